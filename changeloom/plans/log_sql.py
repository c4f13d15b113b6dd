"""The change log of ``orders_log`` in plain SQL, for the oracle queries.

Flat columns: op, pos, sub, k (key), b* (before image), a* (after image).
"""

IMG = """img AS (
  SELECT o_orderkey AS k, o_custkey AS cust, o_orderstatus AS st,
         CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders),
upd AS (
  SELECT k, cust, st, cents,
         CASE WHEN k % 7 = 0 THEN 'F' ELSE st END AS ust,
         CASE WHEN k % 7 = 0 THEN cents + 500 ELSE cents END AS ucents FROM img)"""

_NB = ("CAST(NULL AS BIGINT) AS bk, CAST(NULL AS BIGINT) AS bcust, CAST(NULL AS VARCHAR) AS bst, "
       "CAST(NULL AS BIGINT) AS bcents")
_NA = ("CAST(NULL AS BIGINT) AS ak, CAST(NULL AS BIGINT) AS acust, CAST(NULL AS VARCHAR) AS ast, "
       "CAST(NULL AS BIGINT) AS acents")
_B, _BU = "k AS bk, cust AS bcust, st AS bst, cents AS bcents", "k AS bk, cust AS bcust, ust AS bst, ucents AS bcents"
_A, _AU = "k AS ak, cust AS acust, st AS ast, cents AS acents", "k AS ak, cust AS acust, ust AS ast, ucents AS acents"
_AC = "k + 1000000000 AS ak, cust AS acust, st AS ast, cents AS acents"
_AM = "k + 2000000000 AS ak, cust AS acust, ust AS ast, ucents AS acents"

SNAP = f"snap AS (SELECT 'r' AS op, CAST(0 AS BIGINT) AS pos, 0 AS sub, k, {_NB}, {_A} FROM upd)"

_UCD = f"""SELECT 'u' AS op, 100000000 + k AS pos, 0 AS sub, k, {_B}, {_AU} FROM upd WHERE k % 7 = 0
  UNION ALL SELECT 'd', 200000000 + k, 0, k, {_BU}, {_NA} FROM upd WHERE k % 11 = 0
  UNION ALL SELECT 'c', 300000000 + k, 0, k + 1000000000, {_NB}, {_AC} FROM upd WHERE k % 13 = 0"""
_MOVE = "FROM upd WHERE k % 17 = 0 AND k % 11 <> 0"

# The log as written (the key of a moving update is its new key) and after key changes are split.
RAW = f"""rawlog AS ({_UCD}
  UNION ALL SELECT 'u', 400000000 + k, 0, k + 2000000000, {_BU}, {_AM} {_MOVE})"""
SPLIT = f"""log AS ({_UCD}
  UNION ALL SELECT 'd', 400000000 + k, 0, k, {_BU}, {_NA} {_MOVE}
  UNION ALL SELECT 'c', 400000000 + k, 1, k + 2000000000, {_NB}, {_AM} {_MOVE})"""

BASE = f"WITH {IMG}, {SNAP}, {RAW}, {SPLIT}"
# Final state by its closed form.
FINAL = """final AS (
  SELECT k, cust, ust AS st, ucents AS cents FROM upd WHERE k % 11 <> 0 AND k % 17 <> 0
  UNION ALL SELECT k + 1000000000, cust, st, cents FROM upd WHERE k % 13 = 0
  UNION ALL SELECT k + 2000000000, cust, ust, ucents FROM upd WHERE k % 17 = 0 AND k % 11 <> 0)"""
WITH_FINAL = f"{BASE}, {FINAL}"
# Even chunks of size 1000 on the dense order key, with their log positions.
MARKED = f"""{WITH_FINAL}, bounds AS (SELECT min(k) AS lo, max(k) AS hi, count(*) AS n FROM img),
plan AS (SELECT lo, CASE WHEN n <= 1000 THEN 0 ELSE (hi - lo) // step END AS last, step FROM (
  SELECT lo, hi, n, CAST(greatest(floor(CAST(ceil((hi - lo + 1) * 10000.0 / n) AS DOUBLE) / 10000 * 1000), 1) AS BIGINT) AS step
  FROM bounds)),
chunked AS (SELECT log.*, greatest(least((log.k - lo) // step, last), 0) AS chunk_id FROM log, plan),
marked AS (SELECT *, (1 + chunk_id % 4) * 100000000 + 50 AS high_pos FROM chunked)"""
