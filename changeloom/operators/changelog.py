"""Change rows as an algebra: row kinds, key changes, before images, latest state, checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from . import spread


def offset_column() -> Column:
    return F.struct(*S.ORDER)


class Keys:
    """Grouping columns with the ``key`` struct taken apart: Spark sorts and hashes plain columns
    several times faster than a struct."""

    def __init__(self, df: DataFrame, by: tuple[str, ...] | list[str]):
        fields = df.schema["key"].dataType.fieldNames() if "key" in by else []
        plain = [c for c in by if c != "key"]
        self.names = [*plain, *[f"_key_{f}" for f in fields]]
        self.columns = [*[F.col(c) for c in plain], *[F.col(f"key.{f}").alias(f"_key_{f}") for f in fields]]
        self.restored = [F.col(c) for c in plain]
        if fields:
            self.restored.append(F.struct(*[F.col(f"_key_{f}").alias(f) for f in fields]).alias("key"))

    def add(self, df: DataFrame) -> DataFrame:
        """``df`` with the grouping columns it does not have yet."""
        return df.withColumns({n: c for n, c in zip(self.names, self.columns) if n not in df.columns})


# ---------------------------------------------------------------- row kinds

def to_row_kinds(df: DataFrame, mode: str = "all", has_key: bool = True,
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """Kinded rows: row_kind, pos, sub, payload columns, then the ``keep`` columns.

    ``all`` retracts the old image of an update and needs it; ``upsert`` never does, and needs a key.
    """
    if mode == "upsert" and not has_key:
        raise ValueError("upsert mode needs a primary key")
    if mode not in ("all", "upsert"):
        raise ValueError(f"unknown changelog mode {mode!r}")
    op, before, after = F.col("op"), F.col("before"), F.col("after")

    second = F.col("_part") == 1
    if mode == "all":
        old = F.when(before.isNotNull(), before).otherwise(
            F.raise_error(F.concat(F.lit("no before image at position "), F.col("pos"))))
        # An update gives two rows. Plain numbers are exploded, images are chosen afterwards.
        parts = F.when(op == "u", F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        kind = (F.when(op.isin("r", "c"), S.INSERT).when(op == "d", S.DELETE)
                .when(second, S.UPDATE_AFTER).otherwise(S.UPDATE_BEFORE))
        image = F.when(op.isin("r", "c") | second, after).otherwise(old)
    else:
        kind = F.when(op.isin("r", "c"), S.INSERT).when(op == "d", S.DELETE).otherwise(S.UPDATE_AFTER)
        # Without a before image the key is all that is left of a deleted row.
        names = df.schema["after"].dataType.fieldNames()
        keys = df.schema["key"].dataType.fieldNames()
        bare = F.struct(*[(F.col(f"key.{n}") if n in keys else
                           F.lit(None).cast(df.schema["after"].dataType[n].dataType)).alias(n)
                          for n in names])
        image = F.when(op == "d", F.coalesce(before, bare)).otherwise(after)
    rows = df.where(op.isin("r", "c", "u", "d"))
    if mode == "all":
        rows = rows.withColumn("_part", F.explode(parts))
    return (rows.select(kind.alias("row_kind"), *S.ORDER, image.alias("_image"), *keep)
            .select("row_kind", *S.ORDER, "_image.*", *keep))


def split_key_updates(df: DataFrame) -> DataFrame:
    """An update that changes the key becomes a delete of the old key and a create of the new one."""
    keys = df.schema["key"].dataType.fieldNames()
    old, new = F.col("before"), F.col("after")
    same = F.lit(True)
    for name in keys:
        same = same & old[name].eqNullSafe(new[name])
    moved = (F.col("op") == "u") & old.isNotNull() & new.isNotNull() & ~same

    none = F.lit(None).cast(df.schema["after"].dataType)
    first, second = F.col("_part") == 1, F.col("_part") == 2

    def key_of(image):
        return F.struct(*[image[n].alias(n) for n in keys])
    # 0: as it is, 1: the delete and 2: the create of a moved row.
    parts = F.when(moved, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(0)))
    changed = {
        "op": F.when(first, "d").when(second, "c").otherwise(F.col("op")),
        "sub": F.col("sub") + F.when(second, 1).otherwise(0),     # even as read, so this is free
        "key": F.when(first, key_of(old)).when(second, key_of(new)).otherwise(F.col("key")),
        "before": F.when(second, none).otherwise(old),
        "after": F.when(first, none).otherwise(new),
    }
    return (df.withColumn("_part", F.explode(parts))
            .select(*[(changed[c].alias(c) if c in changed else F.col(c)) for c in df.columns]))


def normalize_upserts(df: DataFrame, by: tuple[str, ...] = ("key",),
                      rows_per_block: int = spread.ROWS_PER_BLOCK) -> DataFrame:
    """Give upsert rows the image their key had before; a first upsert becomes a create.

    A key with very many changes is worked on in position blocks, see ``spread``.
    """
    kind = df.schema["after"].dataType.simpleString()
    keys = Keys(df, by)
    base = keys.add(df.drop("before"))
    out = spread.previous_by_key(base, keys.names, S.ORDER, F.col("after"), "before", rows_per_block)
    out = out.withColumn("before", F.col("before").cast(kind))
    op = F.when(F.col("op").isin("u", "c"),
                F.when(F.col("before").isNull(), F.lit("c")).otherwise(F.lit("u")))
    return out.withColumn("op", F.coalesce(op, F.col("op"))).select(*df.columns)


# ---------------------------------------------------------------- state

def materialize(df: DataFrame, by: tuple[str, ...] = ("key",), keep: tuple[str, ...] = ()) -> DataFrame:
    """Latest image per key, deleted keys gone.

    An aggregate, not a window: every task first reduces its own rows to one per key, so a key with
    very many changes sends one row per task through the shuffle.
    """
    latest = F.max_by(F.struct("op", "after", *S.ORDER), offset_column())
    plain = [c for c in by if c != "key"]
    return (df.groupBy(*Keys(df, by).columns).agg(latest.alias("_l")).where(F.col("_l.op") != "d")
            .select(*plain, "_l.after.*", *[F.col(f"_l.{c}").alias(c) for c in keep]))


def latest_changes(df: DataFrame, by: tuple[str, ...] = ("key",)) -> DataFrame:
    """The last change row of each key, deletes included."""
    rest = [c for c in df.columns if c not in by]
    keys = Keys(df, by)
    latest = F.max_by(F.struct(*rest), offset_column())
    return df.groupBy(*keys.columns).agg(latest.alias("_l")).select(*keys.restored, "_l.*").select(*df.columns)


def dedup_at_least_once(df: DataFrame, by: tuple[str, ...] = ("db", "table", "key", "op", "pos", "sub")) -> DataFrame:
    keys = Keys(df, by)
    return keys.add(df).dropDuplicates(keys.names).select(*df.columns)


def reconcile_states(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of one side that the other does not have (bag semantics), in one shuffle."""
    cols = left.columns
    both = (left.withColumn("_n", F.lit(1))
            .unionByName(right.select(*cols).withColumn("_n", F.lit(-1))))
    extra = both.groupBy(*cols).agg(F.sum("_n").alias("_n")).where(F.col("_n") != 0)
    return extra.select(F.when(F.col("_n") > 0, "left").otherwise("right").alias("side"), *cols,
                        F.abs("_n").alias("copies"))


def evolve_rows(*parts: DataFrame) -> DataFrame:
    """Rows from before and after a column was added, under the union of their columns."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def latest_schemas(history: DataFrame, by: tuple[str, ...] = ("db", "table"), full: bool = False) -> DataFrame:
    """The last schema of each table, or the history numbered in order."""
    if not full:
        return history.groupBy(*by).agg(F.max_by("schema_json", "pos").alias("schema_json"),
                                        F.max("pos").alias("pos"))
    return spread.running_totals_by_key(history, list(by), "pos", {"version": F.lit(1)})


# ---------------------------------------------------------------- checks

def validate_changes(df: DataFrame, key_expected: bool = True) -> DataFrame:
    """Rows that break the contract of their operation, with the reason."""
    op, key, before, after = (F.col(c) for c in ("op", "key", "before", "after"))
    missing_key = key.isNull() if key_expected else key.isNotNull()
    key_text = "key missing" if key_expected else "unexpected key"
    reason = (F.when(op.isNull() | ~op.isin("r", "c", "u", "d"), "unknown op")
              .when((op == "r") & key.isNull(), "key missing")
              .when((op != "r") & missing_key, key_text)
              .when(op.isin("r", "c") & after.isNull(), "after missing")
              .when(op.isin("r", "c") & before.isNotNull(), "unexpected before")
              .when((op == "u") & after.isNull(), "after missing")
              .when((op == "d") & before.isNull(), "before missing")
              .when((op == "d") & after.isNotNull(), "unexpected after"))
    return df.withColumn("reason", reason).where(F.col("reason").isNotNull())


def check_row_images(df: DataFrame) -> DataFrame:
    """Per table: updates and deletes, and how many lack the before image."""
    touched = df.where(F.col("op").isin("u", "d"))
    return touched.groupBy("db", "table").agg(
        F.count(F.lit(1)).alias("changes"),
        F.count_if(F.col("before").isNull()).alias("missing_before"))
