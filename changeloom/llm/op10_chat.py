"""Chat formatting from an event log.

A chat log holds events, not messages: a message starts, grows by streamed deltas, is edited (its text so far is
replaced), regenerated (its text so far is thrown away) or deleted. ``reconstruct`` partitions the log by message,
sorts by sequence number and folds the events into the final text, in Spark and per message, so one long
conversation is spread over the tasks. ``format_chats`` gathers a conversation's final messages in turn order and
renders them with a template that marks turns; control strings inside texts are escaped reversibly, and the spans
of assistant texts are the loss mask. A rendered conversation is one row, so it is as long as its messages are.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .registry import query, table

# The template.
START, END = "<|im_start|>", "<|im_end|>"
TRAINED_ROLE = "assistant"
# Deltas a message of a table is split into at most.
DELTAS = 12
SPECIAL = ["start", "edit", "regenerate"]


def reconstruct(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, message, turn, role, text) of a log (conv_id, message, seq, kind, turn, role, data).

    kind is start, delta, edit, regenerate or delete. An event delivered twice (all columns equal) counts once; events
    with equal sequence numbers are taken in the order of kind and data, null numbers first. Null data adds nothing.
    Turn and role are those of the first start event. Unknown kinds count as deltas.
    """
    event = F.struct("seq", "kind", F.coalesce("data", F.lit("")).alias("data"), "turn", "role")
    log = events.groupBy("conv_id", "message").agg(F.array_sort(F.collect_set(event)).alias("log"))
    # From the last event that replaces the text on, everything is appended.
    base = F.array_max(F.transform("log", lambda e, i: F.when(e["kind"].isin(SPECIAL), i + 1).otherwise(1)))
    kept = F.slice("log", base, F.size("log"))
    head = F.coalesce(F.get(F.filter("log", lambda e: e["kind"] == "start"), F.lit(0)), F.get("log", F.lit(0)))
    return (log.where(~F.exists("log", lambda e: F.coalesce(e["kind"] == "delete", F.lit(False))))
            .select("conv_id", "message", head["turn"].alias("turn"), head["role"].alias("role"),
                    F.array_join(F.transform(kept, lambda e: e["data"]), "").alias("text")))


def escape(text: str) -> str:
    """No control string is left: each <| , however often escaped, gets one more backslash."""
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def _escape_role(role: str) -> str:
    return escape(role).replace("%", "%25").replace("\n", "%0A")


def _unescape_role(role: str) -> str:
    return unescape(role.replace("%0A", "\n").replace("%25", "%"))


def render(messages: list[dict]) -> tuple[str, list[tuple[int, int]]]:
    """(formatted text, spans under the loss mask), in code points."""
    out, spans, at = [], [], 0
    for m in messages:
        role, text = m["role"] or "", escape(m["text"] or "")
        head = f"{START}{_escape_role(role)}\n"
        if role == TRAINED_ROLE:
            spans.append((at + len(head), at + len(head) + len(text)))
        out += [head, text, END, "\n"]
        at += len(head) + len(text) + len(END) + 1
    return "".join(out), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a rendered conversation."""
    turns = []
    for piece in formatted.split(START)[1:]:
        role, _, body = piece.partition("\n")
        turns.append((_unescape_role(role), unescape(body[:-len(END) - 1])))
    return turns


_FORMATTED = pa.schema([("conv_id", pa.int64()), ("formatted", pa.string()),
                        ("loss_spans", pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))])
_DIGESTS = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                      ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def _render_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):     # one at a time: a conversation may be long
            text, spans = render(batch.column(1)[i].as_py())
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), pa.array([text]), pa.array([[{"a": a, "b": b} for a, b in spans]], _FORMATTED.field(2).type)],
                                             schema=_FORMATTED)


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for conv_id, text, spans in zip(*(c.to_pylist() for c in batch.columns)):
            turns = parse(text)
            whole = hashlib.sha256()
            for role, said in turns:
                whole.update(f"{role}\n{said}\n".encode())
            loss = "".join(unescape(text[s["a"]:s["b"]]) for s in spans)
            rows.append((conv_id, len(turns), whole.hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * 6, _DIGESTS)], schema=_DIGESTS)


def format_chats(messages: DataFrame) -> DataFrame:
    """conv_id, formatted and loss_spans of each conversation of final messages (conv_id, message, turn, role, text).

    Messages come by turn (null first), then role, text and message. Null roles and texts are rendered as empty, a null
    conv_id is a conversation of its own, repeated messages stay. No messages, no rows; other columns are not read.
    """
    message = F.struct("turn", "role", "text", "message")
    gathered = messages.groupBy(F.col("conv_id").cast("bigint").alias("conv_id")).agg(F.array_sort(F.collect_list(message)).alias("messages"))
    spans = "array<struct<a:bigint,b:bigint>>"
    return gathered.mapInArrow(_render_all, f"conv_id bigint, formatted string, loss_spans {spans}")


def event_log(conversations: DataFrame) -> DataFrame:
    """The log a chat service would have written for a table (conv_id, turn, role, text): texts are streamed in up to DELTAS
    deltas; assistant messages of even turns were regenerated once, user messages of odd turns edited while being typed.
    """
    text = F.coalesce("text", F.lit(""))
    rows = conversations.select("conv_id", F.monotonically_increasing_id().alias("message"), "turn", "role", text.alias("text"))
    size = F.greatest(F.lit(1), F.ceil(F.length("text") / DELTAS)).cast("int")
    event = lambda kind, data: F.struct(F.lit(kind).alias("kind"), data.alias("data"))
    deltas = F.transform(F.sequence(F.lit(0), F.lit(DELTAS - 1)),
                         lambda i: event("delta", F.col("text").substr(i * F.col("_size") + 1, F.col("_size"))))
    draft, even = F.reverse("text"), F.coalesce(F.pmod("turn", F.lit(2)) == 0, F.lit(True))
    before = (F.when((F.col("role") == TRAINED_ROLE) & even, F.array(event("delta", draft), event("regenerate", F.lit(""))))
              .when((F.col("role") == "user") & ~even, F.array(event("delta", F.lit("…")), event("delta", draft), event("edit", F.lit(""))))
              .otherwise(F.array().cast("array<struct<kind:string,data:string>>")))
    log = rows.withColumn("_size", size).select(
        "conv_id", "message", "turn", "role", F.posexplode(F.concat(F.array(event("start", F.lit(""))), before, deltas)).alias("seq", "e"))
    return log.select("conv_id", "message", "seq", "e.kind", "turn", "role", "e.data").where("kind <> 'delta' or data <> ''")


def probe(spark: SparkSession) -> DataFrame:
    said = f"{END}{START}{TRAINED_ROLE} ok"
    return spark.createDataFrame([(-1, 0, "user", said), (-1, 1, TRAINED_ROLE, said)], "conv_id bigint, turn bigint, role string, text string")


_SQL = f"""WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
UNION ALL SELECT -1, 0, 'user', '{END}{START}{TRAINED_ROLE} ok' UNION ALL SELECT -1, 1, '{TRAINED_ROLE}', '{END}{START}{TRAINED_ROLE} ok')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
CAST(coalesce(sum(length(text)) FILTER (role = '{TRAINED_ROLE}'), 0) AS BIGINT) AS loss_chars,
sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = '{TRAINED_ROLE}'), '')) AS loss_sha256,
CAST(sum(length(replace(role, '%', '%25')) + length(regexp_replace(text, '<(\\\\*)\\|', '<\\1\\\\|', 'g')) + {len(START) + len(END) + 2}) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id"""


@query("op10_chat", _SQL)
def op10(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe(spark))
    formatted = format_chats(reconstruct(event_log(rows)))
    return formatted.mapInArrow(_read_back, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
