"""Document change streams: upsert rows keyed by ``_id``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F, types as T

from ..functions.documents import decode_document, get
from .position import packed

# Digits of the cluster time in a wide position.
TIME_DIGITS = 20


def decode_change_stream(raw: DataFrame, doc_schema, column: str = "value",
                         hints: dict[str, str] | None = None, wide: bool = False) -> DataFrame:
    """Change events to change rows. Updates and replacements carry the looked-up whole document,
    deletes only the key; events that concern no document are left out.

    The position is the cluster time, as a number. All changes of one transaction have the same one; what tells them apart
    is the resume token of the event (``_id._data``), hexadecimal text whose order is that of the stream. ``wide`` positions
    are texts, the cluster time in 20 digits and the token. Without them a change of a transaction is an error.
    """
    row = doc_schema if isinstance(doc_schema, T.StructType) else T.StructType.fromDDL(doc_schema)
    if "_id" not in row.fieldNames():
        raise ValueError("a document schema needs _id")
    df = raw.select(F.try_parse_json(column).alias("_v"))
    v = F.col("_v")

    def at(*path, kind="string"):
        return get(v, list(path), kind)

    # The looked-up document is an object, or a text that holds one.
    df = df.withColumn("_doc", F.when(at("fullDocument", "_id", kind="variant").isNotNull(),
                                      at("fullDocument", kind="variant"))
                       .otherwise(F.try_parse_json(at("fullDocument"))))
    kind = at("operationType")
    op = (F.when((kind == "insert") & (at("source", "snapshot") == "true"), "r").when(kind == "insert", "c")
          .when(kind.isin("update", "replace"), "u").when(kind == "delete", "d"))
    key_row = T.StructType([row["_id"]])
    seconds, counter = (F.coalesce(at("clusterTime", "$timestamp", part, kind="bigint"), at("clusterTime", part, kind="bigint")) for part in ("t", "i"))
    # The key is an object, or a text that holds one.
    key = F.coalesce(F.when(at("documentKey", "_id", kind="variant").isNotNull(), at("documentKey", kind="variant")),
                     F.try_parse_json(at("documentKey")))
    # Cluster time orders all events of a deployment; a resume number is used only where it is not whole.
    place = F.coalesce(packed(seconds, counter), at("resume", kind="bigint"))
    place = F.when(place.isNotNull(), place).when((op == "r") | op.isNull(), F.lit(0)).otherwise(
        F.raise_error(F.lit("a change has no cluster time")).cast("bigint"))
    in_transaction = at("txnNumber").isNotNull() & op.isin("c", "u", "d")
    if wide:
        token = F.upper(F.coalesce(at("_id", "_data"), at("resumeToken", "_data")))
        untold = F.raise_error(F.lit("a change of a transaction has no resume token")).cast("string")
        place = F.concat(F.lpad(place.cast("string"), TIME_DIGITS, "0"), F.when(token.isNotNull(), token).when(in_transaction, untold).otherwise(""))
    else:
        place = F.when(in_transaction, F.raise_error(F.lit("changes of a transaction need wide=True")).cast("bigint")).otherwise(place)
    df = df.withColumn("_key", key).select(
        at("ns", "db").alias("db"), F.lit(None).cast("string").alias("schema"),
        at("ns", "coll").alias("table"), op.alias("op"), place.alias("pos"),
        F.lit(0).alias("sub"), (seconds * 1000).alias("event_ts"), at("ts_ms", kind="bigint").alias("fetch_ts"),
        decode_document(F.col("_key"), key_row, hints).alias("key"),
        F.lit(None).cast(row.simpleString()).alias("before"),
        F.when(op != "d", decode_document(F.col("_doc"), row, hints)).alias("after"))
    return df.where(F.col("op").isNotNull())
