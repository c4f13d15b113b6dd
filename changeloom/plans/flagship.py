"""The whole chain: chunk a table, merge snapshot and log, keep the state, enrich it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import merge as M, views as V
from . import orders_log as O
from .common import marks, order_chunks, snapshot, split_log
from .log_sql import WITH_FINAL
from .registry import query


@query("flagship_enriched_orders", f"""{WITH_FINAL} SELECT k, final.cust, st, cents, c_name, c_mktsegment FROM final
LEFT JOIN customer ON c_custkey = cust""")
def enriched_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = order_chunks(spark, sf_dir)
    changes = M.snapshot_then_log(snapshot(spark, sf_dir), split_log(spark, sf_dir), plan, marks(spark, plan))
    state = M.state_of_kinds(changes, ["k"])
    customers = O.read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("cust"), "c_name", "c_mktsegment")
    return V.enrich(state, (customers, "cust"))
