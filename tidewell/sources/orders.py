"""Order tables as an event stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.functions.scalars import ratio, to_millis


def orders_to_events(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """One transaction event per order line."""
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    text = lambda name: F.col(name).cast("string")
    return joined.select(
        F.concat_ws("-", F.lit("ord"), text("l_orderkey"), text("l_linenumber"), text("l_partkey"),
                    text("l_suppkey")).alias("event_id"),
        F.lit("transaction").alias("event_type"),
        to_millis(F.col("o_orderdate")).alias("timestamp"),
        text("o_custkey").alias("user_id"),
        text("l_partkey").alias("item_id"),
        text("l_orderkey").alias("transaction_id"),
        ratio(F.col("l_extendedprice"), F.col("l_quantity")).alias("price"),
        F.col("l_quantity").cast("int").alias("quantity"),
    )
