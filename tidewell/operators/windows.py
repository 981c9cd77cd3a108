"""Time windows, the same functions for batch and stream input.

Input has `ts`, a timestamp with time zone. On a stream set the watermark first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewell.config import StreamConfig
from tidewell.functions.scalars import filled, nonzero
from tidewell.storage import write_once


def event_time(events: DataFrame, millis: str = "timestamp") -> DataFrame:
    return events.withColumn("ts", F.timestamp_millis(millis))


def tumbling(events: DataFrame, width: str = StreamConfig.tumbling) -> DataFrame:
    """Events, transactions and amount per user and window."""
    amount = F.when(F.col("event_type") == "transaction", F.coalesce("price", F.lit(0.0))).otherwise(0.0)
    return events.groupBy(F.window("ts", width), "user_id").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("event_type") == "transaction").alias("transactions"),
        F.sum(amount.cast("decimal(20,4)")).cast("double").alias("amount"),
    ).select(
        "user_id", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        "events", "transactions", "amount",
    )


def velocity(events: DataFrame, width: str = StreamConfig.tumbling) -> DataFrame:
    """Each event with the number of events and the amount of its user's window. Batch only.

    Events without user count as those of one unknown user; an event without time has no window.
    On a stream the same join runs on the rows of each micro-batch.
    """
    per_window = tumbling(events, width).select(
        "user_id", "window_start", F.col("events").alias("velocity"), F.col("amount").alias("window_amount")
    )
    # window() drops rows without time, so it only sees those that have one.
    placed = events.filter(F.col("ts").isNotNull()).withColumn("window_start", F.window("ts", width)["start"])
    same = F.col("e.user_id").eqNullSafe(F.col("w.user_id")) & (F.col("e.window_start") == F.col("w.window_start"))
    joined = placed.alias("e").join(per_window.alias("w"), same).select("e.*", "w.velocity", "w.window_amount")
    timeless = events.filter(F.col("ts").isNull())
    return joined.unionByName(timeless, allowMissingColumns=True)


def stream_sessions(events: DataFrame, gap: str = StreamConfig.session_gap) -> DataFrame:
    """Session features per user from session windows.

    The distinct items are collected: their number is limited by the length of a session.
    """
    stamp = nonzero(F.col("timestamp"))
    kind = F.coalesce("event_type", F.lit("view"))
    return events.groupBy(F.session_window("ts", gap), "user_id").agg(
        F.count(F.lit(1)).alias("session_length"),
        F.when(F.count(stamp) >= 2, F.max(stamp) - F.min(stamp)).otherwise(F.lit(0)).alias("duration_seconds"),
        F.bool_or(kind == "transaction").alias("has_purchase"),
        F.bool_or(kind == "addtocart").alias("has_cart"),
        F.size(F.collect_set(filled(F.col("item_id")))).cast("bigint").alias("unique_items_viewed"),
    ).select(
        "user_id", F.col("session_window.start").alias("session_start"),
        "session_length", "duration_seconds", "has_purchase", "has_cart", "unique_items_viewed",
    )


def sliding(changes: DataFrame, width: str = StreamConfig.sliding, slide: str = StreamConfig.slide) -> DataFrame:
    """Changes, net quantity and lowest and highest level per item and sliding window."""
    return changes.groupBy(F.window("ts", width, slide), "item_id", "warehouse_id").agg(
        F.count(F.lit(1)).alias("changes"),
        F.sum("quantity_change").alias("net_change"),
        F.min("current_stock").alias("min_stock"),
        F.max("current_stock").alias("max_stock"),
    ).select(
        "item_id", "warehouse_id", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        "changes", "net_change", "min_stock", "max_stock",
    )


PANE_KEYS = ["item_id", "warehouse_id"]
#: Panes whose windows one task works out; several sorts of them are in its memory at once.
PANES_PER_TASK = 50_000


def _pane_sums() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("_n"),
        F.count("quantity_change").alias("_known"),
        F.sum("quantity_change").alias("_net"),
        F.min("current_stock").alias("_min"),
        F.max("current_stock").alias("_max"),
    ]


def stream_panes(changes: DataFrame) -> DataFrame:
    """What each hour holds per item, for `sliding_over`. On a stream an hour comes out when the watermark has passed it.

    The state is one row per item and hour, whatever the width of the windows made of the hours.
    """
    hour = F.floor(F.unix_millis(F.col("window.start")) / F.lit(3600000)).cast("bigint")
    return changes.groupBy(F.window("ts", "1 hour"), *PANE_KEYS).agg(*_pane_sums()).withColumn("_hour", hour).drop("window")


def sliding_by_panes(changes: DataFrame, hours: int = 24) -> DataFrame:
    """The same windows as `sliding`, sliding by an hour, in batch. Rows are summed up per hour first."""
    hour = F.floor(F.col("timestamp") / F.lit(3600000)).cast("bigint")
    panes = changes.filter(F.col("timestamp").isNotNull()).groupBy(*PANE_KEYS, hour.alias("_hour")).agg(*_pane_sums())
    return sliding_over(write_once(panes, "panes"), hours)


def sliding_over(panes: DataFrame, hours: int = 24) -> DataFrame:
    """Sliding windows over stored panes, one per item and hour.

    What a window holds changes only where an hour's pane enters or leaves it, so
    windows are computed once per such instant and repeated for the starts up to the next one. Counts and sums are
    differences of running totals. Lowest and highest levels come from blocks of as many hours as a window has: it
    covers the end of one block and the beginning of the next, whose running extremes are known. Everything
    after the panes happens where a key's panes are, in as many tasks as their number asks for.
    """
    keys = PANE_KEYS
    panes = panes.repartition(max(1, -(-panes.count() // PANES_PER_TASK)), *keys)
    block = F.floor(F.col("_hour") / hours)
    along, inside = W.partitionBy(*keys).orderBy("_hour"), W.partitionBy(*keys, "_block")
    upto = inside.orderBy("_hour").rowsBetween(W.unboundedPreceding, W.currentRow)
    onward = inside.orderBy(F.col("_hour").desc()).rowsBetween(W.unboundedPreceding, W.currentRow)
    running = along.rowsBetween(W.unboundedPreceding, W.currentRow)
    total = F.struct(
        F.sum("_n").over(running).alias("n"), F.sum("_known").over(running).alias("known"),
        F.sum(F.coalesce("_net", F.lit(0))).over(running).alias("net"),
    )
    ends = {
        name: F.struct("_block", F.min("_min").over(edge).alias("min"), F.max("_max").over(edge).alias("max"))
        for name, edge in (("_upto", upto), ("_onward", onward))
    }
    panes = panes.withColumn("_block", block).withColumns({**ends, "_total": total})
    panes = panes.withColumn("_next", F.lead("_onward").over(along))

    # A pane is in the windows that start from hours - 1 before it up to its own hour.
    enters = F.struct((F.col("_hour") - (hours - 1)).alias("start"), F.lit(True).alias("enters"))
    leaves = F.struct((F.col("_hour") + 1).alias("start"), F.lit(False).alias("enters"))
    turns = panes.withColumn("_turn", F.explode(F.array(enters, leaves))).select("*", "_turn.start", "_turn.enters")
    by_start = W.partitionBy(*keys).orderBy("start")
    before = by_start.rowsBetween(W.unboundedPreceding, W.currentRow)
    came = F.when(F.col("enters"), F.struct("_total", "_upto"))
    gone = F.when(~F.col("enters"), F.struct("_total", "_next"))
    opening = F.first(F.when(F.col("enters"), F.struct("_onward")), ignorenulls=True).over(before)
    turns = turns.select(
        *keys, "start",
        F.last(came, ignorenulls=True).over(before).alias("came"),
        F.last(gone, ignorenulls=True).over(before).alias("gone"),
        opening.alias("opening"),
        F.lead("start").over(by_start).alias("until"),
    )
    # Of several turns at one instant only the last one lasts; after the last pane nothing is left.
    turns = turns.filter("until > start")

    def kept(name: str):
        return F.col(f"came._total.{name}") - F.coalesce(F.col(f"gone._total.{name}"), F.lit(0))

    low = F.when(F.col("gone").isNull(), F.col("opening._onward")).otherwise(F.col("gone._next"))
    changes_in = turns.select("*", low.alias("low"), kept("n").alias("changes"), kept("known").alias("known")).filter("changes > 0")
    spread = changes_in.withColumn("_start", F.explode(F.sequence(F.col("start"), F.col("until") - 1)))
    first_block, last_block = F.floor(F.col("_start") / hours), F.floor((F.col("_start") + hours - 1) / hours)

    def extreme(name: str, choose):
        from_low = F.when(F.col("low._block") == first_block, F.col(f"low.{name}"))
        from_high = F.when((F.col("came._upto._block") == last_block), F.col(f"came._upto.{name}"))
        return choose(from_low, from_high)

    return spread.select(
        *keys,
        F.timestamp_millis(F.col("_start") * 3600000).alias("window_start"),
        F.timestamp_millis((F.col("_start") + hours) * 3600000).alias("window_end"),
        "changes",
        F.when(F.col("known") > 0, kept("net")).alias("net_change"),
        extreme("min", F.least).alias("min_stock"),
        extreme("max", F.greatest).alias("max_stock"),
    )
