"""Business and ingestion metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.config import StreamConfig
from tidewell.functions.scalars import ratio, round_to


def business_metrics(events: DataFrame) -> DataFrame:
    """Revenue, orders, views and conversion per day."""
    kind = F.col("event_type")
    revenue = F.when(kind == "transaction", F.col("price") * F.col("quantity")).otherwise(0.0)
    orders, views = F.count_if(kind == "transaction"), F.count_if(kind == "view")
    return events.groupBy(F.to_date(F.timestamp_millis("timestamp")).alias("metric_date")).agg(
        round_to(F.sum(revenue.cast("decimal(20,4)")), 2).alias("revenue"),
        orders.alias("orders"),
        views.alias("views"),
        round_to(ratio(orders, views), 4).alias("conversion_rate"),
    )


def ingest_rate(records: DataFrame) -> DataFrame:
    """Records per topic and second, accepted and rejected."""
    second = F.floor(F.col("timestamp_ms") / F.lit(1000)).cast("bigint")
    return records.groupBy("topic", second.alias("second")).agg(
        F.count_if("valid").alias("sent"),
        F.count_if(~F.col("valid")).alias("failed"),
    )


def consumer_lag(offered: DataFrame, processed: DataFrame, alarm: int = StreamConfig.lag_alarm) -> DataFrame:
    """Per topic: records offered, records processed, those still to come, and whether they are too many.

    Both tables have topic, partition and offset; offsets count a partition's records. Records are summed up per
    partition before anything is joined.
    """

    def last(records: DataFrame, name: str) -> DataFrame:
        return records.groupBy("topic", "partition").agg((F.max("offset") + 1).alias(name))

    partitions = last(offered, "offered").join(last(processed, "done"), ["topic", "partition"], "left")
    done = F.coalesce("done", F.lit(0))
    return partitions.groupBy("topic").agg(
        F.sum("offered").alias("offered"), F.sum(done).alias("processed"), F.sum(F.col("offered") - done).alias("lag"),
    ).withColumn("alarm", F.col("lag") > alarm)


def ingest_metrics(records: DataFrame) -> DataFrame:
    """Per topic: records, failures, size, and the mean and peak rate per second."""
    second = F.floor(F.col("timestamp_ms") / F.lit(1000)).cast("bigint")
    # Seconds first: they are few, so the topic totals need little shuffling.
    seconds = records.groupBy("topic", second.alias("second")).agg(
        F.count_if("valid").alias("sent"), F.count_if(~F.col("valid")).alias("failed"), F.count(F.lit(1)).alias("n")
    )
    return seconds.groupBy("topic").agg(
        F.sum("sent").alias("sent"),
        F.sum("failed").alias("failed"),
        F.sum("n").alias("topic_size"),
        F.max("n").alias("peak_per_second"),
        (F.sum("n") / (F.max("second") - F.min("second") + 1)).alias("events_per_second"),
    )
