"""Bronze, silver and gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell import config
from tidewell.functions import ordered
from tidewell.functions.scalars import round_to


def bronze_events(events: DataFrame, start_date: str = config.BRONZE_START_DATE) -> DataFrame:
    """Raw events from a start date on. Keeps `ingestion_timestamp` where the source has it."""
    # The filter names the source column itself, so the scan can skip row groups.
    stamped = events if "ingestion_timestamp" in events.columns else events.withColumn(
        "ingestion_timestamp", F.current_timestamp()
    )
    return stamped.filter(F.col("timestamp") >= F.lit(start_date).cast(events.schema["timestamp"].dataType)).select(
        "event_id",
        "user_id",
        "event_type",
        F.col("timestamp").cast("timestamp").alias("timestamp"),
        "event_data",
        "ingestion_timestamp",
    )


def bronze_fraud(scores: DataFrame) -> DataFrame:
    return scores.select(
        "event_id",
        "user_id",
        "fraud_score",
        "is_fraud",
        F.col("timestamp").cast("timestamp").alias("timestamp"),
        F.current_timestamp().alias("ingestion_timestamp"),
    )


def bronze_inventory(inventory: DataFrame) -> DataFrame:
    return inventory.select(
        "product_id",
        "warehouse_id",
        "quantity_change",
        "current_stock",
        F.col("timestamp").cast("timestamp").alias("timestamp"),
        F.current_timestamp().alias("ingestion_timestamp"),
    )


def events_clean(bronze: DataFrame) -> DataFrame:
    """The copy of each event that was ingested last, with a numeric value.

    Copies ingested at the same instant are told apart by their content.
    """
    named = bronze.filter(F.col("event_id").isNotNull()).select(
        "event_id", "user_id", "event_type", "event_data", "timestamp", "ingestion_timestamp"
    )
    newest = ordered.latest(
        named,
        ["event_id"],
        [F.col("ingestion_timestamp"), F.col("timestamp"), F.col("event_data"), F.col("event_type"), F.col("user_id")],
    )
    return newest.select(
        "event_id",
        "user_id",
        "event_type",
        F.col("event_data").try_cast("double").alias("event_value"),
        "timestamp",
        F.current_timestamp().alias("built_at"),
    )


def fraud_events(fraud: DataFrame, bronze: DataFrame) -> DataFrame:
    """Scores with the amount of their event; every raw copy of the event counts.

    A left join, in two parts: the copies of one event may be a large share of all rows,
    and Spark can split such a key over tasks in an inner join only. Scores without an
    event are found against the distinct ids, which are few per task.
    """
    amounts = bronze.select("event_id", F.col("event_data").try_cast("double").alias("amount"))
    columns = ["event_id", "user_id", "fraud_score", "is_fraud", "amount", "timestamp"]
    matched = fraud.join(amounts, "event_id").select(*columns)
    alone = fraud.join(bronze.select("event_id").distinct(), "event_id", "left_anti")
    return matched.unionByName(alone.withColumn("amount", F.lit(None).cast("double")).select(*columns))


def fact_purchases(clean: DataFrame) -> DataFrame:
    """One row per purchase. The product column carries the event type, as the model defines it."""
    return clean.filter(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("transaction_id"),
        "user_id",
        F.col("event_type").alias("product_id"),
        F.col("event_value").alias("amount"),
        F.lit(1).alias("quantity"),
        F.to_date("timestamp").alias("transaction_date"),
        F.current_timestamp().alias("created_at"),
    )


def daily_fraud_rate(scored: DataFrame) -> DataFrame:
    frauds = F.count_if(F.col("is_fraud"))
    total = F.count(F.lit(1))
    return scored.groupBy(F.to_date("timestamp").alias("metric_date")).agg(
        total.alias("total_transactions"),
        frauds.alias("fraud_count"),
        round_to(frauds.cast("double") / total * 100, 2).alias("fraud_rate"),
    )


def mart_fraud_daily(scored: DataFrame) -> DataFrame:
    """Daily fraud figures."""
    frauds = F.count_if(F.col("is_fraud"))
    total = F.count(F.lit(1))
    return scored.groupBy(F.to_date("timestamp").alias("metric_date")).agg(
        total.alias("total_transactions"),
        frauds.alias("fraud_count"),
        round_to(frauds.cast("double") / total * 100, 2).alias("fraud_rate"),
        F.sum(F.when(F.col("is_fraud"), F.col("amount")).otherwise(0.0)).alias("total_fraud_amount"),
        F.avg("fraud_score").alias("avg_fraud_score"),
    )
