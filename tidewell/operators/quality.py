"""Data-quality checks. Each returns the offending rows: none means passed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell import config
from tidewell.operators.lakehouse import daily_fraud_rate


def duplicates(df: DataFrame, key: str) -> DataFrame:
    """Values of `key` found more than once."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("cnt")).filter("cnt > 1")


def null_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row with the number of rows lacking a value, or no row at all."""
    missing = F.lit(False)
    for name in columns:
        missing = missing | F.col(name).isNull()
    return df.filter(missing).agg(F.count(F.lit(1)).alias("cnt")).filter("cnt > 0")


def fraud_rate_days(scored: DataFrame, limit: float = 5.0) -> DataFrame:
    """Days whose fraud rate is above the limit, in percent."""
    return daily_fraud_rate(scored).filter(F.col("fraud_rate") > limit).select("metric_date", "fraud_rate")


def fraud_rate_count(scored: DataFrame, limit: float = 5.0) -> DataFrame:
    """The number of such days; always one row."""
    return fraud_rate_days(scored, limit).agg(F.count(F.lit(1)).alias("cnt"))


def column_tests(df: DataFrame, source: str, unique: list[str], not_null: list[str]) -> DataFrame:
    """Declared column tests of one source: a row per test with its failures."""
    wanted = [("unique", name) for name in unique] + [("not_null", name) for name in not_null]
    parts = []
    for test, name in wanted:
        if test == "unique":
            bad = duplicates(df.filter(F.col(name).isNotNull()), name)
        else:
            bad = df.filter(F.col(name).isNull())
        parts.append(
            bad.agg(F.count(F.lit(1)).alias("failures")).select(
                F.lit(source).alias("source"), F.lit(name).alias("column_name"), F.lit(test).alias("test"), "failures"
            )
        )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows, nulls, distinct values and extremes of each column, as text.

    The columns are stacked to (column, value) pairs first: the distinct counts then
    come from one grouped aggregation instead of one expansion per column. Extremes are those of the
    column's own type, so 10.0 is more than 2.5.
    """
    pairs = df.select(
        F.explode(F.array(*[
            F.struct(F.lit(name).alias("column_name"), F.col(name).cast("string").alias("value")) for name in columns
        ])).alias("_p")
    ).select("_p.*")
    values = pairs.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    counts = values.groupBy("column_name").agg(
        F.sum("n").alias("total"),
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("nulls"),
        F.count("value").alias("distinct_values"),
    )
    # One row of extremes, turned into one row per column.
    extremes = df.agg(F.array(*[
        F.struct(
            F.lit(name).alias("column_name"),
            F.min(name).cast("string").alias("min_value"),
            F.max(name).cast("string").alias("max_value"),
        ) for name in columns
    ]).alias("_e")).select(F.inline("_e"))
    return counts.join(extremes, "column_name")


def compare_shares(a: DataFrame, b: DataFrame, column: str) -> DataFrame:
    """Share of each value of `column` in two datasets, and how far apart they are."""

    def shares(df: DataFrame, out: str) -> DataFrame:
        counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
        whole = counts.agg(F.sum("n").alias("n")).scalar()
        return counts.select(column, (F.col("n").cast("double") / whole).alias(out))

    joined = shares(a, "share_a").join(shares(b, "share_b"), column, "full")
    filled = joined.na.fill(0.0, ["share_a", "share_b"])
    return filled.withColumn("difference", F.abs(F.col("share_a") - F.col("share_b")))


def _violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    counted = df.agg(*[F.count_if(rule).alias(name) for name, rule in rules.items()])
    pairs = F.array(*[F.struct(F.lit(name).alias("rule"), F.col(name).alias("violations")) for name in rules])
    return counted.select(F.explode(pairs).alias("_r")).select("_r.*").filter("violations > 0")


def event_conformance(events: DataFrame) -> DataFrame:
    """Rules of the event record that are broken, with the number of rows breaking them."""
    return _violations(events, {
        "event_id_required": F.col("event_id").isNull(),
        "event_type_required": F.col("event_type").isNull(),
        "timestamp_required": F.col("timestamp").isNull(),
        "user_id_required": F.col("user_id").isNull(),
        "event_type_known": F.col("event_type").isNotNull() & ~F.col("event_type").isin(config.EVENT_TYPES),
        "rating_1_to_5": F.col("rating").isNotNull() & ~F.col("rating").between(1, 5),
    })


def inventory_conformance(changes: DataFrame) -> DataFrame:
    return _violations(changes, {
        "change_id_required": F.col("change_id").isNull(),
        "timestamp_required": F.col("timestamp").isNull(),
        "item_id_required": F.col("item_id").isNull(),
        "change_type_known": F.col("change_type").isNull() | ~F.col("change_type").isin(config.CHANGE_TYPES),
        "quantity_before_required": F.col("quantity_before").isNull(),
        "quantity_change_required": F.col("quantity_change").isNull(),
        "quantity_after_required": F.col("quantity_after").isNull(),
    })
