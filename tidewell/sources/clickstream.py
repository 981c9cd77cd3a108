"""Clickstream CSV files and their way into the event model."""

from __future__ import annotations

from typing import Protocol

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell import config, schemas
from tidewell.functions.scalars import filled, has_text, parse_double, parse_long


class Normalizer(Protocol):
    """Raw rows -> events plus a `valid` flag. User code may bring its own."""

    def __call__(self, rows: DataFrame) -> DataFrame: ...


def scan_csv(spark: SparkSession, path: str, schema: T.StructType = schemas.CLICKSTREAM_CSV) -> DataFrame:
    """CSV files with a header, every column as text. A missing file has no rows.

    Quotes inside a quoted value are doubled, and such a value may hold line breaks. Of several files all
    need the same header; reading others is an error, not a mix-up of columns.
    """
    reader = spark.read.options(header=True, inferSchema=False, quote='"', escape='"', multiLine=True)
    try:
        # The header decides which column is which; the schema only when it is absent.
        names = reader.csv(path).columns
        texts = T.StructType([T.StructField(name, T.StringType()) for name in names])
        found = reader.options(enforceSchema=False).schema(texts).csv(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    return found


def _either(rows: DataFrame, *names: str) -> Column:
    """The first of the columns that exists and is not empty."""
    found = [filled(F.col(name)) for name in names if name in _exact(rows)]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def _exact(rows: DataFrame) -> set[str]:
    return set(rows.columns)


def normalize(rows: DataFrame) -> DataFrame:
    """Clickstream rows as events. Rows that are no event have `valid` = false.

    A price or quantity that is no number, or out of range, is left out; such a timestamp
    rejects the row.
    """
    kind = F.lower(_either(rows, "Event", "event"))
    stamp = _either(rows, "Timestamp", "timestamp")
    visitor = _either(rows, "VisitorID", "visitorid")
    item = _either(rows, "ItemID", "itemid")
    transaction = _either(rows, "TransactionID", "transactionid")
    millis = F.try_multiply(parse_long(stamp), F.lit(1000))
    valid = (
        kind.isin(config.CLICKSTREAM_TYPES)
        & has_text(stamp) & has_text(visitor) & has_text(item) & millis.isNotNull()
    )
    return rows.select(
        F.concat(F.lit("rr-"), stamp, F.lit("-"), visitor).alias("event_id"),
        kind.alias("event_type"),
        millis.alias("timestamp"),
        visitor.alias("user_id"),
        item.alias("item_id"),
        F.when(kind == "transaction", transaction).alias("transaction_id"),
        parse_double(_either(rows, "Price", "price")).alias("price"),
        parse_long(_either(rows, "Quantity", "quantity")).try_cast("int").alias("quantity"),
        F.coalesce(valid, F.lit(False)).alias("valid"),
    )


def normalize_raw(rows: DataFrame) -> DataFrame:
    """The lenient form: lowercase headers only, timestamp as it is, ids unchecked."""
    have = _exact(rows)

    def text(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit("")) if name in have else F.lit("")

    kind = F.lower(text("event"))
    stamp = parse_long(text("timestamp")) if "timestamp" in have else F.lit(0).cast("bigint")
    transaction = F.when(kind == "transaction", F.col("transactionid")) if "transactionid" in have else F.lit(None)
    return rows.select(
        F.concat(F.lit("rr-"), text("timestamp"), F.lit("-"), text("visitorid")).alias("event_id"),
        kind.alias("event_type"),
        stamp.alias("timestamp"),
        text("visitorid").alias("user_id"),
        text("itemid").alias("item_id"),
        transaction.cast("string").alias("transaction_id"),
        (kind.isin(config.CLICKSTREAM_TYPES) & stamp.isNotNull()).alias("valid"),
    )


def valid_events(normalized: DataFrame) -> DataFrame:
    return normalized.filter("valid").drop("valid")


def load(
    rows: DataFrame,
    normalizer: Normalizer = normalize,
    max_raw: int | None = None,
    max_valid: int | None = None,
    order: list[str] | None = None,
) -> DataFrame:
    """Events of a file.

    `max_raw` counts all rows read, `max_valid` only those that became events; 0 or
    None means no limit. With `order` the limit takes the first rows in that order.
    """

    def first(df: DataFrame, n: int | None) -> DataFrame:
        if not n:
            return df
        return (df.orderBy(*order) if order else df).limit(n)

    return first(valid_events(normalizer(first(rows, max_raw))), max_valid)


def load_stats(normalized: DataFrame) -> DataFrame:
    """How many rows became events and how many were rejected."""
    return normalized.agg(
        F.count_if(F.col("valid")).alias("events"),
        F.count_if(~F.col("valid")).alias("errors"),
        F.count(F.lit(1)).alias("total"),
    )
