"""Topics: reading, decoding, routing, retention."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell import config, schemas
from tidewell.functions import ordered
from tidewell.functions.scalars import lookup, parse_double, parse_long


def resolve_topics(aliases: Iterable[str] = ("events",)) -> list[str]:
    """Physical topics of the known aliases; an error when none is known."""
    found = [config.TOPICS[alias] for alias in aliases if alias in config.TOPICS]
    if not found:
        raise ValueError("no known topic among the aliases")
    return found


def kafka_options(
    brokers: str,
    aliases: Iterable[str] = ("events",),
    group_id: str | None = None,
    starting: str | int = "latest",
    max_records: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Options of the Kafka source. `starting` is earliest, latest or epoch ms.

    `max_records` limits what one micro-batch takes; `min_partitions` splits large topic partitions
    over more tasks.
    """
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": ",".join(resolve_topics(aliases)),
    }
    if group_id:
        options["kafka.group.id"] = group_id
    if max_records:
        options["maxOffsetsPerTrigger"] = str(max_records)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    if isinstance(starting, int):
        options["startingTimestamp"] = str(starting)
    else:
        options["startingOffsets"] = starting
    return options


def read_topics_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Topic records as they arrive. Needs the Kafka connector on the classpath."""
    return spark.readStream.format("kafka").options(**options).load()


def read_topics(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Topic records up to now, as a table."""
    batch = dict(options)
    batch.pop("maxOffsetsPerTrigger", None)
    if batch.get("startingOffsets") == "latest":
        batch["startingOffsets"] = "earliest"
    return spark.read.format("kafka").options(**batch).load()


def read_topic_files_stream(
    spark: SparkSession, path: str, aliases: Iterable[str] = ("events",), files_per_trigger: int | None = None
) -> DataFrame:
    """Topic records archived as parquet, with the columns of the Kafka source."""
    reader = spark.readStream.schema(schemas.TOPIC_RECORD)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path).filter(F.col("topic").isin(resolve_topics(aliases)))


def parse_json(records: DataFrame, schema: T.StructType) -> DataFrame:
    """Decode topic values. `parsed` is false where the value is no JSON object.

    Numbers may be written as text. `misfits` lists the fields whose value is not of the field's type;
    they are null in the result.

    The record's own `topic`, `partition` and `offset` stay next to the fields; its
    timestamp is called `record_timestamp`. `fields` lists the keys that are present.
    """
    numbers = {f.name: f.dataType for f in schema.fields if isinstance(f.dataType, T.NumericType)}
    as_text = T.StructType([
        T.StructField(f.name, T.StringType() if f.name in numbers else f.dataType) for f in schema.fields
    ])
    text = F.col("value").cast("string")
    fields = F.json_object_keys(text)
    kept = [c for c in records.columns if c in ("topic", "partition", "offset")]
    stamped = [F.col("timestamp").alias("record_timestamp")] if "timestamp" in records.columns else []
    decoded = records.select(
        *kept, *stamped, F.from_json(text, as_text).alias("_event"), fields.alias("fields")
    )

    def typed(f: T.StructField) -> Column:
        value = F.col("_event").getField(f.name)
        if f.name not in numbers:
            return value
        number = parse_double(value) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else parse_long(value)
        return number.try_cast(f.dataType)

    wrong = [
        F.when(F.col("_event").getField(f.name).isNotNull() & typed(f).isNull(), F.lit(f.name))
        for f in schema.fields if f.name in numbers
    ]
    return decoded.select(*kept, *[c for c in decoded.columns if c == "record_timestamp"],
                          F.col("fields").isNotNull().alias("parsed"), "fields", F.array_compact(F.array(*wrong)).alias("misfits"),
                          *[typed(f).alias(f.name) for f in schema.fields])


def to_records(events: DataFrame, topic: str | Column, key: str = "user_id") -> DataFrame:
    """JSON values keyed by the user: what the Kafka sink takes."""
    target = F.lit(topic) if isinstance(topic, str) else topic
    columns = [F.col(name) for name in events.columns]
    return events.select(
        target.alias("topic"),
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("value"),
    )


def sendable(events: DataFrame) -> DataFrame:
    """Events that may be sent: they name a user and a type."""
    return events.filter(F.col("user_id").isNotNull() & F.col("event_type").isNotNull())


def route(events: DataFrame, alias: str = "alias") -> DataFrame:
    """Add the physical topic of each alias; rows with an unknown alias are rejected."""
    return events.withColumn("topic", lookup(F.col(alias), config.TOPICS)).filter(F.col("topic").isNotNull())


def write_records(records: DataFrame, brokers: str) -> None:
    """Publish a batch. Needs the Kafka connector on the classpath."""
    records.write.format("kafka").option("kafka.bootstrap.servers", brokers).save()


def write_records_stream(records: DataFrame, brokers: str, checkpoint: str, trigger: str = "30 seconds"):
    """Publish a stream. Needs the Kafka connector on the classpath."""
    return (
        records.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=trigger)
        .start()
    )


def retained(records: DataFrame, millis: str = "timestamp_ms") -> DataFrame:
    """Records newer than their topic's retention, counted back from its newest record."""
    # One row of cutoffs for the few topics there are, instead of a join on the topic:
    # a topic holds a large share of all rows.
    topic, stamp = F.col("topic"), F.col(millis)
    cutoffs = records.agg(F.struct(*[
        (F.max(F.when(topic == name, stamp)) - keep).alias(name) for name, keep in config.RETENTION_MS.items()
    ]).alias("cutoffs")).scalar()
    cutoff = F
    for name in config.RETENTION_MS:
        cutoff = cutoff.when(topic == name, cutoffs.getField(name))
    return records.filter(~topic.isin(list(config.RETENTION_MS)) | (stamp >= cutoff.otherwise(None)))


def compacted(records: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The newest record of each key."""
    return ordered.latest(records, keys, [F.col(name) for name in order])


def replay_from(records: DataFrame, start_ms: int | None = None, millis: str = "timestamp_ms") -> DataFrame:
    """Records from a point in time on; all of them without one."""
    return records if start_ms is None else records.filter(F.col(millis) >= start_ms)
