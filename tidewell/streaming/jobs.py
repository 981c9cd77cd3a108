"""Streaming jobs: ingestion, deduplication, fraud, recommendations, stock."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell import config, schemas
from tidewell.config import RecommendConfig, StreamConfig
from tidewell.functions import ordered
from tidewell.operators import cache, fraud, recommend, stock, validate, windows
from tidewell.plans import batch as plans
from tidewell.sources import topics
from tidewell.sources.keyed import KeyedTable
from tidewell.storage import scratch, write_once
from tidewell.streaming import sinks


def events_of(records: DataFrame, watermark: str = StreamConfig.watermark) -> DataFrame:
    """Topic records to events with event time. Values that are no JSON object are dropped."""
    parsed = topics.parse_json(records, schemas.EVENT).filter("parsed")
    return windows.event_time(parsed.drop("parsed")).withWatermark("ts", watermark)


def changes_of(records: DataFrame, watermark: str = StreamConfig.watermark) -> DataFrame:
    parsed = topics.parse_json(records, schemas.INVENTORY_CHANGE).filter("parsed")
    named = schemas.inventory_view(parsed.drop("parsed", "fields"))
    return windows.event_time(named).withWatermark("ts", watermark)


def bronze_ingest(records: DataFrame, path: str):
    """Append valid events to the bronze table, by day."""
    valid = validate.validate(events_of(records), "fields").filter("valid")
    return sinks.append_files(
        valid.select(*schemas.EVENT.fieldNames(), F.to_date("ts").alias("event_date")), path, "event_date"
    )


def ingest_all(records: DataFrame, path: str):
    """Append every event that is JSON, valid or not."""
    return sinks.append_files(events_of(records).select(*schemas.EVENT.fieldNames()), path)


def dedup_first(events: DataFrame) -> DataFrame:
    """One row per event id; copies that come within the watermark are dropped."""
    return events.dropDuplicatesWithinWatermark(["event_id"])


def dedup_latest(events: DataFrame, path: str, order: list[str]):
    """Write the newest copy per event and micro-batch; readers take the newest of all."""

    def newest(df: DataFrame, _: int) -> DataFrame:
        return sinks.latest_per_key(df, ["event_id"], order)

    return events.writeStream.foreachBatch(sinks.batches_to(path, newest))


def fraud_scores(events: DataFrame, settings: config.FraudConfig = config.FraudConfig()) -> DataFrame:
    """A score per user and five-minute window, from its amount and its number of events."""
    per_window = windows.tumbling(events)
    score = fraud.rule_score(F.col("amount"), F.col("events").cast("double"), settings)
    scored = per_window.withColumn("fraud_score", score)
    return scored.withColumn("is_fraud", F.col("fraud_score") > settings.threshold)


def fraud_job(events: DataFrame, scores_path: str, cache_path: str, settings: config.FraudConfig = config.FraudConfig()):
    """Scores to a table and to the cache, whose expired entries go when it is merged."""
    table = cache.entry_table(cache_path)

    def write(batch: DataFrame, batch_id: int) -> None:
        sinks.batches_to(scores_path)(batch, batch_id)
        # Read back what was written rather than compute the batch a second time.
        scored = batch.sparkSession.read.schema(batch.schema).parquet(f"{scores_path}/batch_id={batch_id}")
        named = scored.withColumn("event_id", F.concat_ws(":", "user_id", F.unix_millis("window_start")))
        now = scored.agg(F.max("window_end")).first()[0]
        table.write(plans.fraud_entries(named, F.col("window_end")), batch_id, None if now is None else F.lit(now))

    return fraud_scores(events, settings).writeStream.outputMode("append").foreachBatch(write)


def closed_sessions(events: DataFrame) -> DataFrame:
    """Boundaries and length of sessions as they close; the state per session is one row."""
    return events.groupBy(F.session_window("ts", StreamConfig.session_gap), "user_id").agg(
        F.count(F.lit(1)).alias("session_length"),
        F.min("timestamp").alias("first_ms"),
        F.max("timestamp").alias("last_ms"),
    ).select("user_id", "first_ms", "last_ms", "session_length")


def session_events(sessions: DataFrame, bronze_path: str) -> DataFrame:
    """The bronze table's events of each session, with its columns.

    A micro-batch may close as many sessions as there are users: they are sorted and merged with the events, never
    collected by the driver to be broadcast.
    """
    span = sessions.agg(F.min("first_ms").alias("first"), F.max("last_ms").alias("last")).first()
    day = lambda ms: F.to_date(F.timestamp_millis(F.lit(ms)))
    stored = sessions.sparkSession.read.parquet(bronze_path).filter(F.col("event_date").between(day(span.first), day(span.last)))
    # Sessions and events meet by user and hour. A session covers few hours and an hour
    # has few sessions, so no event meets all sessions of a busy user.
    hour = lambda ms: F.floor(F.col(ms) / F.lit(ordered.HOUR_MS))
    hours = sessions.withColumn("_hour", F.explode(F.sequence(hour("first_ms"), hour("last_ms"))))
    placed = stored.select(
        "event_id", "user_id", "item_id", "event_type", "timestamp", hour("timestamp").alias("_hour")
    )
    return placed.join(hours.hint("merge"), ["user_id", "_hour"]).filter(
        F.col("timestamp").between(F.col("first_ms"), F.col("last_ms"))
    )


def incomplete_sessions(sessions: DataFrame, found: DataFrame) -> DataFrame:
    """Sessions of which fewer events were found than they have."""
    counted = found.groupBy("session_id").agg(F.count(F.lit(1)).alias("_n"))
    return sessions.join(counted.hint("merge"), "session_id", "left").filter(
        F.coalesce("_n", F.lit(0)) < F.col("session_length")
    )


def recommendation_job(
    events: DataFrame, bronze_path: str, sims: DataFrame, path: str, settings: RecommendConfig = RecommendConfig()
):
    """Recommendations for each session of valid events that closes.

    Sessions come from the stream, their events from the bronze table that another
    stream fills: no list of events is kept in state. If the table is behind, the
    micro-batch fails and is run again.
    """

    def run(batch: DataFrame, _: int) -> DataFrame:
        named = write_once(batch.withColumn("session_id", F.concat_ws("-", "user_id", "first_ms")), "closed-sessions")
        if named.isEmpty():
            empty = "session_id string, user_id string, item_id string, score double, rank int"
            return batch.sparkSession.createDataFrame([], empty)
        found = write_once(session_events(named, bronze_path), "session-events")
        if not incomplete_sessions(named, found).isEmpty():
            raise RuntimeError("the bronze table is behind the session stream")
        keys = ["session_id", "user_id"]
        listed = recommend.recommend_weighted(found, sims, settings, keys)
        return listed.unionByName(recommend.cold_start(found, settings, keys))

    def write(batch: DataFrame, batch_id: int) -> None:
        with scratch(batch.sparkSession):
            sinks.batches_to(path, run)(batch, batch_id)

    valid = validate.validate(events, "fields").filter("valid")
    return closed_sessions(valid).writeStream.outputMode("append").foreachBatch(write)


def stock_judged(sums: DataFrame) -> DataFrame:
    """Trend, alert and cache key of items, from their sums."""
    judged = stock.full_alerts(stock.project_trend(sums))
    return judged.withColumn("key", cache.forecast_key(F.col("item_id"), F.col("warehouse_id")))


def stock_table(changes: DataFrame, path: str) -> KeyedTable:
    """Where `stock_job` keeps the last judgement of each item."""
    return KeyedTable(path, stock_judged(stock.trend_sums(changes)).schema, ("item_id", "warehouse_id"))


def stock_job(changes: DataFrame, path: str):
    """Trend, alert and cache key of every item that changed.

    The state per item is a handful of sums, and late changes simply add to them.
    """
    table = stock_table(changes, path)
    return stock.trend_sums(changes).writeStream.outputMode("update").foreachBatch(
        lambda batch, batch_id: table.write(stock_judged(batch), batch_id)
    )


def user_activity(events: DataFrame, width: str = StreamConfig.activity_window) -> DataFrame:
    """Event counts per user and day. A day leaves the state when the watermark has passed it, and so does an idle user."""
    kind = F.col("event_type")
    return events.groupBy(F.window("ts", width), "user_id").agg(
        F.count(F.lit(1)).alias("total_interactions"),
        F.count_if(kind == "view").alias("view_count"),
        F.count_if(kind == "addtocart").alias("cart_count"),
        F.count_if(kind == "transaction").alias("purchase_count"),
        F.max("timestamp").alias("last_activity"),
    ).select("user_id", F.col("window.start").alias("day"), *ACTIVITY)


ACTIVITY = ["total_interactions", "view_count", "cart_count", "purchase_count", "last_activity"]


def activity_table(events: DataFrame, path: str) -> KeyedTable:
    """Where `activity_job` keeps the days of each user."""
    return KeyedTable(path, user_activity(events).schema, ("user_id", "day"))


def activity_job(events: DataFrame, path: str):
    """Keep the latest counts of each user's days."""
    table = activity_table(events, path)
    return user_activity(events).writeStream.outputMode("update").foreachBatch(table.write)


def activity_totals(days: DataFrame) -> DataFrame:
    """Counts per user over all days."""
    sums = [F.sum(name).alias(name) for name in ACTIVITY if name != "last_activity"]
    return days.groupBy("user_id").agg(*sums, F.max("last_activity").alias("last_activity"))


def late_job(events: DataFrame, path: str, width: str = StreamConfig.tumbling, delay: str = StreamConfig.watermark):
    """Keep the events that come when their window is over, each once, in `path`/rows.

    The instant up to which windows are over is that of the stream's watermark: the latest event of all micro-batches
    before, less the delay. Each micro-batch notes its latest event, one row, in `path`/seen.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = sinks.read_batches(spark, f"{path}/seen", SEEN).filter(F.col("batch_id") < batch_id)
        passed = before.agg((F.max("seen") - F.expr(f"INTERVAL {delay}")).alias("at")).first()["at"]
        over = F.lit(False) if passed is None else F.window("ts", width)["end"] <= F.lit(passed)
        timed = batch.filter(F.col("ts").isNotNull()).withColumn("_late", over)
        timed.filter("_late").drop("_late").write.mode("overwrite").parquet(f"{path}/rows/batch_id={batch_id}")
        batch.agg(F.max("ts").alias("seen")).write.mode("overwrite").parquet(f"{path}/seen/batch_id={batch_id}")

    return events.writeStream.foreachBatch(write)


SEEN = T.StructType([T.StructField("seen", T.TimestampType())])
