"""Streaming jobs over topic records that are archived as files.

Each query writes its records to the shared folder, runs the stream over them to the
end, and reads what the stream wrote. One record a month after all others closes the
last windows; it belongs to nobody and is in no result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell import config, schemas
from tidewell.catalogue.events import BUSINESS_SQL
from tidewell.catalogue.features import SESSION_SQL, TUMBLING
from tidewell.catalogue.inventory import ITEM
from tidewell.catalogue.recommendations import WEIGHT, fixed_sql
from tidewell.catalogue.registry import query, rnd
from tidewell.catalogue.tables import Tables
from tidewell.functions import ordered
from tidewell.functions.scalars import round_to
from tidewell.operators import cache, metrics, similarity, windows
from tidewell.sources import topics
from tidewell.storage import new_path, write_once
from tidewell.streaming import jobs, sinks

MONTH_MS = 31 * 86400000
CLOSER = "-closing-"


def closing_event(events: DataFrame) -> DataFrame:
    last = events.agg((F.max("timestamp") + MONTH_MS).alias("timestamp"))
    row = last.select(
        F.lit(CLOSER).alias("event_id"), F.lit("view").alias("event_type"), "timestamp", F.lit(CLOSER).alias("user_id"),
        F.lit(CLOSER).alias("item_id"),
    )
    return events.unionByName(row, allowMissingColumns=True)


def archived(t: Tables, records: DataFrame, name: str, aliases=("events",)) -> DataFrame:
    """Records written to files, and read as a stream."""
    path = new_path(t.spark, name)
    records.write.parquet(path)
    return topics.read_topic_files_stream(t.spark, path, aliases)


def event_stream(t: Tables, name: str) -> DataFrame:
    records = t._records(closing_event(t.events), "raw-events", F.col("user_id"))
    return jobs.events_of(archived(t, records, name))


def run_to_files(t: Tables, stream: DataFrame, name: str) -> DataFrame:
    """Run an append stream to its end and read its output."""
    path, schema = new_path(t.spark, name), stream.schema
    sinks.start(sinks.append_files(stream, path), new_path(t.spark, f"{name}-checkpoint"), available_now=True)
    return t.spark.read.schema(schema).parquet(path)


def run_batches(t: Tables, writer, name: str) -> None:
    sinks.start(writer, new_path(t.spark, f"{name}-checkpoint"), available_now=True)


EVENT_COLUMNS = ["event_id", "event_type", "timestamp", "user_id", "item_id", "price", "quantity"]


@query("src_kafka_events", """
SELECT event_id, event_type, "timestamp", user_id, item_id, price, quantity FROM ix_events
""")
def _(t: Tables):
    stream = jobs.events_of(archived(t, t.event_records(), "raw-events"))
    return run_to_files(t, stream.select(*EVENT_COLUMNS), "events")


@query("src_kafka_inventory", f"""
SELECT change_id, {ITEM}, "timestamp", quantity_change, current_stock FROM stock
""")
def _(t: Tables):
    stream = jobs.changes_of(archived(t, t.stock_records(), "inventory-changes", ("inventory",)))
    columns = ["change_id", "item_id", "warehouse_id", "timestamp", "quantity_change", "current_stock"]
    return run_to_files(t, stream.select(*columns), "changes")


@query("bronze_ingest", """
SELECT event_id, event_type, "timestamp", user_id, item_id, price, quantity,
       strftime(make_timestamp("timestamp" * 1000), '%Y-%m-%d') AS event_date
FROM ix_events WHERE event_type IN ('view', 'addtocart', 'transaction')
""")
def _(t: Tables):
    path = new_path(t.spark, "bronze")
    run_batches(t, jobs.bronze_ingest(archived(t, t.event_records(), "raw-events"), path), "bronze")
    return t.spark.read.parquet(path).select(*EVENT_COLUMNS, "event_date")


def raw_event_records(t: Tables) -> DataFrame:
    """Raw deliveries as records, second copies among them."""
    raw = t.raw_events.select(
        "event_id", "user_id", "event_type", F.unix_millis("timestamp").alias("timestamp"),
        F.col("event_data").cast("double").alias("price"), F.unix_millis("ingestion_timestamp").alias("quantity"),
    )
    shaped = raw.withColumn("transaction_id", F.col("quantity").cast("string")).drop("quantity")
    return t._records(shaped, "raw-events", F.col("event_id"))


@query("stream_dedup", "SELECT event_id, user_id, event_type FROM events_clean")
def _(t: Tables):
    stream = jobs.events_of(archived(t, raw_event_records(t), "deliveries"))
    first = jobs.dedup_first(stream).select("event_id", "user_id", "event_type")
    return run_to_files(t, first, "dedup")


@query("stream_dedup_latest", "SELECT event_id, user_id, event_type, event_value AS price FROM events_clean")
def _(t: Tables):
    # The ingestion time travels as transaction_id, in digits of equal length.
    columns = ["event_id", "user_id", "event_type", "price", "transaction_id"]
    stream = jobs.events_of(archived(t, raw_event_records(t), "deliveries")).select(*columns)
    path = new_path(t.spark, "dedup-latest")
    run_batches(t, jobs.dedup_latest(stream, path, ["transaction_id"]), "dedup-latest")
    table = sinks.read_batches(t.spark, path, stream.schema)
    return sinks.latest_per_key(table, ["event_id"], ["transaction_id"]).drop("transaction_id", "batch_id")


@query("win_tumbling_5m_stream", TUMBLING)
def _(t: Tables):
    out = run_to_files(t, windows.tumbling(event_stream(t, "raw-events")), "tumbling")
    return out.filter(F.col("user_id") != CLOSER).withColumn("amount", round_to(F.col("amount"), 4))


@query("win_session_30m_stream", SESSION_SQL)
def _(t: Tables):
    out = run_to_files(t, windows.stream_sessions(event_stream(t, "raw-events")), "sessions")
    return out.filter(F.col("user_id") != CLOSER)


@query("win_sliding_24h_stream", """
SELECT item_id, user_id AS warehouse_id, start_ms AS window_start, start_ms + 86400000 AS window_end, count(*) AS changes,
       sum(quantity)::BIGINT AS net_change, min(price) AS min_stock, max(price) AS max_stock
FROM (SELECT *, unnest(generate_series("timestamp" // 3600000 * 3600000 - 82800000,
                                       "timestamp" // 3600000 * 3600000, 3600000)) AS start_ms
      FROM ix_events WHERE price IS NOT NULL)
GROUP BY 1, 2, 3
""")
def _(t: Tables):
    # Cart and purchase events as changes of a stock: quantity as change, price as level.
    changes = event_stream(t, "raw-events").filter(F.col("price").isNotNull() | (F.col("user_id") == CLOSER)).select(
        "item_id", F.col("user_id").alias("warehouse_id"), "ts", F.col("quantity").alias("quantity_change"),
        F.col("price").alias("current_stock"),
    )
    # The stream keeps hours; of these the windows are made where they are read.
    panes = run_to_files(t, windows.stream_panes(changes), "panes").filter(F.col("warehouse_id") != CLOSER)
    return windows.sliding_over(panes)


@query("late_data", TUMBLING)
def _(t: Tables):
    # Everything once, then the error events again: by then the watermark has passed them.
    path = new_path(t.spark, "late")
    t._records(closing_event(t.events), "raw-events", F.col("user_id")).write.parquet(path)
    out, checkpoint = new_path(t.spark, "late-windows"), new_path(t.spark, "late-checkpoint")

    def run() -> DataFrame:
        stream = jobs.events_of(topics.read_topic_files_stream(t.spark, path))
        result = windows.tumbling(stream)
        sinks.start(sinks.append_files(result, out), checkpoint, available_now=True)
        return t.spark.read.schema(result.schema).parquet(out)

    run()
    late = t.events.filter("event_type = 'error'")
    t._records(late, "raw-events", F.col("user_id")).write.mode("append").parquet(path)
    return run().filter(F.col("user_id") != CLOSER).withColumn("amount", round_to(F.col("amount"), 4))


@query("late_rows", """
SELECT event_id, user_id, "timestamp", count(*) OVER () AS late FROM ix_events WHERE event_type = 'error'
""")
def _(t: Tables):
    # As for late_data; here the events that come when their windows are over are the result.
    path, out, checkpoint = (new_path(t.spark, name) for name in ("late", "late-rows", "late-checkpoint"))
    t._records(closing_event(t.events), "raw-events", F.col("user_id")).write.parquet(path)
    stream = jobs.events_of(topics.read_topic_files_stream(t.spark, path)).select("event_id", "user_id", "timestamp", "ts")
    sinks.start(jobs.late_job(stream, out), checkpoint, available_now=True)
    late = t.events.filter("event_type = 'error'")
    t._records(late, "raw-events", F.col("user_id")).write.mode("append").parquet(path)
    sinks.start(jobs.late_job(stream, out), checkpoint, available_now=True)
    rows = sinks.read_batches(t.spark, f"{out}/rows", stream.schema)
    count = rows.agg(F.count(F.lit(1)).alias("late"))  # one row
    return rows.crossJoin(F.broadcast(count)).select("event_id", "user_id", "timestamp", "late")


@query("consumer_lag", """
WITH m AS (SELECT quantile_disc("timestamp", 0.5) AS middle FROM ix_events)
SELECT 'raw-events' AS topic, count(*) AS offered, count(*) FILTER (WHERE "timestamp" < middle) AS processed,
       count(*) FILTER (WHERE "timestamp" >= middle) AS lag, count(*) FILTER (WHERE "timestamp" >= middle) > 10000 AS alarm
FROM ix_events, m
""")
def _(t: Tables):
    # The stream is stopped when the first half of the records is processed; the second half came meanwhile.
    records = ordered.scan(
        t._records(t.events, "raw-events", F.col("user_id")).drop("offset"), ["topic", "partition"], ["timestamp", "key", "value"],
        index="offset",
    )
    middle = t.events.agg(F.expr("CAST(percentile_disc(0.5) WITHIN GROUP (ORDER BY timestamp) AS BIGINT)")).scalar()
    early = F.col("timestamp") < F.timestamp_millis(middle)
    path, done = new_path(t.spark, "topic"), new_path(t.spark, "consumed")
    offered = write_once(schemas.conform(records, schemas.TOPIC_RECORD), "offered")
    offered.filter(early).write.parquet(path)
    stream = topics.read_topic_files_stream(t.spark, path).select("topic", "partition", "offset")
    sinks.start(sinks.append_files(stream, done), new_path(t.spark, "consumed-checkpoint"), available_now=True)
    offered.filter(~early).write.mode("append").parquet(path)
    return metrics.consumer_lag(
        t.spark.read.schema(schemas.TOPIC_RECORD).parquet(path), t.spark.read.schema(stream.schema).parquet(done)
    )


@query("stream_fraud", f"""
WITH w AS ({TUMBLING}), s AS (
  SELECT *, 0.4::DOUBLE * amount / 5000.0::DOUBLE
            + 0.6::DOUBLE * events::DOUBLE / 50.0::DOUBLE AS fraud_score FROM w)
SELECT user_id, window_start, events, amount, {rnd('fraud_score')} AS fraud_score, fraud_score > 0.05::DOUBLE AS is_fraud,
       'fraud:score:' || user_id || ':' || CAST(window_start AS VARCHAR) AS key, window_end + 86400000 AS expires_ms
FROM s
""")
def _(t: Tables):
    # A low threshold: single purchases of the given tables are small.
    settings = config.FraudConfig(threshold=0.05)
    scores, entries = new_path(t.spark, "fraud-scores"), new_path(t.spark, "fraud-cache")
    stream = event_stream(t, "raw-events")
    shape = jobs.fraud_scores(stream, settings).schema
    run_batches(t, jobs.fraud_job(stream, scores, entries, settings), "fraud")
    scored = sinks.read_batches(t.spark, scores, shape).filter(F.col("user_id") != CLOSER)
    cached = cache.entry_table(entries).read(t.spark)
    keyed = scored.withColumn("key", F.concat_ws(":", F.lit("fraud:score"), "user_id", F.unix_millis("window_start")))
    return keyed.join(cached, "key").select(
        "user_id", "window_start", "events", round_to(F.col("amount"), 4).alias("amount"),
        round_to(F.col("fraud_score"), 6).alias("fraud_score"), "is_fraud", "key",
        F.unix_millis("expires_at").alias("expires_ms"),
    )


@query("stream_sessions_to_recos", f"""
WITH e AS (SELECT * FROM ix_events WHERE event_type IN ('view', 'addtocart', 'transaction')),
  s AS (SELECT *, user_id || '-' || CAST(max(CASE WHEN opens THEN "timestamp" END) OVER
               (PARTITION BY user_id ORDER BY "timestamp" ROWS UNBOUNDED PRECEDING) AS VARCHAR) AS session_id
        FROM (SELECT *, coalesce("timestamp" - lag("timestamp") OVER (PARTITION BY user_id ORDER BY "timestamp")
                                 > 1800000, true) AS opens FROM e)),
  sizes AS (SELECT session_id, user_id, count(*) AS n FROM s GROUP BY 1, 2),
  hist AS (SELECT session_id, user_id, item_id, {fixed_sql(WEIGHT)} AS weight
           FROM s JOIN sizes USING (session_id, user_id) WHERE n >= 3 GROUP BY ALL),
  scored AS (SELECT session_id, user_id, similar_item AS item_id,
                    {fixed_sql('weight * sim')} AS score
             FROM hist JOIN sims USING (item_id) GROUP BY ALL),
  fresh AS (SELECT * FROM scored WHERE (session_id, item_id) NOT IN (SELECT (session_id, item_id) FROM hist)),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY score DESC, item_id) AS rank FROM fresh)
SELECT session_id, user_id, item_id, {rnd('score', 4)} AS score, rank FROM ranked WHERE rank <= 10
UNION ALL
SELECT session_id, user_id, 'popular_' || CAST(i AS VARCHAR), {rnd('1 - i * CAST(0.1 AS DOUBLE)', 4)}, i + 1
FROM sizes, range(5) r(i) WHERE n < 3
""")
def _(t: Tables):
    sims = write_once(similarity.similarities(similarity.item_vectors(t.events)), "item-similarities")
    path = new_path(t.spark, "raw-events")
    t._records(closing_event(t.events), "raw-events", F.col("user_id")).write.parquet(path)
    records = lambda: topics.read_topic_files_stream(t.spark, path)
    bronze, out = new_path(t.spark, "bronze"), new_path(t.spark, "recommendations")
    run_batches(t, jobs.bronze_ingest(records(), bronze), "bronze")
    run_batches(t, jobs.recommendation_job(jobs.events_of(records()), bronze, sims, out), "recommendations")
    listed = t.spark.read.schema("session_id string, user_id string, item_id string, score double, rank int").parquet(
        f"{out}/batch_id=*"
    )
    return listed.filter(F.col("user_id") != CLOSER).withColumn("score", round_to(F.col("score"), 4))


@query("stream_inventory_forecast", f"""
WITH sums AS (SELECT {ITEM}, count(*) AS n, sum("timestamp" // 86400000)::DOUBLE AS x,
       sum(("timestamp" // 86400000) * ("timestamp" // 86400000))::DOUBLE AS xx, sum(current_stock) AS y,
       sum(("timestamp" // 86400000)::DOUBLE * current_stock) AS xy,
       max(current_stock) FILTER (WHERE age = 1) AS current_stock FROM points GROUP BY 1, 2),
  fit AS (SELECT *, coalesce((n::DOUBLE * xy - x * y) / nullif(n::DOUBLE * xx - x * x, 0), 0) AS slope FROM sums),
  ends AS (SELECT {ITEM}, min(d - 1) AS runout_days FROM fit, range(1, 8) r(d)
           WHERE n >= 10 AND current_stock + slope * d <= 0 GROUP BY 1, 2)
SELECT fit.item_id, fit.warehouse_id, 'inventory:forecast:' || fit.item_id || ':' || fit.warehouse_id AS key, n,
       current_stock, {rnd('current_stock + slope * 7', 4)} AS level_in_7_days,
       current_stock < 100 OR coalesce(runout_days < 7, false) AS alert
FROM fit LEFT JOIN ends USING ({ITEM})
""")
def _(t: Tables):
    stream = jobs.changes_of(archived(t, t.stock_records(), "inventory-changes", ("inventory",)))
    path = new_path(t.spark, "stock-forecasts")
    run_batches(t, jobs.stock_job(stream, path), "stock-forecasts")
    # Series too short for a forecast are on the line as well; their list of levels is empty.
    ahead = F.col("current_stock") + F.coalesce("slope", F.lit(0.0)) * config.ForecastConfig.periods
    return jobs.stock_table(stream, path).read(t.spark).select(
        "item_id", "warehouse_id", "key", "n", "current_stock", round_to(ahead, 4).alias("level_in_7_days"), "alert",
    )


@query("stream_state", """
SELECT user_id, count(*) AS total_interactions, count(*) FILTER (WHERE event_type = 'view') AS view_count,
       count(*) FILTER (WHERE event_type = 'addtocart') AS cart_count,
       count(*) FILTER (WHERE event_type = 'transaction') AS purchase_count, max("timestamp") AS last_activity
FROM ix_events GROUP BY 1
""")
def _(t: Tables):
    stream = event_stream(t, "raw-events")
    path = new_path(t.spark, "activity")
    run_batches(t, jobs.activity_job(stream, path), "activity")
    return jobs.activity_totals(jobs.activity_table(stream, path).read(t.spark)).filter(F.col("user_id") != CLOSER)


@query("unified_query", BUSINESS_SQL)
def _(t: Tables):
    # Half of the time is history, half came by stream; one function reads both. The middle is found once: an
    # approximate percentile may come out differently the next time, and rows between both would be lost or count twice.
    middle = t.events.agg(F.percentile_approx("timestamp", 0.5)).first()[0]
    is_old = F.coalesce(F.col("timestamp") < F.lit(middle), F.lit(True))  # without time: history
    old, new = t.events.filter(is_old), t.events.filter(~is_old)
    path = new_path(t.spark, "all-events")
    schemas.conform(old, schemas.EVENT).write.parquet(path)
    stream = archived(t, t._records(new, "raw-events", F.col("user_id")), "raw-events")
    landed = new_path(t.spark, "streamed-events")
    run_batches(t, jobs.ingest_all(stream, landed), "unified")
    both = t.spark.read.schema(schemas.EVENT).parquet(path).unionByName(t.spark.read.schema(schemas.EVENT).parquet(landed))
    return metrics.business_metrics(both)
