"""Sources, sinks, projections and validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell import config, schemas
from tidewell.catalogue.registry import query, rnd
from tidewell.catalogue.tables import Tables
from tidewell.functions.scalars import implicit_rating, interaction_weight, round_to
from tidewell.operators import fraud, metrics, validate
from tidewell.plans import batch
from tidewell.sources import clickstream, tables as table_io, topics
from tidewell.storage import new_path

EVENT_COLUMNS = ["event_id", "event_type", "timestamp", "user_id", "item_id", "price", "quantity"]
EVENT_SQL = 'SELECT event_id, event_type, "timestamp", user_id, item_id, price, quantity FROM ix_events'


def broken_records(t: Tables):
    """Topic records of the events; the values of error events are cut off."""
    records = t.event_records()
    text = F.col("value").cast("string")
    broken = F.get_json_object(text, "$.event_type") == "error"
    return records.withColumn("value", F.when(broken, F.expr("left(cast(value as string), 20)").cast("binary"))
                              .otherwise(F.col("value")))


@query("parse_json_events", """
SELECT event_id, event_type, "timestamp", user_id, item_id, price, quantity FROM ix_events WHERE event_type <> 'error'
""")
def _(t: Tables):
    return topics.parse_json(broken_records(t), schemas.EVENT).filter("parsed").select(*EVENT_COLUMNS)


@query("consumer_stats", """
SELECT 'raw-events' AS topic, count(*) FILTER (WHERE event_type IN ('view', 'addtocart')
                              OR (event_type = 'transaction' AND price IS NOT NULL)) AS consumed,
       count(*) FILTER (WHERE event_type IN ('search', 'error')) AS invalid
FROM ix_events
""")
def _(t: Tables):
    checked = validate.validate(topics.parse_json(broken_records(t), schemas.EVENT), "fields")
    per_partition = validate.consumer_stats(checked)
    # Partitions are assigned by Spark's hash, so the compared result adds them up.
    return per_partition.groupBy("topic").agg(F.sum("consumed").alias("consumed"), F.sum("invalid").alias("invalid"))


@query("src_avro_event", """
SELECT event_id, event_type, "timestamp", user_id, NULL::VARCHAR AS session_id, item_id, category, price, quantity,
       NULL::VARCHAR AS search_query, NULL::VARCHAR AS filter_type, NULL::VARCHAR AS filter_value,
       CAST(NULL AS DOUBLE) AS rating, NULL::VARCHAR AS review_text, NULL::VARCHAR AS device_type,
       NULL::VARCHAR AS ip_address, NULL::VARCHAR AS user_agent, NULL::VARCHAR AS transaction_id, item_id AS metadata_k
FROM ix_events
""")
def _(t: Tables):
    tagged = t.events.withColumn("metadata", F.create_map(F.lit("k"), F.col("item_id")))
    shaped = schemas.conform(tagged, schemas.EVENT)
    return shaped.withColumn("metadata_k", F.col("metadata")["k"]).withColumn(
        "rating", F.col("rating").cast("double")
    ).drop("metadata")


@query("src_avro_inventory", """
SELECT change_id, "timestamp", item_id, warehouse_id, change_type, quantity_before, quantity_change, quantity_after,
       NULL::VARCHAR AS reason, NULL::VARCHAR AS reference_id, NULL::VARCHAR AS category,
       CAST(NULL AS DOUBLE) AS unit_cost, NULL::VARCHAR AS location, NULL::VARCHAR AS operator_id
FROM stock
""")
def _(t: Tables):
    return schemas.conform(t.stock, schemas.INVENTORY_CHANGE).drop("metadata")


def csv_copy(t: Tables) -> str:
    path = new_path(t.spark, "clicks-csv")
    t.clicks.write.option("header", True).csv(path)
    return path


@query("scan_clickstream_csv", "SELECT * FROM clicks")
def _(t: Tables):
    return clickstream.scan_csv(t.spark, csv_copy(t))


NORMAL = 'event_id, event_type, "timestamp", user_id, item_id, transaction_id, price, CAST(quantity AS DOUBLE) AS quantity'


def as_double(df):
    return df.withColumn("quantity", F.col("quantity").cast("double"))


@query("scan_limit_raw", f"""
SELECT {NORMAL} FROM (SELECT * FROM normalized ORDER BY "Timestamp", "VisitorID", "ItemID", "Event" LIMIT 1000)
WHERE valid
""")
def _(t: Tables):
    return as_double(clickstream.load(t.clicks, max_raw=1000, order=["Timestamp", "VisitorID", "ItemID", "Event"]))


@query("scan_limit_valid", f"""
SELECT {NORMAL} FROM normalized WHERE valid ORDER BY "timestamp", user_id, item_id, event_type LIMIT 1000
""")
def _(t: Tables):
    return as_double(
        clickstream.load(t.clicks, max_valid=1000, order=["timestamp", "user_id", "item_id", "event_type"])
    )


@query("norm_retail_rocket", f"SELECT {NORMAL} FROM normalized WHERE valid")
def _(t: Tables):
    return as_double(clickstream.load(t.clicks))


@query("norm_retail_rocket_raw", """
SELECT event_id, event_type, "timestamp" // 1000 AS "timestamp", user_id, item_id, transaction_id
FROM normalized WHERE valid
""")
def _(t: Tables):
    lower = t.clicks.toDF(*[name.lower() for name in t.clicks.columns])
    return clickstream.load(lower, clickstream.normalize_raw)


@query("loader_stats", """
SELECT count(*) FILTER (WHERE valid) AS events, count(*) FILTER (WHERE NOT valid) AS errors, count(*) AS total
FROM normalized
""")
def _(t: Tables):
    return clickstream.load_stats(clickstream.normalize(t.clicks))


@query("orders_to_events", f"""
SELECT event_id, event_type, "timestamp", user_id, item_id, transaction_id, {rnd('price')} AS price, quantity
FROM order_events
""")
def _(t: Tables):
    return t.order_events.withColumn("price", round_to(F.col("price"), 6))


@query("src_dbt_tables", """
SELECT 'events' AS source, count(*) AS n, min(epoch_us("timestamp") // 1000) AS first_ms FROM raw_events
UNION ALL SELECT 'fraud_scores', count(*), min(epoch_us("timestamp") // 1000) FROM fraud_scores
UNION ALL SELECT 'inventory', count(*), min("timestamp") FROM stock
""")
def _(t: Tables):
    inventory = t.stock.withColumn("timestamp", F.timestamp_millis("timestamp"))
    sources = {"events": t.raw_events, "fraud_scores": t.fraud_scores, "inventory": inventory}
    counts = []
    for name, df in sources.items():
        df.createOrReplaceTempView(f"kafka_{name}")
        table = table_io.read_table(t.spark, f"kafka_{name}")
        counts.append(table.agg(
            F.lit(name).alias("source"), F.count(F.lit(1)).alias("n"), F.unix_millis(F.min("timestamp")).alias("first_ms")
        ))
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query("sink_kafka_keyed", """
SELECT 'raw-events' AS topic, user_id AS key, event_id, "timestamp" FROM ix_events
""")
def _(t: Tables):
    records = topics.to_records(topics.sendable(t.events), config.TOPICS["events"])
    return records.select(
        "topic", "key", F.get_json_object("value", "$.event_id").alias("event_id"),
        F.get_json_object("value", "$.timestamp").cast("bigint").alias("timestamp"),
    )


def aliased(t: Tables):
    kind = F.col("event_type")
    alias = F.when(kind == "error", "unknown").when(kind == "transaction", "fraud_scores").when(
        kind == "search", "recommendations").when(kind == "addtocart", "inventory").otherwise("events")
    return t.events.withColumn("alias", alias)


ROUTED = """CASE event_type WHEN 'transaction' THEN 'fraud-scores' WHEN 'search' THEN 'recommendations'
            WHEN 'addtocart' THEN 'inventory-changes' ELSE 'raw-events' END"""


@query("route_topic", f"SELECT event_id, {ROUTED} AS topic FROM ix_events WHERE event_type <> 'error'")
def _(t: Tables):
    return topics.route(aliased(t)).select("event_id", "topic")


@query("replay_csv_to_topic", """
SELECT 'raw-events' AS topic, user_id AS key, event_id, item_id FROM normalized WHERE valid
""")
def _(t: Tables):
    events = clickstream.load(clickstream.scan_csv(t.spark, csv_copy(t)))
    return topics.to_records(topics.sendable(events), config.TOPICS["events"]).select(
        "topic", "key", F.get_json_object("value", "$.event_id").alias("event_id"),
        F.get_json_object("value", "$.item_id").alias("item_id"),
    )


@query("topic_retention", f"""
WITH r AS (SELECT event_id, {ROUTED} AS topic, "timestamp" AS ms FROM ix_events WHERE event_type <> 'error')
SELECT event_id, topic FROM r JOIN (SELECT topic, max(ms) AS newest FROM r GROUP BY 1) m USING (topic)
WHERE ms >= newest - CASE topic WHEN 'recommendations' THEN 86400000 WHEN 'inventory-changes' THEN 2592000000
                     ELSE 604800000 END
""")
def _(t: Tables):
    return topics.retained(topics.route(aliased(t)), "timestamp").select("event_id", "topic")


@query("topic_compact", """
SELECT user_id AS key, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY "timestamp" DESC, event_id DESC) AS rn FROM ix_events)
WHERE rn = 1
""")
def _(t: Tables):
    return topics.compacted(t.events, ["user_id"], ["timestamp", "event_id"]).select(
        F.col("user_id").alias("key"), "event_id"
    )


@query("replay_from", """
SELECT event_id, "timestamp" FROM ix_events WHERE "timestamp" >= 1705276800000
""")
def _(t: Tables):
    return topics.replay_from(t.events, 1705276800000, "timestamp").select("event_id", "timestamp")


VALID = "(event_type IN ('view', 'addtocart') OR (event_type = 'transaction' AND price IS NOT NULL))"
SEARCHABLE = """(SELECT *, CASE WHEN item_id <> '0' AND event_type = 'search' THEN 'q' || item_id END AS search_query
                 FROM ix_events)"""


def with_queries(t: Tables):
    """Search events get a query text, unless their item is 0."""
    text = F.when((F.col("item_id") != "0") & (F.col("event_type") == "search"), F.concat(F.lit("q"), "item_id"))
    return schemas.conform(t.events.withColumn("search_query", text), schemas.EVENT)


@query("validate_required", f"""
SELECT event_id, {VALID} OR (event_type = 'search' AND search_query IS NOT NULL) AS valid FROM {SEARCHABLE}
""")
def _(t: Tables):
    return validate.validate(with_queries(t)).select("event_id", "valid")


@query("route_valid_invalid", f"""
SELECT event_id, CASE WHEN {VALID} OR (event_type = 'search' AND search_query IS NOT NULL) THEN 'accepted'
                 ELSE 'dead_letter' END AS output
FROM {SEARCHABLE}
""")
def _(t: Tables):
    accepted, dead = validate.route_valid_invalid(with_queries(t))
    return accepted.select("event_id", F.lit("accepted").alias("output")).unionByName(
        dead.select("event_id", F.lit("dead_letter").alias("output"))
    )


@query("send_guard", "SELECT event_id, user_id FROM ix_events WHERE event_type NOT IN ('error', 'search')")
def _(t: Tables):
    kind = F.col("event_type")
    gaps = t.events.withColumns({
        "user_id": F.when(kind != "error", F.col("user_id")), "event_type": F.when(kind != "search", kind),
    })
    return topics.sendable(gaps).select("event_id", "user_id")


@query("fraud_basic_features", """
SELECT event_id, coalesce(user_id, 'unknown') AS user_id, coalesce(event_type, 'unknown') AS event_type,
       coalesce("timestamp", 0) AS "timestamp", coalesce(price, 0.0) AS amount,
       CASE WHEN category = 'c9' THEN 1 ELSE quantity END AS quantity
FROM ix_events WHERE event_type <> 'error' AND category <> 'c8'
""")
def _(t: Tables):
    # As the values come in JSON: text, some of it no number.
    price = F.when(F.col("event_type") == "error", "none").otherwise(F.col("price").cast("string"))
    quantity = F.when(F.col("category") == "c8", "2.5").when(F.col("category") != "c9", F.col("quantity").cast("string"))
    return fraud.basic_features(t.events.withColumns({"price": price, "quantity": quantity}))


@query("normalize_clamp", """
SELECT event_id, user_id, least(1.0, greatest(0.0, amount))::DOUBLE AS amount,
       least(1.0, greatest(0.0, velocity::DOUBLE))::DOUBLE AS velocity,
       least(1.0, greatest(0.0, fraud_score - 0.5::DOUBLE))::DOUBLE AS score, is_fraud::INTEGER::DOUBLE AS is_fraud
FROM fraud_scores
""")
def _(t: Tables):
    return fraud.normalize(t.fraud_scores.select(
        "event_id", "user_id", "amount", "velocity", (F.col("fraud_score") - 0.5).alias("score"), "is_fraud"
    ))


@query("interaction_weight", """
SELECT event_id, CASE event_type WHEN 'transaction' THEN 1.0 WHEN 'addtocart' THEN 0.7 WHEN 'view' THEN 0.3
       WHEN 'search' THEN 0.2 ELSE 0.1 END::DOUBLE AS weight FROM ix_events
""")
def _(t: Tables):
    return t.events.select("event_id", interaction_weight(F.upper("event_type")).alias("weight"))


@query("implicit_rating", """
SELECT event_id, CASE event_type WHEN 'transaction' THEN 5.0 WHEN 'addtocart' THEN 3.0 WHEN 'view' THEN 1.0
       WHEN 'search' THEN 0.5 ELSE 1.0 END::DOUBLE AS rating FROM ix_events
""")
def _(t: Tables):
    return t.events.select("event_id", implicit_rating(F.upper("event_type")).alias("rating"))


@query("ingest_metrics", """
WITH s AS (SELECT "timestamp" // 1000 AS second, count(*) FILTER (WHERE event_type <> 'error') AS sent,
                  count(*) FILTER (WHERE event_type = 'error') AS failed, count(*) AS n
           FROM ix_events GROUP BY 1)
SELECT 'raw-events' AS topic, sum(sent)::BIGINT AS sent, sum(failed)::BIGINT AS failed, sum(n)::BIGINT AS topic_size,
       max(n) AS peak_per_second,
       floor(sum(n)::DOUBLE / (max(second) - min(second) + 1) * 1e6 + 0.5) / 1e6 AS events_per_second
FROM s
""")
def _(t: Tables):
    records = t.events.select(
        F.lit("raw-events").alias("topic"), F.col("timestamp").alias("timestamp_ms"),
        (F.col("event_type") != "error").alias("valid"),
    )
    return metrics.ingest_metrics(records).withColumn("events_per_second", round_to(F.col("events_per_second"), 6))


@query("ingest_rate", """
SELECT 'raw-events' AS topic, "timestamp" // 1000 AS second, count(*) FILTER (WHERE event_type <> 'error') AS sent,
       count(*) FILTER (WHERE event_type = 'error') AS failed
FROM ix_events GROUP BY 2
""")
def _(t: Tables):
    records = t.events.select(
        F.lit("raw-events").alias("topic"), F.col("timestamp").alias("timestamp_ms"),
        (F.col("event_type") != "error").alias("valid"),
    )
    return metrics.ingest_rate(records)


BUSINESS_SQL = """
SELECT strftime(make_timestamp("timestamp" * 1000), '%Y-%m-%d') AS metric_date,
       floor(sum(CASE WHEN event_type = 'transaction' THEN price * quantity ELSE 0 END)::DOUBLE * 1e2 + 0.5) / 1e2 AS revenue,
       count(*) FILTER (WHERE event_type = 'transaction') AS orders, count(*) FILTER (WHERE event_type = 'view') AS views,
       CASE WHEN count(*) FILTER (WHERE event_type = 'view') = 0 THEN 0.0
            ELSE floor(count(*) FILTER (WHERE event_type = 'transaction')::DOUBLE
                       / count(*) FILTER (WHERE event_type = 'view') * 1e4 + 0.5) / 1e4 END::DOUBLE AS conversion_rate
FROM ix_events GROUP BY 1
"""


@query("business_metrics", BUSINESS_SQL)
def _(t: Tables):
    return metrics.business_metrics(t.events)


@query("sink_fraud_scores", """
SELECT 'fraud-scores' AS topic, event_id AS key, 'fraud:score:' || event_id AS cache_key,
       epoch_us("timestamp") // 1000 + 86400000 AS expires_ms
FROM fraud_scores
""")
def _(t: Tables):
    scored = t.fraud_scores.select("event_id", "user_id", "fraud_score", "is_fraud", "timestamp")
    entries = batch.fraud_entries(scored, F.col("timestamp"))
    records = topics.to_records(scored, config.TOPICS["fraud_scores"], key="event_id")
    keyed = records.withColumn("cache_key", F.concat(F.lit("fraud:score:"), "key"))
    return keyed.join(entries, keyed.cache_key == entries.key).select(
        "topic", keyed.key, "cache_key", F.unix_millis("expires_at").alias("expires_ms")
    )


