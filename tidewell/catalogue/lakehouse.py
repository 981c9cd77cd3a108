"""Bronze, silver, gold, and data-quality checks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidewell import schemas
from tidewell.catalogue.registry import query, rnd
from tidewell.catalogue.tables import Tables
from tidewell.functions.scalars import round_to
from tidewell.operators import lakehouse, quality
from tidewell.plans import batch
from tidewell.sources import tables as table_io
from tidewell.storage import new_path


@query("bronze_events", """
SELECT event_id, user_id, event_type, epoch_us("timestamp") // 1000 AS "timestamp", event_data
FROM raw_events WHERE "timestamp" >= TIMESTAMP '2024-01-15'
""")
def _(t: Tables):
    return lakehouse.bronze_events(t.raw_events, "2024-01-15").drop("ingestion_timestamp")


@query("bronze_fraud", f"""
SELECT event_id, user_id, {rnd('fraud_score')} AS fraud_score, is_fraud, epoch_us("timestamp") // 1000 AS "timestamp"
FROM fraud_scores
""")
def _(t: Tables):
    return lakehouse.bronze_fraud(t.fraud_scores).drop("ingestion_timestamp").withColumn(
        "fraud_score", round_to(F.col("fraud_score"), 6)
    )


@query("bronze_inventory", """
SELECT item_id AS product_id, warehouse_id, quantity_change, current_stock, "timestamp" FROM stock
""")
def _(t: Tables):
    source = t.stock.withColumn("timestamp", F.timestamp_millis("timestamp")).withColumnRenamed("item_id", "product_id")
    return lakehouse.bronze_inventory(source).drop("ingestion_timestamp")


@query("inventory_view", """
SELECT item_id, warehouse_id, current_stock, "timestamp" FROM stock
""")
def _(t: Tables):
    spelled = t.stock.withColumnRenamed("item_id", "product_id").drop("current_stock")
    return schemas.inventory_view(spelled).select("item_id", "warehouse_id", "current_stock", "timestamp")


@query("events_clean", """
SELECT event_id, user_id, event_type, event_value, epoch_us("timestamp") // 1000 AS "timestamp" FROM events_clean
""")
def _(t: Tables):
    return lakehouse.events_clean(lakehouse.bronze_events(t.raw_events)).drop("built_at")


@query("fact_purchases", """
SELECT event_id AS transaction_id, user_id, event_type AS product_id, event_value AS amount, 1 AS quantity,
       strftime("timestamp", '%Y-%m-%d') AS transaction_date
FROM events_clean WHERE event_type = 'purchase'
""")
def _(t: Tables):
    return batch.purchases(t.raw_events).drop("created_at")


@query("silver_fraud_events", f"""
SELECT event_id, user_id, {rnd('fraud_score')} AS fraud_score, is_fraud, amount,
       epoch_us("timestamp") // 1000 AS "timestamp"
FROM fraud_events
""")
def _(t: Tables):
    bronze = lakehouse.bronze_events(t.raw_events)
    return lakehouse.fraud_events(lakehouse.bronze_fraud(t.fraud_scores), bronze).withColumn(
        "fraud_score", round_to(F.col("fraud_score"), 6)
    )


@query("mart_fraud_daily", f"""
SELECT strftime("timestamp", '%Y-%m-%d') AS metric_date, count(*) AS total_transactions,
       count(*) FILTER (WHERE is_fraud) AS fraud_count,
       {rnd('count(*) FILTER (WHERE is_fraud)::DOUBLE / count(*) * 100', 2)} AS fraud_rate,
       {rnd('sum(CASE WHEN is_fraud THEN amount ELSE 0 END)', 4)} AS total_fraud_amount,
       {rnd('avg(fraud_score)')} AS avg_fraud_score
FROM fraud_events GROUP BY 1
""")
def _(t: Tables):
    return batch.daily_fraud(t.raw_events, t.fraud_scores).withColumns({
        "total_fraud_amount": round_to(F.col("total_fraud_amount"), 4),
        "avg_fraud_score": round_to(F.col("avg_fraud_score"), 6),
    })


@query("sink_table_overwrite", """
SELECT event_id, user_id, event_type, event_value FROM events_clean
""")
def _(t: Tables):
    # A catalog table, rebuilt; a name of its own, since other runs may share the catalog.
    name = f"events_clean_{uuid.uuid4().hex}"
    clean = lakehouse.events_clean(lakehouse.bronze_events(t.raw_events))
    for _ in range(2):
        table_io.overwrite_table(clean, name)
    return table_io.read_table(t.spark, name).select("event_id", "user_id", "event_type", "event_value")


@query("sink_partitioned_day", """
SELECT event_id AS transaction_id, user_id, event_value AS amount, strftime("timestamp", '%Y-%m-%d') AS transaction_date
FROM events_clean WHERE event_type = 'purchase' AND "timestamp" >= TIMESTAMP '2024-01-10'
""")
def _(t: Tables):
    path = new_path(t.spark, "purchases-by-day")
    table_io.overwrite_path(batch.purchases(t.raw_events), path, "transaction_date")
    days = table_io.read_table(t.spark, path, "parquet").filter("transaction_date >= date'2024-01-10'")
    return days.select("transaction_id", "user_id", "amount", "transaction_date")


@query("dq_unique", "SELECT event_id, count(*) AS cnt FROM raw_events GROUP BY 1 HAVING count(*) > 1")
def _(t: Tables):
    return quality.duplicates(lakehouse.bronze_events(t.raw_events), "event_id")


GAPS = """(SELECT event_id, CASE WHEN event_type <> 'error' THEN user_id END AS user_id,
                  CASE WHEN event_type <> 'signup' THEN "timestamp" END AS "timestamp" FROM events_clean)"""


def with_gaps(t: Tables):
    """Clean events, some without user or timestamp."""
    kind = F.col("event_type")
    return lakehouse.events_clean(lakehouse.bronze_events(t.raw_events)).withColumns({
        "user_id": F.when(kind != "error", F.col("user_id")), "timestamp": F.when(kind != "signup", F.col("timestamp")),
    })


@query("dq_no_nulls", f"""
SELECT count(*) AS cnt FROM {GAPS} WHERE event_id IS NULL OR user_id IS NULL OR "timestamp" IS NULL HAVING count(*) > 0
""")
def _(t: Tables):
    return quality.null_rows(with_gaps(t), ["event_id", "user_id", "timestamp"])


RATES = f"""(SELECT strftime("timestamp", '%Y-%m-%d') AS metric_date,
             {rnd('count(*) FILTER (WHERE is_fraud)::DOUBLE / count(*) * 100', 2)} AS fraud_rate
             FROM fraud_events GROUP BY 1)"""


@query("dq_fraud_rate", f"SELECT metric_date, fraud_rate FROM {RATES} WHERE fraud_rate > 5")
def _(t: Tables):
    bronze = lakehouse.bronze_events(t.raw_events)
    return quality.fraud_rate_days(lakehouse.fraud_events(lakehouse.bronze_fraud(t.fraud_scores), bronze))


@query("dq_fraud_rate_count", f"SELECT count(*) AS cnt FROM {RATES} WHERE fraud_rate > 5")
def _(t: Tables):
    bronze = lakehouse.bronze_events(t.raw_events)
    return quality.fraud_rate_count(lakehouse.fraud_events(lakehouse.bronze_fraud(t.fraud_scores), bronze))


@query("dq_source_tests", """
SELECT 'events' AS source, 'event_id' AS column_name, 'unique' AS test,
       (SELECT count(*) FROM (SELECT event_id FROM raw_events GROUP BY 1 HAVING count(*) > 1)) AS failures
UNION ALL SELECT 'events', 'event_id', 'not_null', (SELECT count(*) FROM raw_events WHERE event_id IS NULL)
UNION ALL SELECT 'fraud_scores', 'event_id', 'unique',
       (SELECT count(*) FROM (SELECT event_id FROM fraud_scores GROUP BY 1 HAVING count(*) > 1))
UNION ALL SELECT 'fraud_scores', 'event_id', 'not_null', (SELECT count(*) FROM fraud_scores WHERE event_id IS NULL)
UNION ALL SELECT 'inventory', 'product_id', 'not_null', (SELECT count(*) FROM changes WHERE item_id IS NULL)
""")
def _(t: Tables):
    inventory = t.changes.withColumnRenamed("item_id", "product_id")
    return quality.column_tests(t.raw_events, "events", ["event_id"], ["event_id"]).unionByName(
        quality.column_tests(t.fraud_scores, "fraud_scores", ["event_id"], ["event_id"])
    ).unionByName(quality.column_tests(inventory, "inventory", [], ["product_id"]))


def profile_sql(column: str) -> str:
    return f"""SELECT '{column}' AS column_name, count(*) AS total, count(*) - count("{column}") AS nulls,
    count(DISTINCT "{column}") AS distinct_values, CAST(min("{column}") AS VARCHAR) AS min_value,
    CAST(max("{column}") AS VARCHAR) AS max_value FROM ix_events"""


@query("dq_dataset_validate", " UNION ALL ".join(
    profile_sql(c) for c in ["event_id", "user_id", "item_id", "event_type", "timestamp", "price"]
))
def _(t: Tables):
    return quality.profile(t.events, ["event_id", "user_id", "item_id", "event_type", "timestamp", "price"])


@query("dq_dataset_compare", f"""
WITH a AS (SELECT event_type, count(*) AS n FROM ix_events GROUP BY 1),
     b AS (SELECT event_type, count(*) AS n FROM order_events GROUP BY 1)
SELECT event_type, {rnd('coalesce(a.n::DOUBLE / (SELECT sum(n) FROM a), 0)')} AS share_a,
       {rnd('coalesce(b.n::DOUBLE / (SELECT sum(n) FROM b), 0)')} AS share_b,
       {rnd('abs(coalesce(a.n::DOUBLE / (SELECT sum(n) FROM a), 0) - coalesce(b.n::DOUBLE / (SELECT sum(n) FROM b), 0))')}
           AS difference
FROM a FULL JOIN b USING (event_type)
""")
def _(t: Tables):
    compared = quality.compare_shares(t.events, t.order_events, "event_type")
    return compared.withColumns({name: round_to(F.col(name), 6) for name in ["share_a", "share_b", "difference"]})


@query("dq_schema_conformance", """
WITH v AS (SELECT
    count(*) FILTER (WHERE event_type NOT IN ('view', 'addtocart', 'transaction', 'search', 'filter', 'review')) AS a,
    count(*) FILTER (WHERE CAST(item_id AS BIGINT) NOT BETWEEN 1 AND 5) AS b,
    count(*) FILTER (WHERE event_type = 'search') AS c FROM ix_events)
SELECT 'event_type_known' AS rule, a AS violations FROM v WHERE a > 0
UNION ALL SELECT 'rating_1_to_5', b FROM v WHERE b > 0
UNION ALL SELECT 'user_id_required', c FROM v WHERE c > 0
""")
def _(t: Tables):
    # The item number stands in for a rating, and searches have lost their user.
    spoiled = t.events.withColumns({
        "rating": F.col("item_id").cast("int"), "user_id": F.when(F.col("event_type") != "search", F.col("user_id")),
    })
    return quality.event_conformance(spoiled)


@query("dq_inventory_conformance", """
SELECT 'change_type_known' AS rule, count(*) AS violations FROM changes WHERE quantity_change > 40 HAVING count(*) > 0
""")
def _(t: Tables):
    spoiled = t.stock.withColumn("change_type", F.when(F.col("quantity_change") > 40, "bulk").otherwise(F.col("change_type")))
    return quality.inventory_conformance(spoiled)
