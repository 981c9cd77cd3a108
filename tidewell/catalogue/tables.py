"""The given tables as events, scores and stock changes, in Spark and as SQL.

Every view is computed from a whole table.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell import schemas
from tidewell.functions.scalars import to_millis
from tidewell.operators import fraud, series
from tidewell.sources.orders import orders_to_events

OPENING_STOCK = 400


class Tables:
    """Views over one folder of tables, built when first asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        """Clickstream events: the five kinds of the events table under the model's names."""
        k = F.get_json_object("props", "$.k").cast("bigint")
        kind = F.col("event_type")
        return self.read("events").select(
            F.col("event_id").cast("string").alias("event_id"),
            F.col("user_id").cast("string").alias("user_id"),
            k.cast("string").alias("item_id"),
            F.concat(F.lit("c"), k % 10).alias("category"),
            F.when(kind == "click", "addtocart").when(kind == "purchase", "transaction")
            .when(kind == "signup", "search").otherwise(kind).alias("event_type"),
            to_millis(F.col("ts")).alias("timestamp"),
            F.when(kind.isin("click", "purchase"), F.col("value")).alias("price"),
            (k % 3 + 1).cast("int").alias("quantity"),
        )

    @cached_property
    def raw_events(self) -> DataFrame:
        """Raw deliveries. Events of 100 and more were delivered again, corrected, an hour later."""
        events = self.read("events")
        first = events.select(
            F.col("event_id").cast("string").alias("event_id"), F.col("user_id").cast("string").alias("user_id"),
            "event_type", F.col("ts").cast("timestamp").alias("timestamp"),
            F.col("value").cast("string").alias("event_data"),
            F.col("ts").cast("timestamp").alias("ingestion_timestamp"), "value",
        )
        again = first.filter("value >= 100").withColumns({
            "event_data": (F.col("value") + 1).cast("string"),
            "ingestion_timestamp": F.col("ingestion_timestamp") + F.expr("interval 1 hour"),
        })
        return first.unionByName(again).drop("value")

    @cached_property
    def fraud_scores(self) -> DataFrame:
        """Scored purchases."""
        k = F.get_json_object("props", "$.k").cast("bigint")
        base = self.read("events").filter("event_type = 'purchase'").select(
            F.col("event_id").cast("string").alias("event_id"),
            F.col("user_id").cast("string").alias("user_id"),
            (F.col("value") * 25).alias("amount"),
            (k % 51).cast("int").alias("velocity"),
            F.col("ts").cast("timestamp").alias("timestamp"),
            (F.col("user_id") % 10 / 10.0).alias("country_risk"),
            (F.hour("ts") >= 18).cast("int").alias("is_evening"),
        )
        scored = fraud.with_rule_score(base)
        return scored.withColumn("label", F.col("is_fraud").cast("int"))

    @cached_property
    def changes(self) -> DataFrame:
        """Stock changes from order lines, without levels: returns add, the rest takes away."""
        line = self.read("lineitem")

        def digits(column, width):
            return F.lpad(column.cast("string"), width, "0")

        back = F.col("l_returnflag") == "R"
        quantity = F.col("l_quantity").cast("int")
        return line.select(
            F.concat_ws(
                "-", digits(F.col("l_orderkey"), 12), digits(F.col("l_linenumber"), 2), digits(F.col("l_suppkey"), 8),
                digits(F.floor(F.col("l_extendedprice") * 100 + F.lit(0.5)).cast("bigint"), 12),
            ).alias("change_id"),
            to_millis(F.col("l_shipdate")).alias("timestamp"),
            F.col("l_partkey").cast("string").alias("item_id"),
            F.concat(F.lit("wh-"), F.col("l_partkey") % 10).alias("warehouse_id"),
            F.when(back, "stock_in").otherwise("stock_out").alias("change_type"),
            F.when(back, quantity).otherwise(-quantity).alias("quantity_change"),
        )

    @cached_property
    def stock(self) -> DataFrame:
        """Stock changes with the level after each, as a series per item and warehouse."""
        levels = series.with_running_stock(self.changes, OPENING_STOCK)
        after = F.col("current_stock").cast("int")
        return levels.withColumns({"quantity_after": after, "quantity_before": after - F.col("quantity_change")})

    @cached_property
    def order_events(self) -> DataFrame:
        return orders_to_events(self.read("orders"), self.read("lineitem"))

    @cached_property
    def clicks(self) -> DataFrame:
        """The events as rows of a clickstream file: text, with gaps."""
        kind = F.col("event_type")
        return self.events.select(
            F.floor(F.col("timestamp") / 1000).cast("string").alias("Timestamp"),
            F.col("user_id").alias("VisitorID"),
            F.when(kind == "view", "VIEW").otherwise(kind).alias("Event"),
            F.col("item_id").alias("ItemID"),
            F.when(kind.isin("transaction", "addtocart"), F.concat(F.lit("t"), "event_id")).alias("TransactionID"),
            F.when(F.col("category") == "c7", F.lit("n/a")).otherwise(F.col("price").cast("string")).alias("Price"),
            F.when(F.col("category") == "c8", F.lit("2.5")).otherwise(F.col("quantity").cast("string")).alias("Quantity"),
        )

    @cached_property
    def users(self) -> DataFrame:
        """Known users: all customers, most of whom have no events."""
        return self.read("customer").select(F.col("c_custkey").cast("string").alias("user_id"))

    @cached_property
    def items(self) -> DataFrame:
        return self.read("part").select(F.col("p_partkey").cast("string").alias("item_id"))

    @cached_property
    def catalog(self) -> DataFrame:
        return self.read("part").select(
            F.col("p_partkey").cast("string").alias("item_id"),
            F.col("p_name").alias("name"),
            F.col("p_brand").alias("brand"),
            F.col("p_retailprice").alias("retail_price"),
        )

    @cached_property
    def reorder_policy(self) -> DataFrame:
        return self.read("part").select(
            F.col("p_partkey").cast("string").alias("item_id"),
            (F.col("p_size") * 5.0).alias("reorder_point"),
            (F.col("p_size") % 14).alias("lead_time_days"),
        )

    def event_records(self) -> DataFrame:
        """The events as records of their topic."""
        return self._records(self.events, "raw-events", F.col("user_id"))

    def stock_records(self) -> DataFrame:
        stock = self.stock.withColumn("quantity_change", F.col("quantity_change").cast("int"))
        return self._records(stock.drop("current_stock"), "inventory-changes", F.col("item_id"))

    @staticmethod
    def _records(df: DataFrame, topic: str, key) -> DataFrame:
        # Dealt out evenly: a few large files, or one, would have their values written and read by as many tasks.
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        shaped = df.repartition(parts).select(
            key.cast("binary").alias("key"),
            F.to_json(F.struct("*")).cast("binary").alias("value"),
            F.lit(topic).alias("topic"),
            F.pmod(F.hash(key), F.lit(3)).cast("int").alias("partition"),
            F.monotonically_increasing_id().alias("offset"),
            F.timestamp_millis("timestamp").alias("timestamp"),
        )
        return schemas.conform(shaped, schemas.TOPIC_RECORD)


# The same views for an SQL engine. `k` is the number inside props.
SQL_VIEWS = {
    "ix_events": """
        SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id,
               CAST(k AS VARCHAR) AS item_id, 'c' || CAST(k % 10 AS VARCHAR) AS category,
               CASE event_type WHEN 'click' THEN 'addtocart' WHEN 'purchase' THEN 'transaction'
                    WHEN 'signup' THEN 'search' ELSE event_type END AS event_type,
               epoch_us(ts) // 1000 AS "timestamp",
               CASE WHEN event_type IN ('click', 'purchase') THEN value END AS price,
               CAST(k % 3 + 1 AS INTEGER) AS quantity
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)""",
    "raw_events": """
        SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, event_type,
               ts AS "timestamp", CAST(value AS VARCHAR) AS event_data, ts AS ingestion_timestamp
        FROM events
        UNION ALL
        SELECT CAST(event_id AS VARCHAR), CAST(user_id AS VARCHAR), event_type, ts, CAST(value + 1 AS VARCHAR),
               ts + INTERVAL 1 HOUR
        FROM events WHERE value >= 100""",
    "fraud_scores": """
        SELECT *, fraud_score > CAST(0.7 AS DOUBLE) AS is_fraud,
               CAST(fraud_score > CAST(0.7 AS DOUBLE) AS INTEGER) AS label
        FROM (SELECT *, CAST(0.4 AS DOUBLE) * amount / CAST(5000.0 AS DOUBLE)
                        + CAST(0.6 AS DOUBLE) * velocity / CAST(50.0 AS DOUBLE) AS fraud_score
              FROM (SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id,
                           value * 25 AS amount,
                           CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) % 51 AS INTEGER) AS velocity,
                           ts AS "timestamp", CAST(user_id % 10 AS DOUBLE) / 10 AS country_risk,
                           CAST(hour(ts) >= 18 AS INTEGER) AS is_evening
                    FROM events WHERE event_type = 'purchase'))""",
    "changes": """
        SELECT lpad(CAST(l_orderkey AS VARCHAR), 12, '0') || '-' || lpad(CAST(l_linenumber AS VARCHAR), 2, '0') || '-'
               || lpad(CAST(l_suppkey AS VARCHAR), 8, '0') || '-'
               || lpad(CAST(CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) AS VARCHAR), 12, '0') AS change_id,
               epoch_us(l_shipdate) // 1000 AS "timestamp", CAST(l_partkey AS VARCHAR) AS item_id,
               'wh-' || CAST(l_partkey % 10 AS VARCHAR) AS warehouse_id,
               CASE WHEN l_returnflag = 'R' THEN 'stock_in' ELSE 'stock_out' END AS change_type,
               CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS INTEGER) ELSE -CAST(l_quantity AS INTEGER) END
                   AS quantity_change
        FROM lineitem""",
    "stock": """
        SELECT *, CAST(current_stock AS INTEGER) AS quantity_after,
               CAST(current_stock AS INTEGER) - quantity_change AS quantity_before
        FROM (SELECT *, CAST(400 + sum(quantity_change) OVER (PARTITION BY item_id, warehouse_id
                        ORDER BY "timestamp", change_id ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS current_stock
              FROM changes)""",
    "points": """
        SELECT *, row_number() OVER w - 1 AS i, lag(current_stock) OVER w AS previous,
               row_number() OVER (PARTITION BY item_id, warehouse_id ORDER BY "timestamp" DESC, change_id DESC) AS age,
               count(*) OVER (PARTITION BY item_id, warehouse_id) AS n
        FROM stock WINDOW w AS (PARTITION BY item_id, warehouse_id ORDER BY "timestamp", change_id)""",
    "order_events": """
        SELECT 'ord-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-'
               || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) AS event_id,
               'transaction' AS event_type, epoch_us(o_orderdate) // 1000 AS "timestamp",
               CAST(o_custkey AS VARCHAR) AS user_id, CAST(l_partkey AS VARCHAR) AS item_id,
               CAST(l_orderkey AS VARCHAR) AS transaction_id, l_extendedprice / l_quantity AS price,
               CAST(l_quantity AS INTEGER) AS quantity
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "clicks": """
        SELECT CAST("timestamp" // 1000 AS VARCHAR) AS "Timestamp", user_id AS "VisitorID",
               CASE WHEN event_type = 'view' THEN 'VIEW' ELSE event_type END AS "Event", item_id AS "ItemID",
               CASE WHEN event_type IN ('transaction', 'addtocart') THEN 't' || event_id END AS "TransactionID",
               CASE WHEN category = 'c7' THEN 'n/a' ELSE CAST(price AS VARCHAR) END AS "Price",
               CASE WHEN category = 'c8' THEN '2.5' ELSE CAST(quantity AS VARCHAR) END AS "Quantity"
        FROM ix_events""",
    "normalized": """
        SELECT 'rr-' || "Timestamp" || '-' || "VisitorID" AS event_id, lower("Event") AS event_type,
               CAST("Timestamp" AS BIGINT) * 1000 AS "timestamp", "VisitorID" AS user_id, "ItemID" AS item_id,
               CASE WHEN lower("Event") = 'transaction' THEN "TransactionID" END AS transaction_id,
               try_cast("Price" AS DOUBLE) AS price,
               CAST(CASE WHEN regexp_full_match("Quantity", '[+-]?[0-9]+') THEN "Quantity" END AS BIGINT) AS quantity,
               lower("Event") IN ('view', 'addtocart', 'transaction') AS valid, "Timestamp", "VisitorID", "ItemID", "Event"
        FROM clicks""",
    "vectors": """
        SELECT item_id, user_id, sum(CASE lower(event_type) WHEN 'transaction' THEN 5.0 WHEN 'addtocart' THEN 3.0
               WHEN 'view' THEN 1.0 WHEN 'search' THEN 0.5 ELSE 1.0 END)::DOUBLE AS rating
        FROM ix_events GROUP BY 1, 2""",
    "order_vectors": """
        SELECT item_id, user_id, CAST(5.0 * count(*) AS DOUBLE) AS rating FROM order_events GROUP BY 1, 2""",
    "order_pairs": """
        SELECT a.item_id AS item_a, b.item_id AS item_b, sum(a.rating * b.rating) AS dot, count(*) AS common
        FROM order_vectors a JOIN order_vectors b ON a.user_id = b.user_id AND a.item_id < b.item_id
        GROUP BY 1, 2 HAVING count(*) >= 3""",
    "pairs": """
        SELECT a.item_id AS item_a, b.item_id AS item_b, sum(a.rating * b.rating) AS dot, count(*) AS common
        FROM vectors a JOIN vectors b ON a.user_id = b.user_id AND a.item_id < b.item_id
        GROUP BY 1, 2 HAVING count(*) >= 3""",
    "norms": "SELECT item_id, sqrt(sum(rating * rating)) AS norm FROM vectors GROUP BY 1",
    "order_norms": "SELECT item_id, sqrt(sum(rating * rating)) AS norm FROM order_vectors GROUP BY 1",
    "sims": """
        SELECT * FROM (
          SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY sim DESC, similar_item) AS rank
          FROM (SELECT item_a AS item_id, item_b AS similar_item, dot / (na.norm * nb.norm) AS sim
                FROM pairs JOIN norms na ON na.item_id = item_a JOIN norms nb ON nb.item_id = item_b
                UNION ALL
                SELECT item_b, item_a, dot / (na.norm * nb.norm)
                FROM pairs JOIN norms na ON na.item_id = item_a JOIN norms nb ON nb.item_id = item_b)
          WHERE sim > 0) WHERE rank <= 50""",
    "order_sims": """
        SELECT * FROM (
          SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY sim DESC, similar_item) AS rank
          FROM (SELECT item_a AS item_id, item_b AS similar_item, dot / (na.norm * nb.norm) AS sim
                FROM order_pairs JOIN order_norms na ON na.item_id = item_a JOIN order_norms nb ON nb.item_id = item_b
                UNION ALL
                SELECT item_b, item_a, dot / (na.norm * nb.norm)
                FROM order_pairs JOIN order_norms na ON na.item_id = item_a JOIN order_norms nb ON nb.item_id = item_b)
          WHERE sim > 0) WHERE rank <= 50""",
    "known_users": "SELECT CAST(c_custkey AS VARCHAR) AS user_id FROM customer",
    "known_items": "SELECT CAST(p_partkey AS VARCHAR) AS item_id FROM part",
    "events_clean": """
        SELECT event_id, user_id, event_type, CAST(event_data AS DOUBLE) AS event_value, "timestamp"
        FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ingestion_timestamp DESC) AS rn
              FROM raw_events WHERE event_id IS NOT NULL) WHERE rn = 1""",
    "fraud_events": """
        SELECT f.event_id, f.user_id, f.fraud_score, f.is_fraud, CAST(e.event_data AS DOUBLE) AS amount, f."timestamp"
        FROM fraud_scores f LEFT JOIN raw_events e ON f.event_id = e.event_id""",
}
