"""Features of users, items and sessions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions import ordered
from tidewell.functions.scalars import event_type_or_view, filled, nonzero, ratio, round_to

# Money is summed as decimals: the sum, and what it rounds to, does not depend on the
# order in which tasks finish.
MONEY = "decimal(30,10)"

# Distinct counts: exact by `count_distinct` in batch. Streams have no distinct
# aggregates; there the distinct values of one short window are collected instead.


def _of_type(name: str) -> Column:
    return event_type_or_view(F.col("event_type")) == name


def _count(name: str) -> Column:
    return F.count_if(_of_type(name))


def conversion(purchases: Column, views: Column) -> Column:
    """Purchases per view, 0 without views. May exceed 1."""
    return round_to(ratio(purchases, views), 4)


def popularity(views: Column, carts: Column, purchases: Column) -> Column:
    score = views * F.lit(0.1) + carts * F.lit(0.3) + purchases * F.lit(0.6)
    return F.least(F.lit(1.0), score / F.lit(100.0))


def user_features(events: DataFrame) -> DataFrame:
    """Activity, spending and conversion of each user."""
    spent = F.sum(F.when(_of_type("transaction"), F.coalesce(F.col("price"), F.lit(0.0))).otherwise(0.0).cast(MONEY))
    counted = events.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("total_interactions"),
        _count("view").alias("view_count"),
        _count("addtocart").alias("cart_count"),
        _count("transaction").alias("purchase_count"),
        _count("search").alias("search_count"),
        F.count_distinct(filled(F.col("item_id"))).alias("unique_items"),
        F.count_distinct(filled(F.col("category"))).alias("unique_categories"),
        round_to(spent, 2).alias("total_spent"),
        F.min(nonzero(F.col("timestamp"))).alias("first_activity"),
        F.max(nonzero(F.col("timestamp"))).alias("last_activity"),
    )
    return counted.withColumn("conversion_rate", conversion(F.col("purchase_count"), F.col("view_count")))


def conversion_rates(events: DataFrame) -> DataFrame:
    return events.groupBy("user_id").agg(
        conversion(_count("transaction"), _count("view")).alias("conversion_rate")
    )


def item_features(events: DataFrame) -> DataFrame:
    """Activity and prices of each item. A price of 0 counts as no price."""
    price = nonzero(F.col("price"))
    views, carts, purchases = _count("view"), _count("addtocart"), _count("transaction")
    return events.groupBy("item_id").agg(
        F.count(F.lit(1)).alias("total_interactions"),
        views.alias("view_count"),
        carts.alias("cart_count"),
        purchases.alias("purchase_count"),
        F.count_distinct(filled(F.col("user_id"))).alias("unique_users"),
        F.coalesce(round_to(F.sum(price.cast(MONEY)).cast("double") / F.nullif(F.count(price), F.lit(0)), 2), F.lit(0.0)).alias("avg_price"),
        F.coalesce(F.min(price), F.lit(0.0)).alias("min_price"),
        F.coalesce(F.max(price), F.lit(0.0)).alias("max_price"),
        popularity(views, carts, purchases).alias("popularity_score"),
    )


def item_popularity_scores(events: DataFrame) -> DataFrame:
    return events.groupBy("item_id").agg(
        popularity(_count("view"), _count("addtocart"), _count("transaction")).alias("popularity_score")
    )


def _with_defaults(known: DataFrame, features: DataFrame, key: str, flag: str, unset: list[str]) -> DataFrame:
    """Features for every known key; zeros and the flag where there are none."""
    numbers = [name for name in features.columns if name != key and name not in unset]
    joined = known.select(key).distinct().join(features.withColumn("_seen", F.lit(True)), key, "left")
    return joined.select(
        key,
        *[F.coalesce(F.col(name), F.lit(0).cast(features.schema[name].dataType)).alias(name) for name in numbers],
        *unset,
        F.col("_seen").isNull().alias(flag),
    )


def users_with_defaults(users: DataFrame, features: DataFrame) -> DataFrame:
    """Users without events get zeros and `is_new_user`; they have no first and last activity."""
    return _with_defaults(users, features, "user_id", "is_new_user", ["first_activity", "last_activity"])


def items_with_defaults(items: DataFrame, features: DataFrame) -> DataFrame:
    """Items nobody touched get zeros and `is_new_item`; they have no lowest and highest price."""
    return _with_defaults(items, features, "item_id", "is_new_item", ["min_price", "max_price"])


def lookup_profiles(requests: DataFrame, profiles: DataFrame, key: str) -> DataFrame:
    """The profile of each requested key, where there is one."""
    return requests.join(profiles.withColumn("_hit", F.lit(True)), key, "left").withColumn(
        "found", F.col("_hit").isNotNull()
    ).drop("_hit")


def session_features(events: DataFrame, keys: list[str]) -> DataFrame:
    """Features of each session; `keys` tells the sessions apart."""
    stamp = nonzero(F.col("timestamp"))
    return events.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("session_length"),
        F.lit(False).alias("is_empty"),
        F.when(F.count(stamp) >= 2, F.max(stamp) - F.min(stamp)).otherwise(F.lit(0)).alias("duration_seconds"),
        F.bool_or(_of_type("transaction")).alias("has_purchase"),
        F.bool_or(_of_type("addtocart")).alias("has_cart"),
        F.count_distinct(filled(F.col("item_id"))).alias("unique_items_viewed"),
    )


def user_sessions(
    events: DataFrame, gap_minutes: int = 30, max_rows: int = ordered.MAX_ROWS_PER_KEY
) -> DataFrame:
    """Events with the start of the session they belong to."""
    return ordered.sessions(events, ["user_id"], "timestamp", gap_minutes * 60 * 1000, max_rows=max_rows)


def feature_table(events: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """User and item features side by side, for every (user, item) that interacted."""

    def prefixed(df: DataFrame, key: str, prefix: str) -> DataFrame:
        return df.select(key, *[F.col(name).alias(prefix + name) for name in df.columns if name != key])

    pairs = events.groupBy("user_id", "item_id").agg(F.count(F.lit(1)).alias("interactions"))
    return pairs.join(prefixed(users, "user_id", "user_"), "user_id").join(
        prefixed(items, "item_id", "item_"), "item_id"
    )
