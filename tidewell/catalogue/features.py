"""User, item and session features, and time windows in batch."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.catalogue.registry import query, rnd
from tidewell.catalogue.tables import Tables
from tidewell.functions.scalars import round_to
from tidewell.operators import profiles, windows

ROUND_SPENT = rnd("sum(CAST(CASE WHEN event_type = 'transaction' THEN coalesce(price, 0) ELSE 0 END AS DECIMAL(30,10)))", 2)
CONVERSION = f"""CASE WHEN count(*) FILTER (WHERE event_type = 'view') = 0 THEN CAST(0 AS DOUBLE) ELSE
    {rnd("count(*) FILTER (WHERE event_type = 'transaction')::DOUBLE / count(*) FILTER (WHERE event_type = 'view')", 4)}
    END"""
POPULARITY = """least(1.0::DOUBLE, (count(*) FILTER (WHERE event_type = 'view') * 0.1::DOUBLE
    + count(*) FILTER (WHERE event_type = 'addtocart') * 0.3::DOUBLE
    + count(*) FILTER (WHERE event_type = 'transaction') * 0.6::DOUBLE) / 100.0::DOUBLE)"""

USER_SQL = f"""SELECT user_id, count(*) AS total_interactions, count(*) FILTER (WHERE event_type = 'view') AS view_count,
    count(*) FILTER (WHERE event_type = 'addtocart') AS cart_count,
    count(*) FILTER (WHERE event_type = 'transaction') AS purchase_count,
    count(*) FILTER (WHERE event_type = 'search') AS search_count, count(DISTINCT item_id) AS unique_items,
    count(DISTINCT category) AS unique_categories, {ROUND_SPENT} AS total_spent, min("timestamp") AS first_activity,
    max("timestamp") AS last_activity, {CONVERSION} AS conversion_rate
FROM ix_events GROUP BY 1"""

ITEM_SQL = f"""SELECT item_id, count(*) AS total_interactions, count(*) FILTER (WHERE event_type = 'view') AS view_count,
    count(*) FILTER (WHERE event_type = 'addtocart') AS cart_count,
    count(*) FILTER (WHERE event_type = 'transaction') AS purchase_count, count(DISTINCT user_id) AS unique_users,
    coalesce({rnd('sum(CAST(nullif(price, 0) AS DECIMAL(30,10)))::DOUBLE / count(nullif(price, 0))', 2)}, 0) AS avg_price, coalesce(min(nullif(price, 0)), 0) AS min_price,
    coalesce(max(nullif(price, 0)), 0) AS max_price, {rnd(POPULARITY)} AS popularity_score
FROM ix_events GROUP BY 1"""


def item_features(t: Tables):
    return profiles.item_features(t.events).withColumn("popularity_score", round_to(F.col("popularity_score"), 6))


@query("user_features", USER_SQL)
def _(t: Tables):
    return profiles.user_features(t.events)


@query("conversion_rate", f"SELECT user_id, {CONVERSION} AS conversion_rate FROM ix_events GROUP BY 1")
def _(t: Tables):
    return profiles.conversion_rates(t.events)


@query("item_features", ITEM_SQL)
def _(t: Tables):
    return item_features(t)


@query("popularity_score", f"SELECT item_id, {rnd(POPULARITY)} AS popularity_score FROM ix_events GROUP BY 1")
def _(t: Tables):
    return profiles.item_popularity_scores(t.events).withColumn(
        "popularity_score", round_to(F.col("popularity_score"), 6)
    )


def defaults_sql(features: str, view: str, key: str, flag: str, columns: list[str]) -> str:
    chosen = ", ".join(f"coalesce(f.{c}, 0) AS {c}" for c in columns)
    return f"""WITH f AS ({features}) SELECT k.{key}, {chosen}, f.{key} IS NULL AS {flag}
               FROM (SELECT DISTINCT {key} FROM {view}) k LEFT JOIN f ON f.{key} = k.{key}"""


USER_NUMBERS = ["total_interactions", "view_count", "cart_count", "purchase_count", "search_count", "unique_items",
                "unique_categories", "total_spent", "conversion_rate"]
ITEM_NUMBERS = ["total_interactions", "view_count", "cart_count", "purchase_count", "unique_users", "avg_price",
                "popularity_score"]


@query("user_defaults", defaults_sql(USER_SQL, "known_users", "user_id", "is_new_user", USER_NUMBERS))
def _(t: Tables):
    full = profiles.users_with_defaults(t.users, profiles.user_features(t.events))
    return full.drop("first_activity", "last_activity")


@query("item_defaults", defaults_sql(ITEM_SQL, "known_items", "item_id", "is_new_item", ITEM_NUMBERS))
def _(t: Tables):
    return profiles.items_with_defaults(t.items, item_features(t)).drop("min_price", "max_price")


@query("profile_lookup", f"""
WITH f AS ({USER_SQL}) SELECT k.user_id, f.total_spent, f.user_id IS NOT NULL AS found
FROM known_users k LEFT JOIN f ON f.user_id = k.user_id
""")
def _(t: Tables):
    features = profiles.user_features(t.events).select("user_id", "total_spent")
    return profiles.lookup_profiles(t.users, features, "user_id")


@query("feature_table", f"""
WITH u AS ({USER_SQL}), i AS ({ITEM_SQL}),
     p AS (SELECT user_id, item_id, count(*) AS interactions FROM ix_events GROUP BY 1, 2)
SELECT p.*, {', '.join(f'u.{c} AS user_{c}' for c in USER_NUMBERS + ['first_activity', 'last_activity'])},
       {', '.join(f'i.{c} AS item_{c}' for c in ITEM_NUMBERS + ['min_price', 'max_price'])}
FROM p JOIN u USING (user_id) JOIN i USING (item_id)
""")
def _(t: Tables):
    return profiles.feature_table(t.events, profiles.user_features(t.events), item_features(t))


SESSIONS = """s AS (
    SELECT *, max(CASE WHEN opens THEN "timestamp" END)
                  OVER (PARTITION BY user_id ORDER BY "timestamp" ROWS UNBOUNDED PRECEDING) AS session_start
    FROM (SELECT *, coalesce("timestamp" - lag("timestamp") OVER (PARTITION BY user_id ORDER BY "timestamp")
                             > 1800000, true) AS opens FROM ix_events))"""
SESSION_SQL = f"""WITH {SESSIONS}
SELECT user_id, session_start, count(*) AS session_length,
       CASE WHEN count(*) >= 2 THEN max("timestamp") - min("timestamp") ELSE 0 END AS duration_seconds,
       bool_or(event_type = 'transaction') AS has_purchase, bool_or(event_type = 'addtocart') AS has_cart,
       count(DISTINCT item_id) AS unique_items_viewed
FROM s GROUP BY 1, 2"""


@query("session_features", SESSION_SQL)
def _(t: Tables):
    sessions = profiles.user_sessions(t.events)
    return profiles.session_features(sessions, ["user_id", "session_start"]).drop("is_empty")


@query("win_session_30m", SESSION_SQL)
def _(t: Tables):
    # In batch a busy user's sessions are found in many tasks; session windows are for streams.
    found = profiles.session_features(profiles.user_sessions(t.events), ["user_id", "session_start"])
    return found.drop("is_empty")


TUMBLING = """SELECT user_id, "timestamp" // 300000 * 300000 AS window_start,
    "timestamp" // 300000 * 300000 + 300000 AS window_end, count(*) AS events,
    count(*) FILTER (WHERE event_type = 'transaction') AS transactions,
    floor(sum(CASE WHEN event_type = 'transaction' THEN coalesce(price, 0) ELSE 0 END)::DOUBLE * 1e4 + 0.5) / 1e4 AS amount
FROM ix_events GROUP BY 1, 2, 3"""


@query("win_tumbling_5m", TUMBLING)
def _(t: Tables):
    return windows.tumbling(windows.event_time(t.events)).withColumn("amount", round_to(F.col("amount"), 4))


@query("velocity_5m", f"""
WITH w AS ({TUMBLING})
SELECT event_id, e.user_id, w.events AS velocity, w.amount AS window_amount
FROM ix_events e JOIN w ON w.user_id = e.user_id AND w.window_start = e."timestamp" // 300000 * 300000
""")
def _(t: Tables):
    return windows.velocity(windows.event_time(t.events)).select(
        "event_id", "user_id", "velocity", round_to(F.col("window_amount"), 4).alias("window_amount")
    )


@query("win_sliding_24h", """
SELECT item_id, warehouse_id, start_ms AS window_start, start_ms + 86400000 AS window_end, count(*) AS changes,
       sum(quantity_change)::BIGINT AS net_change, min(current_stock) AS min_stock, max(current_stock) AS max_stock
FROM (SELECT *, unnest(generate_series("timestamp" // 3600000 * 3600000 - 82800000,
                                       "timestamp" // 3600000 * 3600000, 3600000)) AS start_ms FROM stock)
GROUP BY 1, 2, 3
""")
def _(t: Tables):
    return windows.sliding_by_panes(t.stock)
