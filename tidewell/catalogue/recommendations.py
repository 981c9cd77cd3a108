"""Similarities and recommendations.

`order_*` is the sparse case, many items with few common users; the events are the
dense one.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.catalogue.registry import query, rnd
from tidewell.catalogue.tables import Tables
from tidewell.functions.scalars import interaction_weight, round_to
from tidewell.operators import profiles, recommend, similarity
from tidewell.plans import batch
from tidewell.sources import topics
from tidewell.storage import new_path


def rounded(df, *names, digits: int = 6):
    return df.withColumns({name: round_to(F.col(name), digits) for name in names})


def model_sims(t: Tables):
    return similarity.similarities(similarity.item_vectors(t.events))


@query("item_vectors", "SELECT item_id, user_id, rating FROM vectors")
def _(t: Tables):
    return similarity.item_vectors(t.events)


@query("item_popularity", "SELECT item_id, count(*) AS event_count FROM ix_events GROUP BY 1")
def _(t: Tables):
    return similarity.item_popularity(t.events)


@query("item_norms", f"SELECT item_id, {rnd('norm')} AS norm FROM norms")
def _(t: Tables):
    return rounded(similarity.item_norms(similarity.item_vectors(t.events)), "norm")


@query("item_pair_dot", "SELECT item_a, item_b, dot, common FROM order_pairs")
def _(t: Tables):
    return similarity.pair_overlaps(similarity.item_vectors(t.order_events))


@query("item_pair_dot_dense", "SELECT item_a, item_b, dot, common FROM pairs")
def _(t: Tables):
    return similarity.pair_overlaps(similarity.item_vectors(t.events))


@query("similarity_topk", f"SELECT item_id, similar_item, {rnd('sim')} AS sim, rank FROM order_sims")
def _(t: Tables):
    return rounded(similarity.similarities(similarity.item_vectors(t.order_events)), "sim")


@query("similarity_topk_dense", f"SELECT item_id, similar_item, {rnd('sim')} AS sim, rank FROM sims")
def _(t: Tables):
    return rounded(model_sims(t), "sim")


@query("similar_items", f"SELECT similar_item, {rnd('sim')} AS sim, rank FROM sims WHERE item_id = '7' AND rank <= 10")
def _(t: Tables):
    return rounded(similarity.similar_items(model_sims(t), "7").drop("item_id"), "sim")


@query("popular_items", """
SELECT item_id, count(*) AS event_count FROM order_events GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10
""")
def _(t: Tables):
    return similarity.popular_items(similarity.item_popularity(t.order_events))


WEIGHT = """CASE event_type WHEN 'transaction' THEN 1.0 WHEN 'addtocart' THEN 0.7 WHEN 'view' THEN 0.3
            WHEN 'search' THEN 0.2 ELSE 0.1 END"""


def fixed_sql(term: str) -> str:
    """SQL text of `fixed_sum`."""
    return f"CAST(sum(CAST(floor(({term})::DOUBLE * 1e9 + 0.5) AS BIGINT)) AS DOUBLE) / 1e9"


def scored_sql(weight: str, history: str, sims: str, keys: str = "user_id") -> str:
    """CTEs: `scored` has all candidates, `fresh` those not seen yet."""
    return f"""hist AS (SELECT {keys}, item_id, {fixed_sql(weight)} AS weight FROM {history} GROUP BY ALL),
     scored AS (SELECT {keys}, similar_item AS item_id, {fixed_sql('weight * sim')} AS score
                FROM hist JOIN {sims} USING (item_id) GROUP BY ALL),
     fresh AS (SELECT s.* FROM scored s WHERE NOT EXISTS
               (SELECT 1 FROM hist h WHERE h.user_id = s.user_id AND h.item_id = s.item_id))"""


@query("reco_candidates", f"""
WITH {scored_sql(WEIGHT, 'ix_events', 'sims')} SELECT user_id, item_id, {rnd('score')} AS score FROM scored
""")
def _(t: Tables):
    weight = interaction_weight(F.col("event_type"))
    return rounded(recommend.candidates(t.events, model_sims(t), weight, ["user_id"]), "score")


@query("reco_exclude_seen", f"""
WITH {scored_sql(WEIGHT, 'ix_events', 'sims')} SELECT user_id, item_id, {rnd('score')} AS score FROM fresh
""")
def _(t: Tables):
    weight = interaction_weight(F.col("event_type"))
    scored = recommend.candidates(t.events, model_sims(t), weight, ["user_id"])
    return rounded(recommend.exclude_seen(scored, t.events, ["user_id"]), "score")


TOP = """SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank FROM fresh"""
CF = f"""SELECT user_id, item_id, {rnd('score', 4)} AS score, rank, 'cf' AS source FROM ({TOP}) WHERE rank <= 10"""


@query("recommend_cf", f"WITH {scored_sql('1', 'order_events', 'order_sims')} {CF}")
def _(t: Tables):
    sims = similarity.similarities(similarity.item_vectors(t.order_events))
    return recommend.recommend_cf(t.order_events, sims)


POPULAR = """pop AS (SELECT *, row_number() OVER (ORDER BY event_count DESC, item_id) AS rank
                     FROM (SELECT item_id, count(*) AS event_count FROM {} GROUP BY 1))"""


@query("recommend_popular_fallback", f"""
WITH {scored_sql('1', 'ix_events', 'sims')}, {POPULAR.format('ix_events')},
     new_users AS (SELECT user_id FROM known_users WHERE user_id NOT IN (SELECT user_id FROM ix_events))
{CF} UNION ALL
SELECT user_id, item_id, event_count / CAST(1000.0 AS DOUBLE), rank, 'popular' FROM new_users, pop WHERE rank <= 10
""")
def _(t: Tables):
    return recommend.recommend(t.users, t.events, model_sims(t), similarity.item_popularity(t.events))


@query("recommend_weighted_topk", f"""
WITH {scored_sql(WEIGHT, 'ix_events', 'sims')}
SELECT user_id, item_id, {rnd('score', 4)} AS score, rank FROM ({TOP}) WHERE rank <= 10 AND score > 0
   AND user_id IN (SELECT user_id FROM ix_events GROUP BY 1 HAVING count(*) >= 3)
""")
def _(t: Tables):
    return recommend.recommend_weighted(t.events, model_sims(t))


SHORT = "SELECT user_id FROM (SELECT user_id FROM {} GROUP BY 1 HAVING count(*) < 3)"


def sparse_history(t: Tables):
    """One event per order instead of one per line: many users stay below three."""
    return t.read("orders").select(
        F.col("o_custkey").cast("string").alias("user_id"), F.col("o_orderkey").cast("string").alias("item_id")
    )


SPARSE = "(SELECT CAST(o_custkey AS VARCHAR) AS user_id, CAST(o_orderkey AS VARCHAR) AS item_id FROM orders)"


@query("recommend_coldstart", f"""
SELECT user_id, 'popular_' || CAST(i AS VARCHAR) AS item_id, {rnd('1 - i * CAST(0.1 AS DOUBLE)')} AS score, i + 1 AS rank
FROM ({SHORT.format(SPARSE)}), range(5) r(i)
""")
def _(t: Tables):
    return rounded(recommend.cold_start(sparse_history(t)), "score")


@query("recommend_coldstart_popular", f"""
WITH {POPULAR.format('order_events')}
SELECT user_id, item_id, {rnd('1 - (rank - 1) * CAST(0.1 AS DOUBLE)')} AS score, rank
FROM ({SHORT.format(SPARSE)}), pop WHERE rank <= 5
""")
def _(t: Tables):
    popularity = similarity.item_popularity(t.order_events)
    return rounded(recommend.cold_start_popular(sparse_history(t), popularity), "score")


def sessions_of(t: Tables):
    """Events with a session id; sessions of `error` events have no user."""
    marked = profiles.user_sessions(t.events)
    return marked.withColumns({
        "session_id": F.concat_ws("-", "user_id", "session_start"),
        "user_id": F.when(F.col("event_type") != "error", F.col("user_id")),
    })


SESSION_CTES = """s AS (
    SELECT *, CASE WHEN event_type <> 'error' THEN owner END AS user_id,
           owner || '-' || CAST(max(CASE WHEN opens THEN "timestamp" END)
               OVER (PARTITION BY owner ORDER BY "timestamp" ROWS UNBOUNDED PRECEDING) AS VARCHAR) AS session_id
    FROM (SELECT * EXCLUDE (user_id), user_id AS owner, coalesce("timestamp" - lag("timestamp")
              OVER (PARTITION BY user_id ORDER BY "timestamp") > 1800000, true) AS opens FROM ix_events)),
  heads AS (SELECT session_id, arg_min(user_id, "timestamp") FILTER (WHERE user_id IS NOT NULL) AS any_user,
                   min("timestamp") AS start, count(*) AS session_length FROM s GROUP BY 1),
  first AS (SELECT heads.session_id, session_length, s.user_id FROM heads
            JOIN s ON s.session_id = heads.session_id AND s."timestamp" = heads.start)"""


@query("process_session", f"""
WITH {SESSION_CTES},
  hist AS (SELECT f.session_id, s.item_id, {fixed_sql(WEIGHT)} AS weight
           FROM s JOIN first f USING (session_id) WHERE f.user_id IS NOT NULL AND f.session_length >= 3 GROUP BY ALL),
  fresh AS (SELECT session_id, similar_item FROM hist JOIN sims USING (item_id)
            WHERE NOT EXISTS (SELECT 1 FROM hist h WHERE h.session_id = hist.session_id AND h.item_id = similar_item)
            GROUP BY ALL),
  counts AS (SELECT session_id, least(10, count(*)) AS n FROM fresh GROUP BY 1)
SELECT session_id, CASE WHEN user_id IS NULL THEN 'no_user' ELSE 'success' END AS status, user_id, session_length,
       CASE WHEN user_id IS NULL THEN 0 WHEN session_length < 3 THEN 5 ELSE coalesce(n, 0) END AS recommendations
FROM first LEFT JOIN counts USING (session_id)
UNION ALL SELECT 'none-' || user_id, 'empty', NULL, 0, 0 FROM known_users
""")
def _(t: Tables):
    events = sessions_of(t)
    requested = events.select("session_id").unionByName(
        t.users.select(F.concat(F.lit("none-"), "user_id").alias("session_id"))
    )
    return recommend.process_sessions(requested, events, model_sims(t))


@query("process_session_literal", f"""
WITH {SESSION_CTES}
SELECT session_id, CASE WHEN user_id IS NULL THEN 'no_user' ELSE 'success' END AS status, user_id, session_length,
       CASE WHEN user_id IS NOT NULL AND session_length < 3 THEN 5 ELSE 0 END AS recommendations
FROM first
""")
def _(t: Tables):
    return recommend.session_results(sessions_of(t), None)


@query("sink_recommendations", f"""
WITH {scored_sql(WEIGHT, 'ix_events', 'sims')}
SELECT 'recommendations' AS topic, user_id AS record_key, 'recommendations:' || user_id AS key,
       string_agg(item_id, ',' ORDER BY rank) AS items, max(newest) + 3600000 AS expires_ms
FROM ({TOP}), (SELECT max("timestamp") AS newest FROM ix_events)
WHERE rank <= 10 AND score > 0 AND user_id IN (SELECT user_id FROM ix_events GROUP BY 1 HAVING count(*) >= 3)
GROUP BY user_id
""")
def _(t: Tables):
    newest = t.events.agg(F.timestamp_millis(F.max("timestamp"))).scalar()
    entries = batch.recommendation_entries(recommend.recommend_weighted(t.events, model_sims(t)), newest)
    shape = "user_id string, recommendations array<struct<rank int, item_id string, score double>>"
    entries = entries.withColumn("_v", F.from_json("value", shape)).withColumn("user_id", F.col("_v.user_id"))
    # The record for the topic, and what a reader finds in its value.
    records = topics.to_records(entries.drop("_v"), "recommendations")
    sent = F.from_json("value", "key string, value string, expires_at timestamp")
    sent = records.select("topic", F.col("key").alias("record_key"), sent.alias("_r")).select("topic", "record_key", "_r.*")
    ranked = F.from_json("value", shape)["recommendations"]
    return sent.select(
        "topic", "record_key", "key", F.array_join(F.transform(ranked, lambda r: r["item_id"]), ",").alias("items"),
        F.unix_millis("expires_at").alias("expires_ms"),
    )


@query("reco_model_save_load", f"""
SELECT item_id, similar_item, {rnd('sim')} AS sim, rank, 50 AS k_neighbors, 3 AS min_common_users FROM sims
""")
def _(t: Tables):
    path = new_path(t.spark, "recommendation-model")
    batch.save_recommendations(batch.train_recommendations(t.events), path)
    model = batch.load_recommendations(t.spark, path)
    return rounded(model.similarities, "sim").withColumns({
        "k_neighbors": F.lit(model.settings.k_neighbors), "min_common_users": F.lit(model.settings.min_common_users),
    })


CUT = 1705795200000  # 2024-01-21: three weeks to learn from, the rest to be found.


@query("reco_eval", f"""
WITH old AS (SELECT * FROM ix_events WHERE "timestamp" < {CUT}),
     v AS (SELECT item_id, user_id, sum(CASE event_type WHEN 'transaction' THEN 5.0 WHEN 'addtocart' THEN 3.0
           WHEN 'view' THEN 1.0 WHEN 'search' THEN 0.5 ELSE 1.0 END)::DOUBLE AS rating FROM old GROUP BY 1, 2),
     nm AS (SELECT item_id, sqrt(sum(rating * rating)) AS norm FROM v GROUP BY 1),
     pr AS (SELECT a.item_id AS item_id, b.item_id AS similar_item, sum(a.rating * b.rating) AS dot
            FROM v a JOIN v b ON a.user_id = b.user_id AND a.item_id <> b.item_id GROUP BY 1, 2 HAVING count(*) >= 3),
     sm AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY sim DESC, similar_item) AS rank
            FROM (SELECT pr.item_id, similar_item, dot / (x.norm * y.norm) AS sim FROM pr
                  JOIN nm x ON x.item_id = pr.item_id JOIN nm y ON y.item_id = similar_item)) WHERE rank <= 50),
     {scored_sql(WEIGHT, 'old', 'sm')},
     top AS (SELECT * FROM ({TOP}) WHERE rank <= 10
             AND user_id IN (SELECT user_id FROM old GROUP BY 1 HAVING count(*) >= 3)),
     truth AS (SELECT DISTINCT user_id, item_id FROM ix_events WHERE "timestamp" >= {CUT} AND event_type = 'transaction'),
     per AS (SELECT user_id, count(*) AS relevant, count(top.item_id) AS hits
             FROM truth LEFT JOIN top USING (user_id, item_id) GROUP BY 1)
SELECT {rnd('avg(hits / 10.0::DOUBLE)')} AS precision_at_k, {rnd('avg(hits::DOUBLE / relevant)')} AS recall_at_k,
       count(*) AS users, {rnd('(SELECT count(DISTINCT item_id) FROM top)::DOUBLE / (SELECT count(DISTINCT item_id) FROM ix_events)')}
       AS coverage FROM per
""")
def _(t: Tables):
    old, new = t.events.filter(F.col("timestamp") < CUT), t.events.filter(F.col("timestamp") >= CUT)
    sims = similarity.similarities(similarity.item_vectors(old))
    listed = recommend.recommend_weighted(old, sims)
    result = recommend.evaluate(listed, new.filter("event_type = 'transaction'"), t.events)
    return rounded(result, "precision_at_k", "recall_at_k", "coverage")
