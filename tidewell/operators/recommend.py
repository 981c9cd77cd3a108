"""Recommendations from item similarities and user histories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.config import RecommendConfig, SimilarityConfig
from tidewell.functions import ordered
from tidewell.functions.scalars import fixed_sum, has_text, interaction_weight, round_to
from tidewell.operators import similarity
from tidewell.storage import write_once

#: Terms (an item of a history and one similar to it) that one task sums up.
TERMS_PER_TASK = 2_000_000


def _weights(history: DataFrame, weight: Column, keys: list[str]) -> DataFrame:
    """One row per key and item; a repeated item weighs as often as it occurs."""
    return history.filter(has_text(F.col("item_id"))).groupBy(*keys, "item_id").agg(
        fixed_sum(weight).alias("weight")
    )


def _summed(weights: DataFrame, sims: DataFrame, keys: list[str], mark_seen: bool) -> DataFrame:
    """`score`, the sum of weight x similarity, per key and similar item; with `mark_seen` also `_seen`.

    An item of a history travels once, with the list of its similar items, to the task of its key, where the terms
    are summed up: no term is sent. There are as many tasks as the terms ask for. A very large history takes part
    in several tasks, each of which sums up its share of the similar items.
    """
    spark = weights.sparkSession
    weights = write_once(weights, "history-weights")
    near = sims.groupBy("item_id").agg(F.collect_list(F.struct(F.col("similar_item").alias("item"), "sim")).alias("near"))
    near = write_once(near, "near-items")
    most = near.agg(F.max(F.size("near")).alias("n")).first()["n"] or 0
    rows = weights.count()
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows * (most + 1) // TERMS_PER_TASK))
    placed = weights.join(near, "item_id", "left" if mark_seen else "inner")
    if mark_seen:
        own = F.array(F.struct(F.col("item_id").alias("item"), F.lit(None).cast("double").alias("sim")))
        placed = placed.withColumn("near", F.concat(F.coalesce("near", F.array().cast(near.schema["near"].dataType)), own))
    shares = F.ceil(F.count(F.lit(1)) * (most + 1) / F.lit(TERMS_PER_TASK)).cast("int")
    large = weights.groupBy(*keys).agg(shares.alias("_shares")).filter("_shares > 1")
    placed = placed.withColumn("_share", F.lit(0))
    if not large.isEmpty():
        same = [placed[k].eqNullSafe(large[k]) for k in keys]
        on = same[0]
        for column in same[1:]:
            on = on & column
        placed = placed.join(F.broadcast(large), on, "left").select(
            *[placed[k] for k in keys], "weight", "near",
            F.explode(F.sequence(F.lit(0), F.coalesce("_shares", F.lit(1)) - 1)).alias("_share"),
            F.coalesce("_shares", F.lit(1)).alias("_shares"),
        )
        mine = F.filter("near", lambda e: F.pmod(F.xxhash64(e["item"]), F.col("_shares")) == F.col("_share"))
        placed = placed.withColumn("near", F.when(F.col("_shares") > 1, mine).otherwise(F.col("near")))
    terms = placed.select(*keys, "_share", "weight", "near").repartition(tasks, *keys, "_share").select(
        *keys, "_share", "weight", F.explode("near").alias("_e")
    ).select(*keys, "_share", F.col("_e.item").alias("item_id"), (F.col("weight") * F.col("_e.sim")).alias("term"))
    parts = [fixed_sum(F.col("term")).alias("score")]
    if mark_seen:
        parts.append(F.bool_or(F.col("term").isNull()).alias("_seen"))
    return terms.groupBy(*keys, "_share", "item_id").agg(*parts).drop("_share")


def candidates(history: DataFrame, sims: DataFrame, weight: Column, keys: list[str]) -> DataFrame:
    """Score of each similar item per user (or session): summed weight x similarity."""
    return _summed(_weights(history, weight, keys), sims, keys, False)


def exclude_seen(scored: DataFrame, history: DataFrame, keys: list[str]) -> DataFrame:
    """Candidates the user has not interacted with yet."""
    return scored.join(history.select(*keys, "item_id").distinct(), [*keys, "item_id"], "left_anti")


def fresh_candidates(
    history: DataFrame, sims: DataFrame, weight: Column, keys: list[str], only: DataFrame | None = None
) -> DataFrame:
    """Both at once: what was seen takes part in the aggregation as a mark, which saves a join.

    With `only`, for the keys it has.
    """
    weights = _weights(history, weight, keys)
    if only is not None:
        weights = weights.join(only.select(*keys), keys, "left_semi")
    return _summed(weights, sims, keys, True).filter(~F.col("_seen")).drop("_seen")


def _ranked(scored: DataFrame, keys: list[str], top_n: int) -> DataFrame:
    return ordered.top(scored, keys, [F.col("score").desc(), F.col("item_id")], top_n).select(
        *keys, "item_id", round_to(F.col("score"), 4).alias("score"), "rank"
    )


def recommend_cf(history: DataFrame, sims: DataFrame, top_n: int = 10, neighbors: int | None = None) -> DataFrame:
    """Items nearest to a user's history, every occurrence counted."""
    k = neighbors or SimilarityConfig().k_neighbors
    fresh = fresh_candidates(history, sims.filter(F.col("rank") <= k), F.lit(1.0), ["user_id"])
    return _ranked(fresh, ["user_id"], top_n).withColumn("source", F.lit("cf"))


def recommend_popular(users: DataFrame, popularity: DataFrame, top_n: int = 10) -> DataFrame:
    """The most popular items for users without a history.

    The list has `top_n` entries, whatever the size of the data, and goes to every
    user as one value.
    """
    best = similarity.popular_items(popularity, top_n)
    entries = best.agg(
        F.array_sort(F.collect_list(F.struct((-F.col("event_count")).alias("_order"), "item_id", "event_count")))
    ).scalar()
    return users.select("user_id", F.posexplode(entries).alias("_i", "_e")).select(
        "user_id",
        F.col("_e.item_id").alias("item_id"),
        (F.col("_e.event_count") / F.lit(1000.0)).alias("score"),
        (F.col("_i") + 1).alias("rank"),
        F.lit("popular").alias("source"),
    )


def recommend(users: DataFrame, history: DataFrame, sims: DataFrame, popularity: DataFrame, top_n: int = 10) -> DataFrame:
    """Similar items for users with a history, popular ones for the others."""
    new = users.join(history.select("user_id").distinct(), "user_id", "left_anti")
    return recommend_cf(history, sims, top_n).unionByName(recommend_popular(new, popularity, top_n))


def recommend_weighted(
    history: DataFrame, sims: DataFrame, config: RecommendConfig = RecommendConfig(), keys: list[str] | None = None
) -> DataFrame:
    """Top items by similarity weighted with the kind of interaction.

    Only for histories of at least `min_interactions` events.
    """
    keys = keys or ["user_id"]
    enough = history.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(
        F.col("_n") >= config.min_interactions
    )
    weight = interaction_weight(F.col("event_type"))
    fresh = fresh_candidates(history, sims, weight, keys, enough).filter(F.col("score") > 0)
    return _ranked(fresh, keys, config.top_k)


def cold_start(history: DataFrame, config: RecommendConfig = RecommendConfig(), keys: list[str] | None = None) -> DataFrame:
    """Placeholder items for users with too short a history."""
    keys = keys or ["user_id"]
    short = history.filter(has_text(F.col("user_id"))).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(
        F.col("_n") < config.min_interactions
    )
    slots = F.sequence(F.lit(0), F.lit(min(config.top_k, 5) - 1))
    return short.select(*keys, F.explode(slots).alias("_i")).select(
        *keys,
        F.concat(F.lit("popular_"), F.col("_i")).alias("item_id"),
        (F.lit(1.0) - F.col("_i") * F.lit(0.1)).alias("score"),
        (F.col("_i") + 1).alias("rank"),
    )


def cold_start_popular(
    history: DataFrame, popularity: DataFrame, config: RecommendConfig = RecommendConfig(), keys: list[str] | None = None
) -> DataFrame:
    """The same with the items that really are the most popular."""
    placeholders = cold_start(history, config, keys)
    best = similarity.popular_items(popularity, min(config.top_k, 5))
    ordered_ids = best.agg(
        F.array_sort(F.collect_list(F.struct((-F.col("event_count")).alias("_order"), "item_id")))
    ).scalar()
    return placeholders.withColumn("item_id", F.try_element_at(ordered_ids, F.col("rank")).getField("item_id")).filter(
        F.col("item_id").isNotNull()
    )


def session_results(
    sessions: DataFrame, sims: DataFrame | None, config: RecommendConfig = RecommendConfig()
) -> DataFrame:
    """Status, length and number of recommendations of each session.

    `sessions` are events with `session_id`. The user is that of the first event. With
    no similarities a session of `min_interactions` or more events gets nothing.
    """
    keys = ["session_id"]
    first = F.min_by("user_id", F.struct("timestamp", "event_id"))
    heads = sessions.groupBy(*keys).agg(first.alias("user_id"), F.count(F.lit(1)).alias("session_length"))
    status = F.when(has_text(F.col("user_id")), F.lit("success")).otherwise(F.lit("no_user"))
    heads = heads.withColumn("status", status)
    named = sessions.drop("user_id").join(
        heads.filter("status = 'success'").select("session_id", "user_id"), "session_id"
    )
    recommended = cold_start(named, config, keys)
    if sims is not None:
        recommended = recommended.unionByName(recommend_weighted(named, sims, config, keys))
    counts = recommended.groupBy(*keys).agg(F.count(F.lit(1)).alias("recommendations"))
    return heads.join(counts, keys, "left").na.fill(0, ["recommendations"])


def process_sessions(
    requested: DataFrame, events: DataFrame, sims: DataFrame | None, config: RecommendConfig = RecommendConfig()
) -> DataFrame:
    """The same for every requested session; one without events has the status `empty`."""
    results = session_results(events, sims, config)
    return requested.select("session_id").distinct().join(results, "session_id", "left").select(
        "session_id",
        F.coalesce("status", F.lit("empty")).alias("status"),
        "user_id",
        F.coalesce("session_length", F.lit(0)).alias("session_length"),
        F.coalesce("recommendations", F.lit(0)).alias("recommendations"),
    )


def evaluate(recommended: DataFrame, relevant: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """Mean precision and recall at k over users with relevant items, and catalog coverage."""
    truth = relevant.select("user_id", "item_id").distinct()
    listed = recommended.filter(F.col("rank") <= k)
    hits = listed.join(truth, ["user_id", "item_id"]).groupBy("user_id").agg(F.count(F.lit(1)).alias("hits"))
    wanted = truth.groupBy("user_id").agg(F.count(F.lit(1)).alias("relevant"))
    per_user = wanted.join(hits, "user_id", "left").na.fill(0, ["hits"])
    shown = listed.agg(F.count_distinct("item_id")).scalar()
    known = items.agg(F.count_distinct("item_id")).scalar()
    return per_user.agg(
        F.avg(F.col("hits") / F.lit(float(k))).alias("precision_at_k"),
        F.avg(F.col("hits") / F.col("relevant")).alias("recall_at_k"),
        F.count(F.lit(1)).alias("users"),
    ).withColumn("coverage", shown.cast("double") / known)
