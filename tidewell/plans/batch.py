"""Fraud, recommendation, inventory and lakehouse jobs from end to end, in batch."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell import config
from tidewell.operators import cache, fraud, lakehouse, similarity, stock
from tidewell.storage import write_once


def purchases(events: DataFrame) -> DataFrame:
    """Raw events to the purchase fact table; Catalyst sees the whole way."""
    return lakehouse.fact_purchases(lakehouse.events_clean(lakehouse.bronze_events(events)))


def daily_fraud(events: DataFrame, scores: DataFrame) -> DataFrame:
    bronze = lakehouse.bronze_events(events)
    return lakehouse.mart_fraud_daily(lakehouse.fraud_events(lakehouse.bronze_fraud(scores), bronze))


@dataclass
class RecommendationModel:
    vectors: DataFrame
    similarities: DataFrame
    popularity: DataFrame
    settings: config.SimilarityConfig


def train_recommendations(
    events: DataFrame, settings: config.SimilarityConfig = config.SimilarityConfig()
) -> RecommendationModel:
    """Vectors, similarities and popularity of all items."""
    vectors = write_once(similarity.item_vectors(events), "item-vectors")
    sims = write_once(similarity.similarities(vectors, settings, stored=True), "item-similarities")
    return RecommendationModel(vectors, sims, similarity.item_popularity(events), settings)


def save_recommendations(model: RecommendationModel, path: str) -> None:
    model.vectors.write.mode("overwrite").parquet(f"{path}/vectors")
    model.similarities.write.mode("overwrite").parquet(f"{path}/similarities")
    model.popularity.write.mode("overwrite").parquet(f"{path}/popularity")
    spark = model.vectors.sparkSession
    spark.range(1).select(
        F.lit(model.settings.k_neighbors).alias("k_neighbors"),
        F.lit(model.settings.min_common_users).alias("min_common_users"),
    ).write.mode("overwrite").parquet(f"{path}/settings")


def load_recommendations(spark: SparkSession, path: str) -> RecommendationModel | None:
    """The saved model, or None when there is none."""
    from pyspark.errors import AnalysisException

    try:
        row = spark.read.parquet(f"{path}/settings").first()
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return RecommendationModel(
        spark.read.parquet(f"{path}/vectors"),
        spark.read.parquet(f"{path}/similarities"),
        spark.read.parquet(f"{path}/popularity"),
        config.SimilarityConfig(row.k_neighbors, row.min_common_users),
    )


def recommendation_entries(recommended: DataFrame, written_at) -> DataFrame:
    """One cache entry per user with the ranked items, kept for an hour."""
    items = F.array_sort(F.collect_list(F.struct("rank", "item_id", "score")))
    per_user = recommended.groupBy("user_id").agg(items.alias("recommendations"))
    return cache.entries(
        per_user, F.concat(F.lit("recommendations:"), "user_id"), written_at, config.RECOMMENDATION_CACHE_TTL_S
    )


def fraud_entries(scored: DataFrame, written_at) -> DataFrame:
    """One cache entry per scored transaction, kept for a day."""
    return cache.entries(scored, F.concat(F.lit("fraud:score:"), F.col("event_id").cast("string")), written_at,
                         config.FRAUD_CACHE_TTL_S)


def inventory(history: DataFrame, forecasting: config.ForecastConfig = config.ForecastConfig()) -> DataFrame:
    """Forecast, runout and alert of each series."""
    return stock.full_alerts(stock.hybrid(history, forecasting))


def score_fraud(events: DataFrame, names: list[str], settings: config.FraudConfig = config.FraudConfig()) -> DataFrame:
    """Features to gated scores with the rule as the model."""
    rule = fraud.rule_score(F.col("amount"), F.col("events_5m").cast("double"), settings)
    return fraud.gate(events, names, rule, settings)
