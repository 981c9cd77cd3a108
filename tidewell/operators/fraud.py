"""Fraud: event features, scores, gate, model, evaluation."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.config import FraudConfig
from tidewell.functions.scalars import clamp01, parse_double, parse_long, ratio


def basic_features(events: DataFrame) -> DataFrame:
    """Five features per event, defaults for what is absent.

    An event whose price or quantity is present but no number has no features and is
    left out.
    """
    price = F.col("price").cast("string")
    quantity = F.col("quantity").cast("string")
    amount, count = parse_double(price), parse_long(quantity)
    usable = (price.isNull() | amount.isNotNull()) & (quantity.isNull() | count.isNotNull())
    return events.filter(usable).select(
        *[name for name in ("event_id",) if name in events.columns],
        F.coalesce("user_id", F.lit("unknown")).alias("user_id"),
        F.coalesce("event_type", F.lit("unknown")).alias("event_type"),
        F.coalesce("timestamp", F.lit(0)).alias("timestamp"),
        F.coalesce(amount, F.lit(0.0)).alias("amount"),
        F.coalesce(count, F.lit(1)).alias("quantity"),
    )


def normalize(features: DataFrame, skip: tuple[str, ...] = ()) -> DataFrame:
    """Limit every numeric or boolean feature to 0..1; text stays as it is."""
    numeric = {"tinyint", "smallint", "int", "bigint", "float", "double", "boolean"}
    return features.select([
        clamp01(F.col(name)).alias(name)
        if (kind in numeric or kind.startswith("decimal")) and name not in skip else F.col(name)
        for name, kind in features.dtypes
    ])


def rule_score(amount: Column, velocity: Column, config: FraudConfig = FraudConfig()) -> Column:
    return F.lit(config.amount_weight) * amount / F.lit(config.amount_scale) + F.lit(
        config.velocity_weight
    ) * velocity / F.lit(config.velocity_scale)


def with_rule_score(df: DataFrame, config: FraudConfig = FraudConfig()) -> DataFrame:
    """Add the rule's score, and its label: above the cutoff."""
    return df.withColumn("fraud_score", rule_score(F.col("amount"), F.col("velocity"), config)).withColumn(
        "is_fraud", F.col("fraud_score") > config.label_cutoff
    )


def gate(
    df: DataFrame, names: list[str], score: Column | None = None, config: FraudConfig = FraudConfig(),
    valid: Column | None = None,
) -> DataFrame:
    """Score rows that have enough features.

    `names` are the feature columns; one counts when it is not null. `valid` marks rows
    that are feature records at all. Without a score every row gets the constant 0.5.
    """
    score = F.lit(0.5) if score is None else score
    valid = F.lit(True) if valid is None else F.coalesce(valid, F.lit(False))
    present = sum((F.col(name).isNotNull().cast("int") for name in names), F.lit(0))
    enough = valid & (present >= config.min_features)
    return df.withColumns({
        "feature_count": present,
        "fraud_score": F.when(enough, score.cast("double")).otherwise(F.lit(0.0)),
        "is_fraud": F.when(enough, F.coalesce(score > config.threshold, F.lit(False))).otherwise(F.lit(False)),
        "reason": F.when(~valid, F.lit("invalid_input"))
        .when(present < config.min_features, F.lit("insufficient_features"))
        .otherwise(F.lit("scored")),
    })


def alerts(scored: DataFrame) -> DataFrame:
    """Transactions to hold for review."""
    return scored.filter("is_fraud")


def model_inputs(df: DataFrame, config: FraudConfig = FraudConfig()) -> DataFrame:
    """Add the feature vector, in the fixed order of the configuration."""
    return VectorAssembler(inputCols=config.inputs, outputCol="features", handleInvalid="keep").transform(df)


def train(training: DataFrame, config: FraudConfig = FraudConfig()) -> PipelineModel:
    """A random forest on the configured inputs; `label` is 0 or 1."""
    forest = RandomForestClassifier(
        numTrees=config.trees, maxDepth=config.depth, seed=config.seed, labelCol="label", featuresCol="features",
    )
    assembler = VectorAssembler(inputCols=config.inputs, outputCol="features")
    return Pipeline(stages=[assembler, forest]).fit(training)


def score(model: PipelineModel | None, df: DataFrame) -> DataFrame:
    """Predicted class and probability of fraud; null without a model."""
    if model is None:
        return df.withColumns({
            "prediction": F.lit(None).cast("double"), "fraud_probability": F.lit(None).cast("double"),
        })
    scored = model.transform(df)
    return scored.withColumn("fraud_probability", vector_to_array("probability")[1]).drop(
        "features", "rawPrediction", "probability"
    )


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel | None:
    """The saved model, or None when there is none."""
    return PipelineModel.load(path) if _saved_at(path) is not None else None


def _saved_at(path: str) -> int | None:
    """When the model at `path` was saved, in epoch milliseconds; None when there is none."""
    try:
        lines = SparkSession.active().read.text(f"{path}/metadata")
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return lines.select(F.get_json_object("value", "$.timestamp").cast("bigint")).first()[0]


def model_version(path: str) -> str:
    """Name of a saved model: its version and the second it was saved in, `unknown` without one."""
    saved = _saved_at(path)
    return f"v1.0_{saved // 1000}" if saved is not None else "unknown"


def evaluate(scored: DataFrame, predicted: str = "is_fraud", actual: str = "label") -> DataFrame:
    """Confusion counts, precision, recall and accuracy."""
    said, real = F.col(predicted).cast("boolean"), F.col(actual).cast("boolean")
    counts = scored.agg(
        F.count_if(said & real).alias("true_positives"),
        F.count_if(said & ~real).alias("false_positives"),
        F.count_if(~said & real).alias("false_negatives"),
        F.count_if(~said & ~real).alias("true_negatives"),
    )
    tp, fp, fn, tn = (F.col(name) for name in counts.columns)
    return counts.withColumns({
        "precision": ratio(tp, tp + fp),
        "recall": ratio(tp, tp + fn),
        "accuracy": ratio(tp + tn, tp + fp + fn + tn),
    })
