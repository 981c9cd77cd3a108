"""Fraud features, scores, models and their evaluation."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidewell.catalogue.registry import query, rnd
from tidewell.catalogue.tables import Tables
from tidewell.config import FraudConfig
from tidewell.functions.scalars import round_to
from tidewell.operators import fraud, fraud_features
from tidewell.plans import batch
from tidewell.session import WIDE_ROWS
from tidewell.storage import new_path


def rounded(df, *names, digits: int = 6):
    return df.withColumns({name: round_to(F.col(name), digits) for name in names})


@query("fraud_rule_score", f"SELECT event_id, {rnd('fraud_score')} AS fraud_score, is_fraud FROM fraud_scores")
def _(t: Tables):
    scored = fraud.with_rule_score(t.fraud_scores.select("event_id", "amount", "velocity"))
    return rounded(scored.select("event_id", "fraud_score", "is_fraud"), "fraud_score")


GATED = ["amount", "velocity", "country_risk", "is_evening"]


def gaps(t: Tables):
    """Scores of calm transactions lack two features; those without speed are no records at all."""
    calm = F.col("amount") < 500
    return t.fraud_scores.withColumns({
        "country_risk": F.when(~calm, F.col("country_risk")), "is_evening": F.when(~calm, F.col("is_evening")),
    })


@query("fraud_gate", f"""
SELECT event_id, CASE WHEN velocity > 0 AND amount >= 500 THEN {rnd('fraud_score')} ELSE 0 END AS fraud_score,
       velocity > 0 AND amount >= 500 AND fraud_score > 0.85::DOUBLE AS is_fraud,
       CASE WHEN velocity = 0 THEN 'invalid_input' WHEN amount < 500 THEN 'insufficient_features' ELSE 'scored' END AS reason
FROM fraud_scores
""")
def _(t: Tables):
    rows = gaps(t)
    settings = FraudConfig(min_features=4)
    gated = fraud.gate(rows, GATED, fraud.rule_score(F.col("amount"), F.col("velocity")), settings, F.col("velocity") > 0)
    return rounded(gated.select("event_id", "fraud_score", "is_fraud", "reason"), "fraud_score")


@query("fraud_score_constant", "SELECT event_id, 0.5::DOUBLE AS fraud_score, false AS is_fraud FROM fraud_scores")
def _(t: Tables):
    gated = fraud.gate(t.fraud_scores, GATED, config=FraudConfig(min_features=4))
    return gated.select("event_id", "fraud_score", "is_fraud")


@query("fraud_alerts", f"SELECT event_id, user_id, {rnd('fraud_score')} AS fraud_score FROM fraud_scores WHERE is_fraud")
def _(t: Tables):
    return rounded(fraud.alerts(t.fraud_scores).select("event_id", "user_id", "fraud_score"), "fraud_score")


@query("model_input_vector", """
SELECT event_id, amount AS f0, velocity::DOUBLE AS f1, country_risk AS f2, is_evening::DOUBLE AS f3 FROM fraud_scores
""")
def _(t: Tables):
    vector = vector_to_array("features")
    rows = fraud.model_inputs(t.fraud_scores).withColumn("_v", vector)
    return rows.select("event_id", *[F.col("_v")[i].alias(f"f{i}") for i in range(4)])


@query("fraud_eval", f"""
WITH c AS (SELECT count(*) FILTER (WHERE amount > 2500 AND is_fraud) AS tp, count(*) FILTER (WHERE amount > 2500 AND NOT is_fraud) AS fp,
                  count(*) FILTER (WHERE amount <= 2500 AND is_fraud) AS fn, count(*) FILTER (WHERE amount <= 2500 AND NOT is_fraud) AS tn
           FROM fraud_scores)
SELECT tp AS true_positives, fp AS false_positives, fn AS false_negatives, tn AS true_negatives,
       {rnd('CASE WHEN tp + fp = 0 THEN 0 ELSE tp::DOUBLE / (tp + fp) END')} AS "precision",
       {rnd('CASE WHEN tp + fn = 0 THEN 0 ELSE tp::DOUBLE / (tp + fn) END')} AS recall,
       {rnd('(tp + tn)::DOUBLE / (tp + fp + fn + tn)')} AS accuracy FROM c
""")
def _(t: Tables):
    judged = t.fraud_scores.withColumn("is_fraud", F.col("amount") > 2500)
    return rounded(fraud.evaluate(judged), "precision", "recall", "accuracy")


def samples(t: Tables):
    """Four fifths of the scored purchases to train on, and the others to judge by."""
    rows = t.fraud_scores.select("event_id", "label", *FraudConfig().inputs)
    kept = F.col("event_id").cast("bigint") % 5 == 0
    return rows.filter(~kept), rows.filter(kept)


JUDGED = "FROM fraud_scores WHERE CAST(event_id AS BIGINT) % 5 = 0"


# SQL grows no forest. What it can say: which rows are judged, their labels, and how the outputs relate.
@query("fraud_rf_train", f"""
SELECT count(*) FILTER (WHERE label = 1) AS frauds, count(*) FILTER (WHERE label = 0) AS others, true AS accurate {JUDGED}
""")
def _(t: Tables):
    training, judged = samples(t)
    found = fraud.evaluate(fraud.score(fraud.train(training), judged), "prediction")
    return found.select(
        (F.col("true_positives") + F.col("false_negatives")).alias("frauds"),
        (F.col("true_negatives") + F.col("false_positives")).alias("others"),
        (F.col("accuracy") >= 0.9).alias("accurate"),
    )


@query("fraud_rf_score", f"""
SELECT event_id, label, true AS within, true AS agrees {JUDGED}
""")
def _(t: Tables):
    training, judged = samples(t)
    chance = F.col("fraud_probability")
    return fraud.score(fraud.train(training), judged).select(
        "event_id", "label", chance.between(0, 1).alias("within"),
        (F.col("prediction").cast("boolean") == (chance > 0.5)).alias("agrees"),
    )


@query("ml_model_save_load", f"SELECT event_id, true AS same, true AS named {JUDGED}")
def _(t: Tables):
    path = new_path(t.spark, "fraud-model")
    training, judged = samples(t)
    model = fraud.train(training, FraudConfig(trees=20))
    fraud.save_model(model, path)
    first = fraud.score(model, judged).select("event_id", F.col("fraud_probability").alias("before"))
    again = fraud.score(fraud.load_model(path), judged).select("event_id", "fraud_probability")
    return again.join(first, "event_id").select(
        "event_id", (F.col("before") == F.col("fraud_probability")).alias("same"),
        F.lit(fraud.model_version(path)).rlike(r"^v1\.0_\d{10}$").alias("named"),
    )


def features_sql() -> str:
    parts = []
    for name, width in fraud_features.HORIZONS.items():
        inside = "true" if width is None else f"b.ms >= a.at - {width * fraud_features.WINDOW_MS}"

        def agg(call: str, extra: str = "true") -> str:
            return f"{call} FILTER (WHERE {inside} AND {extra})"

        n, total = agg("count(c)"), agg("sum(c)") + "::DOUBLE"
        squares = agg("sum(c::HUGEINT * c)") + "::DOUBLE"
        parts += [
            f"{agg('count(*)')} AS events_{name}",
            f"{agg('count(*)', chr(39).join(['event_type = ', 'transaction', '']))} AS transactions_{name}",
            f"coalesce({total} / 100, 0) AS amount_sum_{name}",
            f"coalesce({total} / 100 / nullif({n}, 0), 0) AS amount_avg_{name}",
            f"coalesce({agg('min(c)')} / 100.0::DOUBLE, 0) AS amount_min_{name}",
            f"coalesce({agg('max(c)')} / 100.0::DOUBLE, 0) AS amount_max_{name}",
            f"""CASE WHEN {n} > 1 THEN sqrt(greatest(0.0::DOUBLE, {squares} - {total} * {total} / nullif({n}, 0))
                / nullif({n} - 1, 0)) / 100 ELSE 0 END AS amount_std_{name}""",
            f"{agg('count(DISTINCT item_id)')} AS items_{name}",
            f"{agg('count(DISTINCT category)')} AS categories_{name}",
            f"{agg('count(DISTINCT event_type)')} AS types_{name}",
            f"coalesce({agg('sum(quantity)')}::DOUBLE / {agg('count(*)')}, 0) AS quantity_avg_{name}",
            f"{agg('count(*)', chr(39).join(['event_type = ', 'addtocart', '']))} AS carts_{name}",
            f"{agg('count(*)', chr(39).join(['event_type = ', 'search', '']))} AS searches_{name}",
            f"{agg('min(ms)')} AS first_{name}",
        ]
    final = []
    for name in fraud_features.HORIZONS:
        for metric in fraud_features.METRICS:
            column = f"{metric}_{name}"
            if metric == "seconds_since_first":
                final.append(f"{rnd(f'(ms - first_{name})::DOUBLE / 1000', 4)} AS {column}")
            elif metric == "amount_ratio":
                final.append(f"{rnd(f'''CASE WHEN amount_avg_{name} = 0 THEN 0 ELSE coalesce(price, 0)
                                    / amount_avg_{name} END''', 4)} AS {column}")
            elif metric.startswith("amount") or metric == "quantity_avg":
                final.append(f"{rnd(column, 4)} AS {column}")
            else:
                final.append(column)
    return f"""
WITH e AS (SELECT *, "timestamp" AS ms, CAST(floor(price * 100 + 0.5) AS BIGINT) AS c
           FROM ix_events),
     f AS (SELECT a.who, a.at, {', '.join(parts)}
           FROM (SELECT DISTINCT user_id AS who, ms AS at FROM e) a JOIN e b ON a.who = b.user_id AND b.ms <= a.at GROUP BY 1, 2)
SELECT event_id, e.user_id, event_type, "timestamp", coalesce(price, 0) AS amount, quantity, {', '.join(final)}
FROM e JOIN f ON f.who = e.user_id AND f.at = e.ms
"""


def rounded_features(df):
    noisy = [
        f"{metric}_{name}" for name in fraud_features.HORIZONS for metric in fraud_features.METRICS
        if metric.startswith("amount") or metric in ("quantity_avg", "seconds_since_first")
    ]
    return rounded(df, *noisy, digits=4)


@query("event_feature_families", features_sql(), settings=WIDE_ROWS)
def _(t: Tables):
    return rounded_features(fraud_features.event_features(t.events))


@query("fraud_gate_full", f"""
WITH s AS (SELECT a.event_id, 0.4::DOUBLE * coalesce(any_value(a.price), 0) / 5000.0::DOUBLE + 0.6::DOUBLE * count(*) / 50.0::DOUBLE AS score
           FROM ix_events a JOIN ix_events b ON a.user_id = b.user_id AND b."timestamp" BETWEEN a."timestamp" - 300000 AND a."timestamp"
           GROUP BY 1)
SELECT event_id, 95 AS feature_count, {rnd("score")} AS fraud_score, score > 0.85::DOUBLE AS is_fraud, 'scored' AS reason FROM s
""", settings=WIDE_ROWS)
def _(t: Tables):
    features = fraud_features.event_features(t.events)
    scored = batch.score_fraud(features, fraud_features.feature_names())
    return rounded(scored.select("event_id", "feature_count", "fraud_score", "is_fraud", "reason"), "fraud_score")
