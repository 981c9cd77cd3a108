"""User, item and session features; windows; fraud features."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidewell.config import FraudConfig
from tidewell.operators import fraud, fraud_features, lakehouse, profiles, windows

SCHEMA = "event_id string, user_id string, item_id string, event_type string, category string, price double, timestamp bigint"


def events(spark, data):
    return spark.createDataFrame([(f"e{i}", *row) for i, row in enumerate(data)], SCHEMA)


def test_user_features(spark):
    got = profiles.user_features(events(spark, [
        ("u1", "i1", "view", "c", None, 5), ("u1", "i2", "purchase", "c", 3.0, 9),
        ("u2", "i1", "transaction", None, 10.504, 0), ("u2", "", "transaction", "", None, 7), ("u2", "i1", None, "d", None, 3),
    ]))
    one, two = rows(got)[0], rows(got)[1]
    if one["user_id"] != "u1":
        one, two = two, one
    assert (one["total_interactions"], one["view_count"], one["purchase_count"], one["unique_items"]) == (2, 1, 0, 2)
    assert (one["first_activity"], one["last_activity"]) == (5, 9)
    # A missing type is a view, a timestamp of 0 and empty ids do not count, price is not multiplied.
    assert (two["view_count"], two["purchase_count"], two["unique_items"], two["unique_categories"]) == (1, 2, 1, 1)
    assert (two["total_spent"], two["first_activity"], two["conversion_rate"]) == (10.5, 3, 2.0)


def test_item_features(spark):
    got = rows(profiles.item_features(events(spark, [
        ("u1", "i1", "view", None, 0.0, 1), ("u2", "i1", "purchase", None, 4.0, 1), ("u2", "i1", "transaction", None, 5.0, 1),
        ("u1", "i2", "addtocart", None, None, 1),
    ])))
    by_item = {r["item_id"]: r for r in got}
    assert (by_item["i1"]["unique_users"], by_item["i1"]["avg_price"], by_item["i1"]["min_price"]) == (2, 4.5, 4.0)
    assert by_item["i1"]["popularity_score"] == pytest.approx(0.007)
    assert (by_item["i2"]["avg_price"], by_item["i2"]["max_price"]) == (0.0, 0.0)


def test_defaults(spark):
    users = spark.createDataFrame([("u1",), ("u9",)], "user_id string")
    features = profiles.user_features(events(spark, [("u1", "i1", "view", "c", None, 5)]))
    got = {r.user_id: r for r in profiles.users_with_defaults(users, features).collect()}
    assert got["u9"].is_new_user and got["u9"].total_interactions == 0 and got["u9"].first_activity is None
    assert not got["u1"].is_new_user and got["u1"].view_count == 1
    found = profiles.lookup_profiles(users, features, "user_id")
    assert {r.user_id: r.found for r in found.collect()} == {"u1": True, "u9": False}


def test_session_features(spark):
    got = rows(profiles.session_features(events(spark, [
        ("u1", "i1", "view", None, None, 100), ("u1", "i2", "addtocart", None, None, 350), ("u2", "i1", "view", None, None, 9),
    ]), ["user_id"]))
    by_user = {r["user_id"]: r for r in got}
    assert (by_user["u1"]["session_length"], by_user["u1"]["has_cart"], by_user["u1"]["has_purchase"]) == (2, True, False)
    assert by_user["u1"]["duration_seconds"] == 250 and by_user["u2"]["duration_seconds"] == 0


def test_panes_equal_sliding_windows(spark):
    rnd = random.Random(1)
    changes = spark.createDataFrame(
        [(f"i{rnd.randrange(3)}", "w", rnd.randrange(0, 4 * 86400000), rnd.randrange(-5, 5), float(rnd.randrange(90)))
         for _ in range(200)],
        "item_id string, warehouse_id string, timestamp bigint, quantity_change int, current_stock double",
    )
    a = windows.sliding_by_panes(changes)
    b = windows.sliding(windows.event_time(changes))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_event_features_by_brute_force(spark):
    rnd = random.Random(5)
    data = []
    for n in range(250):
        # One user has most of the events; times reach over all horizons.
        user = "hot" if n % 3 else f"u{rnd.randrange(4)}"
        stamp = rnd.choice([rnd.randrange(0, 3600000), rnd.randrange(0, 60 * 86400000), 150000 * rnd.randrange(9), 600000])
        kind = rnd.choice(["view", "addtocart", "transaction", "search"])
        price = round(rnd.uniform(1, 50), 2) if kind in ("transaction", "addtocart") else None
        data.append((user, f"i{rnd.randrange(6)}", kind, f"c{rnd.randrange(3)}", price, stamp))
    df = events(spark, data).withColumn("quantity", (F.length("item_id")).cast("int"))
    got = {r.event_id: r for r in fraud_features.event_features(df).collect()}
    assert len(got) == 250 and len(fraud_features.feature_names()) == 95
    for number, (user, _, _, _, price, stamp) in enumerate(data):
        row = got[f"e{number}"]
        for horizon, width in fraud_features.HORIZONS.items():
            frame = [e for e in data if e[0] == user and e[5] <= stamp
                     and (width is None or e[5] >= stamp - width * fraud_features.WINDOW_MS)]
            prices = [e[4] for e in frame if e[4] is not None]
            assert row[f"events_{horizon}"] == len(frame)
            assert row[f"items_{horizon}"] == len({e[1] for e in frame})
            assert row[f"categories_{horizon}"] == len({e[3] for e in frame})
            assert row[f"types_{horizon}"] == len({e[2] for e in frame})
            assert row[f"amount_sum_{horizon}"] == pytest.approx(sum(prices))
            assert row[f"amount_max_{horizon}"] == max(prices, default=0)
            assert row[f"amount_min_{horizon}"] == min(prices, default=0)
            spread = statistics.stdev(prices) if len(prices) > 1 else 0
            assert row[f"amount_std_{horizon}"] == pytest.approx(spread, abs=1e-6)
            assert row[f"carts_{horizon}"] == sum(e[2] == "addtocart" for e in frame)
            assert row[f"seconds_since_first_{horizon}"] == pytest.approx((stamp - min(e[5] for e in frame)) / 1000)
            mean = sum(prices) / len(prices) if prices else 0
            assert row[f"amount_ratio_{horizon}"] == pytest.approx((price or 0) / mean if mean else 0)


def test_features_do_not_look_ahead_and_keep_every_event(spark):
    rows = [("u", 1000), ("u", 200000), ("u", 310000), (None, 5), (None, 6), ("v", None)]
    df = events(spark, [(u, "i", "view", "c", None, ms) for u, ms in rows]).withColumn("quantity", F.lit(1))
    got = {r.event_id: r.events_5m for r in fraud_features.event_features(df).collect()}
    assert [got[f"e{n}"] for n in range(5)] == [1, 2, 2, 1, 2] and len(got) == 6



def test_gate(spark):
    df = spark.createDataFrame([(1, 100.0, 1, True), (2, 5000.0, 50, True), (3, 100.0, None, True), (4, 1.0, 1, False)],
                               "id int, amount double, velocity int, ok boolean")
    settings = FraudConfig(min_features=2)
    score = fraud.rule_score(F.col("amount"), F.col("velocity"))
    got = {r.id: (r.fraud_score, r.is_fraud, r.reason) for r in
           fraud.gate(df, ["amount", "velocity"], score, settings, F.col("ok")).collect()}
    assert got[1] == (pytest.approx(0.02), False, "scored") and got[2] == (1.0, True, "scored")
    assert got[3] == (0.0, False, "insufficient_features") and got[4] == (0.0, False, "invalid_input")
    default = {r.reason for r in fraud.gate(df, ["amount", "velocity"]).collect()}
    assert default == {"insufficient_features"}
    # The constant score is never above the default threshold.
    assert fraud.gate(df, ["amount"], config=FraudConfig(min_features=1)).filter("is_fraud").count() == 0


def test_forest(spark, tmp_path):
    rnd = random.Random(2)
    data = []
    for n in range(200):
        amount, velocity = rnd.uniform(0, 5000), rnd.randrange(50)
        data.append((n, amount, velocity, rnd.random(), n % 2, int(0.4 * amount / 5000 + 0.6 * velocity / 50 > 0.7)))
    df = spark.createDataFrame(data, "id int, amount double, velocity int, country_risk double, is_evening int, label int")
    model = fraud.train(df, FraudConfig(trees=10))
    fraud.save_model(model, str(tmp_path / "model"))
    loaded = fraud.load_model(str(tmp_path / "model"))
    a, b = (fraud.score(m, df).select("id", "prediction", "fraud_probability") for m in (model, loaded))
    assert a.exceptAll(b).count() == 0
    assert fraud.evaluate(fraud.score(loaded, df), "prediction").first().accuracy > 0.9
    assert fraud.load_model(str(tmp_path / "nothing")) is None and fraud.model_version(str(tmp_path / "nothing")) == "unknown"
    assert fraud.score(None, df).filter("prediction is not null").count() == 0


def test_lakehouse_cases(spark):
    raw = spark.createDataFrame(
        [("e1", "u", "purchase", "2024-01-02 00:00:00", "5", "2024-01-02 01:00:00"),
         ("e1", "u", "purchase", "2024-01-02 00:00:00", "6", "2024-01-02 02:00:00"),
         (None, "u", "view", "2024-01-02 00:00:00", "1", "2024-01-02 01:00:00"),
         ("e2", "u", "purchase", "2023-12-31 00:00:00", "7", "2024-01-02 01:00:00"),
         ("e3", "u", "purchase", "2024-01-03 00:00:00", "x", "2024-01-03 01:00:00")],
        "event_id string, user_id string, event_type string, timestamp string, event_data string, ingestion_timestamp string",
    ).withColumns({"ingestion_timestamp": F.col("ingestion_timestamp").cast("timestamp")})
    bronze = lakehouse.bronze_events(raw)
    facts = {r.transaction_id: r.amount for r in lakehouse.fact_purchases(lakehouse.events_clean(bronze)).collect()}
    assert facts == {"e1": 6.0, "e3": None}
    scores = spark.createDataFrame(
        [("e1", "u", 0.9, True, "2024-01-02"), ("e9", "u", 0.1, False, "2024-01-02")],
        "event_id string, user_id string, fraud_score double, is_fraud boolean, timestamp string",
    )
    joined = lakehouse.fraud_events(lakehouse.bronze_fraud(scores), bronze)
    assert sorted((r.event_id, r.amount) for r in joined.collect() if r.amount) == [("e1", 5.0), ("e1", 6.0)]
    daily = lakehouse.mart_fraud_daily(joined).first()
    assert (daily.total_transactions, daily.fraud_count, daily.fraud_rate, daily.total_fraud_amount) == (3, 2, 66.67, 11.0)


def test_velocity_keeps_every_event(spark):
    rows = [("u", 1000), ("u", 200000), ("u", 310000), (None, 5), (None, 6), ("v", None)]
    df = events(spark, [(u, "i", "view", "c", None, ms) for u, ms in rows])
    got = {r.event_id: r.velocity for r in windows.velocity(windows.event_time(df)).collect()}
    assert got == {"e0": 2, "e1": 2, "e2": 1, "e3": 2, "e4": 2, "e5": None}
