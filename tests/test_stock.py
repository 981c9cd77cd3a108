"""Series features, forecasts, alerts, cache."""

import statistics

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidewell import config
from tidewell.catalogue.tables import Tables
from tidewell.operators import cache, series, stock

SCHEMA = "item_id string, warehouse_id string, timestamp bigint, change_id string, current_stock double"


def points(spark, **levels):
    data = [
        (item, "w", n * 86400000, f"{n:04d}", float(v)) for item, values in levels.items() for n, v in enumerate(values)
    ]
    return spark.createDataFrame(data, SCHEMA).repartition(3)


def by_item(df):
    return {r.item_id: r for r in df.collect()}


def test_features(spark):
    levels = {"a": [100, 105, 110, 95, 90], "b": [100, 105, 110, 115, 120], "c": [5], "d": [0, 4],
              "e": [9, 8, 7, 6, 5, 4, 3, 2, 30, 1]}
    got = by_item(series.features(points(spark, **levels)))
    assert (got["b"].is_increasing, got["b"].trend, got["b"].velocity) == (1, pytest.approx(0.2), 5)
    assert got["b"].avg_velocity == 5 and got["b"].volatility == 0
    assert got["a"].avg is None and got["c"].trend is None and got["d"].std_dev is None
    assert got["d"].trend == 0 and got["d"].volatility == 0 and got["d"].max_velocity == 4
    last, steps = levels["e"][-7:], [b - a for a, b in zip(levels["e"], levels["e"][1:])]
    assert (got["e"].avg, got["e"].median, got["e"].range) == (pytest.approx(statistics.mean(last)), statistics.median(last), 29)
    assert got["e"].volatility == pytest.approx(statistics.stdev(steps))
    assert got["e"].cv == pytest.approx(statistics.stdev(levels["e"]) / statistics.mean(levels["e"]))


def test_history_of_five(spark):
    got = by_item(series.history_features(points(spark, a=[100, 105, 110, 95, 90]), 5))["a"]
    assert (got.avg, got.min, got.max, got.median, got.range) == (100, 90, 110, 100, 20)


def test_extended_features(spark):
    got = series.extended_features(points(spark, a=range(40, 0, -1)))
    assert len(got.columns) >= 50
    row = got.first()
    assert (row.lag_1, row.lag_14, row.min_30, row.slope_7) == (2, 15, 1, pytest.approx(-1))


def test_forecast(spark):
    got = by_item(stock.forecast(points(spark, up=[100 + 2 * i for i in range(30)], short=[100, 105, 110],
                                        out=[100, 80, 60, 50, 30, 20, 10, 5, 0, -10, -20])))
    up = got["up"]
    assert up.forecast == pytest.approx(list(range(146, 160, 2))) and up.accuracy == pytest.approx(0.86)
    assert up.confidence_lower == pytest.approx([0.85 * v for v in up.forecast]) and up.runout_date == "N/A"
    assert up.confidence_upper == pytest.approx([1.15 * v for v in up.forecast])
    short = got["short"]
    assert (short.forecast, short.confidence_lower, short.runout_date, short.accuracy) == ([], [], "N/A", 0)
    # The last seven are 30 .. -20; the first not above zero is the fifth of them. Negative bands turn around.
    assert got["out"].runout_date == "1970-01-15" and got["out"].confidence_lower[-1] == pytest.approx(min(-20 * 0.9, -20 * 0.85))


def test_short_components(spark):
    got = by_item(stock.component_forecast(points(spark, a=[1, 2, 3]), "a"))["a"]
    assert got.forecast == got.lower == got.upper == [1, 2, 3] and got.accuracy == 0.87


def test_runout(spark):
    df = spark.createDataFrame([([100.0, 80.0, 60.0, 40.0, 20.0, 0.0, -10.0],), ([100.0, 110.0, 130.0],)], "v array<double>")
    got = [r.i for r in df.select(stock.runout_index(F.col("v")).alias("i")).collect()]
    assert got == [5, None]
    date = df.select(stock.runout_date(F.col("v"), F.lit("2024-01-01").cast("timestamp")).alias("d")).collect()
    assert [r.d for r in date] == ["2024-01-06", "N/A"]


@pytest.mark.parametrize("levels, alert", [
    ([500, 480, 450], False), ([50, 45, 40], True), ([20, 15, 10], True), ([500, 510, 520], False), ([100], False),
])
def test_alerts(spark, levels, alert):
    df = points(spark, a=levels)
    assert stock.alerts(df).first().alert is alert
    echo = stock.last_forecast(df).first()
    assert echo.alert is alert and echo.forecast_values == levels[-7:]


def test_hybrid_and_reorder(spark):
    df = points(spark, line=range(300, 180, -6), flat=[500] * 12, short=[1, 2])
    got = by_item(stock.hybrid(df))
    assert set(got) == {"line", "flat"}
    assert got["line"].forecast == pytest.approx([186 - 6 * h for h in range(1, 8)])
    assert got["flat"].forecast == pytest.approx([500] * 7) and got["flat"].runout_days is None
    policy = spark.createDataFrame([("line", 200.0, None)], "item_id string, reorder_point double, lead_time_days int")
    checked = by_item(stock.reorder_check(stock.hybrid(df), policy))
    assert checked["line"].reorder and not checked["flat"].reorder and checked["line"].lead_time_days == 7


def test_holdout(spark):
    got = by_item(stock.holdout_accuracy(points(spark, line=range(300, 100, -6))))
    assert got["line"].accuracy == pytest.approx(1.0) and got["line"].points == 7


def test_balance(spark):
    df = spark.createDataFrame(
        [("i", "w", 1, "a", 5, 2, 7), ("i", "w", 2, "b", 7, -3, 5)],
        "item_id string, warehouse_id string, timestamp bigint, change_id string, quantity_before int, quantity_change int, quantity_after int",
    )
    assert [r.change_id for r in stock.balance_errors(df).collect()] == ["b"]
    assert stock.stock_levels(df).first().quantity_after == 5


def entries(spark, *keys, at="2024-01-01 00:00:00"):
    df = spark.createDataFrame([(k, w) for k, w in keys], "item_id string, warehouse_id string")
    return cache.entries(df, cache.forecast_key(F.col("item_id"), F.col("warehouse_id")), F.lit(at).cast("timestamp"))


def test_cache(spark):
    old = entries(spark, ("sku-001", "wh-01"), ("sku-002", "wh-02"), ("sku-003", "wh-01"))
    assert old.select("key").distinct().count() == 3
    assert old.filter("unix_seconds(expires_at) - unix_seconds(written_at) = 604800").count() == 3
    new = entries(spark, ("sku-001", "wh-01"), at="2024-01-05 00:00:00")
    table = cache.upsert(old, new)
    assert table.count() == 3
    asked = spark.createDataFrame(
        [("inventory:forecast:sku-001:wh-01", "2024-01-09"), ("inventory:forecast:sku-002:wh-02", "2024-01-09"),
         ("inventory:forecast:sku-003:wh-01", "2024-01-07"), ("nothing", "2024-01-07")], "key string, at string",
    ).withColumn("requested_at", F.col("at").cast("timestamp"))
    found = cache.lookup(asked, table)
    assert {r.key[-12:]: (r.hit, r.expired) for r in found.collect()} == {
        "ku-001:wh-01": (True, False), "ku-002:wh-02": (False, True), "ku-003:wh-01": (True, False), "nothing": (False, False)
    }
    stats = cache.stats(found).first()
    assert (stats.hits, stats.misses, stats.hit_rate, stats.evictions) == (2, 2, 50.0, 1)
    hits = spark.range(100).select((F.col("id") < 80).alias("hit"), F.lit(False).alias("expired"))
    assert cache.stats(hits).first().hit_rate == 80.0
    assert cache.stats(hits.limit(0)).first().hit_rate == 0.0


def test_trend_sums_take_any_order(spark):
    df = points(spark, a=range(50, 10, -2))
    one = stock.project_trend(stock.trend_sums(df)).first()
    two = stock.project_trend(stock.trend_sums(df.orderBy(F.col("timestamp").desc()))).first()
    assert one == two and one.forecast == pytest.approx([10.0, 8.0, 6.0, 4.0, 2.0, 0.0, -2.0]) and one.runout_days == 5
    assert config.ForecastConfig().weight_a + config.ForecastConfig().weight_b == 1


def exchanges(df):
    """Shuffles of rows in the plan, before any of it ran."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning") + plan.count("Exchange rangepartitioning") + plan.count("Exchange SinglePartition")


def test_series_are_shuffled_once(spark, folder):
    table = Tables(spark, folder)
    for found in (
        series.features(table.stock), series.extended_features(table.stock), series.last_values(table.stock, 7),
        stock.holdout_accuracy(table.stock), stock.hybrid(table.stock),
    ):
        assert exchanges(found) == 1


def test_place_from_the_end_in_chunks(spark):
    changes = spark.createDataFrame(
        [(f"c{i:03}", i // 3, "a" if i % 4 else "b", "w", 1) for i in range(60)],
        "change_id string, timestamp bigint, item_id string, warehouse_id string, quantity_change int",
    )
    whole = series.with_running_stock(changes, 0)
    cut = series.with_running_stock(changes, 0, max_rows=10, chunk_rows=7)
    assert rows(whole) == rows(cut)
    assert {r["age"] for r in whole.filter("item_id = 'b'").collect()} == set(range(1, 16))
