"""Chunked ordered computations equal plain windows, also when one key has most rows."""

import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewell.functions import ordered
from tidewell.functions.scalars import last_of, median_of
from tidewell.operators import profiles, series


@pytest.fixture(scope="module")
def skewed(spark):
    """Key a has a third of all rows; keys and times may be null, times tie."""
    rnd = random.Random(7)
    data = [(key, None, -n, n) for n in range(1, 4) for key in ("a", None, "k1")]
    data += [(None, 7, -4, 2), ("a", 0, -5, None), ("a", 0, -6, None)]
    for n in range(900):
        key = "a" if n % 3 == 0 else f"k{rnd.randrange(20)}"
        data.append((key, rnd.randrange(0, 40 * ordered.HOUR_MS, 300000), n, rnd.randrange(-5, 9)))
    return spark.createDataFrame(data, "k string, ms bigint, id bigint, v bigint").repartition(7)


@pytest.mark.parametrize("max_rows,chunk_rows", [(0, 5), (0, 100), (60, 40), (10_000, 40)])
def test_scan(skewed, max_rows, chunk_rows):
    got = ordered.scan(
        skewed, ["k"], ["ms", "id"],
        previous={"pv": "v", "pm": "ms"}, total={"s": F.col("v")}, index="i", max_rows=max_rows, chunk_rows=chunk_rows,
    )
    w = W.partitionBy("k").orderBy("ms", "id")
    run = w.rowsBetween(W.unboundedPreceding, 0)
    want = skewed.select(
        "*", F.lag("v").over(w).alias("pv"), F.lag("ms").over(w).alias("pm"),
        F.sum("v").over(run).alias("s"), (F.row_number().over(w) - 1).cast("bigint").alias("i"),
    )
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


@pytest.mark.parametrize("max_rows,chunk_rows", [(0, 2), (0, 100), (60, 40), (10_000, 40)])
def test_sessions(spark, skewed, max_rows, chunk_rows):
    got = ordered.sessions(skewed, ["k"], "ms", 30 * 60 * 1000, max_rows=max_rows, chunk_rows=chunk_rows)
    assert got.count() == skewed.count()
    assert got.filter("ms IS NULL AND session_start IS NOT NULL OR ms IS NOT NULL AND session_start IS NULL").count() == 0
    got = got.filter("ms IS NOT NULL")
    counted = got.groupBy("k", "session_start").agg(F.count("*").alias("n"))
    want = skewed.groupBy("k", F.session_window(F.timestamp_millis("ms"), "30 minutes")).agg(F.count("*").alias("n"))
    want = want.select("k", F.unix_millis("session_window.start").alias("session_start"), "n")
    assert counted.exceptAll(want).count() == 0 and want.exceptAll(counted).count() == 0


def test_session_border(spark):
    """An event exactly the gap later belongs to the session, one later does not."""
    gap = 30 * 60 * 1000
    events = spark.createDataFrame(
        [("u", 1000, "e1"), ("u", 1000 + gap, "e2"), ("u", 1001 + 2 * gap, "e3")],
        "user_id string, timestamp bigint, event_id string",
    )
    for max_rows in (0, 100):
        got = {r.event_id: r.session_start for r in profiles.user_sessions(events, max_rows=max_rows).collect()}
        assert got == {"e1": 1000, "e2": 1000, "e3": 1001 + 2 * gap}


def test_large_series_equal_small_ones(spark):
    rnd = random.Random(3)
    data = [("i1" if n % 2 else "i2", "w" if n % 4 else None, n // 100 * 3600000, f"{n:05d}", rnd.randrange(-9, 9)) for n in range(400)]
    data += [("i1", "w", None, "x1", 1), ("i1", "w", None, "x2", 2), (None, None, None, "x3", 2)]
    changes = spark.createDataFrame(
        data, "item_id string, warehouse_id string, timestamp bigint, change_id string, quantity_change int"
    )
    a = series.with_running_stock(changes, 100)
    b = series.with_running_stock(changes, 100, max_rows=10, chunk_rows=7)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert a.filter("i = 0").filter("previous is not null").count() == 0


def test_top_prunes_before_the_shuffle(skewed):
    best = ordered.top(skewed, ["k"], [F.col("v").desc(), F.col("id")], 3)
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert best.groupBy("k").count().filter("count > 3").count() == 0


def test_arrays(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0],), ([5.0, 4.0],), ([],)], "a array<double>")
    got = df.select(last_of(F.col("a"), 2).alias("l"), median_of(F.col("a")).alias("m")).collect()
    assert [r.l for r in got] == [[2.0, 3.0], [5.0, 4.0], []]
    assert [r.m for r in got] == [2.0, 4.5, None]
