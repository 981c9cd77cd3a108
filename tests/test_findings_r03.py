"""Cases the third round's findings named."""

import json
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from tests.compare import connect, difference
from tidewell.catalogue.tables import Tables
from tidewell.llm import simhash
from tidewell.operators import fraud_features, recommend, similarity, windows
from tidewell.streaming import sinks

TABLES = ("events", "customer", "supplier", "part", "orders", "lineitem")


@pytest.fixture
def changed(folder, tmp_path):
    """A copy of the tables in which one is what an SQL text over it gives."""

    def copy(table, sql):
        for name in TABLES:
            text = sql if name == table else "SELECT * FROM given"
            con = duckdb.connect()
            con.execute(f"CREATE VIEW given AS SELECT * FROM '{folder}/{name}.parquet'")
            con.execute(f"COPY ({text}) TO '{tmp_path}/{name}.parquet' (FORMAT parquet)")
        return str(tmp_path)

    return copy


def test_series_too_short_for_a_forecast(spark, changed):
    # An item in three keeps one line of an order only: fewer points than a forecast needs.
    folder = changed("lineitem", "SELECT * FROM given WHERE l_partkey < 12 AND (l_partkey % 3 > 0 OR l_linenumber = 1)")
    name = "stream_inventory_forecast"
    got = queries()[name](spark, folder)
    assert got.filter("n < 10").count() > 0
    assert difference(got, connect(folder), oracle_sql()[name])[0] is None


def test_events_without_time_are_on_one_side_of_the_middle(spark, changed):
    folder = changed("events", "SELECT * REPLACE (CASE WHEN event_id % 7 = 0 THEN NULL ELSE ts END AS ts) FROM given")
    name = "unified_query"
    got = queries()[name](spark, folder)
    assert got.filter("metric_date IS NULL").count() == 1
    assert difference(got, connect(folder), oracle_sql()[name])[0] is None


def test_pairs_take_as_many_tasks_as_they_need(spark, monkeypatch):
    # 30 users of 8 items out of 200, one user of 90: most pairs of items have one user or none.
    rows = [(f"i{(u * 37 + k * k * 11) % 200}", f"u{u}", 1.0 + k) for u in range(30) for k in range(8)]
    rows += [(f"i{k * 2}", "many", 2.0) for k in range(90)]
    vectors = spark.createDataFrame(list({(i, u): (i, u, r) for i, u, r in rows}.values()), "item_id string, user_id string, rating double")
    monkeypatch.setattr(similarity, "PAIRS_PER_TASK", 500)
    monkeypatch.setattr(similarity, "LIST_CELLS", 7)
    got = similarity.pair_overlaps(vectors, min_common=1)
    assert "hashpartitioning(first" in got._jdf.queryExecution().toString()
    users = {}
    for item, user, rating in vectors.collect():
        users.setdefault(user, []).append((item, rating))
    want = {}
    for mine in users.values():
        for a, x in mine:
            for b, y in mine:
                if a < b:
                    dot, common = want.get((a, b), (0.0, 0))
                    want[a, b] = dot + x * y, common + 1
    assert {(r["item_a"], r["item_b"]): (r["dot"], r["common"]) for r in got.collect()} == want


def test_terms_are_summed_where_their_history_is(spark, monkeypatch):
    monkeypatch.setattr(recommend, "TERMS_PER_TASK", 20)
    history = [(f"u{u}", f"i{k}", "view") for u in range(6) for k in range(u, 10)] + [(None, "i1", "view")]
    history = spark.createDataFrame(history, "user_id string, item_id string, event_type string")
    sims = spark.createDataFrame(
        [(f"i{a}", f"i{b}", 1.0 / (1 + a + b), 1) for a in range(9) for b in range(12) if a != b],
        "item_id string, similar_item string, sim double, rank int",
    )
    want, seen = {}, {(r["user_id"], r["item_id"]) for r in history.collect()}
    for user, item in seen:
        for r in sims.filter(F.col("item_id") == item).collect():
            key = user, r["similar_item"]
            want[key] = want.get(key, 0) + int(r["sim"] * 1e9 + 0.5)
    got = recommend.candidates(history, sims, F.lit(1.0), ["user_id"])
    # Terms are not sent once more after the histories have met.
    assert got._jdf.queryExecution().executedPlan().toString().count("REPARTITION_BY_NUM") == 1
    assert {(r["user_id"], r["item_id"]): round(r["score"] * 1e9) for r in got.collect()} == want
    fresh = recommend.fresh_candidates(history, sims, F.lit(1.0), ["user_id"])
    assert {(r["user_id"], r["item_id"]) for r in fresh.collect()} == set(want) - seen


def test_three_strangers_under_one_key_are_done(spark, monkeypatch):
    # Equal first segments, second segments near one codeword: a key in common, six and more bits apart.
    prints = spark.createDataFrame([(5 | 0b111 << at,) for at in (23, 27, 33)], "fp bigint")
    written, write = {}, simhash.write_once

    def counted(df, name, *more):
        out = write(df, name, *more)
        written[name] = out.count()
        return out

    monkeypatch.setattr(simhash, "write_once", counted)
    assert simhash.linked_groups(prints).count() == 0
    assert written["simhash-shared"] > 0 and written["simhash-known"] == 0


def test_strangers_seldom_share_a_key():
    # Of random fingerprints hardly any are linked; keys that many share by chance grow with the square of the rows.
    prints = np.random.default_rng(3).integers(0, 2**64, 20_000, np.uint64)
    _, keys = simhash.golay_keys(prints)
    _, counts = np.unique(keys, return_counts=True)
    assert (counts * (counts - 1) // 2).sum() < len(prints) / 50


def test_panes_take_as_many_tasks_as_they_need(spark, folder, monkeypatch):
    name = "win_sliding_24h"
    monkeypatch.setattr(windows, "PANES_PER_TASK", 100)
    got = queries()[name](spark, folder)
    # Not the session's four: one task for a hundred panes.
    found = re.search(r"hashpartitioning\(item_id#\d+, warehouse_id#\d+, (\d+)\), REPARTITION_BY_NUM", got._jdf.queryExecution().executedPlan().toString())
    assert int(found[1]) > 10
    assert difference(got, connect(folder), oracle_sql()[name])[0] is None


def test_stream_keeps_one_row_an_hour(spark, folder, monkeypatch):
    name, started, start = "win_sliding_24h_stream", [], sinks.start
    monkeypatch.setattr(sinks, "start", lambda *a, **k: started.append(start(*a, **k)) or started[-1])
    got = queries()[name](spark, folder)
    rows = sum(o["numRowsUpdated"] for p in started[0].recentProgress for o in json.loads(p.json)["stateOperators"])
    events = connect(folder).execute("SELECT count(*) FROM events").fetchall()[0][0]
    assert 0 < rows <= events + 1
    assert difference(got, connect(folder), oracle_sql()[name])[0] is None


def test_records_are_dealt_to_all_tasks(spark, folder):
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    t = Tables(spark, folder)
    for records in (t.event_records(), t.stock_records()):
        sizes = [r["count"] for r in records.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert len(sizes) == parts and max(sizes) <= 2 * min(sizes)


@pytest.mark.parametrize("name", ["event_feature_families", "fraud_gate_full"])
def test_events_are_sent_once_for_their_features(spark, folder, monkeypatch, name):
    monkeypatch.setattr(fraud_features, "EVENTS_PER_TASK", 100)
    got = queries()[name](spark, folder)
    plan = got._jdf.queryExecution().executedPlan().toString()
    # By user, to one task for a hundred events; no window, join or table on disk sends them again.
    assert plan.count("Exchange") == 1
    assert int(re.search(r"hashpartitioning\(user_id#\d+L?, (\d+)\), REPARTITION_BY_NUM", plan)[1]) == 10
    assert difference(got, connect(folder), oracle_sql()[name])[0] is None


def mixed_events(spark):
    """Two busy users, few others, some events without user, time, item or price, many at one instant."""
    rnd, data = random.Random(11), []
    for n in range(400):
        user = rnd.choice(["hot", "hot", "warm", None, f"u{n % 5}"])
        stamp = rnd.choice([rnd.randrange(-7200000, 7200000), rnd.randrange(70 * 86400000), 300000 * rnd.randrange(12), None])
        price = rnd.choice([None, 0.0, round(rnd.uniform(1, 50), 2)])
        item = rnd.choice([None, "", f"i{rnd.randrange(5)}"])
        data.append((f"e{n}", user, item, rnd.choice(["view", "transaction"]), f"c{n % 3}", price, rnd.choice([None, 1, 4]), stamp))
    kinds = "event_id string, user_id string, item_id string, event_type string, category string, price double, quantity int, timestamp bigint"
    return spark.createDataFrame(data, kinds)


def test_users_of_many_events_get_the_same_features(spark, monkeypatch):
    events = mixed_events(spark)
    want = {r["event_id"]: r for r in fraud_features.event_features(events).collect()}
    written, write = [], fraud_features.write_once
    monkeypatch.setattr(fraud_features, "write_once", lambda df, name, *more: written.append(name) or write(df, name, *more))
    monkeypatch.setattr(fraud_features, "EVENTS_PER_USER", 70)
    got = fraud_features.event_features(events)
    assert written == ["large-users", "fraud-instants"]
    assert {r["event_id"]: r for r in got.collect()} == want and len(want) == 400


def test_events_without_time_are_neither_before_nor_after(spark):
    got = {r["event_id"]: r for r in fraud_features.event_features(mixed_events(spark)).collect()}
    of = {e: r for e, r in got.items() if r["user_id"] == "hot"}
    undated = [e for e, r in of.items() if r["timestamp"] is None]
    assert undated and all(of[e]["events_5m"] == of[e]["events_all"] == len(undated) for e in undated)
    for r in of.values():
        if r["timestamp"] is not None:
            assert r["events_all"] == sum(s["timestamp"] is not None and s["timestamp"] <= r["timestamp"] for s in of.values())


def test_the_gate_works_out_only_what_it_reads(spark, folder):
    got = queries()["fraud_gate_full"](spark, folder)
    plan = got._jdf.queryExecution().executedPlan().toString()
    # No feature of distinct values or extremes can be null, so the count of features needs neither; they have sorts of their own.
    assert plan.count("Sort [") == 1 and "_until_" not in plan and "DESC" not in plan
    assert "lambda" not in plan


def test_code_of_wide_rows_is_short_enough_to_be_compiled(spark, folder):
    limit = "spark.sql.codegen.hugeMethodLimit"
    for name in ("event_feature_families", "fraud_gate_full"):
        queries()[name](spark, folder)
        assert spark.conf.get(limit) == "8000"
        queries()["loader_stats"](spark, folder)
        assert spark.conf.get(limit) == "65535"
