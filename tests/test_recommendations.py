"""Similarities and recommendations against plain Python on small data."""

import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidewell import config
from tidewell.operators import recommend, similarity
from tidewell.plans import batch

RATING = {"transaction": 5.0, "addtocart": 3.0, "view": 1.0, "search": 0.5}
WEIGHT = {"transaction": 1.0, "addtocart": 0.7, "view": 0.3, "search": 0.2}


def interactions(seed=11, crawlers=3):
    """Crawlers touch nearly every item, others few; a third of the rows is one crawler's."""
    rnd = random.Random(seed)
    out = []
    for item in range(40):
        for crawler in range(crawlers):
            if rnd.random() < 0.95:
                out.append((f"bot{crawler}", f"i{item:02d}", "view"))
    for _ in range(260):
        out.append((f"u{rnd.randrange(25)}", f"i{rnd.randrange(40):02d}", rnd.choice([*RATING, "other"])))
    return [(u, i, k, n, f"e{n:04d}") for n, (u, i, k) in enumerate(out)]


def frame(spark, data):
    return spark.createDataFrame(data, "user_id string, item_id string, event_type string, timestamp bigint, event_id string")


def brute(data, min_common=3):
    vectors = defaultdict(lambda: defaultdict(float))
    for user, item, kind, *_ in data:
        vectors[item][user] += RATING.get(kind, 1.0)
    pairs, sims = {}, defaultdict(list)
    norm = {i: math.sqrt(sum(r * r for r in v.values())) for i, v in vectors.items()}
    for a in vectors:
        for b in vectors:
            shared = vectors[a].keys() & vectors[b].keys()
            if a != b and len(shared) >= min_common:
                dot = sum(vectors[a][u] * vectors[b][u] for u in shared)
                sims[a].append((-dot / (norm[a] * norm[b]), b))
                if a < b:
                    pairs[a, b] = (dot, len(shared))
    return pairs, {a: [(b, -s) for s, b in sorted(found)[:50]] for a, found in sims.items()}


@pytest.mark.parametrize("heavy", [0, 5, 10**9])
@pytest.mark.parametrize("min_common", [1, 2, 3, 5])
def test_pairs(spark, heavy, min_common):
    data = interactions()
    vectors = similarity.item_vectors(frame(spark, data))
    got = similarity.pair_overlaps(vectors, min_common, heavy_degree=heavy)
    assert {(r.item_a, r.item_b): (r.dot, r.common) for r in got.collect()} == brute(data, min_common)[0]


def test_heavy_users_propose_no_pairs(spark):
    """Two crawlers over the whole catalog: the pairs come from the others alone."""
    data = interactions(crawlers=2)
    vectors = similarity.item_vectors(frame(spark, data))
    got = similarity.pair_overlaps(vectors, heavy_degree=20)
    assert {(r.item_a, r.item_b): (r.dot, r.common) for r in got.collect()} == brute(data)[0]


@pytest.mark.parametrize("min_common", [2, 3, 6, 7])
def test_five_crawlers(spark, min_common):
    """Five users over the whole catalog: some propose, and what only they share counts exactly."""
    data = interactions(crawlers=5)
    vectors = similarity.item_vectors(frame(spark, data))
    got = similarity.pair_overlaps(vectors, min_common, heavy_degree=20)
    assert {(r.item_a, r.item_b): (r.dot, r.common) for r in got.collect()} == brute(data, min_common)[0]


def test_top_similar(spark):
    data = interactions()
    got = similarity.similarities(similarity.item_vectors(frame(spark, data)), config.SimilarityConfig(4, 3)).collect()
    want = brute(data)[1]
    for row in got:
        assert 0 < row.sim <= 1 + 1e-12 and row.rank <= 4
        assert want[row.item_id][row.rank - 1][1] == pytest.approx(row.sim)
    assert len(got) == sum(min(4, len(v)) for v in want.values())


def test_few_common_users(spark):
    data = [("u1", "a", "view", 1, "e1"), ("u2", "a", "view", 1, "e2"), ("u1", "b", "view", 1, "e3"), ("u2", "b", "view", 1, "e4")]
    assert similarity.similarities(similarity.item_vectors(frame(spark, data))).count() == 0


def test_popular(spark):
    data = [("u1", "i1", "view", 1, "a"), ("u2", "i1", "view", 1, "b"), ("u1", "i2", "view", 1, "c"), ("u1", "", "view", 1, "d")]
    got = similarity.popular_items(similarity.item_popularity(frame(spark, data)), 5).collect()
    assert [(r.item_id, r.event_count) for r in got] == [("i1", 2), ("i2", 1)]


def scores(history, sims, weight):
    seen, found = {i for i, _ in history}, defaultdict(float)
    for item, kind in history:
        for other, sim in sims.get(item, []):
            if other not in seen:
                found[other] += sim * weight(kind)
    return found


@pytest.mark.parametrize("flow", ["cf", "weighted"])
def test_recommendations(spark, flow):
    data = interactions()
    df, sims_want = frame(spark, data), brute(data)[1]
    sims = similarity.similarities(similarity.item_vectors(df))
    if flow == "cf":
        got, weight = recommend.recommend_cf(df, sims), lambda k: 1.0
    else:
        got, weight = recommend.recommend_weighted(df, sims), lambda k: WEIGHT.get(k, 0.1)
    histories = defaultdict(list)
    for user, item, kind, *_ in data:
        histories[user].append((item, kind))
    listed = defaultdict(dict)
    for row in got.collect():
        listed[row.user_id][row.rank] = row
    for user, history in histories.items():
        want = scores(history, sims_want, weight)
        best = sorted(want.values(), reverse=True)[:10] if flow == "cf" or len(history) >= 3 else []
        assert len(listed[user]) == len(best)
        for rank, score in enumerate(best, 1):
            row = listed[user][rank]
            assert row.score == pytest.approx(score, abs=6e-5)
            assert row.item_id not in {i for i, _ in history}


def test_two_steps_equal_one(spark):
    df = frame(spark, interactions())
    sims = similarity.similarities(similarity.item_vectors(df))
    one = recommend.fresh_candidates(df, sims, F.lit(1.0), ["user_id"])
    two = recommend.exclude_seen(recommend.candidates(df, sims, F.lit(1.0), ["user_id"]), df, ["user_id"])
    assert one.exceptAll(two).count() == 0 and two.exceptAll(one).count() == 0


def test_fallbacks(spark):
    df = frame(spark, interactions())
    sims, popularity = similarity.similarities(similarity.item_vectors(df)), similarity.item_popularity(df)
    users = spark.createDataFrame([("new",), ("u1",)], "user_id string")
    got = recommend.recommend(users, df, sims, popularity, 3)
    new = sorted((r.rank, r.source, r.score) for r in got.collect() if r.user_id == "new")
    counts = [r.event_count for r in similarity.popular_items(popularity, 3).collect()]
    assert new == [(n + 1, "popular", count / 1000) for n, count in enumerate(counts)]
    short = frame(spark, [("x", "i1", "view", 1, "e1"), ("x", "i2", "addtocart", 2, "e2")])
    cold = sorted((r.rank, r.item_id, round(r.score, 9)) for r in recommend.cold_start(short).collect())
    assert cold == [(n + 1, f"popular_{n}", round(1 - n * 0.1, 9)) for n in range(5)]
    real = recommend.cold_start_popular(short, popularity).orderBy("rank").collect()
    assert [r.item_id for r in real] == [r.item_id for r in similarity.popular_items(popularity, 5).collect()]


def test_history_without_candidates_gets_nothing(spark):
    data = [("u1", "i1", "view", 1, "a"), ("u1", "i2", "view", 2, "b"), ("u2", "i1", "view", 3, "c"), ("u2", "i3", "view", 4, "d")]
    df = frame(spark, data)
    sims = similarity.similarities(similarity.item_vectors(df))
    got = recommend.recommend(df.select("user_id").distinct(), df, sims, similarity.item_popularity(df))
    assert got.count() == 0


def test_sessions(spark):
    df = frame(spark, [("u", "i1", "view", 1, "a"), ("u", "i2", "addtocart", 2, "b"), ("", "i1", "view", 1, "c"),
                       ("v", "i1", "view", 1, "d"), ("v", "i2", "view", 2, "e"), ("v", "i3", "view", 3, "f")])
    df = df.withColumn("session_id", F.concat(F.lit("s-"), "user_id"))
    asked = df.select("session_id").union(spark.sql("select 's-none'"))
    got = {r.session_id: (r.status, r.session_length, r.recommendations) for r in
           recommend.process_sessions(asked, df, None).collect()}
    assert got == {"s-u": ("success", 2, 5), "s-": ("no_user", 1, 0), "s-v": ("success", 3, 0), "s-none": ("empty", 0, 0)}


def test_save_and_load(spark, tmp_path):
    df = frame(spark, interactions())
    model = batch.train_recommendations(df, config.SimilarityConfig(5, 2))
    batch.save_recommendations(model, str(tmp_path / "model"))
    loaded = batch.load_recommendations(spark, str(tmp_path / "model"))
    assert loaded.settings == config.SimilarityConfig(5, 2)
    for name in ("vectors", "similarities", "popularity"):
        a, b = getattr(model, name), getattr(loaded, name)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert batch.load_recommendations(spark, str(tmp_path / "nothing")) is None
