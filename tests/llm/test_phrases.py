import random
import re

import numpy as np

from tests.compare import connect, difference
from tests.llm.fixtures import awkward, check_awkward, empty, sorted_rows
from tidewell.llm import phrases
from tidewell.llm.queries import ORACLES, QUERIES

WORD = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
ITEMS = "item_id string, text string"


def words(text):
    return WORD.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))


def plain(docs, items, window):
    out = []
    for number, text in docs:
        own, hit, named = words(text), set(), set()
        for name, phrase in items:
            of = words(phrase)
            n = min(window, len(of))
            sought = {tuple(of[i:i + n]) for i in range(len(of) - n + 1)} if n else set()
            for i in range(len(own) - n + 1):
                if tuple(own[i:i + n]) in sought:
                    hit |= set(range(i, i + n))
                    named |= {name} - {None}
        out.append((number, len(own), sorted(hit), sorted(named)))
    return sorted(out, key=repr)


def found(spark, docs, items, **settings):
    out = phrases.contamination(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, ITEMS), **settings
    )
    rows = []
    for r in out.collect():
        assert all(a < b for a, b in zip(r["starts"], r["ends"]))
        assert all(a < b for a, b in zip(r["ends"], r["starts"][1:]))
        rows.append((r["doc_id"], r["n_words"], [i for a, b in zip(r["starts"], r["ends"]) for i in range(a, b)], r["items"]))
    return sorted(rows, key=repr)


def made(rng):
    pool = [f"w{i}" for i in range(30)]
    items = [(str(i), " ".join(rng.choices(pool, k=rng.choice([1, 2, 4, 9, 10, 11, 30])))) for i in range(25)]
    docs = []
    for i in range(120):
        text = rng.choices(pool + ["Ünï-codé", "x.y"], k=rng.choice([0, 3, 50, 200]))
        for _ in range(rng.randint(0, 2)):
            at = rng.randint(0, len(text))
            text[at:at] = rng.choice(items)[1].upper().split()
        docs.append((i, ", ".join(text)))
    # Copies, near copies, and one passage over and over.
    docs += [(200 + i, docs[7][1]) for i in range(30)] + [(300 + i, docs[7][1] + f" end{i}") for i in range(10)]
    docs += [(400, " ".join([items[0][1]] * 60)), (401, "w1 " * 700)]
    return docs, items


def test_against_plain_search(spark):
    docs, items = made(random.Random(2))
    wanted = plain(docs, items, 10)
    assert sum(bool(w[2]) for w in wanted) > 20
    for settings in ({}, {"shard_words": 90}, {"item_bytes": 300}, {"item_bytes": 500, "shard_words": 2000}):
        assert found(spark, docs, items, **settings) == wanted
    assert found(spark, docs, items, window=3, shard_words=500) == plain(docs, items, 3)


def test_awkward_documents_and_items(spark):
    docs = [(r["doc_id"], r["text"]) for r in awkward(spark).collect()]
    items = [
        ("1", "three FOUR, five!"), ("1", "nine ten"), (None, "w5 x5 w6 x6"), ("2", None), ("3", ""), ("4", "--"),
        ("5", "日本語 テスト é"), ("6", "one two three four five six seven eight nine ten"), ("6", "one two three four five six seven eight nine ten"),
    ]
    for settings in ({}, {"shard_words": 5}, {"item_bytes": 20}):
        assert found(spark, docs, items, **settings) == plain(docs, items, 10)
    sought = spark.createDataFrame(items, ITEMS)
    check_awkward(spark, lambda t: phrases.contamination(t, sought))
    clashing = sought.selectExpr("*", "'clash' AS name", "1 AS shard", "2 AS row")
    assert sorted_rows(phrases.contamination(awkward(spark), clashing)) == sorted_rows(phrases.contamination(awkward(spark), sought))
    assert found(spark, docs, [], shard_words=50) == plain(docs, [], 10)
    assert phrases.contamination(empty(spark), sought).count() == 0


def test_suffixes_ranks_and_places():
    rng = np.random.default_rng(1)
    for sizes in ([5, 1, 9], [64, 64, 64, 3], [1]):
        texts = [rng.integers(1, 4, n).tolist() for n in sizes]
        numbers = phrases.Numbers()
        for w in (b"a", b"b", b"c"):
            numbers[w]
        shard = phrases.build(texts, numbers, 10)
        text, first, size = phrases.blocks_of(np.array(sizes), 10)
        flat = []
        for t, f, n in zip(text, first, size):
            for i, w in enumerate(texts[t][f:f + n]):
                flat.append(w)
            flat.append(0)
        for length in (1, 2, 5):
            windows = np.unique(rng.integers(1, 4, (40, length)), axis=0)
            which, low, high = shard.search(windows)
            got = {tuple(windows[w].tolist()): sorted(shard.locate(np.arange(a, b)).tolist()) for w, a, b in zip(which, low, high)}
            wanted = {}
            for i in range(len(flat) - length + 1):
                if 0 not in flat[i:i + length]:
                    wanted.setdefault(tuple(flat[i:i + length]), []).append(i)
            assert got == {k: v for k, v in wanted.items() if k in set(map(tuple, windows.tolist()))}


def test_query_matches_sql(spark, folder):
    problem, count = difference(QUERIES["op13_contamination"](spark, folder), connect(folder), ORACLES["op13_contamination"])
    assert problem is None and count > 0
