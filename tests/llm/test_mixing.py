import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.fixtures import awkward, check_awkward, with_clashes
from tidewell.llm import mixing
from tidewell.llm.queries import QUERIES


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_targets(sizes):
    """Step by step: share out, stop what is above, share the excess among the others."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, got, free = 1.5 * sum(sizes.values()), {s: 0.0 for s in names}, set(names)
    while left > 1e-9 and free:
        each = left / sum(weight[s] for s in free)
        left = 0.0
        for s in list(free):
            got[s] += each * weight[s]
            if got[s] >= 2 * sizes[s]:
                left += got[s] - 2 * sizes[s]
                got[s] = 2.0 * sizes[s]
                free.discard(s)
    return got


def check(rows, docs):
    sizes = defaultdict(int)
    for d in docs:
        sizes[d["source"]] += words(d["text"])
    targets, taken = plain_targets(sizes), defaultdict(int)
    assert sorted(((r["id"], r["size"], r["source"]) for r in rows), key=repr) == sorted(
        ((d["doc_id"], words(d["text"]), d["source"]) for d in docs), key=repr
    )
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"]
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(targets[r["source"]], abs=1e-6)
        taken[r["source"]] += r["taken"]
    for source, n in taken.items():
        assert abs(n - targets[source]) <= 1


@pytest.mark.parametrize("slot_bits", [0, 3, 10])
def test_taken_words(spark, slot_bits):
    rng = random.Random(slot_bits)
    rows = [(i, " ".join("x" * rng.randrange(1, 5) for _ in range(rng.choice([0, 1, 7, 60]))), rng.choice([*"aaaab", None, "é", "z" * 3]))
            for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    check(mixing.taken_words(mixing.mix(docs, slot_bits=slot_bits)).collect(), docs.collect())


def test_awkward(spark):
    mixed = lambda docs: mixing.taken_words(mixing.mix(docs, slot_bits=6))
    check_awkward(spark, mixed)
    check(mixed(awkward(spark)).collect(), awkward(spark).collect())


def test_reruns_agree(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    key = ["id", "taken"]
    one = sorted(map(tuple, mixing.taken_words(mixing.mix(docs)).select(*key).collect()))
    two = sorted(map(tuple, mixing.taken_words(mixing.mix(docs.repartition(7))).select(*key).collect()))
    assert one == two


def test_query(spark, folder):
    rows = QUERIES["op8_mixing"](spark, folder).withColumnRenamed("doc_id", "id").collect()
    check(rows, spark.read.parquet(f"{folder}/documents.parquet").collect())


def test_schedule_is_spread_evenly(spark):
    sizes = [("a", 600), ("b", 300), ("c", 100)]
    targets = spark.createDataFrame([(s, n, 1, float(n)) for s, n in sizes], "source string, source_size bigint, weight int, target double")
    rows = mixing.schedule(targets, 9).orderBy("slot").collect()
    assert [r["slot"] for r in rows] == list(range(512))
    for upto in (8, 64, 100, 333, 512):
        for source, n in sizes:
            share = sum(r["source"] == source for r in rows[:upto])
            assert abs(share - upto * n / 1000) <= 6
    for source, n in sizes:
        own = sorted((r["block"], r["start"], r["stop"]) for r in rows if r["source"] == source)
        assert [b for b, _, _ in own] == list(range(len(own)))
        assert own[0][1] == 0 and own[-1][2] == n
        assert all(a[2] == b[1] for a, b in zip(own, own[1:]))
        assert max(c - b for _, b, c in own) - min(c - b for _, b, c in own) <= 1


def test_pieces_do_not_overlap(spark):
    docs = spark.createDataFrame([(i, "w " * (i % 9), "ab"[i % 2]) for i in range(40)], "doc_id bigint, text string, source string")
    seen = defaultdict(list)
    for r in mixing.mix(docs, slot_bits=4).filter("slot IS NOT NULL").collect():
        seen[r["id"], r["pass"]].append((r["first"], r["first"] + r["words"], r["size"]))
    for parts in seen.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a[1] == b[0] for a, b in zip(parts, parts[1:])) and parts[-1][1] <= parts[0][2]


def test_word_count(spark):
    texts = ["", " ", "a", " a\tb\n", "\x0b\x0c\r x y", "w w", "a b", None, "ww  w"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").select("text", mixing.word_count(F.col("text")).alias("n"))
    assert [r["n"] for r in docs.collect()] == [words(t) for t in texts]


def test_mixed_documents(spark):
    docs = with_clashes(awkward(spark)).filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    counts = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert set(counts.values()) <= {1, 2} and {3, 4, 5} <= set(counts)


def test_mixed_documents_with_repeated_and_null_ids(spark):
    """Rows that share an id do not multiply, and no source passes its target by more than a document."""
    rows = [(None, f"n{i} " * (3 + i % 5), "a") for i in range(40)] + [(7, f"s{i} " * (3 + i % 5), "b") for i in range(40)]
    rows += [(8, "the same row", "c")] * 2500 + [(i, "own words here", "c") for i in range(100, 140)]
    docs = with_clashes(spark.createDataFrame(rows, "doc_id bigint, text string, source string"))
    sizes, taken, times = defaultdict(int), defaultdict(int), defaultdict(int)
    for _, text, source in rows:
        sizes[source] += words(text)
    for r in mixing.mixed_documents(docs, slot_bits=8).collect():
        taken[r["source"]] += words(r["text"])
        times[r["doc_id"], r["text"]] += 1
    for source, target in plain_targets(sizes).items():
        assert abs(taken[source] - target) <= 7
    same = times.pop((8, "the same row"))
    assert 2500 < same <= 5000 and max(times.values()) <= 2


def test_mixed_documents_takes_the_awkward_table_as_it_is(spark):
    docs = with_clashes(awkward(spark))
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    times = defaultdict(int)
    for r in mixed.collect():
        times[r["doc_id"], r["text"]] += 1
    own = defaultdict(int)
    for r in docs.collect():
        own[r["doc_id"], r["text"]] += 1
    assert all(n <= 2 * own[row] for row, n in times.items())
    assert all(times[row] == own[row] for row in own if not words(row[1]))
