import random
import zlib

import pytest

from tests.llm.fixtures import check_awkward, with_clashes
from tidewell.llm import shards
from tidewell.llm.queries import QUERIES


def smallest_capacity(sizes, parts):
    """By trying every cut."""
    best = {0: [0] + [float("inf")] * parts}
    table = [[float("inf")] * (parts + 1) for _ in range(len(sizes) + 1)]
    table[0] = [0] * (parts + 1)
    for end in range(1, len(sizes) + 1):
        for k in range(1, parts + 1):
            table[end][k] = min(max(table[at][k - 1], sum(sizes[at:end])) for at in range(end))
    del best
    return table[-1][parts]


@pytest.mark.parametrize("seed", range(20))
def test_cuts_are_minimax(seed):
    rng = random.Random(seed)
    sizes = [rng.choice([1, 2, 5, rng.randint(1, 60)]) for _ in range(rng.randint(1, 14))]
    parts = rng.randint(1, 5)
    cuts = shards.minimax_cuts(sizes, parts)
    edges = [0, *cuts, len(sizes)]
    assert edges == sorted(edges) and len(edges) <= parts + 1
    assert max(sum(sizes[a:b]) for a, b in zip(edges, edges[1:])) == smallest_capacity(sizes, parts)


def test_no_sizes():
    assert shards.minimax_cuts([], 4) == []


def check(rows, docs, count):
    texts = {}
    for r in rows:
        texts.setdefault(r["shard"], []).append(r["slot"])
        assert 0 <= r["shard"] < count
    for slots in texts.values():
        assert sorted(slots) == list(range(len(slots)))
    plain = sorted(
        ((d["doc_id"], len((d["text"] or "").encode()) + 1, zlib.crc32((d["text"] or "").encode())) for d in docs), key=repr
    )
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in rows), key=repr) == plain
    groups = {}
    for r in rows:
        groups.setdefault((r["size"], r["text_crc32"]), set()).add(r["shard"])
    assert all(len(g) == 1 for g in groups.values())


def test_query(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    found = QUERIES["op6_shards"](spark, folder)
    rows = found.collect()
    check(rows, docs, 16)
    assert {r["law"] for r in rows} == {"bytes"} and {r["grown_shard"] for r in rows} == {None}
    loads = [0] * 16
    for r in rows:
        loads[r["shard"]] += r["size"]
    total, largest = sum(loads), max(r["size"] for r in rows)
    assert max(loads) <= total / 16 + 3 * largest
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_awkward(spark):
    check_awkward(spark, lambda docs: shards.assign(docs, 3).select("doc_id", "size", "text_crc32", "shard"))


def test_a_text_with_many_copies_is_numbered_in_lanes(spark):
    docs = spark.createDataFrame([(i, "same" if i % 3 else f"t{i}") for i in range(300)], "doc_id bigint, text string")
    check(shards.assign(with_clashes(docs), 4, lanes=8).collect(), docs.collect(), 4)


@pytest.mark.parametrize("seed", range(20))
def test_even_cuts_stay_minimax(seed):
    rng = random.Random(seed)
    sizes = [rng.choice([1, 2, 5, rng.randint(1, 60), 300]) for _ in range(rng.randint(1, 14))]
    parts = rng.randint(1, 6)
    edges = [0, *shards.even_cuts(sizes, parts), len(sizes)]
    assert edges == sorted(edges) and len(edges) <= parts + 1
    assert max(sum(sizes[a:b]) for a, b in zip(edges, edges[1:])) == smallest_capacity(sizes, parts)


@pytest.mark.parametrize("place", [0, 1, 5000, 9999])
def test_what_lies_around_a_third_is_even(place):
    sizes = [10] * 10_000
    sizes.insert(place, 50_000)
    edges = [0, *shards.even_cuts(sizes, 16), len(sizes)]
    loads = sorted(sum(sizes[a:b]) for a, b in zip(edges, edges[1:]))
    if place > 1:
        assert len(loads) == 16
    assert loads[-1] == 50_000 and loads[-2] <= 100_000 / 13


def test_a_third_of_equal_texts_leaves_no_shard_empty(spark):
    docs = spark.createDataFrame([(i, "the same" if i % 3 == 0 else f"text {i:5}") for i in range(6000)], "doc_id bigint, text string")
    rows = shards.assign(docs, 16).collect()
    check(rows, docs.collect(), 16)
    loads = [0] * 16
    for r in rows:
        loads[r["shard"]] += r["size"]
    assert min(loads) > 0 and sorted(loads)[-2] < 1.5 * sum(sorted(loads)[:-1]) / 15
