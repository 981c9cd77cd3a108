import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.fixtures import awkward, check_awkward
from tidewell.llm import fracsketch
from tidewell.llm.queries import QUERIES


def brute(rows):
    ordered = sorted(((n, t or "") for n, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    out = []
    for i, (number, text) in enumerate(ordered):
        following = ordered[(i + 1) % len(ordered)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        own, other, after = (fracsketch.sketch(t) for t in (text, edited, following))
        out.append((
            number, len(text), hashlib.sha256(edited.encode()).hexdigest(), fracsketch.to_text(own), fracsketch.to_text(other),
            fracsketch.containment(own, other), fracsketch.containment(own, after),
        ))
    return sorted(out, key=repr)


@pytest.mark.parametrize("chunk_rows", [1, 7, 4000])
def test_next_documents(spark, folder, chunk_rows):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    found = fracsketch.edited_likeness(docs, chunk_rows=chunk_rows)
    assert sorted(map(tuple, found.collect()), key=repr) == brute([tuple(r) for r in docs.collect()])


@pytest.mark.parametrize("chunk_rows", [1, 3, 4000])
def test_awkward(spark, chunk_rows):
    found = check_awkward(spark, lambda docs: fracsketch.edited_likeness(docs, chunk_rows=chunk_rows))
    assert found == brute([(r["doc_id"], r["text"]) for r in awkward(spark).collect()])


def test_query_columns(spark, folder):
    found = QUERIES["op5_fingerprints"](spark, folder)
    assert found.columns == [
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"
    ]
    rows = found.collect()
    assert sum(r["near_edited"] > r["near_next"] for r in rows) > 0.95 * len(rows)


def test_all_shingles_at_scale_one():
    text = "the quick brown fox jumps over the lazy dog, the quick brown fox"
    exact = {text[i:i + 5] for i in range(len(text) - 4)}
    assert len(fracsketch.sketch(text, 5, 1)) == len(exact)
    half = text[:30]
    share = len({half[i:i + 5] for i in range(26)} & exact) / len({half[i:i + 5] for i in range(26)})
    assert fracsketch.containment(fracsketch.sketch(half, 5, 1), fracsketch.sketch(text, 5, 1)) == share == 1.0


def test_merging_and_estimates():
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(30_000)]
    small, large = " ".join(words[:3000]), " ".join(words[1500:])
    a, b = fracsketch.sketch(small), fracsketch.sketch(large)
    assert abs(fracsketch.containment(a, b) - 0.5) < 0.05
    whole = fracsketch.sketch(small + "\n" + large)
    assert len(np.setdiff1d(fracsketch.merged(a, b), whole)) == 0
    assert not fracsketch.is_whole(whole)
    assert len(np.setdiff1d(whole, fracsketch.merged(a, b))) <= 12
    assert (fracsketch.from_text(fracsketch.to_text(a)) == a).all()


def test_fingerprints(spark):
    rows = fracsketch.fingerprints(awkward(spark)).collect()
    of = {r["doc_id"]: r["fingerprint"] for r in rows}
    assert of[1] == of[2] != of[-9] and of[3] == of[4] == ""
    assert all(len(r["fingerprint"]) == 16 * r["hashes"] for r in rows)


def test_short_texts_keep_their_shingles():
    rng = np.random.default_rng(8)
    texts = ["".join(rng.choice(list("abcdefghij "), n)) for n in rng.integers(1, 260, 400)]
    sketches = [fracsketch.sketch(t) for t in texts]
    assert all(len(s) for s in sketches)
    assert fracsketch.containment(fracsketch.sketch("one short text here"), fracsketch.sketch("hello world, nothing")) == 0
    assert fracsketch.containment(fracsketch.sketch(""), fracsketch.sketch("")) == 1
    assert fracsketch.containment(fracsketch.sketch(""), fracsketch.sketch("a")) == 0
    assert fracsketch.containment(fracsketch.sketch("a"), fracsketch.sketch("")) == 0
    for text, other in zip(texts, texts[1:]):
        exact = lambda t: {t[i:i + 12] for i in range(max(1, len(t) - 11))}
        half = text[:len(text) - len(text) // 2] + other[:len(text) // 2]
        wanted = len(exact(text) & exact(half)) / len(exact(text))
        assert abs(fracsketch.containment(fracsketch.sketch(text), fracsketch.sketch(half)) - wanted) < 1e-9 or len(text) < 14


def test_a_short_text_inside_a_long_one():
    rng = np.random.default_rng(9)
    long = "".join(rng.choice(list("abcdefghij "), 20_000))
    part = long[5000:5200]
    assert fracsketch.containment(fracsketch.sketch(part), fracsketch.sketch(long)) == 1
    both = fracsketch.merged(fracsketch.sketch(part), fracsketch.sketch(long))
    assert (both == fracsketch.sketch(long)).all()


def test_ids_of_text(spark):
    rows = [(f"id{i:03d}", f"text number {i} " * (i % 7)) for i in range(200)] + [(None, "x")]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or ""))
    following = {a[0]: b[1] for a, b in zip(ordered, ordered[1:] + ordered[:1])}
    for chunk_rows in (9, 4000):
        for r in fracsketch.edited_likeness(docs, chunk_rows=chunk_rows).collect():
            text, half = dict(rows)[r["doc_id"]], len(dict(rows)[r["doc_id"]]) // 2
            edited = text[:len(text) - half] + following[r["doc_id"]][:half]
            assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()


def test_place_among_many_starts(spark):
    starts = list(range(0, 1000, 3))
    found = spark.range(-5, 1005).select("id", fracsketch._place(F.col("id"), starts).alias("n")).collect()
    assert all(r["n"] == sum(s <= r["id"] for s in starts) for r in found)
