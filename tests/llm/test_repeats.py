import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.fixtures import awkward, check_awkward
from tidewell.llm import repeats
from tidewell.llm.queries import QUERIES


def brute(rows, window):
    texts = [(t or "").encode().split() for _, t in rows]
    seen = Counter(tuple(w[i:i + window]) for w in texts for i in range(len(w) - window + 1))
    out = []
    for (number, _), words in zip(rows, texts):
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            if seen[tuple(words[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        kept = [w for w, g in zip(words, gone) if not g]
        out.append((number, len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=repr)


def removed(docs, **options):
    return repeats.removal(docs, **options).select("doc_id", "words", "removed", F.sha2("kept", 256))


def test_query(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    found = QUERIES["op10_substring_dedup"](spark, folder).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert sorted(map(tuple, found.collect()), key=repr) == brute(rows, 35)


@pytest.mark.parametrize("window,base", [(5, 1), (6, 2), (7, 7), (3, 1), (1, 1)])
def test_dense_repeats(spark, window, base):
    rng = random.Random(window)
    rows = [
        (i if i % 7 else None, " ".join(rng.choice("abc") for _ in range(rng.randrange(14))) if i % 9 else None) for i in range(50)
    ]
    rows += rows[:3]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(map(tuple, removed(docs, window=window, base=base).collect()), key=repr) == brute(rows, window)


def test_awkward(spark):
    found = check_awkward(spark, lambda docs: removed(docs, window=4, base=2))
    assert found == brute([(r["doc_id"], r["text"]) for r in awkward(spark).collect()], 4)


def test_lengths_double():
    for window in range(1, 200):
        for base in (1, 3, 16):
            steps = repeats.lengths(window, base)
            assert steps[-1] == window
            assert all(short < long <= 2 * short for short, long in zip(steps, steps[1:]))


def test_smallest_within():
    values = np.random.default_rng(2).integers(1, 9, 60).astype(np.uint64)
    for span in (1, 2, 5, 18):
        least, places = repeats.smallest_within(values, span)
        runs = [values[i:i + span] for i in range(len(values) - span + 1)]
        assert least.tolist() == [r.min() for r in runs]
        assert places.tolist() == sorted({i + j for i, r in enumerate(runs) for j in range(span) if r[j] == r.min()})
