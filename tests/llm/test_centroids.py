import hashlib
import math
import random

import numpy as np

from tests.compare import connect, difference
from tidewell.llm import centroids
from tidewell.llm.queries import ORACLES, QUERIES

SCHEMA = "vec_id bigint, embedding array<float>"


def plain(rows, dimensions, clusters, rounds, seed=2):
    kept = []
    for number, vector in rows:
        if vector is not None and len(vector) == dimensions and all(x is not None and math.isfinite(x) for x in vector):
            kept.append((number, [math.floor(256 * float(np.float32(x))) for x in vector]))
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    centres = [v for _, v in first[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(centres))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        centres = [[sum(x) // len(groups[i]) for x in zip(*groups[i])] if i in groups else c for i, c in enumerate(centres)]
    found = [(number, *nearest(v)[::-1]) for number, v in kept]
    sums = {}
    for _, c, d in found:
        sums[c] = sums.get(c, 0) + d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((n, c, d, sums[c], sum(sums.values()), digest[c]) for n, c, d in found), key=repr)


def found(spark, rows, schema=SCHEMA, **settings):
    return sorted(map(tuple, centroids.clustered(spark.createDataFrame(rows, schema), **settings).collect()), key=repr)


def test_against_plain_rounds(spark):
    rng = random.Random(1)
    rows = [(i, [rng.choice([-1.5, -0.25, 0.1, 0.3, 2.0]) for _ in range(5)]) for i in range(300)]
    rows += [(1000 + i, [0.5] * 5) for i in range(200)]  # one hot vector
    for chunk in (7, 64, 65_536):
        got = found(spark, rows, dimensions=5, clusters=9, rounds=4, chunk_rows=chunk)
        assert got == plain(rows, 5, 9, 4)


def test_awkward_vectors(spark):
    good = [0.5, -0.5, 0.25]
    rows = [
        (1, good), (1, good), (2, None), (3, []), (4, [1.0]), (5, [1.0, None, 2.0]), (6, [float("nan"), 0.0, 0.0]),
        (7, [float("inf"), 0.0, 0.0]), (8, good), (9, [0.0, 0.0, 0.0]), (10, [100.0, -100.0, 3.0]),
    ]
    assert found(spark, rows, dimensions=3, clusters=3, rounds=2) == plain(rows, 3, 3, 2)
    # Fewer vectors than clusters, and none.
    assert found(spark, rows, dimensions=3, clusters=40, rounds=2) == plain(rows, 3, 40, 2)
    assert found(spark, [], dimensions=3) == []
    without_id = centroids.clustered(spark.createDataFrame([(None, good), (None, good), (3, good)], SCHEMA), dimensions=3, clusters=2)
    assert sorted((r["vec_id"] for r in without_id.collect()), key=repr) == [3, None, None]
    huge = found(spark, [(1, [3e38, 0.0, 0.0]), (2, good)], dimensions=3, clusters=1)
    assert len(huge) == 2


def test_clashing_columns(spark):
    rng = random.Random(3)
    rows = [(i, [rng.random() for _ in range(4)], "clash") for i in range(50)]
    schema = SCHEMA + "".join(f", {n} string" for n in ("id", "values", "cluster", "ids", "codes", "distance", "n"))
    wide = [(*r[:2], *["clash"] * 7) for r in rows]
    assert found(spark, wide, schema, dimensions=4, clusters=5, rounds=2) == plain([r[:2] for r in rows], 4, 5, 2)


def test_encoding_is_without_loss():
    rng = np.random.default_rng(5)
    for values in (rng.integers(-3, 3, (500, 7)), rng.integers(-(2**40), 2**40, (50, 4)), np.zeros((9, 3), np.int64)):
        blocks = centroids.encode(values)
        assert (np.concatenate([e[c] for _, e, c in blocks], axis=1) == values).all()
        centres = values[:4]
        if abs(values).max() < 1000:
            apart = ((values[:, None] - centres[None]) ** 2).sum(axis=2)
            assert (centroids.distances(blocks, centres) == apart).all()
            nearest = apart.argmin(axis=1)
            wanted = [values[nearest == c].sum(axis=0).tolist() for c in range(len(centres))]
            assert centroids.sums(blocks, nearest, len(centres)).tolist() == wanted
    # Blocks of several dimensions are used where few subvectors occur.
    assert max(e.shape[1] for _, e, _ in centroids.encode(rng.integers(0, 2, (500, 8)))) == 4


def test_query_matches_sql(spark, folder):
    problem, count = difference(QUERIES["op12_centroids"](spark, folder), connect(folder), ORACLES["op12_centroids"])
    assert problem is None and count > 0
