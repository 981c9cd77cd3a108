import numpy as np
import pytest
import xxhash

from tests.llm.fixtures import awkward, check_awkward, with_clashes
from tidewell.llm import simhash
from tidewell.llm.components import components
from tidewell.llm.queries import QUERIES


def plain_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints, most):
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= most:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def expected(rows, most=4):
    prints = [plain_print(t) for _, t in rows]
    roots = plain_groups(prints, most)
    least = {}
    for (number, _), root in zip(rows, roots):
        if number is not None:
            least[root] = min(number, least.get(root, number))
    return sorted(((n, f"{p:016x}", least.get(r)) for (n, _), p, r in zip(rows, prints, roots)), key=repr)


def test_query_against_all_pairs(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    found = sorted(map(tuple, QUERIES["op2_simhash"](spark, folder).collect()), key=repr)
    assert found == expected(rows)


def test_awkward(spark):
    found = check_awkward(spark, simhash.near_duplicates)
    assert found == expected([(r["doc_id"], r["text"]) for r in awkward(spark).collect()])


def test_every_word_is_near_one_codeword():
    words = np.random.default_rng(1).integers(0, 1 << 23, 5000)
    index = simhash.codeword_index(words)
    # The same index again when any up to three bits of its codeword are wrong.
    codeword = words ^ simhash._ERRORS[simhash._syndromes(words)]
    assert (simhash._syndromes(codeword) == 0).all()
    assert (np.bitwise_count((words ^ codeword).astype(np.uint64)) <= 3).all()
    for flips in (1 | 2 | 4, 1 << 22, (1 << 9) | (1 << 17)):
        assert (simhash.codeword_index(codeword ^ flips) == index).all()


@pytest.mark.parametrize("bits", [1, 2, 3, 4])
def test_keys_lose_no_pair(bits):
    rng = np.random.default_rng(bits)
    left = rng.integers(0, 2**64, 1500, dtype=np.uint64)
    right = left.copy()
    for i in range(len(right)):
        for b in rng.choice(64, bits, replace=False):
            right[i] ^= np.uint64(1 << int(b))

    def by_row(prints):
        rows, keys = simhash.golay_keys(prints)
        out = [set() for _ in prints]
        for r, k in zip(rows.tolist(), keys.tolist()):
            out[r].add(k)
        return out

    assert all(a & b for a, b in zip(by_row(left), by_row(right)))


def test_chains_and_dense_groups(spark):
    """A chain of steps of four bits, a dense cloud, and strangers."""
    rng = np.random.default_rng(5)
    chain = [0]
    for i in range(15):
        chain.append(chain[-1] ^ (0b1111 << (4 * i)))
    centre = int(rng.integers(0, 2**63))
    cloud = [centre ^ sum(1 << int(b) for b in rng.choice(64, int(rng.integers(0, 4)), replace=False)) for _ in range(200)]
    prints = sorted({*chain, *cloud, *map(int, rng.integers(0, 2**63, 50))})
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = {r["fp"]: r["root"] for r in simhash.linked_groups(spark.createDataFrame([(s,) for s in signed], "fp bigint")).collect()}
    roots = plain_groups(prints, 4)
    ours = [found.get(s, s) for s in signed]
    assert len(set(zip(roots, ours))) == len(set(roots)) == len(set(ours))


def test_components(spark):
    links = [(1, 2), (3, 2), (3, 4), (9, 8), (8, 7), (7, 9), (5, 5)]
    found = components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    assert sorted(map(tuple, found)) == [(1, 1), (2, 1), (3, 1), (4, 1), (7, 7), (8, 7), (9, 7)]


def test_drop_near_keeps_one_of_each(spark):
    docs = with_clashes(awkward(spark))
    left = simhash.drop_near(docs)
    assert left.columns == docs.columns
    kept = {r["doc_id"] for r in left.collect()}
    assert kept == {c for n, _, c in expected([(r["doc_id"], r["text"]) for r in docs.collect()]) if n == c}
