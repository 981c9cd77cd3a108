"""SimHash near-duplicates found with Golay-code fuzzy hashing.

A fingerprint's 64 bits are three segments of 23, 23 and 18 bits. The binary Golay code of
length 23 is perfect: every 23-bit word lies within 3 bits of exactly one codeword. The codeword
indices of a word and of its 23 one-bit neighbours are one to six keys, and two words that differ in at
most two bits share at least one of them, since a word between both is a neighbour of each.

With at most four differing bits in all, either some segment agrees: then of the two others one
differs in at most two bits, and the agreeing segment's bits together with the other's key are shared. Or
all segments differ: then two of them differ in one bit each and the third in one or two. One half of either of the
two and one third of the third agree, and so do the parities of the two taken together; these bits are a
key. Joining on these keys, of about 30 bits, meets every pair of fingerprints to be linked; each is verified.

Only linked groups are wanted, not all pairs within them. Fingerprints are first linked to the smallest and
the largest one under each key, which needs no pairs; a key all of whose fingerprints are then
in one group is done. Pairs are formed only across groups.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.components import components
from tidewell.storage import write_once

WORDS = 4
MOST_BITS = 4
SEED = 42
SHINGLES_AT_ONCE = 1 << 16

# First bit and width of the segments.
SEGMENTS = ((0, 23), (23, 23), (46, 18))
#: Generator polynomial of the Golay code of length 23, x^11 + x^9 + x^7 + x^6 + x^5 + x + 1; a fixed value.
GENERATOR = 0b101011100011


def simhash(text: str | None, width: int = WORDS) -> int:
    """The 64-bit fingerprint of a text: a bit is set if it is in over half of the shingles' hashes.

    A-Z are lower-cased; words are runs of characters other than space and U+0009 to U+000D. Fewer
    than `width` words are one shingle; a text without words, or null, has fingerprint 0.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = min(width, len(words)) - 1
    firsts, stops = starts[:len(words) - last].tolist(), ends[last:].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for i in range(0, len(firsts), SHINGLES_AT_ONCE):
        spans = zip(firsts[i:i + SHINGLES_AT_ONCE], stops[i:i + SHINGLES_AT_ONCE])
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(firsts), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WORDS) -> DataFrame:
    """id and fp, the fingerprint as a signed 64-bit integer, of each row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = np.array([simhash(text, width) for text in batch["text"]], np.uint64)
            yield pd.DataFrame({"id": batch["id"], "fp": found.view(np.int64)})

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(run, f"id {kind}, fp bigint")


# The Golay code.


def _syndromes(words: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words as polynomials, divided by the generator."""
    rest = words.astype(np.int64)
    for bit in range(22, 10, -1):
        rest = rest ^ ((rest >> bit & 1) * (GENERATOR << bit - 11))
    return rest


def _error_patterns() -> np.ndarray:
    """The error of at most three bits for each of the 2048 remainders."""
    bits = [1 << i for i in range(23)]
    errors = [0, *bits]
    errors += [a | b for i, a in enumerate(bits) for b in bits[:i]]
    errors += [a | b | c for i, a in enumerate(bits) for j, b in enumerate(bits[:i]) for c in bits[:j]]
    patterns = np.array(errors, np.int64)
    table = np.full(2048, -1, np.int64)
    table[_syndromes(patterns)] = patterns
    assert (table >= 0).all() and len(patterns) == 2048
    return table


_ERRORS = _error_patterns()


def codeword_index(words: np.ndarray) -> np.ndarray:
    """12-bit index of the codeword within 3 bits of each 23-bit word."""
    return (words ^ _ERRORS[_syndromes(words)]) >> 11


def near_indices(words: np.ndarray, width: int = 23) -> np.ndarray:
    """For each word, the codeword indices of it and its one-bit neighbours in the first `width` bits; repeats are -1."""
    flips = np.array([0, *(1 << i for i in range(width))], np.int64)
    found = np.sort(codeword_index(words[:, None] ^ flips[None, :]), axis=1)
    found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
    return found


def pieces_of(segment: int, count: int) -> list[tuple[int, int]]:
    """First bit and width of the pieces into which a segment is cut."""
    at, width = SEGMENTS[segment]
    cuts = [at + -(-width * k // count) for k in range(count + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def golay_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in `prints` and keys, one row per key: kind, and agreeing bits and index or agreeing bits alone."""
    whole = prints.astype(np.uint64)
    parts = [
        (whole >> np.uint64(at) & np.uint64((1 << width) - 1)).astype(np.int64) for at, width in SEGMENTS
    ]
    near = [near_indices(part, width) for part, (_, width) in zip(parts, SEGMENTS)]
    rows, keys = [], []
    kind = 0
    for i, part in enumerate(parts):
        for j, indices in enumerate(near):
            if i != j:
                row, column = np.nonzero(indices >= 0)
                rows.append(row)
                keys.append((kind << 35) | (part[row] << 12) | indices[row, column])
                kind += 1
    odd = [np.bitwise_count(part.astype(np.uint64)).astype(np.int64) & 1 for part in parts]
    every = np.arange(len(prints))
    for i, j, rest in ((0, 1, 2), (0, 2, 1), (1, 2, 0)):
        # The bits of one half each and of a third, side by side; a single different bit turns either parity.
        for halves in product(pieces_of(i, 2), pieces_of(j, 2), pieces_of(rest, 3)):
            key = odd[i] ^ odd[j]
            for at, width in halves:
                key = key << width | (whole >> np.uint64(at) & np.uint64((1 << width) - 1)).astype(np.int64)
            rows.append(every)
            keys.append((kind << 35) | key)
            kind += 1
    return np.concatenate(rows), np.concatenate(keys)


def keyed(prints: DataFrame) -> DataFrame:
    """key and fp: every fingerprint under all its keys, about 70."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            prints = batch["fp"].to_numpy()
            for i in range(0, len(prints), 2048):
                some = prints[i:i + 2048]
                rows, keys = golay_keys(some.view(np.uint64))
                yield pd.DataFrame({"key": keys, "fp": some[rows]})

    # Few bytes come in and seventy times as many go out: all shuffle partitions take part.
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return prints.select("fp").repartition(parts).mapInPandas(run, "key bigint, fp bigint")


def _close(a, b, most_bits: int):
    return F.bit_count(a.bitwiseXOR(b)) <= most_bits


def linked_groups(prints: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """fp and root, the smallest fingerprint that links reach, for the linked ones of distinct fingerprints `fp`.

    `most_bits` may be at most 4, up to which the keys lose no pair.
    """
    if most_bits > MOST_BITS:
        raise ValueError("the keys find pairs of up to four differing bits")
    keys = write_once(keyed(prints), "simhash-keys")
    ends = keys.groupBy("key").agg(F.min("fp").alias("low"), F.max("fp").alias("high"), F.count(F.lit(1)).alias("n"))
    # Keys with one fingerprint are gone from here on, and those with two that are not linked.
    linked = (F.col("n") > 2) | _close(F.col("low"), F.col("high"), most_bits)
    ends = ends.filter((F.col("low") != F.col("high")) & linked)
    shared = write_once(keys.join(ends, "key"), "simhash-shared")
    fp, low, high = F.col("fp"), F.col("low"), F.col("high")
    stars = [
        shared.filter((fp != end) & _close(fp, end, most_bits)).select(fp.alias("a"), end.alias("b")) for end in (low, high)
    ]
    stars = stars[0].unionByName(stars[1])
    first = write_once(components(stars), "simhash-groups")
    # Of up to three fingerprints the stars have compared every pair.
    known = shared.filter("n > 3").select("key", "fp").join(first.withColumnRenamed("node", "fp"), "fp", "left").select(
        "key", "fp", F.coalesce("root", "fp").alias("root")
    )
    known = write_once(known, "simhash-known")
    mixed = known.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high")
    open_keys = write_once(known.join(mixed.select("key"), "key"), "simhash-open")
    left, right = open_keys.alias("l"), open_keys.alias("r")
    across = left.join(
        right,
        (F.col("l.key") == F.col("r.key"))
        & (F.col("l.root") < F.col("r.root"))
        & _close(F.col("l.fp"), F.col("r.fp"), most_bits),
    ).select(F.col("l.root").alias("a"), F.col("r.root").alias("b"))
    second = components(across)
    # Groups of the first step move to the root that links across groups lead to.
    moved = first.alias("f").join(second.alias("s"), F.col("f.root") == F.col("s.node"), "left").select(
        F.col("f.node").alias("fp"), F.coalesce("s.root", "f.root").alias("root")
    )
    alone = second.alias("s").join(first.alias("f"), F.col("s.node") == F.col("f.node"), "left_anti").select(
        F.col("s.node").alias("fp"), F.col("s.root").alias("root")
    )
    return moved.unionByName(alone)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WORDS, most_bits: int = MOST_BITS
) -> DataFrame:
    """Every row's id, fingerprint (16 hex digits) and component_id, the smallest id that links reach.

    Rows are linked if their fingerprints differ in at most `most_bits` bits. Texts without words, and null
    ones, have fingerprint 0 and are linked like any other. Repeated rows have equal results. A component
    without any id has a null component_id. An empty table gives no rows.
    """
    rows = write_once(fingerprints(docs, id_col, text_col, width), "simhash-prints")
    prints = rows.groupBy("fp").agg(F.min("id").alias("least"))
    groups = write_once(linked_groups(prints, most_bits), "simhash-linked")
    by_print = prints.join(groups, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    by_root = by_print.groupBy("root").agg(F.min("least").alias("component_id"))
    named = by_print.join(by_root, "root").select("fp", "component_id")
    return rows.join(named, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` whose id is the smallest of their component, with all their columns."""
    kept = near_duplicates(docs, id_col, text_col).filter(F.col(id_col).eqNullSafe(F.col("component_id")))
    kept = kept.select(F.col(id_col).alias("_kept")).distinct()
    return docs.alias("_d").join(kept, F.col(f"_d.`{id_col}`").eqNullSafe(F.col("_kept")), "left_semi").select("_d.*")
