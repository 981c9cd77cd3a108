"""Removal of repeated passages by level-wise doubling.

A window of the full length holds windows of half of it, and can only be repeated if those are. So the
search starts at a short length; what is repeated there is extended to twice the length (the last
step may overlap), until the full length is reached or nothing is left. At the short lengths it is
enough to look, in each window of the full length still in question, at the shorter windows with the
smallest hash: every occurrence of the window picks the same ones. That is about one place in ten.

Texts are known by their 64-bit hash, so that copies are one text and their windows meet only once;
all words of a copied text with enough words are repeated by definition. Windows are known by
96 bits of hash at the full length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.storage import write_once

WINDOW = 35
BASE = 16
ROWS_AT_ONCE = 500_000

_FACTORS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xBF58476D1CE4E5B9))


def lengths(window: int = WINDOW, base: int = BASE) -> list[int]:
    """The window lengths to go through, each at least half of the next, the first no more than twice `base`."""
    out = [window]
    while out[0] > 2 * base or (out[0] > base and len(out) == 1):
        out.insert(0, -(-out[0] // 2))
    return out


def words_of(text: str | None) -> list[bytes]:
    """Runs of characters other than space and U+0009 to U+000D."""
    return (text or "").encode().split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.array([digest(w) for w in words], np.uint64)


def _mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    out = (left ^ (left >> np.uint64(29))) * _FACTORS[0] + right * _FACTORS[1]
    out = (out ^ (out >> np.uint64(32))) * _FACTORS[2]
    return out ^ (out >> np.uint64(29))


def window_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """A hash of every run of `length` words, made of the two runs of half the length that cover it."""
    if length == 1 or len(words) < length:
        return words[:max(0, len(words) - length + 1)]
    half = -(-length // 2)
    part = window_hashes(words, half)
    count = len(words) - length + 1
    return _mixed(part[:count], part[length - half:length - half + count])


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """`pick` (minimum or maximum) over every run of `width` values."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = pick(values[:-step], values[step:])
        done += step
    return values


def smallest_within(hashes: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """The smallest of every run of `span` hashes, and the places at which some run has its smallest."""
    least = _sliding(hashes, span, np.minimum)
    padded = np.zeros(len(least) + 2 * (span - 1), np.uint64)
    padded[span - 1:span - 1 + len(least)] = least
    return least, np.flatnonzero(_sliding(padded, span, np.maximum) == hashes)


def packed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, key (hash of the text), words (their number) and body (the words, one space apart, compressed)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            found = [words_of(text) for text in batch["text"]]
            yield pd.DataFrame({
                "id": batch["id"], "key": batch["key"], "words": [len(w) for w in found],
                "body": [press.compress(b" ".join(w)) for w in found],
            })

    kind = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("key"), text.alias("text"))
    return rows.mapInPandas(run, f"id {kind}, key bigint, words bigint, body binary")


def _unpacked(body: bytes) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(body).split()


class _Rows:
    """Collects rows of key, place, hash and check, and gives them out in portions."""

    def __init__(self):
        self.parts: list[tuple] = []
        self.count = 0

    def add(self, key: int, places: np.ndarray, hashes: np.ndarray, checks: np.ndarray) -> None:
        if len(places):
            self.parts.append((np.full(len(places), key, np.int64), places, hashes, checks))
            self.count += len(places)

    def take(self) -> pd.DataFrame:
        key, place, hashes, checks = (np.concatenate(c) for c in zip(*self.parts))
        self.parts, self.count = [], 0
        return pd.DataFrame({
            "key": key, "place": place.astype(np.int32), "hash": hashes.view(np.int64), "check": checks.view(np.int32)
        })


PLACES = "key bigint, place int, hash bigint, check int"


def _places(words: np.ndarray, length: int, window: int, among: np.ndarray | None = None, before: int = 0):
    """Places, hashes and checks of the windows of `length` words to look at.

    `among` are the repeated places at length `before`; without them all windows of the full length are in question.
    """
    open_windows = np.ones(len(words) - window + 1, bool)
    if among is not None:
        shorter = window_hashes(words, before)
        least = _sliding(shorter, window - before + 1, np.minimum)
        open_windows = np.isin(least, shorter[among])
    hashes = window_hashes(words, length)
    if length == window:
        places = np.flatnonzero(open_windows)
        # The check is a second hash, of the words' hashes in other bits.
        second = window_hashes(words * _FACTORS[1] ^ (words >> np.uint64(17)), window)
        return places, hashes[places], (second[places] >> np.uint64(32)).astype(np.uint32)
    span = window - length + 1
    least, places = smallest_within(hashes, span)
    if among is not None:
        places = places[np.isin(hashes[places], least[open_windows])]
    return places, hashes[places], np.zeros(len(places), np.uint32)


def _first_level(docs: DataFrame, text_col: str, length: int, window: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = _Rows()
        for batch in batches:
            for key, text in zip(batch["key"], batch["text"]):
                words = words_of(text)
                if len(words) >= window:
                    rows.add(key, *_places(word_hashes(words), length, window))
                if rows.count >= ROWS_AT_ONCE:
                    yield rows.take()
        if rows.count:
            yield rows.take()

    return docs.select(F.xxhash64(F.col(text_col)).alias("key"), F.col(text_col).alias("text")).filter(
        "text IS NOT NULL"
    ).mapInPandas(run, PLACES)


def _next_level(texts: DataFrame, survivors: DataFrame, before: int, length: int, window: int) -> DataFrame:
    """Places of `length` words in the windows whose shorter ones, at `survivors`' places, are repeated."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, last = _Rows(), None
        for batch in batches:
            for key, body, places in zip(batch["key"], batch["body"], batch["places"]):
                # Copies of a text mostly follow each other; once is enough, more do no harm.
                if key != last:
                    words = word_hashes(_unpacked(body))
                    rows.add(key, *_places(words, length, window, np.asarray(places, np.int64), before))
                    last = key
                if rows.count >= ROWS_AT_ONCE:
                    yield rows.take()
        if rows.count:
            yield rows.take()

    return texts.select("key", "body").join(survivors, "key").select("key", "body", "places").mapInPandas(run, PLACES)


def _repeated(places: DataFrame) -> DataFrame:
    """key and places: per text, the places whose window is met at another place or in another text."""
    met = places.groupBy("hash", "check").agg(
        F.min("key").alias("k1"), F.max("key").alias("k2"), F.min("place").alias("p1"), F.max("place").alias("p2")
    ).filter("k1 <> k2 OR p1 <> p2").select("hash", "check")
    # Written, so that both sides of the join are dealt out anew and Spark can split a very common window.
    found = places.join(write_once(met, "repeats-met"), ["hash", "check"])
    return found.groupBy("key").agg(F.collect_set("place").alias("places"))


def repeated_windows(
    docs: DataFrame, text_col: str = "text", window: int = WINDOW, base: int = BASE
) -> DataFrame:
    """key and places: where windows start that also start in another text, or elsewhere in the same one.

    Texts that are equal count as one here. A level without survivors ends the search.
    """
    steps = lengths(window, base)
    texts = docs.select(F.lit(0).alias("none"), F.col(text_col).alias("text"))
    level = write_once(_first_level(docs, text_col, steps[0], window), "repeats-level")
    survivors = write_once(_repeated(level), "repeats-places")
    for before, length in zip(steps, steps[1:]):
        if survivors.isEmpty():
            break
        longer = _next_level(packed(texts, "none"), survivors, before, length, window)
        level = write_once(longer, "repeats-level")
        survivors = write_once(_repeated(level), "repeats-places")
    return survivors


def covered(places, length: int, window: int) -> np.ndarray:
    """Which of `length` words lie in a window that starts at one of `places`."""
    change = np.zeros(length + 1, np.int64)
    places = np.asarray(places, np.int64)
    np.add.at(change, places, 1)
    np.add.at(change, places + window, -1)
    return np.cumsum(change[:-1]) > 0


def removal(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, base: int = BASE
) -> DataFrame:
    """Every row's id, words, removed (numbers of words) and kept, the words that stay, one space apart.

    A word goes if a window of `window` words that covers it also starts anywhere else, in this or another
    row. Windows are judged on the input. A null text has no words; a text shorter than a window keeps
    all; of equal rows, repeated ones too, each loses all words if there are enough. Ids are only carried along.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for number, count, body, places, copied in zip(
                batch["id"], batch["words"], batch["body"], batch["places"], batch["copied"]
            ):
                words = _unpacked(body)
                if count >= window and copied:
                    kept = []
                elif places is not None:
                    gone = covered(places, count, window)
                    kept = [w for w, g in zip(words, gone.tolist()) if not g]
                else:
                    kept = words
                out.append((number, count, count - len(kept), b" ".join(kept).decode()))
            yield pd.DataFrame(out, columns=["id", "words", "removed", "kept"])

    kind = docs.schema[id_col].dataType.simpleString()
    places = repeated_windows(docs, text_col, window, base)
    copies = (
        docs.filter(F.col(text_col).isNotNull()).groupBy(F.xxhash64(text_col).alias("key"))
        .agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key", F.lit(True).alias("copied"))
    )
    decided = copies.join(places, "key", "full")
    rows = packed(docs, id_col, text_col).join(decided, "key", "left")
    rows = rows.select("id", "words", "body", F.when(F.col("copied").isNull(), F.col("places")).alias("places"),
                       F.coalesce("copied", F.lit(False)).alias("copied"))
    return rows.mapInPandas(run, f"id {kind}, words bigint, removed bigint, kept string").withColumnRenamed("id", id_col)
