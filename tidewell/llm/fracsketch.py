"""Document fingerprints as threshold-scaled sketches.

A sketch keeps every shingle hash below a fixed fraction of the hash range. The same shingles are
kept in every document, so sketches merge by union, and the share of one sketch found in another
estimates how much of one document is contained in the other, however unequal their sizes. Texts of few
shingles, of which that could leave none, keep all their hashes: their sketches are whole, which the hashes above
the threshold show. Sketches are compared, and merged, on the hashes that both kinds keep.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Characters of a shingle, and one in how many hashes is kept.
WIDTH = 12
SCALE = 16
#: Texts of no more shingles keep all. With one hash in 16, longer ones keep none with a probability below 10^-7.
WHOLE = 256
# Hash digits of a fingerprint; hashes below 2**64 / 16 need 15.
DIGITS = 16
CHUNK_ROWS = 4_000
MOST_CHUNKS = 10_000
SAMPLED_PER_CHUNK = 20
SEED = 5

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def shingle_hashes(text: str, width: int = WIDTH) -> np.ndarray:
    """A 64-bit hash of every run of `width` code points; of the whole text when it is shorter; none if empty."""
    points = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64)
    width = min(width, len(points))
    if not width:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(points) - width + 1, np.uint64)
    for i in range(width):
        total = total * _BASE + points[i:i + len(total)] + np.uint64(1)
    total += np.uint64(width)
    for shift, factor in zip((30, 27), _MIX):
        total = (total ^ (total >> np.uint64(shift))) * factor
    return total ^ (total >> np.uint64(31))


def threshold(scale: int) -> np.uint64:
    """The largest hash that long texts keep."""
    return np.uint64(2**64 // scale - 1)


def sketch(text: str, width: int = WIDTH, scale: int = SCALE) -> np.ndarray:
    """The distinct hashes of the text's shingles below 2**64 / scale, or all of a short text's, in order."""
    hashes = shingle_hashes(text, width)
    return np.unique(hashes if len(hashes) <= WHOLE else hashes[hashes <= threshold(scale)])


def is_whole(hashes: np.ndarray, scale: int = SCALE) -> bool:
    """Whether a sketch shows that nothing was left out of it."""
    return not len(hashes) or hashes[-1] > threshold(scale)


def merged(left: np.ndarray, right: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """The sketch of two documents together; whole if both are."""
    union = np.union1d(left, right)
    return union if is_whole(left, scale) and is_whole(right, scale) else union[union <= threshold(scale)]


def containment(left: np.ndarray, right: np.ndarray, scale: int = SCALE) -> float:
    """The share of `left`'s shingles that are in `right`, estimated unless both sketches are whole.

    Two empty texts are alike (1), an empty one and another are not (0). A whole sketch none of whose hashes another
    that is not whole would keep gives 0.
    """
    if not len(left):
        return float(not len(right))
    if not is_whole(right, scale):
        left = left[left <= threshold(scale)]
    return float(np.isin(left, right, assume_unique=True).mean()) if len(left) else 0.0


def to_text(hashes: np.ndarray) -> str:
    return hashes.astype(">u8").tobytes().hex()


def from_text(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u8").astype(np.uint64)


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, scale: int = SCALE
) -> DataFrame:
    """id, fingerprint (its hashes in order, 16 hex digits each) and hashes (their number) of each row.

    A null text counts as empty, and an empty text has an empty fingerprint. Equal texts have equal fingerprints. Repeated rows get one each.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            kept = [sketch(text or "", width, scale) for text in batch["text"]]
            yield pd.DataFrame({
                "id": batch["id"], "fingerprint": [to_text(k) for k in kept], "hashes": [len(k) for k in kept]
            })

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = rows.mapInPandas(run, f"id {kind}, fingerprint string, hashes bigint")
    return out.withColumnRenamed("id", id_col)


def _chunk_starts(rows: DataFrame, chunk_rows: int) -> list:
    """Ids that cut the rows into ordered chunks of about `chunk_rows`, but no more than MOST_CHUNKS."""
    chunks = min(MOST_CHUNKS, max(1, rows.count() // chunk_rows))
    if chunks == 1:
        return []
    parts = [i / chunks for i in range(1, chunks)]
    if isinstance(rows.schema["id"].dataType, T.NumericType):
        found = rows.agg(F.percentile_approx("id", parts, 100_000)).first()[0] or []
    else:
        # Ids that are no numbers are cut by a sample whose size depends on the number of chunks only.
        share = min(1.0, SAMPLED_PER_CHUNK * chunks / max(1, rows.count()))
        some = sorted(r["id"] for r in rows.filter("id IS NOT NULL").select("id").sample(share, seed=SEED).collect())
        found = [some[int(p * len(some))] for p in parts] if some else []
    return sorted(set(found))


def _place(number: Column, starts: list) -> Column:
    """How many of the sorted starts are not above a number, by looking at some of them first."""
    step = max(1, int(len(starts) ** 0.5))
    count = lambda some: F.size(F.filter(some, lambda s: s <= number))
    every, heads = (F.array(*[F.lit(s) for s in some]) for some in (starts, starts[::step]))
    blocks = count(heads)
    before = (blocks - 1) * step
    return F.when(blocks == 0, 0).otherwise(before + count(F.slice(every, before + 1, F.lit(step))))


def in_order(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """chunk, wrap, ghost, id and text: within a chunk, sorted by wrap, id and text, the next document follows each row.

    Chunks are ranges of ids. Rows with the first id of a chunk are repeated, as ghosts, at the end of the chunk
    before; those with the first id of all follow the last. Null ids come first.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    starts = _chunk_starts(rows, chunk_rows)
    chunk = F.lit(0)
    if starts:
        chunk = F.when(F.col("id").isNull(), 0).otherwise(_place(F.col("id"), starts))
    rows = rows.withColumn("chunk", chunk)
    firsts = sorted(
        (r["chunk"], r["id"])
        for r in rows.groupBy("chunk").agg(F.min(F.struct("id")).alias("id")).select("chunk", "id.id").collect()
    )
    if not firsts:
        return rows.select("chunk", F.lit(0).alias("wrap"), F.lit(False).alias("ghost"), "id", "text")
    ahead = [(here, then, int(i == 0)) for i, ((_, here), (then, _)) in enumerate(zip(firsts, [firsts[-1], *firsts]))]
    kind = docs.schema[id_col].dataType.simpleString()
    ghosts = docs.sparkSession.createDataFrame(ahead, f"first {kind}, before int, wrap int")
    # At most MOST_CHUNKS rows of an id and two integers.
    joined = rows.join(F.broadcast(ghosts), F.col("id").eqNullSafe(F.col("first")), "left")
    own = F.struct(F.col("chunk"), F.lit(0).alias("wrap"), F.lit(False).alias("ghost"))
    ghost = F.struct(F.col("before").alias("chunk"), F.col("wrap"), F.lit(True).alias("ghost"))
    places = F.when(F.col("before").isNull(), F.array(own)).otherwise(F.array(own, ghost))
    return joined.select(F.explode(places).alias("at"), "id", "text").select("at.*", "id", "text")


def edited_likeness(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WIDTH,
    scale: int = SCALE,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Every row's fingerprint against those of its edited text and of the next document.

    In the edited text the last floor(n / 2) of n code points give way to the first as many, or all, of
    the next document by id; the first follows the last, and a single row is its own next. Rows that
    repeat an id follow each other by text. A null text counts as empty. Likeness is the estimated share of the
    row's shingles found in the other text: see `containment`.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = None
        for batch in batches:
            out = []
            for chunk, ghost, number, text in zip(batch["chunk"], batch["ghost"], batch["id"], batch["text"]):
                now = (chunk, ghost, number, text, sketch(text, width, scale))
                if last is not None and last[0] == chunk and not last[1]:
                    out.append(_compared(last, now, width, scale))
                last = now
            yield pd.DataFrame(out, columns=list(_COMPARED))

    kind = docs.schema[id_col].dataType.simpleString()
    rows = in_order(docs, id_col, text_col, chunk_rows)
    rows = rows.repartition("chunk").sortWithinPartitions("chunk", "wrap", "id", "text", "ghost")
    schema = f"id {kind}, " + ", ".join(f"{k} {v}" for k, v in list(_COMPARED.items())[1:])
    return rows.mapInPandas(run, schema).withColumnRenamed("id", id_col)


_COMPARED = {
    "id": "", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string",
    "edited_fingerprint": "string", "near_edited": "double", "near_next": "double",
}


def _compared(own: tuple, following: tuple, width: int, scale: int) -> tuple:
    _, _, number, text, kept = own
    half = len(text) // 2
    edited = text[:len(text) - half] + following[3][:half]
    changed = sketch(edited, width, scale)
    return (
        number, len(text), hashlib.sha256(edited.encode()).hexdigest(), to_text(kept), to_text(changed),
        containment(kept, changed, scale), containment(kept, following[4], scale),
    )
