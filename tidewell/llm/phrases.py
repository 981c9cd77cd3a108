"""Benchmark passages in training documents, found with an FM-index per shard.

A shard is a bounded number of words of neighbouring documents. Its words become numbers, equal documents are kept
once, and texts are cut into blocks that overlap by one word less than the longest window, so that every window lies
whole in a block and suffixes are sorted within few rounds of doubling, however much the documents repeat. The index
holds the Burrows-Wheeler transform of the blocks as a wavelet tree with ranks, and the positions of some suffixes.

Test windows are searched backwards, all at once, two ranks a word; the places of their occurrences are reached by
steps back to the next sampled suffix. Spans are merged per document. The index is written once to the shared
folder; the items are taken in blocks of bounded size, each of which goes to all tasks and over all shards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.storage import write_once

WINDOW = 10
SHARD_WORDS = 250_000
BLOCK_WORDS = 64
#: Every such place of a block is sampled.
SAMPLED = 8
#: Bytes of item texts that are searched for at a time.
ITEM_BYTES = 2_000_000
#: Occurrences looked up at a time.
AT_ONCE = 200_000

_TO_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    """A-Z in lower case; words are runs of letters, digits and all characters beyond ASCII."""
    return text.translate(_TO_WORDS).split() if text else []


class Numbers(dict):
    """Words to numbers from 1, in the order in which they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self) + 1
        return number


class WaveletTree:
    """Ranks of symbols in a sequence: one bit vector a level, zeros before ones at the next."""

    def __init__(self, size: int, levels: int, bits: np.ndarray, counts: np.ndarray):
        self.size, self.levels, self.bits, self.counts = size, levels, bits, counts
        self.zeros = [size - int(self._ones(level, np.array([size]))[0]) for level in range(levels)]

    @classmethod
    def of(cls, symbols: np.ndarray, levels: int) -> WaveletTree:
        size = len(symbols)
        row = size // 64 + 1
        bits = np.zeros((levels, row), np.uint64)
        counts = np.zeros((levels, row), np.uint32)
        for level in range(levels):
            bit = (symbols >> (levels - 1 - level) & 1).astype(np.uint8)
            padded = np.zeros(row * 64, np.uint8)
            padded[:size] = bit
            bits[level] = np.packbits(padded, bitorder="little").view("<u8")
            counts[level, 1:] = np.cumsum(np.bitwise_count(bits[level]), dtype=np.uint32)[:-1]
            ones = bit.astype(bool)
            symbols = np.concatenate([symbols[~ones], symbols[ones]])
        return cls(size, levels, bits, counts)

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        """Number of ones before each place of a level."""
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.counts[level][word] + np.bitwise_count(self.bits[level][word] & below).astype(np.int64)

    def descend(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where `at` places of the sequence lead in the symbol's part of the last level."""
        for level in range(self.levels):
            ones = self._ones(level, at)
            at = np.where(symbols >> (self.levels - 1 - level) & 1, self.zeros[level] + ones, at - ones)
        return at

    def symbols_at(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of places, and where these lead in the last level."""
        symbols = np.zeros(len(at), np.int64)
        for level in range(self.levels):
            bit = self.bits[level][at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)
            ones = self._ones(level, at)
            at = np.where(bit == 1, self.zeros[level] + ones, at - ones)
            symbols = symbols << 1 | bit.astype(np.int64)
        return symbols, at


def sorted_suffixes(text: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Places of the text in the order of their suffixes, by doubling.

    `text` has numbers from 1, and 0 after each block; `ends` are the places of the zeros. An earlier block's end is
    smaller than a later one's and ends are smaller than words, so all suffixes differ before or at their block's end.
    """
    size = len(text)
    rank = text.astype(np.int64) + len(ends) - 1
    rank[ends] = np.arange(len(ends))
    limit = int(rank.max()) + 1
    width = 1
    key = rank
    while limit ** (width + 1) < 1 << 62 and width < 4:
        follows = np.zeros(size, np.int64)
        follows[:max(0, size - width)] = rank[width:]
        key = key * limit + follows
        width += 1
    order = np.argsort(key, kind="stable")
    new = np.empty(size, bool)
    new[0] = True
    np.not_equal(key[order[1:]], key[order[:-1]], out=new[1:])
    while True:
        # A suffix's rank is the place at which its equals start.
        starts = np.flatnonzero(new)
        rank = np.empty(size, np.int64)
        lengths = np.diff(np.append(starts, size))
        rank[order] = np.repeat(starts, lengths)
        open_rows = np.flatnonzero(np.repeat(lengths > 1, lengths))
        if not len(open_rows):
            return order
        places = order[open_rows]
        after = places + width
        follows = np.where(after < size, rank[np.minimum(after, size - 1)], -1)
        key = rank[places] * (size + 1) + follows + 1
        sub = np.argsort(key, kind="stable")
        order[open_rows] = places[sub]
        key = key[sub]
        new[open_rows[1:]] |= key[1:] != key[:-1]
        width *= 2


@dataclass
class Shard:
    """An FM-index over the blocks of a shard's distinct texts."""

    words: Numbers
    #: Numbers of words of the distinct texts.
    lengths: np.ndarray
    tree: WaveletTree
    #: Per symbol: number of smaller ones.
    smaller: np.ndarray
    sampled: np.ndarray
    places: np.ndarray

    def __post_init__(self):
        every = np.arange(len(self.smaller))
        self.base = self.smaller - self.tree.descend(every, np.zeros(len(every), np.int64))
        self.sampled_before = np.concatenate([[0], np.cumsum(self.sampled)])

    def search(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of the window and its interval of suffixes, of the windows (rows of word numbers) that occur."""
        which = np.arange(len(windows))
        low, high = np.zeros(len(windows), np.int64), np.full(len(windows), self.tree.size, np.int64)
        for column in range(windows.shape[1] - 1, -1, -1):
            symbols = windows[which, column]
            low = self.base[symbols] + self.tree.descend(symbols, low)
            high = self.base[symbols] + self.tree.descend(symbols, high)
            there = low < high
            which, low, high = which[there], low[there], high[there]
        return which, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The places in the text of suffixes given by their rank."""
        places = np.zeros(len(rows), np.int64)
        walking = np.arange(len(rows))
        steps = 0
        while len(walking):
            here = self.sampled[rows]
            done = walking[here]
            places[done] = self.places[self.sampled_before[rows[here]]] + steps
            walking, rows = walking[~here], rows[~here]
            symbols, at = self.tree.symbols_at(rows)
            rows = self.base[symbols] + at
            steps += 1
        return places


def blocks_of(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, first word and number of words of every block; the next starts before the last window does not fit."""
    step = BLOCK_WORDS - window + 1
    many = np.maximum(1, -(-(lengths - window + 1) // step))
    text = np.repeat(np.arange(len(lengths)), many)
    first = (np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)) * step
    return text, first, np.minimum(BLOCK_WORDS, lengths[text] - first)


def build(texts: list[list[int]], words: Numbers, window: int) -> Shard:
    """The index of distinct texts, given as word numbers."""
    lengths = np.array([len(t) for t in texts], np.int64)
    flat = np.fromiter((w for t in texts for w in t), np.int64, int(lengths.sum()))
    text, first, size = blocks_of(lengths, window)
    starts = (np.cumsum(lengths) - lengths)[text] + first
    ends = np.cumsum(size + 1) - 1
    begins = ends - size
    whole = np.zeros(int(ends[-1]) + 1, np.int64)
    inside = np.arange(len(whole)) - np.repeat(begins, size + 1)
    is_word = np.ones(len(whole), bool)
    is_word[ends] = False
    whole[is_word] = flat[(np.repeat(starts, size + 1) + inside)[is_word]]
    order = sorted_suffixes(whole, ends)
    transform = whole[order - 1]
    sampled = (inside % SAMPLED == 0)[order]
    counts = np.bincount(whole, minlength=len(words) + 1)
    levels = max(1, int(len(words)).bit_length())
    return Shard(words, lengths, WaveletTree.of(transform, levels), np.cumsum(counts) - counts, sampled, order[sampled])


INDEX_SCHEMA = (
    "shard string, ids array<{kind}>, n_words array<bigint>, text_of binary, words binary, lengths binary, size bigint, levels int, bits binary, "
    "counts binary, smaller binary, sampled binary, places binary"
)


def _stored(shard: Shard, name: str, ids: list[pa.Array], text_of: list[int]) -> pa.RecordBatch:
    kept = pa.concat_arrays(ids)
    tree = shard.tree
    one = lambda value: pa.array([value], pa.binary())
    return pa.RecordBatch.from_arrays(
        [
            pa.array([name]), pa.ListArray.from_arrays(pa.array([0, len(kept)], pa.int32()), kept),
            pa.array([[int(shard.lengths[t]) if t >= 0 else 0 for t in text_of]], pa.list_(pa.int64())),
            one(np.array(text_of, "<i4").tobytes()), one(b" ".join(shard.words)), one(shard.lengths.astype("<i8").tobytes()),
            pa.array([tree.size], pa.int64()), pa.array([tree.levels], pa.int32()), one(tree.bits.tobytes()),
            one(tree.counts.tobytes()), one(shard.smaller.astype("<i8").tobytes()), one(np.packbits(shard.sampled).tobytes()),
            one(shard.places.astype("<i4").tobytes()),
        ],
        names=["shard", "ids", "n_words", "text_of", "words", "lengths", "size", "levels", "bits", "counts", "smaller", "sampled", "places"],
    )


def _loaded(row: dict) -> Shard:
    words = Numbers()
    for word in row["words"].split(b" "):
        words[word]
    levels, size = row["levels"], row["size"]
    tree = WaveletTree(
        size, levels, np.frombuffer(row["bits"], "<u8").reshape(levels, -1), np.frombuffer(row["counts"], "<u4").reshape(levels, -1)
    )
    sampled = np.unpackbits(np.frombuffer(row["sampled"], np.uint8), count=size).astype(bool)
    return Shard(
        words, np.frombuffer(row["lengths"], "<i8"), tree, np.frombuffer(row["smaller"], "<i8"), sampled,
        np.frombuffer(row["places"], "<i4").astype(np.int64),
    )


def index(docs: DataFrame, id_col: str, text_col: str, window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """One row per shard: its documents' ids, which distinct text each has, and the index; documents without words,
    which nothing can be found in, have text -1."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count = TaskContext.get().partitionId(), 0
        ids: list[pa.Array] = []
        text_of: list[int] = []
        words, texts, known, held = Numbers(), [], {}, 0

        def ended() -> pa.RecordBatch:
            shard = build(texts or [[words[b"-"]]], words, window)
            return _stored(shard, f"{part}-{count}", ids, text_of)

        for batch in batches:
            start, column = 0, batch.column("text")
            for i in range(batch.num_rows):
                found = words_of(column[i].as_py())
                if not found:
                    text_of.append(-1)
                    continue
                digest = hashlib.blake2b(b" ".join(found), digest_size=16).digest()
                if digest not in known:
                    known[digest] = len(texts)
                    texts.append(list(map(words.__getitem__, found)))
                    held += len(found)
                text_of.append(known[digest])
                if held >= shard_words:
                    ids.append(batch.column("id")[start:i + 1])
                    yield ended()
                    start, count = i + 1, count + 1
                    ids, text_of = [], []
                    words, texts, known, held = Numbers(), [], {}, 0
            ids.append(batch.column("id")[start:])
        if text_of:
            yield ended()

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    return write_once(rows.mapInArrow(run, INDEX_SCHEMA.format(kind=kind)), "phrase-index")


@dataclass
class Windows:
    """The distinct windows of a block of items, by their number of words."""

    vocabulary: list[bytes]
    #: Per length: rows of places in the vocabulary.
    rows: dict[int, np.ndarray]
    #: Per length: items of each row, all in one array, and where each row's begin.
    items: dict[int, tuple[np.ndarray, np.ndarray]]
    names: list[str | None]


def windows_of(items: list[tuple[str | None, bytes | None]], window: int = WINDOW) -> Windows:
    """An item of fewer words than a window, but not none, is one window."""
    words = Numbers()
    by_length: dict[int, list[tuple[np.ndarray, int]]] = {}
    names = sorted({name for name, _ in items if name is not None})
    place = {name: i for i, name in enumerate(names)}
    for name, text in items:
        numbers = np.array([words[w] - 1 for w in words_of(text)], np.int64)
        if len(numbers):
            rows = np.lib.stride_tricks.sliding_window_view(numbers, min(window, len(numbers)))
            by_length.setdefault(rows.shape[1], []).append((rows, place.get(name, -1)))
    out = Windows(list(words), {}, {}, names)
    for length, parts in by_length.items():
        distinct, which = np.unique(np.concatenate([r for r, _ in parts]), axis=0, return_inverse=True)
        item = np.repeat([i for _, i in parts], [len(r) for r, _ in parts])
        pairs = np.unique(np.stack([which.reshape(-1), item], axis=1), axis=0)
        starts = np.searchsorted(pairs[:, 0], np.arange(len(distinct) + 1))
        out.rows[length], out.items[length] = distinct, (pairs[:, 1], starts)
    return out


def _spread(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of several ranges, and the range each is from."""
    many = ends - starts
    which = np.repeat(np.arange(len(starts)), many)
    return np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many) + starts[which], which


def hits(shard: Shard, windows: Windows, window: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Text, starts and ends of its merged spans, and its items (places in the names), of every text that is hit."""
    text, first, size = blocks_of(shard.lengths, window)
    ends = np.cumsum(size + 1) - 1
    begins = ends - size
    offsets = np.concatenate([[0], np.cumsum(shard.lengths)])
    change = np.zeros(offsets[-1] + 1, np.int64)
    met: list[np.ndarray] = []
    local = np.array([shard.words.get(w, 0) for w in windows.vocabulary], np.int64)
    for length, rows in windows.rows.items():
        here = local[rows]
        known = np.flatnonzero((here > 0).all(axis=1))
        which, low, high = shard.search(here[known])
        items, starts = windows.items[length]
        for i in range(0, len(which), 1 + AT_ONCE // 64):
            part = slice(i, i + 1 + AT_ONCE // 64)
            ranks, of = _spread(low[part], high[part])
            of = known[which[part]][of]
            for j in range(0, len(ranks), AT_ONCE):
                places = shard.locate(ranks[j:j + AT_ONCE])
                block = np.searchsorted(ends, places)
                begin = offsets[text[block]] + first[block] + places - begins[block]
                change += np.bincount(begin, minlength=len(change))
                change -= np.bincount(begin + length, minlength=len(change))
                # The pairs of a text and a window are distinct before items are looked up.
                pairs = np.unique(np.stack([text[block], of[j:j + AT_ONCE]], axis=1), axis=0)
                item, pair = _spread(starts[pairs[:, 1]], starts[pairs[:, 1] + 1])
                pairs = np.stack([pairs[pair, 0], items[item]], axis=1)
                met.append(np.unique(pairs[pairs[:, 1] >= 0], axis=0))
                if sum(map(len, met)) > 4 * AT_ONCE:
                    met = [np.unique(np.concatenate(met), axis=0)]
    covered = np.cumsum(change[:-1]) > 0
    pairs = np.unique(np.concatenate(met), axis=0) if met else np.zeros((0, 2), np.int64)
    total = np.concatenate([[0], np.cumsum(covered)])
    for number in np.flatnonzero(total[offsets[1:]] > total[offsets[:-1]]).tolist():
        mask = np.concatenate([[False], covered[offsets[number]:offsets[number + 1]], [False]])
        edges = np.flatnonzero(mask[1:] != mask[:-1])
        a, b = np.searchsorted(pairs[:, 0], [number, number + 1])
        yield number, edges[::2], edges[1::2], pairs[a:b, 1]


def search(indexed: DataFrame, items: list[tuple[str | None, bytes | None]], window: int = WINDOW) -> DataFrame:
    """shard, row (place of the document in its shard), starts and ends of the spans, and items found."""
    shared = indexed.sparkSession.sparkContext.broadcast(windows_of(items, window))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                text_of = np.frombuffer(row["text_of"], "<i4")
                found = {n: rest for n, *rest in hits(_loaded(row), shared.value, window)}
                there = [k for k, t in enumerate(text_of.tolist()) if t in found]
                names = shared.value.names
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["shard"]] * len(there), pa.string()), pa.array(there, pa.int32()),
                        pa.array([found[text_of[k]][0].tolist() for k in there], pa.list_(pa.int64())),
                        pa.array([found[text_of[k]][1].tolist() for k in there], pa.list_(pa.int64())),
                        pa.array([[names[n] for n in found[text_of[k]][2]] for k in there], pa.list_(pa.string())),
                    ],
                    names=["shard", "row", "starts", "ends", "items"],
                )

    columns = [c for c in indexed.columns if c not in ("ids", "n_words")]
    return indexed.select(*columns).mapInArrow(
        run, "shard string, row int, starts array<bigint>, ends array<bigint>, items array<string>"
    )


def _merged(found: DataFrame) -> DataFrame:
    """One row per document of the rows that several blocks of items gave; spans that touch or overlap become one."""
    spans = F.array_sort(F.flatten(F.collect_list(F.arrays_zip("starts", "ends"))))

    def add(done, span):
        last = F.element_at(done, -1)
        longer = F.concat(
            F.slice(done, 1, F.size(done) - 1),
            F.array(F.struct(last["starts"].alias("starts"), F.greatest(last["ends"], span["ends"]).alias("ends"))),
        )
        apart = F.size(done) == 0
        return F.when(apart, F.array(span)).when(last["ends"] < span["starts"], F.concat(done, F.array(span))).otherwise(longer)

    whole = found.groupBy("shard", "row").agg(
        spans.alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items")
    )
    joined = F.aggregate("spans", F.array().cast("array<struct<starts:bigint,ends:bigint>>"), add)
    whole = whole.withColumn("spans", joined)
    return whole.select("shard", "row", F.col("spans.starts").alias("starts"), F.col("spans.ends").alias("ends"), "items")


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    shard_words: int = SHARD_WORDS,
    item_bytes: int = ITEM_BYTES,
) -> DataFrame:
    """id, n_words, starts and ends of the spans of words to remove, and items (ids as strings, sorted) of each row.

    A word is hit when it lies in an occurrence of a run of `window` words of an item, or of a whole shorter item.
    Texts without words, null ones too, have no spans, and items without words are in none. Items that repeat an id
    are one item; those without id mark words but are not listed. Rows may repeat ids or have none. No documents give
    no rows; no items leave all documents clean. Other columns are not read.
    """
    indexed = index(docs, id_col, text_col, window, shard_words)
    rows = items.select(F.col(f"`{item_col}`").cast("string").alias("name"), F.col(f"`{item_text_col}`").cast("binary").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    blocks = max(1, -(-size // item_bytes))
    found = None
    for block in range(blocks):
        # About `item_bytes` of texts.
        part = rows.filter(F.pmod(F.xxhash64("name", "text"), F.lit(blocks)) == block).collect()
        here = write_once(search(indexed, [(r["name"], r["text"]) for r in part], window), "phrase-hits")
        found = here if found is None else found.unionByName(here)
    if blocks > 1:
        found = _merged(found)
    listed = indexed.select("shard", F.posexplode(F.arrays_zip("ids", "n_words")).alias("row", "doc"))
    none = F.array().cast("array<bigint>")
    return listed.join(found, ["shard", "row"], "left").select(
        F.col("doc.ids").alias(id_col),
        F.col("doc.n_words").alias("n_words"),
        F.coalesce("starts", none).alias("starts"),
        F.coalesce("ends", none).alias("ends"),
        F.array_sort(F.coalesce("items", F.array().cast("array<string>"))).alias("items"),
    )
