"""SentencePiece BPE encoding that keeps offsets, and decoding.

Normalisation walks the text and at each place takes the longest key of the model's compiled
character map, or else one character, and notes for every byte it puts out at which byte of the
source it came from. Merging then works on the normalised text, and each piece is projected back to
a span of source bytes. Spark deals out the texts; a task encodes one text at a time.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import re
import struct
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
UNKNOWN_BYTE = "�"

# Kinds of pieces in a model file; fixed values.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6

MOST_MODEL_BYTES = 16 << 20
# Segments a task remembers. Only the time depends on it.
REMEMBERED = 250_000
# Texts whose ids and spans are sent at once: these take many times the texts' memory.
ENCODED_AT_ONCE = 64
NO_PIECE = float("-inf")
# Up to this length a plain search for the best pair beats a heap.
SHORT = 24


def charsmap_rules(blob: bytes) -> dict[str, str]:
    """The compiled character map as key -> replacement.

    The blob is the size of a double-array trie, the trie's 32-bit units, and the replacements
    as texts that end in a zero byte; a leaf holds its replacement's place.
    """
    if not blob:
        return {}
    size = struct.unpack_from("<I", blob)[0]
    units = np.frombuffer(blob, "<u4", size // 4, 4).tolist()
    texts = blob[4 + size:]
    rules: dict[str, str] = {}

    def below(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    stack = [(below(units[0]), b"")]
    while stack:
        place, key = stack.pop()
        for byte in range(1, 0xF5):  # no byte of UTF-8 is higher
            child = place ^ byte
            if child >= len(units) or units[child] & 0x800000FF != byte:
                continue
            unit, longer = units[child], key + bytes([byte])
            inner = child ^ below(unit)
            if unit >> 8 & 1:
                start = units[inner] & 0x7FFFFFFF
                rules[longer.decode()] = texts[start:texts.index(b"\0", start)].decode()
            stack.append((inner, longer))
    return rules


class _Remembered(dict):
    """Results of a function, worked out when first asked for."""

    def __init__(self, work):
        self.work = work

    def __missing__(self, segment: str) -> bytes:
        part = self.work(segment)
        if len(segment) <= 64:
            if len(self) >= REMEMBERED:
                self.clear()
            self[segment] = part
        return part


class Codec:
    """Encodes and decodes with one model."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        if proto.trainer_spec.model_type != proto.trainer_spec.BPE:
            raise ValueError("the model is not a BPE model")
        spec = proto.normalizer_spec
        self.escape, self.prefix, self.trim = spec.escape_whitespaces, spec.add_dummy_prefix, spec.remove_extra_whitespaces
        self.suffix = proto.trainer_spec.treat_whitespace_as_suffix
        if self.suffix:
            raise ValueError("models with spaces as suffixes are not supported")
        self.rules = charsmap_rules(spec.precompiled_charsmap)
        self.reach: dict[str, int] = {}
        for key in self.rules:
            self.reach[key[0]] = max(self.reach.get(key[0], 0), len(key))
        self.kinds = [p.type for p in proto.pieces]
        self.is_control = np.array(self.kinds) == CONTROL
        self.names = [p.piece for p in proto.pieces]
        if USER_DEFINED in self.kinds or UNUSED in self.kinds:
            raise ValueError("models with user-defined or unused pieces are not supported")
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces)}
        self.scores = {p.piece: p.score for p in proto.pieces if p.type == NORMAL}
        self.unknown = self.kinds.index(UNKNOWN)
        self.unknown_text = proto.trainer_spec.unk_surface.encode()
        self.bos, self.eos = proto.trainer_spec.bos_id, proto.trainer_spec.eos_id
        self.byte_ids = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == BYTE}
        self.fallback = proto.trainer_spec.byte_fallback
        # Merges cannot cross a place that no piece of several characters spans.
        longer = [p for p in self.scores if len(p) > 1]
        joined = {c for p in longer for c in p} - {SPACE}
        inside = re.compile(f"[^{SPACE}]{SPACE}")
        if any(inside.search(p) for p in longer):
            self.segments = re.compile(r"(?s).+")
        elif joined:
            letters = "".join(map(re.escape, sorted(joined)))
            self.segments = re.compile(f"(?s){SPACE}*[{letters}]+|{SPACE}+|.")
        else:
            self.segments = re.compile(f"(?s){SPACE}+|.")
        self.surfaces = [self._surface(i) for i in range(len(self.names))]
        self.remembered = _Remembered(self._segment)

    # Normalisation.

    def normalize(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its bytes, and its end, the source byte it starts at."""
        if not text:
            return "", np.zeros(1, np.int64)
        if not self.rules and not self.trim and self.escape:
            return self._escaped(text)
        out: list[str] = []
        at: list[int] = []
        space, is_space = SPACE if self.escape else " ", self.trim
        place = source = 0
        if self.trim:  # leading spaces count as read before the prefix is put out
            while place < len(text):
                piece, n = self._longest(text, place)
                if piece != " ":
                    break
                source += len(text[place:place + n].encode())
                place += n
            if place == len(text):
                return "", np.array([source])
        if self.prefix:
            out.append(space)
            at += [source] * len(space.encode())
        while place < len(text):
            piece, n = self._longest(text, place)
            if is_space:
                piece = piece.lstrip(" ")
            if piece:
                is_space = piece.endswith(" ") and self.trim
                shown = piece.replace(" ", space)
                out.append(shown)
                at += [source] * len(shown.encode())
            source += len(text[place:place + n].encode())
            place += n
        normal = "".join(out)
        if self.trim:
            kept = normal.rstrip(space)
            cut = len(kept.encode())
            if cut < len(at):
                source, normal, at = at[cut], kept, at[:cut]
        return normal, np.array(at + [source])

    def _longest(self, text: str, place: int) -> tuple[str, int]:
        for n in range(self.reach.get(text[place], 0), 0, -1):
            found = self.rules.get(text[place:place + n])
            if found is not None and place + n <= len(text):
                return found, n
        return text[place], 1

    def _escaped(self, text: str) -> tuple[str, np.ndarray]:
        """`normalize` where the map is empty and spaces stay: every space turns into three bytes."""
        source = np.frombuffer(text.encode(), np.uint8)
        wide = np.where(source == 32, 3, 1)
        at = np.repeat(np.arange(len(source)), wide)
        lead = [0, 0, 0] if self.prefix else []
        normal = (SPACE if self.prefix else "") + text.replace(" ", SPACE)
        return normal, np.concatenate([np.array(lead, np.int64), at, np.array([len(source)])])

    # Merging.

    def merge(self, segment: str) -> list[str]:
        """The pieces of a segment: the pair with the highest score is joined first, the leftmost of equals."""
        parts = list(segment)
        if len(parts) > SHORT:
            return self._merge_long(parts)
        score = self.scores.get
        gains = [score(a + b, NO_PIECE) for a, b in zip(parts, parts[1:])]
        while gains:
            best = max(gains)
            if best == NO_PIECE:
                break
            where = gains.index(best)
            both = parts[where] = parts[where] + parts.pop(where + 1)
            del gains[where]
            if where:
                gains[where - 1] = score(parts[where - 1] + both, NO_PIECE)
            if where < len(gains):
                gains[where] = score(both + parts[where + 1], NO_PIECE)
        return parts

    def _merge_long(self, parts: list[str]) -> list[str]:
        count = len(parts)
        before, after = list(range(-1, count - 1)), [*range(1, count), -1]
        heap: list[tuple[float, int, int, str]] = []

        def offer(left: int, right: int) -> None:
            if left >= 0 and right >= 0:
                both = parts[left] + parts[right]
                gain = self.scores.get(both)
                if gain is not None:
                    heapq.heappush(heap, (-gain, left, right, both))

        for i in range(count - 1):
            offer(i, i + 1)
        while heap:
            _, left, right, both = heapq.heappop(heap)
            if not parts[left] or not parts[right] or len(parts[left]) + len(parts[right]) != len(both):
                continue
            parts[left], parts[right] = both, ""
            after[left] = after[right]
            if after[right] >= 0:
                before[after[right]] = left
            offer(before[left], left)
            offer(left, after[left])
        return [p for p in parts if p]

    def _segment(self, segment: str) -> bytes:
        """A segment's ids and each id's share of its bytes, as 64-bit integers: id times 2**32, plus the share."""
        out: list[int] = []
        for piece in self.merge(segment):
            found = self.ids.get(piece, self.unknown)
            raw = piece.encode()
            if found == self.unknown and self.fallback:
                # All bytes of a character but the last have empty spans, before it.
                out += [self.byte_ids[b] << 32 for b in raw]
                out[-1] += len(raw)
            else:
                out.append(found << 32 | len(raw))
        return array("Q", out).tobytes()

    def encode(self, text: str, ends: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and the first and the end byte of each id's span in the UTF-8 text."""
        normal, at = self.normalize(text)
        known = self.remembered
        parts = [known[segment] for segment in self.segments.findall(normal)]
        both = np.frombuffer(b"".join(parts), np.uint64)
        ids, sizes = (both >> np.uint64(32)).astype("<u4"), (both & np.uint64(0xFFFFFFFF)).astype(np.int64)
        if not self.fallback and self.unknown in ids:
            ids, sizes = self._one_unknown(ids, sizes)
        edges = np.concatenate([[0], np.cumsum(sizes)])
        first, last = at[edges[:-1]], at[edges[1:]]
        if ends:
            close = at[-1:]
            ids = np.concatenate([[self.bos], ids, [self.eos]]).astype("<u4")
            first, last = np.concatenate([[0], first, close]), np.concatenate([[0], last, close])
        return ids, first, last

    def _one_unknown(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Neighbouring unknown pieces become one."""
        new = np.ones(len(ids), bool)
        new[1:] = (ids[1:] != self.unknown) | (ids[:-1] != self.unknown)
        return ids[new], np.add.reduceat(sizes, np.flatnonzero(new))

    # Decoding.

    def _surface(self, number: int) -> bytes:
        kind = self.kinds[number]
        if kind == CONTROL:
            return b""
        if kind == UNKNOWN:
            return self.unknown_text
        if kind == BYTE:
            return bytes([int(self.names[number][3:5], 16)])
        return self.names[number].replace(SPACE, " ").encode()

    def decode(self, ids: np.ndarray) -> str:
        """The text of some ids; bytes that form no character become U+FFFD each."""
        numbers = ids.tolist()
        table = self.surfaces
        raw = [table[i] for i in numbers]
        if self.prefix or self.trim:
            for i, number in enumerate(numbers):
                if self.kinds[number] == CONTROL:
                    continue
                if self.kinds[number] == NORMAL:
                    raw[i] = raw[i].removeprefix(b" ")
                    if self.trim and not raw[i]:
                        continue
                break
        # No character reaches over a control piece.
        breaks = np.flatnonzero(self.is_control[ids]).tolist()
        parts = [raw[a:b] for a, b in zip([0, *breaks], [*breaks, len(raw)])]
        return "".join([_text(b"".join(part)) for part in parts])


def _text(raw: bytes) -> str:
    """`raw` as text, with every byte that belongs to no valid character replaced."""
    out = []
    while True:
        try:
            return "".join([*out, raw.decode()])
        except UnicodeDecodeError as error:
            out += [raw[:error.start].decode(), UNKNOWN_BYTE]
            raw = raw[error.start + 1:]


def read_model(path: str) -> bytes:
    """A model file's bytes, which go to the tasks with the function; it must be small."""
    with open(path, "rb") as file:
        model = file.read()
    if len(model) > MOST_MODEL_BYTES:
        raise ValueError(f"{path} has {len(model)} bytes, more than {MOST_MODEL_BYTES}")
    return model


@functools.lru_cache(maxsize=2)
def codec(model: bytes) -> Codec:
    """One codec per worker process and model."""
    return Codec(model)


def encoded(batches: Iterator[pd.DataFrame], model: bytes) -> Iterator[pd.DataFrame]:
    """id, ids, starts and ends of the rows of each batch (id and text), in frames of bounded size."""
    coder = codec(model)
    for batch in batches:
        for at in range(0, len(batch), ENCODED_AT_ONCE):
            some = batch.iloc[at:at + ENCODED_AT_ONCE]
            coded = [coder.encode(text or "") for text in some["text"]]
            yield pd.DataFrame({
                "id": some["id"].to_numpy(),
                "ids": [c[0].astype(np.int32) for c in coded],
                "starts": [c[1] for c in coded],
                "ends": [c[2] for c in coded],
            })


def encode(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ids, starts and ends (bytes of the source) of each row; a null text counts as empty.

    Begin and end ids stand around every text, the empty one too. Repeated rows are encoded each.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    out = rows.mapInPandas(lambda batches: encoded(batches, model), f"id {kind}, ids array<int>, starts array<bigint>, ends array<bigint>")
    return out.withColumnRenamed("id", id_col)


def decode(rows: DataFrame, model: bytes, id_col: str = "doc_id") -> DataFrame:
    """id and text of rows with `ids`; null ids give a null text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = codec(model)
        for batch in batches:
            texts = [None if ids is None else coder.decode(np.asarray(ids, np.int64)) for ids in batch["ids"]]
            yield pd.DataFrame({"id": batch["id"], "text": texts})

    kind = rows.schema[id_col].dataType.simpleString()
    out = rows.select(F.col(id_col).alias("id"), "ids").mapInPandas(run, f"id {kind}, text string")
    return out.withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digests of encoding each text and decoding its ids again, in one pass.

    id, n_tokens, ids_sha256 (ids as little-endian unsigned 32-bit integers), decoded_sha256, spans_sha256 (first and end
    bytes as little-endian signed 64-bit integers, one list after the other). Nulls as in `encode`.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = codec(model)
        for batch in batches:
            out = []
            for text in batch["text"]:
                ids, first, last = coder.encode(text or "")
                out.append((
                    len(ids),
                    hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(),
                    hashlib.sha256(coder.decode(ids).encode()).hexdigest(),
                    hashlib.sha256(first.astype("<i8").tobytes() + last.astype("<i8").tobytes()).hexdigest(),
                ))
            done = pd.DataFrame(out, columns=["n_tokens", "ids_sha256", "decoded_sha256", "spans_sha256"])
            done.insert(0, "id", batch["id"].to_numpy())
            yield done

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string, spans_sha256 string"
    return rows.mapInPandas(run, schema).withColumnRenamed("id", id_col)
