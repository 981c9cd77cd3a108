import hashlib
import random
import struct

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from tests.llm.fixtures import awkward, check_awkward
from tidewell.llm import pieces
from tidewell.llm.queries import QUERIES

MODEL = pieces.read_model(public_tokenizers.path("piece_bpe_32k.model"))
ODD = [
    "", " ", "  ", "a", " a", "\n", "\t a b\n\n c  ", "▁", "▁▁ x", "<s></s><unk>", "<0x0A>", "é é", "日本語テスト", "😀😀 a",
    "​﻿", "a" * 700, "\0a", "x\r\ny", "1234 5678", "ﬁ ①", "Ⅳ ½",
]


def fuzz(seed, count=400):
    rng = random.Random(seed)
    return ["".join(rng.choice("ab c\n é▁日😀1.<>s/\tﬁ①Å") for _ in range(rng.randrange(60))) for _ in range(count)]


def charsmap(rules):
    """A compiled character map: a double-array trie over UTF-8 keys, and the replacements."""
    texts, at = b"", {}
    for key, text in rules.items():
        at[key.encode()] = len(texts)
        texts += text.encode() + b"\0"
    units, taken, offsets = {0: 0}, {0}, set()

    def place(position, prefix):
        labels = sorted({k[len(prefix)] for k in at if k.startswith(prefix) and len(k) > len(prefix)})
        leaf = prefix in at
        free = lambda o: o not in offsets and all(o ^ c not in taken for c in labels + [0] * leaf)
        offset = next(o for o in range(1, 1 << 20) if free(o))
        offsets.add(offset)
        units[position] |= (position ^ offset) << 10 | leaf << 8
        for c in labels:
            taken.add(offset ^ c)
            units[offset ^ c] = c
        if leaf:
            taken.add(offset)
            units[offset] = at[prefix] | 1 << 31
        for c in labels:
            place(offset ^ c, prefix + bytes([c]))

    place(0, b"")
    size = (max(units) // 256 + 1) * 256
    array = [units.get(i, 0xFF) for i in range(size)]
    return struct.pack("<I", 4 * size) + struct.pack(f"<{size}I", *array) + texts


RULES = {
    "ﬁ": "fi", "①": "1", "Å": "Å", "a": "b", "ab": "x", "abc": "yy y", "　": " ", "\t": " ", "é": "", "日本": "にほん", "s": "ss",
}


def variant(**spec):
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(MODEL)
    for name, value in spec.items():
        setattr(proto.normalizer_spec, name, value)
    return proto.SerializeToString()


VARIANTS = {
    "given": MODEL,
    "map": variant(precompiled_charsmap=charsmap(RULES), name="own"),
    "map, trimmed": variant(precompiled_charsmap=charsmap(RULES), name="own", remove_extra_whitespaces=True),
    "trimmed": variant(remove_extra_whitespaces=True),
    "no prefix": variant(add_dummy_prefix=False),
}


@pytest.mark.parametrize("name", VARIANTS)
def test_ids_and_texts_equal_the_library(name):
    library = sentencepiece.SentencePieceProcessor(model_proto=VARIANTS[name])
    ours = pieces.Codec(VARIANTS[name])
    for text in ODD + fuzz(1):
        ids, first, last = ours.encode(text)
        wanted = library.encode(text, add_bos=True, add_eos=True)
        assert ids.tolist() == wanted, text
        assert ours.decode(ids) == library.decode(wanted), text
        size = len(text.encode())
        assert (first <= last).all() and (last <= size).all() and (np.diff(first) >= 0).all()


def test_rules_are_read_back():
    assert pieces.charsmap_rules(charsmap(RULES)) == RULES


def test_any_ids_decode_like_the_library():
    library, ours = sentencepiece.SentencePieceProcessor(model_proto=MODEL), pieces.Codec(MODEL)
    rng = random.Random(2)
    special = [0, 1, 2, 259, *(library.piece_to_id(p) for p in ("▁", "▁▁"))]
    for _ in range(4000):
        ids = [rng.choice([rng.choice(special), rng.randrange(3, 259), rng.randrange(32_000)]) for _ in range(rng.randrange(9))]
        assert ours.decode(np.array(ids, np.int64)) == library.decode(ids)


def test_spans_cover_the_source(spark):
    ours = pieces.Codec(MODEL)
    library = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
    for text in ODD[:9] + ["hello wörld, das ist gut", "two  spaces and aé"]:
        ids, first, last = ours.encode(text, ends=False)
        raw = text.encode()
        assert b"".join(raw[a:b] for a, b in zip(first, last)) == raw
        if all(not library.is_byte(int(i)) for i in ids):
            points = [(len(raw[:a].decode()), len(raw[:b].decode())) for a, b in zip(first, last)]
            assert points == library.EncodeAsOffsetMapping(text)["offsets"]


def test_longest_key_wins_and_is_aligned():
    ours = pieces.Codec(VARIANTS["map"])
    normal, at = ours.normalize("zabcﬁé①")
    assert normal == "▁zyy▁yfi1"
    # Source bytes: z 0, abc 1-3, fi ligature 4-6, é 7-8, circled one 9-11.
    assert at.tolist() == [0, 0, 0, 0, 1, 1, 1, 1, 1, 1, 4, 4, 9, 12]


def test_long_and_short_segments_merge_alike():
    ours = pieces.Codec(MODEL)
    rng = random.Random(3)
    for _ in range(300):
        word = "▁" + "".join(rng.choice("theraniostdl") for _ in range(rng.randrange(1, pieces.SHORT)))
        assert ours.merge(word) == ours._merge_long(list(word))


def test_round_trip_frames(spark):
    docs = awkward(spark)
    coded = pieces.encode(docs, MODEL)
    back = {(r["doc_id"], r["text"]) for r in pieces.decode(coded, MODEL).collect()}
    assert back == {(r["doc_id"], r["text"] or "") for r in docs.collect()}
    check_awkward(spark, lambda d: pieces.encode(d, MODEL))
    check_awkward(spark, lambda d: pieces.round_trip(d, MODEL))


def test_query_against_the_library(spark, folder):
    library = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = QUERIES["op9_pieces"](spark, folder).collect()
    assert len(found) == len(texts)
    for r in found:
        ids = library.encode(texts[r["doc_id"]], add_bos=True, add_eos=True)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_model_size_is_checked(tmp_path, monkeypatch):
    monkeypatch.setattr(pieces, "MOST_MODEL_BYTES", 10)
    (tmp_path / "m").write_bytes(bytes(11))
    with pytest.raises(ValueError):
        pieces.read_model(str(tmp_path / "m"))


def test_frames_are_bounded():
    # Ids and spans take ten times a text's memory, and workers keep what they once had.
    texts = [f"text number {i} of a large batch" for i in range(1000)]
    frames = list(pieces.encoded([pd.DataFrame({"id": range(1000), "text": texts})], MODEL))
    assert max(map(len, frames)) <= 100
    assert [i for f in frames for i in f["id"]] == list(range(1000))
    coder = pieces.codec(MODEL)
    assert all((coder.encode(t)[0] == ids).all() for t, ids in zip(texts, (x for f in frames for x in f["ids"])))
