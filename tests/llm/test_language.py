import zlib

import numpy as np
import pytest

from tests.llm.fixtures import awkward, check_awkward, with_clashes
from tidewell.llm import language
from tidewell.llm.queries import QUERIES


def small_network(seed=0):
    return language.Network.fresh(["a", "b", "c"], 4, np.random.default_rng(seed))


def test_gradients_match_differences():
    rng = np.random.default_rng(1)
    network = small_network()
    steps = rng.integers(97, 110, (7, 5)).astype(np.int16)
    steps[5:, 2] = language.PAD
    labels = np.array([0, 1, 2, 1, 0])
    for weights in network.parameters():
        weights[...] = weights.astype(np.float32)
    _, grads = network.gradients(steps, labels)
    for weights, grad in zip(network.parameters(), grads):
        order = np.argsort(-np.abs(grad), axis=None)[:6]
        for place in order:
            at = np.unravel_index(place, weights.shape)
            kept, losses = weights[at], []
            for change in (1e-2, -1e-2):
                weights[at] = kept + np.float32(change)
                losses.append(network.gradients(steps, labels)[0])
            weights[at] = kept
            assert (losses[0] - losses[1]) / 2e-2 == pytest.approx(grad[at], rel=0.05, abs=1e-4)


def test_padding_changes_nothing():
    network = small_network(2)
    text = np.frombuffer(b"some bytes", np.uint8).astype(np.int16)
    padded = np.concatenate([text, np.full(6, language.PAD, np.int16)])
    short, *_ = network.probabilities(text[:, None])
    long, *_ = network.probabilities(padded[:, None])
    assert np.allclose(short, long[:len(text)], atol=1e-5)
    assert np.allclose(short.sum(axis=1), 1, atol=1e-5)


def test_both_directions_count():
    network = small_network(3)
    one, *_ = network.probabilities(np.array([[97], [98], [99]], np.int16))
    two, *_ = network.probabilities(np.array([[97], [98], [100]], np.int16))
    three, *_ = network.probabilities(np.array([[101], [98], [99]], np.int16))
    assert not np.allclose(one[0], two[0]) and not np.allclose(one[2], three[2])


def test_whole_texts_are_read():
    """The mean over all bytes, however texts are cut and put together."""
    network = small_network(4)
    texts = ["abc " * 999 + "xyz", "q", "", "zz " * 50]
    totals, sizes = language.predict_texts(network, texts)
    for text, total, size in zip(texts, totals, sizes):
        alone, n = language.predict_texts(network, [text])
        assert np.allclose(alone[0], total, atol=1e-3) and n[0] == size == len(text)
        assert total.sum() == pytest.approx(size, rel=1e-4)


def test_held_out_accuracy(spark, folder):
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op3_language"](spark, folder).collect()
    assert {r["doc_id"] for r in rows} == set(lang)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["lang_pred"] in {*lang.values(), "und"}
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.95 * len(held)


def test_awkward(spark):
    network = small_network()
    found = check_awkward(spark, lambda docs: language.predict(docs, network))
    of = {r[0]: r[1:] for r in found}
    assert of[3] == of[4] == of[5] == of[7] == ("und", 0.0)
    assert of[1] == of[2] and of[1][0] in "abc"


def test_nothing_to_learn_from(spark):
    docs = awkward(spark).filter("lang IS NULL")
    assert language.fit(docs) is None
    assert {r["lang_pred"] for r in language.identify(docs).collect()} == {"und"}


def test_labels_of_held_out_documents_are_not_used(spark):
    rows = [(i, f"text number {i} of many", "x" if zlib.crc32(str(i).encode()) % 5 else "secret") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    assert language.fit(docs, epochs=1).langs == ["x"]


def test_keep_known_keeps_rows_whole(spark):
    docs = with_clashes(awkward(spark))
    left = language.keep_known(docs, least=0.0)
    assert left.columns == docs.columns
    assert {3, 4, 5, 7}.isdisjoint({r["doc_id"] for r in left.collect()})
