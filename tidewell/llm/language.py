"""Language identification with a bidirectional gated recurrent network over bytes.

Texts are cut into windows of bytes. One gated recurrent unit reads a window forwards and one
backwards; from both states every byte gets a probability for each language, and a document's are the means
over all its bytes. The network is trained in numpy, by backpropagation through time, on a bounded
sample of labelled documents; its few thousand numbers go to the tasks with the function.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewell.storage import write_once

UNDETERMINED = "und"
#: The training sample: so many documents of each language, and windows of each document.
DOCS_PER_LANG = 150
WINDOWS_PER_DOC = 12

#: A document whose score is below so many times that of chance has no known language; with four languages, below 0.4.
LEAST_OVER_CHANCE = 1.6

WINDOW_BYTES = 64
HIDDEN = 8
PAD = 256
WINDOWS_AT_ONCE = 4096
EPOCHS = 6
BATCH = 128
RATE = 0.02


def windows_of(raw: np.ndarray, width: int = WINDOW_BYTES) -> np.ndarray:
    """Byte values in rows of `width`; the last row is filled up with PAD."""
    rows = -(-len(raw) // width)
    out = np.full(rows * width, PAD, np.int16)
    out[:len(raw)] = raw
    return out.reshape(rows, width)


@dataclass
class Network:
    """Weights of both directions and of the output, and the languages in order."""

    langs: list[str]
    reads: list[np.ndarray]  # per direction, 3 * hidden x 257: what a byte adds to update, reset and new state
    turns: list[np.ndarray]  # per direction, 3 * hidden x hidden
    out: np.ndarray  # languages x 2 * hidden
    bias: np.ndarray

    @staticmethod
    def fresh(langs: list[str], hidden: int, rng: np.random.Generator) -> Network:
        reads, turns = [], []
        for _ in range(2):
            read = rng.normal(0, 0.5, (3 * hidden, PAD + 1)).astype(np.float32)
            # Padding keeps the state: the update gate is shut.
            read[:, PAD] = 0
            read[:hidden, PAD] = 40
            reads.append(read)
            turns.append(rng.normal(0, hidden**-0.5, (3 * hidden, hidden)).astype(np.float32))
        out = rng.normal(0, 0.3, (len(langs), 2 * hidden)).astype(np.float32)
        return Network(langs, reads, turns, out, np.zeros((len(langs), 1), np.float32))

    def parameters(self) -> list[np.ndarray]:
        return [*self.reads, *self.turns, self.out, self.bias]

    def states(self, steps: np.ndarray, way: int, keep: list | None = None) -> np.ndarray:
        """States after every step, steps x hidden x windows. `steps`: steps x windows of byte values."""
        read, turn = self.reads[way], self.turns[way]
        hidden = turn.shape[1]
        state = np.zeros((hidden, steps.shape[1]), np.float32)
        out = np.empty((len(steps), hidden, steps.shape[1]), np.float32)
        for i in range(len(steps)) if way == 0 else range(len(steps) - 1, -1, -1):
            given = read.take(steps[i], axis=1)
            turned = turn @ state
            gates = given[:2 * hidden]
            gates += turned[:2 * hidden]
            gates *= 0.5
            np.tanh(gates, out=gates)
            gates *= 0.5
            gates += 0.5
            update, reset = gates[:hidden], gates[hidden:]
            new = given[2 * hidden:]
            new += reset * turned[2 * hidden:]
            np.tanh(new, out=new)
            if keep is not None:
                keep.append((i, state, update, reset, new, turned[2 * hidden:]))
            state = np.add(new, update * (state - new), out=out[i])
        return out

    def probabilities(self, steps: np.ndarray, ahead: list | None = None, back: list | None = None):
        """Probabilities of the languages, steps x languages x windows, and the states of both directions."""
        one, two = self.states(steps, 0, ahead), self.states(steps, 1, back)
        hidden = one.shape[1]
        scores = np.matmul(self.out[:, :hidden], one)
        scores += np.matmul(self.out[:, hidden:], two)
        scores += self.bias
        scores -= scores.max(axis=1, keepdims=True)
        np.exp(scores, out=scores)
        scores /= scores.sum(axis=1, keepdims=True)
        return scores, one, two

    def gradients(self, steps: np.ndarray, labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean loss per byte and its gradients, by backpropagation through time."""
        kept: tuple[list, list] = ([], [])
        probs, one, two = self.probabilities(steps, *kept)
        real = (steps != PAD).astype(np.float32)
        count = max(1.0, float(real.sum()))
        right = np.take_along_axis(probs, np.broadcast_to(labels, (len(steps), 1, len(labels))), axis=1)[:, 0]
        loss = float(-(np.log(right + 1e-9) * real).sum() / count)
        error = probs.copy()
        error[:, labels, np.arange(len(labels))] -= 1
        error *= real[:, None, :] / count
        hidden = one.shape[1]
        both = np.concatenate([one, two], axis=1)
        d_out = np.einsum("tlb,thb->lh", error, both)
        d_bias = error.sum(axis=(0, 2))[:, None]
        d_both = np.einsum("lh,tlb->thb", self.out, error)
        d_reads, d_turns = [], []
        for way in range(2):
            turn = self.turns[way]
            d_read, d_turn = np.zeros_like(self.reads[way]), np.zeros_like(turn)
            passed = np.zeros((hidden, steps.shape[1]), np.float32)
            from_out = d_both[:, way * hidden:(way + 1) * hidden]
            for i, state, update, reset, new, turned in reversed(kept[way]):
                d_state = from_out[i] + passed
                d_new = d_state * (1 - update) * (1 - new * new)
                d_update = d_state * (state - new) * update * (1 - update)
                d_reset = d_new * turned * reset * (1 - reset)
                d_given = np.concatenate([d_update, d_reset, d_new])
                d_turned = np.concatenate([d_update, d_reset, d_new * reset])
                d_turn += d_turned @ state.T
                passed = d_state * update + turn.T @ d_turned
                onehot = np.zeros((PAD + 1, steps.shape[1]), np.float32)
                onehot[steps[i], np.arange(steps.shape[1])] = 1
                d_read += d_given @ onehot.T
            d_read[:, PAD] = 0
            d_reads.append(d_read)
            d_turns.append(d_turn)
        return loss, [*d_reads, *d_turns, d_out, d_bias]


def train(
    windows: np.ndarray,
    labels: np.ndarray,
    langs: list[str],
    hidden: int = HIDDEN,
    epochs: int = EPOCHS,
    batch: int = BATCH,
    rate: float = RATE,
    seed: int = 3,
) -> Network:
    """Fit a network to windows (rows of byte values) and the numbers of their languages, by Adam."""
    rng = np.random.default_rng(seed)
    network = Network.fresh(langs, hidden, rng)
    weights = network.parameters()
    first = [np.zeros_like(w) for w in weights]
    second = [np.zeros_like(w) for w in weights]
    step, total = 0, epochs * -(-len(windows) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), batch):
            some = order[at:at + batch]
            _, grads = network.gradients(np.ascontiguousarray(windows[some].T), labels[some])
            step += 1
            pace = rate * (1 - (step - 1) / total)
            for w, g, m, v in zip(weights, grads, first, second):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w -= (pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return network


def held_out(doc_id) -> object:
    """Whether a document is kept from training: crc32 of its id as text is divisible by 5; a null id is."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "utf-8")) % 5 == 0, F.lit(True))


def fit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    docs_per_lang: int = DOCS_PER_LANG,
    windows_per_doc: int = WINDOWS_PER_DOC,
    **training,
) -> Network | None:
    """Train on documents that are not held out and have a language; None if there are none.

    The driver gets `docs_per_lang` documents of each language, those with the smallest hash of their id, and of
    each `windows_per_doc` windows, evenly spaced over the whole text.
    """
    order = F.xxhash64(F.col("id"), F.lit(3))
    labelled = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    labelled = labelled.filter(F.col("lang").isNotNull() & ~held_out(F.col("id")) & F.col("text").rlike(r"\p{L}"))
    rank = F.row_number().over(W.partitionBy("lang").orderBy(order, "id"))
    chosen = labelled.select("id", "lang").withColumn("rank", rank).filter(F.col("rank") <= docs_per_lang)
    chosen = write_once(chosen.select("id", "lang"), "language-sample")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            langs, parts = [], []
            for text, lang in zip(batch["text"], batch["lang"]):
                rows = windows_of(np.frombuffer(text.encode(), np.uint8))
                for i in np.unique(np.linspace(0, len(rows) - 1, windows_per_doc).astype(int)):
                    langs.append(lang)
                    parts.append(rows[i].astype("<i2").tobytes())
            yield pd.DataFrame({"lang": langs, "window": parts})

    sample = labelled.join(chosen, ["id", "lang"]).select("text", "lang").mapInPandas(cut, "lang string, window binary")
    rows = sorted((r["lang"], bytes(r["window"])) for r in sample.collect())
    if not rows:
        return None
    langs = sorted({lang for lang, _ in rows})
    windows = np.stack([np.frombuffer(raw, "<i2") for _, raw in rows])
    labels = np.array([langs.index(lang) for lang, _ in rows])
    return train(windows, labels, langs, **training)


def predict_texts(network: Network, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the probabilities over all bytes, texts x languages, and the numbers of bytes."""
    raws = [np.frombuffer(text.encode(), np.uint8) for text in texts]
    sizes = np.array([len(r) for r in raws])
    totals = np.zeros((len(texts), len(network.langs)))
    pending: list[np.ndarray] = []
    owners: list[np.ndarray] = []
    count = 0

    def flush() -> None:
        nonlocal pending, owners, count
        if not count:
            return
        windows, owner = np.concatenate(pending), np.concatenate(owners)
        for at in range(0, len(windows), WINDOWS_AT_ONCE):
            steps = np.ascontiguousarray(windows[at:at + WINDOWS_AT_ONCE].T)
            probs, _, _ = network.probabilities(steps)
            probs *= (steps != PAD)[:, None, :]
            np.add.at(totals, owner[at:at + WINDOWS_AT_ONCE], probs.sum(axis=0).T)
        pending, owners, count = [], [], 0

    for i, raw in enumerate(raws):
        if len(raw):
            rows = windows_of(raw)
            pending.append(rows)
            owners.append(np.full(len(rows), i))
            count += len(rows)
            if count >= 4 * WINDOWS_AT_ONCE:
                flush()
    flush()
    return totals, sizes


def predictor(network: Network | None):
    """A function from a text column to lang_pred and score; see `predict`."""

    @F.pandas_udf("lang_pred string, score double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            known = texts.notna().to_numpy() & (network is not None)
            lang = np.full(len(texts), UNDETERMINED, object)
            score = np.zeros(len(texts))
            if known.any():
                totals, sizes = predict_texts(network, texts[known].tolist())
                best = totals.argmax(axis=1)
                lang[known] = np.array(network.langs, object)[best]
                score[known] = np.clip(totals[np.arange(len(best)), best] / sizes, 0, 1)
            yield pd.DataFrame({"lang_pred": lang, "score": score})

    return lambda text: of(F.when(text.rlike(r"\p{L}"), text))


def predict(docs: DataFrame, network: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's id, lang_pred and score, the mean probability of that language over all bytes.

    A text that is null or has no letter, and any text if there is no network, is `und` with score 0. Only the text
    is read; equal texts get equal results. Of equally likely languages the first by name is taken.
    """
    found = docs.select(F.col(id_col), predictor(network)(F.col(text_col)).alias("found"))
    return found.select(id_col, "found.lang_pred", "found.score")


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """id, held_out, lang_pred and score of every row, with a network trained on the rows not held out."""
    network = fit(docs, id_col, text_col, lang_col)
    found = predict(docs, network, id_col, text_col)
    return found.select(id_col, held_out(F.col(id_col)).alias("held_out"), "lang_pred", "score")


def keep_known(
    docs: DataFrame,
    least: float = LEAST_OVER_CHANCE,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """The rows of `docs` that have a language, with a score of at least `least` times that of chance, which is one
    divided by the number of languages, in the columns of `docs`."""
    network = fit(docs, id_col, text_col, lang_col)
    least = least / len(network.langs) if network is not None else 1.0
    found = docs.select(F.struct("*").alias("row"), predictor(network)(F.col(text_col)).alias("found"))
    return found.filter((F.col("found.lang_pred") != UNDETERMINED) & (F.col("found.score") >= least)).select("row.*")
