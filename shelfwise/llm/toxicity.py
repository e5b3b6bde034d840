"""Toxic texts by a small convolutional network over hashed words, trained in numpy."""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.common import annotate, prepare_text, words_of

BUCKETS = (1 << 16) - 1
STEMS = (4, 5)  # a word's vector is that of itself and of its first so many bytes, so that inflected forms share a part
WIDTHS = (1, 2, 3)
DIMENSION = FILTERS = 16
LEARN_ROWS_BY_CLASS = 3_000
THRESHOLD = 0.7
# Function words that tell the language of a text; fixed values. The column `lang` is never read.
LANGUAGE_WORDS = {
    "en": "the of and to in is that it for was on with as are at by this from",
    "de": "der die das und ist nicht ein eine zu mit von den auf für im dem sich auch",
    "fr": "le la les de des et un une est que pour dans en du au ne pas sur",
    "es": "el la los las de y un una que es en por con del para se no al",
}
LANGUAGES = (*LANGUAGE_WORDS, "other")
PAD = BUCKETS  # one more bucket, always zero, between documents


class _Buckets(dict):
    """Buckets of each word and its stems, 16 bits each, remembered for the words met most lately."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        value = zlib.crc32(word) % BUCKETS
        for k, length in enumerate(STEMS, 1):
            value |= zlib.crc32(word[:length], k) % BUCKETS << 16 * k
        self[word] = value
        return value


_buckets = _Buckets()


def buckets_of(text: bytes) -> np.ndarray:
    """A row of buckets for each word."""
    words = words_of(text)
    return unpack(np.fromiter(map(_buckets.__getitem__, words), np.int64, len(words)))


def pack(rows: np.ndarray) -> np.ndarray:
    return sum((rows[:, k].astype(np.int64) << 16 * k for k in range(1, rows.shape[1])), rows[:, 0].astype(np.int64))


def unpack(packed: np.ndarray) -> np.ndarray:
    return np.stack([(packed >> 16 * k & 0xFFFF).astype(np.int32) for k in range(len(STEMS) + 1)], axis=1)


def _padded(rows: np.ndarray, n: int) -> np.ndarray:
    return np.concatenate([rows, np.full((n, rows.shape[1]), PAD, rows.dtype)])


def _gather(values: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sum of the values of each row's buckets."""
    out = values[rows[:, 0]]
    for k in range(1, rows.shape[1]):
        out = out + values[rows[:, k]]
    return out


def _language_table() -> np.ndarray:
    out = np.zeros((BUCKETS + 1, len(LANGUAGE_WORDS)), np.float32)
    for i, words in enumerate(LANGUAGE_WORDS.values()):
        for word in words.encode().split():
            out[zlib.crc32(word) % BUCKETS, i] = 1
    return out


_LANGUAGE_TABLE = _language_table()


def guess_language(ids: np.ndarray) -> int:
    """Index in `LANGUAGES` of the language with the most function words; the last one for none."""
    counts = _LANGUAGE_TABLE[ids[:, 0]].sum(axis=0)
    return int(counts.argmax()) if len(ids) and counts.max() > 0 else len(LANGUAGES) - 1


@dataclass
class ToxicityModel:
    embedding: np.ndarray
    filters: list[np.ndarray]  # by width: (width, DIMENSION, FILTERS)
    biases: list[np.ndarray]
    dense: np.ndarray
    intercept: float
    cuts: list[float] = field(default_factory=lambda: [0.0] * len(LANGUAGES))
    _tables: list | None = None

    def tables(self) -> list[list[np.ndarray]]:
        """Filter responses of each bucket at each place of a window, so that scoring only gathers and adds."""
        if self._tables is None:
            self._tables = [[self.embedding @ w[j] for j in range(len(w))] for w in self.filters]
        return self._tables

    def pooled(self, ids: np.ndarray) -> np.ndarray:
        """Largest response of each filter over all windows of one text. Texts are processed whole, in blocks."""
        out = []
        for tables, bias in zip(self.tables(), self.biases):
            best = np.zeros(FILTERS, np.float32)
            width = len(tables)
            padded = _padded(ids, width - 1)
            for start in range(0, len(ids), 8192):
                block = padded[start : start + 8192 + width - 1]
                n = len(block) - width + 1
                response = _gather(tables[0], block[:n])
                for j in range(1, width):
                    response += _gather(tables[j], block[j : j + n])
                best = np.maximum(best, response.max(axis=0) + bias)
            out.append(best)
        return np.concatenate(out)

    def margin(self, ids: np.ndarray) -> float:
        return float(self.pooled(ids) @ self.dense + self.intercept)

    def score(self, ids: np.ndarray) -> float:
        """Probability, moved so that the cut of the text's language lies at `THRESHOLD`."""
        z = self.margin(ids) - self.cuts[guess_language(ids)] + np.log(THRESHOLD / (1 - THRESHOLD))
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def new_model(seed: int = 1) -> ToxicityModel:
    random = np.random.default_rng(seed)
    embedding = random.normal(0, 0.02, (BUCKETS + 1, DIMENSION)).astype(np.float32)
    embedding[PAD] = 0
    filters = [random.normal(0, 0.5 / np.sqrt(w), (w, DIMENSION, FILTERS)).astype(np.float32) for w in WIDTHS]
    biases = [np.full(FILTERS, 0.0, np.float32) for _ in WIDTHS]
    return ToxicityModel(embedding, filters, biases, random.normal(0, 0.3, FILTERS * len(WIDTHS)).astype(np.float32), 0.0)


class _Adam:
    def __init__(self, shape, rate: float):
        self.m, self.v, self.t, self.rate = np.zeros(shape, np.float32), np.zeros(shape, np.float32), 0, rate

    def step(self, value: np.ndarray, gradient: np.ndarray, rows: np.ndarray | None = None) -> None:
        """In place; with `rows` only those rows move."""
        self.t += 1
        at = slice(None) if rows is None else rows
        self.m[at] = 0.9 * self.m[at] + 0.1 * gradient
        self.v[at] = 0.99 * self.v[at] + 0.01 * gradient**2
        value[at] -= self.rate * (self.m[at] / (1 - 0.9**self.t)) / (np.sqrt(self.v[at] / (1 - 0.99**self.t)) + 1e-7)


def word_evidence(texts: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """By how many deviations a bucket occurs in more toxic texts than chance would have it: where training starts from.

    Most words are rare; a word in one toxic text says little, one in five of them and in no other a lot.
    """
    counts = np.zeros((2, BUCKETS), np.float32)
    for ids, label in zip(texts, labels):
        counts[int(label > 0), np.unique(ids)] += 1
    total = counts.sum(axis=0)
    expected = total * labels.mean()
    return np.clip((counts[1] - expected) / np.sqrt(expected * (1 - labels.mean()) + 1), -4, 8).astype(np.float32)


def train(texts: list[np.ndarray], labels: np.ndarray, epochs: int = 8, batch: int = 32, rate: float = 0.01, seed: int = 1) -> ToxicityModel:
    """Gradient steps on whole texts. Through the max pooling, only the window that won moves a filter and its words."""
    model = new_model(seed)
    random = np.random.default_rng(seed)
    if not len(labels) or labels.min() == labels.max():
        model.dense[:] = 0
        share = float(np.clip(labels.mean(), 0.01, 0.99)) if len(labels) else 0.5
        model.intercept = float(np.log(share / (1 - share)))
        return model
    model.embedding[:BUCKETS, 0] = 0.5 * word_evidence(texts, labels)
    for filters in model.filters:
        filters[:, 0, : FILTERS // 2] += np.float32(1)
        filters[:, 0, FILTERS // 2 :] -= np.float32(1)
    for k in range(len(WIDTHS)):
        model.dense[k * FILTERS : (k + 1) * FILTERS] = np.float32(0.05) * np.repeat(np.float32([1, -1]), FILTERS // 2)
    intercept = np.zeros(1, np.float32)
    adams = {"e": _Adam(model.embedding.shape, rate), "d": _Adam(model.dense.shape, rate), "i": _Adam(1, rate)}
    for k, w in enumerate(WIDTHS):
        adams[f"f{k}"], adams[f"b{k}"] = _Adam(model.filters[k].shape, rate), _Adam(FILTERS, rate)
    weight = np.where(labels > 0, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
    for _ in range(epochs):
        order = random.permutation(len(texts))
        for start in range(0, len(order), batch):
            chosen = order[start : start + batch]
            pooled = np.zeros((len(chosen), len(WIDTHS) * FILTERS), np.float32)
            winners = []
            for row, i in enumerate(chosen):
                ids = texts[i]
                won = []
                for k, width in enumerate(WIDTHS):
                    padded = _padded(ids, width - 1)
                    if not len(ids):
                        won.append(None)
                        continue
                    vectors = _gather(model.embedding, padded)
                    response = vectors[: len(ids)] @ model.filters[k][0]
                    for j in range(1, width):
                        response += vectors[j : j + len(ids)] @ model.filters[k][j]
                    at = response.argmax(axis=0)
                    best = response[at, np.arange(FILTERS)] + model.biases[k]
                    pooled[row, k * FILTERS : (k + 1) * FILTERS] = np.maximum(best, 0)
                    won.append(padded[at[:, None] + np.arange(width)])
                winners.append(won)
            p = 1 / (1 + np.exp(-(pooled @ model.dense + intercept[0])))
            error = ((p - labels[chosen]) * weight[chosen] / len(chosen)).astype(np.float32)
            back = error[:, None] * model.dense * (pooled > 0)
            rows, grads = [], []
            for k, width in enumerate(WIDTHS):
                part = back[:, k * FILTERS : (k + 1) * FILTERS]
                filter_gradient = np.zeros_like(model.filters[k])
                for row, won in enumerate(winners):
                    if won[k] is None:
                        continue
                    windows = won[k]  # (FILTERS, width, buckets)
                    for j in range(width):
                        filter_gradient[j] += (_gather(model.embedding, windows[:, j]) * part[row][:, None]).T
                        for bucket in windows[:, j].T:
                            rows.append(bucket)
                            grads.append(part[row][:, None] * model.filters[k][j].T)
                adams[f"f{k}"].step(model.filters[k], filter_gradient + 1e-4 * model.filters[k])
                adams[f"b{k}"].step(model.biases[k], part.sum(axis=0))
            dense_gradient = pooled.T @ error + 1e-4 * model.dense
            if rows:
                touched, where = np.unique(np.concatenate(rows), return_inverse=True)
                total = np.zeros((len(touched), DIMENSION), np.float32)
                np.add.at(total, where, np.concatenate(grads))
                adams["e"].step(model.embedding, total, touched)
                model.embedding[PAD] = 0
            adams["d"].step(model.dense, dense_gradient)
            adams["i"].step(intercept, error.sum(keepdims=True))
    model.intercept = float(intercept[0])
    return model


def _best_cut(margins: np.ndarray, labels: np.ndarray, negatives_per_row: float) -> float:
    """The middle of the widest gap among cuts with the best F1, each negative row standing for `negatives_per_row`."""
    order = np.argsort(margins)
    z, y = margins[order], labels[order]
    hits = np.concatenate([np.cumsum(y[::-1])[::-1], [0.0]])
    false = np.concatenate([np.cumsum((1 - y)[::-1])[::-1], [0.0]]) * negatives_per_row
    f1 = 2 * hits / (hits + false + y.sum())
    edges = np.concatenate([[z[0] - 2], z, [z[-1] + 2]])
    good = np.flatnonzero(f1 >= f1.max() - 1e-12)
    k = good[np.argmax(edges[good + 1] - edges[good])]
    return float((edges[k] + edges[k + 1]) / 2)


def calibrate(model: ToxicityModel, texts: list[np.ndarray], labels: np.ndarray, negatives_per_row: float = 1.0, least: int = 15) -> None:
    """A cut for each language that has `least` rows of both classes; one over all rows for the others."""
    if not len(labels) or labels.min() == labels.max():
        return
    margins = np.array([model.margin(x) for x in texts])
    languages = np.array([guess_language(x) for x in texts])
    every = _best_cut(margins, labels, negatives_per_row)
    for i in range(len(LANGUAGES)):
        own = languages == i
        enough = min((labels[own] > 0).sum(), (labels[own] == 0).sum()) >= least
        model.cuts[i] = _best_cut(margins[own], labels[own], negatives_per_row) if enough else every


def learn(docs: DataFrame, labels: DataFrame, learnable: Column, label: str = "toxic", doc_id: str = "doc_id", text: str = "text", rows: int = LEARN_ROWS_BY_CLASS) -> ToxicityModel:
    """Model from at most `rows` labelled documents of each class, chosen by a hash of their id, a quarter of them for
    the cuts. Null ids and labels are not used; of repeated labels the largest counts."""
    prepare_text(docs.sparkSession)
    once = labels.filter(learnable & F.col(doc_id).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(doc_id).alias("_id")).agg(F.max(label).cast("int").alias("_label"))
    sizes = {r["_label"]: r["count"] for r in once.groupBy("_label").count().collect()}
    chosen = None
    for value in (0, 1):
        some = once.filter(F.col("_label") == value).orderBy(F.xxhash64("_id"), "_id").limit(rows)
        chosen = some if chosen is None else chosen.unionByName(some)
    # At most twice `rows` ids: safe to broadcast.
    joined = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(chosen), "_id")

    def compute(texts: list[bytes]) -> list[pa.Array]:
        return [pa.array([pack(buckets_of(x)).tobytes() for x in texts], pa.binary())]

    coded = annotate(joined, "_text", compute, {"_words": T.BinaryType()}, ["_id", "_label"])
    # Ids may repeat in the documents: the bound is put on the rows as well.
    got = coded.orderBy(F.xxhash64("_id"), "_id", "_words").limit(2 * rows).collect()
    texts, y = [unpack(np.frombuffer(r["_words"], np.int64)) for r in got], np.array([r["_label"] for r in got], np.float32)
    last = np.arange(len(y)) % 4 == 3
    first_texts = [t for t, x in zip(texts, last) if not x]
    model = train(first_texts, y[~last])
    negatives = max(int((y == 0).sum()), 1)
    positives = max(int((y == 1).sum()), 1)
    share = (sizes.get(0, 0) / negatives) / max(sizes.get(1, 0) / positives, 1e-9)
    held = [t for t, x in zip(texts, last) if x]
    if len(held) and 0 < y[last].mean() < 1:
        calibrate(model, held, y[last], max(share, 1.0))
    else:
        calibrate(model, texts, y, max(share, 1.0))
    return model


def score_toxicity(docs: DataFrame, model: ToxicityModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) of every whole text; null and empty texts have the score of no words. The model has a fixed size.

    Repeated rows are scored each for itself, very long texts as a whole; an empty table gives an empty result.
    """
    prepare_text(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compute(texts: list[bytes]) -> list[pa.Array]:
        return [pa.array([shared.value.score(buckets_of(x)) for x in texts], pa.float64())]

    return annotate(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text", compute, {"score": T.DoubleType()}, ["doc_id"])
