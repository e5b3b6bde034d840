"""Text quality by a sparse ensemble of rules over text statistics."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.common import annotate, fresh, prepare_text

LEARN_ROWS = 20_000
THRESHOLD = 0.3
STATISTICS = (
    "log_bytes", "log_words", "word_bytes", "upper_share", "digit_share", "sentence_mark_share", "exclamation_share", "bar_share",
    "symbol_share", "blank_share", "non_ascii_share", "distinct_word_share", "top_word_share", "short_word_share",
    "marked_word_share", "distinct_line_share", "line_bytes", "distinct_triple_share",
)


def _byte_classes() -> np.ndarray:
    members = [
        range(65, 91), range(97, 123), range(48, 58), b".,;:?'\"()-", b"!", b"|", b"#$%&*+/<=>@[\\]^_`{}~", b" \t\n\x0b\x0c\r", range(128, 256),
    ]
    out = np.zeros((256, len(members)))
    for i, values in enumerate(members):
        out[list(values), i] = 1
    return out


_CLASSES = _byte_classes()


def statistics(text: bytes) -> list[float]:
    """The values named in `STATISTICS`; all zero for the empty text."""
    if not text:
        return [0.0] * len(STATISTICS)
    n = len(text)
    upper, lower, digits, marks, exclamations, bars, symbols, blanks, other = np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ _CLASSES
    words = text.split()
    m = max(len(words), 1)
    counts: dict[bytes, int] = {}
    for word in words:
        counts[word] = counts.get(word, 0) + 1
    triples = len(set(zip(words, words[1:], words[2:])))
    lines = [x for x in text.split(b"\n") if x]
    return [
        float(np.log1p(n)), float(np.log1p(len(words))), n / m, upper / max(upper + lower, 1), digits / n, marks / n, exclamations / n,
        bars / n, symbols / n, blanks / n, other / n, len(counts) / m, max(counts.values(), default=0) / m,
        sum(c for w, c in counts.items() if len(w) <= 3) / m, min((exclamations + symbols + bars) / m, 9.0),
        len(set(lines)) / max(len(lines), 1), float(np.log1p(n / max(len(lines), 1))), triples / max(len(words) - 2, 1),
    ]


def with_statistics(df: DataFrame, text: str, column: str, keep: list[str] | None = None) -> DataFrame:
    def compute(texts: list[bytes]) -> list[pa.Array]:
        flat = np.array([statistics(x) for x in texts], np.float64).reshape(-1)
        offsets = np.arange(len(texts) + 1, dtype=np.int32) * len(STATISTICS)
        return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))]

    return annotate(df, text, compute, {column: T.ArrayType(T.DoubleType())}, keep)


Condition = tuple[int, bool, float]  # statistic, at most (else above), value


@dataclass(frozen=True)
class RuleModel:
    """Score = logistic(intercept + weights of the rules that hold)."""

    intercept: float
    rules: tuple[tuple[tuple[Condition, ...], float], ...]

    def score(self, stats: Column) -> Column:
        """The model as one column expression over an array of statistics."""
        total = F.lit(self.intercept)
        for conditions, weight in self.rules:
            holds = F.lit(True)
            for i, below, value in conditions:
                x = F.get(stats, F.lit(i))
                holds &= (x <= value) if below else (x > value)
            total = total + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def _grow(x: np.ndarray, g: np.ndarray, h: np.ndarray, rows: np.ndarray, depth: int, path: tuple[Condition, ...], cuts: list[np.ndarray], out: list, value: np.ndarray) -> None:
    """A regression tree on gradients: every node's path goes to `out`, every leaf's step to `value`."""
    if path:
        out.append(path)
    best = (1e-6, None, None)
    total_g, total_h = g[rows].sum(), h[rows].sum()
    if depth:
        for i, cut in enumerate(cuts):
            if not len(cut):
                continue
            slot = np.searchsorted(cut, x[rows, i], side="left")
            left_g = np.bincount(slot, g[rows], len(cut) + 1).cumsum()[:-1]
            left_h = np.bincount(slot, h[rows], len(cut) + 1).cumsum()[:-1]
            gain = left_g**2 / (left_h + 1) + (total_g - left_g) ** 2 / (total_h - left_h + 1) - total_g**2 / (total_h + 1)
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (gain[k], i, float(cut[k]))
    _, i, cut = best
    if i is None:
        value[rows] = total_g / (total_h + 1)
        return
    below = x[rows, i] <= cut
    if below.all() or not below.any():
        value[rows] = total_g / (total_h + 1)
        return
    _grow(x, g, h, rows[below], depth - 1, (*path, (i, True, cut)), cuts, out, value)
    _grow(x, g, h, rows[~below], depth - 1, (*path, (i, False, cut)), cuts, out, value)


def tree_paths(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, seed: int = 5) -> list[tuple[Condition, ...]]:
    """Conjunctions along the paths of boosted trees, each grown on half of the rows."""
    random = np.random.default_rng(seed)
    cuts = []
    for i in range(x.shape[1]):
        edges = np.unique(np.quantile(x[:, i], np.linspace(0.01, 0.99, 49)))
        cuts.append(edges)
    margin = np.full(len(y), np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    paths: list[tuple[Condition, ...]] = []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        rows = np.flatnonzero(random.random(len(y)) < 0.5)
        value = np.zeros(len(y))
        found: list[tuple[Condition, ...]] = []
        if len(rows) < 4:
            continue
        _grow(x, y - p, p * (1 - p) + 1e-6, rows, depth, (), cuts, found, value)
        paths += found
        margin += 0.3 * np.clip(value, -4, 4)
    return list(dict.fromkeys(paths))


def _holds(x: np.ndarray, path: tuple[Condition, ...]) -> np.ndarray:
    out = np.ones(len(x), bool)
    for i, below, value in path:
        out &= (x[:, i] <= value) if below else (x[:, i] > value)
    return out


def lasso_logistic(a: np.ndarray, y: np.ndarray, penalty: float = 2e-3, steps: int = 400) -> tuple[float, np.ndarray]:
    """Intercept and L1-penalized weights by accelerated proximal gradient steps."""
    n = len(y)
    step = 4 / (np.linalg.norm(a, 2) ** 2 / n + 1)
    w = last = np.zeros(a.shape[1])
    b = last_b = 0.0
    for k in range(steps):
        ahead, ahead_b = w + (k / (k + 3)) * (w - last), b + (k / (k + 3)) * (b - last_b)
        r = 1 / (1 + np.exp(-np.clip(a @ ahead + ahead_b, -30, 30))) - y
        last, last_b = w, b
        moved = ahead - step * (a.T @ r) / n
        w = np.sign(moved) * np.maximum(np.abs(moved) - step * penalty, 0)
        b = ahead_b - step * r.mean()
    return float(b), w


def fit_rules(x: np.ndarray, y: np.ndarray, threshold: float = THRESHOLD) -> RuleModel:
    """Rules from trees, weights by lasso, intercept moved so that `threshold` separates the classes best.

    With no rows, or rows of one class only, the score is that class's share of them (one half for none).
    """
    if not len(y) or y.min() == y.max():
        share = float(np.clip(y.mean(), 0.001, 0.999)) if len(y) else 0.5
        return RuleModel(float(np.log(share / (1 - share))), ())
    paths = tree_paths(x, y)
    held = np.array([_holds(x, p) for p in paths], np.float64).T.reshape(len(y), len(paths))
    scale = held.std(axis=0) + 0.05
    intercept, weights = lasso_logistic(held / scale, y)
    weights = weights / scale
    margin = held @ weights + intercept
    order = np.argsort(margin)
    good, bad = y[order].sum(), len(y) - y[order].sum()
    # Balance of the classes if all up to each row, in order of the margin, were turned down.
    balance = np.concatenate([[0.0], np.cumsum(1 - y[order]) / bad - np.cumsum(y[order]) / good])
    sorted_margin = np.concatenate([[margin.min() - 1], margin[order], [margin.max() + 1]])
    k = int(balance.argmax())
    middle = (sorted_margin[k] + sorted_margin[k + 1]) / 2
    shift = np.log(threshold / (1 - threshold)) - middle
    kept = tuple((p, float(w)) for p, w in zip(paths, weights) if abs(w) > 1e-6)
    return RuleModel(float(intercept + shift), kept)


def learn(docs: DataFrame, labels: DataFrame, learnable: Column, label: str = "quality", doc_id: str = "doc_id", text: str = "text", rows: int = LEARN_ROWS) -> RuleModel:
    """Model from at most `rows` labelled documents, chosen by a hash of their id.

    `learnable` says, on `labels`, which may be used. Null ids and labels are not; of repeated labels the largest counts.
    """
    prepare_text(docs.sparkSession)
    once = labels.filter(learnable & F.col(doc_id).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(doc_id).alias("_id")).agg(F.max(label).cast("double").alias("_label"))
    chosen = once.orderBy(F.xxhash64("_id"), "_id").limit(rows)
    # At most `rows` ids: safe to broadcast.
    joined = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(chosen), "_id")
    # Ids may repeat in the documents: the bound is put on the rows as well.
    got = with_statistics(joined, "_text", "_stats", ["_id", "_label"]).orderBy(F.xxhash64("_id"), "_id", "_stats").limit(rows).collect()
    x = np.array([r["_stats"] for r in got], np.float64).reshape(len(got), len(STATISTICS))
    return fit_rules(x, np.array([r["_label"] for r in got], np.float64))


def score_quality(docs: DataFrame, model: RuleModel, score: str = "score", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """`docs` with the score of every whole text in [0, 1]; null and empty texts have the score of zero statistics.

    Repeated rows are scored each for itself, very long texts as a whole; an empty table gives an empty result.
    """
    (stats,) = fresh(docs, "_stats")
    scored = with_statistics(docs, text, stats, keep)
    kept = [c for c in scored.columns if c not in (stats, score)]
    return scored.select(*kept, model.score(F.col(stats)).alias(score))


def drop_poor(docs: DataFrame, model: RuleModel, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """`docs` whose score reaches the threshold; all columns kept, nothing shuffled."""
    (score,) = fresh(docs, "_score")
    return score_quality(docs, model, score, text).filter(F.col(score) >= threshold).select(*docs.columns)
