import math
from fractions import Fraction

import numpy as np
import pytest

from shelfwise.llm import whitening as op
from shelfwise.llm.common import prepare_text

SCHEMA = "vec_id long, embedding array<double>"


def test_agrees_with_plain_arithmetic(spark):
    prepare_text(spark)
    random = np.random.default_rng(1)
    mix = random.normal(size=(7, 7))
    rows = [(i, [float(c) for c in mix @ random.normal(size=7) + 5]) for i in range(400)] + [(3, [1.0] * 7)] * 5
    bad = [(900, None), (901, [1.0] * 6), (902, [1.0] * 6 + [None]), (903, [1.0] * 6 + [math.nan]), (904, [math.inf] * 7), (905, [])]
    df = spark.createDataFrame(rows + bad + [(None, [0.25] * 7)], SCHEMA).repartition(4).selectExpr("*", "1 as n", "2 as x")
    got = op.whiten(df, components=4).collect()
    rows = rows + [(None, [0.25] * 7)]
    x = [[math.floor(1024 * c) + 100_000 for c in v] for _, v in rows]
    n, sums = len(x), [sum(col) for col in zip(*x)]
    want = sorted(str((i, n, sum((n * a - s) ** 2 for a, s in zip(v, sums)))) for (i, _), v in zip(rows, x))
    assert sorted(str((r.vec_id, r.n, int(r.deviation))) for r in got) == want

    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(v, sums)] for v in x])
    cov = centred.T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    plain = {}
    for (i, _), z in zip(rows, (centred @ vectors[:, ::-1][:, :4]) / np.sqrt(values[::-1][:4])):
        plain.setdefault(i, []).append(np.abs(z))
    for r in got:
        assert min(np.max(np.abs(np.abs(r.whitened) - z)) for z in plain[r.vec_id]) < 1e-9
        assert np.allclose(r.explained, values[::-1][:4] / np.trace(cov), rtol=1e-12)
        assert r.identity_error < 1e-9
    signs = {r.vec_id: np.array(r.whitened) for r in got if r.vec_id is not None}
    z = np.array([signs[i] for i, _ in rows[:400]])
    assert np.allclose(np.abs(z.T @ (centred[:400] @ vectors[:, ::-1][:, :4])).argmax(axis=1), range(4))


def test_degenerate_tables(spark):
    prepare_text(spark)
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], SCHEMA)
    assert [(r.n, int(r.deviation), r.whitened, r.identity_error) for r in op.whiten(same).collect()] == [(5, 0, [], 0.0)] * 5
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 7.0]) for i in range(5)], SCHEMA)
    assert all(len(r.whitened) == 1 and abs(r.explained[0] - 1) < 1e-12 for r in op.whiten(line).collect())
    assert op.whiten(same.filter("false")).count() == 0
    assert op.whiten(same, dims=3).count() == 0
    one = op.whiten(same.limit(1)).collect()
    assert len(one) == 1 and one[0].whitened == []


def matrices():
    random = np.random.default_rng(3)
    a = random.normal(size=(40, 20))
    q, _ = np.linalg.qr(random.normal(size=(12, 12)))
    yield a.T @ a
    yield np.diag([5.0, 5.0, 5.0, 2.0, 2.0, 1.0])
    yield q @ np.diag([9, 9, 9, 9 - 1e-9, 4, 4, 3, 2, 1, 1e-8, 0, 0]) @ q.T
    yield np.eye(9) * 3
    yield np.zeros((4, 4))
    yield np.array([[2.0]])
    yield np.ones((6, 6))
    yield 1e12 * (a.T @ a) + 1e3 * np.eye(20)
    wilkinson = np.diag(np.abs(np.arange(-10, 11.0))) + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1)
    yield wilkinson


@pytest.mark.parametrize("a", list(matrices()))
def test_eigenpairs(a):
    k = min(8, len(a))
    values, vectors = op.leading_eigenpairs(a, k)
    want = np.linalg.eigvalsh(a)[::-1][:k]
    norm = max(np.abs(want).max(), 1e-300)
    assert np.max(np.abs(values - want)) <= 1e-13 * norm * len(a)
    assert np.max(np.abs(vectors.T @ vectors - np.eye(k))) < 1e-12
    assert np.max(np.abs(a @ vectors - vectors * values)) <= 1e-13 * norm * len(a)


def test_sturm_counts_are_numbers_of_smaller_eigenvalues():
    random = np.random.default_rng(8)
    diag, off = random.normal(size=9), random.normal(size=8)
    values = np.linalg.eigvalsh(np.diag(diag) + np.diag(off, 1) + np.diag(off, -1))
    at = np.concatenate([values - 1e-9, values + 1e-9, [-100, 100]])
    assert list(op.sturm_counts(diag, off, at)) == [int((values < x).sum()) for x in at]
