"""Whitened components against a dense eigendecomposition."""

from __future__ import annotations

import math

import numpy as np
import pytest

from clicktrail.llm import whitening


def plain(rows):
    """vec_id -> (deviation, whitened), n, explained; by numpy over the whole table."""
    good = [(i, v) for i, v, _ in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(256 * float(np.float32(c))) for c in v] for _, v in good]
    fit = [list(t) for t in {tuple(v) for v in x}]
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    z = np.array(fit, float) - np.array(sums) / n
    values, axes = np.linalg.eigh(z.T @ z / n)
    values, axes = values[::-1][:4], axes[:, ::-1][:, :4]
    white = (np.array(x, float) - np.array(sums) / n) @ (axes / np.sqrt(values))
    deviation = [sum((n * c - s) ** 2 for c, s in zip(v, sums, strict=True)) for v in x]
    return good, n, deviation, white, values / (z * z).sum() * n


def check(got, rows, tolerance=1e-9):
    good, n, deviation, white, explained = plain(rows)
    by = {}
    for r in got:
        by.setdefault((r.vec_id, r.component), []).append(r)
    k = white.shape[1]
    assert len(got) == k * len(good)
    for c in range(k):
        ours = np.array([by[i, c + 1][0].whitened for i, _ in good])
        sign = np.sign(ours @ white[:, c])
        assert np.abs(sign * ours - white[:, c]).max() < tolerance * max(1, np.abs(white).max())
        assert all(r.explained == pytest.approx(explained[c], rel=1e-9) for r in got if r.component == c + 1)
    assert {(r.vec_id, r.deviation) for r in got} == {(i, d) for (i, _), d in zip(good, deviation, strict=True)}
    assert {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-8


def random_rows(n, width, spread, seed=1):
    random = np.random.default_rng(seed)
    return [(i, [float(c) for c in random.standard_normal(width) * spread], 0) for i in range(n)]


@pytest.mark.parametrize("width", [1, 3, 12, 40])
def test_equals_a_dense_eigendecomposition(vectors_table, width):
    rows = random_rows(300, width, np.linspace(3, 0.3, width))
    check(whitening.whiten(vectors_table(rows).repartition(7)).collect(), rows)


def test_flat_spectrum_grows_the_block(vectors_table):
    rows = random_rows(4000, 30, np.ones(30))
    check(whitening.whiten(vectors_table(rows)).collect(), rows, 1e-7)


def test_copies_weigh_nothing_and_odd_rows_are_dropped(vectors_table):
    rows = random_rows(60, 5, np.arange(5, 0, -1.0))
    odd = [(100, None, 0), (101, [1.0, None, 2.0, 3.0, 4.0], 0), (102, [math.nan] * 5, 0), (103, [math.inf, 0.0, 0.0, 0.0, 0.0], 1)]
    copies = [(200 + i, rows[0][1], i) for i in range(500)]
    check(whitening.whiten(vectors_table(rows + odd + copies)).collect(), rows + odd + copies)
    short = [(300, [1.0, 2.0], 0), (301, [], 0), (None, rows[1][1], None)]
    got = whitening.whiten(vectors_table(rows + short)).collect()
    assert {r.vec_id for r in got} == {i for i, _, _ in rows} | {None} and len(got) == 61 * 4


def test_low_rank_and_degenerate_tables(vectors_table):
    line = [(i, [float(i), 2.0 * i, -float(i), 0.5 * i, 1.0, 1.0], 0) for i in range(40)]
    got = whitening.whiten(vectors_table(line)).collect()
    assert {r.component for r in got} == {1} and got[0].explained == pytest.approx(1)
    for rows in ([], [(1, [1.0, 2.0], 0)], [(1, [1.0, 2.0], 0)] * 5, [(1, [], 0)], [(1, None, 0)]):
        out = whitening.whiten(vectors_table(rows))
        assert out.count() == 0 and out.columns == "vec_id component n deviation whitened explained identity_error".split()


def test_deviation_is_exact_or_null(vectors_table):
    rows = [(i, [float(2**17 * i), float(3 * i)], 0) for i in range(10)] + [(50, [3e38, 1.0], 0)]
    got = {r.vec_id: r.deviation for r in whitening.whiten(vectors_table(rows)).collect()}
    assert got[50] is None
    rows = rows[:10]
    good, _, deviation, _, _ = plain(rows)
    assert {r.vec_id: r.deviation for r in whitening.whiten(vectors_table(rows)).collect()} == {i: d for (i, _), d in zip(good, deviation, strict=True)}


def test_subspace_iteration_on_close_eigenvalues():
    random = np.random.default_rng(3)
    turn = np.linalg.qr(random.standard_normal((50, 50)))[0]
    for values in (np.r_[[10, 9.999, 5, 4.99], np.linspace(4.9, 0, 46)], np.r_[np.full(8, 2.0), np.full(42, 1.0)], 10.0 ** -np.arange(50)):
        matrix = turn * values @ turn.T
        got, axes = whitening.principal(lambda b, m=matrix: m @ b, 50, 4)
        assert np.allclose(got, values[:4], rtol=1e-10)
        assert np.abs(matrix @ axes - axes * got).max() < 1e-12 * values[0]
