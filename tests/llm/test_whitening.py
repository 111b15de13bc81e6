import math
import random

import numpy as np
import pytest

from tablewright.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, n long, component int, piece string"


def frame(spark, vectors, parts=3):
    return spark.createDataFrame([(i, v, 0, 1, 2, "x") for i, v in vectors], SCHEMA).repartition(parts)


def brute(vectors, most=8):
    """By vec_id (of sound vectors): deviation and whitened values, signs as numpy has them."""
    kept = [(i, v) for i, v in vectors if v and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(float(np.float32(c)) * 1024) + 100_000 for c in v] for _, v in kept]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x]
    centred = np.array([[(n * a - s) / n for a, s in zip(row, sums)] for row in x])
    values, vectors_ = np.linalg.eigh(centred.T @ centred / n)
    values, vectors_ = values[::-1][:most], vectors_[:, ::-1][:, :most]
    return [i for i, _ in kept], deviation, centred @ vectors_ / np.sqrt(values), values / (centred**2).sum() * n


def holds(spark, vectors, parts=3):
    ids, deviation, white, explained = brute(vectors)
    got = whitening.whiten(frame(spark, vectors, parts)).collect()
    k = len(explained)
    assert sorted((r.vec_id, r.component, r.n) for r in got if r.vec_id is not None) == sorted((i, c + 1, len(ids)) for i in ids for c in range(k) if i is not None)
    assert len(got) == k * len(ids)
    by = {(r.vec_id, r.component): r for r in got}
    where = {i: j for j, i in enumerate(ids)}
    for c in range(1, k + 1):
        ours = np.array([by[i, c].whitened for i in ids if i is not None])
        theirs = white[[where[i] for i in ids if i is not None], c - 1]
        assert np.allclose(ours, theirs, atol=1e-8) or np.allclose(ours, -theirs, atol=1e-8)
        assert [*{by[i, c].explained for i in ids}] == pytest.approx([explained[c - 1]], rel=1e-9)
    assert all(by[i, 1].deviation == deviation[where[i]] for i in ids if i is not None)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9


def some(n, d, seed, spread=None):
    r = random.Random(seed)
    return [(i, [r.gauss(0.3, (spread or [0.2] * d)[k] * (1 + k / d)) for k in range(d)]) for i in range(n)]


def test_against_numpy(spark):
    bad = [(1000, None), (1001, []), (1002, [1.0] * 11 + [None]), (1003, [float("nan")] + [0.0] * 11), (1004, [float("inf")] + [0.0] * 11)]
    vectors = some(400, 12, 1) + bad
    holds(spark, vectors)
    holds(spark, vectors + [vectors[0], (None, vectors[1][1])], 1)  # repeated rows count again
    holds(spark, [*vectors, (77777, [900.5] * 12)], 5)


def test_few_dimensions_and_no_variance(spark):
    holds(spark, some(50, 3, 2))
    flat = [(i, [1.0, 2.0, 3.0]) for i in range(5)]
    assert whitening.whiten(frame(spark, flat)).count() == 0
    assert whitening.whiten(frame(spark, [(1, None)])).count() == whitening.whiten(frame(spark, [])).count() == 0
    line = [(i, [i / 8, 0.5, -i / 8]) for i in range(40)]  # one direction only
    got = whitening.whiten(frame(spark, line)).collect()
    assert {r.component for r in got} == {1} and got[0].explained == pytest.approx(1)
    mixed = some(40, 4, 3) + [(100 + i, [1.0] * 5) for i in range(7)]  # lengths of few vectors are left out
    assert {r.vec_id for r in whitening.whiten(frame(spark, mixed)).collect()} == set(range(40))


def test_large_entries(spark):
    huge = [(i, [v * 1e7 for v in vec]) for i, vec in some(30, 4, 4)]
    got = whitening.whiten(frame(spark, huge)).collect()
    ids, deviation, _, _ = brute(huge)
    want = {i: d if d < 1 << 63 else None for i, d in zip(ids, deviation)}
    assert None in want.values() and {r.vec_id: r.deviation for r in got} == want
    with pytest.raises(Exception, match="too large"):
        whitening.whiten(frame(spark, [(1, [1e30]), (2, [1.0])]))


@pytest.mark.parametrize("values", [[9, 9, 9, 4, 4, 1], [1] * 6, [1e6, 1, 1e-3], [5, 5 - 1e-9, 5 - 2e-9, 1], [7]])
def test_eigenvectors_of_clusters(values):
    random_ = np.random.default_rng(len(values))
    q = np.linalg.qr(random_.normal(size=(20, 20)))[0]
    spectrum = np.array([*values, *[0.0] * (20 - len(values))])
    v = (q * spectrum) @ q.T
    found, vectors = whitening.components((v + v.T) / 2, 8)
    k = min(8, len(values))
    assert np.allclose(found[:k], sorted(values, reverse=True)[:k], rtol=1e-9)
    assert np.abs(vectors.T @ vectors - np.eye(len(found))).max() < 1e-12
    assert np.abs(v @ vectors - vectors * found).max() < 1e-12 * max(values)


def test_sturm_counts():
    d, e = np.array([2.0, -1.0, 3.0, 0.5]), np.array([1.0, 0.0, 2.0])
    want = np.linalg.eigvalsh(np.diag(d) + np.diag(e, 1) + np.diag(e, -1))
    points = np.linspace(-4, 6, 41) + 1e-3
    assert list(whitening.below(d, e, points, 1e-300)) == [int((want < p).sum()) for p in points]


def test_merging_in_levels(spark):
    partials = spark.createDataFrame([(i % 3, t, np.array([t, i]).tobytes()) for i in range(3) for t in range(50)], whitening.PARTIAL).repartition(50)
    out = whitening.merged(partials, np.int64, fan_in=4)
    assert {p: list(v) for p, v in out.items()} == {p: [sum(range(50)), 50 * p] for p in range(3)}
