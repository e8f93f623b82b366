"""Tables of the cross-polytope search: the transform, the lists, the votes."""

from __future__ import annotations

import numpy as np
import pytest

from cellscope.llm import cross_polytope as cp


@pytest.mark.parametrize("width", [1, 2, 4, 8, 128, 512])
def test_transform(width):
    rows = np.random.default_rng(width).normal(size=(1030, width))
    want = np.array([[(-1.0) ** (i & j).bit_count() for j in range(width)] for i in range(width)]) / np.sqrt(width)
    assert np.allclose(cp.hadamard(rows), rows @ want) and cp.hadamard(rows[:0]).shape == (0, width)


def test_lists_give_the_votes_of_a_test_of_every_pair():
    rng = np.random.default_rng(3)
    axes, buckets = 16, [rng.integers(0, 16, 500) for _ in range(5)]
    buckets[2][:] = 7  # a table with one bucket
    lists, first_of, size_of = cp.inverted(buckets, axes)
    for share in (0.0, 0.1, 1.0):
        probed = rng.random((5, axes)) < share
        read = cp.met(lists, first_of, size_of, np.nonzero(probed.reshape(-1))[0])
        want = sum(p[b].astype(int) for p, b in zip(probed, buckets))
        assert (np.bincount(read, minlength=500) == want).all() and len(read) == want.sum()  # nothing else is read


def test_near_rows_in_clusters_are_found():
    """Rows about many centres: nine of ten of the 20 nearest are found."""
    rng = np.random.default_rng(5)
    for n in (2_000, 20_000):
        centres = rng.normal(size=(n // 50, 64))
        x = centres[np.arange(n) % len(centres)] + 0.3 * rng.normal(size=(n, 64))
        ids, q = np.arange(n), np.arange(0, n, n // 40)
        least = cp.least_cosines(128, cp.TABLES, cp.PROBE_AT, cp.VOTES, 7)
        hits = 0
        for i, got, _ in cp._search(x, ids, x[q], q, 20, 20, least, cp.TABLES, cp.PROBE_AT, cp.VOTES, 7):
            score = x @ x[q[i]]
            score[q[i]] = -np.inf
            hits += len(set(got) & set(np.argsort(-score)[:20]))
        assert hits >= 0.9 * 20 * len(q)
