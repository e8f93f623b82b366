"""Approximate nearest neighbours by cross-polytope hashing.

Largest inner product becomes nearest direction band by band: vectors whose
norms agree within a factor of BAND are scaled by the largest norm among them
and get one more component that makes them unit vectors. A table turns them by
three rounds of random signs and a fast Hadamard transform; a point lies in the
bucket of its nearest signed axis. A query probes, in every table, all axes on
which its own coordinate reaches PROBE_AT standard deviations. Points met in at
least VOTES tables are candidates, and are ranked by their exact inner products.
A long vector ranks high at a wide angle too: where a band's vectors would reach
the best scores at cosines that so many votes do not find, fewer are asked for.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellscope.llm.common import written
from cellscope.llm.grid import Grid, best, finite_vectors, matrix, top

#: Tables, probing threshold, tables that must agree: recall over 0.9 of the 20 nearest for random directions.
TABLES, PROBE_AT, VOTES = 24, 1.4, 3
#: Factor between the norms of a band at most; share of a band's points that its votes find, at the least cosine that counts.
BAND, FOUND = 1.1, 0.95


def _small_hadamard(d: int) -> np.ndarray:
    h = np.ones((1, 1))
    while len(h) < d:
        h = np.block([[h, h], [h, -h]])
    return h


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row (a power of two long), scaled to keep norms.

    Two steps of a radix about the root of the width, each a product with a
    small matrix, some rows at a time so that they stay in the cache.
    """
    n, d = x.shape
    b = 1 << d.bit_length() // 2
    a = d // b
    inner, outer = _small_hadamard(b), _small_hadamard(a) / np.sqrt(d)
    out = np.empty((n, d))
    for lo in range(0, n, 1024):
        y = (x[lo:lo + 1024].reshape(-1, b) @ inner).reshape(-1, a, b)
        y = (y.transpose(0, 2, 1).reshape(-1, a) @ outer).reshape(-1, b, a)
        out[lo:lo + 1024] = y.transpose(0, 2, 1).reshape(-1, d)
    return out


def rotations(x: np.ndarray, tables: int, seed: int) -> Iterator[np.ndarray]:
    """Each table's pseudo-rotation of the rows: three rounds of signs and transform."""
    rng = np.random.default_rng(seed)
    for _ in range(tables):
        y = x
        for signs in rng.integers(0, 2, (3, x.shape[1])) * 2.0 - 1:
            y = hadamard(y * signs)
        yield y


def axis_of(y: np.ndarray) -> np.ndarray:
    """Nearest signed axis: i for +i, i + d for -i."""
    i = np.abs(y).argmax(1)
    return i + y.shape[1] * (y[np.arange(len(y)), i] < 0)


def inverted(buckets: list[np.ndarray], axes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All tables' lists of points one after the other, by table and bucket; each list's place and size."""
    n = len(buckets[0])
    lists = np.concatenate([np.argsort(b, kind="stable") for b in buckets]).astype(np.int32)
    size_of = np.concatenate([np.bincount(b, minlength=axes) for b in buckets])
    table = np.repeat(np.arange(len(buckets)) * n, axes)
    inside = np.concatenate([np.cumsum(s) - s for s in size_of.reshape(len(buckets), axes)])
    return lists, table + inside, size_of


def met(lists: np.ndarray, first_of: np.ndarray, size_of: np.ndarray, probes: np.ndarray) -> np.ndarray:
    """The points in the probed lists, each as often as it is met; no other list is read."""
    size = size_of[probes]
    ends = np.cumsum(size)
    return lists[np.repeat(first_of[probes] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]


def norms(x: np.ndarray) -> np.ndarray:
    """Length of each row, without overflow of the squares; no row is zero."""
    most = np.abs(x).max(1, keepdims=True)
    return most[:, 0] * np.linalg.norm(x / most, axis=1)


def padded_width(width: int) -> int:
    return 1 << int(width).bit_length()  # over the dimension: one more component at least


def least_cosines(width: int, tables: int, probe_at: float, votes: int, seed: int) -> np.ndarray:
    """Entry v - 1: the least cosine to a query at which FOUND of the points get v votes (2: none does).

    A turned point's largest coordinate is that of ``width`` normal ones; the
    query's coordinate there is normal about cosine times it.
    """
    largest = np.abs(np.random.default_rng(seed).normal(size=(1000, width))).max(1)
    out = np.full(votes, 2.0)
    for c in np.arange(0.99, -0.005, -0.01):
        p = np.mean([0.5 * math.erfc((probe_at - c * m) / math.sqrt(2 * (1 - c * c))) for m in largest])
        missed = np.cumsum([math.comb(tables, j) * p ** j * (1 - p) ** (tables - j) for j in range(votes)])
        out[1 - missed >= FOUND] = c
    return out


def _search(points: np.ndarray, ids: np.ndarray, queries: np.ndarray, own: np.ndarray, k: int, enough: int, least: np.ndarray,
            tables: int, probe_at: float, votes: int, seed: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query's place, ids, scores) of the block's best. A point below the block's ``enough``-th best score counts for nothing."""
    width = padded_width(points.shape[1])
    def padded(x: np.ndarray, last: np.ndarray) -> np.ndarray:
        return np.concatenate([x, np.maximum(0, last)[:, None], np.zeros((len(x), width - x.shape[1] - 1))], axis=1)
    norm, length = norms(points), norms(queries)
    _, band = np.unique(np.floor(np.log(norm) / np.log(BAND)), return_inverse=True)
    longest = np.zeros(band.max() + 1)
    np.maximum.at(longest, band, norm)
    unit = points / longest[band][:, None]
    x = padded(unit, np.sqrt(np.maximum(0, 1 - (unit * unit).sum(1))))
    q = padded(queries / length[:, None], np.zeros(len(queries)))
    lists, first_of, size_of = inverted([axis_of(y) for y in rotations(x, tables, seed)], 2 * width)
    for lo in range(0, len(q), 256):
        probed = np.stack([np.concatenate([y, -y], axis=1) for y in rotations(q[lo:lo + 256], tables, seed)], axis=1) >= probe_at / np.sqrt(width)
        for i, axes in enumerate(probed.reshape(len(probed), -1), lo):
            row = np.bincount(met(lists, first_of, size_of, np.nonzero(axes)[0]), minlength=len(x))
            others = ids != own[i]
            at = np.nonzero((row >= votes) & others)[0]
            score = points[at] @ queries[i]
            reach = np.partition(score, len(score) - enough)[len(score) - enough] if len(score) >= enough else -np.inf
            # Votes that find the band's points at the cosine from which they reach that score; none: all are candidates.
            need = np.searchsorted(least, reach / length[i] / longest, side="right")
            if need.min() < votes:
                at = np.nonzero((row >= need[band]) & others)[0]
            if len(at) < k:  # too few for a full list: all rows of the block are candidates
                at = np.nonzero(others)[0]
            score = points[at] @ queries[i]
            first = best(score, ids[at], k)
            yield i, ids[at[first]], score[first]


def nearest(vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
            tables: int = TABLES, probe_at: float = PROBE_AT, votes: int = VOTES, seed: int = 7) -> DataFrame:
    """(query_id, rank, vec_id, score): up to ``k`` nearest found of each query, nearest first.

    Queries: rows for which ``is_query`` (a function of the id column) holds;
    candidates: every other id. score: inner product in double precision.
    Ties go to the smaller id. Vectors that are null, zero or hold null or
    non-finite components, and rows without an id, take no part. Rows that
    repeat an id count as one (see ``finite_vectors``); vectors of different
    lengths are compared with zeros after the shorter one's end. Other columns
    are ignored. An empty table gives no rows.

    Every row is hashed, in every table. A block builds the tables of its
    points; no list of candidates leaves it, only its k best for each query.
    Norms may differ: see the module. A block is a random share of the points,
    so it has few of a query's k best; the score of about that many of its own
    tells at which cosines a band's points still count.
    """
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    points = written(finite_vectors(vectors, id_col, vector_col).withColumn("norm", norm).where("norm > 0"), "ann-points")
    n, width, n_queries = points.agg(F.count(F.lit(1)), F.max(F.size("v")), F.count(F.when(is_query(F.col("vec_id")), 1))).first()
    grid = Grid(n, n_queries)
    share = k / grid.shards
    enough = min(k, math.ceil(share + 3 * math.sqrt(share) + 3))  # more of the k best are in one block about once in 10^4 blocks
    least = least_cosines(padded_width(width or 0), tables, probe_at, votes, seed)
    queries = points.where(is_query(F.col("vec_id"))).select(F.col("vec_id").alias("query_id"), "v")

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        rows = [] if left.empty or right.empty else [
            (right["query_id"].iat[i], vec, s) for i, vecs, scores in _search(
                matrix(left["v"], width), left["vec_id"].to_numpy(), matrix(right["v"], width), right["query_id"].to_numpy(),
                k, enough, least, tables, probe_at, votes, seed) for vec, s in zip(vecs, scores)]
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"])

    found = grid.points(points.select("vec_id", "v")).groupBy("cell").cogroup(grid.queries(queries).groupBy("cell")).applyInPandas(
        run, "query_id long, vec_id long, score double")
    return top(found, k)
