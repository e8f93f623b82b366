"""Vectors against a query set, in blocks: a grid of point blocks and query blocks.

Points and queries are dealt over blocks by a hash of their ids, so that no
block depends on how vectors cluster. Each cell of the grid is one task's work
of bounded memory, and hands on a short list for each query, never all pairs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Vectors of a block, and the blocks that points are dealt over at least.
BLOCK, LEAST_BLOCKS = 32_768, 16


def finite_vectors(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v) with v array<double>, for rows with an id and a vector of finite components.

    Rows that repeat an id are one vector: the smallest in array order.
    """
    v = F.col(vector_col).cast("array<double>")
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (table.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & whole)
            .groupBy("vec_id").agg(F.min("v").alias("v")))


class Grid:
    """Block numbers for ``points`` points and ``queries`` queries, at most about ``q_block`` queries a block."""

    def __init__(self, points: int, queries: int, q_block: int = BLOCK) -> None:
        self.shards = max(LEAST_BLOCKS, -(-points // BLOCK))
        self.q_blocks = max(1, -(-queries // q_block))

    def shard(self, vec_id: Column) -> Column:
        return F.pmod(F.xxhash64(vec_id), F.lit(self.shards))

    def q_block(self, query_id: Column) -> Column:
        return F.pmod(F.xxhash64(query_id, F.lit(1)), F.lit(self.q_blocks))

    def cell(self, shard: Column, q_block: Column) -> Column:
        return shard * self.q_blocks + q_block

    def points(self, df: DataFrame) -> DataFrame:
        """Rows of points, one for each cell that needs them."""
        return df.withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(self.q_blocks - 1)))).withColumn(
            "cell", self.cell(self.shard(F.col("vec_id")), F.col("b"))).drop("b")

    def queries(self, df: DataFrame) -> DataFrame:
        return df.withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(self.shards - 1)))).withColumn(
            "cell", self.cell(F.col("b"), self.q_block(F.col("query_id")))).drop("b")


def matrix(vectors: pd.Series, width: int) -> np.ndarray:
    """Rows of doubles, with zeros after a shorter vector's end."""
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def width_of(*vectors: pd.Series) -> int:
    return max((len(v) for s in vectors for v in s), default=0)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if len(scores) > 4 * k:  # all that reach the k-th score, ties included
        places = np.nonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])[0]
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((ids[places], -scores[places]))[:k]]


def top(found: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): k best of each query's rows."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
