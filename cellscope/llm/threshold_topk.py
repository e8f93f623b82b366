"""Exact top-k search by a three-phase uniform threshold.

An inner product is the sum of the scores that two nodes know, each for its
half of the components.
Phase 1: every node sends its highest scores of each query, k of each block;
the halves missing of up to LISTED of a node's are fetched, and the k-th highest
total is a safe cutoff: the more are looked up, the nearer to the final one.
Phase 2: the cutoff over the number of nodes goes to all nodes, and each sends
all vectors that reach it. A vector that no node sends has a lower total than
the cutoff. Phase 3: what a vector can reach at most is what is known of it
plus less than the node's cutoff for each node that did not send it; vectors
that cannot reach the k-th best known total go, and the scores missing of the
others are fetched from their nodes.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellscope.llm.common import written
from cellscope.llm.grid import Grid, best, finite_vectors, matrix, top, width_of

NODES = 2
#: Entries of a node's list that are looked up for the first cutoff, for each result asked for.
LISTED = 8
#: Queries of a block: a cell's entries of phase 2 are one task's rows at a time.
Q_BLOCK = 8_192
_SCORES = "query_id long, vec_id long, node int, partial long"


def _products(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows, exact."""
    bound = np.abs(queries).max(initial=0) * np.abs(points).max(initial=0) * max(1, points.shape[1])
    if bound < 1 << 53:
        return (queries @ points.T).astype(np.int64)
    return queries.astype(np.int64) @ points.T.astype(np.int64)


def _cells(left: pd.DataFrame, right: pd.DataFrame):
    """Point ids, query rows and their scores, some queries at a time."""
    width = width_of(left["v"], right["v"])
    points, queries = matrix(left["v"], width), matrix(right["v"], width)
    ids, own = left["vec_id"].to_numpy(), right["query_id"].to_numpy()
    for lo in range(0, len(queries), 256):
        for i, scores in enumerate(_products(queries[lo:lo + 256], points), lo):
            yield i, ids, ids != own[i], scores


def _frame(rows: list[tuple]) -> pd.DataFrame:
    q, ids, node, scores = zip(*rows) if rows else ((),) * 4
    sizes = [len(x) for x in ids]
    flat = lambda parts: np.concatenate(parts).astype(np.int64) if parts else np.array([], np.int64)
    return pd.DataFrame({"query_id": np.repeat(np.array(q, np.int64), sizes), "vec_id": flat(ids),
                         "node": np.repeat(np.array(node, np.int32), sizes), "partial": flat(scores)})


def _highest(k: int):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(left) and len(right):
            for i, ids, other, scores in _cells(left, right):
                at = np.nonzero(other)[0]
                first = at[best(scores[at], ids[at], k)]
                rows.append((right["query_id"].iat[i], ids[first], left["node"].iat[0], scores[first]))
        return _frame(rows)
    return run


def _reaching(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    rows = []
    if len(left) and len(right):
        for i, ids, other, scores in _cells(left, right):
            at = np.nonzero(other & (scores >= right["least"].iat[i]))[0]
            rows.append((right["query_id"].iat[i], ids[at], left["node"].iat[0], scores[at]))
    return _frame(rows)


def _fetch(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """Scores of the pairs asked for: rows of ``right`` with a vec_id; the others are the queries."""
    asked, queries = right[right["vec_id"].notna()], right[right["vec_id"].isna()]
    if not len(asked):
        return _frame([])
    width = width_of(left["v"], queries["v"])
    points, q = matrix(left["v"], width), matrix(queries["v"], width)
    at_p = pd.Index(left["vec_id"]).get_indexer(asked["vec_id"].astype(np.int64))
    at_q = pd.Index(queries["query_id"]).get_indexer(asked["query_id"])
    out = []
    for lo in range(0, len(asked), 50_000):
        x, y = points[at_p[lo:lo + 50_000]], q[at_q[lo:lo + 50_000]]
        exact = np.abs(x).max(initial=0) * np.abs(y).max(initial=0) * max(1, width) < 1 << 53
        out.append((x * y).sum(1).astype(np.int64) if exact else (x.astype(np.int64) * y.astype(np.int64)).sum(1))
    return pd.DataFrame({"query_id": asked["query_id"].to_numpy(), "vec_id": asked["vec_id"].astype(np.int64).to_numpy(),
                         "node": np.full(len(asked), left["node"].iat[0], np.int32), "partial": np.concatenate(out)})


def top_k(vectors: DataFrame, is_query, k: int = 20, scale: float = 64.0, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest integer inner products of each query.

    Components become floor(scale * x). Queries: rows for which ``is_query``
    (a function of the id column) holds; candidates: every other id; all, if
    fewer than k. Ties go to the smaller id. Vectors that are null or hold
    null or non-finite components, and rows without an id, take no part (an
    empty or zero vector does, with score 0). Rows that repeat an id count as
    one (see ``finite_vectors``); vectors of different lengths are compared
    with zeros after the shorter one's end. Scores must fit in 64 bits. Other
    columns are ignored. An empty table gives no rows.
    """
    whole = written(finite_vectors(vectors, id_col, vector_col).select(
        "vec_id", F.transform("v", lambda x: F.floor(F.lit(scale) * x).cast("double")).alias("v")), "topk-vectors")
    asking = whole.where(is_query(F.col("vec_id")))
    copy = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    first_copies = whole.withColumn("copy", copy).where(F.col("copy") <= k + 1).select("vec_id", "v")
    points = written(first_copies, "topk-points")
    n, width = points.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    grid, half = Grid(n, asking.count(), Q_BLOCK), max(1, -(-(width or 1) // NODES))

    def sliced(rows: DataFrame) -> DataFrame:
        return rows.withColumn("node", F.explode(F.sequence(F.lit(0), F.lit(NODES - 1)))).withColumn(
            "v", F.slice("v", F.col("node") * half + 1, F.lit(half)))

    queries = sliced(asking).withColumnRenamed("vec_id", "query_id")
    by_node = lambda df: df.withColumn("cell", F.col("cell") * NODES + F.col("node"))
    left = by_node(grid.points(sliced(points)))

    def at_nodes(right: DataFrame, run) -> DataFrame:
        right = right.select(*(F.col(c).alias(c) for c in right.columns))  # columns of its own, not left's
        return left.groupBy("cell").cogroup(right.groupBy("cell")).applyInPandas(run, _SCORES)

    def kth(rows: DataFrame, score: str, name: str) -> DataFrame:
        order = Window.partitionBy("query_id").orderBy(F.desc(score))
        return rows.withColumn("nth", F.row_number().over(order)).where(F.col("nth") == k).select("query_id", F.col(score).alias(name))

    own = by_node(grid.queries(queries))

    def fetched(asked: DataFrame) -> DataFrame:
        """Scores of the pairs (query_id, vec_id, node) at that node."""
        cell = grid.cell(grid.shard(F.col("vec_id")), grid.q_block(F.col("query_id"))) * NODES + F.col("node")
        right = asked.select("query_id", "vec_id", "node", F.lit(None).cast("array<double>").alias("v"), cell.alias("cell")).unionByName(
            own.select("query_id", F.lit(None).cast("long").alias("vec_id"), "node", "v", "cell"))
        return at_nodes(right, _fetch).drop("node")

    # Phase 1
    order = Window.partitionBy("query_id", "node").orderBy(F.desc("partial"), "vec_id")
    lists = at_nodes(own, _highest(k)).withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k * LISTED)
    first = written(lists.groupBy("query_id", "vec_id").agg(F.sum("partial").alias("has"), F.count(F.lit(1)).alias("n"), F.min("node").alias("node")), "topk-lists")
    half_known = first.where(F.col("n") < NODES).select("query_id", "vec_id", (NODES - 1 - F.col("node")).alias("node"), "has")
    known = first.where(F.col("n") == NODES).select("query_id", F.col("has").alias("total")).unionByName(
        half_known.join(fetched(half_known), ["query_id", "vec_id"]).select("query_id", (F.col("has") + F.col("partial")).alias("total")))
    cutoff = written(kth(known, "total", "cutoff"), "topk-cutoff")
    # Phase 2: a score reaches cutoff / NODES exactly if it reaches that number rounded up. Fewer than k vectors: all do.
    least = F.ceil(F.col("cutoff") / F.lit(NODES).cast("decimal(20,0)")).cast("long")
    told = queries.join(cutoff.select("query_id", least.alias("least")), "query_id", "left").withColumn(
        "least", F.coalesce("least", F.lit(-(1 << 63)).cast("long")))
    entries = written(at_nodes(by_node(grid.queries(told)), _reaching), "topk-entries")
    # Phase 3
    seen = entries.groupBy("query_id", "vec_id").agg(F.sum("partial").alias("score"), F.count(F.lit(1)).alias("n"), F.min("node").alias("node"))
    seen = written(seen, "topk-seen")
    done = seen.where(F.col("n") == NODES)
    bar = written(cutoff.join(kth(done, "score", "known"), "query_id", "left").select(
        "query_id", F.greatest("cutoff", "known").alias("bar"), least.alias("least")), "topk-bar")
    most = F.col("score") + (F.col("least") - 1)  # of a vector that one of the two nodes has not sent
    open_ = seen.where(F.col("n") < NODES).join(bar, "query_id").where(most >= F.col("bar"))
    asked = open_.select("query_id", "vec_id", (NODES - 1 - F.col("node")).alias("node"), F.col("score").alias("has"))
    asked = written(asked, "topk-asked")
    resolved = asked.join(fetched(asked), ["query_id", "vec_id"]).select("query_id", "vec_id", (F.col("has") + F.col("partial")).alias("score"))
    return top(done.select("query_id", "vec_id", "score").unionByName(resolved), k)
