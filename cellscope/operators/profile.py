"""Profiling (C1-C7): schema, shape, head, null profile, describe, non-null counts.

Every per-column statistic is one aggregation over all columns (one scan),
then an unpivot of the single result row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellscope import constants as K
from cellscope.functions._util import literal_rows, numeric_columns
from cellscope.operators.quantile import approx_quantiles, exact_quantiles


def _q(c: str):
    return F.col(f"`{c}`")


def schema_report(df: DataFrame) -> DataFrame:
    """``(position, column, type)`` from the schema; no job runs."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return literal_rows(df.sparkSession, rows, "position int, column string, type string")


def shape(df: DataFrame) -> DataFrame:
    """One row ``n_rows, n_cols``."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


def head(df: DataFrame, n: int = K.HEAD_ROWS, order_by: str | None = "id") -> DataFrame:
    """First ``n`` rows; ordered by ``order_by`` so the answer is stable.

    A top-k (``TakeOrderedAndProject``), not a global sort.
    """
    if order_by and order_by in df.columns:
        return df.orderBy(_q(order_by)).limit(n)
    return df.limit(n)


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """C4: one wide row, the null count of each column under its own name."""
    cols = list(columns) if columns is not None else df.columns
    return df.agg(*[F.count_if(_q(c).isNull()).alias(c) for c in cols])


def non_null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column, non_null)`` per column, one scan."""
    cols = list(columns) if columns is not None else df.columns
    wide = df.agg(*[F.count(_q(c)).alias(c) for c in cols])
    return wide.unpivot([], cols, "column", "non_null")


def info(df: DataFrame) -> DataFrame:
    """C1 + C7: ``(position, column, type, non_null)`` as a data-frame summary."""
    return schema_report(df).join(F.broadcast(non_null_counts(df)), "column").orderBy("position")


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column, n_null, pct_null)`` for columns with nulls, worst first."""
    cols = list(columns) if columns is not None else df.columns
    wide = df.agg(F.count(F.lit(1)).alias("__rows"), *[F.count_if(_q(c).isNull()).alias(c) for c in cols])
    long = wide.unpivot(["__rows"], cols, "column", "n_null")
    return (long.where(F.col("n_null") > 0)
            .select("column", "n_null", F.try_divide(F.col("n_null") * 100.0, F.col("__rows")).alias("pct_null"))
            .orderBy(F.desc("pct_null"), "column"))


def null_total(df: DataFrame) -> DataFrame:
    """One row, the number of null cells in the whole table."""
    total = sum((F.count_if(_q(c).isNull()) for c in df.columns[1:]), F.count_if(_q(df.columns[0]).isNull()))
    return df.agg(total.alias("n_null_cells"))


def describe(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True,
             accuracy: int = 10_000) -> DataFrame:
    """Count, mean, sample std, min, 25/50/75 %, max per numeric column.

    The columns are unpivoted to ``(column, value)`` once; quartiles
    interpolate linearly like pandas. ``exact=True`` uses the distributed
    exact selection (``quantile.exact_quantiles``), whose first pass also
    computes the other statistics; ``False`` one ``percentile_approx`` pass.
    """
    cols = list(columns) if columns is not None else numeric_columns(df)
    long = df.select(*[_q(c).cast("double").alias(c) for c in cols]).unpivot([], cols, "column", "value")
    named = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    if exact:
        quant = exact_quantiles(long, "value", [0.25, 0.5, 0.75], by=["column"], group_stats=named)
    else:
        stats = long.groupBy("column").agg(*[f(F.col("value")).alias(k) for k, f in named.items()])
        quant = approx_quantiles(long, "value", [0.25, 0.5, 0.75], by=["column"], accuracy=accuracy).join(
            stats, "column")
    wide = quant.groupBy("column", *named).agg(*[F.max(F.when(F.col("p") == p, F.col("quantile"))).alias(n)
                                                 for p, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))])
    # Columns with no value at all still get a row (count 0, the rest null).
    every = literal_rows(df.sparkSession, [(c, i) for i, c in enumerate(cols)], "column string, position int")
    # wide has one row per column: the bounded side that a left join can build.
    return (every.join(F.broadcast(wide), "column", "left")
            .select("column", F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"),
                    "mean", "std", "min", "q25", "q50", "q75", "max")
            .orderBy(F.array_position(F.array(*[F.lit(c) for c in cols]), F.col("column"))))
