"""Distributions: equal-width histogram (E10), Gaussian density (E11), box
statistics by category (E12).

Range statistics are fitted first (one global aggregate, a few numbers);
the per-row work is a code-generated projection followed by a grouped
count with map-side partial aggregation (at most ``bins`` groups).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellscope import constants as K
from cellscope.functions._util import checked_broadcast, fit, literal_rows
from cellscope.session import materialize
from cellscope.operators.quantile import approx_quantiles, exact_quantiles

_TRANSFORMS = {None: lambda c: c, "log1p": F.log1p}


def _value(df: DataFrame, column: str, transform: str | None) -> DataFrame:
    if transform not in _TRANSFORMS:
        raise ValueError(f"unknown transform {transform!r}")
    x = _TRANSFORMS[transform](F.col(f"`{column}`").cast("double"))
    return df.select(x.alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))


def _range(lo: float | None, hi: float | None) -> tuple[Column, Column]:
    """Range ends; a constant column gets [v - 0.5, v + 0.5] as numpy does."""
    if lo is None:
        return F.lit(None).cast("double"), F.lit(None).cast("double")
    if lo == hi:
        return F.lit(lo - 0.5), F.lit(hi + 0.5)
    return F.lit(lo), F.lit(hi)


def bin_index(x: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Equal-width bin of ``x`` in ``[lo, hi]``; the maximum goes to the last bin."""
    return F.least(F.floor((x - lo) * F.lit(bins) / (hi - lo)), F.lit(bins - 1)).cast("int")


def histogram(df: DataFrame, column: str, bins: int = K.TARGET_BINS, transform: str | None = None) -> DataFrame:
    """``(bin, bin_lo, bin_hi, count)`` for ``bins`` equal-width bins, empty ones included.

    ``transform='log1p'`` bins ``log1p(column)``.
    """
    data = _value(df, column, transform)
    stats = fit(data, F.min("x").alias("lo"), F.max("x").alias("hi"))
    lo, hi = _range(stats["lo"], stats["hi"])
    counts = data.groupBy(bin_index(F.col("x"), lo, hi, bins).alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    width = (hi - lo) / F.lit(bins)
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    # counts has at most ``bins`` rows: the bounded side that a left join can build.
    return (every.join(F.broadcast(counts), "bin", "left")
            .select("bin", (lo + F.col("bin") * width).alias("bin_lo"), (lo + (F.col("bin") + 1) * width).alias("bin_hi"),
                    F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"))
            .orderBy("bin"))


def histograms(df: DataFrame, columns: Sequence[str] = tuple(K.SIGNAL_HIST_COLUMNS), bins: int = K.SIGNAL_BINS,
               transform: str | None = None) -> DataFrame:
    """E10 for several columns in one pass: ``(column, bin, bin_lo, bin_hi, count)``.

    One fit of every column's range, then the columns are unpivoted and
    counted with a single grouping on ``(column, bin)``; absent columns are
    skipped. Equal to ``histogram`` column by column.
    """
    if transform not in _TRANSFORMS:
        raise ValueError(f"unknown transform {transform!r}")
    cols = [c for c in columns if c in df.columns]
    vals = df.select(*[_TRANSFORMS[transform](F.col(f"`{c}`").cast("double")).alias(c) for c in cols])
    st = fit(vals, *[F.min(c).alias(f"lo{i}") for i, c in enumerate(cols)],
             *[F.max(c).alias(f"hi{i}") for i, c in enumerate(cols)])
    spark = df.sparkSession
    rows = []
    for i, c in enumerate(cols):
        lo, hi = st[f"lo{i}"], st[f"hi{i}"]
        if lo is not None and lo == hi:
            lo, hi = lo - 0.5, hi + 0.5
        rows.append((c, lo, hi))
    # One row per column: a broadcast bounded by the column count.
    ranges = F.broadcast(literal_rows(spark, rows, "column string, lo double, hi double"))
    long = (vals.unpivot([], cols, "column", "x").where(F.col("x").isNotNull() & ~F.isnan("x"))
            .join(ranges, "column"))
    counts = long.groupBy("column", bin_index(F.col("x"), F.col("lo"), F.col("hi"), bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("count"))
    grid = literal_rows(spark, [(c,) for c in cols], "column string").select("column", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = (F.col("hi") - F.col("lo")) / F.lit(bins)
    # counts has at most columns x bins rows.
    return (grid.join(ranges, "column").join(F.broadcast(counts), ["column", "bin"], "left")
            .select("column", "bin", (F.col("lo") + F.col("bin") * width).alias("bin_lo"),
                    (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_hi"),
                    F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"))
            .orderBy("column", "bin"))


#: Bandwidths beyond which the Gaussian kernel is nothing.
KDE_REACH = 9.0


def kde(df: DataFrame, column: str, grid_points: int = K.KDE_GRID_POINTS, bins_per_bandwidth: int = 256,
        transform: str | None = None, hist_bins: int = K.TARGET_BINS) -> DataFrame:
    """Gaussian kernel density on ``grid_points`` points from min to max.

    Bandwidth ``h`` is Scott's rule, ``sd * n ** (-1/5)`` with the sample sd.
    Rows are first reduced to the occupied bins of width ``h /
    bins_per_bandwidth`` (count, mean, variance), whatever the range and the
    row count; a bin's kernel sum is expanded to second order about its mean,
    which leaves a relative error of the third power of the bin width over h.
    Each bin meets only the grid points within ``KDE_REACH`` bandwidths
    (beyond, the kernel is below 1e-17). Result ``(grid_index, x, density,
    expected_count)``, the last one scaled to the counts of a ``hist_bins``
    histogram; null density without a bandwidth (constant or single value).
    """
    data = _value(df, column, transform)
    st = fit(data, F.count(F.lit(1)).alias("n"), F.stddev_samp("x").alias("sd"),
             F.min("x").alias("lo"), F.max("x").alias("hi"))
    n, lo, hi = st["n"], st["lo"], st["hi"]
    if not n:
        return literal_rows(df.sparkSession, [], "grid_index int, x double, density double, expected_count double")
    h = st["sd"] * n ** -0.2 if st["sd"] else None
    step = (hi - lo) / (grid_points - 1) if grid_points > 1 else 0.0
    grid = df.sparkSession.range(grid_points).select(
        F.col("id").cast("int").alias("grid_index"), (F.lit(lo) + F.col("id") * F.lit(step)).alias("x"))
    if not h or not step:
        return grid.select("grid_index", "x", F.lit(None).cast("double").alias("density"),
                           F.lit(None).cast("double").alias("expected_count")).orderBy("grid_index")
    x = F.col("x")
    bins = (data.groupBy(F.floor((x - F.lit(lo)) * F.lit(bins_per_bandwidth / h)).alias("bin"))
            .agg(F.count(F.lit(1)).cast("double").alias("w"), F.avg("x").alias("mu"), F.var_pop("x").alias("var")))
    near = lambda side: (F.col("mu") - F.lit(lo) + F.lit(side * KDE_REACH * h)) / F.lit(step)
    first = F.greatest(F.ceil(near(-1)), F.lit(0)).cast("int")
    last = F.least(F.floor(near(1)), F.lit(grid_points - 1)).cast("int")
    # A bin between two far grid points reaches none.
    expanded = bins.where(first <= last).select("w", "mu", "var", F.explode(F.sequence(first, last)).alias("grid_index"))
    z = (F.lit(lo) + F.col("grid_index") * F.lit(step) - F.col("mu")) / F.lit(h)
    kernel = F.exp(F.lit(-0.5) * z * z) * (1 + F.lit(0.5) * F.col("var") / F.lit(h * h) * (z * z - 1))
    sums = expanded.groupBy("grid_index").agg(F.sum(F.col("w") * kernel).alias("s"))
    density = F.coalesce("s", F.lit(0.0)) / F.lit(n * h * math.sqrt(2 * math.pi))
    # Both sides have at most grid_points rows.
    return (grid.join(F.broadcast(sums), "grid_index", "left").select("grid_index", "x", density.alias("density"))
            .withColumn("expected_count", F.col("density") * F.lit(n * (hi - lo) / hist_bins))
            .orderBy("grid_index"))


def box_stats(df: DataFrame, value: str = "target", by: str | Sequence[str] = "area",
              whisker: float = K.WHISKER_IQR, exact: bool = True, accuracy: int = 10_000) -> DataFrame:
    """Quartiles, whiskers and outlier count of ``value`` per category.

    ``by`` is one column, or several: then the categories of each are
    unpivoted into ``(grouping, category)`` and all are computed in one pass.
    Whiskers are the furthest values within ``whisker * IQR`` of the box.
    Rows with a null category or value are left out, as the plots do.
    ``exact=False`` takes the quartiles from one ``percentile_approx`` pass.
    """
    multi = not isinstance(by, str)
    if multi:
        groups = [c for c in by if c in df.columns]
        data = (df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in groups],
                          F.col(f"`{value}`").cast("double").alias("x"))
                .unpivot(["x"], groups, "grouping", "category"))
        keys = ["grouping", "category"]
    else:
        data = df.select(F.col(f"`{by}`").alias(by), F.col(f"`{value}`").cast("double").alias("x"))
        keys = [by]
    data = data.where(F.col("x").isNotNull() & ~F.isnan("x"))
    for k in keys:
        data = data.where(F.col(k).isNotNull())
    q = (exact_quantiles(data, "x", [0.25, 0.5, 0.75], by=keys) if exact
         else approx_quantiles(data, "x", [0.25, 0.5, 0.75], by=keys, accuracy=accuracy))
    box = q.groupBy(*keys).agg(*[F.max(F.when(F.col("p") == p, F.col("quantile"))).alias(name)
                                 for p, name in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))])
    iqr = F.col("q3") - F.col("q1")
    fences = box.select(*keys, "q1", "median", "q3", (F.col("q1") - whisker * iqr).alias("lo_fence"),
                        (F.col("q3") + whisker * iqr).alias("hi_fence"))
    x = F.col("x")
    inside = (x >= F.col("lo_fence")) & (x <= F.col("hi_fence"))
    fences = materialize(fences, "box-fences")
    return (data.join(checked_broadcast(fences), keys)
            .groupBy(*keys, "q1", "median", "q3")
            .agg(F.count(F.lit(1)).alias("n"),
                 F.min(F.when(inside, x)).alias("whisker_lo"),
                 F.max(F.when(inside, x)).alias("whisker_hi"),
                 F.count_if(~inside).alias("n_outliers"))
            .select(*keys, "n", "q1", "median", "q3", "whisker_lo", "whisker_hi", "n_outliers")
            .orderBy(*keys))
