"""Pearson correlation (E6) and correlation matrices (E7, E8), ranking.

Under ANSI mode ``corr`` raises on a constant column; here the ratio is
``try_divide(covar_samp, stddev_samp * stddev_samp)``, which is null for a
constant column or a single row (pandas gives NaN there).

Matrices have two plans, chosen by width:

* up to ``DIRECT_MAX_COLUMNS`` columns, one lazy aggregation over all column
  pairs (each pair's moments are map-side partial aggregates), exploded into
  ``(col_a, col_b, corr)``;
* wider, the Gram-matrix form: every column is standardised (``z``, 0 when
  null); Spark ML's ``Correlation`` (a ``treeAggregate`` of BLAS outer
  products, O(rows x p^2) in the JVM) gives ``sum z_i z_j``. For pairwise
  deletion, the sums of ``z_i`` and ``z_i^2`` over the rows where ``j`` is
  present, needed only for the columns that have nulls, come from one
  aggregate of plain sums (or, when many columns have nulls, from presence
  flags and squares added to the vector). Each pair's moments over the rows
  where both are present follow. Where they are small differences of large
  sums (an overlap that is narrow next to the whole column), the digits are
  lost, and the pair is computed again as the direct form does it. Only
  matrices of the column count reach the driver, whatever the row count.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellscope import constants as K
from cellscope.functions._util import literal_rows, numeric_columns
from cellscope.operators.clean import complete_cases


def _q(c: str) -> Column:
    return F.col(f"`{c}`").cast("double")


def pearson(a: str | Column, b: str | Column) -> Column:
    """Null-safe Pearson correlation aggregate over rows where both are present."""
    ca = _q(a) if isinstance(a, str) else a
    cb = _q(b) if isinstance(b, str) else b
    both = ca.isNotNull() & cb.isNotNull()
    return F.try_divide(F.covar_samp(ca, cb),
                        F.stddev_samp(F.when(both, ca)) * F.stddev_samp(F.when(both, cb)))


def matrix_columns(df: DataFrame, columns: Sequence[str] | None = None,
                   exclude: Sequence[str] = tuple(K.CORR_EXCLUDE)) -> list[str]:
    """Numeric columns entering a matrix; ``exclude`` ignores absent names."""
    if columns is not None:
        return [c for c in columns if c in df.columns and c not in set(exclude)]
    return numeric_columns(df, exclude)


DIRECT_MAX_COLUMNS = 8
# A column whose standardised sum of squares is below this share of the rows is constant.
ZERO_VARIANCE = 1e-10
# Pairs that lose so many digits in the Gram form are computed again from
# centred moments over their own overlap, so many pairs to an aggregate.
LOST_DIGITS = 1e-4
RECOMPUTE_PAIRS = 60


def corr_matrix(df: DataFrame, columns: Sequence[str] | None = None,
                exclude: Sequence[str] = tuple(K.CORR_EXCLUDE), deletion: str = "pairwise",
                method: str = "auto") -> DataFrame:
    """E7 (``deletion='listwise'``) and E8 (``'pairwise'``) correlation matrix.

    Listwise drops a row when any selected column is null; pairwise uses, for
    each pair, the rows where both are present. Result: every ordered pair,
    diagonal included, as ``(col_a, col_b, corr)``; null where a side has no
    variance. ``method`` is ``direct``, ``gram`` or ``auto`` (by width).
    """
    if deletion not in ("listwise", "pairwise"):
        raise ValueError(f"deletion must be 'listwise' or 'pairwise', not {deletion!r}")
    if method not in ("auto", "direct", "gram"):
        raise ValueError("method must be 'auto', 'direct' or 'gram'")
    cols = matrix_columns(df, columns, exclude)
    data = df.select(*[_q(c).alias(f"c{i}") for i, c in enumerate(cols)])
    if deletion == "listwise":
        data = complete_cases(data)
    if method == "gram" or (method == "auto" and len(cols) > DIRECT_MAX_COLUMNS):
        return _gram_matrix(data, cols, deletion)
    idx = range(len(cols))
    aggs, cells = [], []
    if deletion == "listwise":
        aggs += [F.stddev_samp(f"c{i}").alias(f"s{i}") for i in idx]
        aggs += [F.covar_samp(f"c{i}", f"c{j}").alias(f"v{i}_{j}") for i in idx for j in idx if i < j]
    else:
        for i in idx:
            aggs.append(F.stddev_samp(f"c{i}").alias(f"s{i}_{i}"))
            for j in idx:
                if i < j:
                    a, b = F.col(f"c{i}"), F.col(f"c{j}")
                    both = a.isNotNull() & b.isNotNull()
                    aggs += [F.covar_samp(a, b).alias(f"v{i}_{j}"),
                             F.stddev_samp(F.when(both, a)).alias(f"s{i}_{j}"),
                             F.stddev_samp(F.when(both, b)).alias(f"s{j}_{i}")]
    row = data.agg(*aggs)

    def sd(i: int, j: int) -> Column:
        return F.col(f"s{i}") if deletion == "listwise" else F.col(f"s{i}_{j}")

    for i in idx:
        for j in idx:
            if i == j:
                var = sd(i, i) * sd(i, i)
                corr = F.try_divide(var, var)
            else:
                lo, hi = min(i, j), max(i, j)
                corr = F.try_divide(F.col(f"v{lo}_{hi}"), sd(i, j) * sd(j, i))
            cells.append(F.struct(F.lit(cols[i]).alias("col_a"), F.lit(cols[j]).alias("col_b"),
                                  corr.alias("corr")))
    return row.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def _long(spark, cols: list[str], mat: np.ndarray) -> DataFrame:
    rows = [(a, b, None if not np.isfinite(mat[i, j]) else float(mat[i, j]))
            for i, a in enumerate(cols) for j, b in enumerate(cols)]
    return literal_rows(spark, rows, "col_a string, col_b string, corr double")


# Above this many block sums the pairwise path puts presence flags and
# squares into the Gram vector instead of one aggregate.
MAX_BLOCK_SUMS = 256


def _gram_matrix(data: DataFrame, cols: list[str], deletion: str) -> DataFrame:
    """Correlation matrix from the Gram matrix of standardised columns.

    Scans: one aggregate (count, mean, sd per column); for pairwise deletion
    one aggregate of plain sums (``z^4`` per column, and for the ``m`` columns
    that have nulls the blocks ``sum z_i k_j``, ``sum z_i^2 k_j``,
    ``sum k_i k_j``); then the ``Correlation`` pass over the ``p`` values
    ``z`` (0 where null). With ``z = (x - m) / s`` over the N present values,
    ``sum z = 0`` and ``sum z^2 = N - 1``, which gives the mean and sd of every
    component without another scan. When ``m`` is large the presence flags
    and squares join the vector instead (``3p`` components).
    """
    spark = data.sparkSession
    p = len(cols)
    names = [f"c{i}" for i in range(p)]
    st = data.agg(F.count(F.lit(1)).alias("rows"),
                  *[F.count(c).alias(f"n{i}") for i, c in enumerate(names)],
                  *[F.avg(c).alias(f"m{i}") for i, c in enumerate(names)],
                  *[F.stddev_samp(c).alias(f"s{i}") for i, c in enumerate(names)]).first()
    nan = np.full((p, p), np.nan)
    n = int(st["rows"])
    if n < 2:
        return _long(spark, cols, nan)
    counts = np.array([float(st[f"n{i}"]) for i in range(p)])
    varies = [bool(st[f"s{i}"]) and st[f"s{i}"] > 0 for i in range(p)]
    z = [F.lit(0.0) if st[f"m{i}"] is None else
         F.coalesce((F.col(c) - F.lit(st[f"m{i}"])) / F.lit(st[f"s{i}"] if varies[i] else 1.0), F.lit(0.0))
         for i, c in enumerate(names)]
    sum_z2 = np.array([(counts[i] - 1.0) if varies[i] else 0.0 for i in range(p)])
    sd_z = np.sqrt(sum_z2 / (n - 1.0))
    if deletion == "listwise":
        g = _gram(data.select(*[z[i].alias(f"z{i}") for i in range(p)]), n, np.zeros(p), sd_z)
        sxx = np.diag(g)
        with np.errstate(invalid="ignore", divide="ignore"):
            out = g / np.sqrt(np.outer(sxx, sxx))
        bad = sxx <= ZERO_VARIANCE * n
        out[bad, :] = np.nan
        out[:, bad] = np.nan
        return _long(spark, cols, out)
    has_nulls = [i for i in range(p) if counts[i] < n]
    m = len(has_nulls)
    present = [F.col(c).isNotNull() for c in names]
    small_blocks = 2 * p * m + m * m <= MAX_BLOCK_SUMS
    if small_blocks:
        aggs = [F.count(F.lit(1)).alias("rows")]
        aggs += [F.sum(F.when(present[j], z[i])).alias(f"sz{i}_{j}") for i in range(p) for j in has_nulls]
        aggs += [F.sum(F.when(present[j], z[i] * z[i])).alias(f"sq{i}_{j}") for i in range(p) for j in has_nulls]
        aggs += [F.count_if(present[i] & present[j]).alias(f"nk{i}_{j}") for i in has_nulls for j in has_nulls]
    else:
        aggs = [F.sum(z[i] * z[i] * z[i] * z[i]).alias(f"f{i}") for i in range(p)]
    sums = data.agg(*aggs).first()
    # Defaults for a column j without nulls: k_j = 1 on every row.
    cnt = np.minimum.outer(counts, counts)
    sx = np.zeros((p, p))                      # sum of z_i over rows where j is present
    sxx = np.repeat(sum_z2[:, None], p, axis=1)  # sum of z_i^2 over those rows
    if small_blocks:
        sxy = _gram(data.select(*[z[i].alias(f"z{i}") for i in range(p)]), n, np.zeros(p), sd_z)
        for j in has_nulls:
            for i in range(p):
                sx[i, j] = float(sums[f"sz{i}_{j}"] or 0.0)
                sxx[i, j] = float(sums[f"sq{i}_{j}"] or 0.0)
                cnt[i, j] = cnt[j, i] = counts[j] if i not in has_nulls else float(sums[f"nk{i}_{j}"])
    else:
        sum_z4 = np.array([float(sums[f"f{i}"] or 0.0) if varies[i] else 0.0 for i in range(p)])
        mu_k = counts / n
        sd_k = np.sqrt(np.maximum(counts * (n - counts), 0) / (n * (n - 1.0)))
        mu_q = sum_z2 / n
        sd_q = np.sqrt(np.maximum(sum_z4 - n * mu_q ** 2, 0.0) / (n - 1.0))
        parts = ([F.when(present[i], 1.0).otherwise(0.0).alias(f"k{i}") for i in range(p)]
                 + [z[i].alias(f"z{i}") for i in range(p)] + [(z[i] * z[i]).alias(f"q{i}") for i in range(p)])
        g = _gram(data.select(*parts), n, np.concatenate([mu_k, np.zeros(p), mu_q]),
                  np.concatenate([sd_k, sd_z, sd_q]))
        k, zz, qq = slice(0, p), slice(p, 2 * p), slice(2 * p, 3 * p)
        cnt, sx, sxx, sxy = g[k, k], g[zz, k], g[qq, k], g[zz, zz]
    with np.errstate(invalid="ignore", divide="ignore"):
        num = sxy - sx * sx.T / cnt
        vx = sxx - sx * sx / cnt
        vy = vx.T
        out = num / np.sqrt(vx * vy)
        lost = ((vx <= LOST_DIGITS * np.maximum(sxx, 1)) | (vy <= LOST_DIGITS * np.maximum(sxx.T, 1))
                | (vx * vy <= (LOST_DIGITS * n) ** 2) | ~np.isfinite(out))
    out[cnt < 1.5] = np.nan
    lost &= cnt >= 1.5
    pairs = [(i, j) for i in range(p) for j in range(i, p) if lost[i, j] or lost[j, i]]
    for k in range(0, len(pairs), RECOMPUTE_PAIRS):
        part = pairs[k:k + RECOMPUTE_PAIRS]
        row = data.agg(*[pearson(names[i], names[j]).alias(f"r{i}_{j}") for i, j in part]).first()
        for i, j in part:
            value = row[f"r{i}_{j}"]
            out[i, j] = out[j, i] = np.nan if value is None else (1.0 if i == j else value)
    return _long(spark, cols, out)


def _gram(vectors: DataFrame, n: int, mu: np.ndarray, sd: np.ndarray) -> np.ndarray:
    """``sum v v'`` of the numeric columns of ``vectors`` (known mean and sd),
    from Spark ML's correlation: ``(n - 1) C sd sd' + n mu mu'``."""
    vec = VectorAssembler(inputCols=vectors.columns, outputCol="v").transform(vectors).select("v")
    c = Correlation.corr(vec, "v").first()[0].toArray()
    cov = np.where(np.outer(sd, sd) > 0, np.nan_to_num(c) * np.outer(sd, sd), 0.0)
    return (n - 1) * cov + n * np.outer(mu, mu)


def target_ranking(matrix: DataFrame, target: str = "target", k: int = 15, include_self: bool = True,
                   direction: str = "top") -> DataFrame:
    """The correlations with ``target`` sorted descending (nulls last);
    the first ``k`` (``direction='top'``) or the last ``k`` (``'bottom'``).

    Result ``(column, corr, rank)``; the window covers one row per matrix
    column, so a single partition is bounded by the column count.
    """
    if direction not in ("top", "bottom"):
        raise ValueError("direction must be 'top' or 'bottom'")
    col = matrix.where(F.col("col_b") == target).select(F.col("col_a").alias("column"), "corr")
    if not include_self:
        col = col.where(F.col("column") != target)
    w = Window.orderBy(F.desc_nulls_last("corr"), F.asc("column"))
    ranked = col.withColumn("rank", F.row_number().over(w))
    if direction == "top":
        return ranked.where(F.col("rank") <= k).orderBy("rank")
    total = Window.partitionBy(F.lit(1))
    return (ranked.withColumn("_n", F.count(F.lit(1)).over(total))
            .where(F.col("rank") > F.col("_n") - k).drop("_n").orderBy("rank"))
