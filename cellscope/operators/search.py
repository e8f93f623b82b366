"""Weight search (H6 grid, H7 random, H8 history) by moments.

The objective of a candidate ``w`` is the Pearson correlation of the score
``a . X`` with the target, where ``X = (Signal, Mobility, Env, Congestion)``
and ``a = (w1, w2, w3, -w4)``. With ``S = cov(X)``, ``b = cov(X, target)``
and ``v = var(target)``::

    corr(w) = a . b / sqrt(a' S a * v)

so one aggregation over the data (15 sample moments) serves every
candidate: O(rows) + O(candidates) instead of O(rows x candidates). The
candidate table is ``spark.range`` (at most 10,000 rows by the parameter
limits); the 15 fitted moments enter it as literals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellscope import constants as K
from cellscope.functions._util import literal_rows
from cellscope.operators.clean import complete_cases
from cellscope.operators.sample import hash52
from cellscope.operators.scale import COMPONENT_WEIGHTS, normalise_weights, range_aggregates

FEATURES = tuple(K.COMPONENT_COLUMNS)
SIGNS = (1.0, 1.0, 1.0, -1.0)


def grid_candidates(spark: SparkSession, n_points: int = K.GRID_POINTS_DEFAULT) -> DataFrame:
    """H6: all 4-tuples of ``n_points`` values evenly spaced from 0.1 to 0.9,
    in product order (the last weight varies fastest), normalised (H5).

    Result ``(candidate_id, w_signal, w_mobility, w_env, w_congestion)``.
    """
    if not K.GRID_POINTS_MIN <= n_points <= K.GRID_POINTS_MAX:
        raise ValueError(f"n_points must be in {K.GRID_POINTS_MIN}..{K.GRID_POINTS_MAX}")
    step = (K.GRID_HIGH - K.GRID_LOW) / (n_points - 1)
    ids = spark.range(n_points ** 4).withColumnRenamed("id", "candidate_id")
    cols = {}
    for pos, name in enumerate(K.WEIGHT_NAMES):
        digit = (F.col("candidate_id") / F.lit(n_points ** (3 - pos))).cast("bigint") % n_points
        # As numpy's linspace: i * step + start, the last point exactly the end.
        cols[name] = F.when(digit == n_points - 1, F.lit(K.GRID_HIGH)).otherwise(
            digit.cast("double") * F.lit(step) + F.lit(K.GRID_LOW))
    return normalise_weights(ids.withColumns(cols))


def uniform(seed: int, *parts: Column) -> Column:
    """Deterministic uniform [0, 1) value from a hash of the seed and parts."""
    return hash52(seed, *parts).cast("double") / F.lit(float(1 << 52))


def random_candidates(spark: SparkSession, n_iterations: int = K.RANDOM_ITER_DEFAULT,
                      seed: int = K.SAMPLE_SEED) -> DataFrame:
    """H7: ``n_iterations`` uniform 4-vectors, normalised (H5); seeded."""
    if not K.RANDOM_ITER_MIN <= n_iterations <= K.RANDOM_ITER_MAX:
        raise ValueError(f"n_iterations must be in {K.RANDOM_ITER_MIN}..{K.RANDOM_ITER_MAX}")
    ids = spark.range(n_iterations).withColumnRenamed("id", "candidate_id")
    return normalise_weights(ids.withColumns({
        name: uniform(seed, F.col("candidate_id"), F.lit(k)) for k, name in enumerate(K.WEIGHT_NAMES)}))


def score_moments(df: DataFrame, features: Sequence[str] = FEATURES, target: str = "target") -> DataFrame:
    """The 15 sample moments of (features, target) in one aggregation.

    Columns ``c{i}{j}`` (i <= j < 4) = cov(X_i, X_j), ``t{i}`` = cov(X_i, target),
    ``vt`` = var(target). Rows with a null in any of them are ignored.
    """
    data = df.select(*[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)],
                     F.col(target).cast("double").alias("y"))
    data = complete_cases(data)
    n = len(features)
    aggs = [F.covar_samp(f"x{i}", f"x{j}").alias(f"c{i}{j}") for i in range(n) for j in range(n) if i <= j]
    aggs += [F.covar_samp(f"x{i}", "y").alias(f"t{i}") for i in range(n)]
    aggs.append(F.var_samp("y").alias("vt"))
    return data.agg(*aggs)


def fit_inputs(df: DataFrame, columns: Sequence[str] = tuple(K.SCORE_INPUT_COLUMNS),
               target: str = "target") -> tuple[dict[str, tuple[float | None, float | None]], DataFrame]:
    """Ranges of the raw inputs and the moments of ``score_moments``, in one aggregate.

    For rows without nulls. The component scores are linear in the scaled
    inputs and these in the raw ones, so their covariances follow from the
    raw covariances.
    """
    cols = list(columns)
    raw = [F.col(f"`{c}`").cast("double") for c in [*cols, target]]
    pairs = [(i, j) for i in range(len(raw)) for j in range(i, len(raw))]
    row = df.agg(*range_aggregates(cols), *[F.covar_samp(raw[i], raw[j]).alias(f"v{i}_{j}") for i, j in pairs]).first()
    ranges = {c: (row[f"lo{i}"], row[f"hi{i}"]) for i, c in enumerate(cols)}
    weight = {f: {cols.index(c): w / (ranges[c][1] - ranges[c][0]) for c, w in COMPONENT_WEIGHTS[f].items()
                  if ranges[c][0] is not None and ranges[c][1] > ranges[c][0]} for f in FEATURES}
    weight["target"] = {len(cols): 1.0}

    def cov(a: str, b: str) -> float | None:
        terms = [u * v * row[f"v{min(i, j)}_{max(i, j)}"] for i, u in weight[a].items() for j, v in weight[b].items()
                 if row[f"v{min(i, j)}_{max(i, j)}"] is not None]
        return float(sum(terms)) if row["v0_0"] is not None else None
    names = [*FEATURES]
    out = {f"c{i}{j}": cov(names[i], names[j]) for i in range(4) for j in range(i, 4)}
    out |= {f"t{i}": cov(names[i], "target") for i in range(4)} | {"vt": cov("target", "target")}
    return ranges, literal_rows(df.sparkSession, [tuple(out.values())], ", ".join(f"{c} double" for c in out))


def evaluate_candidates(candidates: DataFrame, moments: DataFrame) -> DataFrame:
    """Correlation of each candidate's score with the target (0.0 when the
    score or the target has no variance, as the analysed program does)."""
    a = [F.col(w) * F.lit(s) for w, s in zip(K.WEIGHT_NAMES, SIGNS)]
    row = moments.first()
    m = {c: F.lit(row[c]).cast("double") for c in moments.columns}
    cov = F.lit(0.0)
    var = F.lit(0.0)
    for i in range(4):
        cov = cov + a[i] * m[f"t{i}"]
        for j in range(4):
            c = m[f"c{min(i, j)}{max(i, j)}"]
            var = var + a[i] * a[j] * c
    vt = m["vt"]
    valid = (var > 0) & (vt > 0)
    corr = F.when(valid, F.try_divide(cov, F.sqrt(var * vt)))
    return candidates.withColumn("correlation", F.coalesce(corr, F.lit(0.0)))


def search_history(evaluated: DataFrame) -> DataFrame:
    """H8: per trial the correlation and the best so far (trial order).

    The running maximum is a window over the candidate table, which is at
    most 10,000 rows, so its single partition is bounded.
    """
    w = Window.orderBy("candidate_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return evaluated.withColumn("best_so_far", F.max("correlation").over(w)).orderBy("candidate_id")


def best_candidate(evaluated: DataFrame) -> DataFrame:
    """The arg-max trial: highest correlation (rounded to 12 decimals, so
    float noise between equal normalised weights does not decide), then the
    earliest trial, as a strict ``>`` scan keeps the first."""
    return evaluated.orderBy(F.desc(F.round("correlation", 12)), F.asc("candidate_id")).limit(1)
