"""Aggregations E1-E5 and E13.

All are hash aggregations with partial (map-side) aggregation, so a hot
group key costs one buffer row per task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellscope import constants as K
from cellscope.functions._util import literal_rows
from cellscope.operators.clean import complete_cases
from cellscope.functions.time import epoch_to_timestamp, hour_of_day

# Output names of the six area-hour means, in metric order.
AREA_HOUR_OUTPUT = ["avg_rsrp", "avg_snr", "avg_speed", "avg_jam", "avg_humidity", "avg_precip"]


def area_hour_averages(df: DataFrame, area: str = "area", epoch_col: str = "timestamp",
                       metrics: Sequence[str] = tuple(K.AREA_HOUR_METRICS),
                       names: Sequence[str] = tuple(AREA_HOUR_OUTPUT), order: bool = True) -> DataFrame:
    """Mean of six metrics per (area, UTC hour) over complete rows.

    A row counts only if its timestamp and all six metrics are present
    (whole-row rejection); a group without such a row does not appear.
    Result: ``area, hour, avg_*..., n``.
    """
    complete = complete_cases(df, [epoch_col, *metrics])
    out = (complete
           .groupBy(F.col(area).alias("area"), hour_of_day(epoch_to_timestamp(epoch_col)).alias("hour"))
           .agg(*[F.avg(F.col(m)).alias(n) for m, n in zip(metrics, names)], F.count(F.lit(1)).alias("n")))
    return out.orderBy("area", "hour") if order else out


def category_counts(df: DataFrame, columns: Sequence[str] = tuple(K.CATEGORY_COLUMNS)) -> DataFrame:
    """Value counts of several category columns in one pass.

    The columns are unpivoted to ``(column, value)`` text pairs and counted
    with a single grouping; result ``column, value, count`` largest first.
    """
    present = [c for c in columns if c in df.columns]
    long = df.select(*[F.col(c).cast("string").alias(c) for c in present]).unpivot(
        [], present, "column", "value")
    return (long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
            .orderBy("column", F.desc("count"), F.asc_nulls_last("value")))


def mean_by(df: DataFrame, by: Sequence[str] = ("hour_of_day", "operator"), value: str = "target",
            name: str = "avg_target") -> DataFrame:
    """Mean of ``value`` by the given keys, ordered by the keys."""
    return df.groupBy(*by).agg(F.avg(value).alias(name)).orderBy(*by)


def global_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with mean, min and max of each column (``<c>_mean`` ...)."""
    aggs = []
    for c in columns:
        aggs += [F.avg(c).alias(f"{c}_mean"), F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
    return df.agg(*aggs)


def variation_flags(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """E5: one row; ``<c>_varies`` is true when ``c`` has two or more distinct values.

    ``min < max`` over the non-null values, in the same pass as other
    statistics (cheaper than a distinct count).
    """
    return df.agg(*[F.coalesce(F.min(c) < F.max(c), F.lit(False)).alias(f"{c}_varies") for c in columns])


def weight_shares(weights: DataFrame | Mapping[str, float], columns: Sequence[str] = tuple(K.WEIGHT_NAMES),
                  spark=None) -> DataFrame:
    """Each weight as a percentage of their sum (pie data).

    ``weights`` is a frame with the weight columns (one row per weight set,
    as the search produces) or a mapping. Result: ``weight, share_pct``.
    """
    if isinstance(weights, Mapping):
        if spark is None:
            raise ValueError("spark is required when weights is a mapping")
        weights = literal_rows(spark, [[float(weights[c]) for c in columns]], ", ".join(f"`{c}` double" for c in columns))
    total = sum((F.col(c) for c in columns[1:]), F.col(columns[0]))
    shares = weights.select(*[F.try_divide(F.col(c) * 100.0, total).alias(c) for c in columns])
    return shares.unpivot([], list(columns), "weight", "share_pct")
