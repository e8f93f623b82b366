"""The exploratory analysis session as result frames, keyed by name.

load -> null profile -> clean (B9) -> time features (D11) -> shape, counts,
distributions, correlations, box statistics, hourly means, map points.
Every entry is a DataFrame over all rows (the point sets are hash samples,
bounded by their size). Building the report runs jobs: modes, ranges, moments
and quantiles are fitted first, and only such one-row or one-row-a-group
results reach the driver. A caller may persist the input first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from cellscope import constants as K
from cellscope.functions.time import engineer_time_features
from cellscope.operators import aggregate, clean, correlation, distribution, geo, profile, sample


def prepare(df: DataFrame, long_weekday: bool = False) -> DataFrame:
    """Clean (presence flag, zero-fill, mode imputation), operator as text, time features."""
    return engineer_time_features(clean.operator_to_string(clean.clean(df)), long_weekday=long_weekday)


def eda_report(df: DataFrame, deletion: str = "listwise", map_points: int = 2000,
               seed: int = K.SAMPLE_SEED) -> dict[str, DataFrame]:
    """All results of the session, keyed by name (see the module docstring)."""
    prepared = prepare(df)
    matrix = correlation.corr_matrix(prepared, deletion=deletion)
    points = sample.fixed_size_sample(prepared, map_points, seed)
    return {
        "prepared": prepared,
        "shape": profile.shape(df),
        "schema": profile.schema_report(df),
        "head": profile.head(prepared),
        "nulls_before": profile.null_profile(df),
        "nulls_after": profile.null_profile(prepared),
        "describe": profile.describe(df),
        "target_histogram": distribution.histogram(prepared, "target", K.TARGET_BINS),
        "log_target_histogram": distribution.histogram(prepared, "target", K.TARGET_BINS, transform="log1p"),
        "log_target_density": distribution.kde(prepared, "target", transform="log1p"),
        "signal_histograms": distribution.histograms(prepared, K.SIGNAL_HIST_COLUMNS, K.SIGNAL_BINS),
        "category_counts": aggregate.category_counts(prepared),
        "correlation_matrix": matrix,
        "target_correlations": correlation.target_ranking(matrix, k=15),
        "box_by_category": distribution.box_stats(prepared, "target", K.BOX_GROUP_COLUMNS),
        "scatter": geo.scatter_points(points),
        "map_points": geo.map_points(points),
        "map_centre": geo.map_centre(points),
        "hourly_target": aggregate.mean_by(prepared),
    }
