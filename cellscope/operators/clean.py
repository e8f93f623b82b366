"""Projection and cleaning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellscope import constants as K
from cellscope.functions._util import NUMERIC_TYPES


def select_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """B1: project the listed columns that exist, in list order."""
    return df.select(*[F.col(f"`{c}`") for c in columns if c in df.columns])


def default_missing(df: DataFrame, columns: Sequence[str], target: str = "target",
                    number_default: float = K.MISSING_NUMBER_DEFAULT,
                    target_default: float = K.MISSING_TARGET_DEFAULT) -> DataFrame:
    """B2: add absent columns as constants: numbers 0.0, the target 1.

    Unlike the analysed program, the defaults stay in the projection (its
    defaults were dropped again by a projection on the old column list).
    """
    missing = [c for c in columns if c not in df.columns]
    if not missing:
        return df
    return df.withColumns({c: F.lit(target_default if c == target else number_default) for c in missing})


def complete_cases(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Keep rows where every listed column (default: all) is present.

    NaN in a floating column is absent as well. One condition tests each
    column once; columns that come unchanged from a scan have an ``isnotnull``
    filter more, which reaches a Parquet scan as a pushed filter.
    """
    names = list(columns) if columns is not None else df.columns
    stored = _stored_columns(df)
    out = df
    for c in names:
        if c in stored:
            out = out.where(F.col(f"`{c}`").isNotNull())
    return out.dropna(subset=[f"`{c}`" for c in names]) if names else out


def _stored_columns(df: DataFrame) -> set[str]:
    """Names of the columns that a leaf of the plan gives as they are."""
    plan = df._jdf.queryExecution().analyzed()

    def listed(seq):
        return [seq.apply(i) for i in range(seq.size())]
    ids = {a.exprId().id() for leaf in listed(plan.collectLeaves()) for a in listed(leaf.output())}
    return {a.name() for a in listed(plan.output()) if a.exprId().id() in ids}


def add_presence_flag(df: DataFrame, source: str = K.SCELL_PRESENCE_COLUMN, name: str = "has_scell") -> DataFrame:
    """Boolean flag ``source is not null``; run it before zero-filling."""
    return df.withColumn(name, F.col(f"`{source}`").isNotNull())


def zero_fill_prefix(df: DataFrame, prefix: str = K.SCELL_PREFIX, value: float = 0) -> DataFrame:
    """Fill nulls with 0 in the numeric columns whose name has ``prefix``."""
    cols = [f.name for f in df.schema.fields
            if f.name.startswith(prefix) and isinstance(f.dataType, NUMERIC_TYPES)]
    return df.na.fill(value, subset=cols) if cols else df


def mode_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Most frequent non-null value of each column, one row, column names kept.

    Ties go to the smallest value. Two grouped aggregations, both with
    map-side partial aggregation: (column, value) counts, then per column
    the value with the largest count. Nothing grows in one task except the
    per-task hash map of distinct values, which spills.
    """
    cols = list(columns)
    long = (df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in cols])
            .unpivot([], cols, "column", "value")
            .where(F.col("value").isNotNull()))
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("cnt"))
    rank_key = F.struct((-F.col("cnt")).alias("neg"), F.col("value").alias("v"))
    return counts.agg(*[
        F.min_by(F.col("value"), F.when(F.col("column") == c, rank_key)).alias(c) for c in cols])


def impute_mode(df: DataFrame, columns: Sequence[str] = tuple(K.PCELL_MODE_COLUMNS)) -> DataFrame:
    """Fill nulls of each column with its mode (nulls ignored, smallest on ties).

    The modes are fitted first (one row, as an ML imputer does) and then
    filled in as literals, inside the scan's code-generated stage.
    """
    cols = [c for c in columns if c in df.columns]
    if not cols:
        return df
    modes = mode_values(df, cols).first()
    return df.withColumns({
        c: F.coalesce(F.col(f"`{c}`"), F.lit(modes[c]).cast(df.schema[c].dataType))
        for c in cols if modes[c] is not None})


def operator_to_string(df: DataFrame, column: str = "operator") -> DataFrame:
    """Recast the operator code to text (category)."""
    return df.withColumn(column, F.col(column).cast("string")) if column in df.columns else df


def parse_numbers(df: DataFrame, columns: Sequence[str], to: T.DataType = T.DoubleType()) -> DataFrame:
    """Cast text columns to numbers; malformed values become null.

    ``try_cast`` never raises under ANSI mode; follow with ``complete_cases``
    to reject the whole row.
    """
    return df.withColumns({c: F.col(f"`{c}`").try_cast(to) for c in columns})


def clean(df: DataFrame, presence_source: str = K.SCELL_PRESENCE_COLUMN, prefix: str = K.SCELL_PREFIX,
          mode_columns: Sequence[str] = tuple(K.PCELL_MODE_COLUMNS)) -> DataFrame:
    """Presence flag, zero-fill of the prefixed columns, mode imputation."""
    out = df
    if presence_source in df.columns:
        out = add_presence_flag(out, presence_source)
    return impute_mode(zero_fill_prefix(out, prefix), mode_columns)
