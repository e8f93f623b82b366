"""Scalar functions (D5-D9): all built-in expressions, no Python per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cellscope import constants as K
from cellscope.functions._util import as_col


def log1p(c: str | Column) -> Column:
    """log(1 + x)."""
    return F.log1p(as_col(c))


def round4(c: str | Column) -> Column:
    """Display rounding to 4 decimals."""
    return F.round(as_col(c), 4)


def fmt2(c: str | Column) -> Column:
    """``%.2f`` text (Java formatter, half-up on the decimal form)."""
    return F.format_string("%.2f", as_col(c))


def fmt0(c: str | Column) -> Column:
    """``%.0f`` text."""
    return F.format_string("%.0f", as_col(c))


def significant(c: Column, digits: int) -> Column:
    """``c`` rounded to ``digits`` significant decimal digits; zero, null and non-finite values stay."""
    return F.format_string(f"%.{digits - 1}e", c).try_cast("double") if digits else c


def area_hour_key(area: str | Column, hour_hh: str | Column) -> Column:
    """The ``<area>_<HH>`` key of the batch output."""
    return F.concat(as_col(area), F.lit("_"), as_col(hour_hh))


def route_label(id_col: str | Column) -> Column:
    """``Route <id>`` label of the top-k report."""
    return F.concat(F.lit("Route "), as_col(id_col).cast("string"))


def color_band(value: str | Column, lo: Column, hi: Column, epsilon: float = K.COLOR_EPSILON) -> Column:
    """Three-band colour of ``log1p(value)`` normalised by ``lo``/``hi``.

    ``lo``/``hi`` are the min and max of ``log1p`` over the point set (fitted
    literals). Missing value gives gray. With ``epsilon=0`` and all
    values equal the normalised value is NaN and the rule falls through to
    green, as the epsilon-free variant does.
    """
    v = as_col(value)
    norm = F.try_divide(F.log1p(v) - lo, hi - lo + F.lit(epsilon))
    norm = F.coalesce(norm, F.lit(float("nan")))
    return (F.when(v.isNull(), K.COLOR_MISSING)
            .when(norm < K.COLOR_LOW_CUT, K.COLOR_LOW)
            .when(norm < K.COLOR_MID_CUT, K.COLOR_MID)
            .otherwise(K.COLOR_HIGH))


def guarded(expr: Column, *inputs: str | Column, default: float = 0.0) -> Column:
    """``expr`` when every input is present, else ``default``."""
    cond = F.lit(True)
    for c in inputs:
        cond = cond & as_col(c).isNotNull()
    return F.when(cond, expr).otherwise(F.lit(default))


def nan_to_null(c: str | Column) -> Column:
    """NaN becomes null, so that one null model holds after ingest."""
    col = as_col(c)
    return F.when(F.isnan(col), F.lit(None)).otherwise(col)
