"""Map and scatter datasets (I1-I4): chart data, no drawing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellscope import constants as K
from cellscope.functions._util import fit
from cellscope.functions.scalar import color_band


def map_points(df: DataFrame, lat: str = "Latitude", lon: str = "Longitude", target: str = "target",
               operator: str = "operator", epsilon: float = K.COLOR_EPSILON) -> DataFrame:
    """``(lat, lon, target, color, popup)`` for each point of ``df``.

    Pass a sample (G1/G2) to bound the point count. The colour bands use the
    min and max of ``log1p(target)`` over the same points (fitted first).
    """
    st = fit(df, F.min(F.log1p(F.col(target))).alias("lo"), F.max(F.log1p(F.col(target))).alias("hi"))
    lo, hi = F.lit(st["lo"]).cast("double"), F.lit(st["hi"]).cast("double")
    popup = F.format_string("Target: %.0f<br>Operator: %s", F.col(target), F.col(operator).cast("string"))
    return df.select(F.col(lat).alias("lat"), F.col(lon).alias("lon"), F.col(target).alias("target"),
                     color_band(F.col(target), lo, hi, epsilon).alias("color"), popup.alias("popup"))


def map_centre(df: DataFrame, lat: str = "Latitude", lon: str = "Longitude") -> DataFrame:
    """One row, mean latitude and longitude (of a sample or of all rows)."""
    return df.agg(F.avg(lat).alias("centre_lat"), F.avg(lon).alias("centre_lon"))


def scatter_points(df: DataFrame, predictors: Sequence[str] = tuple(K.SCATTER_PREDICTORS), target: str = "target",
                   operator: str = "operator") -> DataFrame:
    """``(predictor, value, target, operator, log_scale_ok)``: one row per
    point and predictor; ``log_scale_ok`` marks targets a log axis can show."""
    cols = [p for p in predictors if p in df.columns]
    wide = df.select(F.col(target).cast("double").alias("target"), F.col(operator).cast("string").alias("operator"),
                     *[F.col(f"`{p}`").cast("double").alias(p) for p in cols])
    return (wide.unpivot(["target", "operator"], cols, "predictor", "value")
            .select("predictor", "value", "target", "operator", (F.col("target") > 0).alias("log_scale_ok")))


def route_profile(best: DataFrame, components: Sequence[str] = tuple(K.COMPONENT_COLUMNS),
                  id_col: str = "id") -> DataFrame:
    """I4: ``(id, component, value)`` for the chosen row(s)."""
    return best.select(id_col, *components).unpivot([id_col], list(components), "component", "value")
