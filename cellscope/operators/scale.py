"""Min-max scaling (H1), component scores (H3), weighted score (H4), weight
normalisation (H5).

The scaler fits all columns with one aggregation (the min and max of every
column) instead of one job per column; the fitted values enter the row
expressions as literals, so the arithmetic stays in the scan's generated code.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellscope import constants as K
from cellscope.functions._util import fit
from cellscope.functions.scalar import guarded


def scaled_name(column: str, suffix: str = "_norm") -> str:
    return f"{column}{suffix}"


def range_aggregates(columns: Sequence[str]) -> list[Column]:
    """``lo<i>`` and ``hi<i>`` of each column."""
    return [f(F.col(f"`{c}`").cast("double")).alias(f"{name}{i}")
            for name, f in (("lo", F.min), ("hi", F.max)) for i, c in enumerate(columns)]


#: H3 as weights of the scaled inputs: a score is a constant plus these.
COMPONENT_WEIGHTS = {
    "SignalScore": {"PCell_RSRP_max": K.SIGNAL_RSRP_COEF, "PCell_SNR_max": K.SIGNAL_SNR_COEF},
    "MobilityScore": {"speed_kmh": -1.0},
    "EnvScore": {"temperature": K.ENV_TEMPERATURE_COEF, "pressure": K.ENV_PRESSURE_COEF},
    "CongestionPenalty": {"Traffic Jam Factor": 1.0},
}


def min_max_scale(df: DataFrame, columns: Sequence[str] = tuple(K.SCORE_INPUT_COLUMNS),
                  suffix: str = "_norm", ranges: Mapping[str, tuple[float | None, float | None]] | None = None) -> DataFrame:
    """H1: add ``<c>_norm = (c - min) / (max - min)`` for each column.

    A constant column scales to 0.5 (as Spark ML's ``MinMaxScaler`` does);
    null stays null. Min and max skip nulls; ``ranges`` gives them where they
    are known, and saves the pass that finds them.
    """
    cols = [c for c in columns if c in df.columns]
    if not cols:
        return df
    if ranges is None:
        stats = fit(df, *range_aggregates(cols))
        ranges = {c: (stats[f"lo{i}"], stats[f"hi{i}"]) for i, c in enumerate(cols)}
    out = {}
    for c in cols:
        lo, hi = ranges[c]
        x = F.col(f"`{c}`").cast("double")
        if lo is None:  # no value at all
            out[scaled_name(c, suffix)] = F.lit(None).cast("double")
        elif hi == lo:
            out[scaled_name(c, suffix)] = F.when(x.isNotNull(), F.lit(0.5))
        else:
            out[scaled_name(c, suffix)] = (x - F.lit(lo)) / F.lit(hi - lo)
    return df.withColumns(out)


def component_scores(df: DataFrame, rsrp: str = "PCell_RSRP_max_norm", snr: str = "PCell_SNR_max_norm",
                     speed: str = "speed_kmh_norm", temperature: str = "temperature_norm",
                     pressure: str = "pressure_norm", jam: str = "Traffic Jam Factor_norm") -> DataFrame:
    """H3: Signal, Mobility, Env scores and the Congestion penalty from scaled
    columns; a missing input gives 0.0 (guarded form)."""
    c = {k: F.col(f"`{v}`") for k, v in dict(rsrp=rsrp, snr=snr, speed=speed, temperature=temperature,
                                              pressure=pressure, jam=jam).items()}
    return df.withColumns({
        "SignalScore": guarded(F.lit(K.SIGNAL_RSRP_COEF) * c["rsrp"] + F.lit(K.SIGNAL_SNR_COEF) * c["snr"],
                               c["rsrp"], c["snr"]),
        "MobilityScore": guarded(F.lit(1.0) - c["speed"], c["speed"]),
        "EnvScore": guarded(F.lit(K.ENV_TEMPERATURE_COEF) * c["temperature"]
                            + F.lit(K.ENV_PRESSURE_COEF) * c["pressure"], c["temperature"], c["pressure"]),
        "CongestionPenalty": guarded(c["jam"], c["jam"]),
    })


def _w(v: float | Column) -> Column:
    return v if isinstance(v, Column) else F.lit(float(v))


def score_expr(weights: Mapping[str, float | Column]) -> Column:
    """H4: ``w1 Signal + w2 Mobility + w3 Env - w4 Congestion``."""
    return (_w(weights["w_signal"]) * F.col("SignalScore") + _w(weights["w_mobility"]) * F.col("MobilityScore")
            + _w(weights["w_env"]) * F.col("EnvScore") - _w(weights["w_congestion"]) * F.col("CongestionPenalty"))


def weighted_score(df: DataFrame, weights: Mapping[str, float | Column] | None = None,
                   name: str = K.SCORE_COLUMN) -> DataFrame:
    """H4: add the weighted score column (default weights 0.4/0.2/0.1/0.3)."""
    return df.withColumn(name, score_expr(weights or K.DEFAULT_WEIGHTS))


def normalise_weights(df: DataFrame, names: Sequence[str] = tuple(K.WEIGHT_NAMES)) -> DataFrame:
    """H5: scale the weight columns to sum 1; a sum below 1e-6 gives 0.25 each."""
    total = sum((F.col(c) for c in names[1:]), F.col(names[0]))
    small = total < F.lit(K.WEIGHT_SUM_EPSILON)
    equal = 1.0 / len(names)
    return df.withColumns({c: F.when(small, F.lit(equal)).otherwise(F.col(c) / total) for c in names})


def normalise_weight_map(weights: Mapping[str, float]) -> dict[str, float]:
    """H5 on a plain mapping (user-entered weights)."""
    total = sum(float(weights[c]) for c in K.WEIGHT_NAMES)
    if total < K.WEIGHT_SUM_EPSILON:
        return {c: 1.0 / len(K.WEIGHT_NAMES) for c in K.WEIGHT_NAMES}
    return {c: float(weights[c]) / total for c in K.WEIGHT_NAMES}
