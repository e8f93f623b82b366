"""Text sink of the area-hour job (A4) and its reader (round-trip checks)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellscope.functions.scalar import area_hour_key, fmt2, significant
from cellscope.operators.aggregate import AREA_HOUR_OUTPUT


def area_hour_lines(result: DataFrame, names: Sequence[str] = tuple(AREA_HOUR_OUTPUT)) -> DataFrame:
    """``<area>_<HH>\\t<v1>,...,<v6>`` lines (``%.2f``, half up), ordered by key.

    ``result`` is the output of ``area_hour_averages`` (columns ``area``,
    ``hour`` and the six means).
    """
    key = area_hour_key(F.col("area"), F.lpad(F.col("hour").cast("string"), 2, "0"))
    # Rounded at the noise level of a double only (about 13 significant
    # digits), so that the summation order of partitions or micro-batches does
    # not decide an exact tie, and 0.5349999996 is still below it.
    values = F.concat_ws(",", *[fmt2(significant(F.col(n), 13)) for n in names])
    return result.select(key.alias("key"), values.alias("values")).orderBy("key").select(
        F.concat(F.col("key"), F.lit("\t"), F.col("values")).alias("value"))


def write_area_hour_text(result: DataFrame, path: str) -> None:
    """A4: write the key-ordered text output; the target must not exist.

    The sort is a range-partitioned shuffle, so part files are each sorted
    and follow one another in key order; no single-task sort is forced.
    """
    area_hour_lines(result).write.mode("errorifexists").text(path)


def read_area_hour_text(spark: SparkSession, path: str) -> DataFrame:
    """Parse the text output back into ``(key, area, hour, v1..v6)`` strings."""
    line = F.col("value")
    parts = F.split(line, "\t", 2)
    key, vals = F.get(parts, 0), F.split(F.get(parts, 1), ",", -1)
    area = F.regexp_extract(key, r"^(.*)_([0-9]{2})$", 1)
    hour = F.regexp_extract(key, r"^(.*)_([0-9]{2})$", 2).cast("int")
    return spark.read.text(path).select(
        key.alias("key"), area.alias("area"), hour.alias("hour"),
        *[F.get(vals, i).alias(n) for i, n in enumerate(AREA_HOUR_OUTPUT)])
