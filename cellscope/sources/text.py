"""Tolerant positional text source (A3, J1) for the area-hour job.

Semantics of the line-oriented batch job, in built-in expressions:

* blank lines and lines starting with the header prefix are skipped;
* fields are split on ``,`` (Spark's CSV tokenizer with quoting switched
  off) and, as when trailing empty fields are dropped, a line whose
  ``area`` and ``target`` are both empty is too short and rejected, while
  an empty ``area`` followed by a target is the legal area ``""``;
* no quoting is honoured;
* the timestamp must be an integer; the six metrics must parse as numbers
  and be non-blank, otherwise the whole row is rejected (atomic, where the
  original kept partial sums of a half-parsed record).

The parse is a projection in the scan stage: no shuffle, no Python.
Files are split by the CSV reader itself; a frame of lines (a stream, say)
goes through ``from_csv`` with the same options.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellscope import constants as K


N_FIELDS = len(K.MEASUREMENT_COLUMNS)
FIELD_SCHEMA = T.StructType([T.StructField(f"f{i}", T.StringType(), True) for i in range(N_FIELDS)])
# Plain comma splitting: no quoting, no escapes, no trimming; an empty field
# stays "" (only a missing field is null), blank lines are skipped.
SPLIT_OPTIONS = {"sep": ",", "quote": "", "escape": "\u0000", "nullValue": "\u0000",
                 "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
                 "mode": "PERMISSIVE", "header": "false"}


def read_fields(spark: SparkSession, path: str) -> DataFrame:
    """Text lines of ``path`` split on commas into ``f0..f40`` (strings)."""
    return spark.read.schema(FIELD_SCHEMA).options(**SPLIT_OPTIONS).csv(path)


def split_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """The same split for a frame of text lines (e.g. a text stream)."""
    kept = lines.where(F.trim(F.col(value)) != "")
    return kept.select(F.from_csv(F.col(value), FIELD_SCHEMA.simpleString(), SPLIT_OPTIONS).alias("r")).select("r.*")


def parse_fields(fields: DataFrame) -> DataFrame:
    """A3: ``(timestamp, area, <six metrics>)`` typed rows from split lines.

    A field at position ``i`` exists, as for a split that drops trailing
    empty fields, when some field at ``i`` or later is non-empty.
    """
    f = lambda i: F.col(f"f{i}")
    header = (f(0) == K.HEADER_PREFIX.split(",")[0]) & f(1).startswith(K.HEADER_PREFIX.split(",")[1])
    non_empty = [f(i).isNotNull() & (f(i) != "") for i in range(N_FIELDS)]
    area_exists = non_empty[K.TEXT_POS_AREA]
    for i in range(K.TEXT_POS_AREA + 1, N_FIELDS):
        area_exists = area_exists | non_empty[i]
    ts_text = f(K.TEXT_POS_TIMESTAMP)
    cols = {
        "timestamp": F.when(ts_text.rlike(r"^[+-]?[0-9]+$"), ts_text.try_cast("bigint")),
        "area": F.when(area_exists, F.coalesce(f(K.TEXT_POS_AREA), F.lit(""))),
    }
    for name, pos in K.TEXT_METRIC_POSITIONS.items():
        raw = F.trim(f(pos))
        cols[name] = F.when(raw != "", raw.try_cast("double"))
    parsed = fields.where(~F.coalesce(header, F.lit(False))).select(*[c.alias(n) for n, c in cols.items()])
    valid = F.col("timestamp").isNotNull() & F.col("area").isNotNull()
    for m in K.TEXT_METRIC_POSITIONS:
        valid = valid & F.col(f"`{m}`").isNotNull() & ~F.isnan(F.col(f"`{m}`"))
    return parsed.where(valid)


def parse_measurement_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """A3 on a frame of raw text lines."""
    return parse_fields(split_lines(lines, value))


def read_measurement_lines(spark: SparkSession, path: str) -> DataFrame:
    """A3: read and parse in one step (the split runs inside the file scan)."""
    return parse_fields(read_fields(spark, path))


def render_measurement_lines(df: DataFrame) -> DataFrame:
    """Inverse of the parser: one comma-separated line of the 41 header
    positions per row (columns absent from ``df`` stay empty); ``value``."""
    def field(name: str):
        if name not in df.columns:
            return F.lit("")
        return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))
    return df.select(F.concat_ws(",", *[field(c) for c in K.MEASUREMENT_COLUMNS]).alias("value"))
