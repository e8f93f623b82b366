from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def literal_rows(spark: SparkSession, rows: Sequence[Sequence], schema: str | T.StructType) -> DataFrame:
    """A few rows known when the plan is built, as literals: no Python worker is started to read them."""
    fields = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields)]) for row in rows]
    if not structs:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])
    return spark.range(1).select(F.inline(F.array(*structs)))


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def numeric_columns(df: DataFrame, exclude: list[str] | tuple[str, ...] = ()) -> list[str]:
    """Numeric columns of ``df`` in schema order (booleans are not numeric)."""
    skip = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in skip]


# Largest table broadcast after a size check.
BROADCAST_MAX_BYTES = 64 << 20


def _row_bytes(schema: T.StructType) -> Column:
    """Bytes of a row as the join's hash table holds it, about: 8 a value, texts and arrays by their length."""
    total = F.lit(16)
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            total = total + 16 + F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(f.dataType, T.ArrayType):
            each = 8 * len(f.dataType.elementType) if isinstance(f.dataType.elementType, T.StructType) else 8
            total = total + 24 + F.coalesce(F.greatest(F.size(c), F.lit(0)), F.lit(0)) * each
        else:
            total = total + 8
    return total


def checked_broadcast(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``broadcast(df)`` when ``df`` has at most about ``max_bytes`` bytes, else ``df``.

    For small tables derived from materialized statistics (one row per
    group): measuring them is cheap, and beyond the bound the join stays a
    shuffle join whose hot keys adaptive execution splits (see
    ``session.scale_conf``: also where the keys are grouped next).
    """
    size = df.agg(F.sum(_row_bytes(df.schema))).first()[0]
    return F.broadcast(df) if (size or 0) <= max_bytes else df


def fit(df: DataFrame, *aggs: Column):
    """Run a global aggregate and return its single row (the "fit" step).

    As Spark ML estimators do, one-row statistics (min/max, modes, moments)
    are computed by one distributed aggregation and brought back as a few
    numbers, bounded by the number of columns, never by the row count. The
    "transform" step then uses them as literals, so its plan stays one flat
    code-generated projection.
    """
    return df.agg(*aggs).first()

