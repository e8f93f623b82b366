"""Measurement CSV source with header (A1) and fallback paths (A2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellscope import constants as K

_STRINGS = {"id", "device", "area"}
_LONGS = {"timestamp"}
_INTS = {"operator"}


def _type(name: str) -> T.DataType:
    if name in _STRINGS:
        return T.StringType()
    if name in _LONGS:
        return T.LongType()
    if name in _INTS:
        return T.IntegerType()
    return T.DoubleType()


MEASUREMENT_SCHEMA = T.StructType([T.StructField(c, _type(c), True) for c in K.MEASUREMENT_COLUMNS])


def read_measurements(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | None = MEASUREMENT_SCHEMA,
                      infer: bool = False, nan_as_null: bool = True) -> DataFrame:
    """A1: the measurement CSV (header, comma separated, empty field = null).

    Columns are taken by the name in the header, in any order: declared names
    get their declared type, other names are text, and declared columns that
    the file lacks are absent (B1 and B2 handle them). Files whose headers
    differ raise an error when they are read. No inference pass runs and a
    malformed number becomes null (``PERMISSIVE``); ``infer=True`` samples the
    file instead. NaN becomes null so that one null model holds.
    """
    paths = path if isinstance(path, str) else list(path)
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if infer or schema is None:
        reader = reader.option("inferSchema", True)
    else:
        declared = {f.name: f.dataType for f in schema.fields}
        names = reader.csv(paths).columns  # the header line alone
        reader = reader.option("enforceSchema", False).schema(
            T.StructType([T.StructField(c, declared.get(c, T.StringType()), True) for c in names]))
    df = reader.csv(paths)
    if not nan_as_null:
        return df
    fixes = {f.name: F.when(F.isnan(F.col(f"`{f.name}`")), F.lit(None)).otherwise(F.col(f"`{f.name}`"))
             for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.withColumns(fixes) if fixes else df


def read_first_available(spark: SparkSession, paths: Sequence[str], reader=read_measurements, **kwargs) -> DataFrame:
    """A2: read the first path that exists (e.g. the full file, else the sample).

    Only a missing path leads on to the next one; any other error is raised.
    """
    errors = []
    for p in paths:
        try:
            return reader(spark, p, **kwargs)
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
            errors.append(str(p))
    raise FileNotFoundError("none of the paths exists: " + ", ".join(errors))
