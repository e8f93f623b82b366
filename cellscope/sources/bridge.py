"""Measurement view over the driver's ``lineitem`` table.

The test tables hold no radio measurements, so this projection gives every
measurement role a deterministic expression over ``lineitem`` columns, with
nulls injected by modulus so that cleaning and profiling have work to do.
Column names are those of the measurement table, so every operator runs on
it with its defaults. It is a narrow projection: it scans only the eleven
``lineitem`` columns it needs and grows linearly with the table.

``BRIDGE_SQL`` is the same view as DuckDB SQL text; the correctness oracles
are written on top of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _d(c: Column) -> Column:
    return c.cast("double")


def _null_when(cond: Column, value: Column) -> Column:
    return F.when(cond, F.lit(None).cast("double")).otherwise(value)


def measurement_view(lineitem: DataFrame) -> DataFrame:
    """Project ``lineitem`` onto the measurement schema (22 columns)."""
    ok, pk, sk, ln = (F.col(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))
    return lineitem.select(
        F.concat_ws("-", ok.cast("string"), ln.cast("string"), pk.cast("string"), sk.cast("string")).alias("id"),
        (F.lit(1609459200) + ((ok * 3607 + ln * 977) % 2592000).cast("bigint")).alias("timestamp"),
        F.concat(F.lit("pc"), (pk % 3 + 1).cast("string")).alias("device"),
        (F.lit(-140.0) + F.col("l_quantity") * F.lit(1.5)).alias("PCell_RSRP_max"),
        _null_when(ok % 11 == 0, _d(pk % 35 - 5)).alias("PCell_SNR_max"),
        _d(pk % 29).alias("PCell_Downlink_Average_MCS"),
        _null_when(ok % 13 == 0, _d(F.when(sk % 3 == 0, 15).otherwise(20))).alias("PCell_Downlink_bandwidth_MHz"),
        _null_when(ok % 17 == 0, _d(F.lit(2568960) + sk % 7)).alias("PCell_Cell_Identity"),
        _d(F.when(pk % 4 == 0, 2600).otherwise(1800)).alias("PCell_freq_MHz"),
        _null_when(ln % 3 == 0, _d(pk % 60 - 130)).alias("SCell_RSRP_max"),
        _null_when(ln % 3 == 0, _d(sk % 25 - 3)).alias("SCell_SNR_max"),
        (sk % 2 + 1).cast("int").alias("operator"),
        (F.lit(52.4) + _d(pk % 1000) / F.lit(10000.0)).alias("Latitude"),
        (F.lit(13.2) + _d(sk % 100) / F.lit(1000.0)).alias("Longitude"),
        _d(sk % 90).alias("speed_kmh"),
        _d(pk % 360).alias("COG"),
        F.col("l_discount").alias("precipProbability"),
        (F.lit(18.0) + F.col("l_tax") * F.lit(100.0)).alias("temperature"),
        (F.lit(0.5) + F.col("l_tax")).alias("humidity"),
        _d(F.lit(1000) + ok % 30).alias("pressure"),
        (F.col("l_discount") * F.lit(100.0)).alias("Traffic Jam Factor"),
        F.concat(F.col("l_returnflag"), F.col("l_linestatus")).alias("area"),
        F.col("l_extendedprice").alias("target"),
    )


def load_measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The measurement view over ``{sf_dir}/lineitem.parquet``."""
    return measurement_view(spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet"))


# The same view as DuckDB SQL (used by the oracles only).
BRIDGE_SQL = """
SELECT
  concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR)) AS id,
  CAST(1609459200 + CAST((l_orderkey * 3607 + l_linenumber * 977) % 2592000 AS BIGINT) AS BIGINT) AS "timestamp",
  concat('pc', CAST(l_partkey % 3 + 1 AS VARCHAR)) AS device,
  CAST(-140.0 AS DOUBLE) + l_quantity * CAST(1.5 AS DOUBLE) AS PCell_RSRP_max,
  CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE CAST(l_partkey % 35 - 5 AS DOUBLE) END AS PCell_SNR_max,
  CAST(l_partkey % 29 AS DOUBLE) AS PCell_Downlink_Average_MCS,
  CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE CAST(CASE WHEN l_suppkey % 3 = 0 THEN 15 ELSE 20 END AS DOUBLE) END AS PCell_Downlink_bandwidth_MHz,
  CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE CAST(2568960 + l_suppkey % 7 AS DOUBLE) END AS PCell_Cell_Identity,
  CAST(CASE WHEN l_partkey % 4 = 0 THEN 2600 ELSE 1800 END AS DOUBLE) AS PCell_freq_MHz,
  CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE CAST(l_partkey % 60 - 130 AS DOUBLE) END AS SCell_RSRP_max,
  CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE CAST(l_suppkey % 25 - 3 AS DOUBLE) END AS SCell_SNR_max,
  CAST(l_suppkey % 2 + 1 AS INTEGER) AS operator,
  CAST(52.4 AS DOUBLE) + CAST(l_partkey % 1000 AS DOUBLE) / CAST(10000.0 AS DOUBLE) AS Latitude,
  CAST(13.2 AS DOUBLE) + CAST(l_suppkey % 100 AS DOUBLE) / CAST(1000.0 AS DOUBLE) AS Longitude,
  CAST(l_suppkey % 90 AS DOUBLE) AS speed_kmh,
  CAST(l_partkey % 360 AS DOUBLE) AS COG,
  l_discount AS precipProbability,
  CAST(18.0 AS DOUBLE) + l_tax * CAST(100.0 AS DOUBLE) AS temperature,
  CAST(0.5 AS DOUBLE) + l_tax AS humidity,
  CAST(1000 + l_orderkey % 30 AS DOUBLE) AS pressure,
  l_discount * CAST(100.0 AS DOUBLE) AS "Traffic Jam Factor",
  concat(l_returnflag, l_linestatus) AS area,
  l_extendedprice AS target
FROM lineitem
"""
