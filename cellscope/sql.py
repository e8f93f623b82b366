"""The library from SQL text: functions, and operators as views with parameters.

``install`` gives a session functions for ``spark.sql``. They are Spark's own
SQL functions: the optimizer puts their bodies in the place of the call, so
arguments that are literals become filters that reach the scan, and nothing
runs that Spark would not run for the DataFrame functions of the same names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from cellscope import constants as K
from cellscope.operators.aggregate import AREA_HOUR_OUTPUT
from cellscope.plans.routing import prepare_features

#: Scalar functions: parameters, result, expression (D1-D8 as in ``functions``; epochs are seconds, the clock is the session's).
SCALARS = {
    "epoch_to_timestamp": ("epoch DOUBLE", "TIMESTAMP", "timestamp_seconds(epoch)"),
    "hour_of_day": ("ts TIMESTAMP", "INT", "hour(ts)"),
    "hour_text": ("ts TIMESTAMP", "STRING", "date_format(ts, 'HH')"),
    "weekday_short": ("ts TIMESTAMP", "STRING", "date_format(ts, 'E')"),
    "weekday_long": ("ts TIMESTAMP", "STRING", "date_format(ts, 'EEEE')"),
    "calendar_date": ("ts TIMESTAMP", "DATE", "to_date(ts)"),
    "round4": ("x DOUBLE", "DOUBLE", "round(x, 4)"),
    "fmt2": ("x DOUBLE", "STRING", "format_string('%.2f', x)"),
    "fmt0": ("x DOUBLE", "STRING", "format_string('%.0f', x)"),
    "nan_to_null": ("x DOUBLE", "DOUBLE", "nullif(x, double('NaN'))"),
    "area_hour_key": ("area STRING, hour_hh STRING", "STRING", "concat(area, '_', hour_hh)"),
    "route_label": ("id STRING", "STRING", "concat('Route ', id)"),
    "color_band": (
        f"value DOUBLE, lo DOUBLE, hi DOUBLE, epsilon DOUBLE DEFAULT {K.COLOR_EPSILON}D", "STRING",
        f"CASE WHEN value IS NULL THEN '{K.COLOR_MISSING}' "
        f"WHEN coalesce(try_divide(log1p(value) - lo, hi - lo + epsilon), double('NaN')) < {K.COLOR_LOW_CUT}D THEN '{K.COLOR_LOW}' "
        f"WHEN coalesce(try_divide(log1p(value) - lo, hi - lo + epsilon), double('NaN')) < {K.COLOR_MID_CUT}D THEN '{K.COLOR_MID}' "
        f"ELSE '{K.COLOR_HIGH}' END"),
}

_WEIGHTS = ", ".join(f"{c} DOUBLE DEFAULT {w}D" for c, w in K.DEFAULT_WEIGHTS.items())
_SCORE = " + ".join(f"{w} * {c}" for w, c in zip(K.WEIGHT_NAMES[:3], K.COMPONENT_COLUMNS)) + f" - {K.WEIGHT_NAMES[3]} * {K.COMPONENT_COLUMNS[3]}"
_COMPONENTS = ", ".join(f"{c} DOUBLE" for c in K.COMPONENT_COLUMNS)
_SPAN = "(since IS NULL OR `timestamp` >= since) AND (until IS NULL OR `timestamp` < until)"
_SPAN_PARAMS = "since BIGINT DEFAULT NULL, until BIGINT DEFAULT NULL"


def _present(columns: Sequence[str]) -> str:
    return " AND ".join(f"`{c}` IS NOT NULL AND NOT isnan(`{c}`)" for c in columns)


#: Views with parameters: the table's columns that they need, parameters, columns, query; ``{p}`` is the prefix, ``{id_type}`` the type of the table's ``id``.
TABLES = {
    # E1 over the readings of a span of time, of one area or all.
    "area_hour": (
        ["area", "timestamp", *K.AREA_HOUR_METRICS], f"{_SPAN_PARAMS}, only_area STRING DEFAULT NULL",
        "area STRING, hour INT, " + ", ".join(f"{n} DOUBLE" for n in AREA_HOUR_OUTPUT) + ", n BIGINT",
        "SELECT area, hour(timestamp_seconds(`timestamp`)), " + ", ".join(f"avg(`{c}`)" for c in K.AREA_HOUR_METRICS) + ", count(*) "
        f"FROM {{p}}measurements WHERE {_present(['timestamp', *K.AREA_HOUR_METRICS])} AND {_SPAN} AND (only_area IS NULL OR area = only_area) GROUP BY ALL"),
    # E3 with counts: mean target by hour and operator.
    "hourly_target": (
        ["timestamp", "operator", "target"], _SPAN_PARAMS, "hour INT, operator STRING, mean_target DOUBLE, n BIGINT",
        "SELECT hour(timestamp_seconds(`timestamp`)), CAST(operator AS STRING), avg(target), count(target) "
        f"FROM {{p}}measurements WHERE {_SPAN} GROUP BY ALL"),
    # H4: the component scores of all readings under given weights.
    "weighted_scores": (
        K.SCORE_REQUIRED_COLUMNS, _WEIGHTS, f"id {{id_type}}, {_COMPONENTS}, {K.SCORE_COLUMN} DOUBLE",
        f"SELECT id, {', '.join(K.COMPONENT_COLUMNS)}, {_SCORE} FROM {{p}}features"),
    # the k best readings under given weights; a task hands on k rows at most.
    "top_routes": (
        K.SCORE_REQUIRED_COLUMNS, f"k INT DEFAULT {K.TOP_K}, {_WEIGHTS}", f"place INT, route STRING, {K.SCORE_COLUMN} DOUBLE",
        f"SELECT place, {{p}}route_label(CAST(id AS STRING)), score FROM (SELECT id, score, row_number() OVER (ORDER BY score DESC, id) AS place "
        f"FROM (SELECT id, {_SCORE} AS score FROM {{p}}features)) WHERE place <= k"),
}


def install(spark: SparkSession, measurements: DataFrame, prefix: str = "cs_", ranges: bool = True) -> list[str]:
    """Make the functions, over ``measurements``; their names, each with ``prefix``.

    Scalar functions: ``SCALARS``. Views with parameters: ``TABLES``, called as
    ``SELECT * FROM cs_area_hour(since => 1609459200)``; parameters that are
    not given have their defaults, and a null limit is none. Also the temporary
    views ``measurements`` and ``features`` (component scores; with prefix).
    A view whose columns the table does not have is not made (those of the
    scores fill missing inputs by their defaults, but need ``id``).
    ``ranges=False`` leaves out the views of scores, and with them the one pass
    over the table that fits the scaling.

    Everything is temporary: it ends with the session, and a second call puts
    new definitions in the place of the old ones.
    """
    names = []

    def define(name: str, params: str, returns: str, body: str) -> None:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({params}) RETURNS {returns} RETURN {body}")
        names.append(prefix + name)
    for name, (params, result, body) in SCALARS.items():
        define(name, params, result, body)
    measurements.createOrReplaceTempView(f"{prefix}measurements")
    have = set(measurements.columns)
    scored, id_type = ranges and "id" in have, ""
    if scored:
        featured, _ = prepare_features(measurements)
        featured.createOrReplaceTempView(f"{prefix}features")
        id_type = measurements.schema["id"].dataType.simpleString()
    for name, (needed, params, columns, query) in TABLES.items():
        of_scores = needed is K.SCORE_REQUIRED_COLUMNS
        if scored if of_scores else have.issuperset(needed):
            define(name, params, f"TABLE({columns.format(id_type=id_type)})", query.format(p=prefix))
    return names
