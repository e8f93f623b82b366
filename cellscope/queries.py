"""Registered queries (one per operator of the inventory) and their oracles.

Each query takes ``(spark, sf_dir)``, reads the driver tables through the
measurement view and returns a lazy DataFrame over the whole table. Each
oracle is DuckDB SQL over the same tables; ``M`` is the measurement view as
a CTE and ``E`` adds the cleaned and time-featured view ``e`` on top.
Floating results are rounded to 6 decimals on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellscope import constants as K
from cellscope.functions._util import literal_rows
from cellscope.functions import scalar as fs
from cellscope.functions import time as ft
from cellscope.operators import aggregate as agg
from cellscope.operators import clean as cl
from cellscope.operators import correlation as corr
from cellscope.operators import distribution as dist
from cellscope.operators import geo
from cellscope.operators import profile as prof
from cellscope.operators import rank
from cellscope.operators import sample as smp
from cellscope.operators import scale as sc
from cellscope.operators import search as srch
from cellscope.plans import routing
from cellscope.sources import csv as csv_src
from cellscope.sources import sinks
from cellscope.sources import text as text_src
from cellscope.sources.bridge import BRIDGE_SQL, load_measurements
from cellscope.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = nudge_rounding(oracle)
        return fn
    return deco


def nudge_rounding(sql: str) -> str:
    """Rewrite every ``round(X, 6)`` of an oracle to round as ``round6`` does."""
    out, i = [], 0
    while True:
        j = sql.find("round(", i)
        if j < 0 or (j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k = 0, j + 5
        while True:
            ch = sql[k]
            depth += ch == "("
            depth -= ch == ")"
            if depth == 0:
                break
            k += 1
        inner = sql[j + 6:k]
        comma = inner.rfind(",")
        if inner[comma + 1:].strip() == "6":
            x = nudge_rounding(inner[:comma])
            # Through DECIMAL: DuckDB's double round scales by 10^6 in floating
            # point, which misrounds large values; Spark rounds the decimal form.
            out.append(sql[i:j] + f"CAST(round(CAST(({x}) + 1e-9 AS DECIMAL(38,18)), 6) AS DOUBLE)")
        else:
            out.append(sql[i:j] + "round(" + nudge_rounding(inner) + ")")
        i = k + 1


def round6(c) -> "F.Column":
    """Round to 6 decimals for the value-hash comparison.

    A nudge of 1e-9 (above the summation noise of these magnitudes, below
    the last kept digit) moves exact decimal ties, such as an average of
    exactly 0.5390625, off the tie, so that both engines round them the same
    way whatever their summation order. The oracles apply the same function.
    """
    x = F.col(c) if isinstance(c, str) else c
    return F.round(x + F.lit(1e-9), 6)


def r6(df: DataFrame) -> DataFrame:
    """Round every double column (for the value-hash comparison)."""
    return df.select(*[round6(F.col(f"`{f.name}`")).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return load_measurements(spark, sf_dir)


def engineered(spark: SparkSession, sf_dir: str, mode_columns=tuple(K.PCELL_MODE_COLUMNS)) -> DataFrame:
    """Measurements after the EDA preparation: clean (B9), operator as text
    (B7), time features (D11). Queries that use none of the mode-filled
    columns pass none: then nothing is fitted."""
    return ft.engineer_time_features(cl.operator_to_string(cl.clean(measurements(spark, sf_dir), mode_columns=mode_columns)))


# ---------------------------------------------------------------------------
# SQL helpers for the oracles
# ---------------------------------------------------------------------------

def q(c: str) -> str:
    return f'"{c}"'


def r(expr: str) -> str:
    return f"round({expr}, 6)"


def java_fmt(expr: str, digits: int, pre_round: int | None = None) -> str:
    """Java ``%.Nf``: half-up on the shortest decimal form of the double
    (optionally of the value first rounded to ``pre_round`` significant digits)."""
    src = f"CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,18))"
    if pre_round is not None:
        src = f"CAST(CAST(CAST(format('{{:.{pre_round - 1}e}}', {expr}) AS DOUBLE) AS VARCHAR) AS DECIMAL(38,18))"
    dec = f"round({src}, {digits})"
    txt = f"CAST(CAST({dec} AS DECIMAL(38,{digits})) AS VARCHAR)"
    return (f"CASE WHEN {expr} IS NULL THEN 'null' WHEN {expr} < 0 AND {dec} = 0 THEN '-' || {txt} "
            f"ELSE {txt} END")


M = f"WITH m AS ({BRIDGE_SQL})\n"
HOUR_SQL = 'CAST(("timestamp" // 3600) % 24 AS INTEGER)'
TS_SQL = 'make_timestamp(CAST("timestamp" AS BIGINT) * 1000000)'


def _mode_sql(c: str) -> str:
    return (f"(SELECT v FROM (SELECT {q(c)} AS v, count(*) AS cnt FROM m WHERE {q(c)} IS NOT NULL GROUP BY 1) "
            f"ORDER BY cnt DESC, v ASC LIMIT 1)")


CLEAN_SELECT = (
    "SELECT m.* REPLACE (coalesce(SCell_RSRP_max, 0.0) AS SCell_RSRP_max, coalesce(SCell_SNR_max, 0.0) AS SCell_SNR_max"
    + "".join(f", coalesce({q(c)}, {_mode_sql(c)}) AS {q(c)}" for c in K.PCELL_MODE_COLUMNS)
    + "), SCell_RSRP_max IS NOT NULL AS has_scell FROM m"
)
E = M + f""", c AS ({CLEAN_SELECT}),
e AS (SELECT c.* REPLACE (CAST(operator AS VARCHAR) AS operator), {HOUR_SQL} AS hour_of_day,
      strftime({TS_SQL}, '%a') AS day_of_week FROM c)
"""

BRIDGE_COLUMNS = ["id", "timestamp", "device", "PCell_RSRP_max", "PCell_SNR_max", "PCell_Downlink_Average_MCS",
                  "PCell_Downlink_bandwidth_MHz", "PCell_Cell_Identity", "PCell_freq_MHz", "SCell_RSRP_max",
                  "SCell_SNR_max", "operator", "Latitude", "Longitude", "speed_kmh", "COG", "precipProbability",
                  "temperature", "humidity", "pressure", "Traffic Jam Factor", "area", "target"]
BRIDGE_NUMERIC = [c for c in BRIDGE_COLUMNS if c not in ("id", "device", "area")]
BRIDGE_TYPES = {c: "double" for c in BRIDGE_NUMERIC}
BRIDGE_TYPES.update({"id": "string", "device": "string", "area": "string", "timestamp": "bigint", "operator": "int"})
# Columns of the matrices: numeric columns of the prepared view minus the excluded ones.
MATRIX_COLUMNS = [c for c in BRIDGE_NUMERIC if c not in K.CORR_EXCLUDE and c != "operator"] + ["hour_of_day"]


# --- scoring oracles -------------------------------------------------------

def _scaled(c: str) -> str:
    return (f"CASE WHEN max({q(c)}) OVER () = min({q(c)}) OVER () THEN 0.5 ELSE ({q(c)} - min({q(c)}) OVER ()) / "
            f"(max({q(c)}) OVER () - min({q(c)}) OVER ()) END")


SCALED_CTE = (", v AS (SELECT * FROM m WHERE " + " AND ".join(f"{q(c)} IS NOT NULL" for c in K.SCORE_REQUIRED_COLUMNS)
              + "),\nsc AS (SELECT id, target, " + ", ".join(f"{_scaled(c)} AS {q(c + '_norm')}" for c in K.SCORE_INPUT_COLUMNS)
              + " FROM v),\n"
              "comp AS (SELECT id, target, 0.6 * PCell_RSRP_max_norm + 0.4 * PCell_SNR_max_norm AS SignalScore, "
              "1.0 - speed_kmh_norm AS MobilityScore, 0.5 * temperature_norm + 0.5 * pressure_norm AS EnvScore, "
              "\"Traffic Jam Factor_norm\" AS CongestionPenalty FROM sc)")
SCORED_CTE = SCALED_CTE + (",\nscored AS (SELECT *, 0.4 * SignalScore + 0.2 * MobilityScore + 0.1 * EnvScore "
                           "- 0.3 * CongestionPenalty AS QoS_Score FROM comp)")


def sel(cols: list[str], src: str = "m") -> str:
    """SELECT list that rounds the double columns of the measurement view."""
    items = [f"round({q(c)}, 6) AS {q(c)}" if BRIDGE_TYPES.get(c) == "double" else q(c) for c in cols]
    return f"SELECT {', '.join(items)} FROM {src}"


# ---------------------------------------------------------------------------
# A: sources and sinks
# ---------------------------------------------------------------------------

def _e1_sql(rounded: bool = True) -> str:
    rd = r if rounded else (lambda e: e)
    return f"""
SELECT area, {HOUR_SQL} AS hour,
  {rd('avg(PCell_RSRP_max)')} AS avg_rsrp, {rd('avg(PCell_SNR_max)')} AS avg_snr,
  {rd('avg(speed_kmh)')} AS avg_speed, {rd('avg("Traffic Jam Factor")')} AS avg_jam,
  {rd('avg(humidity)')} AS avg_humidity, {rd('avg(precipProbability)')} AS avg_precip,
  count(*) AS n
FROM m
WHERE "timestamp" IS NOT NULL AND PCell_RSRP_max IS NOT NULL AND PCell_SNR_max IS NOT NULL
  AND speed_kmh IS NOT NULL AND "Traffic Jam Factor" IS NOT NULL AND humidity IS NOT NULL
  AND precipProbability IS NOT NULL
GROUP BY 1, 2
"""


E1_SQL_BODY = _e1_sql()


@register("e1_area_hour_avg", M + E1_SQL_BODY)
def q_e1(spark, sf_dir):
    """E1 (flagship): area-hour averages of six metrics."""
    return r6(agg.area_hour_averages(measurements(spark, sf_dir)))


@register("a1_csv_source", M + sel(["id", "timestamp", "device", "PCell_RSRP_max", "PCell_SNR_max", "operator", "area", "target"]))
def q_a1(spark, sf_dir):
    """A1 + A2: measurements written as header CSV without one column, in
    another order and with a column more, read back by name through the
    fallback reader."""
    m = measurements(spark, sf_dir)
    path = scratch_path(spark, "measurements-csv")
    layout = m.select(*[F.col(f"`{c}`") if c in m.columns else F.lit(None).cast(csv_src._type(c)).alias(c)
                        for c in reversed(K.MEASUREMENT_COLUMNS) if c != "Altitude"], F.lit("x").alias("extra"))
    layout.write.option("header", True).csv(path)
    df = csv_src.read_first_available(spark, [path + "-absent", path])
    return r6(df.select("id", "timestamp", "device", "PCell_RSRP_max", "PCell_SNR_max", "operator", "area", "target"))


@register("a3_text_source_area_hour", M + E1_SQL_BODY)
def q_a3(spark, sf_dir):
    """A3 + J1/J2: measurements rendered as raw comma lines (with a header
    line), parsed back by the tolerant positional source, then E1."""
    m = measurements(spark, sf_dir)
    path = scratch_path(spark, "measurements-text")
    header = literal_rows(spark, [(",".join(K.MEASUREMENT_COLUMNS),)], "value string")
    header.unionByName(text_src.render_measurement_lines(m)).write.text(path)
    return r6(agg.area_hour_averages(text_src.read_measurement_lines(spark, path)))


@register("a4_text_sink_lines", M + f"""
, g AS ({_e1_sql(False)})
SELECT area || '_' || lpad(CAST(hour AS VARCHAR), 2, '0') || chr(9) || {java_fmt('avg_rsrp', 2, 13)} || ',' ||
  {java_fmt('avg_snr', 2, 13)} || ',' || {java_fmt('avg_speed', 2, 13)} || ',' || {java_fmt('avg_jam', 2, 13)} || ',' ||
  {java_fmt('avg_humidity', 2, 13)} || ',' || {java_fmt('avg_precip', 2, 13)} AS value
FROM g
""")
def q_a4(spark, sf_dir):
    """A4: the key-ordered ``area_HH<TAB>v1,...,v6`` text lines (the frame
    that ``write_area_hour_text`` writes)."""
    return sinks.area_hour_lines(agg.area_hour_averages(measurements(spark, sf_dir), order=False))


@register("s1_stream_area_hour_lines", ORACLES["a4_text_sink_lines"])
def q_s1(spark, sf_dir):
    """A3 -> E1 -> A4 as a Structured Streaming query: the measurement lines
    arrive as two time-ordered batches of files; the second run resumes from
    the checkpoint; the last epoch's key-ordered text snapshot is returned."""
    from cellscope.streaming.area_hour import latest_snapshot, start_area_hour_stream
    m = measurements(spark, sf_dir)
    base = scratch_path(spark, "stream")
    split = F.col("timestamp") < F.lit(1610755200)
    for part, cond in (("early", split), ("late", ~split)):
        text_src.render_measurement_lines(m.where(cond)).write.text(f"{base}/in/{part}")
        if part == "early":
            start_area_hour_stream(spark, f"{base}/in/*", f"{base}/out", f"{base}/ckpt").awaitTermination()
    start_area_hour_stream(spark, f"{base}/in/*", f"{base}/out", f"{base}/ckpt").awaitTermination()
    return latest_snapshot(spark, f"{base}/out")


@register("a5_preview", M + SCORED_CTE + """
, s AS (SELECT * FROM scored ORDER BY QoS_Score DESC, id ASC LIMIT 1000)
SELECT id, round(SignalScore, 6) AS SignalScore, round(MobilityScore, 6) AS MobilityScore,
  round(EnvScore, 6) AS EnvScore, round(CongestionPenalty, 6) AS CongestionPenalty, round(QoS_Score, 6) AS QoS_Score
FROM s
""")
def q_a5(spark, sf_dir):
    """A5: the 1,000-row preview of the fixed-weight scores, by score."""
    return r6(routing.score_fixed(measurements(spark, sf_dir)).preview)


# ---------------------------------------------------------------------------
# B: projection and cleaning
# ---------------------------------------------------------------------------

@register("b1_select_present", M + sel(K.SCORE_REQUIRED_COLUMNS))
def q_b1(spark, sf_dir):
    """B1: the required scoring columns that exist (Altitude does not)."""
    cols = ["id", "Altitude", *K.SCORE_INPUT_COLUMNS, "target"]
    return r6(cl.select_present(measurements(spark, sf_dir), cols))


@register("b2_default_missing", M + "SELECT id, round(PCell_RSRP_max, 6) AS PCell_RSRP_max, 0.0 AS Altitude, 0.0 AS windSpeed, "
          "round(target, 6) AS target FROM m")
def q_b2(spark, sf_dir):
    """B2: absent inputs added as 0.0."""
    m = cl.select_present(measurements(spark, sf_dir), ["id", "PCell_RSRP_max", "Altitude", "windSpeed", "target"])
    return r6(cl.default_missing(m, ["PCell_RSRP_max", "Altitude", "windSpeed", "target"])
              .select("id", "PCell_RSRP_max", "Altitude", "windSpeed", "target"))


@register("b3_complete_cases", M + sel(BRIDGE_COLUMNS) + " WHERE " + " AND ".join(f"{q(c)} IS NOT NULL" for c in BRIDGE_COLUMNS))
def q_b3(spark, sf_dir):
    """Rows with every column present."""
    return r6(cl.complete_cases(measurements(spark, sf_dir)))


@register("b4_presence_flag", M + "SELECT id, SCell_RSRP_max IS NOT NULL AS has_scell FROM m")
def q_b4(spark, sf_dir):
    """``has_scell`` flag."""
    return cl.add_presence_flag(measurements(spark, sf_dir)).select("id", "has_scell")


@register("b5_zero_fill_prefix", M + "SELECT id, round(coalesce(SCell_RSRP_max, 0.0), 6) AS SCell_RSRP_max, "
          "round(coalesce(SCell_SNR_max, 0.0), 6) AS SCell_SNR_max, round(PCell_SNR_max, 6) AS PCell_SNR_max FROM m")
def q_b5(spark, sf_dir):
    """Zero-fill of the numeric ``SCell_`` columns only."""
    return r6(cl.zero_fill_prefix(measurements(spark, sf_dir)).select("id", "SCell_RSRP_max", "SCell_SNR_max",
                                                                       "PCell_SNR_max"))


@register("b6_mode_impute", M + "SELECT id, " + ", ".join(
    f"round(coalesce({q(c)}, {_mode_sql(c)}), 6) AS {q(c)}" for c in K.PCELL_MODE_COLUMNS) + " FROM m")
def q_b6(spark, sf_dir):
    """Mode imputation of the three PCell columns."""
    return r6(cl.impute_mode(measurements(spark, sf_dir)).select("id", *K.PCELL_MODE_COLUMNS))


@register("b6_mode_values", M + "SELECT " + ", ".join(f"round({_mode_sql(c)}, 6) AS {q(c)}" for c in K.PCELL_MODE_COLUMNS))
def q_b6m(spark, sf_dir):
    """The mode of each column (one row)."""
    return r6(cl.mode_values(measurements(spark, sf_dir), K.PCELL_MODE_COLUMNS))


@register("b7_operator_text", M + "SELECT id, CAST(operator AS VARCHAR) AS operator FROM m")
def q_b7(spark, sf_dir):
    """Operator code as text."""
    return cl.operator_to_string(measurements(spark, sf_dir)).select("id", "operator")


@register("b8_parse_numbers", M + """
SELECT id, round(TRY_CAST(CAST(PCell_SNR_max AS VARCHAR) AS DOUBLE), 6) AS snr_text, TRY_CAST(device AS DOUBLE) AS device
FROM m WHERE PCell_SNR_max IS NOT NULL
""")
def q_b8(spark, sf_dir):
    """Text columns to numbers; malformed text (``device``) becomes null,
    rows with a missing number are rejected as a whole."""
    m = measurements(spark, sf_dir).select("id", F.col("PCell_SNR_max").cast("string").alias("snr_text"), "device")
    return r6(cl.complete_cases(cl.parse_numbers(m, ["snr_text", "device"]), ["snr_text"]))


@register("b9_clean", M + f", c AS ({CLEAN_SELECT})\n" + sel(["id", "has_scell", "SCell_RSRP_max", "SCell_SNR_max",
                                                                  *K.PCELL_MODE_COLUMNS], "c"))
def q_b9(spark, sf_dir):
    """The whole cleaning step."""
    return r6(cl.clean(measurements(spark, sf_dir)).select("id", "has_scell", "SCell_RSRP_max", "SCell_SNR_max",
                                                           *K.PCELL_MODE_COLUMNS))


# ---------------------------------------------------------------------------
# C: profiling
# ---------------------------------------------------------------------------

def _info_sql() -> str:
    parts = [f"SELECT {i} AS position, '{c}' AS \"column\", '{BRIDGE_TYPES[c]}' AS type, count({q(c)}) AS non_null FROM m"
             for i, c in enumerate(BRIDGE_COLUMNS)]
    return M + "\nUNION ALL\n".join(parts)


@register("c1_info", _info_sql())
def q_c1(spark, sf_dir):
    """C1 + C7: schema with non-null counts (a frame summary)."""
    return prof.info(measurements(spark, sf_dir))


@register("c2_shape", M + f"SELECT count(*) AS n_rows, {len(BRIDGE_COLUMNS)} AS n_cols FROM m")
def q_c2(spark, sf_dir):
    """Row and column count."""
    return prof.shape(measurements(spark, sf_dir))


@register("c3_head", M + sel(BRIDGE_COLUMNS) + " ORDER BY id LIMIT 5")
def q_c3(spark, sf_dir):
    """First 5 rows by id."""
    return r6(prof.head(measurements(spark, sf_dir)))


@register("c4_null_counts", M + "SELECT " + ", ".join(f"count(*) FILTER (WHERE {q(c)} IS NULL) AS {q(c)}"
                                                      for c in BRIDGE_COLUMNS) + " FROM m")
def q_c4(spark, sf_dir):
    """C4: null count per column, one wide row."""
    return prof.null_counts(measurements(spark, sf_dir))


@register("c5_null_profile", M + "SELECT * FROM (" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {q(c)} IS NULL) AS n_null, "
    f"round(count(*) FILTER (WHERE {q(c)} IS NULL) * 100.0 / count(*), 6) AS pct_null FROM m"
    for c in BRIDGE_COLUMNS) + ") WHERE n_null > 0")
def q_c5(spark, sf_dir):
    """Columns with nulls, count and percentage, worst first."""
    return r6(prof.null_profile(measurements(spark, sf_dir)))


@register("c5_null_total", M + "SELECT " + " + ".join(f"count(*) FILTER (WHERE {q(c)} IS NULL)" for c in BRIDGE_COLUMNS)
          + " AS n_null_cells FROM m")
def q_c5t(spark, sf_dir):
    """Null cells in the whole table."""
    return prof.null_total(measurements(spark, sf_dir))


def _describe_sql(c: str) -> str:
    x = f"CAST({q(c)} AS DOUBLE)"
    return (f"SELECT '{c}' AS \"column\", count({x}) AS count, {r(f'avg({x})')} AS mean, {r(f'stddev_samp({x})')} AS std, "
            f"{r(f'min({x})')} AS min, {r(f'quantile_cont({x}, 0.25)')} AS q25, {r(f'quantile_cont({x}, 0.5)')} AS q50, "
            f"{r(f'quantile_cont({x}, 0.75)')} AS q75, {r(f'max({x})')} AS max FROM m")


@register("c6_describe", M + "\nUNION ALL\n".join(_describe_sql(c) for c in BRIDGE_NUMERIC))
def q_c6(spark, sf_dir):
    """Describe of every numeric column with exact linear quartiles."""
    return r6(prof.describe(measurements(spark, sf_dir)))


@register("c7_non_null_counts", M + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", count({q(c)}) AS non_null FROM m" for c in BRIDGE_COLUMNS))
def q_c7(spark, sf_dir):
    """Non-null count per column."""
    return prof.non_null_counts(measurements(spark, sf_dir))


# ---------------------------------------------------------------------------
# D: scalar functions
# ---------------------------------------------------------------------------

@register("d11_time_features", M + f"SELECT id, {HOUR_SQL} AS hour_of_day, strftime({TS_SQL}, '%a') AS day_of_week FROM m")
def q_d11(spark, sf_dir):
    """Hour of day and short weekday from epoch seconds (UTC)."""
    return ft.engineer_time_features(measurements(spark, sf_dir)).select("id", "hour_of_day", "day_of_week")


@register("d3_weekday_long_date", M + f"SELECT id, strftime({TS_SQL}, '%A') AS day_of_week, "
          f"CAST({TS_SQL} AS DATE) AS date FROM m")
def q_d3(spark, sf_dir):
    """D3 long weekday name, D4 calendar date."""
    return (ft.engineer_time_features(measurements(spark, sf_dir), long_weekday=True, with_date=True)
            .select("id", "day_of_week", "date"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


@register("d11_events_time_features", """
SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour_of_day, strftime(ts, '%a') AS day_of_week, CAST(ts AS DATE) AS date
FROM events
""")
def q_d11e(spark, sf_dir):
    """D2-D4, D11 on a real timestamp column (``events.ts``)."""
    return (ft.engineer_time_features(events(spark, sf_dir), "ts", with_date=True)
            .select("event_id", "hour_of_day", "day_of_week", "date"))


@register("e3_events_hourly_mean", """
SELECT CAST(hour(ts) AS INTEGER) AS hour_of_day, event_type, round(avg(value), 6) AS avg_value FROM events GROUP BY 1, 2
""")
def q_e3e(spark, sf_dir):
    """E3 on the event stream table: mean value by hour of day and event type."""
    ev = ft.engineer_time_features(events(spark, sf_dir), "ts")
    return r6(agg.mean_by(ev, ("hour_of_day", "event_type"), "value", "avg_value"))


@register("e2_events_category_counts", """
SELECT 'event_type' AS "column", event_type AS value, count(*) AS count FROM events GROUP BY 2
UNION ALL
SELECT 'day_of_week', strftime(ts, '%a'), count(*) FROM events GROUP BY 2
""")
def q_e2e(spark, sf_dir):
    """E2 on the event table: event types and weekdays in one pass."""
    ev = ft.engineer_time_features(events(spark, sf_dir), "ts")
    return agg.category_counts(ev, ["event_type", "day_of_week"])


@register("d7_area_hour_key", M + f"SELECT id, area || '_' || lpad(CAST({HOUR_SQL} AS VARCHAR), 2, '0') AS key FROM m")
def q_d7(spark, sf_dir):
    """D2 ``HH`` text and D7 key building ``area_HH``."""
    m = measurements(spark, sf_dir)
    return m.select("id", fs.area_hour_key("area", ft.hour_text(ft.epoch_to_timestamp("timestamp"))).alias("key"))


@register("d5_d6_numeric_text", M + f"""
SELECT id, round(ln(1 + target), 6) AS log_target, round(target, 4) AS target_4dp,
  {java_fmt('PCell_RSRP_max', 2)} AS rsrp_text, {java_fmt('target', 0)} AS target_text,
  'Route ' || id AS label FROM m
""")
def q_d5(spark, sf_dir):
    """D5 log1p, D6 rounding and ``%.2f``/``%.0f`` text, D7 route label."""
    m = measurements(spark, sf_dir)
    return r6(m.select("id", fs.log1p("target").alias("log_target"), fs.round4("target").alias("target_4dp"),
                       fs.fmt2("PCell_RSRP_max").alias("rsrp_text"), fs.fmt0("target").alias("target_text"),
                       fs.route_label("id").alias("label")))


# ---------------------------------------------------------------------------
# E: aggregations and statistics
# ---------------------------------------------------------------------------

CATEGORY_SQL = E + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", CAST({q(c)} AS VARCHAR) AS value, count(*) AS count FROM e GROUP BY 2"
    for c in K.CATEGORY_COLUMNS)


@register("e2_category_counts", CATEGORY_SQL)
def q_e2(spark, sf_dir):
    """Counts of device, operator, area, weekday, has_scell in one pass."""
    return agg.category_counts(engineered(spark, sf_dir, mode_columns=()))


@register("e3_hourly_mean_target", E + "SELECT hour_of_day, operator, round(avg(target), 6) AS avg_target FROM e GROUP BY 1, 2")
def q_e3(spark, sf_dir):
    """Mean target by hour of day and operator."""
    return r6(agg.mean_by(engineered(spark, sf_dir, mode_columns=())))


@register("e4_global_stats", M + "SELECT " + ", ".join(
    f"{r(f'avg({q(c)})')} AS {q(c + '_mean')}, {r(f'min({q(c)})')} AS {q(c + '_min')}, "
    f"{r(f'max({q(c)})')} AS {q(c + '_max')}" for c in ("Latitude", "Longitude", "target")) + " FROM m")
def q_e4(spark, sf_dir):
    """Mean, min, max of position and target."""
    return r6(agg.global_stats(measurements(spark, sf_dir), ["Latitude", "Longitude", "target"]))


@register("e5_variation_flags", M + "SELECT " + ", ".join(
    f"coalesce(min({q(c)}) < max({q(c)}), false) AS {q(c + '_varies')}" for c in BRIDGE_NUMERIC) + " FROM m")
def q_e5(spark, sf_dir):
    """E5: "two or more distinct values" per numeric column."""
    return agg.variation_flags(measurements(spark, sf_dir), BRIDGE_NUMERIC)


def _corr_sql(a: str, b: str, src: str = "m") -> str:
    return (f"(SELECT CASE WHEN isnan(x) THEN NULL ELSE round(x, 6) END FROM "
            f"(SELECT corr({q(a)}, {q(b)}) AS x FROM {src}))")


@register("e6_pearson_predictors", M + "SELECT " + ", ".join(
    f"{_corr_sql(c, 'target')} AS {q('corr_' + c)}" for c in K.SCATTER_PREDICTORS))
def q_e6(spark, sf_dir):
    """Correlation of MCS, SNR, RSRP with the target (null-safe)."""
    m = measurements(spark, sf_dir)
    return r6(m.agg(*[corr.pearson(c, "target").alias(f"corr_{c}") for c in K.SCATTER_PREDICTORS]))


def _matrix_sql(listwise: bool, columns: list[str] = MATRIX_COLUMNS) -> str:
    cols = ", ".join(q(c) for c in columns)
    where = (" WHERE " + " AND ".join(f"{q(c)} IS NOT NULL" for c in columns)) if listwise else ""
    return E + f""", base AS (SELECT row_number() OVER () AS rid, {cols} FROM e{where}),
long AS (UNPIVOT (SELECT rid, {", ".join(f"CAST({q(c)} AS DOUBLE) AS {q(c)}" for c in columns)} FROM base)
         ON {cols} INTO NAME col VALUE val),
pairs AS (SELECT a.col AS col_a, b.col AS col_b, corr(a.val, b.val) AS x
          FROM long a JOIN long b ON a.rid = b.rid GROUP BY 1, 2),
names AS (SELECT unnest([{", ".join(f"'{c}'" for c in columns)}]) AS col)
SELECT na.col AS col_a, nb.col AS col_b, CASE WHEN isnan(p.x) THEN NULL ELSE round(p.x, 6) END AS corr
FROM names na CROSS JOIN names nb LEFT JOIN pairs p ON p.col_a = na.col AND p.col_b = nb.col
"""


@register("e7_corr_matrix_listwise", _matrix_sql(True))
def q_e7(spark, sf_dir):
    """Correlation matrix with listwise deletion."""
    return r6(corr.corr_matrix(engineered(spark, sf_dir), deletion="listwise"))


@register("e8_corr_matrix_pairwise", _matrix_sql(False))
def q_e8(spark, sf_dir):
    """Correlation matrix with pairwise deletion."""
    return r6(corr.corr_matrix(engineered(spark, sf_dir), deletion="pairwise"))


ALL_MATRIX_COLUMNS = [*MATRIX_COLUMNS, *(c for c in BRIDGE_NUMERIC if c in K.CORR_EXCLUDE)]


@register("e8_corr_matrix_all_columns", _matrix_sql(False, ALL_MATRIX_COLUMNS))
def q_e8_all(spark, sf_dir):
    """E8 with nothing excluded: the timestamp stays in."""
    return r6(corr.corr_matrix(engineered(spark, sf_dir), exclude=(), deletion="pairwise"))


def _ranking_sql(listwise: bool, k: int, include_self: bool, direction: str, *columns) -> str:
    base = _matrix_sql(listwise, *columns)
    self_filter = "" if include_self else " AND col_a <> 'target'"
    ranked = (f"SELECT col_a AS \"column\", corr, CAST(row_number() OVER (ORDER BY corr DESC NULLS LAST, col_a) AS INTEGER) "
              f"AS rank, count(*) OVER () AS total FROM final WHERE col_b = 'target'{self_filter}")
    keep = f"rank <= {k}" if direction == "top" else f"rank > total - {k}"
    return base.replace("\nSELECT na.col AS col_a", ", final AS (SELECT na.col AS col_a", 1) + \
        f") SELECT \"column\", corr, rank FROM ({ranked}) WHERE {keep}"


@register("e9_top15_listwise", _ranking_sql(True, 15, True, "top"))
def q_e9a(spark, sf_dir):
    """Top 15 correlations with the target, self included (listwise)."""
    m = corr.corr_matrix(engineered(spark, sf_dir), deletion="listwise")
    return r6(corr.target_ranking(m.withColumn("corr", round6("corr")), k=15))


@register("e9_top15_pairwise_no_self", _ranking_sql(False, 15, False, "top"))
def q_e9b(spark, sf_dir):
    """Top 15 correlations with the target, self dropped (pairwise)."""
    m = corr.corr_matrix(engineered(spark, sf_dir), deletion="pairwise")
    return r6(corr.target_ranking(m.withColumn("corr", round6("corr")), k=15, include_self=False))


@register("e9_bottom5_pairwise", _ranking_sql(False, 5, True, "bottom"))
def q_e9c(spark, sf_dir):
    """The last 5 of the descending ranking, self included (pairwise)."""
    m = corr.corr_matrix(engineered(spark, sf_dir), deletion="pairwise")
    return r6(corr.target_ranking(m.withColumn("corr", round6("corr")), k=5, direction="bottom"))


@register("e9_top11_all_columns", _ranking_sql(False, 11, True, "top", ALL_MATRIX_COLUMNS))
def q_e9d(spark, sf_dir):
    """Top 11 of the matrix of all columns, self included (pairwise)."""
    m = corr.corr_matrix(engineered(spark, sf_dir), exclude=(), deletion="pairwise")
    return r6(corr.target_ranking(m.withColumn("corr", round6("corr")), k=11))


def _hist_sql(expr: str, bins: int, src: str = "m", pre: str = M) -> str:
    return pre + f""", hv AS (SELECT {expr} AS x FROM {src} WHERE {expr} IS NOT NULL AND NOT isnan({expr})),
hst AS (SELECT CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
               CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi FROM hv),
hcnt AS (SELECT CAST(least(floor((x - lo) * {bins} / (hi - lo)), {bins - 1}) AS INTEGER) AS bin, count(*) AS n
         FROM hv, hst GROUP BY 1)
SELECT CAST(b.range AS INTEGER) AS bin, round(lo + b.range * ((hi - lo) / {bins}), 6) AS bin_lo,
       round(lo + (b.range + 1) * ((hi - lo) / {bins}), 6) AS bin_hi, coalesce(hcnt.n, 0) AS count
FROM range({bins}) b CROSS JOIN hst LEFT JOIN hcnt ON hcnt.bin = b.range
"""


@register("e10_hist_target", _hist_sql("target", K.TARGET_BINS))
def q_e10a(spark, sf_dir):
    """50-bin histogram of the target."""
    return r6(dist.histogram(measurements(spark, sf_dir), "target", K.TARGET_BINS))


@register("e10_hist_log_target", _hist_sql("ln(1 + target)", K.TARGET_BINS))
def q_e10b(spark, sf_dir):
    """50-bin histogram of log1p(target)."""
    return r6(dist.histogram(measurements(spark, sf_dir), "target", K.TARGET_BINS, transform="log1p"))


@register("e10_hist_snr", _hist_sql("PCell_SNR_max", K.SIGNAL_BINS))
def q_e10c(spark, sf_dir):
    """40-bin histogram of a signal column (nulls skipped)."""
    return r6(dist.histogram(measurements(spark, sf_dir), "PCell_SNR_max", K.SIGNAL_BINS))


def _multi_hist_sql(cols: list[str], bins: int) -> str:
    parts = []
    for c in cols:
        parts.append(f"""SELECT '{c}' AS "column", CAST(b.range AS INTEGER) AS bin,
  round(lo + b.range * ((hi - lo) / {bins}), 6) AS bin_lo, round(lo + (b.range + 1) * ((hi - lo) / {bins}), 6) AS bin_hi,
  coalesce(cnt.n, 0) AS count
FROM range({bins}) b CROSS JOIN (SELECT CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
    CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi FROM (SELECT {q(c)} AS x FROM m WHERE {q(c)} IS NOT NULL)) st
LEFT JOIN (SELECT CAST(least(floor((x - lo) * {bins} / (hi - lo)), {bins - 1}) AS INTEGER) AS bin, count(*) AS n
    FROM (SELECT {q(c)} AS x FROM m WHERE {q(c)} IS NOT NULL),
         (SELECT CASE WHEN min({q(c)}) = max({q(c)}) THEN min({q(c)}) - 0.5 ELSE min({q(c)}) END AS lo,
                 CASE WHEN min({q(c)}) = max({q(c)}) THEN max({q(c)}) + 0.5 ELSE max({q(c)}) END AS hi FROM m)
    GROUP BY 1) cnt ON cnt.bin = b.range""")
    return M + "\nUNION ALL\n".join(parts)


@register("e10_hist_signal_columns", _multi_hist_sql([c for c in K.SIGNAL_HIST_COLUMNS if c in BRIDGE_COLUMNS],
                                                     K.SIGNAL_BINS))
def q_e10d(spark, sf_dir):
    """40-bin histograms of the signal columns present, one pass for all."""
    return r6(dist.histograms(measurements(spark, sf_dir), K.SIGNAL_HIST_COLUMNS, K.SIGNAL_BINS))


@register("e10_hist_score", _hist_sql("QoS_Score", K.SCORE_BINS, "scored", M + SCORED_CTE))
def q_e10e(spark, sf_dir):
    """30-bin histogram of the fixed-weight QoS score."""
    return r6(dist.histogram(routing.score_fixed(measurements(spark, sf_dir)).scored, K.SCORE_COLUMN, K.SCORE_BINS))


def _kde_sql(expr: str, grid: int = K.KDE_GRID_POINTS, prebins: int = 4096, hist_bins: int = K.TARGET_BINS) -> str:
    return M + f""", v AS (SELECT {expr} AS x FROM m WHERE {expr} IS NOT NULL AND NOT isnan({expr})),
st AS (SELECT count(*) AS n, stddev_samp(x) AS sd, min(x) AS lo, max(x) AS hi FROM v),
k AS (SELECT CAST(g.range AS INTEGER) AS grid_index, lo + g.range * ((hi - lo) / {grid - 1}) AS xg,
             sd * pow(CAST(n AS DOUBLE), -0.2) AS h, n, hi, lo FROM range({grid}) g, st),
s AS (SELECT grid_index, xg, h, n, hi, lo, sum(exp(-0.5 * ((xg - x) / h) * ((xg - x) / h))) AS s FROM k, v GROUP BY ALL)
SELECT grid_index, round(xg, 6) AS x, CAST(round(CAST(s / (n * h * sqrt(2 * pi())) AS DECIMAL(38,18)), 5) AS DOUBLE) AS density,
       CAST(round(CAST(s / (h * sqrt(2 * pi())) * (hi - lo) / {hist_bins} AS DECIMAL(38,18)), 1) AS DOUBLE) AS expected_count FROM s
"""


def _kde(spark, sf_dir, column: str, transform: str | None = None) -> DataFrame:
    """Density to 5 decimals, counts to 1: the oracle sums every row, the operator's error is far below."""
    out = dist.kde(measurements(spark, sf_dir), column, transform=transform)
    return out.select("grid_index", round6("x").alias("x"), F.round("density", 5).alias("density"),
                      F.round("expected_count", 1).alias("expected_count"))


@register("e11_kde_log_target", _kde_sql("ln(1 + target)"))
def q_e11(spark, sf_dir):
    """Gaussian density of log1p(target) on 200 points."""
    return _kde(spark, sf_dir, "target", "log1p")


@register("e11_kde_target", _kde_sql("target"))
def q_e11_target(spark, sf_dir):
    """E11 of the target as it is."""
    return _kde(spark, sf_dir, "target")


@register("e11_kde_rsrp", _kde_sql('"PCell_RSRP_max"'))
def q_e11_rsrp(spark, sf_dir):
    """E11 of a signal column."""
    return _kde(spark, sf_dir, "PCell_RSRP_max")


@register("e11_kde_snr", _kde_sql('"PCell_SNR_max"'))
def q_e11_snr(spark, sf_dir):
    """E11 of a signal column."""
    return _kde(spark, sf_dir, "PCell_SNR_max")


def _box_sql(key_exprs: list[tuple[str, str]], src_pre: str, src: str) -> str:
    """Box statistics per key; ``key_exprs`` are (grouping name, expression)."""
    union = "\nUNION ALL\n".join(
        f"SELECT '{name}' AS grouping, CAST({expr} AS VARCHAR) AS category, CAST(target AS DOUBLE) AS x FROM {src} "
        f"WHERE {expr} IS NOT NULL AND target IS NOT NULL" for name, expr in key_exprs)
    return src_pre + f""", d AS ({union}),
qs AS (SELECT grouping, category, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median,
              quantile_cont(x, 0.75) AS q3 FROM d GROUP BY 1, 2),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo_f, q3 + 1.5 * (q3 - q1) AS hi_f FROM qs)
SELECT d.grouping, d.category, count(*) AS n, round(f.q1, 6) AS q1, round(f.median, 6) AS median, round(f.q3, 6) AS q3,
  round(min(x) FILTER (WHERE x >= lo_f AND x <= hi_f), 6) AS whisker_lo,
  round(max(x) FILTER (WHERE x >= lo_f AND x <= hi_f), 6) AS whisker_hi,
  count(*) FILTER (WHERE x < lo_f OR x > hi_f) AS n_outliers
FROM d JOIN f USING (grouping, category) GROUP BY d.grouping, d.category, f.q1, f.median, f.q3
"""


@register("e12_box_by_category", _box_sql([(c, q(c)) for c in K.BOX_GROUP_COLUMNS], E, "e"))
def q_e12(spark, sf_dir):
    """Box statistics of the target by area, operator and has_scell."""
    return r6(dist.box_stats(engineered(spark, sf_dir), "target", K.BOX_GROUP_COLUMNS))


def _grid_sql(n: int = K.GRID_POINTS_DEFAULT) -> str:
    step = (K.GRID_HIGH - K.GRID_LOW) / (n - 1)

    def w(pos: int) -> str:
        d = f"((range // {n ** (3 - pos)}) % {n})"
        return f"CASE WHEN {d} = {n - 1} THEN {K.GRID_HIGH!r} ELSE CAST({d} AS DOUBLE) * {step!r} + {K.GRID_LOW!r} END"
    raw = f"SELECT range AS candidate_id, {w(0)} AS a1, {w(1)} AS a2, {w(2)} AS a3, {w(3)} AS a4 FROM range({n ** 4})"
    return (f", raw AS ({raw}),\n"
            "cand AS (SELECT candidate_id, CASE WHEN a1 + a2 + a3 + a4 < 1e-6 THEN 0.25 ELSE a1 / (a1 + a2 + a3 + a4) END AS w_signal,"
            " CASE WHEN a1 + a2 + a3 + a4 < 1e-6 THEN 0.25 ELSE a2 / (a1 + a2 + a3 + a4) END AS w_mobility,"
            " CASE WHEN a1 + a2 + a3 + a4 < 1e-6 THEN 0.25 ELSE a3 / (a1 + a2 + a3 + a4) END AS w_env,"
            " CASE WHEN a1 + a2 + a3 + a4 < 1e-6 THEN 0.25 ELSE a4 / (a1 + a2 + a3 + a4) END AS w_congestion FROM raw),\n"
            "ev AS (SELECT candidate_id, w_signal, w_mobility, w_env, w_congestion, "
            "coalesce(CASE WHEN var_samp(s) > 0 AND var_samp(target) > 0 THEN corr(s, target) END, 0.0) AS correlation FROM "
            "(SELECT c.*, comp.target, c.w_signal * comp.SignalScore + c.w_mobility * comp.MobilityScore + "
            "c.w_env * comp.EnvScore - c.w_congestion * comp.CongestionPenalty AS s FROM cand c, comp) "
            "GROUP BY ALL),\n"
            "best AS (SELECT * FROM ev ORDER BY round(correlation, 12) DESC, candidate_id LIMIT 1)")


@register("f1_best_row", M + SCORED_CTE + """
SELECT id, round(SignalScore, 6) AS SignalScore, round(MobilityScore, 6) AS MobilityScore, round(EnvScore, 6) AS EnvScore,
  round(CongestionPenalty, 6) AS CongestionPenalty, round(QoS_Score, 6) AS QoS_Score
FROM scored ORDER BY QoS_Score DESC, id LIMIT 1
""")
def q_f1(spark, sf_dir):
    """F1 / H9: best route under the default weights."""
    res = routing.score_fixed(measurements(spark, sf_dir))
    return r6(res.best.select(*routing.DISPLAY_COLUMNS))


@register("h9_normalised_weights", M + SCORED_CTE + """
SELECT id, round(QoS_Score, 6) AS QoS_Score FROM scored ORDER BY QoS_Score DESC, id LIMIT 10
""")
def q_h9_normalised(spark, sf_dir):
    """H9 with H5 on request: weights given at ten times their size, divided by their sum."""
    weights = {k: 10 * v for k, v in K.DEFAULT_WEIGHTS.items()}
    return r6(routing.score_fixed(measurements(spark, sf_dir), weights, normalise=True).top.select("id", "QoS_Score"))


@register("f2_top10_labelled", M + SCORED_CTE + """
SELECT id, round(SignalScore, 6) AS SignalScore, round(MobilityScore, 6) AS MobilityScore, round(EnvScore, 6) AS EnvScore,
  round(CongestionPenalty, 6) AS CongestionPenalty, round(QoS_Score, 6) AS QoS_Score, 'Route ' || id AS label
FROM scored ORDER BY QoS_Score DESC, id LIMIT 10
""")
def q_f2(spark, sf_dir):
    """top 10 routes over the whole table, labelled."""
    return r6(routing.score_fixed(measurements(spark, sf_dir)).top)


@register("f5_preview_sorted_by_env", M + SCORED_CTE + """
SELECT id, round(SignalScore, 6) AS SignalScore, round(MobilityScore, 6) AS MobilityScore, round(EnvScore, 6) AS EnvScore,
  round(CongestionPenalty, 6) AS CongestionPenalty, round(QoS_Score, 6) AS QoS_Score
FROM scored ORDER BY EnvScore ASC, id LIMIT 1000
""")
def q_f5(spark, sf_dir):
    """the preview re-sorted by a chosen column (EnvScore, ascending)."""
    res = routing.score_fixed(measurements(spark, sf_dir))
    shown = res.scored.select(*routing.DISPLAY_COLUMNS)
    return r6(rank.preview(shown, sort_by="EnvScore", ascending=True))


def _hash52_sql(*parts: str, seed: int = K.SAMPLE_SEED) -> str:
    text = " || '|' || ".join([f"'{seed}'", *(f"CAST({p} AS VARCHAR)" for p in parts)])
    return f"CAST('0x' || substr(md5({text}), 1, 13) AS BIGINT)"


_G1 = f" WHERE {_hash52_sql('id')} < {round(0.05 * (1 << 52))}"
_G1_CAPPED = M + f", c AS (SELECT * FROM m{_G1} ORDER BY {_hash52_sql('id')}, id LIMIT 1000)"


@register("g1_fraction_sample", M + sel(["id", "Latitude", "Longitude", "target"]) + _G1)
def q_g1(spark, sf_dir):
    """G1: 5 % Bernoulli sample by key hash, seed 42."""
    return r6(smp.fraction_sample(measurements(spark, sf_dir), 0.05).select("id", "Latitude", "Longitude", "target"))


@register("g1_capped_sample", _G1_CAPPED + "SELECT id, round(target, 6) AS target FROM c")
def q_g1_capped(spark, sf_dir):
    """G1 with its cap of 1,000 rows (lowest hash first)."""
    return r6(smp.fraction_sample(measurements(spark, sf_dir), 0.05, cap=1000).select("id", "target"))


@register("g2_fixed_size_sample", M + f"SELECT id, round(target, 6) AS target FROM m ORDER BY {_hash52_sql('id')}, id LIMIT 2000")
def q_g2(spark, sf_dir):
    """2,000 rows without replacement, seed 42."""
    return r6(smp.fixed_size_sample(measurements(spark, sf_dir), 2000).select("id", "target"))


@register("h1_min_max_scale", M + SCALED_CTE + "\nSELECT id, " + ", ".join(
    f"round({q(c + '_norm')}, 6) AS {q(c + '_norm')}" for c in K.SCORE_INPUT_COLUMNS) + " FROM sc")
def q_h1(spark, sf_dir):
    """H1: min-max scaling of the six scoring inputs (complete rows)."""
    m = cl.complete_cases(cl.select_present(measurements(spark, sf_dir), K.SCORE_REQUIRED_COLUMNS))
    out = sc.min_max_scale(m)
    return r6(out.select("id", *[f"{c}_norm" for c in K.SCORE_INPUT_COLUMNS]))


@register("h3_component_scores", M + SCALED_CTE + "\nSELECT id, round(SignalScore, 6) AS SignalScore, "
          "round(MobilityScore, 6) AS MobilityScore, round(EnvScore, 6) AS EnvScore, "
          "round(CongestionPenalty, 6) AS CongestionPenalty FROM comp")
def q_h3(spark, sf_dir):
    """H3: the four component scores."""
    featured, _ = routing.prepare_features(measurements(spark, sf_dir))
    return r6(featured.select("id", *K.COMPONENT_COLUMNS))


@register("h4_weighted_score", M + SCORED_CTE + "\nSELECT id, round(QoS_Score, 6) AS QoS_Score FROM scored")
def q_h4(spark, sf_dir):
    """H4: weighted score with the default weights, every row."""
    featured, _ = routing.prepare_features(measurements(spark, sf_dir))
    return r6(sc.weighted_score(featured).select("id", K.SCORE_COLUMN))


@register("h6_grid_search", M + SCALED_CTE + _grid_sql() + """
SELECT candidate_id, round(w_signal, 6) AS w_signal, round(w_mobility, 6) AS w_mobility, round(w_env, 6) AS w_env,
  round(w_congestion, 6) AS w_congestion, round(correlation, 6) AS correlation FROM ev
""")
def q_h6(spark, sf_dir):
    """H6: all 625 grid candidates with their correlation (by moments)."""
    featured, _ = routing.prepare_features(measurements(spark, sf_dir))
    ev = srch.evaluate_candidates(srch.grid_candidates(spark), srch.score_moments(featured))
    return r6(ev)


def _random_sql(n: int = K.RANDOM_ITER_DEFAULT) -> str:
    """The grid's evaluation with seeded random candidates instead."""
    draw = lambda k: f"{_hash52_sql('range', str(k))} / 4503599627370496.0"
    raw = ", ".join(f"{draw(k)} AS r{k}" for k in range(4))
    names = list(K.WEIGHT_NAMES)
    norm = ", ".join(f"r{k} / (r0 + r1 + r2 + r3) AS {w}" for k, w in enumerate(names))
    return f""", raw AS (SELECT CAST(range AS BIGINT) AS candidate_id, {raw} FROM range({n})),
rcand AS (SELECT candidate_id, {norm} FROM raw),
rev AS (SELECT candidate_id, {", ".join(names)}, coalesce(corr(w_signal * SignalScore + w_mobility * MobilityScore
          + w_env * EnvScore - w_congestion * CongestionPenalty, target), 0.0) AS correlation
        FROM rcand, comp GROUP BY ALL),
rbest AS (SELECT * FROM rev ORDER BY round(correlation, 12) DESC, candidate_id LIMIT 1)
"""


@register("h7_random_search", M + SCALED_CTE + _random_sql() + "SELECT candidate_id, " + ", ".join(
    f"round({w}, 6) AS {w}" for w in K.WEIGHT_NAMES) + ", round(correlation, 6) AS correlation FROM rev")
def q_h7(spark, sf_dir):
    """H7: 100 seeded random candidates with their correlation."""
    featured, _ = routing.prepare_features(measurements(spark, sf_dir))
    out = srch.evaluate_candidates(srch.random_candidates(spark), srch.score_moments(featured))
    return r6(out.select("candidate_id", *K.WEIGHT_NAMES, "correlation"))


@register("h10_random_best_route", M + SCALED_CTE + _random_sql() + """
SELECT id, round(w_signal * SignalScore + w_mobility * MobilityScore + w_env * EnvScore - w_congestion * CongestionPenalty, 6) AS QoS_Score
FROM comp, rbest ORDER BY w_signal * SignalScore + w_mobility * MobilityScore + w_env * EnvScore - w_congestion * CongestionPenalty DESC, id LIMIT 1
""")
def q_h10_random(spark, sf_dir):
    """The whole pipeline with random search."""
    return r6(routing.score_searched(measurements(spark, sf_dir), "random_search").best.select("id", "QoS_Score"))


@register("h8_search_history", M + SCALED_CTE + _grid_sql() + """
SELECT candidate_id, round(correlation, 6) AS correlation,
  round(max(correlation) OVER (ORDER BY candidate_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS best_so_far
FROM ev
""")
def q_h8(spark, sf_dir):
    """H8: search history with the best correlation so far."""
    res = routing.score_searched(measurements(spark, sf_dir), "grid_search")
    return r6(res.history.select("candidate_id", "correlation", "best_so_far"))


@register("h10_searched_best_route", M + SCALED_CTE + _grid_sql() + """
, s2 AS (SELECT comp.*, best.w_signal * SignalScore + best.w_mobility * MobilityScore + best.w_env * EnvScore
                - best.w_congestion * CongestionPenalty AS QoS_Score FROM comp, best)
SELECT id, round(SignalScore, 6) AS SignalScore, round(MobilityScore, 6) AS MobilityScore, round(EnvScore, 6) AS EnvScore,
  round(CongestionPenalty, 6) AS CongestionPenalty, round(QoS_Score, 6) AS QoS_Score
FROM s2 ORDER BY QoS_Score DESC, id LIMIT 1
""")
def q_h10(spark, sf_dir):
    """Best route under the grid-searched weights."""
    res = routing.score_searched(measurements(spark, sf_dir), "grid_search")
    return r6(res.best.select(*routing.DISPLAY_COLUMNS))


@register("h10_searched_weights", M + SCALED_CTE + _grid_sql() + """
SELECT candidate_id, round(w_signal, 6) AS w_signal, round(w_mobility, 6) AS w_mobility, round(w_env, 6) AS w_env,
  round(w_congestion, 6) AS w_congestion, round(correlation, 6) AS correlation FROM best
""")
def q_h10w(spark, sf_dir):
    """The chosen weights and their correlation."""
    return r6(routing.score_searched(measurements(spark, sf_dir), "grid_search").weights)


@register("e13_weight_shares", M + SCALED_CTE + _grid_sql() + """
SELECT weight, round(share_pct, 6) AS share_pct FROM (
  SELECT 'w_signal' AS weight, w_signal * 100.0 / (w_signal + w_mobility + w_env + w_congestion) AS share_pct FROM best
  UNION ALL SELECT 'w_mobility', w_mobility * 100.0 / (w_signal + w_mobility + w_env + w_congestion) FROM best
  UNION ALL SELECT 'w_env', w_env * 100.0 / (w_signal + w_mobility + w_env + w_congestion) FROM best
  UNION ALL SELECT 'w_congestion', w_congestion * 100.0 / (w_signal + w_mobility + w_env + w_congestion) FROM best)
""")
def q_e13(spark, sf_dir):
    """Percentage share of each searched weight (pie data)."""
    return r6(agg.weight_shares(routing.score_searched(measurements(spark, sf_dir), "grid_search").weights))


@register("h11_step_counts", M + "SELECT count(*) AS rows_loaded, count(*) FILTER (WHERE " + " AND ".join(
    f"{q(c)} IS NOT NULL" for c in K.SCORE_REQUIRED_COLUMNS) + ") AS rows_valid FROM m")
def q_h11(spark, sf_dir):
    """Rows loaded and rows valid after cleaning, as the pipeline's counters observe them."""
    featured, counters = routing.prepare_features(measurements(spark, sf_dir), count_steps=True)
    featured.write.format("noop").mode("overwrite").save()
    return literal_rows(spark, [(counters["rows_loaded"].get["rows"], counters["rows_valid"].get["rows"])],
                                 "rows_loaded bigint, rows_valid bigint")


# ---------------------------------------------------------------------------
# I: map and scatter data
# ---------------------------------------------------------------------------

@register("i1_map_points", M + f"""
, st AS (SELECT min(ln(1 + target)) AS lo, max(ln(1 + target)) AS hi FROM m),
n AS (SELECT m.*, (ln(1 + target) - lo) / (hi - lo + 1e-6) AS norm FROM m, st)
SELECT round(Latitude, 6) AS lat, round(Longitude, 6) AS lon, round(target, 6) AS target,
  CASE WHEN target IS NULL THEN 'gray' WHEN norm < 0.33 THEN 'red' WHEN norm < 0.66 THEN 'orange' ELSE 'green' END AS color,
  'Target: ' || {java_fmt('target', 0)} || '<br>Operator: ' || CAST(operator AS VARCHAR) AS popup
FROM n
""")
def q_i1(spark, sf_dir):
    """I1 + D8: every point with its colour band and popup text."""
    return r6(geo.map_points(measurements(spark, sf_dir)))


@register("i2_map_centre", M + "SELECT round(avg(Latitude), 6) AS centre_lat, round(avg(Longitude), 6) AS centre_lon FROM m")
def q_i2(spark, sf_dir):
    """Map centre over all rows."""
    return r6(geo.map_centre(measurements(spark, sf_dir)))


@register("i1_sampled_map", _G1_CAPPED + """, st AS (SELECT min(ln(1 + target)) AS lo, max(ln(1 + target)) AS hi FROM c),
n AS (SELECT c.*, (ln(1 + target) - lo) / (hi - lo + 1e-6) AS norm FROM c, st)
SELECT round(Latitude, 6) AS lat, round(Longitude, 6) AS lon, round(target, 6) AS target,
  CASE WHEN target IS NULL THEN 'gray' WHEN norm < 0.33 THEN 'red' WHEN norm < 0.66 THEN 'orange' ELSE 'green' END AS color,
  (SELECT round(avg(Latitude), 6) FROM c) AS centre_lat, (SELECT round(avg(Longitude), 6) FROM c) AS centre_lon
FROM n
""")
def q_i1_sampled(spark, sf_dir):
    """G1 with its cap, feeding I1 and I2: the map's points and its centre."""
    points = smp.fraction_sample(measurements(spark, sf_dir), 0.05, cap=1000)
    centre = geo.map_centre(points).first()
    return r6(geo.map_points(points).select("lat", "lon", "target", "color", F.lit(centre["centre_lat"]).alias("centre_lat"),
                                            F.lit(centre["centre_lon"]).alias("centre_lon")))


@register("i3_scatter_points", M + "\nUNION ALL\n".join(
    f"SELECT '{p}' AS predictor, round({q(p)}, 6) AS value, round(target, 6) AS target, CAST(operator AS VARCHAR) AS operator, "
    f"target > 0 AS log_scale_ok FROM m" for p in K.SCATTER_PREDICTORS))
def q_i3(spark, sf_dir):
    """Scatter dataset of three predictors against the target."""
    return r6(geo.scatter_points(measurements(spark, sf_dir)))


@register("i4_route_profile", M + SCORED_CTE + """
, b AS (SELECT * FROM scored ORDER BY QoS_Score DESC, id LIMIT 1)
SELECT id, component, round(value, 6) AS value FROM (
  SELECT id, 'SignalScore' AS component, SignalScore AS value FROM b
  UNION ALL SELECT id, 'MobilityScore', MobilityScore FROM b
  UNION ALL SELECT id, 'EnvScore', EnvScore FROM b
  UNION ALL SELECT id, 'CongestionPenalty', CongestionPenalty FROM b)
""")
def q_i4(spark, sf_dir):
    """I4: component profile of the best route."""
    return r6(geo.route_profile(routing.score_fixed(measurements(spark, sf_dir)).best))
