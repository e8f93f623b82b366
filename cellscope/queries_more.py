"""Queries of operations beyond the measurement programs: ordered and nearness joins, running aggregates, levels,
multisets, event-time windows, JSON texts, and the library from SQL text.

Each reads ``events``, ``orders`` or the measurements whole and has a DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellscope.functions.time import epoch_to_timestamp, hour_of_day
from cellscope.functions import json_text
from cellscope.operators import grouping, near, ranges
from cellscope.queries import HOUR_SQL, M, SCALED_CTE, measurements, r6, register
from cellscope.session import scratch_path
from cellscope.sql import install
from cellscope.streaming.windows import EventWindows


def stored(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register("k1_asof_join", """
WITH p AS (SELECT * FROM events WHERE event_type = 'purchase'),
v AS (SELECT user_id, ts, max(struct_pack(a := value, b := event_id)) AS last FROM events WHERE event_type = 'view' GROUP BY 1, 2)
SELECT p.event_id, p.user_id, round(v.last.a, 6) AS view_value, v.last.b AS view_id
FROM p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.ts >= v.ts
""")
def q_asof(spark, sf_dir):
    """As-of join: each purchase with its user's latest view up to then."""
    e = stored(spark, sf_dir, "events")
    found = ranges.asof_join(e.where("event_type = 'purchase'").select("event_id", "user_id", "ts"), e.where("event_type = 'view'"), ["user_id"], "ts", "ts",
                             {"view_value": "value", "view_id": "event_id"})
    return r6(found.select("event_id", "user_id", "view_value", "view_id"))


@register("k1_asof_join_within", """
WITH e AS (SELECT ts, max(struct_pack(a := event_id)) AS last FROM events WHERE event_type = 'error' GROUP BY 1)
SELECT c.event_id, CASE WHEN e.ts >= c.ts - INTERVAL 10 MINUTE THEN e.last.a END AS error_id
FROM (SELECT * FROM events WHERE event_type = 'click') c ASOF LEFT JOIN e ON c.ts > e.ts
""")
def q_asof_within(spark, sf_dir):
    """As-of join without a key: each click with the latest error before it, if at most ten minutes old."""
    e = stored(spark, sf_dir, "events")
    found = ranges.asof_join(e.where("event_type = 'click'").select("event_id", "ts"), e.where("event_type = 'error'"), [], "ts", "ts",
                             {"error_id": "event_id"}, before=True, within=F.expr("INTERVAL 10 MINUTES"))
    return found.select("event_id", "error_id")


@register("k2_interval_join", """
WITH i AS (SELECT event_id AS error_id, epoch_us(ts) / 1e6 AS lo, epoch_us(ts) / 1e6 + value * 60 AS hi FROM events WHERE event_type = 'error')
SELECT error_id, count(*) AS n_events, round(sum(value), 6) AS total FROM i JOIN events e ON epoch_us(e.ts) / 1e6 >= lo AND epoch_us(e.ts) / 1e6 < hi GROUP BY 1
""")
def q_interval(spark, sf_dir):
    """Interval join: the events in the minutes after each error (as many as its value says)."""
    e = stored(spark, sf_dir, "events")
    at = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    spans = e.where("event_type = 'error'").select(F.col("event_id").alias("error_id"), at.alias("lo"), (at + F.col("value") * 60).alias("hi"))
    met = near.interval_join(e.select(at.alias("at"), "value"), spans, "at", "lo", "hi", totals={"n_events": ("count", "*"), "total": ("sum", "value")})
    return r6(met.groupBy("error_id").agg(F.sum("n_events").alias("n_events"), F.sum("total").alias("total")))


@register("k2_interval_join_by_key", """
WITH i AS (SELECT o_orderkey AS open_key, o_custkey, o_orderdate AS lo, max(l_shipdate) AS hi FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL)
SELECT o.o_orderkey, o.o_custkey, i.open_key FROM orders o LEFT JOIN i ON o.o_custkey = i.o_custkey AND o.o_orderdate >= i.lo AND o.o_orderdate <= i.hi
""")
def q_interval_key(spark, sf_dir):
    """Interval join by key: the customer's orders that were open (placed, not all shipped) when each order came in."""
    o, line = stored(spark, sf_dir, "orders"), stored(spark, sf_dir, "lineitem")
    spans = o.join(line, F.col("l_orderkey") == F.col("o_orderkey")).groupBy(F.col("o_orderkey").alias("open_key"), "o_custkey", F.col("o_orderdate").alias("lo")).agg(
        F.max("l_shipdate").alias("hi"))
    met = near.interval_join(o.select("o_orderkey", "o_custkey", "o_orderdate"), spans, "o_orderdate", "lo", "hi", on=["o_custkey"], closed=True, how="left")
    return met.select("o_orderkey", "o_custkey", "open_key")


@register("k3_band_join", """
SELECT a.o_orderkey, b.o_orderkey AS other_key, round(abs(a.o_totalprice - b.o_totalprice), 6) AS gap FROM orders a JOIN orders b
ON a.o_orderkey < b.o_orderkey AND abs(a.o_totalprice - b.o_totalprice) <= 250 AND abs(epoch_us(a.o_orderdate) - epoch_us(b.o_orderdate)) <= 86400000000
""")
def q_band(spark, sf_dir):
    """Band join on two numbers: pairs of orders at most a day and 250 apart."""
    o = stored(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    met = near.band_join(o, o, ("o_totalprice", "o_orderdate"), ("o_totalprice", "o_orderdate"), (250.0, 86400.0), distinct_by="o_orderkey")
    return r6(met.select("o_orderkey", F.col("near_o_orderkey").alias("other_key"), F.abs(F.col("o_totalprice") - F.col("near_o_totalprice")).alias("gap")))


@register("k4_running_totals", """
SELECT o_orderkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) OVER w AS DOUBLE) AS total, max(o_totalprice) OVER w AS best_so_far, count(*) OVER w AS place
FROM orders WINDOW w AS (ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING)
""")
def q_running(spark, sf_dir):
    """Running aggregates over the whole table: revenue to date, the best order so far, its place."""
    o = stored(spark, sf_dir, "orders").withColumn("cents", F.col("o_totalprice").cast("decimal(18, 2)"))
    found = ranges.running(o, ["o_orderdate", "o_orderkey"], {"total": ("sum", "cents"), "best_so_far": ("max", "o_totalprice")}, number="place")
    return found.select("o_orderkey", F.col("total").cast("double").alias("total"), "best_so_far", "place")


@register("k4_running_by_key", """
SELECT event_id, round(min(value) OVER w, 6) AS least, count(*) OVER w AS place
FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)
""")
def q_running_key(spark, sf_dir):
    """Running aggregates of a few hot keys: the least value so far of each event type."""
    e = stored(spark, sf_dir, "events")
    return r6(ranges.running(e, ["ts", "event_id"], {"least": ("min", "value")}, ["event_type"], number="place").select("event_id", "least", "place"))


@register("k5_cube", M + f"""
SELECT area, hour, operator, 4 * grouping(area) + 2 * grouping(hour) + grouping(operator) AS level, count(*) AS n, count(target) AS n_target,
       round(avg(target), 6) AS mean_target, round(max("PCell_RSRP_max"), 6) AS best_rsrp
FROM (SELECT *, {HOUR_SQL} AS hour FROM m) GROUP BY CUBE (area, hour, operator)
""")
def q_cube(spark, sf_dir):
    """Cube of area, hour and operator over E1 to E3's figures."""
    m = measurements(spark, sf_dir).withColumn("hour", hour_of_day(epoch_to_timestamp("timestamp")))
    dims = ["area", "hour", "operator"]
    return r6(grouping.grouping_sets(m, dims, grouping.cube_sets(dims), {"n": ("count", "*"), "n_target": ("count", "target"), "mean_target": ("avg", "target"),
                                                                         "best_rsrp": ("max", "PCell_RSRP_max")}))


@register("k5_rollup_events", """
SELECT event_type, day, grouping(event_type) * 2 + grouping(day) AS level, count(*) AS n, round(sum(value), 6) AS total
FROM (SELECT *, CAST(ts AS DATE) AS day FROM events) GROUP BY ROLLUP (event_type, day)
""")
def q_rollup(spark, sf_dir):
    """Rollup of events by type and day."""
    e = stored(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    return r6(grouping.grouping_sets(e, ["event_type", "day"], grouping.rollup_sets(["event_type", "day"]), {"n": ("count", "*"), "total": ("sum", "value")}))


_DISTINCT = " UNION ALL ".join(f"""
SELECT event_type, year, level, '{c}' AS "column", count(*) AS n_distinct, {total} AS sum_distinct, CAST(sum(n) AS BIGINT) AS n_rows, round(max(n) / sum(n), 6) AS top_share
FROM (SELECT event_type, year, grouping(event_type) * 2 + grouping(year) AS level, {c}, count(*) AS n FROM e WHERE {c} IS NOT NULL
      GROUP BY GROUPING SETS ((event_type, year, {c}), (event_type, {c}), ({c}))) GROUP BY 1, 2, 3""" for c, total in (
    ("user_id", "CAST(sum(user_id) AS DOUBLE)"), ("value", "round(sum(value), 6)"), ("props", "CAST(NULL AS DOUBLE)")))


@register("k6_distinct_levels", "WITH e AS (SELECT *, year(ts) AS year FROM events)" + _DISTINCT)
def q_distinct(spark, sf_dir):
    """Distinct aggregates of three columns at three levels."""
    e = stored(spark, sf_dir, "events").withColumn("year", F.year("ts"))
    return r6(grouping.distinct_aggregates(e, ["event_type", "year"], grouping.rollup_sets(["event_type", "year"]), ["user_id", "value", "props"]))


_HALVES = "one AS (SELECT user_id, event_type FROM events WHERE event_id % 2 = 0), two AS (SELECT user_id, event_type FROM events WHERE event_id % 2 = 1)"


def _halves(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    e = stored(spark, sf_dir, "events")
    return [e.where(F.col("event_id") % 2 == i).select("user_id", "event_type") for i in (0, 1)]


@register("k7_multiset_difference", f"WITH {_HALVES} SELECT * FROM one EXCEPT ALL SELECT * FROM two")
def q_difference(spark, sf_dir):
    """Multiset difference of two snapshots: users' actions in even events beyond those in odd ones."""
    return grouping.multiset_difference(*_halves(spark, sf_dir))


@register("k7_multiset_intersection", f"WITH {_HALVES} SELECT * FROM one INTERSECT ALL SELECT * FROM two")
def q_intersection(spark, sf_dir):
    """Multiset intersection of the same snapshots."""
    return grouping.multiset_intersection(*_halves(spark, sf_dir))


_EARLY = "ts < TIMESTAMP '2024-01-20' AND event_id % 10 <> 0"


@register("k8_event_windows", f"""
WITH e AS (SELECT *, {_EARLY} AS early, CAST(floor(epoch_us(ts) / 7200000000) AS BIGINT) AS slot FROM events),
w AS (SELECT *, (slot - back) * 7200000000 AS begins FROM e, (SELECT unnest([0, 1, 2]) AS back)),
mark AS (SELECT max(epoch_us(ts)) - 3600000000 AS reached FROM e WHERE early)
SELECT make_timestamp(begins) AS window_start, event_type, count(*) AS n, round(sum(value), 6) AS total, round(min(value), 6) AS least,
       round(max(value), 6) AS most, CAST(count(*) FILTER (NOT early AND begins + 21600000000 <= reached) AS BIGINT) AS n_late
FROM w, mark GROUP BY 1, 2
""")
def q_windows(spark, sf_dir):
    """Event-time windows of six hours every two, as a stream: a tenth of the early events comes days late, with the later ones."""
    e, base = stored(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value"), scratch_path(spark, "event-windows")
    windows = EventWindows(spark, f"{base}/out", "ts", ["event_type"], "value", 6 * 3600, 2 * 3600, delay=3600)
    for lot, rows in (("early", e.where(_EARLY)), ("late", e.where(f"NOT ({_EARLY})"))):
        rows.write.parquet(f"{base}/in/{lot}")
        windows.start(spark.readStream.schema(e.schema).parquet(f"{base}/in/*"), f"{base}/checkpoint").awaitTermination()
    return r6(windows.result(with_open=True).drop("n_value", "mean").withColumn("window_start", F.col("window_start").cast("timestamp_ntz")))


_RECORDS = """WITH j AS (SELECT event_id, json_merge_patch(props, to_json({'type': event_type, 'value': value, 'big': value >= 50})) AS record FROM events)"""


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event's properties and columns as one JSON text."""
    e = stored(spark, sf_dir, "events")
    own = F.struct(F.col("event_type").alias("type"), "value", (F.col("value") >= 50).alias("big"))
    inner = F.regexp_replace("props", r"^\{|\}$", "")
    return e.select("event_id", F.concat(F.lit("{"), inner, F.when(inner != "", ", ").otherwise(""), F.substr(F.to_json(own), F.lit(2))).alias("record"))


@register("k9_json_keys", _RECORDS + """,
v AS (SELECT unnest(json_keys(record)) AS key, record FROM j),
t AS (SELECT key, json_type(json_extract(record, '$.' || key)) AS kind, json_extract_string(record, '$.' || key) AS x FROM v)
SELECT key, count(*) AS n, CASE WHEN bool_and(kind IN ('UBIGINT', 'BIGINT')) THEN
  CASE WHEN min(TRY_CAST(x AS BIGINT)) >= -128 AND max(TRY_CAST(x AS BIGINT)) < 128 THEN 'tinyint' ELSE 'smallint' END
  WHEN bool_and(kind IN ('UBIGINT', 'BIGINT', 'DOUBLE')) THEN 'double' WHEN bool_and(kind = 'BOOLEAN') THEN 'boolean' ELSE 'string' END AS type
FROM t GROUP BY 1
""")
def q_json_keys(spark, sf_dir):
    """Keys of JSON texts with the narrowest type that holds all their values."""
    return json_text.json_keys(_records(spark, sf_dir), "record").select("key", "n", "type")


@register("k9_json_typed", _RECORDS + """
SELECT event_id, CAST(json_extract(record, '$.big') AS BOOLEAN) AS big, CAST(json_extract(record, '$.k') AS BIGINT) AS k,
       json_extract_string(record, '$.type') AS "type", round(CAST(json_extract(record, '$.value') AS DOUBLE), 6) AS value FROM j
""")
def q_json_typed(spark, sf_dir):
    """The same texts as typed columns."""
    typed = json_text.typed_json(_records(spark, sf_dir), "record").drop("record")
    return r6(typed.withColumn("k", F.col("k").cast("bigint")))


@register("k9_json_figures", """
SELECT event_type, 'k' AS key, count(*) AS n, round(sum(x), 6) AS total, round(avg(x), 6) AS mean, round(min(x), 6) AS least, round(max(x), 6) AS most
FROM (SELECT event_type, CAST(json_extract(props, '$.k') AS DOUBLE) AS x FROM events) GROUP BY 1
""")
def q_json_figures(spark, sf_dir):
    """Figures of the properties' numbers by event type."""
    return r6(json_text.json_figures(stored(spark, sf_dir, "events"), "props", ["event_type"]).drop("n_number"))


def _installed(spark: SparkSession, sf_dir: str, **kw) -> SparkSession:
    install(spark, measurements(spark, sf_dir), **kw)
    return spark


@register("k10_sql_area_hour", M + f"""
SELECT concat(area, '_', lpad(CAST(hour AS VARCHAR), 2, '0')) AS area_hour, round(avg_rsrp, 6) AS avg_rsrp, round(avg_jam, 6) AS avg_jam, n FROM (
SELECT area, {HOUR_SQL} AS hour, avg(PCell_RSRP_max) AS avg_rsrp, avg("Traffic Jam Factor") AS avg_jam, count(*) AS n FROM m
WHERE "timestamp" IS NOT NULL AND PCell_RSRP_max IS NOT NULL AND PCell_SNR_max IS NOT NULL AND speed_kmh IS NOT NULL AND "Traffic Jam Factor" IS NOT NULL
  AND humidity IS NOT NULL AND precipProbability IS NOT NULL AND "timestamp" >= 1610000000 GROUP BY 1, 2)
""")
def q_sql_area_hour(spark, sf_dir):
    """E1 from SQL text: the view with a parameter, and a scalar function over it."""
    return r6(_installed(spark, sf_dir, ranges=False).sql(
        "SELECT cs_area_hour_key(area, lpad(hour, 2, '0')) AS area_hour, avg_rsrp, avg_jam, n FROM cs_area_hour(since => 1610000000)"))


@register("k10_sql_weighted_scores", M + SCALED_CTE + """
SELECT id, round(EnvScore, 6) AS EnvScore, round(0.1 * SignalScore + 0.2 * MobilityScore + 0.6 * EnvScore - 0.3 * CongestionPenalty, 6) AS QoS_Score FROM comp
""")
def q_sql_scores(spark, sf_dir):
    """H4 from SQL text, with two weights given and two by default."""
    return r6(_installed(spark, sf_dir).sql("SELECT id, EnvScore, QoS_Score FROM cs_weighted_scores(w_signal => 0.1D, w_env => 0.6D)"))


@register("k10_sql_top_routes", M + SCALED_CTE + """, s AS (SELECT id, 0.25 * SignalScore + 0.25 * MobilityScore + 0.25 * EnvScore - 0.25 * CongestionPenalty AS score FROM comp)
SELECT CAST(row_number() OVER (ORDER BY score DESC, id) AS INTEGER) AS place, 'Route ' || id AS route, round(score, 6) AS score FROM s ORDER BY score DESC, id LIMIT 25
""")
def q_sql_top(spark, sf_dir):
    """F2 from SQL text: the best 25 under equal weights."""
    return r6(_installed(spark, sf_dir).sql("SELECT place, route, QoS_Score AS score FROM cs_top_routes(25, 0.25D, 0.25D, 0.25D, 0.25D)"))
