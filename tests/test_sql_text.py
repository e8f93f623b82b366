"""The library from SQL text against the DataFrame functions."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cellscope import constants as K
from cellscope.functions import scalar as fs
from cellscope.functions import time as ft
from cellscope.operators.aggregate import area_hour_averages
from cellscope.operators.rank import top_k
from cellscope.plans import routing
from cellscope.queries import measurements
from cellscope.sql import SCALARS, TABLES, install


def close(a, b) -> bool:
    return a == b or (isinstance(a, float) and isinstance(b, float) and abs(a - b) < 1e-9)


def same(one, two) -> None:
    one, two = (sorted(map(tuple, df.collect()), key=str) for df in (one, two))
    assert len(one) == len(two) and all(close(x, y) for r, s in zip(one, two) for x, y in zip(r, s))


def test_scalars(spark, sf_small):
    m = measurements(spark, sf_small).select(F.col("timestamp").cast("double").alias("e"), "area", F.col("target").alias("x"), F.col("id").cast("string").alias("id"))
    m = m.unionByName(spark.createDataFrame([(None, None, float("nan"), None), (0.0, "a", None, "")], "e double, area string, x double, id string"))
    assert len(install(spark, m, "cs_", ranges=False)) == len(SCALARS)  # none of the views has its columns
    m.createOrReplaceTempView("some")
    ts = ft.epoch_to_timestamp("e")
    lo, hi = F.lit(0.5), F.lit(4.0)
    for call, want in (("cs_epoch_to_timestamp(e)", ts), ("cs_hour_of_day(cs_epoch_to_timestamp(e))", ft.hour_of_day(ts)),
                       ("cs_hour_text(cs_epoch_to_timestamp(e))", ft.hour_text(ts)), ("cs_weekday_short(cs_epoch_to_timestamp(e))", ft.weekday_short(ts)),
                       ("cs_weekday_long(cs_epoch_to_timestamp(e))", ft.weekday_long(ts)), ("cs_calendar_date(cs_epoch_to_timestamp(e))", ft.calendar_date(ts)),
                       ("cs_round4(x)", fs.round4("x")), ("cs_fmt2(x)", fs.fmt2("x")), ("cs_fmt0(x)", fs.fmt0("x")), ("cs_nan_to_null(x)", fs.nan_to_null("x")),
                       ("cs_area_hour_key(area, '07')", fs.area_hour_key("area", F.lit("07"))), ("cs_route_label(id)", fs.route_label("id")),
                       ("cs_color_band(x, 0.5D, 4.0D)", fs.color_band("x", lo, hi)), ("cs_color_band(x, 1D, 1D, 0D)", fs.color_band("x", F.lit(1.0), F.lit(1.0), 0))):
        both = spark.table("some").select(F.expr(call).alias("got"), want.alias("want"))
        assert both.where("NOT (got <=> want)").count() == 0, call


def test_views(spark, sf_small):
    m = measurements(spark, sf_small)
    assert set(install(spark, m, "t_")) == {"t_" + n for n in (*SCALARS, *TABLES)}
    same(spark.sql("SELECT * FROM t_area_hour()"), area_hour_averages(m, order=False))
    span = m.where("timestamp >= 1610000000 AND timestamp < 1615000000")
    same(spark.sql("SELECT * FROM t_area_hour(1610000000, until => 1615000000)"), area_hour_averages(span, order=False))
    area = m.select("area").first()[0]
    same(spark.sql(f"SELECT * FROM t_area_hour(only_area => '{area}')"), area_hour_averages(m.where(F.col("area") == area), order=False))
    hour = ft.hour_of_day(ft.epoch_to_timestamp("timestamp")).alias("hour")
    same(spark.sql("SELECT * FROM t_hourly_target(until => 1615000000)"),
         m.where("timestamp < 1615000000").groupBy(hour, F.col("operator").cast("string")).agg(F.avg("target"), F.count("target")))
    fixed = routing.score_fixed(m)
    same(spark.sql("SELECT * FROM t_weighted_scores()"), fixed.shown)
    w = dict(zip(K.WEIGHT_NAMES, (0.7, 0.1, 0.1, 0.1)))
    same(spark.sql("SELECT * FROM t_weighted_scores(0.7D, 0.1D, 0.1D, 0.1D)"), routing.score_fixed(m, w).shown)
    best = top_k(fixed.shown, 7).collect()
    got = spark.sql("SELECT * FROM t_top_routes(7) ORDER BY place").collect()
    assert [r["route"] for r in got] == [f"Route {r['id']}" for r in best] and [r["place"] for r in got] == list(range(1, 8))


def test_plans(spark, sf_small):
    """Literal arguments reach the scan as filters; the best routes are cut in each task first."""
    m = measurements(spark, sf_small)
    install(spark, m, "t_")
    explain = lambda q: spark._jvm.PythonSQLUtils.explainString(spark.sql(q)._jdf.queryExecution(), "formatted")
    assert "until" not in explain("SELECT * FROM t_area_hour(since => 1610000000)")
    top = explain("SELECT * FROM t_top_routes(7)")
    assert "TakeOrderedAndProject" in top or "WindowGroupLimit" in top, top
    assert "Python" not in explain("SELECT * FROM t_weighted_scores()")


def test_empty_and_partial_tables(spark, sf_small):
    m = measurements(spark, sf_small)
    install(spark, m.where("target < -1e300"), "t_")
    for call in ("t_area_hour()", "t_hourly_target()", "t_weighted_scores()", "t_top_routes()"):
        assert spark.sql(f"SELECT * FROM {call}").collect() == []
    names = install(spark, m.drop("humidity"), "u_")
    assert "u_area_hour" not in names and "u_hourly_target" in names
    # A second call puts new definitions in the place of the old ones.
    install(spark, m.where("area = 'none'"), "u_", ranges=False)
    with pytest.raises(Exception, match="(?i)resolve|not found|no such"):
        spark.sql("SELECT * FROM v_hourly_target()").collect()
    assert spark.sql("SELECT * FROM u_hourly_target()").collect() == []
