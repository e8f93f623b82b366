"""Hand-made edge cases (FIXTURES.md section 5)."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from cellscope import constants as K
from cellscope.functions.scalar import color_band, fmt2
from cellscope.operators import aggregate as agg
from cellscope.operators import clean as cl
from cellscope.operators import correlation as corr
from cellscope.operators import distribution as dist
from cellscope.operators import geo
from cellscope.operators import rank
from cellscope.operators import scale as sc
from cellscope.operators import search as srch
from cellscope.operators.quantile import exact_quantiles
from cellscope.plans import routing
from cellscope.sources import text as text_src
from tests.helpers import line, rows


def _lines(spark, *ls):
    return spark.createDataFrame([(x,) for x in ls], "value string")


def test_text_source_malformed_blank_header(spark):
    df = _lines(spark, ",".join(K.MEASUREMENT_COLUMNS), "",
                line(id="good1"), line(id="bad", PCell_SNR_max="abc"), line(id="good2", area="Avenue"),
                ",".join(K.MEASUREMENT_COLUMNS), "   ")
    got = text_src.parse_measurement_lines(df).collect()
    assert sorted(r.area for r in got) == ["Avenue", "Park"]
    out = agg.area_hour_averages(text_src.parse_measurement_lines(df)).collect()
    assert sorted((r.area, r.n) for r in out) == [("Avenue", 1), ("Park", 1)]
    assert all(r.avg_snr == 1.5 for r in out)  # no partial sums of the rejected row


def test_text_source_empty_area(spark):
    both_empty = line(area="", target="")
    area_empty = line(area="", target="7")
    got = text_src.parse_measurement_lines(_lines(spark, both_empty, area_empty)).collect()
    assert [r.area for r in got] == [""]


def test_text_source_bad_timestamp(spark):
    got = text_src.parse_measurement_lines(_lines(spark, line(timestamp="12x"), line(timestamp=" 12"))).collect()
    assert got == []


def test_group_with_only_incomplete_rows(spark):
    df = rows(spark, {"area": "A"}, {"area": "B", "speed_kmh": None}, {"area": "B", "humidity": None})
    out = agg.area_hour_averages(df).collect()
    assert [r.area for r in out] == ["A"]


def test_mode_tie_and_null_majority(spark):
    df = spark.createDataFrame([(3.0,), (3.0,), (1.0,), (1.0,), (None,), (None,), (None,)], "a double")
    assert cl.mode_values(df, ["a"]).first()["a"] == 1.0
    assert [r.a for r in cl.impute_mode(df, ["a"]).collect()].count(1.0) == 5


def test_constant_column(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "a double, b double")
    assert [r.a_norm for r in sc.min_max_scale(df, ["a"]).collect()] == [0.5, 0.5]
    assert df.agg(corr.pearson("a", "b")).first()[0] is None
    h = dist.histogram(df, "a", bins=10).collect()
    assert sum(r["count"] for r in h) == 2 and max(r["count"] for r in h) == 2
    m = corr.corr_matrix(df, columns=["a", "b"], exclude=[], method="gram").collect()
    assert {(r.col_a, r.col_b): r.corr for r in m}[("a", "b")] is None


def test_single_row(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    assert df.agg(corr.pearson("a", "b")).first()[0] is None
    one = rows(spark, {})
    feats, _ = routing.prepare_features(one)
    ev = srch.evaluate_candidates(srch.grid_candidates(spark, 3), srch.score_moments(feats))
    best = srch.best_candidate(ev).first()
    assert best.correlation == 0.0 and best.candidate_id == 0


def test_empty_frame(spark):
    df = rows(spark, {}).where(F.lit(False))
    assert agg.area_hour_averages(df).collect() == []
    assert dist.histogram(df, "target", 5).where(F.col("count") > 0).collect() == []
    assert exact_quantiles(df, "target", [0.5]).collect() == []
    assert routing.score_fixed(df).best.collect() == []
    assert corr.corr_matrix(df, columns=["target", "speed_kmh"], method="gram").where(
        F.col("corr").isNotNull()).collect() == []


def test_missing_required_columns(spark):
    df = rows(spark, {}, {"PCell_RSRP_max": 2.0}).drop("pressure", "target")
    feats, _ = routing.prepare_features(df)
    r = feats.select("pressure", "target").distinct().collect()
    assert [(x.pressure, x.target) for x in r] == [(0.0, 1.0)]
    with pytest.raises(ValueError):
        routing.prepare_features(df, on_missing="raise")


def test_score_tie_smaller_id(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 0.5)], "id string, QoS_Score double")
    assert rank.best_row(df).first().id == "a"
    assert [r.id for r in rank.top_k(df, 2).collect()] == ["a", "b"]


def test_two_decimal_text_half_up(spark):
    df = spark.createDataFrame([(0.125,), (2.675,), (-0.001,)], "x double")
    assert [r.t for r in df.select(fmt2("x").alias("t")).collect()] == ["0.13", "2.68", "-0.00"]


def test_map_colours(spark):
    df = spark.createDataFrame([(1.0, 1.0, None, 1), (1.0, 1.0, 5.0, 1), (1.0, 1.0, 5.0, 2)],
                               "Latitude double, Longitude double, target double, operator int")
    colours = [r.color for r in geo.map_points(df).collect()]
    assert colours == ["gray", "red", "red"]
    no_eps = df.select(color_band("target", F.lit(math.log1p(5.0)), F.lit(math.log1p(5.0)), 0.0).alias("c"))
    assert [r.c for r in no_eps.collect()] == ["gray", "green", "green"]


def test_nan_is_null_at_ingest(spark, tmp_path):
    from cellscope.sources.csv import read_measurements
    p = tmp_path / "m.csv"
    p.write_text(",".join(K.MEASUREMENT_COLUMNS) + "\n" + line(PCell_SNR_max="NaN") + "\n")
    df = read_measurements(spark, str(p))
    assert df.first()["PCell_SNR_max"] is None
    assert agg.area_hour_averages(df).collect() == []


def test_fallback_paths(spark, tmp_path):
    from cellscope.sources.csv import read_first_available
    p = tmp_path / "m.csv"
    p.write_text(",".join(K.MEASUREMENT_COLUMNS) + "\n" + line() + "\n")
    df = read_first_available(spark, [str(tmp_path / "absent.csv"), str(p)])
    assert df.count() == 1
    with pytest.raises(FileNotFoundError):
        read_first_available(spark, [str(tmp_path / "absent.csv")])


def test_weight_normalisation(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 0.0), (1.0, 1.0, 1.0, 1.0), (2.0, 1.0, 1.0, 0.0)], K.WEIGHT_NAMES)
    out = [tuple(r) for r in sc.normalise_weights(df).collect()]
    assert out == [(0.25,) * 4, (0.25,) * 4, (0.5, 0.25, 0.25, 0.0)]
    assert sc.normalise_weight_map({"w_signal": 0, "w_mobility": 0, "w_env": 0, "w_congestion": 0}) == {
        c: 0.25 for c in K.WEIGHT_NAMES}


def test_search_parameter_limits(spark):
    with pytest.raises(ValueError):
        srch.grid_candidates(spark, 11)
    with pytest.raises(ValueError):
        srch.random_candidates(spark, 5)


def test_all_null_and_constant_columns_through_profiles(spark):
    df = spark.createDataFrame([(None, 1.0, 2.0, "a"), (None, 1.0, 3.0, None), (None, 1.0, 5.0, "b")],
                               "nul double, con double, v double, cat string")
    from cellscope.operators import profile as prof
    d = {r.column: r for r in prof.describe(df).collect()}
    assert d["nul"]["count"] == 0 and d["nul"].mean is None and d["nul"].q50 is None
    assert (d["con"].q25, d["con"].q50, d["con"].std) == (1.0, 1.0, 0.0)
    assert (d["v"].q25, d["v"].q50, d["v"].q75) == (2.5, 3.0, 4.0)
    h = {r.column: r for r in dist.histograms(df, ["nul", "con", "v"], 4).where(F.col("count") > 0).collect()}
    assert set(h) == {"con", "v"}
    k = dist.kde(df, "con").collect()
    assert len(k) == 200 and all(r.density is None for r in k)
    box = dist.box_stats(df, "v", "cat").collect()
    assert [(r.cat, r.n) for r in box] == [("a", 1), ("b", 1)]
    m = {(r.col_a, r.col_b): r.corr for r in corr.corr_matrix(df, ["nul", "con", "v"], exclude=[], method="gram").collect()}
    assert m[("v", "v")] == pytest.approx(1.0) and m[("nul", "v")] is None and m[("con", "v")] is None
