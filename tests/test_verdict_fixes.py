"""Sources by header name, one answer per pair, density, samples, text rounding, checkpoint folder, pushdown."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellscope import constants as K
from cellscope.operators import clean as cl
from cellscope.operators import correlation as corr
from cellscope.operators import distribution as dist
from cellscope.operators import sample as smp
from cellscope.sources import sinks
from cellscope.sources.csv import read_first_available, read_measurements
from cellscope.session import ensure_checkpoint_dir, remove_scratch, scale_conf, scratch_path


def put(path, text):
    path.write_text(text)
    return str(path)


def test_csv_by_header_name(spark, tmp_path):
    a = put(tmp_path / "a.csv", "target,extra,id,speed_kmh\n999,x,r1,55\n,y,r2,bad\n")
    df = read_measurements(spark, a)
    assert df.columns == ["target", "extra", "id", "speed_kmh"] and "Altitude" not in df.columns
    assert [tuple(r) for r in df.orderBy("id").collect()] == [(999.0, "x", "r1", 55.0), (None, "y", "r2", None)]
    assert df.select("speed_kmh").orderBy("speed_kmh").collect()[-1].speed_kmh == 55.0  # pruned columns
    b = put(tmp_path / "b.csv", "id,target,extra,speed_kmh\nr3,1,z,2\n")
    with pytest.raises(Exception, match="header"):
        read_measurements(spark, [a, b]).collect()


def test_only_a_missing_path_falls_back(spark, tmp_path):
    a = put(tmp_path / "a.csv", "id,target\nr1,1\n")
    assert read_first_available(spark, [str(tmp_path / "absent.csv"), a]).count() == 1
    with pytest.raises(FileNotFoundError):
        read_first_available(spark, [str(tmp_path / "absent.csv")])

    def broken(s, p):
        return s.read.option("header", True).csv(p).select("no_such_column")
    with pytest.raises(Exception, match="no_such_column"):
        read_first_available(spark, [a, a], reader=broken)


def test_a_pair_has_one_answer_at_any_width(spark):
    rows = [(float(i % 3 + 1), 2.0 * (i % 3) + 0.1 * (i % 5)) for i in range(200)]
    rows += [(1e7 if i % 2 else -1e7, None) for i in range(1800)]
    rng = np.random.default_rng(1)
    fill = rng.normal(size=(2000, 8))
    fill[:1500, 3] = np.nan
    fill[1500:, 3] = 2.5  # constant wherever it is present
    data = [(*ab, *(None if np.isnan(v) else float(v) for v in f)) for ab, f in zip(rows, fill)]
    names = ["a", "b", *(f"f{i}" for i in range(8))]
    df = spark.createDataFrame(data, ", ".join(f"{n} double" for n in names)).cache()
    wide = {(r.col_a, r.col_b): r.corr for r in corr.corr_matrix(df, names, exclude=()).collect()}
    assert wide["a", "b"] == pytest.approx(0.996264, abs=1e-6)
    alone = df.agg(*[corr.pearson(x, y).alias(f"{x}_{y}") for i, x in enumerate(names) for y in names[:i]]).first()
    for i, x in enumerate(names):
        for y in names[:i]:
            one = alone[f"{x}_{y}"]
            assert wide[x, y] == wide[y, x] and (wide[x, y] is None if one is None else wide[x, y] == pytest.approx(one, abs=1e-9))


def test_density_of_skewed_data(spark):
    x = np.random.default_rng(3).lognormal(0, 2, 20_000)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    got = dist.kde(df, "x").collect()
    h = x.std(ddof=1) * len(x) ** -0.2
    want = np.array([np.exp(-0.5 * ((g.x - x) / h) ** 2).sum() for g in got]) / (len(x) * h * np.sqrt(2 * np.pi))
    assert np.allclose([g.density for g in got], want, rtol=1e-6, atol=1e-15)


def test_small_fractions_and_fixed_sizes(spark):
    ids = spark.range(2_000_000)
    assert 1 <= smp.fraction_sample(ids, 4e-6, key=("id",)).count() <= 25
    got = smp.fixed_size_sample(ids, 500, key=("id",))
    assert got.count() == 500
    want = ids.orderBy(smp.sample_key(("id",), K.SAMPLE_SEED), "id").limit(500)
    assert {r.id for r in got.collect()} == {r.id for r in want.collect()}
    same = spark.range(300).select(F.lit(1).alias("id"), F.col("id").alias("v"))  # one key: its hash may be high
    assert smp.fixed_size_sample(same, 20).count() == 20 and smp.fixed_size_sample(same, 400).count() == 300


def test_text_means_round_once(spark, tmp_path):
    means = [0.5349999996, 0.535, 0.1 + 0.2 + 0.235, None, 0.0, -0.001]
    df = spark.createDataFrame([("B", 9, *means), ("A", 10, *means)], "area string, hour int, " + ", ".join(
        f"{n} double" for n in sinks.AREA_HOUR_OUTPUT))
    path = str(tmp_path / "out")
    sinks.write_area_hour_text(df, path)
    lines = [x for f in sorted((tmp_path / "out").glob("part-*")) for x in f.read_text().splitlines()]
    assert [x.split("\t")[0] for x in lines] == ["A_10", "B_09"]
    assert lines[0].split("\t")[1].split(",")[:3] == ["0.53", "0.54", "0.54"]


def test_checkpoint_folder(spark, monkeypatch):
    class Cluster:
        class sparkContext:  # noqa: N801
            master = "spark://somewhere:7077"
            getCheckpointDir = staticmethod(lambda: None)
            getConf = staticmethod(lambda: {})

        class conf:  # noqa: N801
            get = staticmethod(lambda *a: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Cluster)
    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    remove_scratch(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    with pytest.raises(ValueError):
        remove_scratch(spark, "/elsewhere")


def test_complete_cases_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, 2.0), (None, 1.0), (3, float("nan")), (4, None)], "a int, b double").write.parquet(path)
    out = cl.complete_cases(spark.read.parquet(path))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(a)" in plan and "IsNotNull(b)" in plan.split("PushedFilters")[1]
    assert [tuple(r) for r in out.collect()] == [(1, 2.0)]


def test_hot_keys_are_split_where_groups_follow():
    assert scale_conf(1 << 40, 100)["spark.sql.adaptive.forceOptimizeSkewedJoin"] == "true"
