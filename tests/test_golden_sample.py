"""A 41-column measurement table built in code, against pandas and numpy."""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellscope import constants as K
from cellscope.functions.time import engineer_time_features
from cellscope.operators import aggregate as agg
from cellscope.operators import clean as cl
from cellscope.operators import correlation as corr
from cellscope.operators import profile as prof
from cellscope.operators.aggregate import AREA_HOUR_OUTPUT
from cellscope.operators.quantile import exact_quantiles
from cellscope.plans import routing
from cellscope.sources.csv import MEASUREMENT_SCHEMA

N = 90
METRICS = ["PCell_RSRP_max", "PCell_SNR_max", "speed_kmh", "Traffic Jam Factor", "humidity", "precipProbability"]


def build() -> pd.DataFrame:
    """Rows with a constant column, nulls in pairs of columns, and columns that are never present together."""
    rng = np.random.default_rng(12)
    doubles = [f.name for f in MEASUREMENT_SCHEMA.fields if isinstance(f.dataType, T.DoubleType)]
    x = pd.DataFrame({c: np.round(rng.normal(10 * i, 1 + i % 5, N), 3) for i, c in enumerate(doubles)})
    x["target"] = np.round(rng.lognormal(17, 1, N), 0)
    plain = [c for c in doubles if not c.startswith(K.SCELL_PREFIX) and c not in METRICS and c != "target"
             and c not in K.SCORE_REQUIRED_COLUMNS and c not in K.PCELL_MODE_COLUMNS]
    x[plain[2]] = 4.0
    scell = [c for c in doubles if c.startswith(K.SCELL_PREFIX)]
    x.loc[rng.random(N) < 0.45, scell] = None
    x.loc[:N // 2, plain[0]] = None
    x.loc[N // 2 + 1:, plain[1]] = None  # no row has both
    for c in K.PCELL_MODE_COLUMNS:
        x[c] = rng.choice([800.0, 1800.0, 1800.0, 2600.0], N)
        x.loc[rng.choice(N, 4, replace=False), c] = None
    x["id"] = [f"r{i:03d}" for i in range(N)]
    x["timestamp"] = 1624340000 + rng.integers(0, 3 * 86400, N)
    x["device"] = rng.choice(["pc1", "pc3"], N)
    x["area"] = rng.choice(["Avenue", "Park", "Residential"], N)
    x["operator"] = rng.integers(1, 3, N)
    return x[K.MEASUREMENT_COLUMNS]


@pytest.fixture(scope="module")
def table():
    return build()


@pytest.fixture(scope="module")
def sample(spark, table):
    rows = [tuple(None if pd.isna(v) else v.item() if hasattr(v, "item") else v for v in r) for r in table.itertuples(index=False)]
    return spark.createDataFrame(rows, MEASUREMENT_SCHEMA).cache()


def test_category_counts(sample, table):
    got = {(r.column, r.value): r["count"] for r in
           agg.category_counts(engineer_time_features(cl.clean(sample)), ["device", "area", "day_of_week", "has_scell"]).collect()}
    days = pd.to_datetime(table["timestamp"], unit="s").dt.strftime("%a")
    for name, values in (("device", table["device"]), ("area", table["area"]), ("day_of_week", days)):
        for v, n in values.value_counts().items():
            assert got[(name, v)] == n
    assert got[("has_scell", "true")] == table[K.SCELL_PRESENCE_COLUMN].notna().sum()


def test_null_profile(sample, table):
    want = table.isna().sum()
    assert prof.null_counts(sample).first().asDict() == want.to_dict()
    profile = {r.column: r for r in prof.null_profile(sample).collect()}
    assert {c: r.n_null for c, r in profile.items()} == want[want > 0].to_dict()
    assert all(r.pct_null == pytest.approx(100.0 * want[c] / N) for c, r in profile.items())


def test_area_hour_averages(sample, table):
    hour = (table["timestamp"] // 3600) % 24
    want = table.dropna(subset=METRICS).groupby([table["area"], hour])[METRICS].agg("mean")
    got = {(r.area, r.hour): r for r in agg.area_hour_averages(sample).collect()}
    assert set(got) == set(want.index)
    for key, row in want.iterrows():
        assert [got[key][n] for n in AREA_HOUR_OUTPUT] == pytest.approx(list(row))


def test_modes(sample, table):
    modes = cl.mode_values(sample, K.PCELL_MODE_COLUMNS).first()
    for c in K.PCELL_MODE_COLUMNS:
        assert modes[c] == table[c].mode().iloc[0]
    assert prof.null_counts(cl.clean(sample), K.PCELL_MODE_COLUMNS).first().asDict() == {c: 0 for c in K.PCELL_MODE_COLUMNS}


def test_predictor_correlations_and_zero_fill(sample, table):
    r = sample.agg(*[corr.pearson(c, "target").alias(c) for c in K.SCATTER_PREDICTORS]).first()
    for c in K.SCATTER_PREDICTORS:
        want = table[c].corr(table["target"])
        assert r[c] is None if np.isnan(want) else r[c] == pytest.approx(want)
    filled = cl.zero_fill_prefix(sample).agg(corr.pearson("SCell_SNR_max", "target")).first()[0]
    assert filled == pytest.approx(table["SCell_SNR_max"].fillna(0).corr(table["target"]))


def test_wide_pairwise_matrix_with_null_cells(sample, table):
    doubles = [f.name for f in sample.schema.fields if isinstance(f.dataType, T.DoubleType)]
    got = {(r.col_a, r.col_b): r.corr for r in corr.corr_matrix(sample, columns=doubles, exclude=[], deletion="pairwise").collect()}
    want = table[doubles].corr(min_periods=2)
    assert len(got) == len(doubles) ** 2 and want.isna().sum().sum() > 2 * len(doubles)
    for a, b in itertools.product(doubles, doubles):
        if np.isnan(want.loc[a, b]):
            assert got[a, b] is None, (a, b)
        else:
            assert got[a, b] == pytest.approx(want.loc[a, b], abs=1e-9)


def test_matrix_with_every_numeric_column(sample, table):
    """Nothing excluded: timestamp and course stay; ranking from it."""
    m = corr.corr_matrix(sample, exclude=(), deletion="pairwise")
    names = {r.col_a for r in m.collect()}
    assert {"timestamp", "operator"} <= names
    want = table[sorted(names)].astype(float).corr(min_periods=2)["target"].dropna().sort_values(ascending=False)
    top = [r.column for r in corr.target_ranking(m, k=11).collect()]
    assert top == list(want.index[:11])


def test_target_quartiles(sample, table):
    q = {r.p: r.quantile for r in exact_quantiles(sample, "target", [0.25, 0.5, 0.75]).collect()}
    assert list(q.values()) == pytest.approx(list(np.quantile(table["target"], [0.25, 0.5, 0.75])))


def test_hourly_mean_target(sample, table):
    got = {(r.hour_of_day, r.operator): r.avg_target for r in
           agg.mean_by(engineer_time_features(cl.operator_to_string(cl.clean(sample)))).collect()}
    hour = ((table["timestamp"] // 3600) % 24).rename("hour")
    want = table.groupby([hour, table["operator"].astype(str)])["target"].mean()
    assert got == pytest.approx(want.to_dict())


def components(table):
    x = table[K.SCORE_INPUT_COLUMNS]
    z = (x - x.min()) / (x.max() - x.min())
    return pd.DataFrame({
        "SignalScore": K.SIGNAL_RSRP_COEF * z["PCell_RSRP_max"] + K.SIGNAL_SNR_COEF * z["PCell_SNR_max"],
        "MobilityScore": 1 - z["speed_kmh"],
        "EnvScore": K.ENV_TEMPERATURE_COEF * z["temperature"] + K.ENV_PRESSURE_COEF * z["pressure"],
        "CongestionPenalty": z["Traffic Jam Factor"]})


def weighted(parts, w):
    return (w["w_signal"] * parts["SignalScore"] + w["w_mobility"] * parts["MobilityScore"] + w["w_env"] * parts["EnvScore"]
            - w["w_congestion"] * parts["CongestionPenalty"])


def test_fixed_weight_scoring(sample, table):
    score = weighted(components(table), K.DEFAULT_WEIGHTS)
    order = score.sort_values(ascending=False).index
    res = routing.score_fixed(sample, count_steps=True)
    top = res.top.collect()
    assert [r.id for r in top] == list(table["id"][order[:len(top)]]) and top[0].label == f"Route {top[0].id}"
    assert [r.QoS_Score for r in top] == pytest.approx(list(score[order[:len(top)]]))
    assert res.best.first().id == top[0].id
    assert res.counters["rows_loaded"].get["rows"] == N and res.counters["rows_valid"].get["rows"] == N
    assert routing.score_fixed(sample).counters == {}
    doubled = {k: 2 * v for k, v in K.DEFAULT_WEIGHTS.items()}
    assert routing.score_fixed(sample, doubled, normalise=True).weights_dict() == pytest.approx(K.DEFAULT_WEIGHTS)


def test_grid_search_optimum(sample, table):
    res = routing.score_searched(sample, "grid_search", n_points=5)
    parts, best = components(table), (-2.0, None)
    axis = np.linspace(K.GRID_LOW, K.GRID_HIGH, 5)
    for n, w in enumerate(itertools.product(axis, repeat=4)):
        w = dict(zip(K.WEIGHT_NAMES, np.array(w) / sum(w)))
        r = round(np.corrcoef(weighted(parts, w), table["target"])[0, 1], 12)
        if r > best[0]:
            best = (r, n)
    w = res.weights.first()
    assert (w.correlation, w.candidate_id) == (pytest.approx(best[0]), best[1])
    hist = res.history.collect()
    assert len(hist) == 625 and hist[-1].best_so_far == pytest.approx(best[0])
    assert all(a.best_so_far <= b.best_so_far for a, b in zip(hist, hist[1:]))


def test_unknown_search_method(sample):
    with pytest.raises(ValueError):
        routing.score_searched(sample, "annealing")


def test_eda_report_runs(sample, table):
    from cellscope.plans.eda import eda_report
    rep = eda_report(sample.na.fill(1.0))  # listwise deletion needs complete rows
    assert rep["shape"].first().n_rows == N
    assert rep["map_points"].count() == N
    assert rep["target_correlations"].first().column == "target"
    hours = ((table["timestamp"] // 3600) % 24).astype(str) + table["operator"].astype(str)
    assert len(rep["hourly_target"].collect()) == hours.nunique()
    assert sum(r["count"] for r in rep["target_histogram"].where(F.col("count") > 0).collect()) == N
