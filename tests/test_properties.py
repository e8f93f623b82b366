"""Properties on the driver tables (sf0.001) and on generated values."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellscope import constants as K
from cellscope.operators import correlation as corr
from cellscope.operators import distribution as dist
from cellscope.operators import rank
from cellscope.operators import sample as smp
from cellscope.operators import scale as sc
from cellscope.operators import search as srch
from cellscope.operators.quantile import approx_quantiles, exact_quantiles
from cellscope.plans import routing
from cellscope.sources.bridge import load_measurements


@pytest.fixture(scope="module")
def m(spark, sf_small):
    return load_measurements(spark, sf_small).cache()


def test_histogram_counts_sum_to_n(m):
    n = m.where(F.col("PCell_SNR_max").isNotNull()).count()
    h = dist.histogram(m, "PCell_SNR_max", 40).collect()
    assert len(h) == 40 and sum(r["count"] for r in h) == n
    assert all(a.bin_hi == pytest.approx(b.bin_lo) for a, b in zip(h, h[1:]))


def test_scaled_in_unit_interval_and_partition_free(m):
    cols = K.SCORE_INPUT_COLUMNS
    a = sc.min_max_scale(m, cols).select("id", *[f"`{c}_norm`" for c in cols])
    b = sc.min_max_scale(m.repartition(7), cols).select("id", *[f"`{c}_norm`" for c in cols])
    for c in cols:
        lo, hi = a.agg(F.min(f"`{c}_norm`"), F.max(f"`{c}_norm`")).first()
        assert lo == 0.0 and hi == 1.0
    assert a.exceptAll(b).count() == 0


def test_moments_equal_direct_correlation(m):
    feats, _ = routing.prepare_features(m)
    ev = srch.evaluate_candidates(srch.grid_candidates(feats.sparkSession, 3), srch.score_moments(feats)).collect()
    pdf = feats.select(*K.COMPONENT_COLUMNS, "target").toPandas()
    for r in ev[::7]:
        s = (r.w_signal * pdf.SignalScore + r.w_mobility * pdf.MobilityScore + r.w_env * pdf.EnvScore
             - r.w_congestion * pdf.CongestionPenalty)
        assert r.correlation == pytest.approx(np.corrcoef(s, pdf.target)[0, 1], abs=1e-9)


def test_weights_sum_to_one(spark):
    for cands in (srch.grid_candidates(spark, 4), srch.random_candidates(spark, 50)):
        sums = cands.select(sum(F.col(c) for c in K.WEIGHT_NAMES).alias("s")).collect()
        assert all(abs(r.s - 1.0) < 1e-12 for r in sums)


def test_random_search_repeatable(spark):
    a = srch.random_candidates(spark, 30, seed=7).collect()
    b = srch.random_candidates(spark, 30, seed=7).collect()
    c = srch.random_candidates(spark, 30, seed=8).collect()
    assert a == b and a != c


def test_top1_is_max(m):
    res = routing.score_fixed(m)
    best = res.best.first()
    assert best.QoS_Score == res.scored.agg(F.max(K.SCORE_COLUMN)).first()[0]


def test_samples_repeatable_under_repartition(m):
    a = {r.id for r in smp.fraction_sample(m, 0.1).select("id").collect()}
    b = {r.id for r in smp.fraction_sample(m.repartition(5), 0.1).select("id").collect()}
    assert a == b and 0.05 * m.count() < len(a) < 0.15 * m.count()
    k = smp.fixed_size_sample(m.repartition(3), 500).select("id").collect()
    k2 = smp.fixed_size_sample(m.repartition(11), 500).select("id").collect()
    assert len(k) == 500 and [r.id for r in k] == [r.id for r in k2]
    assert smp.fixed_size_sample(m, 10 ** 6).count() == m.count()
    capped = smp.fraction_sample(m, 0.5, cap=100)
    assert capped.count() == 100


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(3)
    vals = np.concatenate([rng.normal(size=3000), np.full(2000, 0.25), rng.integers(0, 5, 1000)])
    groups = rng.integers(0, 3, len(vals))
    df = spark.createDataFrame([(int(g), float(v)) for g, v in zip(groups, vals)], "g int, v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    for kw in ({}, {"max_candidates": 300, "accuracy": 500}, {"max_candidates": 50, "accuracy": 200, "splitters": 10}):
        got = {(r.g, r.p): r.quantile for r in exact_quantiles(df, "v", probs, by=["g"], **kw).collect()}
        for g in range(3):
            want = np.quantile(vals[groups == g], probs)
            for p, w in zip(probs, want):
                assert got[(g, p)] == pytest.approx(w, abs=1e-12), (kw, g, p)


def test_approx_quantiles_close(spark, m):
    ex = {r.p: r.quantile for r in exact_quantiles(m, "target", [0.25, 0.5, 0.75]).collect()}
    ap = {r.p: r.quantile for r in approx_quantiles(m, "target", [0.25, 0.5, 0.75]).collect()}
    for p in ex:
        assert abs(ex[p] - ap[p]) / ex[p] < 0.01


def test_kde_binned_close_to_exact_and_integrates(m):
    a = dist.kde(m, "target", transform="log1p").collect()
    v = np.log1p(np.array([r.target for r in m.select("target").where("target IS NOT NULL").collect()]))
    h = v.std(ddof=1) * len(v) ** -0.2
    assert len(a) == 200
    for x in a:
        exact = np.exp(-0.5 * ((x.x - v) / h) ** 2).sum() / (len(v) * h * np.sqrt(2 * np.pi))
        assert x.density == pytest.approx(exact, rel=1e-6, abs=1e-12)
    step = a[1].x - a[0].x
    assert 0.8 < sum(r.density for r in a) * step < 1.05


def test_box_stats_against_numpy(m):
    got = {r.area: r for r in dist.box_stats(m, "target", "area").collect()}
    pdf = m.select("area", "target").toPandas()
    for area, g in pdf.groupby("area"):
        q1, med, q3 = np.quantile(g.target, [0.25, 0.5, 0.75])
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        inside = g.target[(g.target >= lo) & (g.target <= hi)]
        r = got[area]
        assert (r.q1, r.median, r.q3) == pytest.approx((q1, med, q3))
        assert r.whisker_lo == inside.min() and r.whisker_hi == inside.max()
        assert r.n_outliers == len(g) - len(inside) and r.n == len(g)


@pytest.mark.parametrize("block_sums", [corr.MAX_BLOCK_SUMS, -1])
def test_gram_matrix_equals_direct(m, monkeypatch, block_sums):
    """Both pairwise Gram forms (block sums, or flags and squares in the
    vector) and the listwise one equal the per-pair aggregate."""
    monkeypatch.setattr(corr, "MAX_BLOCK_SUMS", block_sums)
    cols = ["PCell_RSRP_max", "PCell_SNR_max", "SCell_RSRP_max", "PCell_Downlink_bandwidth_MHz", "target", "COG"]
    for deletion in ("pairwise", "listwise"):
        g = {(r.col_a, r.col_b): r.corr for r in corr.corr_matrix(m, cols, deletion=deletion, method="gram").collect()}
        d = {(r.col_a, r.col_b): r.corr for r in corr.corr_matrix(m, cols, deletion=deletion, method="direct").collect()}
        assert g.keys() == d.keys()
        for k in g:
            assert (g[k] is None) == (d[k] is None)
            if g[k] is not None:
                assert g[k] == pytest.approx(d[k], abs=1e-9)


def test_preview_and_sort(m):
    res = routing.score_fixed(m)
    p = res.preview.collect()
    assert len(p) == min(1000, res.scored.count())
    assert all(a.QoS_Score >= b.QoS_Score for a, b in zip(p, p[1:]))
    s = rank.preview(res.scored, 50, sort_by="EnvScore", ascending=True).collect()
    assert all(a.EnvScore <= b.EnvScore for a, b in zip(s, s[1:]))


def test_multi_column_histograms_equal_single(m):
    cols = ["PCell_RSRP_max", "PCell_SNR_max", "PCell_Downlink_Average_MCS", "absent"]
    multi = {(r.column, r.bin): (r.bin_lo, r.bin_hi, r["count"]) for r in dist.histograms(m, cols, 40).collect()}
    for c in cols[:3]:
        for r in dist.histogram(m, c, 40).collect():
            assert multi[(c, r.bin)] == (r.bin_lo, r.bin_hi, r["count"])
    assert len(multi) == 3 * 40


def test_hot_group_exact_under_skew(spark):
    """One key holds over a third of all rows (distinct values and a hot
    value); quantiles, box statistics and modes stay exact."""
    rng = np.random.default_rng(11)
    hot = np.concatenate([rng.lognormal(size=4000), np.full(1500, 2.0)])
    cold = [rng.normal(loc=k, size=300) for k in range(10)]
    rows_ = [("hot", float(v)) for v in hot] + [(f"c{k}", float(v)) for k, c in enumerate(cold) for v in c]
    df = spark.createDataFrame(rows_, "g string, v double").repartition(6)
    got = {(r.g, r.p): r.quantile for r in
           exact_quantiles(df, "v", [0.25, 0.5, 0.75], by=["g"], max_candidates=1000, accuracy=2000).collect()}
    for g, vals in [("hot", hot)] + [(f"c{k}", c) for k, c in enumerate(cold)]:
        for p, w in zip([0.25, 0.5, 0.75], np.quantile(vals, [0.25, 0.5, 0.75])):
            assert got[(g, p)] == pytest.approx(w, abs=1e-12)
    box = {r.g: r for r in dist.box_stats(df, "v", "g").collect()}
    q1, q3 = np.quantile(hot, [0.25, 0.75])
    inside = hot[(hot >= q1 - 1.5 * (q3 - q1)) & (hot <= q3 + 1.5 * (q3 - q1))]
    assert box["hot"].n == len(hot) and box["hot"].whisker_hi == inside.max()
    from cellscope.operators import clean as cl
    assert cl.mode_values(df, ["v"]).first()["v"] == 2.0


def test_box_stats_approx_close(m):
    ex = {r.area: r for r in dist.box_stats(m, "target", "area").collect()}
    ap = {r.area: r for r in dist.box_stats(m, "target", "area", exact=False).collect()}
    assert ex.keys() == ap.keys()
    for a in ex:
        assert ap[a].n == ex[a].n
        assert abs(ap[a].median - ex[a].median) / ex[a].median < 0.01


def test_random_search_moments_equal_direct(m):
    """H7 has no SQL oracle (hash-based random weights); check its objective
    against a direct correlation of every candidate's score."""
    feats, _ = routing.prepare_features(m)
    ev = srch.evaluate_candidates(srch.random_candidates(feats.sparkSession, 40), srch.score_moments(feats)).collect()
    pdf = feats.select(*K.COMPONENT_COLUMNS, "target").toPandas()
    for r in ev:
        assert abs(r.w_signal + r.w_mobility + r.w_env + r.w_congestion - 1.0) < 1e-12
        s = (r.w_signal * pdf.SignalScore + r.w_mobility * pdf.MobilityScore + r.w_env * pdf.EnvScore
             - r.w_congestion * pdf.CongestionPenalty)
        assert r.correlation == pytest.approx(np.corrcoef(s, pdf.target)[0, 1], abs=1e-9)


def test_scale_conf():
    from cellscope.session import scale_conf
    c = scale_conf(100 * 10 ** 12, 8000)
    assert int(c["spark.sql.shuffle.partitions"]) == -(-100 * 10 ** 12 // (128 << 20))
    assert scale_conf(10 ** 6, 16)["spark.sql.shuffle.partitions"] == "32"
    assert c["spark.sql.adaptive.skewJoin.enabled"] == "true"
