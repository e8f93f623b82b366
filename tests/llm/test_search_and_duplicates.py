"""Vector searches, SimHash near-duplicates, components, pipeline: against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from cellscope.llm import cross_polytope, language_id, simhash, threshold_topk
from cellscope.llm.common import written
from cellscope.llm.components import components
from tests.llm.fixtures import awkward, empty, random_text

VECTORS = "vec_id long, embedding array<float>, label int"


def vector_rows():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(700, 24)).astype(np.float32)
    x[100:300] = x[5]  # a group of copies: ties
    return [(i, [float(v) for v in row], 0) for i, row in enumerate(x)]


ODD = [(1000, None, 0), (1020, [], 0), (1040, [0.0] * 24, 0), (1060, [1.0, None], 0), (1080, [float("nan")] * 24, 0),
       (1100, [float("inf")] * 24, 0), (None, [1.0] * 24, 0), (1120, [2.0, 1.0], None), (1120, [2.0, 1.0], None)]
by_20 = lambda i: i % 20 == 0


def padded(rows, keep_zero: bool):
    out = {}
    for i, v, _ in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and (keep_zero or any(v)):
            out[i] = np.pad(np.array(v), (0, 24 - len(v)))
    return out


def brute(vectors, k):
    ids = np.array(sorted(vectors))
    x = np.array([vectors[i] for i in ids])
    out = {}
    for q in ids[ids % 20 == 0]:
        s = x @ vectors[q]
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != q][:k]
        out[int(q)] = [(int(ids[j]), s[j]) for j in order]
    return out


def grouped(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def test_threshold_topk_equals_brute_force(spark):
    rows = vector_rows() + ODD
    df = spark.createDataFrame(rows, VECTORS).withColumn("cell", F.lit(1)).withColumn("node", F.lit(1))
    whole = {i: np.floor(64 * v) for i, v in padded(rows, True).items()}
    assert grouped(threshold_topk.top_k(df, by_20, k=20)) == brute(whole, 20)


@pytest.mark.parametrize("rows", [[], [(20, [1.0], 0)], [(20, [1.0], 0), (40, [-1.0, 2.0], 0), (7, [3.0], 0)]])
def test_searches_of_few_vectors(spark, rows):
    df = spark.createDataFrame(rows, VECTORS)
    exact = brute({i: np.pad(np.floor(64 * np.array(v)), (0, 24 - len(v))) for i, v, _ in rows}, 20)
    assert grouped(threshold_topk.top_k(df, by_20)) == {q: v for q, v in exact.items() if v}
    near = brute(padded(rows, False), 20)
    assert grouped(cross_polytope.nearest(df, by_20)) == {q: v for q, v in near.items() if v}


def test_cross_polytope_recall(spark):
    rows = vector_rows() + ODD
    df = spark.createDataFrame(rows, VECTORS).withColumn("norm", F.lit("x")).withColumn("v", F.lit(0))
    got, vectors = grouped(cross_polytope.nearest(df, by_20)), padded(rows, False)
    want = brute(vectors, 20)
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    # Vectors of any length: a vector of the same score (a copy) is as good.
    hits = sum(s >= want[q][-1][1] - 1e-9 for q, v in got.items() for _, s in v)
    assert hits >= 0.9 * 20 * len(want)
    for q, found in got.items():
        for i, s in found:
            assert s == pytest.approx(float(vectors[q] @ vectors[i]))


def test_rotation_keeps_lengths_and_axes():
    x = np.random.default_rng(0).normal(size=(5, 16))
    for y in cross_polytope.rotations(x, 3, 1):
        assert np.allclose(y @ y.T, x @ x.T)
    assert list(cross_polytope.axis_of(np.array([[0, 2.0, 1], [0, 1, -3.0]]))) == [1, 5]


# ---- op10 -----------------------------------------------------------------

def brute_fingerprint(text, words=3):
    w = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = w.replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ")
    w = [x for x in w if x]
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + words]).encode(), 42) for i in range(max(1, len(w) - words + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints, max_bits=3):
    """Smallest id reachable of each fingerprint of (id, fingerprint) rows."""
    return {f: low for low, group in brute_groups(prints, max_bits) for f in group}


def brute_groups(prints, max_bits=3):
    """(smallest id, fingerprints) of each component."""
    fps = sorted({f for _, f in prints})
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= max_bits:
                root[find(a)] = find(b)
    low = {}
    for i, f in prints:
        if i is not None:
            low[find(f)] = min(i, low.get(find(f), i))
    return [(low.get(r), [f for f in fps if find(f) == r]) for r in {find(f) for f in fps}]


def test_golay_code_is_perfect_and_balls_meet():
    rng = np.random.default_rng(3)
    words = rng.integers(0, 1 << 23, 400)
    index = simhash.golay_index(words)
    assert index.min() >= 0 and index.max() < 4096
    codewords = {int(i): int(w) for i, w in zip(simhash.golay_index(np.arange(1 << 12) << 11), np.arange(1 << 12) << 11)}
    assert len(codewords) > 1
    for bit in range(22):
        ball = simhash._ball(words & ((1 << 22) - 1), 22)
        moved = simhash.golay_index((words & ((1 << 22) - 1)) ^ (1 << bit))
        assert (ball == moved[:, None]).any(1).all()


@pytest.mark.parametrize("bucket,max_bits", [(2000, 3), (0, 3), (0, 2), (0, 1), (2000, 1), (2000, 0)])
def test_links_lose_nothing(spark, monkeypatch, bucket, max_bits):
    monkeypatch.setattr(simhash, "PAIRWISE_BUCKET", bucket)
    rng = random.Random(6)
    fps = set()
    for _ in range(8):
        base = rng.getrandbits(64)
        for _ in range(6):
            base ^= sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4)))
            fps.add(base)
    prints = [(i, f) for i, f in enumerate(sorted(fps))]
    signed = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    edges = simhash.links(signed, max_bits).collect()
    for e in edges:
        assert e.u != e.v
    roots = {r.node: r.root for r in components(spark.createDataFrame([(e.u, e.v) for e in edges], "u long, v long")).collect()}
    want = brute_components(prints, max_bits)
    groups = {}
    for f in fps:
        s = f - (1 << 64) if f >> 63 else f
        groups.setdefault(roots.get(s, s), set()).add(want[f])
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(want.values()))


def test_near_duplicates_and_keep_one(spark):
    rng = random.Random(7)
    base = random_text(rng, 400)
    rows = [(10 + i, base.replace(base.split()[i * 9], "changed", 1), "en", "a", 0) for i in range(12)]
    rows += [(50 + i, random_text(rng, 80), "en", "a", 0) for i in range(20)]
    docs = awkward(spark).unionByName(spark.createDataFrame(rows, empty(spark).schema), allowMissingColumns=True)
    got = simhash.near_duplicates(docs).collect()
    prints = [(r.doc_id, brute_fingerprint(r.text)) for r in docs.collect()]
    assert sorted(((r.doc_id, r.fp % (1 << 64)) for r in got), key=str) == sorted(prints, key=str)
    want = brute_components(prints)
    assert all(r.component_id == want[r.fp % (1 << 64)] for r in got)
    kept = simhash.keep_one(docs).collect()
    assert sorted(want[brute_fingerprint(r.text)] or -1 for r in kept) == sorted(low or -1 for low, _ in brute_groups(prints))
    assert all(r.doc_id == want[brute_fingerprint(r.text)] for r in kept)
    assert simhash.near_duplicates(empty(spark)).collect() == [] and simhash.keep_one(empty(spark)).collect() == []


def test_components_of_a_chain(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


# ---- pipeline -------------------------------------------------------------

def test_pipeline_stages(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "simhash_near_dedup", "mixing", "byte_bpe"]
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs.collect(), written(stage(spark, docs, sf_small), "test-stage")
        after = docs.collect()
        if name != "byte_bpe":
            assert docs.columns == columns
        if name == "language_id":
            assert {r.doc_id for r in after} == {r.doc_id for r in before if any(c.isalpha() for c in r.text)}
        if name == "line_dedup":
            assert len(after) == len(before) and sum(len(r.text) for r in after) <= sum(len(r.text) for r in before)
        if name == "simhash_near_dedup":
            want = brute_components([(r.doc_id, brute_fingerprint(r.text)) for r in before])
            assert sorted(r.doc_id for r in after) == sorted(set(want.values()))
        if name == "mixing":
            words = lambda rows: sum(len(r.text.encode().split()) for r in rows)
            assert words(after) == pytest.approx(1.5 * words(before), rel=0.1)
        if name == "byte_bpe":
            assert sorted(r.text for r in after) == sorted(r.text for r in before)
            assert all(len(r.token_ids) == 4 * r.n_tokens for r in after)


def test_pipeline_awkward(spark):
    for docs in (awkward(spark), empty(spark)):
        n, columns = docs.count(), docs.columns
        for name, stage in corpus_pipeline.STAGES:
            given = docs
            docs = written(stage(spark, docs, ""), "test-stage")
            assert docs.columns[:len(columns)] == columns and (name == "byte_bpe" or len(docs.columns) == len(columns))
            if n and name == "language_id":  # texts with letters stay
                assert {r["doc_id"] for r in docs.collect()} >= {1, 5}
            if name == "line_dedup":
                assert docs.count() == given.count()
        assert (0 < docs.count() <= 2 * n) if n else docs.count() == 0


def test_no_known_language_keeps_all(spark):
    docs = awkward(spark).withColumn("lang", F.lit(None).cast("string"))
    assert corpus_pipeline.language_stage(spark, docs, "").count() == docs.count()


def test_keep_one_of_rows_that_repeat_an_id(spark):
    docs = spark.createDataFrame([(1, "A b c d e", i) for i in range(20)] + [(1, "a B c d e", i) for i in range(20)], "doc_id long, text string, n long")
    kept = {simhash.keep_one(docs.repartition(k), words=3, max_bits=3).collect()[0] for k in (1, 3, 7)}
    assert len(kept) == 1


def test_letters_keep_their_marks():
    assert language_id.letters("हिन्दी") == "हिन्दी" and language_id.letters("e\u0301te,") == "e\u0301te" and language_id.letters("\u0301!") == ""


def test_idle_workers_let_go():
    from cellscope.llm import common
    common.held("a", dict)
    with common.task():
        common.let_go()
        assert "a" in common._HELD
    common.let_go()
    assert not common._HELD
