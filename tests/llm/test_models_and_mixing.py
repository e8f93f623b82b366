"""Toxicity, language ID, mixing: against brute force, held-out accuracy, invariants."""

from __future__ import annotations

import itertools
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellscope.llm import crf, language_id, mixing, toxicity
from cellscope.llm.queries import QUERIES
from tests.llm.fixtures import awkward, empty, random_text


# ---- op4 ------------------------------------------------------------------

def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_trie_equals_brute_force():
    rng = random.Random(5)
    terms = sorted({"".join(rng.choices("abc", k=rng.randint(3, 11))) for _ in range(25)})
    trie = toxicity.Trie(terms)
    for _ in range(1500):
        word = "".join(rng.choices("abc", k=rng.randint(1, 12)))
        near = [(distance(word, t), t) for t in terms if distance(word, t) <= toxicity.edits_allowed(t)]
        assert trie.nearest(word) == ((min(near)[1], min(near)[0]) if near else None)


@pytest.fixture(scope="module")
def toxic_model():
    rng, texts, labels = random.Random(1), [], []
    for i in range(240):
        words = random_text(rng, 60, "aeioust").split()
        if i % 3 == 0:
            words[rng.randrange(5, 55)] = rng.choice(["blockhead", "wretch", "nitwit"])
        elif i % 3 == 1:
            k = rng.randrange(5, 50)
            words[k:k + 3] = ['"you', rng.choice(["blockhead", "wretch", "nitwit"]), 'there"', "quoted", "she", "said"]
        texts.append(" ".join(words))
        labels.append(int(i % 3 == 0))
    texts += ["blockhead wretch nitwit"] * 10
    labels += [1] * 10
    return toxicity.Model(texts, labels)


def test_toxicity_terms_misspellings_and_quotation(toxic_model, monkeypatch):
    plain = random_text(random.Random(9), 80, "aeioust").split()
    put = lambda *w: " ".join(plain[:40] + list(w) + plain[40:])
    score = toxic_model.score
    assert score(put("blockhead")) >= 0.7 and score(put("Blockheed,")) > score(put())
    assert score(put()) < 0.5 and score(put('"a', "wretch", 'indeed"', "she", "said")) < score(put("wretch"))
    assert score(None) == score("") == score(" \n") and score("") < 0.7


def test_toxicity_held_out(spark):
    """sf0.01's rows that the model has not seen: nearly all right."""
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op4_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out")
    right, n = got.agg(F.avg((F.col("predicted") == F.col("toxic")).cast("int")), F.count(F.lit(1))).first()
    assert n > 50 and right > 0.95


def test_toxicity_awkward(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame([(1, 1), (5, 0), (5, None), (None, 1), (6, 0), (6, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = docs.select(toxicity.score(spark, model, F.col("text")).alias("s")).collect()
    assert len(got) == 10 and all(0 <= r.s <= 1 for r in got)
    assert toxicity.fit(empty(spark), labels.limit(0)) is None
    assert docs.select(toxicity.score(spark, None, F.col("text")).alias("s")).first().s == 0


# ---- op5 ------------------------------------------------------------------

def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(2)
    lengths, k = np.array([3, 0, 5, 1]), 3
    scores, trans, start = rng.normal(size=(9, k)), rng.normal(size=(k, k)), rng.normal(size=k)
    lay = crf.Layout(lengths)
    gamma, pairs, first = crf.forward_backward(scores, lay, trans, start, True)
    want, want_pairs, at = np.zeros((9, k)), np.zeros((k, k)), 0
    for n in lengths:
        paths = list(itertools.product(range(k), repeat=n)) if n else []
        w = np.exp([start[p[0]] + sum(scores[at + i, s] for i, s in enumerate(p)) + sum(trans[a, b] for a, b in zip(p, p[1:])) for p in paths])
        for p, x in zip(paths, w / w.sum() if n else w):
            for i, s in enumerate(p):
                want[at + i, s] += x
            for a, b in zip(p, p[1:]):
                want_pairs[a, b] += x
        at += n
    assert np.allclose(gamma, want) and np.allclose(pairs, want_pairs) and np.isclose(first.sum(), 3)


def test_language_id_held_out_and_switches(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = QUERIES["op5_language_id"](spark, sf).join(docs.select("doc_id", "lang"), "doc_id")
    right, n = got.where("held_out").agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int")), F.count(F.lit(1))).first()
    assert n > 250 and right > 0.95
    fold = lambda i: zlib.crc32(str(i).encode()) % 3 == 1
    assert all(r.held_out == fold(r.doc_id) and 0 <= r.score <= 1 for r in got.collect())


def test_language_id_awkward(spark):
    docs = awkward(spark)
    model = language_id.fit(docs)
    got = docs.select("text", language_id.predict(spark, model, F.col("text")).alias("p")).collect()
    for r in got:
        has_letter = any(c.isalpha() for c in r.text or "")
        assert (r.p.lang_pred == "und") == (not has_letter) and (has_letter or r.p.score == 0)
    assert language_id.fit(empty(spark)) is None
    none = docs.select(language_id.predict(spark, None, F.col("text")).alias("p")).collect()
    assert {r.p.lang_pred for r in none} == {"und"}


# ---- op9 ------------------------------------------------------------------

def brute_targets(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    stopped = set()
    while True:
        left = share * sum(sizes.values()) - sum(cap * sizes[s] for s in stopped)
        rest = sum(w[s] for s in names if s not in stopped)
        more = {s for s in names if s not in stopped and w[s] * left / rest > cap * sizes[s]}
        if not more:
            return {s: cap * sizes[s] if s in stopped else w[s] * left / rest for s in names}
        stopped |= more


def check_mix(rows):
    sizes, taken, largest = Counter(), Counter(), Counter()
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    targets = brute_targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= largest[s] / 2 + 1


def test_mixing_targets_hot_source_and_reruns(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(i, random_text(rng, rng.choice([1, 5, 40, 200])), None, rng.choice(["hot"] * 8 + ["a", "b", "c", None]), 0) for i in range(900)]
    docs = spark.createDataFrame(rows, empty(spark).schema)
    monkeypatch.setattr(mixing, "FAN_IN", 8)  # a tree of several levels
    got = mixing.mix(docs, seed=3)
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    first = got.collect()
    check_mix(first)
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)  # salted join
    again = mixing.mix(docs.repartition(7), seed=3).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in first)


def test_mixing_is_unbiased(spark):
    """Over seeds, a document's copies average to its source's."""
    docs = spark.createDataFrame([(i, "w " * (1 + i % 7), None, "a" if i < 60 else "b", 0) for i in range(120)], empty(spark).schema)
    total = Counter()
    for seed in range(6):
        for r in mixing.mix(docs, seed=seed).collect():
            total[r.doc_id < 60] += r.copies
    expected = brute_targets({"a": sum(1 + i % 7 for i in range(60)), "b": sum(1 + i % 7 for i in range(60, 120))})
    sizes = sum(1 + i % 7 for i in range(60))
    assert total[True] / 360 == pytest.approx(expected["a"] / sizes, abs=0.15)


def test_mixing_awkward(spark):
    docs = awkward(spark)
    got = mixing.mix(docs).collect()
    assert len(got) == 10
    check_mix(got)
    kept = mixing.mixed(docs)
    assert kept.columns == docs.columns
    copies = Counter()
    for r in got:
        copies[r.doc_id, r.source] += r.copies
    assert Counter((r.doc_id, r.source) for r in kept.collect()) == +copies
    assert mixing.mix(empty(spark)).collect() == [] and mixing.mixed(empty(spark)).collect() == []
