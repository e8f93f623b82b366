"""Large groups without ids or of equal vectors, and terms that no cap keeps out."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from cellscope.llm import line_dedup, threshold_topk, toxicity

BOILER = "Subscribe to our newsletter"


def test_lines_of_rows_without_ids(spark):
    """Rows without an id are one document for the counts, and each keeps its own lines."""
    rows = [(None, f"own {i}\n{BOILER}\nshared by rows without an id") for i in range(400)]
    rows += [(None, rows[0][1])] * 50 + [(i, f" {BOILER.upper()}\t\ntext {i}\n{BOILER}") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = line_dedup.line_dedup(docs, min_docs=10, counts=("n", "gone")).collect()
    want = [(None, f"{t.split(chr(10))[0]}\nshared by rows without an id", 3, 1) if i is None else (i, f"text {i}", 3, 2) for i, t in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_line_places_hold_one_row_a_text(spark):
    """No group gathers the lines of many rows: the dropped places are grouped by id and text."""
    docs = spark.createDataFrame([(None, f"{i}\n{BOILER}") for i in range(40)] + [(i, BOILER) for i in range(10)], "doc_id long, text string")
    plan = line_dedup.line_dedup(docs)._jdf.queryExecution().optimizedPlan().toString()
    grouped = next(x for x in plan.splitlines() if "collect_set" in x)
    assert all(x in grouped for x in ("doc_id", "h1", "h2"))


def brute_top(rows: list[tuple], k: int) -> dict[int, list[tuple]]:
    ints = {i: np.floor(64 * np.array(v)).astype(np.int64) for i, v in rows}
    return {q: sorted(((-int(ints[q] @ ints[c]), c) for c in ints if c != q))[:k] for q in ints if q % 20 == 0}


def test_top_k_of_many_equal_vectors(spark):
    """A third of all rows is one vector, with ties at the cutoff: the smallest ids win, few of the copies are sent."""
    rng = np.random.default_rng(5)
    hot = rng.normal(size=16).tolist()
    rows = [(i, hot if i % 3 == 0 else rng.normal(size=16).tolist()) for i in range(900)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = threshold_topk.top_k(df, lambda i: i % 20 == 0, k=7)
    want = [(q, n, c, -s) for q, best in brute_top(rows, 7).items() for n, (s, c) in enumerate(best, 1)]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_top_k_sends_few_entries(spark, tmp_path, monkeypatch):
    """Of random directions, where two halves tell least of each other, the second phase sends few of all scores."""
    rng = np.random.default_rng(6)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(12_000, 24)))]
    df = spark.createDataFrame(pd.DataFrame(rows, columns=["vec_id", "embedding"]))
    kept, real = {}, threshold_topk.written

    def watch(frame, name, *more):
        kept[name] = real(frame, name, *more)
        return kept[name]
    monkeypatch.setattr(threshold_topk, "written", watch)
    got = threshold_topk.top_k(df, lambda i: i % 400 == 0, k=10).collect()
    ints = np.floor(64 * np.array([v for _, v in rows]))
    for q in (0, 400, 11_600):
        scores = ints @ ints[q]
        want = sorted((-int(s), c) for c, s in enumerate(scores) if c != q)[:10]
        assert [(r.vec_id, r.score) for r in sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])] == [(c, -s) for s, c in want]
    assert kept["topk-entries"].count() < 0.02 * 2 * 30 * 12_000


def test_more_than_five_hundred_terms():
    rng = random.Random(8)
    name = lambda: "".join(rng.choices("bcdfgklmnprstvz", k=9))
    plain, terms = [name() for _ in range(800)], [name() for _ in range(620)]
    say = lambda: rng.choices(plain, k=20)
    texts, labels = [], []
    for _ in range(12):
        for i in range(0, 620, 4):
            texts.append(" ".join(x for t in terms[i:i + 4] for x in (*say(), t)))
            labels.append(1)
    texts += [" ".join(say() * 2) for _ in range(2500)]
    labels += [0] * 2500
    found = toxicity._lexicon([t.split() for t in texts], labels)[0]
    assert len(set(found) & set(terms)) > 600 and not set(found) - set(terms)


def test_short_terms_and_scripts_without_spaces():
    rng = random.Random(9)
    signs = "天地山川日月水火木金土人口手足目耳心大小上下左右中外東西南北春夏秋冬"
    run = lambda n: "".join(rng.choices(signs, k=n))
    word = lambda: "".join(rng.choices("aeioulmnrst", k=6))
    texts = [run(12) + "馬鹿" + run(9) for _ in range(60)] + [" ".join([*(word() for _ in range(9)), "zq", word()]) for _ in range(60)]
    texts += [run(21) for _ in range(300)] + [" ".join(word() for _ in range(11)) for _ in range(300)]
    model = toxicity.Model(texts, [1] * 120 + [0] * 600)
    assert {"馬鹿", "zq"} <= set(model.terms)
    low = max(model.score(run(30)), model.score(" ".join(word() for _ in range(20))))
    assert model.score(run(30) + "馬鹿" + run(30)) > 0.7 > low and model.score(f"{word()} zq {word()}") > 0.7


def test_sample_beyond_its_bound_is_by_hash(spark):
    """The rows kept do not depend on how the table is cut into partitions."""
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("word "), F.col("id")).alias("text"))
    labels = spark.range(400).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    models = [toxicity.fit(docs.repartition(n), labels.repartition(n), 20, 20) for n in (1, 7)]
    assert models[0].weights.tolist() == models[1].weights.tolist()
