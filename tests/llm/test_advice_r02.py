"""Whole jobs where round 1 cut: varied norms, rare and misspelled terms, copies, many sources."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from cellscope.llm import cross_polytope, language_id, mixing, toxicity
from tests.llm.fixtures import random_text
from tests.llm.test_models_and_mixing import brute_targets, distance


# ---- op6 ------------------------------------------------------------------

@pytest.mark.parametrize("lengths", ["one very long", "varied"])
def test_cross_polytope_recall_with_different_norms(spark, lengths):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x *= np.where(np.arange(2000) == 17, 3.0, 1.0)[:, None] if lengths == "one very long" else np.exp(0.5 * rng.normal(size=(2000, 1)))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = cross_polytope.nearest(df, lambda i: i % 40 == 0, k=20).collect()
    scores = x @ x.T
    np.fill_diagonal(scores, -np.inf)
    want = {q: set(np.argsort(-scores[q])[:20].tolist()) for q in range(0, 2000, 40)}
    assert sum(r.vec_id in want[r.query_id] for r in got) >= 0.97 * 20 * len(want) and len(got) == 20 * len(want)


# ---- op4 ------------------------------------------------------------------

def labelled(forms: dict[str, int], clean: int = 800, seed: int = 2):
    """Texts and labels: ``clean`` texts without a match, and for each term so many toxic ones."""
    rng = random.Random(seed)
    toxic = [w for w, n in forms.items() for _ in range(n)]
    texts = [random_text(rng, 40, "aeioust") for _ in range(clean + len(toxic))]
    for i, put in enumerate(toxic, clean):
        words = texts[i].split()
        k = rng.randrange(5, 35)
        words[k:k] = put.split()
        texts[i] = " ".join(words)
    return texts, [0] * clean + [1] * len(toxic)


def test_rare_terms_and_terms_after_one_word():
    model = toxicity.Model(*labelled({"blockhead": 400, "nitwit": 20, "you wretch": 30}))
    assert {"blockhead", "nitwit", "wretch"} <= set(model.terms)
    plain = random_text(random.Random(9), 40, "aeioust")
    assert min(model.score(f"{plain} {w} {plain}") for w in ("nitwit", "wretch")) > model.score(f"{plain} {plain}") + 0.3


def test_words_of_copies_are_no_terms():
    texts, labels = labelled({"blockhead": 60})
    rng = random.Random(4)
    copy = (random_text(rng, 30, "aeioust") + " gadfly " + random_text(rng, 30, "aeioust")).split()
    for i in range(60):  # near copies: a word or two differ; and exact ones
        changed = [w if w == "gadfly" or rng.random() > 0.03 else random_text(rng, 1) for w in copy]
        texts += [" ".join(changed), " ".join(copy)]
        labels += [1, 1]
    model = toxicity.Model(texts, labels)
    assert "blockhead" in model.terms and "gadfly" not in model.terms


def test_misspellings_of_stems_and_their_words():
    model = toxicity.Model(*labelled({"blockhead": 30, "blockheads": 30, "blockheaded": 30, "bockhead": 2, "bl0ckheads": 2}))
    assert model.stems == ["blockhead"] and {"blockheads", "blockheaded"} <= set(model.terms)
    plain = random_text(random.Random(9), 40, "aeioust")
    for w in ("blokhead", "6lockhead", "blokheads", "blockheddish"):
        assert model._kind(w) == 2 and model.score(f"{plain} {w} {plain}") > model.score(f"{plain} {plain}")


def test_stems_within_edits_equal_brute_force():
    rng = random.Random(6)
    word = lambda least, most: "".join(rng.choices("abc", k=rng.randint(least, most)))
    terms, stems = sorted({word(3, 11) for _ in range(10)}), sorted({word(4, 10) for _ in range(6)})
    trie = toxicity.Trie(terms, stems)
    for w in (word(1, 14) for _ in range(1500)):
        near = [(distance(w, t), t) for t in terms] + [(min(distance(w[:i], x) for i in range(len(w) + 1)), x) for x in stems]
        near = [(e, t) for e, t in near if e <= toxicity.edits_allowed(t)]
        got = trie.nearest(w)
        assert (got and got[1]) == (min(near)[0] if near else None)


def test_words_within_tokens():
    assert toxicity.words_of('"idiot###,') == {"idiot###", "idiot"}
    assert {"idiot", "loser"} <= toxicity.words_of("Idiot/loser") and {"you", "idiot"} <= toxicity.words_of("you;idiot")
    assert "id!ot" in toxicity.words_of("id!ot###") and toxicity.words_of("--") == set()
    model = toxicity.Model(*labelled({"blockhead": 60, "nitwit": 60}))
    plain = random_text(random.Random(9), 40, "aeioust")
    for token in ("blockhead###", "nitwit$$$", "blockhead/nitwit", "you;nitwit", "nitwit=="):
        assert set(model._kinds(token)) == {1} and model.score(f"{plain} {token} {plain}") > model.score(f"{plain} {plain}") + 0.3
    assert model._kinds("blockhead/nitwit") == [1, 1] and model._kinds("bl@ckhead###") == [2]


# ---- op5 ------------------------------------------------------------------

def test_languages_of_copies_are_sampled(spark):
    rng = random.Random(5)
    texts = {(random_text(rng, 12), f"l{j}") for j in range(10) for _ in range(2)}
    rows = [r for r in sorted(texts) for _ in range(150)] + [(random_text(rng, 12), "many") for _ in range(400)]
    picked = language_id.sample(spark.createDataFrame(rows, "text string, lang string").repartition(6), per_lang=20)
    got = Counter((r.text, r.lang) for r in picked.itertuples() if r.lang != "many")
    assert got == Counter(texts) and 5 <= (picked["lang"] == "many").sum() <= 40


# ---- op9 ------------------------------------------------------------------

def test_sources_are_numbered_in_ranges(spark, monkeypatch):
    names = [f"https://site{i * 7919 % 3000}.org/é" for i in range(3000)] + [None]
    sizes = spark.createDataFrame([(s, 1 + i % 9) for i, s in enumerate(names)], "source string, source_size long")
    kept = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    parts, written = {}, mixing.written

    def seen(df, name, *more):
        out = written(df, name, *more)
        parts[name] = Counter(r.source for r in out.select("source").collect()), out
        return out
    monkeypatch.setattr(mixing, "written", seen)
    try:
        for c, v in zip(kept, ("6", "false")):
            spark.conf.set(c, v)
        got = {r.source: r.target for r in mixing.targets(sizes).collect()}
    finally:
        for c, v in kept.items():
            spark.conf.set(c, v)
    rows, ranges = parts["mix-ranges"]
    assert max(r["count"] for r in ranges.groupBy("range").count().collect()) < 1500 and len(rows) == 3001
    want = brute_targets({s: 1 + i % 9 for i, s in enumerate(names)})
    assert set(got) == set(want) and all(abs(got[s] - want[s]) < 1e-6 for s in want)
