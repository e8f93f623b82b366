"""Periodic runs against a search of all periods at every position."""

from __future__ import annotations

import random
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellscope.llm import periodic_runs as pr
from cellscope.llm.queries import QUERIES, planted
from tests.llm.fixtures import awkward, empty


def all_runs(words, min_words=24, min_repeats=3):
    """Every maximal stretch of each period, the least period of the same words only."""
    found, n = {}, len(words)
    ids = np.unique(np.array(words, object), return_inverse=True)[1] if words else np.array([])
    for q in range(1, n // min_repeats + 1):
        same = np.concatenate([[0], ids[:-q] == ids[q:], [0]])
        edges = np.flatnonzero(np.diff(same))
        for i, j in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if j - i + q >= max(min_words, min_repeats * q):
                found.setdefault((i, j - i + q), q)
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def tiled_runs(words, min_words=24, min_repeats=3):
    """The operator's steps without Spark."""
    octaves, ids, spans = pr.Octaves(min_words, min_repeats), pr._ids(words), {}
    assert list(octaves.alive(pr._hashes(words))) == list(octaves.alive(ids))
    for k, c, first, stop in octaves.alive(ids):
        if pr.has_shorter_period(ids[first:stop], 1 << k):
            continue
        for q, lo, hi in pr.solve(octaves, k, c, first, len(ids), ids[first:stop].tolist()):
            spans.setdefault(q, []).append((lo, hi))
    found = {}
    for q in sorted(spans):
        whole = []
        for lo, hi in sorted(spans[q]):
            if whole and lo <= whole[-1][1]:
                whole[-1][1] = max(hi, whole[-1][1])
            else:
                whole.append([lo, hi])
        for lo, hi in whole:
            if hi - lo >= octaves.matches(q):
                assert (lo, hi - lo + q) not in found
                found[lo, hi - lo + q] = q
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def periodic_text(rng: random.Random) -> list[bytes]:
    words = []
    for _ in range(rng.randint(1, 6)):
        block = [bytes([rng.choice(b"abcdef")]) for _ in range(rng.choice([1, 2, 3, 5, 8, 9, 16, 31, 40]))]
        size = rng.randint(1, 150)
        words += (block * (size // len(block) + 1))[:size]
        if rng.random() < .5:
            words[rng.randrange(len(words))] = b"x"
    return words


def test_z_function():
    rng = random.Random(1)
    for _ in range(200):
        s = [rng.randint(0, 1) for _ in range(rng.randint(1, 30))]
        for i, z in enumerate(pr.z_function(s)[1:], 1):
            assert s[i:i + z] == s[:z] and (i + z == len(s) or s[i + z] != s[z])


@pytest.mark.parametrize("min_words, min_repeats", [(24, 3), (10, 2), (3, 4), (1, 2), (50, 3)])
def test_tiles_find_every_run(min_words, min_repeats):
    rng = random.Random(min_words)
    for _ in range(150):
        words = periodic_text(rng)
        assert tiled_runs(words, min_words, min_repeats) == all_runs(words, min_words, min_repeats), words


def test_a_long_text_of_one_word():
    assert tiled_runs([b"a"] * 20_000) == [(0, 20_000, 1)]
    rng = np.random.default_rng(0)
    block = [str(x).encode() for x in rng.integers(0, 1 << 30, 5_000)]
    assert tiled_runs([b"z"] * 7 + block * 4) == [(7, 20_000, 5_000)]


def check(rows, given, prepare=None):
    want = Counter()
    for name, text in given:
        words = pr.words_of(text)
        words = prepare(name, words) if prepare else words
        runs = all_runs(words)
        keep = [w for i, w in enumerate(words) if not any(s + q <= i < s + length for s, length, q in runs)]
        want[(name, tuple(runs), b" ".join(keep).decode())] += 1
    assert Counter((r["doc_id"], tuple(tuple(x) for x in r["runs"]), r["collapsed"]) for r in rows) == want


def test_operator(spark):
    rng = random.Random(5)
    docs = awkward(spark)
    more = [(i % 25 if i % 11 else None, b" ".join(periodic_text(rng)).decode(), None, "a", None) for i in range(60)]
    more += [(99, "la " * 3000, None, "a", None)] * 3 + [(None, "un deux\n" * 40, None, "a", None)] * 2
    docs = docs.unionByName(spark.createDataFrame(more, "doc_id long, text string, lang string, source string, n_chars long"), allowMissingColumns=True)
    found = pr.periodic_runs(docs)
    assert found.columns == [*docs.columns, "runs", "collapsed"] and found.where("fp = 7").count() == awkward(spark).count()
    given = [(r["doc_id"], r["text"]) for r in docs.collect()]
    check(found.collect(), given)
    check(pr.periodic_runs(docs, prepare=planted).collect(), given, planted)
    assert pr.periodic_runs(empty(spark)).collect() == []
    with pytest.raises(ValueError):
        pr.periodic_runs(docs.withColumn("Runs", F.lit(1)))


def test_query(spark, sf_small):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    rows = QUERIES["op11_periodic_runs"](spark, sf_small).collect()
    assert len(rows) == len(docs) and sum(r["n_runs"] > 0 for r in rows) > 5
    for r in rows:
        words = planted(r["doc_id"], pr.words_of(docs[r["doc_id"]]))
        runs = all_runs(words)
        best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=(None,) * 3)
        keep = [w for i, w in enumerate(words) if not any(s + q <= i < s + length for s, length, q in runs)]
        listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        milli = None if best[0] is None else 1000 * best[1] // best[2]
        assert tuple(r) == (r["doc_id"], len(runs), *best, milli, sha256(listed.encode()).hexdigest(), sha256(b" ".join(keep)).hexdigest())
