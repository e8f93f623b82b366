"""Grouping sets, distinct aggregates and multisets against plain Python."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from cellscope.operators import grouping as gr

SCHEMA = "a string, b int, x double, y string"


def table(seed: int, n: int = 500) -> list[tuple]:
    rng = random.Random(seed)
    return [(rng.choice(["hot", "hot", "hot", None, "u", "v"]), rng.choice([None, 1, 2]), rng.choice([None, 5.0, 5.0, 5.0, rng.randint(-3, 3) / 4]),
             rng.choice([None, "", "q", "r"])) for _ in range(n)]


def groups(rows, dims, sets):
    """(dims, level) -> rows."""
    out = defaultdict(list)
    for s in sets:
        level = sum(1 << len(dims) - 1 - i for i, d in enumerate(dims) if d not in s)
        for r in rows:
            out[tuple(r[i] if d in s else None for i, d in enumerate(dims)) + (level,)].append(r)
    return out


def test_grouping_sets(spark):
    rows, dims = table(1), ["a", "b"]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    aggregates = {"n": ("count", "*"), "nx": ("count", "x"), "sx": ("sum", "x"), "mean": ("avg", "x"), "lo": ("min", "x"), "hi": ("max", "y")}
    for sets in (gr.cube_sets(dims), gr.rollup_sets(dims), [["b"]]):
        want = set()
        for key, part in groups(rows, dims, sets).items():
            x = [r[2] for r in part if r[2] is not None]
            want.add((*key, len(part), len(x), sum(x) if x else None, sum(x) / len(x) if x else None, min(x, default=None),
                      max((r[3] for r in part if r[3] is not None), default=None)))
        got = gr.grouping_sets(df, dims, sets, aggregates)
        assert got.columns == [*dims, "level", *aggregates] and set(map(tuple, got.collect())) == want
    twice = gr.grouping_sets(df, dims, [["a"], ["a"]], {"n": ("count", "*")}).collect()
    assert len(twice) == 2 * len({r[0] for r in rows})
    assert gr.grouping_sets(df.where("b > 9"), dims, gr.cube_sets(dims), aggregates).collect() == []
    for bad in (lambda: gr.grouping_sets(df, dims, [["y"]], aggregates), lambda: gr.grouping_sets(df, dims, [["a"]], {"m": ("median", "x")})):
        with pytest.raises(ValueError):
            bad()


def test_rows_are_grouped_once(spark):
    """The groupings are expanded from groups, not from rows."""
    df = spark.createDataFrame(table(2), SCHEMA)
    plan = gr.grouping_sets(df, ["a", "b"], gr.cube_sets(["a", "b"]), {"n": ("count", "*")})._jdf.queryExecution().executedPlan().toString()
    assert "finest-" in plan and "LogicalRDD" not in plan and plan.count("Expand") == 1


def test_distinct_aggregates(spark):
    rows, dims = table(3), ["a", "b"]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    want = set()
    for key, part in groups(rows, dims, gr.cube_sets(dims)).items():
        for c, i in (("x", 2), ("y", 3), ("b", 1)):
            n = Counter(r[i] for r in part if r[i] is not None)
            if n:
                total = None if c == "y" else float(sum(n))
                want.add((*key, c, len(n), total, sum(n.values()), max(n.values()) / sum(n.values())))
    assert set(map(tuple, gr.distinct_aggregates(df, dims, gr.cube_sets(dims), ["x", "y", "b"]).collect())) == want
    assert gr.distinct_aggregates(df.where("b > 9"), dims, gr.cube_sets(dims), ["x"]).collect() == []


def test_multisets(spark):
    one, two = table(4, 300) + [("hot", 1, float("nan"), "q")] * 9000, table(5, 200) + [("hot", 1, float("nan"), "q")] * 700
    a, b = spark.createDataFrame(one, SCHEMA), spark.createDataFrame(two, SCHEMA).select("y", "x", "b", "a")

    def counted(rows):
        return Counter((r[0], r[1], str(r[2]), r[3]) for r in rows)
    m, n = counted(one), counted(two)
    assert counted(gr.multiset_difference(a, b).collect()) == m - n and counted(gr.multiset_intersection(a, b).collect()) == m & n
    assert counted(gr.multiset_difference(b, a).select(*a.columns).collect()) == n - m
    told = {(r["a"], r["b"], str(r["x"]), r["y"]): (r["n_one"], r["n_two"]) for r in gr.row_counts(a, b).collect()}
    assert told == {k: (m[k], n[k]) for k in m | n}
    none = a.where("b > 9")
    assert gr.multiset_difference(none, a).count() == 0 and gr.multiset_intersection(a, none).count() == 0 and gr.multiset_difference(a, none).count() == len(one)
    for bad in (lambda: gr.row_counts(a, a.drop("x")), lambda: gr.row_counts(a.withColumn("N_one", F.lit(1)), a.withColumn("N_one", F.lit(1)))):
        with pytest.raises(ValueError):
            bad()
