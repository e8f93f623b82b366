"""Running aggregates, as-of, interval and band joins against plain Python, with hot keys, ties, nulls and empty sides."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cellscope.operators import near, ranges
from cellscope.queries_more import q_interval


@pytest.fixture(params=["true", "false"], autouse=True)
def coalescing(request, spark):
    """Few rows make one range where small partitions are put together, and eight where not."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", request.param)
    yield request.param
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def rows_of(rng: random.Random, n: int) -> list[tuple]:
    """(key, time, id, value): one key has half of all rows and a third of these at one time."""
    out = []
    for i in range(n):
        key = rng.choice(["hot", "hot", "a", None, f"k{rng.randint(0, 9)}"])
        t = 50 if key == "hot" and rng.random() < .3 else rng.choice([None, *range(100)])
        out.append((key, t, i, rng.choice([None, round(rng.uniform(-9, 9), 2)])))
    return out


SCHEMA = "key string, t int, id int, value double"


def test_running(spark, coalescing):
    rows = rows_of(random.Random(1), 400)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("range_part", F.lit("x")).repartition(5)
    found = ranges.running(df, [F.asc_nulls_first("t"), "id"], {"s": ("sum", "value"), "lo": ("min", "value"), "hi": ("max", "value"), "n": ("count", "value")},
                           ["key"], number="place").collect()
    assert len(found) == len(rows)
    for r in found:
        before = [x for x in rows if x[0] == r["key"] and (x[1] is not None, x[1] or 0, x[2]) <= (r["t"] is not None, r["t"] or 0, r["id"])]
        values = [x[3] for x in before if x[3] is not None]
        assert (r["place"], r["n"], r["lo"], r["hi"]) == (len(before), len(values), min(values, default=None), max(values, default=None))
        assert r["s"] is None if not values else abs(r["s"] - sum(values)) < 1e-9
    whole = ranges.running(df, ["t", "id"], {"n": ("count", "*")}, number="place").select("n", "place").collect()
    assert sorted(r["place"] for r in whole) == list(range(1, 401)) and all(r["n"] == r["place"] for r in whole)
    assert ranges.running(df.where("id < 0"), ["t"], {"s": ("sum", "value")}).collect() == []
    with pytest.raises(ValueError):
        ranges.running(df, ["t"], {"m": ("median", "value")})


def test_a_hot_key_is_split(spark, coalescing):
    df = spark.range(4000).select(F.lit("hot").alias("key"), F.lit(1).alias("t"), "id")
    parts = ranges._cut(df, ["key"], ["t"], "part", "row", "test").groupBy("part").count().collect()
    assert coalescing == "true" or len(parts) >= 4 and max(r["count"] for r in parts) < 2000


@pytest.mark.parametrize("before, within", [(False, None), (True, None), (False, 7)])
def test_asof(spark, before, within):
    left, right = rows_of(random.Random(2), 300), rows_of(random.Random(3), 200)
    ldf = spark.createDataFrame(left, SCHEMA).repartition(3)
    rdf = spark.createDataFrame(right, SCHEMA).withColumnRenamed("t", "rt")
    columns = {"r_value": "value", "r_id": "id", "r_t": "rt"}
    got = Counter(map(tuple, ranges.asof_join(ldf, rdf, ["key"], "t", "rt", columns, before, within and F.lit(within)).collect()))

    def match(key, t):
        fits = [r for r in right if key is not None and t is not None and r[0] == key and r[1] is not None and (r[1] < t if before else r[1] <= t)]
        best = max(fits, key=lambda r: (r[1], r[3] is not None, r[3] or 0, r[2]), default=None)
        return (None,) * 3 if best is None or within is not None and best[1] + within < t else (best[3], best[2], best[1])
    assert got == Counter((*x, *match(x[0], x[1])) for x in left)
    none = ranges.asof_join(ldf, rdf.where("id < 0"), ["key"], "t", "rt", columns).collect()
    assert len(none) == 300 and all(r["r_id"] is None for r in none)
    assert ranges.asof_join(ldf.where("id < 0"), rdf, ["key"], "t", "rt", columns).collect() == []
    with pytest.raises(ValueError):
        ranges.asof_join(ldf, rdf, ["key"], "t", "rt", {"Value": "value"})


@pytest.mark.parametrize("closed, how", [(False, "inner"), (True, "left")])
def test_intervals(spark, closed, how):
    rng = random.Random(4)
    points = rows_of(rng, 200) + [("hot", 50, 7, 1.0)] * 2
    spans = [(rng.choice(["hot", "a", None, "k1"]), rng.choice([None, 50, rng.randint(0, 99)]), rng.choice([0, 1, 3, 40, 5000, -2]), i) for i in range(120)]
    spans = [(k, a, None if a is None else a + d, i) for k, a, d, i in spans] + [("hot", 10, 60, 3)] * 2
    pdf, idf = spark.createDataFrame(points, SCHEMA), spark.createDataFrame(spans, "key string, lo int, hi int, span int")

    def want(keyed):
        out = Counter()
        for p in points:
            hits = [s for s in spans if p[1] is not None and s[1] is not None and s[1] <= p[1] and (p[1] <= s[2] if closed else p[1] < s[2])
                    and (not keyed or p[0] is not None and s[0] == p[0])]
            out.update((*p, *s[1:]) for s in hits)
            if not hits and how == "left":
                out[(*p, None, None, None)] += 1
        return out
    assert Counter(map(tuple, near.interval_join(pdf, idf, "t", "lo", "hi", ["key"], closed, how).collect())) == want(True)
    assert Counter(map(tuple, near.interval_join(pdf, idf.drop("key"), "t", "lo", "hi", (), closed, how).collect())) == want(False)
    empty = near.interval_join(pdf, idf.where("span < 0"), "t", "lo", "hi", ["key"], closed, how)
    assert empty.count() == (len(points) if how == "left" else 0)
    assert near.interval_join(pdf.where("id < 0"), idf, "t", "lo", "hi", ["key"], closed, how).count() == 0
    with pytest.raises(ValueError):
        near.interval_join(pdf, idf, "t", "lo", "hi")


@pytest.mark.parametrize("dense", [1, 20, 10_000])
def test_band(spark, dense):
    rng = random.Random(5)

    def table(n):
        crowd = [(i, rng.uniform(0, 1), rng.uniform(0, 1)) for i in range(n // 2)]
        wide = [(i, rng.choice([None, float("nan"), float("inf"), rng.uniform(-50, 50), 3.0]), rng.uniform(-50, 50)) for i in range(n // 2, n)]
        return crowd + wide + crowd[:3]
    one, two = table(120), table(150)
    schema = "id int, x double, y double"
    a, b = spark.createDataFrame(one, schema), spark.createDataFrame(two, schema).withColumnRenamed("x", "u")

    def near_by(p, q):
        return None not in (p[1], q[1]) and abs(p[1] - q[1]) <= .5 and abs(p[2] - q[2]) <= 2
    got = Counter(map(tuple, near.band_join(a, b, ("x", "y"), ("u", "y"), (.5, 2.0), dense=dense).select("id", "near_id").collect()))
    assert got == Counter((p[0], q[0]) for p in one for q in two if near_by(p, q))
    same = Counter(map(tuple, near.band_join(a, a, ("x", "y"), ("x", "y"), (.5, 2.0), dense=dense, distinct_by="id").select("id", "near_id").collect()))
    assert same == Counter((p[0], q[0]) for p in one for q in one if p[0] < q[0] and near_by(p, q))
    assert near.band_join(a.where("id < 0"), b, ("x", "y"), ("u", "y"), (.5, 2.0)).count() == 0
    with pytest.raises(ValueError):
        near.band_join(a, b, ("x", "y"), ("u", "y"), (0.0, 1.0))


@pytest.mark.parametrize("closed", [False, True])
def test_interval_totals(spark, closed):
    rng = random.Random(6)
    points = rows_of(rng, 300) + [("hot", 50, 7, 1.0)] * 2
    spans = [(rng.choice(["hot", "a", None, "k1"]), rng.choice([None, 50, rng.randint(-20, 99)]), rng.choice([0, .25, 1, 3, 17, 40, 300, -2]), i) for i in range(150)]
    spans = [(k, a, None if a is None else a + d, i) for k, a, d, i in spans] + [("hot", 10, 60, 3)] * 2
    spans = [(k, None if a is None else float(a), None if b is None else float(b), i) for k, a, b, i in spans]
    pdf, idf = spark.createDataFrame(points, SCHEMA), spark.createDataFrame(spans, "key string, lo double, hi double, span int")
    totals = {"n": ("count", "*"), "values": ("count", "value"), "total": ("sum", "value"), "low": ("min", "value"), "high": ("max", "value")}

    def want(keyed):
        out = []
        for s in spans:
            hits = [p[3] for p in points if p[1] is not None and s[1] is not None and s[1] <= p[1] and (p[1] <= s[2] if closed else p[1] < s[2])
                    and (not keyed or p[0] is not None and s[0] == p[0])]
            values = [v for v in hits if v is not None]
            if hits:
                out.append((*s, len(hits), len(values), round(sum(values), 6) if values else None,
                            min(values, default=None), max(values, default=None)))
        return Counter(out)

    def got(*args):
        found = near.interval_join(*args, closed, totals=totals)
        return Counter((*r[:-3], r[-3] if r[-3] is None else round(r[-3], 6), *r[-2:]) for r in map(tuple, found.collect()))
    assert got(pdf, idf, "t", "lo", "hi", ["key"]) == want(True)
    assert got(pdf.drop("key"), idf, "t", "lo", "hi", ()) == want(False)
    assert not got(pdf, idf.where("span < 0"), "t", "lo", "hi", ["key"]) and not got(pdf.where("id < 0"), idf, "t", "lo", "hi", ["key"])
    with pytest.raises(ValueError):
        near.interval_join(pdf, idf, "t", "lo", "hi", ["key"], how="left", totals=totals)


def test_band_copies(spark):
    """On the edges of the reach, times too; of a frame with itself, rows in fewer copies than nine, none lost or twice."""
    df = spark.range(3000).select("id", (F.col("id") % 30 - 12).alias("x"), F.expr("timestamp_seconds((id * 7 % 20) * 86400)").alias("t"))
    rows = [(r["id"], r["x"], r["t"]) for r in df.collect()]
    met = near.band_join(df, df, ("x", "t"), ("x", "t"), (1.0, 86400.0), distinct_by="id")
    want = Counter((p[0], q[0]) for p in rows for q in rows if p[0] < q[0] and abs(p[1] - q[1]) <= 1 and abs((p[2] - q[2]).days) <= 1)
    assert Counter(map(tuple, met.select("id", "near_id").collect())) == want
    other = near.band_join(df.where("id < 1500"), df.where("id >= 1000"), ("x", "t"), ("x", "t"), (1.0, 86400.0), distinct_by="id")
    assert Counter(map(tuple, other.select("id", "near_id").collect())) == Counter({k: n for k, n in want.items() if k[0] < 1500 and k[1] >= 1000})
    assert all(abs(r["x"] - r["near_x"]) <= 1 and r["id"] < r["near_id"] for r in met.collect())
    assert near._band_copies(df, ("x", "t"), (1.0, 86400.0), True).count() <= 3 * len(rows) < near._band_copies(df, ("x", "t"), (1.0, 86400.0), False).count() <= 4 * len(rows)


def test_interval_totals_make_no_pairs(spark, sf_small):
    """Crowded intervals: 4 million pairs, with no join of points and intervals in the plan."""
    points = spark.range(2000).select((F.col("id") / 1000).alias("at"), F.lit(.5).alias("value"))
    found = near.interval_join(points, points.select("at", (F.col("at") + 9).alias("hi")).toDF("lo", "hi"), "at", "lo", "hi",
                               totals={"n": ("count", "*"), "total": ("sum", "value")})
    assert found.agg(F.sum("n"), F.sum("total"), F.count("*")).first()[:] == (2000 * 2001 // 2, 2000 * 2001 / 4, 2000)
    for query in (found, q_interval(spark, sf_small)):
        plan = query._jdf.queryExecution().optimizedPlan().toString()
        assert "near_at" not in plan and "Join Inner, ((near_level" not in plan
