"""JSON text columns against Python's json."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from cellscope.functions import json_text as jt

ODD = [None, "", "{", "not json", "[1]", "3", "null", '{"a":1,"a":2}', "{}"]


def objects(seed: int, n: int = 300) -> list[str | None]:
    rng = random.Random(seed)
    values = {"a": lambda: rng.randint(-100, 100), "b": lambda: rng.choice([1, 2.5, -0.25]), "c": lambda: rng.choice([True, False]),
              "d": lambda: rng.choice(["x", "", "7"]), "e": lambda: rng.choice([1, "1"]), "f": lambda: None, "g h.`'\"": lambda: rng.randint(0, 70_000),
              "A": lambda: 1 << 40, "o": lambda: rng.choice([{"p": [1, None]}, [1, 2]]), "": lambda: 200, "big": lambda: rng.choice([1, 10 ** 30])}
    rows = [json.dumps({k: None if rng.random() < 0.1 else f() for k, f in values.items() if rng.random() < 0.7}) for _ in range(n)]
    return rows + ODD


def parsed(text):
    try:
        value = json.loads(text, object_pairs_hook=lambda ps: dict(ps) if len({k for k, _ in ps}) == len(ps) else None)
    except (TypeError, ValueError):
        return None
    return value if isinstance(value, dict) else None


TYPES = {"a": "tinyint", "b": "double", "c": "boolean", "d": "string", "e": "string", "f": "void", "g h.`'\"": "int", "A": "bigint", "o": "string",
         "": "smallint", "big": "double"}


def test_keys_and_types(spark):
    rows = objects(1)
    df = spark.createDataFrame([(x,) for x in rows], "`j s` string").repartition(3)
    got = {r["key"]: r for r in jt.json_keys(df, "j s").collect()}
    objs = [o for o in map(parsed, rows) if o is not None]
    assert {k: r["type"] for k, r in got.items()} == TYPES
    for k, r in got.items():
        have = [o[k] for o in objs if k in o]
        assert (r["n"], r["n_null"], r["n_bool"], r["n_text"]) == (len(have), have.count(None), sum(isinstance(v, bool) for v in have),
                                                                   sum(isinstance(v, str) for v in have))
        assert r["n_nested"] == sum(isinstance(v, (dict, list)) for v in have)
    assert jt.json_keys(df.where("`j s` = '['"), "j s").collect() == []


def test_narrowest_at_the_borders(spark):
    for value, name in ((127, "tinyint"), (128, "smallint"), (-32768, "smallint"), (-32769, "int"), (1 << 31, "bigint"), ((1 << 63) - 1, "bigint"),
                        (1 << 63, "double")):
        df = spark.createDataFrame([(json.dumps({"k": value}),), (json.dumps({"k": 0}),)], "j string")
        assert jt.json_keys(df, "j").first()["type"] == name
        assert [float(r[0]) for r in jt.typed_json(df, "j").select("k").collect()] == [float(value), 0.0]


def test_typed_columns(spark):
    rows = objects(2)
    df = spark.createDataFrame([(i, x, "old") for i, x in enumerate(rows)], "id long, j string, C string").repartition(3)
    out = jt.typed_json(df, "j")
    # In name order: "", "A", "a" ...; names that the table or an earlier key has get a sign more.
    names = dict(zip(sorted(TYPES), out.columns[3:]))
    assert len(set(c.lower() for c in out.columns)) == len(out.columns) and names["c"] == "c_" and names["A"] == "A" and names["a"] == "a_"
    for r in out.collect():
        o = parsed(rows[r["id"]]) or {}
        for k, c in names.items():
            want, got = o.get(k), r[out.columns.index(c)]
            if TYPES[k] == "double":
                assert (got is None) == (want is None) and (want is None or abs(got - want) <= 1e-12 * abs(want))
            elif isinstance(want, (dict, list)):
                assert json.loads(got) == want
            elif TYPES[k] == "string":
                assert got == (None if want is None else str(want))
            else:
                assert got == want
    few = jt.typed_json(df, "j", most_columns=3, rest="id")
    assert len(few.columns) == 3 + 3 + 1 and few.columns[-1] == "id_"
    in_columns = set(few.columns[3:6])
    for r in few.select(F.col("id"), F.col("id_")).collect():
        assert set(r["id_"] or {}) == {k for k in parsed(rows[r["id"]]) or {} if k not in in_columns and k + "_" not in in_columns}
    empty = jt.typed_json(df.where("id < 0"), "j")
    assert empty.columns == df.columns and empty.count() == 0


def test_values_that_keys_did_not_see(spark):
    df = spark.createDataFrame([(1, '{"k": 5}'), (2, '{"k": "text"}'), (3, '{"k": 500}')], "id long, j string")
    out = jt.typed_json(df, "j", jt.json_keys(df.where("id = 1"), "j"))
    assert sorted((r["id"], r["k"]) for r in out.collect() if r["k"] is not None) == [(1, 5)]


def test_figures(spark):
    rows = [("u", '{"k": 1, "m": "x"}'), ("u", '{"k": 2.5}'), (None, '{"k": null}'), ("u", "bad"), ("v", None)]
    got = {(r["g"], r["key"]): tuple(r)[2:] for r in jt.json_figures(spark.createDataFrame(rows, "g string, j string"), "j", ["g"]).collect()}
    assert got == {("u", "k"): (2, 2, 3.5, 1.75, 1.0, 2.5), ("u", "m"): (1, 0, None, None, None, None), (None, "k"): (1, 0, None, None, None, None)}
    with pytest.raises(ValueError):
        jt.json_figures(spark.createDataFrame(rows, "key string, j string"), "j", ["key"])
