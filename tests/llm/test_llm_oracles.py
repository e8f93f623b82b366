"""Every opN query that has SQL against DuckDB, and that all are registered."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from cellscope.llm.queries import ORACLES, QUERIES


def test_all_are_registered():
    names = entry.queries()
    assert "pipeline" in names and {int(k[2:].split("_")[0]) for k in QUERIES} == set(range(1, 14)) and set(QUERIES) <= set(names)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_small, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    df = QUERIES[name](spark, sf_small)
    got = sorted(tuple(r) for r in df.collect())
    want = con.execute(ORACLES[name])
    columns = [d[0] for d in want.description]
    order = [columns.index(c) for c in df.columns]
    assert got == sorted(tuple(r[i] for i in order) for r in want.fetchall())
