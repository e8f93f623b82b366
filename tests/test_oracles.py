"""Every registered query against its DuckDB oracle on the sf0.001 tables,
and the driver contract of ``__spark_entry__``."""

from __future__ import annotations

import math
import os
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from cellscope.queries import ORACLES, QUERIES

TABLES = ["lineitem", "orders", "events"]


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return float(v) + 0.0
    return v


@pytest.fixture(scope="module")
def con(sf_small):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return c


def test_contract():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q) and set(QUERIES) <= set(q) and set(ORACLES) == set(QUERIES) and len(QUERIES) >= 75


def test_entry_without_the_training_data_operators(tmp_path):
    """The subpackage and the pipeline can be deleted: the rest imports and has all its queries."""
    root = Path(entry.__file__).parent
    shutil.copytree(root / "cellscope", tmp_path / "cellscope", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True, env=env)
    assert out.stdout.split() == [str(len(QUERIES)), str(len(ORACLES))]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert len(df.collect()) > 0 and df.columns[:2] == ["area", "hour"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, sf_small, name):
    df = QUERIES[name](spark, sf_small)
    s_cols = df.columns
    s_rows = [tuple(_norm(v) for v in r) for r in df.collect()]
    res = con.execute(ORACLES[name])
    d_cols = [d[0] for d in res.description]
    d_rows = [tuple(_norm(v) for v in r) for r in res.fetchall()]
    assert sorted(s_cols) == sorted(d_cols)
    order = [d_cols.index(c) for c in s_cols]
    d_rows = [tuple(r[i] for i in order) for r in d_rows]
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(s_rows, key=key) == sorted(d_rows, key=key)
