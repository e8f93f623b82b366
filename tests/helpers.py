"""Rows of the measurement schema built in code (FIXTURES.md section 5)."""

from __future__ import annotations

from cellscope import constants as K
from cellscope.sources.csv import MEASUREMENT_SCHEMA

BASE = {c: 1.0 for c in K.MEASUREMENT_COLUMNS}
BASE.update({"id": "r0", "timestamp": 1624367008, "device": "pc1", "operator": 1, "area": "Park", "target": 1.0})


def rows(spark, *overrides: dict):
    """A measurement frame; each dict overrides the defaults of one row."""
    data = []
    for i, o in enumerate(overrides):
        r = dict(BASE, id=f"r{i}")
        r.update(o)
        data.append(tuple(r[c] for c in K.MEASUREMENT_COLUMNS))
    return spark.createDataFrame(data, MEASUREMENT_SCHEMA)


def line(**fields) -> str:
    """One raw comma line of the 41 positions; unspecified fields are 1.5."""
    vals = {c: "1.5" for c in K.MEASUREMENT_COLUMNS}
    vals.update({"id": "x", "timestamp": "1624367008", "device": "pc1", "operator": "1", "area": "Park"})
    vals.update({k.replace("__", " "): v for k, v in fields.items()})
    return ",".join(vals[c] for c in K.MEASUREMENT_COLUMNS)
