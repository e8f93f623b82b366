"""The Merkle manifest against a tree built in plain Python."""

from __future__ import annotations

from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from cellscope.llm import merkle
from cellscope.llm.queries import QUERIES
from tests.llm.fixtures import awkward, empty

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def hex_of(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def leaf_of(row) -> str:
    return hex_of("".join("-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in FIELDS))


def tree(nodes: list[str], fanout: int) -> tuple[str, list[list[tuple[str, str]]]]:
    """The root and each leaf's path."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for leaf, i in enumerate(at):
            lo = i // fanout * fanout
            paths[leaf].append(("".join(nodes[lo:i]), "".join(nodes[i + 1:lo + fanout])))
        nodes = [hex_of("".join(nodes[i:i + fanout])) for i in range(0, len(nodes), fanout)]
        at = [i // fanout for i in at]
    return nodes[0], paths


def manifest_rows(rows, fanout: int):
    groups: dict = {}
    for r in rows:
        groups.setdefault(r["source"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r), r["doc_id"]))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    sub = [tree([x[2] for x in sorted(groups[s], key=lambda x: x[:3])], fanout) for s in order]
    root, above = tree([s[0] for s in sub], fanout)
    return sorted(((x[3] is not None, x[3] or 0, x[2], subroot, root, tuple(path + up)) for s, (subroot, paths), up in zip(order, sub, above)
                   for x, path in zip(sorted(groups[s], key=lambda x: x[:3]), paths)))


def found(docs, fanout: int, stride: int):
    m = merkle.build(docs, merkle.leaf(*(F.col(c) for c in FIELDS)), "source", "doc_id", [F.col("doc_id")], fanout, stride)
    out = merkle.proofs(m).withColumn("folded", merkle.fold(F.col("leaf"), F.col("path"))).collect()
    assert all(r["folded"] == r["root"] for r in out)
    return sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["leaf"], r["subroot"], r["root"], tuple(tuple(x) for x in r["path"])) for r in out)


@pytest.mark.parametrize("fanout, stride", [(2, 1), (2, 3), (3, 2), (16, 2)])
def test_equals_a_plain_tree(spark, fanout, stride):
    docs = awkward(spark)
    more = spark.range(40).select((F.col("id") % 37).alias("doc_id"), F.concat(F.lit("t"), F.col("id") % 5).alias("text"), F.lit("en").alias("lang"),
                                  F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 7 == 0, F.concat(F.lit("é"), F.col("id"))).otherwise("").alias("source"),
                                  F.lit(1).cast("long").alias("n_chars"))
    docs = docs.unionByName(more, allowMissingColumns=True)
    assert found(docs, fanout, stride) == manifest_rows(docs.select(*FIELDS).collect(), fanout)


def test_one_row_and_none(spark):
    one = awkward(spark).where("doc_id = 5")
    rows = found(one, 16, 2)
    assert len(rows) == 1 and rows[0][2] == rows[0][3] == rows[0][4] and rows[0][5] == ()
    assert found(empty(spark), 16, 2) == []


def test_tampering_is_found(spark, sf_small):
    rows = QUERIES["op12_merkle"](spark, sf_small).collect()
    changed = [r for r in rows if not r["verified"]]
    assert 0 < len(changed) < len(rows) and all(r["folded_root"] != r["root"] for r in changed) and len({r["root"] for r in rows}) == 1
