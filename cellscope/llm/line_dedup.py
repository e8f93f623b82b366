"""Line dedup: lines found in many documents lose all their copies everywhere."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellscope.llm.common import SPACE, fresh, task, written

_SPACE = SPACE.encode()
#: A key in at least 1 / HOT_SHARE of all (row, key) pairs is hot: so there are HOT_SHARE hot keys at most.
HOT_SHARE = 10_000


def _digest(line: bytes, min_chars: int) -> bytes | None:
    """128-bit hash of a line's key; None for keys that are too short."""
    key = line.strip(_SPACE).lower()  # bytes: ASCII only
    if len(key) < min_chars or min_chars > 1 and len(key.decode()) < min_chars:
        return None
    return blake2b(key, digest_size=16).digest()


def _places(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, h1, h2, key, at) for each different key of each row of ``docs`` (doc_id, text, h1, h2): its line numbers."""
    given = [docs.schema[c] for c in ("doc_id", "h1", "h2")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> pa.RecordBatch:
            ends = pa.array(np.cumsum([0, *map(len, at)]), pa.int32())
            lines = pa.ListArray.from_arrays(ends, pa.array(np.fromiter(chain.from_iterable(at), np.int32)))
            owners = pa.array(row, pa.int64())
            own = [batch.column(batch.schema.get_field_index(f.name)).take(owners) for f in given]
            return pa.RecordBatch.from_arrays([*own, pa.array(keys, pa.binary()), lines], [*(f.name for f in given), "key", "at"])

        for batch in batches:
            row, keys, at = [], [], []
            for i, text in enumerate(batch.column(batch.schema.get_field_index("text"))):
                found: dict[bytes, list[int]] = {}
                for n, line in enumerate((text.as_py() or "").encode().split(b"\n")):
                    if (key := _digest(line, min_chars)) is not None:
                        found.setdefault(key, []).append(n)
                row += [i] * len(found)
                keys += found.keys()
                at += found.values()
                if len(row) > 100_000:
                    yield rows()
                    row, keys, at = [], [], []
            yield rows()
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in given)
    return docs.mapInArrow(run, f"{columns}, key binary, at array<int>")


def line_dedup(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, id_col: str = "doc_id",
               text_col: str = "text", counts: tuple[str, str] | None = None) -> DataFrame:
    """``docs`` without the lines whose key is in at least ``min_docs`` documents.

    A text is split at line feeds. A line's key is the line without ASCII
    white space at both ends, A-Z lower-cased; keys shorter than ``min_chars``
    code points never count. A document is an id: rows that repeat an id (or
    the null id) count once, and all are cleaned. Null texts are one empty
    line and come back as empty texts; a text that loses all lines is empty.
    Other columns are kept. ``counts`` names two more columns: lines before,
    lines dropped. An empty table gives no rows.

    Scale: each row's different lines are hashed once, to 128 bits, and written
    with their places. A row is known by its id and 128 bits of its text, so
    that rows that repeat an id, or have none, are groups of their own. The
    hashes are shuffled, distinct per document. Of the frequent keys, the hot
    ones (HOT_SHARE at most, by arithmetic) are broadcast to the places and the
    others joined by a shuffle, so that no task gets a hot line's places. The
    documents are shuffled once, and lines go by place, not by another hash.
    """
    id_, h1, h2, dropped, out = (fresh(docs, x) for x in ("line_doc", "line_h1", "line_h2", "line_drops", "line_out"))
    hashes = lambda: (F.xxhash64(text_col), F.xxhash64(F.lit(7), F.col(text_col)))
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *(h.alias(n) for h, n in zip(hashes(), ("h1", "h2"))))
    places = written(_places(narrow, min_chars), "line-places")
    total = places.count()
    frequent = written(places.select("doc_id", "key").distinct().groupBy("key").count().where(F.col("count") >= min_docs), "line-frequent")
    hot = F.col("count") * HOT_SHARE >= total
    drops = (places.join(F.broadcast(frequent.where(hot).select("key")), "key")
             .unionByName(places.join(frequent.where(~hot).select("key"), "key")))
    # A set: rows alike in id and text name the same places.
    per_row = drops.groupBy(F.col("doc_id").alias(id_), F.col("h1").alias(h1), F.col("h2").alias(h2)).agg(
        F.flatten(F.collect_set("at")).alias(dropped))

    @F.pandas_udf("text string, n_lines long, n_dropped long")
    def clean(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        with task():
            for texts, gone in parts:
                rows = []
                for text, drop in zip(texts, gone):
                    lines = (text or "").split("\n")
                    drop = set() if drop is None else set(drop)
                    kept = [x for i, x in enumerate(lines) if i not in drop] if drop else lines
                    rows.append(("\n".join(kept), len(lines), len(lines) - len(kept)))
                yield pd.DataFrame(rows, columns=["text", "n_lines", "n_dropped"])

    same = F.col(id_col).eqNullSafe(F.col(id_))
    for mine, name in zip(hashes(), (h1, h2)):
        same &= mine == F.col(name)
    joined = docs.join(per_row, same, "left").withColumn(out, clean(F.col(text_col), F.col(dropped)))
    more = [F.col(f"{out}.n_lines").alias(counts[0]), F.col(f"{out}.n_dropped").alias(counts[1])] if counts else []
    return joined.select(*(F.col(f"{out}.text").alias(c) if c == text_col else F.col(c) for c in docs.columns), *more)
