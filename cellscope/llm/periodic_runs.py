"""Periodic runs of words: stretches that repeat a block of words several times over.

A period octave is the periods from 2^k to 2^(k+1) - 1. For each octave, a
document's words are cut into overlapping tiles around boundaries that are so
close that every long enough stretch of matches ``word[i] == word[i + q]``
holds one. A tile is solved alone: Z-functions of the words after and before
its boundary give, for each period, the matches around the boundary. What
reaches the next boundary is a fragment; fragments of a document and period
are stitched to whole stretches after a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cellscope.llm.common import fresh, written

Prepare = Callable[[object, list[bytes]], list[bytes]]
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Array elements and tile bytes that a task holds at once, beside one tile.
_CHUNK, _BYTES = 1 << 20, 4 << 20


def words_of(text: str | None) -> list[bytes]:
    """The words between ASCII white space."""
    return text.encode().split() if text else []


class Octaves:
    """Boundaries and tiles of runs of at least ``min_words`` words and ``min_repeats`` periods (2 or more)."""

    def __init__(self, min_words: int, min_repeats: int):
        if min_repeats < 2 or min_words < 1:
            raise ValueError("a run has two periods and one word at least")
        self.min_words, self.min_repeats = min_words, min_repeats
        self._steps = [self.step(k) for k in range(48)]

    def matches(self, q: int) -> int:
        """The matches that a run of period ``q`` has at least."""
        return max(self.min_words - q, (self.min_repeats - 1) * q)

    def step(self, k: int) -> int:
        """Distance of the boundaries: the fewest matches that a run of the octave has."""
        low, high, turn = 1 << k, (2 << k) - 1, self.min_words // self.min_repeats
        return min(self.matches(min(max(q, low), high)) for q in (low, high, turn, turn + 1))

    def alive(self, ids: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(octave, boundary, first, last + 1) of each tile in which some period matches a whole gram beside the boundary.

        ``ids``: a number for each word, the same for the same word. Of a
        stretch that holds a boundary, at least half lies on one side of it,
        so no run is missed; equal grams are told by a hash, so a tile may be
        solved in vain.
        """
        n = len(ids)
        if n < self.min_words:
            return
        last = (n // self.min_repeats).bit_length()
        least, gram, grams = min(self._steps[:max(1, last)]), 1, ids.astype(np.uint64) * _MIX + _MIX
        while 4 * gram <= least:
            grams = (grams[:-gram] ^ (grams[:-gram] >> np.uint64(29))) * _MIX + grams[gram:]
            gram *= 2
        ordered = np.sort(grams)
        if not (ordered[1:] == ordered[:-1]).any():
            return
        for k in range(last):
            low, high, step = 1 << k, min((2 << k) - 1, n // self.min_repeats), self.step(k)
            width = high - low + 1
            padded = np.concatenate([grams, np.zeros(width + gram + step, np.uint64)])
            view = np.lib.stride_tricks.sliding_window_view(padded, width)
            at = np.arange(0, n - low, step)
            for part in np.array_split(at, max(1, len(at) * width // _CHUNK)):
                right = (view[part + low] == padded[part][:, None]).any(axis=1) & (part + low + gram <= n)
                back = np.maximum(part - gram, 0)
                left = (view[back + low] == padded[back][:, None]).any(axis=1) & (part >= gram)
                for c in part[right | left].tolist():
                    yield k, c, max(0, c - step), min(n, c + step + high)


def z_function(s: list[int]) -> list[int]:
    """For each position, how long ``s`` from there equals ``s`` from its start."""
    n = len(s)
    z, left, right = [0] * n, 0, 0
    for i in range(1, n):
        k = min(z[i - left], right - i) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        if i + k > right:
            left, right = i, i + k
        z[i] = k
    return z


def has_shorter_period(ids: np.ndarray, low: int) -> bool:
    """Whether all ``ids`` have a period below ``low``, as far as the first few repeats of their first number tell.

    Such a tile gives nothing: any period of its octave that matches around
    the boundary is then a multiple of a shorter one.
    """
    near = np.flatnonzero(ids[1:low] == ids[0])[:8] + 1
    return any(np.array_equal(ids[d:], ids[:-d]) for d in near.tolist())


def solve(octaves: Octaves, k: int, c: int, first: int, n: int, ids: list[int]) -> Iterator[tuple[int, int, int]]:
    """(period, start, stop) of the stretches of matches that hold boundary ``c``, seen one step to each side.

    Stretches that end within the tile's steps and are too short are left out;
    those that reach a neighbouring boundary are fragments of any length. A
    period is left out where a divisor of it is a period of the same words:
    they are two periods long at least, so the divisor holds for the whole
    stretch, and every tile leaves its fragment out.
    """
    step, low, high = octaves.step(k), 1 << k, min((2 << k) - 1, n // octaves.min_repeats, n - 1 - c)
    if high < low:
        return
    cut = c - first
    after = z_function(ids[cut:cut + step + high])
    before = ids[:cut][::-1]
    behind = z_function(before + [-1] + ids[:cut + high][::-1])
    for q in range(low, high + 1):
        f, b = min(after[q], step), min(behind[cut + 1 + high - q], step)
        if f and (f == step or b == step or f + b >= octaves.matches(q)):
            if not any(after[d] >= f + q - d and behind[cut + 1 + high - d] >= b for d in _largest_divisors(q)):
                yield q, c - b, c + f


@lru_cache(1 << 16)
def _largest_divisors(q: int) -> list[int]:
    """``q`` divided by each of its prime factors."""
    out, rest, p = [], q, 2
    while p * p <= rest:
        if rest % p == 0:
            out.append(q // p)
            while rest % p == 0:
                rest //= p
        p += 1
    return out + [q // rest] * (rest > 1)


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(hash, words), np.int64, len(words))


def _ids(words: list[bytes]) -> np.ndarray:
    names: dict[bytes, int] = {}
    return np.fromiter((names.setdefault(w, len(names)) for w in words), np.int32, len(words))


def _tiles(docs: DataFrame, octaves: Octaves, prepare: Prepare | None) -> DataFrame:
    """The live tiles of ``docs`` (key, id, text), each with its words' numbers."""
    schema = pa.schema([("key", pa.binary()), ("octave", pa.int32()), ("boundary", pa.int64()), ("first", pa.int64()), ("n", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for key, name, text in zip(*(batch.column(i) for i in range(3))):
                words = words_of(text.as_py())
                words, ids = prepare(name.as_py(), words) if prepare else words, None
                for k, c, first, stop in octaves.alive(_hashes(words)):
                    ids = _ids(words) if ids is None else ids
                    if has_shorter_period(ids[first:stop], 1 << k):
                        continue
                    rows.append((key.as_py(), k, c, first, len(ids), ids[first:stop].astype("<i4").tobytes()))
                    held += len(rows[-1][-1]) + 64
                    if held > _BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), schema.types)], schema=schema)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), schema.types)], schema=schema)
    return docs.mapInArrow(run, "key binary, octave int, boundary long, first long, n long, ids binary")


def _solved(tiles: DataFrame, octaves: Octaves) -> DataFrame:
    schema = pa.schema([("key", pa.binary()), ("period", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, k, c, first, n, ids in zip(*(batch.column(x) for x in ("key", "octave", "boundary", "first", "n", "ids"))):
                words = np.frombuffer(ids.as_py(), "<i4").tolist()
                rows += [(key.as_py(), *x) for x in solve(octaves, k.as_py(), c.as_py(), first.as_py(), n.as_py(), words)]
                if len(rows) > 100_000:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), schema.types)], schema=schema)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), schema.types)], schema=schema)
    return tiles.mapInArrow(run, "key binary, period long, start long, stop long")


def _stitched(fragments: DataFrame, octaves: Octaves) -> DataFrame:
    """(key, runs): fragments that overlap or touch are one stretch."""
    order = Window.partitionBy("key", "period").orderBy("start", "stop")
    reach = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    parts = fragments.withColumn("begins", (reach.isNull() | (F.col("start") > reach)).cast("long"))
    parts = parts.withColumn("stretch", F.sum("begins").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    whole = parts.groupBy("key", "period", "stretch").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    q = F.col("period")
    runs = whole.where(F.col("stop") - F.col("start") >= F.greatest(octaves.min_words - q, (octaves.min_repeats - 1) * q))
    ordered = F.sort_array(F.collect_list(F.struct("start", "period", (F.col("stop") - F.col("start") + q).alias("length"))))
    return runs.groupBy("key").agg(F.transform(ordered, lambda r: F.struct(r["start"].alias("start"), r["length"].alias("length"), r["period"].alias("period"))).alias("runs"))


def _live(docs: DataFrame, octaves: Octaves, prepare: Prepare | None, at: tuple[int, int]) -> DataFrame:
    """The rows of ``docs`` that have live tiles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for name, text in zip(*(batch.column(i) for i in at)):
                words = words_of(text.as_py())
                keep.append(next(octaves.alive(_hashes(prepare(name.as_py(), words) if prepare else words)), None) is not None)
            yield batch.filter(pa.array(keep, pa.bool_()))
    return docs.mapInArrow(run, docs.schema)


def _plain(docs: DataFrame, octaves: Octaves, prepare: Prepare | None, at: tuple[int, int], out: StructType) -> DataFrame:
    """The other rows, with no runs and all their words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans = pa.list_(pa.struct([(x, pa.int64()) for x in ("start", "length", "period")]))
        for batch in batches:
            keep, texts = [], []
            for name, text in zip(*(batch.column(i) for i in at)):
                words = words_of(text.as_py())
                words = prepare(name.as_py(), words) if prepare else words
                keep.append(next(octaves.alive(_hashes(words)), None) is None)
                if keep[-1]:
                    texts.append(b" ".join(words).decode())
            rest = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array([[]] * len(texts), spans), pa.array(texts, pa.string())], out.names)
    return docs.mapInArrow(run, out)


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """``words`` without those that a run (start, length, period) repeats: of each run its first period stays."""
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    return [w for w, g in zip(words, np.cumsum(gone).tolist()) if not g]


def periodic_runs(docs: DataFrame, min_words: int = 24, min_repeats: int = 3, id_col: str = "doc_id", text_col: str = "text",
                  prepare: Prepare | None = None, names: tuple[str, str] = ("runs", "collapsed")) -> DataFrame:
    """``docs`` with two more columns: the runs of each text, and the text without their repetitions.

    A run is a maximal stretch of words with smallest period ``period`` and
    ``length`` of at least ``min_words`` and ``min_repeats`` periods. ``runs``
    lists (start, length, period) by start, then period; ``collapsed`` joins
    the words that no run holds beyond its first period by single spaces.
    ``prepare`` (id, words) may change the words first; it must depend on
    these alone. Null and empty texts have no runs and collapse to an empty
    text. Rows that repeat an id are rows of their own; rows alike in id and
    text are solved as one. Columns named as the new ones are an error. An
    empty table gives no rows.

    Scale: work is in proportion to words times octaves. Documents without a
    repeated gram are done where they are read. Tiles are dealt out by
    document and boundary, so those of a very long text are solved by many
    tasks, and fragments by document and period. Only documents with live
    tiles are shuffled, by a digest of id and text, to meet their runs.
    """
    octaves = Octaves(min_words, min_repeats)
    if {x.lower() for x in names} & {c.lower() for c in docs.columns}:
        raise ValueError(f"columns named as the new ones: {names}")
    key = fresh(docs, "run_key")
    keyed = docs.withColumn(key, F.unhex(F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("-")), F.lit("|"), F.coalesce(F.col(text_col), F.lit("")))
                                               .cast("binary"))))
    tiles = _tiles(keyed.select(F.col(key).alias("key"), F.col(id_col).alias("id"), F.col(text_col).alias("text")), octaves, prepare)
    fragments = _solved(tiles.repartition("key", "octave", "boundary"), octaves)
    found = written(_stitched(fragments, octaves), "periodic-runs").select(F.col("key").alias(fresh(keyed, "run_of")), F.col("runs").alias(names[0]))
    runs_type = found.schema[names[0]].dataType
    at = (docs.columns.index(id_col), docs.columns.index(text_col))
    live = _live(keyed, octaves, prepare, at).join(found, F.col(key) == F.col(found.columns[0]), "left")
    live = live.select(*docs.columns, F.coalesce(F.col(names[0]), F.array().cast(runs_type)).alias(names[0]))
    out = StructType([*live.schema.fields, StructField(names[1], StringType())])

    def collapsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for name, text, spans in zip(*(batch.column(i) for i in (*at, len(out) - 2))):
                words = words_of(text.as_py())
                words = prepare(name.as_py(), words) if prepare else words
                texts.append(b" ".join(collapse(words, [(r["start"], r["length"], r["period"]) for r in spans.as_py()])).decode())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], out.names)
    return live.mapInArrow(collapsed, out).unionByName(_plain(docs, octaves, prepare, at, out))
