"""Byte-level BPE encoding and decoding with DuckDB recursive queries in each task.

A text is split by the tokenizer's pattern. Each different piece is encoded
once and kept (up to a bound) by the Python worker: a piece that is a token is
that token; the others go to DuckDB, where a recursive query spreads each word
over (word, position, token) rows, joins neighbours to the merge table and
contracts the word's leftmost pair of minimum rank, round by round, until no
pair is in the table. Decoding joins (text, position, id) rows to the token
table and aggregates in order.
"""

from __future__ import annotations

from base64 import b64decode
from collections.abc import Iterator
from itertools import chain

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from cellscope.llm.common import held, task
from cellscope.llm.pretokens import splitter

#: Bytes of pieces encoded by one query, ids decoded by one query.
QUERY_BYTES, QUERY_IDS = 300_000, 500_000
#: Pieces kept by a worker; characters of text split at once.
CACHE_PIECES, CHUNK_CHARS = 250_000, 2_000_000
#: Rows whose results a worker holds at once.
SLICE_ROWS = 2000
#: Words of more bytes contract every occurrence of a pair at once where that is the same.
LONG_WORD = 1024
#: Rounds of one recursive query over long words (it keeps every round's rows).
ROUNDS = 24

# One contraction a word and round; the rank of a merge is the id of its token.
_SHORT = f"""
WITH RECURSIVE t(word, ids, n) AS (
  SELECT word, ids, 0 FROM words
  UNION ALL
  SELECT t.word, ids[:p - 1] || [rank::INT] || ids[p + 2:], n + 1
  FROM t JOIN (
    SELECT word, min((rank << 32) + pos) AS least, least >> 32 AS rank, least & 4294967295 AS p
    FROM (SELECT word, unnest(ids[:-2]) AS l, unnest(ids[2:]) AS r, generate_subscripts(ids[2:], 1) AS pos FROM t WHERE n < {ROUNDS})
    JOIN merges USING (l, r)
    GROUP BY word) USING (word)
)
SELECT word, arg_max(ids, n) AS ids, max(n) < {ROUNDS} AS done FROM t GROUP BY word ORDER BY word
"""

# safe: no pair that holds the merged token ranks lower than this merge, so that
# contracting all occurrences from the left at once gives what contracting the
# leftmost again and again gives. Else only the leftmost. Occurrences overlap
# only in a run of one token: then every other one counts.
_LONG = f"""
WITH RECURSIVE t(word, pos, id, n, done) AS (
  SELECT word, pos, id, 0, false FROM start
  UNION ALL
  SELECT word, pos, CASE WHEN hit THEN best ELSE id END, n + 1, best IS NULL
  FROM (
    SELECT *, lag(hit, 1, false) OVER (PARTITION BY word ORDER BY pos) AS gone
    FROM (
      SELECT *, best IS NOT NULL AND rank IS NOT DISTINCT FROM best AND
                (pos = first OR all_safe AND (id <> right_id OR (nth - run) % 2 = 0)) AS hit
      FROM (
        SELECT *, min(nth) OVER (PARTITION BY word, rank, nth - nth_equal) AS run
        FROM (
          SELECT *, min(rank) OVER w AS best, min(safe) OVER (PARTITION BY word, rank) AS all_safe,
                 min(pos) OVER (PARTITION BY word, rank) AS first,
                 row_number() OVER (PARTITION BY word ORDER BY pos) AS nth,
                 row_number() OVER (PARTITION BY word, rank ORDER BY pos) AS nth_equal
          FROM (SELECT *, lead(id) OVER (PARTITION BY word ORDER BY pos) AS right_id FROM t WHERE NOT done AND n < {ROUNDS})
          LEFT JOIN merges ON l = id AND r = right_id
          WINDOW w AS (PARTITION BY word)
        )
      )
    )
  )
  WHERE NOT gone
)
SELECT word, pos, id, done FROM t WHERE done OR n = {ROUNDS} ORDER BY word, pos
"""

_DECODE = """
SELECT unhex(string_agg(piece, '' ORDER BY pos)) AS bytes
FROM ids JOIN tokens USING (id) GROUP BY doc ORDER BY doc
"""


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank (= id) of a rank file: lines of base64 and a number."""
    with open(path, "rb") as f:
        return {b64decode(a): int(b) for a, b in map(bytes.split, f)}


def _merges(ranks: dict[bytes, int]) -> pa.Table:
    """(l, r, rank, safe) for every way to make a token of two tokens."""
    rows = [(l, r, i) for token, i in ranks.items() for k in range(1, len(token))
            if (l := ranks.get(token[:k])) is not None and (r := ranks.get(token[k:])) is not None]
    left, right, rank = np.array(rows, np.int64).reshape(-1, 3).T
    lowest = np.full(max(ranks.values(), default=0) + 1, np.iinfo(np.int64).max)
    np.minimum.at(lowest, left, rank)
    np.minimum.at(lowest, right, rank)
    return pa.table({"l": left.astype(np.int32), "r": right.astype(np.int32), "rank": rank, "safe": lowest[rank] > rank})


class Codec:
    """Encodes and decodes whole texts; one for each Python worker."""

    def __init__(self, path: str, pattern: str) -> None:
        self.ranks = load_ranks(path)
        self.split = splitter(pattern)
        self.byte_id = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        self.cache: dict[str, bytes] = {}
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "300MB", "temp_directory": ""})
        for name, data in (("merges", _merges(self.ranks)),
                           ("tokens", pa.table({"id": pa.array(list(self.ranks.values()), pa.int32()),
                                                "piece": [t.hex() for t in self.ranks]}))):
            self.con.register("given", data)
            self.con.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
            self.con.unregister("given")

    def _ask(self, name: str, data: pa.Table, sql: str) -> pa.Table:
        self.con.register(name, data)
        try:
            return self.con.sql(sql).to_arrow_table()
        finally:
            self.con.unregister(name)

    def _contract_short(self, words: list[bytes]) -> list[bytes]:
        out: dict[int, bytes] = {}
        word = np.arange(len(words), dtype=np.int32)
        ids = self.byte_id[np.frombuffer(b"".join(words), np.uint8)]
        size = np.array([len(w) for w in words])
        while len(word):
            ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
            got = self._ask("words", pa.table({"word": word, "ids": pa.ListArray.from_arrays(ends, pa.array(ids))}), _SHORT)
            lists, word, done = got["ids"].combine_chunks(), got["word"].to_numpy(), got["done"].to_numpy()
            ids, size = np.asarray(lists.flatten(), np.int32), np.asarray(lists.value_lengths(), np.int64)
            data, at = ids.astype(np.uint32).tobytes(), 4 * np.cumsum(size)
            for i in np.nonzero(done)[0]:
                out[word[i]] = data[at[i] - 4 * size[i]:at[i]]
            ids, word, size = ids[~np.repeat(done, size)], word[~done], size[~done]
        return [out[i] for i in range(len(words))]

    def _contract_long(self, words: list[bytes]) -> list[bytes]:
        out: dict[int, bytes] = {}
        size = np.array([len(w) for w in words])
        word, pos = np.repeat(np.arange(len(words)), size), np.concatenate([np.arange(n) for n in size])
        ids = self.byte_id[np.frombuffer(b"".join(words), np.uint8)]
        while len(word):
            got = self._ask("start", pa.table({"word": word, "pos": pos, "id": ids.astype(np.int32)}), _LONG)
            word, pos, ids, done = (got[c].to_numpy() for c in ("word", "pos", "id", "done"))
            for w in np.unique(word[done]):
                out[int(w)] = ids[(word == w) & done].astype(np.uint32).tobytes()
            word, pos, ids = word[~done], pos[~done], ids[~done]
        return [out[i] for i in range(len(words))]

    def _learn(self, pieces: list[str]) -> None:
        new = [(p, p.encode()) for p in pieces]
        for p, b in new:
            if (i := self.ranks.get(b)) is not None:
                self.cache[p] = i.to_bytes(4, "little")
        rest = [(p, b) for p, b in new if p not in self.cache]
        for contract, own in ((self._contract_short, [x for x in rest if len(x[1]) <= LONG_WORD]),
                              (self._contract_long, [x for x in rest if len(x[1]) > LONG_WORD])):
            part, size = [], 0
            for x in own:
                part.append(x)
                size += len(x[1])
                if size > QUERY_BYTES:
                    self.cache.update(zip((p for p, _ in part), contract([b for _, b in part])))
                    part, size = [], 0
            if part:
                self.cache.update(zip((p for p, _ in part), contract([b for _, b in part])))

    def _encode_chunk(self, texts: list[str]) -> list[bytes]:
        if len(self.cache) > CACHE_PIECES:
            self.cache.clear()
        split = [self.split(t) for t in texts]
        self._learn([p for p in dict.fromkeys(chain.from_iterable(split)) if p not in self.cache])
        get = self.cache.__getitem__
        return [b"".join(map(get, s)) for s in split]

    def encode(self, texts: Iterator[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        out, part, size = [], [], 0
        for text in texts:
            part.append(text or "")
            size += len(part[-1])
            if size > CHUNK_CHARS:
                out += self._encode_chunk(part)
                part, size = [], 0
        return out + self._encode_chunk(part)

    def _decode_rows(self, rows: list[bytes]) -> list[bytes]:
        """The bytes of each (non-empty) row of ids."""
        ids = np.frombuffer(b"".join(rows), np.uint32)
        doc = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r) // 4 for r in rows])
        got = self._ask("ids", pa.table({"doc": doc, "pos": np.arange(len(ids)), "id": ids.astype(np.int32)}), _DECODE)
        return got["bytes"].to_pylist()

    def decode(self, rows: Iterator[bytes | None]) -> list[bytes]:
        """The bytes of each row of packed ids; long rows go in parts."""
        parts, owner, out = [], [], []
        for i, row in enumerate(rows):
            out.append([])
            for k in range(0, len(row or b""), 4 * QUERY_IDS):
                parts.append(row[k:k + 4 * QUERY_IDS])
                owner.append(i)
        part, size, first = [], 0, 0
        for n, p in enumerate(parts):
            part.append(p)
            size += len(p)
            if size > 4 * QUERY_IDS or n == len(parts) - 1:
                for i, b in zip(owner[first:], self._decode_rows(part)):
                    out[i].append(b)
                part, size, first = [], 0, n + 1
        return [b"".join(x) for x in out]


def codec(path: str, pattern: str) -> Codec:
    """This Python worker's codec."""
    return held(("byte_bpe", path, pattern), lambda: Codec(path, pattern))


def _slices(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Batches in slices of rows: ids and bytes of a whole batch would be held at once."""
    for part in parts:
        for i in range(0, len(part), SLICE_ROWS):
            yield part.iloc[i:i + SLICE_ROWS]


def encode(text: Column, path: str, pattern: str) -> Column:
    """Token ids of each whole text as binary: little-endian unsigned 32-bit integers.

    As tiktoken's ``encode_ordinary`` with the rank file at ``path`` (on every
    worker). Null and empty texts have no ids (empty binary).
    """
    @F.pandas_udf("binary")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        from cellscope.llm.byte_bpe import codec
        with task():
            for part in _slices(parts):
                yield pd.Series(codec(path, pattern).encode(part), dtype=object)
    return run(text)


def decode(ids: Column, path: str, pattern: str) -> Column:
    """Bytes of the tokens of packed ids, as ``encode`` gives them; null: empty."""
    @F.pandas_udf("binary")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        from cellscope.llm.byte_bpe import codec
        with task():
            for part in _slices(parts):
                yield pd.Series(codec(path, pattern).decode(part), dtype=object)
    return run(ids)


def round_trip(text: Column, path: str, pattern: str) -> Column:
    """struct(ids, decoded): ``encode`` of the text and ``decode`` of these ids, by one worker with one codec.

    Null and empty texts give empty ids and bytes; long texts go in parts.
    Each row stands alone: repeated rows give the same, an empty table nothing.
    """
    @F.pandas_udf("ids binary, decoded binary")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        from cellscope.llm.byte_bpe import codec
        with task():
            for part in _slices(parts):
                ids = codec(path, pattern).encode(part)
                yield pd.DataFrame({"ids": ids, "decoded": codec(path, pattern).decode(ids)}, dtype=object)
    return run(text)
