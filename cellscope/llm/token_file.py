"""Token ids in a compressed file format, in ascending id order, and their reading.

A file is a Parquet table of segments (part, seq, n_tokens, payload), written
and read by Spark. A segment holds whole documents: their ids and lengths, and
their token ids in blocks of the range coder, each reset and checksummed. Parts
are ranges of ids in ascending order, segments of a part are numbered; so a
document's place in the whole stream follows from the segments' lengths.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellscope.llm.common import held, written
from cellscope.llm.range_coder import BLOCK, LANES, decode_blocks, encode_blocks
from cellscope.llm.token_counts import _tokenizer

#: Tokens of a segment, about: the blocks that are coded in step.
SEGMENT = BLOCK * LANES
CACHE_WORDS, CHUNK_CHARS = 400_000, 12_000_000
#: Texts of these characters only are in normal form, and lower-case letter by letter; their white space is ASCII.
_PLAIN = re.compile("[\\x00-\\x1b\\x20-\\x7eÀ-ÖØ-öø-ÿ¡«»¿‐-‧]*")
_WORDS = re.compile(r"'(?:[stmd]|re|ve|ll)|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")


class WordEncoder:
    """Ids of whole texts by a word BPE file: lower case, white space only separates words.

    Texts of plain Latin characters without "<|" are split here by the file's
    own pattern, and the library encodes each different word once; all others
    go to the library as they are.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer, pre_tokenizers
        self.library = _tokenizer(path)
        #: The library's model alone, for words that are lower-cased and split already.
        self.words = Tokenizer(self.library.model)
        self.words.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.library.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end a word
        self.ends[[i for name, i in vocabulary.items() if name.endswith("</w>")]] = True
        #: Ids of runs without white space (words are such runs), now and before the cache was last full.
        self.cache: dict[str, bytes] = {}
        self.past: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, np.uint32).tobytes() for e in self.library.encode_batch(texts, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> None:
        """Takes the ids of ``words`` into the cache, many by one text: each ends with its only end-of-word id."""
        for k in range(0, len(words), 500):
            part = words[k:k + 500]
            ids = np.array(self.words.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, np.uint32)
            stops = 4 * (np.flatnonzero(self.ends.take(ids)) + 1)
            if len(stops) == len(part) and stops[-1] == 4 * len(ids):
                raw, stops = ids.tobytes(), stops.tolist()
                self.cache.update(zip(part, map(raw.__getitem__, map(slice, [0, *stops], stops))))
            else:
                self.cache.update(zip(part, self._ids(part)))

    def _runs(self, names: list[str]) -> list[bytes]:
        """Ids of different runs of plain lower-case characters."""
        runs = list(map(self.cache.get, names))
        new = [i for i, ids in enumerate(runs) if ids is None]
        if len(self.cache) + len(new) > CACHE_WORDS:
            # A new cache; what is still asked for comes over from the last one.
            self.past, self.cache = self.cache, {name: ids for name, ids in zip(names, runs) if ids is not None}
        cache, past, whole, mixed = self.cache, self.past, [], {}
        for i in new:
            name = names[i]
            if (ids := past.get(name)) is not None:
                cache[name] = ids
            elif name.isalpha():
                whole.append(name)
            else:
                mixed[name] = _WORDS.findall(name)
        self._learn(list(dict.fromkeys(chain(whole, (w for w in chain.from_iterable(mixed.values()) if w not in cache)))))
        for name, words in mixed.items():
            if len(words) != 1:
                cache[name] = b"".join([cache[w] for w in words])
        for i in new:
            runs[i] = cache[names[i]]
        return runs

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of plain texts: of each different run between white space once, then taken by text."""
        lower = [t.lower() for t in texts]
        split = pc.ascii_split_whitespace(pa.array(lower, pa.large_string() if sum(map(len, lower)) > 1 << 28 else pa.string()))
        coded = split.flatten().dictionary_encode()
        runs = self._runs(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        stops = np.cumsum([0, *map(len, runs)]) >> 2
        values = pa.array(np.frombuffer(b"".join(runs), np.uint32))
        ids = pa.LargeListArray.from_arrays(pa.array(stops), values).take(coded.indices).flatten().to_numpy()
        sizes = np.diff(stops).take(coded.indices.to_numpy())
        at = np.concatenate([[0], np.cumsum(sizes)]).take(split.offsets.to_numpy()).tolist()
        return [ids[i:j] for i, j in zip(at, at[1:])]

    def _chunk(self, texts: list[str]) -> Iterator[np.ndarray]:
        plain = [_PLAIN.fullmatch(t) is not None and "<|" not in t for t in texts]
        easy = iter(self._plain([t for t, p in zip(texts, plain) if p]) if any(plain) else [])
        whole = iter(self._ids([t for t, p in zip(texts, plain) if not p]))
        return (next(easy) if p else np.frombuffer(next(whole), np.uint32) for p in plain)

    def __call__(self, texts: Iterator[str | None]) -> Iterator[np.ndarray]:
        part, size = [], 0
        for text in texts:
            part.append(text or "")
            size += len(part[-1])
            if size > CHUNK_CHARS:
                yield from self._chunk(part)
                part, size = [], 0
        yield from self._chunk(part)


def word_encoder(path: str) -> WordEncoder:
    """This Python worker's encoder."""
    return held(("word_bpe", path), lambda: WordEncoder(path))


def _pack(doc_ids: list[int | None], docs: list[np.ndarray]) -> tuple[int, bytes]:
    """(number of tokens, payload): counts, null flags, ids, lengths, sizes of the blocks, blocks."""
    sizes = np.array([len(d) for d in docs], "<u4")
    ids = np.concatenate(docs)
    blocks = encode_blocks([ids[k:k + BLOCK] for k in range(0, len(ids), BLOCK)])
    head = np.array([len(docs), len(blocks)], "<u4").tobytes()
    flags = np.array([d is None for d in doc_ids], np.uint8).tobytes()
    names = np.array([d or 0 for d in doc_ids], "<i8").tobytes()
    return len(ids), b"".join([head, flags, names, sizes.tobytes(), np.array([len(b) for b in blocks], "<u4").tobytes(), *blocks])


def _unpack(payload: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(ids of the documents, their lengths, all token ids)."""
    n, m = (int(x) for x in np.frombuffer(payload[:8], "<u4"))
    flags, names = np.frombuffer(payload, np.uint8, n, 8), np.frombuffer(payload, "<i8", n, 8 + n)
    sizes, lengths = np.frombuffer(payload, "<u4", n, 8 + 9 * n), np.frombuffer(payload, "<u4", m, 8 + 13 * n)
    ends = 8 + 13 * n + 4 * m + np.cumsum(lengths, dtype=np.int64)
    blocks = decode_blocks([payload[e - k:e] for e, k in zip(ends.tolist(), lengths.tolist())])
    return [None if f else int(d) for f, d in zip(flags, names)], sizes, np.concatenate([*blocks, np.array([], np.uint32)])


def write_tokens(docs: DataFrame, encoder: Callable[[], Callable], end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The file of ``docs`` (part, seq, n_tokens, payload), written and opened for reading.

    ``encoder()`` gives, on a worker, a function from texts to arrays of ids;
    ``end_id`` is appended to each document. Documents are in ascending id
    order, null ids first; equal ids in the order of a hash of their texts.
    Null and empty texts are the end id alone. Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    order = ["doc_id", F.xxhash64("text")]  # equal ids need not stay in one range

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, names, held, size, seq, part = encoder(), [], [], 0, 0, 0

        def flush() -> pa.RecordBatch:
            n, payload = _pack(names, held)
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([n], pa.int64()),
                                               pa.array([payload], pa.binary())], ["part", "seq", "n_tokens", "payload"])
        for batch in batches:
            part = batch.column(2)[0].as_py() if batch.num_rows else part
            ids = batch.column(0).to_pylist()
            for name, doc in zip(ids, encode(t.as_py() for t in batch.column(1))):
                names.append(name)
                held.append(np.append(doc, np.uint32(end_id)))
                size += len(doc) + 1
                if size >= SEGMENT:
                    yield flush()
                    names, held, size, seq = [], [], 0, seq + 1
        if names:
            yield flush()

    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    return written(dealt.mapInArrow(run, "part int, seq int, n_tokens long, payload binary"), "token-file")


def read_tokens(file: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document of a file, from its blocks.

    start: tokens of all documents before it. ids_crc32: crc32 of its ids as
    little-endian unsigned 32-bit integers. A damaged block raises an error.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, payload in zip(*(batch.column(i) for i in range(3))):
                names, sizes, ids = _unpack(payload.as_py())
                ends = np.cumsum(sizes, dtype=np.int64)
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), sizes.tolist())]
                n = len(names)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.as_py()] * n, pa.int32()), pa.array([seq.as_py()] * n, pa.int32()), pa.array(names, pa.int64()),
                     pa.array(ends - sizes), pa.array(sizes, pa.int64()), pa.array(crc, pa.int64())],
                    ["part", "seq", "doc_id", "inside", "n_tokens", "ids_crc32"])

    docs = file.select("part", "seq", "payload").mapInArrow(
        run, "part int, seq int, doc_id long, inside long, n_tokens long, ids_crc32 long")
    # Parts are as many as the writer's tasks; segments are summed within a part.
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = file.select("part", "seq", F.col("n_tokens").alias("n"))
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n")).select("part", before(Window.orderBy("part")).alias("part_start"))
    segments = sizes.select("part", "seq", before(Window.partitionBy("part").orderBy("seq")).alias("seq_start"))
    starts = written(segments.join(parts, "part").select("part", "seq", (F.col("part_start") + F.col("seq_start")).alias("at")), "token-starts")
    return docs.join(starts, ["part", "seq"]).select("doc_id", (F.col("at") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
