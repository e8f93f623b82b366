"""Line dedup, tokenizers, token file, token counts: against brute force and the libraries."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cellscope.llm import byte_bpe, line_dedup, range_coder, token_counts, token_file
from tests.llm.fixtures import awkward, empty, random_text

RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
CHARS = [chr(i) for i in range(0x500)] + ["東", "😀", " ", "'s", "'LL", "<|endoftext|>", "  ", "\n\n"]


def mixed_texts(n: int) -> list[str]:
    rng = random.Random(n)
    return ["".join(rng.choices(CHARS, k=60)) for _ in range(n)] + [random_text(rng, 50) for _ in range(5)] + ["", " ", "a" * 90]


# ---- op1 ------------------------------------------------------------------

def brute_lines(rows, min_docs):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    docs = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            docs.setdefault(key(line), set()).add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not key(x) or len(docs[key(x)]) < min_docs]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("min_docs", [2, 3])
def test_line_dedup_awkward(spark, min_docs):
    docs = awkward(spark)
    got = line_dedup.line_dedup(docs, min_docs=min_docs, counts=("a", "b"))
    assert got.columns == [*docs.columns, "a", "b"]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(((r.doc_id, r.text, r.a, r.b) for r in got.collect()), key=str) == brute_lines(rows, min_docs)
    assert line_dedup.line_dedup(empty(spark)).collect() == []


# ---- op2 ------------------------------------------------------------------

@pytest.fixture(scope="module")
def codec():
    return byte_bpe.Codec(RANKS, PATTERN)


def test_byte_bpe_equals_tiktoken(codec, monkeypatch):
    own = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    texts = [*mixed_texts(150), "ab" * 40, "aaab" * 30, "x" * 64 + "yz" * 30]
    expected = [np.array(own.encode_ordinary(t), np.uint32).tobytes() for t in texts]
    assert codec.encode(texts) == expected
    assert codec.decode(expected) == [t.encode() for t in texts]
    codec.cache.clear()
    monkeypatch.setattr(byte_bpe, "LONG_WORD", 8)  # the form for long words
    assert codec.encode(texts[-40:]) == expected[-40:]
    codec.cache.clear()


def test_byte_bpe_awkward(spark):
    docs = awkward(spark)
    got = docs.select("text", byte_bpe.encode(F.col("text"), RANKS, PATTERN).alias("ids")).select(
        "text", "ids", byte_bpe.decode(F.col("ids"), RANKS, PATTERN).alias("back")).collect()
    assert len(got) == 10 and all(bytes(r.back) == (r.text or "").encode() for r in got)
    both = docs.select("text", byte_bpe.round_trip(F.col("text"), RANKS, PATTERN).alias("b"))
    assert {(r.text, bytes(r.b.ids)) for r in both.collect()} == {(r.text, bytes(r.ids)) for r in got}
    assert empty(spark).select(byte_bpe.encode(F.col("text"), RANKS, PATTERN)).collect() == []


# ---- op3 ------------------------------------------------------------------

def test_range_coder_round_trip_and_checksum():
    rng = np.random.default_rng(1)
    blocks = [np.array([], np.uint32), np.array([7], np.uint32), rng.integers(0, 50_000, 4096).astype(np.uint32),
              np.zeros(4096, np.uint32), (np.arange(4096) * 1_000_003 % (1 << 32)).astype(np.uint32), np.tile(np.arange(30), 100).astype(np.uint32)]
    coded = range_coder.encode_blocks(blocks)
    assert all(np.array_equal(a, b) for a, b in zip(range_coder.decode_blocks(coded), blocks))
    assert len(coded[3]) < 1000 and len(coded[5]) < 1200  # what repeats costs little
    for b in range(0, len(coded[5]), 97):
        broken = coded[5][:b] + bytes([coded[5][b] ^ 1]) + coded[5][b + 1:]
        with pytest.raises(ValueError):
            range_coder.decode_blocks([broken])


def test_word_encoder_equals_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = mixed_texts(300) + ["İ ẞ Σς", "Straße ÀÉ", "it's 12 \x1c x"]
    library = Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)
    assert [list(x) for x in token_file.WordEncoder(path)(iter(texts))] == [e.ids for e in library]


def test_token_file(spark, monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    docs = awkward(spark).repartition(3)
    encoder = lambda: token_file.word_encoder(path)
    got = token_file.read_tokens(token_file.write_tokens(docs, encoder, end_id=2)).collect()
    library = Tokenizer.from_file(path)
    rows = []
    for r in docs.collect():
        ids = np.array(library.encode(r.text or "", add_special_tokens=False).ids + [2], "<u4")
        rows.append((r.doc_id, len(ids), zlib.crc32(ids.tobytes())))
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=str) == sorted(rows, key=str)
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.start for r in ordered] == list(np.cumsum([0, *(r.n_tokens for r in ordered)])[:-1])
    ids = [-1 if r.doc_id is None else r.doc_id for r in ordered]
    assert ids == sorted(ids)
    assert token_file.read_tokens(token_file.write_tokens(empty(spark), encoder, end_id=2)).collect() == []


# ---- op8 ------------------------------------------------------------------

@pytest.mark.parametrize("common", [200_000, 40, 0])
def test_token_counts(spark, monkeypatch, common):
    monkeypatch.setattr(token_counts, "COMMON", common)
    path = public_tokenizers.path("byte_bpe_50k.json")
    extra = spark.createDataFrame([(100 + i, t, None, None, None) for i, t in enumerate(mixed_texts(60))], empty(spark).schema)
    docs = awkward(spark).unionByName(extra, allowMissingColumns=True)
    library = Tokenizer.from_file(path)
    expected = [(r.doc_id, len((r.text or "").encode()), len(library.encode(r.text or "", add_special_tokens=False).ids)) for r in docs.collect()]
    got = [tuple(r) for r in token_counts.token_counts(docs, path, PATTERN).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_token_counts_empty(spark):
    assert token_counts.token_counts(empty(spark), public_tokenizers.path("byte_bpe_50k.json"), PATTERN).collect() == []


def test_digests(spark, sf_small):
    """The registered query's decoded text is the text."""
    from cellscope.llm.queries import QUERIES
    got = {r.doc_id: r.decoded_sha256 for r in QUERIES["op2_byte_bpe"](spark, sf_small).collect()}
    for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect():
        assert got[r.doc_id] == hashlib.sha256(r.text.encode()).hexdigest()
