"""Token counts without token ids: every distinct pre-token is counted once.

Pass 1 finds the distinct pre-tokens with the number of rows that hold each;
the tokenizer counts each once. Pass 2 takes every document's pre-token
frequencies: the COMMON most frequent short pre-tokens are a bounded broadcast
table and are summed in place; all others become (document, pre-token,
frequency) rows, joined to the counts by a shuffle and summed by document.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellscope.llm.common import written
from cellscope.llm.pretokens import splitter

#: The broadcast table has at most COMMON pre-tokens of at most COMMON_CHARS characters: 50 MB, whatever the corpus.
COMMON, COMMON_CHARS = 200_000, 64
#: Distinct pre-tokens that a task of pass 1 holds before it passes them on.
HOLD = 300_000


@lru_cache(2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


@lru_cache(2)
def pieces(path: str, pattern: str) -> Callable[[str], list[str]]:
    """Function that lists a text's pre-tokens; strings of added tokens are pre-tokens of their own."""
    added = _tokenizer(path).get_added_tokens_decoder().values()
    if any(t.single_word or t.lstrip or t.rstrip for t in added):
        raise ValueError("added tokens that take up their surroundings are not supported")
    split = splitter(pattern)
    names = sorted((t.content for t in added), key=len, reverse=True)
    if not names:
        return split
    special = re.compile("(" + "|".join(map(re.escape, names)) + ")")

    def run(text: str) -> list[str]:
        if not special.search(text):
            return split(text)
        return [p for i, part in enumerate(special.split(text)) for p in ([part] if i % 2 else split(part))]
    return run


def _distinct(texts: DataFrame, path: str, pattern: str) -> DataFrame:
    """(piece, n): rows that hold the piece, as partial counts of tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, held = pieces(path, pattern), Counter()
        flush = lambda: pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["piece", "n"])
        for batch in batches:
            for text in batch.column(0):
                held.update(set(split(text.as_py() or "")))
                if len(held) > HOLD:
                    yield flush()
                    held = Counter()
        yield flush()
    return texts.mapInArrow(run, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))


def _counted(distinct: DataFrame, path: str) -> DataFrame:
    """``distinct`` with the number of tokens of each piece."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _tokenizer(path)
        for batch in batches:
            for k in range(0, batch.num_rows, 5000):
                part = batch.slice(k, 5000)
                sizes = [len(e.ids) for e in t.encode_batch(part.column(0).to_pylist(), add_special_tokens=False)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(sizes, pa.int64())], ["piece", "n", "tokens"])
    return distinct.mapInArrow(run, "piece string, n long, tokens long")


def _common(counts: DataFrame) -> DataFrame:
    """The commonest short pieces (piece, tokens), COMMON at most.

    They are all pieces from some frequency on, found from a histogram of the
    frequencies' logarithms (a few hundred rows): no task ranks pieces.
    """
    short = counts.where(F.length("piece") <= COMMON_CHARS).withColumn("step", F.floor(8 * F.log2("n")).cast("int"))
    steps = sorted(((r["step"], r["count"]) for r in short.groupBy("step").count().collect()), reverse=True)
    least, total = None, 0
    for step, n in steps:
        if (total := total + n) > COMMON:
            break
        least = step
    return short.where(F.lit(False) if least is None else F.col("step") >= least).select("piece", "tokens")


def token_counts(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens) for each row of ``docs``.

    n_tokens: as the tokenizers library's file at ``path`` (on every worker)
    encodes the whole text, without added special tokens; special strings
    inside texts count as their token. ``pattern``: the file's split pattern.
    Null and empty texts: 0 bytes, 0 tokens. Null ids and repeated rows come
    back as they are. Other columns are ignored. An empty table gives no rows.
    """
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    counts = written(_counted(_distinct(narrow.select("text"), path, pattern), path), "token-pieces")
    common = _common(counts).toPandas()
    sent = docs.sparkSession.sparkContext.broadcast(dict(zip(common["piece"], common["tokens"].tolist())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, known = pieces(path, pattern), sent.value
        names = ["row", "doc_id", "h", "n_bytes", "tokens", "piece", "n"]
        make = lambda batch, at, *cols: pa.RecordBatch.from_arrays(
            [cols[0], batch.column(0).take(pa.array(at, pa.int64())), batch.column(2).take(pa.array(at, pa.int64())), *cols[1:]], names)
        for batch in batches:
            base, rest = [], []
            for i, text in enumerate(batch.column(1)):
                text, total = text.as_py() or "", 0
                for p, n in Counter(split(text)).items():
                    if (t := known.get(p)) is not None:
                        total += t * n
                    else:
                        rest.append((i, p, n))
                base.append((len(text.encode()), total))
            n_bytes, totals = (pa.array(x, pa.int64()) for x in zip(*base)) if base else (pa.array([], pa.int64()),) * 2
            k = len(base)
            yield make(batch, range(k), pa.array([True] * k, pa.bool_()), n_bytes, totals, pa.nulls(k, pa.string()), pa.nulls(k, pa.int64()))
            for j in range(0, len(rest), 100_000):
                at, piece, n = zip(*rest[j:j + 100_000])
                yield make(batch, at, pa.array([False] * len(at)), n_bytes.take(pa.array(at)), pa.nulls(len(at), pa.int64()),
                           pa.array(piece, pa.string()), pa.array(n, pa.int64()))

    kind = narrow.schema["doc_id"].dataType.simpleString()
    rows = written(narrow.withColumn("h", F.xxhash64("text")).mapInArrow(
        run, f"row boolean, doc_id {kind}, h long, n_bytes long, tokens long, piece string, n long"), "token-rows")
    # Rows that agree in id and text are one group of ``copies``.
    base = rows.where("row").groupBy("doc_id", "h", "n_bytes").agg(F.max("tokens").alias("tokens"), F.count(F.lit(1)).alias("copies"))
    rare = rows.where("NOT row").select("doc_id", "h", "n_bytes", "piece", "n").join(
        counts.select("piece", F.col("tokens").alias("each")), "piece")
    more = rare.groupBy(F.col("doc_id").alias("id2"), F.col("h").alias("h2"), F.col("n_bytes").alias("b2")).agg(
        F.sum(F.col("n") * F.col("each")).alias("more"))
    same = F.col("doc_id").eqNullSafe(F.col("id2")) & (F.col("h") == F.col("h2")) & (F.col("n_bytes") == F.col("b2"))
    total = F.col("tokens") + F.coalesce(F.col("more") / F.col("copies"), F.lit(0)).cast("long")
    return base.join(more, same, "left").withColumn("one", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select(
        "doc_id", "n_bytes", total.alias("n_tokens"))
