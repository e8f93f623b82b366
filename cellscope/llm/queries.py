"""The queries ``opN_<name>`` of the training-data operators, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable
from zlib import crc32

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellscope.llm import (byte_bpe, chat_format, cross_polytope, language_id, line_dedup, merkle, mixing, periodic_runs, simhash, threshold_topk, token_counts,
                           token_file, toxicity)
from cellscope.llm.common import ascii_lower, fold_of, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@register
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, max_bits=3)
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


@register
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.line_dedup(docs, min_docs=10, min_chars=1, counts=("n_lines", "n_dropped"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


ORACLES["op1_line_dedup"] = """
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
rows_ AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM split),
keyed AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM rows_),
frequent AS (SELECT key AS gone FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE gone IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN frequent ON key = gone GROUP BY doc_id
"""


@register
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.fit(docs.where(fold_of(F.col("doc_id")) != 1))
    found = docs.select("doc_id", (fold_of(F.col("doc_id")) == 1).alias("held_out"),
                        language_id.predict(spark, model, F.col("text")).alias("p"))
    return found.select("doc_id", "held_out", "p.lang_pred", "p.score")


@register
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix(table(spark, sf_dir, "documents"), weights=(5, 2, 1), share=1.5, cap=2.0, seed=42)
    return plan.select("doc_id", "size", "source_size", "target", "taken")


@register
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    both = table(spark, sf_dir, "documents").select("doc_id", byte_bpe.round_trip(F.col("text"), path, pattern).alias("both"))
    both = both.select("doc_id", "both.ids", "both.decoded")
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@register
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                      public_tokenizers.PATTERN)
    return found.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))


@register
def op6_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_polytope.nearest(table(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0, k=20)


@register
def op7_threshold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return threshold_topk.top_k(table(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0, k=20, scale=64.0)


ORACLES["op7_threshold_topk"] = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))),
pairs AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                 CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
          FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""


@register
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold_of(F.col("doc_id")) == 1
    model = toxicity.fit(docs.where(~held_out), table(spark, sf_dir, "labels").where(~held_out))
    found = docs.select("doc_id", held_out.alias("held_out"), toxicity.score(spark, model, F.col("text")).alias("score"))
    return found.withColumn("predicted", F.when(F.col("score") >= 0.7, 1).otherwise(0))


@register
def op3_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    file = token_file.write_tokens(table(spark, sf_dir, "documents"), lambda: token_file.word_encoder(path), end_id=2)
    return token_file.read_tokens(file)


@register
def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    values = {c: F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")}
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0,
                      merkle.leaf(*(values | {"text": ascii_lower(F.col("text"))}).values()))
    manifest = merkle.build(docs, merkle.leaf(*values.values()), "source", "doc_id", keep=[F.col("doc_id"), tampered.alias("tampered")])
    found = merkle.proofs(manifest)
    folded = found.withColumn("folded_root", merkle.fold(F.coalesce("tampered", "leaf"), F.col("path")))
    return folded.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("path")), 256).alias("proof_sha256"),
                         "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _merkle_sql(levels: int = 7, crown_levels: int = 6) -> str:
    """The trees level by level: as many levels as 16 ** levels leaves a source and 16 ** crown_levels sources need."""
    def value(x: str) -> str:
        return f"coalesce(strlen(CAST({x} AS VARCHAR)) || ':' || CAST({x} AS VARCHAR), '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(value(x) for x in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    def tree(name: str, count: int) -> str:
        """Levels <name>0.. and runs <name>_r0.., from <name>0 (g, pos, n, digest)."""
        return ",\n".join(
            f"{name}_r{k} AS (SELECT g, pos // 16 AS up, any_value(n) AS n, list(digest ORDER BY pos) AS run FROM {name}{k} WHERE n > 1 GROUP BY 1, 2),\n"
            f"{name}{k + 1} AS (SELECT g, up AS pos, (n + 15) // 16 AS n, sha256(array_to_string(run, '')) AS digest FROM {name}_r{k})" for k in range(count))

    def climb(name: str, start: str, count: int, key: str, at: str) -> str:
        """Proof text and folded digest carried up the levels of a tree, from <start> to <name>_p<count>."""
        out, before = [], start
        for k in range(count):
            i = f"((p.{at} // {16 ** k}) % 16)"
            out.append(
                f"{name}_p{k + 1} AS (SELECT p.* EXCLUDE (proof, folded), CASE WHEN run IS NULL THEN proof ELSE proof || "
                f"array_to_string(run[:{i}], '') || array_to_string(run[{i} + 2:], '') END AS proof, CASE WHEN run IS NULL THEN folded ELSE "
                f"sha256(array_to_string(run[:{i}], '') || folded || array_to_string(run[{i} + 2:], '')) END AS folded "
                f"FROM {before} p LEFT JOIN {name}_r{k} r ON r.g = p.{key} AND r.up = p.{at} // {16 ** (k + 1)})")
            before = f"{name}_p{k + 1}"
        return ",\n".join(out)

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    subroots = " UNION ALL ".join(f"SELECT g, digest FROM t{k} WHERE n = 1" for k in range(levels + 1))
    roots = " UNION ALL ".join(f"SELECT digest AS root FROM s{k} WHERE n = 1" for k in range(crown_levels + 1))
    return f"""
WITH codes AS (SELECT list(v ORDER BY i) AS codes FROM (SELECT i, list_reduce([i] || range(8), lambda x, y:
        CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS v FROM range(256) t(i))),
checked AS (SELECT d.*, xor(list_reduce([4294967295] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
        lambda x, y: xor(x >> 8, codes[(xor(x, y) & 255) + 1])), 4294967295) AS crc FROM documents d, codes),
hashed AS (SELECT doc_id, source, {leaf('text')} AS leaf, CASE WHEN crc % 5 = 0 THEN {leaf(lower)} END AS tampered,
        dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g FROM checked),
placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM hashed),
t0 AS (SELECT g, pos, n, leaf AS digest FROM placed),
{tree('t', levels)},
subroots AS ({subroots}),
s0 AS (SELECT 0 AS g, g AS pos, count(*) OVER () AS n, digest FROM subroots),
{tree('s', crown_levels)},
roots AS ({roots}),
begun AS (SELECT doc_id, leaf, g, pos, 0 AS one, '' AS proof, coalesce(tampered, leaf) AS folded FROM placed),
{climb('t', 'begun', levels, 'g', 'pos')},
{climb('s', f't_p{levels}', crown_levels, 'one', 'g')}
SELECT doc_id, leaf, u.digest AS subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM s_p{crown_levels} p JOIN subroots u ON u.g = p.g CROSS JOIN roots
"""


ORACLES["op12_merkle"] = _merkle_sql()


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The contract's periodic tail: where 10 divides crc32 of the id, words from ``a`` on repeat the first ``p`` of them (null ids: none)."""
    h, n = crc32(str(int(doc_id)).encode()) if doc_id is not None else 1, len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * ((n - a) // p + 1))[:n - a]


@register
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(table(spark, sf_dir, "documents").select("doc_id", "text"), min_words=24, min_repeats=3, prepare=planted)
    by_exponent = F.array_sort("runs", lambda x, y: (
        F.when(x["length"] * y["period"] > y["length"] * x["period"], -1).when(x["length"] * y["period"] < y["length"] * x["period"], 1)
        .when(x["start"] < y["start"], -1).when(x["start"] > y["start"], 1).when(x["period"] < y["period"], -1).when(x["period"] > y["period"], 1).otherwise(0)))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"),
                                                                    F.concat(r["period"].cast("string"), F.lit("\n")))), "")
    best = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.get(by_exponent, F.lit(0)).alias("best"),
                        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return best.select("doc_id", "n_runs", "best.start", "best.length", "best.period",
                       F.expr("1000 * best.length div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


@register
def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    told = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                 F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    found = chat_format.windows(rows.unionByName(told), chat_format.bpe_counter(public_tokenizers.path("byte_bpe_50k.json")), budget=1024, history=256)
    return chat_format.digests(chat_format.read_back(found))
