"""Small awkward document tables."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators might use inside.
CLASHES = ["fp", "h", "key", "size", "bucket", "piece", "count", "component_id", "line_out", "mix_copies", "tokens", "rank", "score"]


def random_text(rng: random.Random, words: int, alphabet: str = "abcdefgh") -> str:
    return " ".join("".join(rng.choices(alphabet, k=rng.randint(2, 8))) for _ in range(words))


def awkward(spark):
    """Nulls in every column, empty and long texts, repeated rows and ids, clashing extra columns."""
    rng = random.Random(3)
    long = "\n".join(random_text(rng, 60) for _ in range(300))
    rows = [(1, "Hello World, this is it.\n the same line \nend", "en", "a", 1), (1, "Hello World, this is it.\n the same line \nend", "en", "a", 1),
            (2, None, "en", "b", None), (None, "The Same Line", None, "b", 3), (3, "", "fr", None, 0), (4, " \t\n", None, None, 2),
            (5, long, "de", "a", len(long)), (6, "THE SAME LINE\x0b\nélan 東京 ½ 123!!", "fr", "c", 9), (None, None, None, None, None),
            (1, "another text under id one", "en", "c", 5)]
    df = spark.createDataFrame(rows, SCHEMA)
    for c in CLASHES:
        df = df.withColumn(c, F.lit(7))
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
