"""Deterministic sampling.

Rows are chosen by a hash of their key and the seed, not by a random number
generator per partition, so the same rows come back after any repartition
or executor loss (a recomputed task picks the same rows).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellscope import constants as K

#: Values of a sample key: 13 hexadecimal digits.
_SCALE = 1 << 52


def hash52(seed: int, *parts: Column) -> Column:
    """The first 13 hex digits of md5 of ``seed|part|...`` as a number below 2^52; nulls are empty text."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long")


def sample_key(key: Sequence[str], seed: int) -> Column:
    """Non-negative 52-bit hash of the key columns and the seed."""
    return hash52(seed, *[F.col(f"`{k}`") for k in key])


def fraction_sample(df: DataFrame, fraction: float, seed: int = K.SAMPLE_SEED, key: Sequence[str] = ("id",),
                    cap: int | None = None) -> DataFrame:
    """G1: Bernoulli sample of about ``fraction`` of the rows (a filter, no shuffle).

    ``cap`` keeps at most that many of the sampled rows (lowest hash first),
    as the map sample does with its 1,000-point limit.
    """
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must be in [0, 1]")
    h = sample_key(key, seed)
    out = df if fraction >= 1.0 else df.where(h < F.lit(int(round(fraction * _SCALE))))
    return out if cap is None else _lowest(out, cap, h, key)


def fixed_size_sample(df: DataFrame, n: int, seed: int = K.SAMPLE_SEED, key: Sequence[str] = ("id",)) -> DataFrame:
    """``min(n, rows)`` rows without replacement: the ``n`` lowest hashes.

    See ``_lowest``: two passes over ``df``, however repeated keys crowd the hashes.
    """
    return _lowest(df, n, sample_key(key, seed), key)


def _lowest(df: DataFrame, n: int, h: Column, key: Sequence[str]) -> DataFrame:
    """The ``n`` rows with the lowest ``h``, ties by ``key``.

    One pass counts the rows by the length of their hash in bits, which says
    exactly how many are below each power of two. Only the rows below the
    least power that ``n`` rows reach are ranked, usually at most ``2 n``, so
    that no task gathers ``n`` rows from every other.
    """
    counts = {r["bits"]: r["count"] for r in df.groupBy(F.length(F.bin(h)).alias("bits")).count().collect()}  # 52 rows at most
    reached, bits = 0, 0
    while bits < _SCALE.bit_length() - 1 and reached < n:
        bits += 1
        reached += counts.get(bits, 0)
    return df.where(h < F.lit(1 << bits)).orderBy(h, *[F.col(f"`{k}`") for k in key]).limit(n)
