"""Sort, limit and top-k.

Every ``orderBy(...).limit(k)`` here plans as ``TakeOrderedAndProject``: each
task keeps its best ``k`` rows and the driver merges ``k x tasks`` rows, so
no global sort of the table happens. Ties are broken by the row key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellscope import constants as K
from cellscope.functions._util import NUMERIC_TYPES
from cellscope.functions.scalar import route_label


def _order(score: str, tie: Sequence[str], ascending: bool = False) -> list[Column]:
    first = F.asc_nulls_last(score) if ascending else F.desc_nulls_last(score)
    return [first, *[F.asc(t) for t in tie]]


def best_row(df: DataFrame, score: str = K.SCORE_COLUMN, tie: Sequence[str] = ("id",)) -> DataFrame:
    """F1: the row with the highest score (smallest ``id`` on a tie)."""
    return df.orderBy(*_order(score, [t for t in tie if t in df.columns])).limit(1)


def top_k(df: DataFrame, k: int = K.TOP_K, score: str = K.SCORE_COLUMN, tie: Sequence[str] = ("id",),
          label_from: str | None = "id") -> DataFrame:
    """the ``k`` best rows over the whole table, ranked, with a ``Route <id>`` label."""
    out = df.orderBy(*_order(score, [t for t in tie if t in df.columns])).limit(k)
    if label_from and label_from in df.columns:
        out = out.withColumn("label", route_label(label_from))
    return out


def ordered(df: DataFrame, by: Sequence[str | Column], ascending: bool | Sequence[bool] = True) -> DataFrame:
    """the result ordered by any chosen columns (range-partitioned sort)."""
    return df.orderBy(*by, ascending=ascending)


def limit_ordered(df: DataFrame, n: int, by: Sequence[str], ascending: bool = True) -> DataFrame:
    """the first ``n`` rows in a stated order (a top-k, deterministic)."""
    return df.orderBy(*by, ascending=ascending).limit(n)


#: Accuracy of the sketch that finds a preview's threshold.
SKETCH = 20_000
#: Previews of fewer rows are plain top-k.
PREVIEW_PRUNED_FROM = 200


def _before_threshold(df: DataFrame, column: str, n: int, ascending: bool) -> DataFrame:
    """The rows up to a value of ``column`` that at least ``n`` rows reach; ``df`` if none is found.

    One pass counts the rows and sketches their values; where even the last
    of the shares is far more than ``n`` rows, a next pass sketches what it keeps.
    """
    x = F.col(f"`{column}`").cast("double")
    shares = [0.5 ** j for j in range(1, 13)]
    kept = df
    while True:
        found = kept.agg(F.count(x).alias("rows"), F.percentile_approx(x, F.array(*(F.lit(s if ascending else 1 - s) for s in shares)), SKETCH).alias("cuts")).first()
        # A cut is off by a SKETCH-th of the rows at most, so that at least n rows reach it.
        wide = [i for i, s in enumerate(shares) if (s - 2 / SKETCH) * found["rows"] >= n + 1]
        if not wide:
            return kept
        cut = F.lit(found["cuts"][wide[-1]])
        kept = kept.where(x <= cut if ascending else x >= cut)
        if wide[-1] < len(shares) - 1:
            return kept


def preview(df: DataFrame, n: int = K.PREVIEW_ROWS, score: str = K.SCORE_COLUMN,
            tie: Sequence[str] = ("id",), sort_by: str | None = None, ascending: bool = False) -> DataFrame:
    """Bounded preview of a scored result, ordered by score (or by
    ``sort_by``), so that its rows are the same on every run.

    A threshold keeps every task from sending ``n`` rows to one place: the
    rows that are certainly before about the ``2 n``-th in order are ranked,
    if there are ``n`` of them; else (many nulls, another type) all are.
    """
    lead = sort_by or score
    if n >= PREVIEW_PRUNED_FROM and isinstance(df.schema[lead].dataType, NUMERIC_TYPES):
        df = _before_threshold(df, lead, n, ascending)
    if sort_by:
        keys = [F.asc_nulls_last(sort_by) if ascending else F.desc_nulls_last(sort_by),
                *[F.asc(t) for t in tie if t in df.columns]]
    else:
        keys = _order(score, [t for t in tie if t in df.columns], ascending)
    return df.orderBy(*keys).limit(n)
