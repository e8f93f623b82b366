"""Order over a whole table without one-task steps: running aggregates, as-of join.

Rows are cut into ranges of their order; a range holds about as many rows as
any other, whatever key or value is frequent. What a range hands on is one
row a key (its totals, its last event), and a prefix over these few rows
carries it into the later ranges. Operators without keys go by ranges alone.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellscope.session import materialize

#: Aggregates that can be carried: how a range's value and what came before combine.
RUNNING = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}


def _name(taken: Sequence[str], name: str) -> str:
    lower = {c.lower() for c in taken}
    while name in lower:
        name += "_"
    return name


def _cut(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], part: str, row: str, name: str) -> DataFrame:
    """``df`` written in ranges of (keys, order, row number): with its range's number and a unique row number.

    The row number splits rows that are alike in all else; range numbers
    ascend in the order.
    """
    numbered = df.withColumn(row, F.monotonically_increasing_id())
    ranged = numbered.repartitionByRange(*[F.col(f"`{k}`") for k in keys], *order, F.col(row))
    return materialize(ranged.withColumn(part, F.spark_partition_id()), name)


def running(df: DataFrame, order_by: Sequence[Column | str], aggregates: Mapping[str, tuple[str, str]], keys: Sequence[str] = (),
            number: str | None = None) -> DataFrame:
    """Running aggregates from the first row (of each key) up to each row, over a table of any size.

    ``aggregates`` names columns: ``{"best": ("max", "score")}``, with ``sum``,
    ``count``, ``min``, ``max``; nulls are skipped, and before the first value
    the result is null (``count``: 0). ``number`` names a column with the row's
    number from 1. ``order_by`` should decide every tie; rows equal in it are
    numbered in their order of reading. Null keys are one key. An empty table
    gives no rows. Only ``keys`` rows a range meet in one group.
    """
    unknown = {f for f, _ in aggregates.values()} - set(RUNNING)
    if unknown:
        raise ValueError(f"no running form of {sorted(unknown)}")
    part, row, key = _name(df.columns, "range_part"), _name(df.columns, "range_row"), [F.col(f"`{k}`") for k in keys]
    order = [F.col(f"`{c}`") if isinstance(c, str) else c for c in order_by]
    rows = _cut(df, keys, order, part, row, "running-ranges")
    wanted = dict(aggregates) | ({number: ("count", "*")} if number else {})

    def value(column: str) -> Column:
        return F.lit(1) if column == "*" else F.col(f"`{column}`")
    ids = [f"range_k{i}" for i in range(len(keys))]
    totals = rows.groupBy(F.col(part).alias("range_of"), *[k.alias(i) for k, i in zip(key, ids)]).agg(
        *[RUNNING[f](value(c)).alias(f"range_t{i}") for i, (f, c) in enumerate(wanted.values())])
    # One row for each range and key; of a key as many as there are ranges at most.
    earlier = Window.partitionBy(*([F.col(i) for i in ids] or [F.lit(0)])).orderBy("range_of").rowsBetween(Window.unboundedPreceding, -1)
    carried = {f: F.sum if f in ("sum", "count") else RUNNING[f] for f in RUNNING}
    before = totals.select("range_of", *ids, *[carried[f](f"range_t{i}").over(earlier).alias(f"range_b{i}") for i, (f, _) in enumerate(wanted.values())])
    within = Window.partitionBy(part, *key).orderBy(*order, row).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = rows.withColumns({f"range_l{i}": RUNNING[f](value(c)).over(within) for i, (f, c) in enumerate(wanted.values())})
    on = F.col(part) == F.col("range_of")
    for k, i in zip(key, ids):
        on = on & k.eqNullSafe(F.col(i))
    joined = local.join(before, on)

    def both(f: str, i: int) -> Column:
        now, past = F.col(f"range_l{i}"), F.col(f"range_b{i}")
        if f in ("sum", "count"):
            return F.coalesce(now + past, now, past)
        return F.greatest(now, past) if f == "max" else F.least(now, past)
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], *[both(f, i).alias(n) for i, (n, (f, _)) in enumerate(wanted.items())])


def asof_join(left: DataFrame, right: DataFrame, on: Sequence[str], left_time: str, right_time: str, columns: Mapping[str, str],
              before: bool = False, within: Column | None = None) -> DataFrame:
    """Each row of ``left`` with the latest row of ``right`` of the same keys that is not later (``before``: earlier).

    ``columns`` maps new names to columns of ``right``; they are null where
    there is no such row, or where it is older than ``within`` (an interval or
    a number). Of right rows at one time, the one with the greatest values of
    ``columns``, compared in turn, counts. A null key or time matches nothing.
    Rows of ``left`` are kept as they are, repeats and all; names of
    ``columns`` that ``left`` has are an error. With no right rows all new
    columns are null; with no left rows there are no rows.

    Both sides go into common ranges of (keys, time), so a hot key is split;
    the last right row of each range is carried into the later ones.
    """
    if {c.lower() for c in columns} & {c.lower() for c in left.columns}:
        raise ValueError("the left side has columns of these names")
    ids = [f"asof_k{i}" for i in range(len(on))]
    taken = F.struct(F.col(f"`{right_time}`").alias("t"), *[F.col(f"`{c}`").alias(f"v{i}") for i, c in enumerate(columns.values())])
    rights = right.where(F.col(f"`{right_time}`").isNotNull()).dropna(subset=[f"`{k}`" for k in on]).select(
        *[F.col(f"`{k}`").alias(i) for k, i in zip(on, ids)], F.col(f"`{right_time}`").alias("asof_t"), F.lit(2 if before else 0).alias("asof_side"),
        taken.alias("asof_right"))
    lefts = left.select(*[F.col(f"`{k}`").alias(i) for k, i in zip(on, ids)], F.col(f"`{left_time}`").alias("asof_t"), F.lit(1).alias("asof_side"),
                        F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("asof_left"))
    both = lefts.unionByName(rights, allowMissingColumns=True)
    order = [F.col("asof_t"), F.col("asof_side"), F.col("asof_right")]
    rows = _cut(both, ids, order, "asof_part", "asof_row", "asof-ranges")
    local = Window.partitionBy("asof_part", *ids).orderBy(*order, "asof_row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = rows.withColumn("asof_seen", F.last("asof_right", ignorenulls=True).over(local)).where(F.col("asof_side") == 1)
    lasts = rows.where(F.col("asof_side") != 1).groupBy("asof_part", *ids).agg(F.max("asof_right").alias("asof_last"))
    # Ranges that hold a key only on the left need the carried row as well.
    parts = rows.select("asof_part", *ids).distinct().join(lasts, ["asof_part", *ids], "left")
    earlier = Window.partitionBy(*([F.col(i) for i in ids] or [F.lit(0)])).orderBy("asof_part").rowsBetween(Window.unboundedPreceding, -1)
    carry = parts.select("asof_part", *ids, F.last("asof_last", ignorenulls=True).over(earlier).alias("asof_carry"))
    met = seen.join(carry, ["asof_part", *ids], "left").withColumn("asof_found", F.coalesce("asof_seen", "asof_carry"))
    found = F.col("asof_found")
    fits = F.lit(True) if within is None else found["t"] + within >= F.col("asof_t")
    return met.select("asof_left.*", *[F.when(fits, found[f"v{i}"]).alias(n) for i, n in enumerate(columns)])
