"""Aggregates at several levels, distinct aggregates, and sets of repeated rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellscope.session import materialize

#: Rows that one step of repeating a row makes.
REPEAT = 4096


def _cols(names: Sequence[str]) -> list[Column]:
    return [F.col(f"`{c}`") for c in names]


def rollup_sets(dims: Sequence[str]) -> list[list[str]]:
    return [list(dims[:i]) for i in range(len(dims), -1, -1)]


def cube_sets(dims: Sequence[str]) -> list[list[str]]:
    return [[d for i, d in enumerate(dims) if not m >> i & 1] for m in range(1 << len(dims))]


def grouping_sets(df: DataFrame, dims: Sequence[str], sets: Sequence[Sequence[str]], aggregates: Mapping[str, tuple[str, str]],
                  level: str = "level") -> DataFrame:
    """Aggregates for each of several groupings: the dims, ``level``, the aggregates.

    ``aggregates``: ``{"mean_target": ("avg", "target")}`` with ``count``,
    ``sum``, ``avg``, ``min``, ``max`` (column ``*`` counts rows); nulls are
    skipped. A dim that a grouping leaves out is null, and its bit in
    ``level`` is 1 (the first dim has the highest bit), which tells it from a
    null value. Groupings given twice come twice. An empty table gives no rows,
    for the empty grouping either.

    Rows are grouped once, by all dims, into counts, sums, least and greatest
    values (one row a task and group before the shuffle, so a hot group costs
    no more than another); the groupings are rolled up from these.
    """
    unknown = {f for f, _ in aggregates.values()} - {"count", "sum", "avg", "min", "max"}
    if unknown:
        raise ValueError(f"not an aggregate that can be rolled up: {sorted(unknown)}")
    if any(set(s) - set(dims) for s in sets):
        raise ValueError("a grouping has columns beyond the dims")

    def value(c: str) -> Column:
        return F.lit(1) if c == "*" else F.col(f"`{c}`")
    first = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
    needed = sorted({(f, c) for f0, c in aggregates.values() for f in (("sum", "count") if f0 == "avg" else (f0,))})
    names = {x: f"part_{i}" for i, x in enumerate(needed)}
    finest = df.groupBy(*[c.alias(f"dim_{i}") for i, c in enumerate(_cols(dims))]).agg(*[first[f](value(c)).alias(n) for (f, c), n in names.items()])
    finest = materialize(finest, "finest-groups")

    def merged(f: str, c: str) -> Column:
        if f == "count":
            return F.coalesce(F.sum(names[f, c]), F.lit(0))
        return F.try_divide(F.sum(names["sum", c]), F.sum(names["count", c])) if f == "avg" else first[f](names[f, c])
    ids = [f"dim_{i}" for i in range(len(dims))]
    id_of = dict(zip(dims, ids))
    out = finest.groupingSets([[F.col(id_of[d]) for d in s] for s in sets], *ids).agg(
        F.grouping_id(*ids).cast("long").alias(level), *[merged(f, c).alias(n) for n, (f, c) in aggregates.items()])
    return out.select(*[F.col(i).alias(d) for i, d in zip(ids, dims)], level, *aggregates)


def distinct_aggregates(df: DataFrame, dims: Sequence[str], sets: Sequence[Sequence[str]], columns: Sequence[str], level: str = "level") -> DataFrame:
    """For each grouping and column: ``n_distinct``, ``sum_distinct``, ``n_rows``, ``top_share``.

    One row for each group and column that has a value there; nulls do not
    count. ``sum_distinct`` adds the different values of numeric columns (null
    for others); ``top_share`` is the share of the commonest value in
    ``n_rows``. ``level`` as in ``grouping_sets``. An empty table gives no rows.

    Two stages: rows become one row for each (group, column, value), counted
    in every task before the shuffle and dealt by the value as well, so that
    neither a hot value nor a hot group meets in one task; then each grouping
    merges these, and at last counts them.
    """
    numeric = [c for c in columns if isinstance(df.schema[c].dataType, T.NumericType)]
    told = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value"),
                     (F.col(f"`{c}`").cast("double") if c in numeric else F.lit(None).cast("double")).alias("number")) for c in columns]
    ids = [f"dim_{i}" for i in range(len(dims))]
    long = df.select(*[c.alias(i) for c, i in zip(_cols(dims), ids)], F.inline(F.array(*told))).where("value IS NOT NULL")
    finest = materialize(long.groupBy(*ids, "column", "value", "number").agg(F.count(F.lit(1)).alias("n")), "finest-values")
    id_of, rest = dict(zip(dims, ids)), ["column", "value", "number"]
    values = finest.groupingSets([[*(F.col(id_of[d]) for d in s), *map(F.col, rest)] for s in sets], *ids, *rest).agg(
        F.grouping_id(*ids, *rest).alias("bits"), F.sum("n").alias("n"))
    found = values.groupBy(*ids, "bits", "column").agg(F.count(F.lit(1)).alias("n_distinct"), F.sum("number").alias("sum_distinct"),
                                                       F.sum("n").alias("n_rows"), F.max("n").alias("top"))
    return found.select(*[F.col(i).alias(d) for i, d in zip(ids, dims)], F.shiftright("bits", len(rest)).cast("long").alias(level), "column", "n_distinct",
                        "sum_distinct", "n_rows", (F.col("top") / F.col("n_rows")).alias("top_share"))


def row_counts(one: DataFrame, two: DataFrame, names: tuple[str, str] = ("n_one", "n_two")) -> DataFrame:
    """Each different row of two tables of the same columns, with how often each table has it.

    Columns are matched by name; nulls are equal, NaN is equal to NaN. One
    shuffle, after every task has counted its own repeats.
    """
    if set(one.columns) != set(two.columns) or len(set(one.columns)) != len(one.columns):
        raise ValueError("both tables must have the same columns")
    if {n.lower() for n in names} & {c.lower() for c in one.columns}:
        raise ValueError(f"the tables have columns of the names {names}")
    signed = one.withColumns({names[0]: F.lit(1), names[1]: F.lit(0)}).unionByName(two.withColumns({names[0]: F.lit(0), names[1]: F.lit(1)}))
    return signed.groupBy(*_cols(one.columns)).agg(*[F.sum(n).alias(n) for n in names])


def _repeated(counts: DataFrame, times: Column, columns: Sequence[str]) -> DataFrame:
    """Each row as often as ``times`` says, a bounded number at a time."""
    out = counts.withColumn("repeat_n", times).where("repeat_n > 0")
    out = out.withColumn("repeat_at", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(repeat_n - 1) div {REPEAT}"))))
    left = F.least(F.lit(REPEAT).cast("long"), F.col("repeat_n") - F.col("repeat_at") * REPEAT)
    return out.withColumn("repeat_i", F.explode(F.array_repeat(F.lit(0), left.cast("int")))).select(*_cols(columns))


def multiset_difference(one: DataFrame, two: DataFrame) -> DataFrame:
    """Rows of ``one`` without those of ``two``: a row that is there m and n times stays max(0, m - n) times."""
    counts = row_counts(one, two, ("repeat_one", "repeat_two"))
    return _repeated(counts, F.col("repeat_one") - F.col("repeat_two"), one.columns)


def multiset_intersection(one: DataFrame, two: DataFrame) -> DataFrame:
    """Rows that both have: a row that is there m and n times stays min(m, n) times."""
    counts = row_counts(one, two, ("repeat_one", "repeat_two"))
    return _repeated(counts, F.least("repeat_one", "repeat_two"), one.columns)
