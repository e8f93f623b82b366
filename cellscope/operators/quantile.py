"""Exact, linearly interpolated quantiles per group, without one-task groups.

Spark's ``percentile`` keeps every distinct value of a group in one
aggregation buffer, which does not scale to a hot group. This operator
computes the same numbers (``x[k0] + (x[k1] - x[k0]) * frac`` with
``h = p * (n - 1)``, ``k0 = floor(h)``, as pandas and DuckDB
``quantile_cont`` do) in distributed steps:

1. One aggregation: ``n`` and an approximate distinct count per group; a
   small table, written to the checkpoint folder.
2. Groups with at most ``max_candidates`` rows or about half as many
   distinct values: ``(group, value)`` counts (a hot value collapses to one
   row), running count over the values of the group (window bounded by the
   distinct count), pick the ranks.
3. Other groups: ``percentile_approx`` brackets ``[lo, hi]`` around each
   probability (rank error of the sketch is at most ``n / accuracy``). One
   more pass over the rows counts those in the gaps between brackets and
   writes the value counts of those inside (about ``10 n / accuracy`` rows a
   bracket) to the checkpoint folder; ranks are found in that small table.
4. A bracket with more than ``max_candidates`` different values is cut into
   cells by a quantile grid of its values, the cells are counted, and only
   those that hold a wanted rank go on, until they are small: each round
   divides them by about ``splitters``, so no round count is given.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellscope.functions._util import checked_broadcast, literal_rows
from cellscope.session import materialize

GROUP_KEY = "_g"


def _rank_cols(n: Column, p: float) -> tuple[Column, Column, Column]:
    h = F.lit(p) * (n - 1).cast("double")
    k0 = F.floor(h).cast("bigint")
    k1 = F.least(k0 + 1, n - 1)
    return k0, k1, h - k0.cast("double")


def _interp(v0: Column, v1: Column, frac: Column) -> Column:
    return F.when(frac == 0, v0).otherwise(v0 + (v1 - v0) * frac)


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (),
                    max_candidates: int = 1 << 17, accuracy: int = 10_000, splitters: int = 1000,
                    group_stats: dict[str, Callable[[Column], Column]] | None = None
                    ) -> DataFrame:
    """Quantiles of ``value`` per ``by`` group: rows ``(*by, p, quantile)``.

    Nulls (and NaN) are ignored; a group with no value gives no rows.
    ``max_candidates`` bounds the rows one task ranks; ``accuracy`` is the
    sketch accuracy of the brackets. ``group_stats`` (name -> aggregate of
    the value column) are computed in the first pass and added to each row.
    """
    keys = list(by) or [GROUP_KEY]
    base = df if by else df.withColumn(GROUP_KEY, F.lit(0))
    data = (base.select(*[F.col(f"`{k}`").alias(k) for k in keys], F.col(f"`{value}`").cast("double").alias("x"))
            .where(F.col("x").isNotNull() & ~F.isnan("x")))
    delta = 4.0 / accuracy
    bounds = []
    for p in probs:
        bounds += [max(0.0, p - delta), min(1.0, p + delta)]
    # Pass A: group sizes and (approximate) distinct counts, a small table.
    extra = {k: f(F.col("x")) for k, f in (group_stats or {}).items()}
    stats = materialize(data.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.approx_count_distinct("x").alias("d"),
        *[agg.alias(k) for k, agg in extra.items()]), "quantile-stats")
    # Groups with few rows or few distinct values are ranked whole from their
    # value counts: a hot value is one row there, whatever its frequency.
    whole = (F.col("n") <= max_candidates) | (F.col("d") <= max_candidates // 2)
    empty = literal_rows(data.sparkSession, [], data.select(*keys).schema.add("p", "double").add("quantile", "double"))
    # One small action: how many groups take each path.
    paths = {r["whole"]: r["count"] for r in stats.groupBy(whole.alias("whole")).count().collect()}
    out = _small_groups(data, stats.where(whole), keys, probs) if paths.get(True, 0) else empty
    large = stats.where(~whole)
    if paths.get(False, 0):
        # Pass B: sketch brackets for the remaining groups only.
        sk = materialize(data.join(checked_broadcast(large.select(*keys)), keys).groupBy(*keys).agg(
            F.percentile_approx("x", F.array(*[F.lit(b) for b in bounds]), accuracy).alias("b")), "quantile-sketch")
        large = materialize(large.select(*keys, "n").join(sk, keys), "quantile-large")
        # Pass C: the last one over the rows.
        coded = materialize(_bracketed(data, large, keys, probs), "quantile-values")
        found = materialize(_ranked(coded, large, keys, probs, max_candidates, splitters, accuracy), "quantile-found")
        out = out.unionByName(found.where(F.col("quantile").isNotNull()))
        # A rank outside its bracket breaks the sketch's promise: then the whole group is ranked.
        missed = materialize(large.join(found.where(F.col("quantile").isNull()).select(*keys).distinct(), keys, "left_semi"),
                             "quantile-missed")
        if not missed.isEmpty():
            every = data.join(checked_broadcast(missed.select(*keys)), keys).groupBy(*keys, F.col("x").alias("v")).agg(
                F.count(F.lit(1)).alias("c")).withColumn("cell", F.lit(0)).withColumn("off", F.lit(0).cast("bigint"))
            redone = _ranked(materialize(every, "quantile-values"), missed, keys, probs, max_candidates, splitters, accuracy)
            out = out.join(missed.select(*keys), keys, "left_anti").unionByName(redone)
    out = materialize(out, "quantiles")
    if extra:
        out = out.join(stats.select(*keys, *extra), keys)
    return out if by else out.drop(GROUP_KEY)


def _small_groups(data: DataFrame, sizes: DataFrame, keys: list[str], probs: Sequence[float]) -> DataFrame:
    """Rank whole groups (value counts and a running count over the group's
    distinct values, at most ``max_candidates`` of them)."""
    sizes = checked_broadcast(sizes.select(*keys, "n"))
    vc = data.join(sizes, keys).groupBy(*keys, "n", "x").agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy(*keys).orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    vc = vc.withColumn("cum", F.sum("c").over(w)).withColumn("start", F.col("cum") - F.col("c"))
    picks = []
    for i, p in enumerate(probs):
        k0, k1, _ = _rank_cols(F.col("n"), p)
        picks.append(F.max(F.when((F.col("start") <= k0) & (k0 < F.col("cum")), F.col("x"))).alias(f"v0_{i}"))
        picks.append(F.max(F.when((F.col("start") <= k1) & (k1 < F.col("cum")), F.col("x"))).alias(f"v1_{i}"))
    per_group = vc.groupBy(*keys, "n").agg(*picks)
    rows = []
    for i, p in enumerate(probs):
        _, _, frac = _rank_cols(F.col("n"), p)
        rows.append(F.struct(F.lit(float(p)).alias("p"),
                             _interp(F.col(f"v0_{i}"), F.col(f"v1_{i}"), frac).alias("quantile")))
    return (per_group.select(*keys, F.explode(F.array(*rows)).alias("r"))
            .select(*keys, "r.p", "r.quantile"))


def _bracket_rows(stats: DataFrame, keys: list[str], probs: Sequence[float]) -> DataFrame:
    rows = []
    for i, p in enumerate(probs):
        k0, k1, frac = _rank_cols(F.col("n"), p)
        rows.append(F.struct(F.lit(float(p)).alias("p"), k0.alias("k0"), k1.alias("k1"), frac.alias("frac"),
                             F.col("b")[2 * i].alias("lo"), F.col("b")[2 * i + 1].alias("hi")))
    return stats.select(*keys, "n", F.explode(F.array(*rows)).alias("r")).select(*keys, "n", "r.*")


def _bracketed(data: DataFrame, stats: DataFrame, keys: list[str], probs: Sequence[float]) -> DataFrame:
    """Pass C: value counts inside the sketch brackets, one count for each gap.

    The brackets of a group are merged into disjoint regions (a handful per
    group, carried as one small array per group), and every row gets a cell:
    odd inside region ``j`` (``2j + 1``), even in the gap after it, whose
    value is null. ``off`` is the rank before the cells: 0.
    """
    br = _bracket_rows(stats, keys, probs)
    w = Window.partitionBy(*keys).orderBy("lo", "hi")
    prev_hi = F.max("hi").over(w.rowsBetween(Window.unboundedPreceding, -1))
    br = (br.withColumn("_new", F.when(prev_hi.isNull() | (F.col("lo") > prev_hi), 1).otherwise(0))
          .withColumn("region", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1)
          .drop("_new"))
    regions = (br.groupBy(*keys, "region").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
               .groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("region", "lo", "hi"))).alias("rg")))
    x = F.col("x")
    code = F.lit(0)
    for j in range(len(probs)):
        r = F.get(F.col("rg"), j)
        code = code + F.when(r["hi"] < x, 2).when(r["lo"] <= x, 1).otherwise(0)
    coded = data.join(checked_broadcast(regions), keys).select(*keys, code.alias("cell"), F.when(code % 2 == 1, x).alias("v"))
    return coded.groupBy(*keys, "cell", "v").agg(F.count(F.lit(1)).alias("c")).withColumn("off", F.lit(0).cast("bigint"))


def _ranked(vc: DataFrame, sizes: DataFrame, keys: list[str], probs: Sequence[float], max_candidates: int,
            splitters: int, accuracy: int) -> DataFrame:
    """(*keys, p, quantile) from value counts ``vc`` (*keys, off, cell, v, c) in cells of ascending values.

    A quantile is null where a rank lies in a cell without values (a gap).
    """
    wanted = []
    for p in probs:
        k0, k1, frac = _rank_cols(F.col("n"), p)
        wanted += [F.struct(F.lit(float(p)).alias("p"), F.lit(side).alias("side"), k.alias("k"), frac.alias("frac"))
                   for side, k in ((0, k0), (1, k1))]
    ranks = sizes.select(*keys, F.explode(F.array(*wanted)).alias("r")).select(*keys, "r.*")
    while True:
        # At most some thousand cells a group.
        cells = vc.groupBy(*keys, "off", "cell").agg(F.sum("c").alias("total"), F.count("v").alias("d"))
        before = Window.partitionBy(*keys, "off").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
        cells = cells.withColumn("below", F.col("off") + F.coalesce(F.sum("total").over(before), F.lit(0)))
        hit = materialize(ranks.join(cells, keys).where((F.col("below") <= F.col("k")) & (F.col("k") < F.col("below") + F.col("total"))),
                          "quantile-cells")
        chosen = hit.select(*keys, "off", "cell", "below").distinct()
        rows = vc.where(F.col("v").isNotNull()).join(checked_broadcast(chosen), [*keys, "off", "cell"])
        if (hit.agg(F.max("d")).first()[0] or 0) <= max_candidates:
            break
        grid = F.array(*[F.lit(i / splitters) for i in range(1, splitters)])
        cuts = materialize(rows.groupBy(*keys, "below").agg(F.percentile_approx("v", grid, accuracy).alias("cuts")), "quantile-cuts")
        cell = F.size(F.filter("cuts", lambda q: q < F.col("v")))
        vc = materialize(rows.join(checked_broadcast(cuts), [*keys, "below"])
                         .select(*keys, F.col("below").alias("off"), cell.alias("cell"), "v", "c"), "quantile-values")
    w = Window.partitionBy(*keys, "below").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.withColumn("cum", F.col("below") + F.sum("c").over(w)).withColumn("start", F.col("cum") - F.col("c"))
    picked = hit.select(*keys, "p", "side", "k", "frac", "below").join(
        placed.select(*keys, "below", "start", "cum", "v"), [*keys, "below"], "left")
    inside = (F.col("start") <= F.col("k")) & (F.col("k") < F.col("cum"))
    at = lambda side: F.max(F.when(inside & (F.col("side") == side), F.col("v")))
    both = picked.groupBy(*keys, "p", "frac").agg(at(0).alias("v0"), at(1).alias("v1"))
    value = F.when(F.col("v0").isNotNull() & F.col("v1").isNotNull(), _interp(F.col("v0"), F.col("v1"), F.col("frac")))
    return both.select(*keys, "p", value.alias("quantile"))


def approx_quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (),
                     accuracy: int = 10_000) -> DataFrame:
    """Sketch quantiles (``percentile_approx``): one pass, bounded memory."""
    keys = list(by)
    arr = F.percentile_approx(F.col(f"`{value}`").cast("double"), F.array(*[F.lit(float(p)) for p in probs]),
                              accuracy)
    g = df.groupBy(*keys).agg(arr.alias("q"))
    rows = F.array(*[F.struct(F.lit(float(p)).alias("p"), F.col("q")[i].alias("quantile"))
                     for i, p in enumerate(probs)])
    return g.select(*keys, F.explode(rows).alias("r")).select(*keys, "r.p", "r.quantile")
