"""Joins by nearness: points in intervals, pairs within a distance of two numbers.

Both turn the inequality into an equality of cells, so that Spark joins by a
hash shuffle, and test the exact condition on what meets in a cell.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellscope.functions._util import checked_broadcast
from cellscope.operators.ranges import RUNNING, _cut
from cellscope.session import materialize

#: Cells of one level are this many times as wide as those of the level below.
LEVEL = 4
#: The same for totals, where an interval may cover so many cells whole.
TOTALS_LEVEL = 16
#: Cells of a band join are so many times as wide as its reach.
BAND_STEP = 2
#: Rows of one side that meet in a cell before it is split.
DENSE = 10_000


def _number(df: DataFrame, column: str) -> Column:
    """Seconds of a date or time, or the number itself, as a double; NaN and infinities are null."""
    c, kind = F.col(f"`{column}`"), df.schema[column].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_micros(c.cast("timestamp")) / 1e6
    x = c.cast("double")
    return F.when(F.abs(x) < float("inf"), x)


def _same(left: Sequence[str], right: Sequence[str]) -> Column:
    return F.lit(True) if not left else F.expr(" AND ".join(f"{a} <=> {b}" for a, b in zip(left, right)))


def interval_join(points: DataFrame, intervals: DataFrame, point: str, start: str, stop: str, on: Sequence[str] = (), closed: bool = False,
                  how: str = "inner", totals: Mapping[str, tuple[str, str]] | None = None) -> DataFrame:
    """Each point with each interval that holds it: ``start <= point < stop`` (``closed``: ``<= stop``), and equal ``on``.

    Columns of ``points``, then those of ``intervals`` (without ``on``); clashing
    names are an error. Nulls, in keys too, and NaN match nothing; intervals
    that end before they start are empty. ``how``: ``inner``, or ``left`` to
    keep points in no interval. Repeated rows match as often as they are there.

    An interval belongs to a level by its length: cells there are at least as
    long, so it covers two or three. A point goes to one cell of each level in
    use (at most 64, one small aggregate finds them); long intervals so cost
    no more rows than short ones. Cells full of points and intervals are split
    by adaptive execution.

    ``totals``: each interval that holds a point once, all its columns, with aggregates of its
    points (``{"total": ("sum", "value")}``, with ``sum``, ``count``, ``min``,
    ``max``; nulls are skipped, ``*`` counts rows) instead of the pairs, which
    are never made: see ``_interval_totals``.
    """
    if how not in ("inner", "left"):
        raise ValueError("how is inner or left")
    if totals is not None and (how != "inner" or {f for f, _ in totals.values()} - set(RUNNING)):
        raise ValueError(f"totals are of an inner join, by {sorted(RUNNING)}")
    if {c.lower() for c in totals or {}} & {c.lower() for c in intervals.columns}:
        raise ValueError("intervals have columns of the totals' names")
    clash = ({c.lower() for c in intervals.columns} - {k.lower() for k in on}) & {c.lower() for c in points.columns}
    if clash and totals is None:
        raise ValueError(f"both sides have columns {sorted(clash)}")
    lo, hi = _number(intervals, start), _number(intervals, stop)
    keys = [f"near_k{i}" for i in range(len(on))]
    spans = intervals.select(*[F.col(f"`{k}`").alias(i) for k, i in zip(on, keys)], lo.alias("near_lo"), hi.alias("near_hi"),
                             F.struct(*[F.col(f"`{c}`") for c in intervals.columns if totals is not None or c not in on]).alias("near_interval"))
    spans = spans.where((F.col("near_lo") <= F.col("near_hi")) if closed else (F.col("near_lo") < F.col("near_hi"))).dropna(subset=keys or ["near_lo"])
    if totals is not None:
        return _interval_totals(points.withColumns({"near_x": _number(points, point), **{i: F.col(f"`{k}`") for k, i in zip(on, keys)}}), spans, keys, closed, totals)
    length = F.greatest(F.col("near_hi") - F.col("near_lo"), F.lit(1e-6))
    spans = spans.withColumn("near_level", F.least(F.lit(40), F.ceil(F.log(float(LEVEL), length))).cast("int"))
    levels = sorted(r[0] for r in spans.select("near_level").distinct().collect())
    width = F.pow(F.lit(float(LEVEL)), F.col("near_level"))
    cells = spans.withColumn("near_cell", F.explode(F.sequence(F.floor(F.col("near_lo") / width), F.floor(F.col("near_hi") / width))))
    narrow = points.withColumn("near_row", F.monotonically_increasing_id()) if how == "left" else points
    narrow = materialize(narrow, "near-points") if how == "left" else narrow
    at = narrow.withColumn("near_at", _number(points, point))
    spread = at.where(F.col("near_at").isNotNull()).withColumn("near_level", F.explode(F.array(*[F.lit(x) for x in levels]).cast("array<int>")))
    spread = spread.withColumns({"near_cell": F.floor(F.col("near_at") / width), **{f"near_p{i}": F.col(f"`{k}`") for i, k in enumerate(on)}})
    meets = [spread[x] == cells[x] for x in ("near_level", "near_cell")] + [spread[f"near_p{i}"] == cells[k] for i, k in enumerate(keys)]
    inside = (cells["near_lo"] <= spread["near_at"]) & ((spread["near_at"] <= cells["near_hi"]) if closed else (spread["near_at"] < cells["near_hi"]))
    kept = [*points.columns, *(["near_row"] if how == "left" else [])]
    met = spread.join(cells, [*meets, inside]).select(*[spread[f"`{c}`"] for c in kept], "near_interval.*")
    if how == "inner":
        return met
    alone = narrow.join(met.select("near_row").distinct(), "near_row", "left_anti")
    return met.unionByName(alone, allowMissingColumns=True).drop("near_row")


def _interval_totals(points: DataFrame, spans: DataFrame, keys: Sequence[str], closed: bool, totals: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Each span with the totals of its points, by running aggregates in cells instead of pairs.

    Cells of a span's level are at most as long as it, so it ends in another
    cell than it starts in: its points are the rest of the first cell, whole
    cells, and the beginning of the last. Each of these is a row among the
    points of its cell, and takes the aggregate up to there, from behind or from
    the front; nothing is subtracted, so a sum has the span's own terms only.
    Cells are cut into ranges of rows (``ranges``), so that none is too full
    for a task. Spans of no length (``closed``) have the point itself as cell.
    Numbers less than 1e-300 apart count as equal where a span ends.
    """
    base, lo, hi = float(TOTALS_LEVEL), F.col("near_lo"), F.col("near_hi")
    width = F.pow(F.lit(base), F.col("near_level"))
    spot = -1000  # the level of cells that are one point
    spans = spans.withColumn("near_id", F.monotonically_increasing_id()).withColumn(
        "near_level", F.least(F.lit(255), F.greatest(F.lit(-249), F.floor(F.log(base, F.least(hi - lo, F.lit(1.7e308)))))).cast("int"))
    one = F.floor(lo / width) == F.floor(hi / width)
    spans = spans.withColumn("near_level", F.when(lo == hi, spot).otherwise(F.col("near_level") - one.cast("int")))
    spans = materialize(spans, "near-spans")
    levels = sorted(r[0] for r in spans.select("near_level").distinct().collect())
    at_spot = F.col("near_level") == spot

    def cell(x: Column) -> Column:
        return F.when(at_spot, F.lit(0)).otherwise(F.floor(x / width))

    def piece(cell: Column, x: Column, front: bool, side: int) -> Column:
        return F.struct(cell.alias("near_cell"), x.cast("double").alias("near_x"), F.lit(front).alias("near_front"), F.lit(side).alias("near_side"))
    # At one number, points have side 1: a piece from behind takes them in, one from the front where the span is closed.
    first, last = piece(cell(lo), lo, False, 0), piece(cell(hi), hi, True, 2 if closed else 0)
    whole = F.when(cell(hi) - cell(lo) > 1, F.transform(F.sequence(cell(lo) + 1, cell(hi) - 1), lambda c: piece(c, F.lit(float("-inf")), False, 0)))
    pieces = spans.withColumn("near_piece", F.explode(F.when(at_spot, F.array(first)).otherwise(F.concat(F.array(first, last), F.coalesce(whole, F.array())))))
    pieces = pieces.select(*keys, "near_level", "near_piece.*", F.when(at_spot, lo).otherwise(0.0).alias("near_spot"), "near_id",
                           F.when((F.col("near_piece.near_x") == lo) & ~F.col("near_piece.near_front"), F.col("near_interval")).alias("near_interval"))
    wanted = {f"near_t{i}": (f, f"near_v{i}") for i, (f, _) in enumerate(totals.values())} | {"near_n": ("count", "near_one")}
    spread = points.where(F.col("near_x").isNotNull()).dropna(subset=list(keys) or ["near_x"]).withColumn(
        "near_level", F.explode(F.array(*[F.lit(x) for x in levels]).cast("array<int>")))
    spread = spread.select(*keys, "near_level", cell(F.col("near_x")).alias("near_cell"), "near_x", F.lit(1).alias("near_side"),
                           F.when(at_spot, F.col("near_x")).otherwise(0.0).alias("near_spot"), F.lit(1).alias("near_one"),
                           *[(F.lit(1) if c == "*" else F.col(f"`{c}`")).alias(f"near_v{i}") for i, (_, c) in enumerate(totals.values())])
    group = [*keys, "near_level", "near_cell", "near_spot"]
    rows = _cut(spread.unionByName(pieces, allowMissingColumns=True), group, ["near_x", "near_side"], "near_part", "near_row", "near-ranges")
    order = ["near_x", "near_side", "near_row"]
    cells = Window.partitionBy("near_part", *group).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    front, behind = cells.orderBy(*order), cells.orderBy(*[F.desc(c) for c in order])
    local = rows.select("*", *[RUNNING[f](c).over(front).alias(f"{n}f") for n, (f, c) in wanted.items()])
    local = local.select("*", *[RUNNING[f](c).over(behind).alias(f"{n}b") for n, (f, c) in wanted.items()]).where(F.col("near_id").isNotNull())
    # Cells that lie in several ranges are the first or the last of each: at most two a range, with what the other ranges have of them.
    ends = rows.groupBy("near_part").agg(F.min(F.struct(*group)).alias("a"), F.max(F.struct(*group)).alias("b"))
    ends = materialize(ends.select(F.explode(F.array("a", "b")).alias("end")).select("end.*").distinct(), "near-ends")
    parts = rows.join(F.broadcast(ends), group).groupBy("near_part", *group).agg(*[RUNNING[f](c).alias(n) for n, (f, c) in wanted.items()])
    carried = {n: F.sum if f in ("sum", "count") else RUNNING[f] for n, (f, _) in wanted.items()}
    others = Window.partitionBy(*group).rowsBetween(Window.unboundedPreceding, -1)
    carry = parts.select("near_part", *group, *[carried[n](n).over(others.orderBy("near_part")).alias(f"{n}p") for n in wanted],
                         *[carried[n](n).over(others.orderBy(F.desc("near_part"))).alias(f"{n}q") for n in wanted])
    met = local.join(F.broadcast(carry), ["near_part", *group], "left")

    def both(n: str) -> Column:
        own = F.when(F.col("near_front"), F.col(f"{n}f")).otherwise(F.col(f"{n}b"))
        other = F.when(F.col("near_front"), F.col(f"{n}p")).otherwise(F.col(f"{n}q"))
        if wanted[n][0] in ("sum", "count"):
            return F.coalesce(own + other, own, other)
        return F.greatest(own, other) if wanted[n][0] == "max" else F.least(own, other)
    found = met.groupBy("near_id").agg(F.first("near_interval", ignorenulls=True).alias("near_interval"), *[carried[n](both(n)).alias(n) for n in wanted])
    return found.where("near_n > 0").select("near_interval.*", *[F.col(f"near_t{i}").alias(c) for i, c in enumerate(totals)])


def _band_cell(x: Column, reach: float) -> Column:
    # Off the multiples of reach, where dates and whole numbers lie: one is not at the edge of its neighbour's reach.
    return F.floor(x / (BAND_STEP * reach) + 0.25)


def _placed(df: DataFrame, xy: tuple[str, str], name: str) -> DataFrame:
    """The rows with two numbers: their columns by place (name0, name1, ...), and the numbers (name_x, name_y)."""
    out = df.select(*[F.col(f"`{c}`").alias(f"{name}{i}") for i, c in enumerate(df.columns)], *[_number(df, c).alias(f"{name}_{a}") for c, a in zip(xy, "xy")])
    return out.dropna(subset=[f"{name}_x", f"{name}_y"])


def _band_copies(right: DataFrame, xy: tuple[str, str], reach: tuple[float, float], half: bool) -> DataFrame:
    """Each row in the cells (cx, cy) that its reach meets, ``home`` in its own; ``half``: in its own and those before it."""
    two = _placed(right, xy, "two")
    for a, r in zip("xy", reach):
        # A little more than the reach, as differences are rounded.
        x, far = F.col(f"two_{a}"), F.lit(r * (1 + 1e-9))
        two = two.withColumn(f"c{a}", F.explode(F.sequence(_band_cell(x - far, r), _band_cell(x + far, r))))
    own = [_band_cell(F.col(f"two_{a}"), r) for a, r in zip("xy", reach)]
    if half:
        two = two.where((F.col("cx") < own[0]) | (F.col("cx") == own[0]) & (F.col("cy") <= own[1]))
    return two.withColumn("home", (F.col("cx") == own[0]) & (F.col("cy") == own[1]))


def band_join(left: DataFrame, right: DataFrame, left_xy: tuple[str, str], right_xy: tuple[str, str], reach: tuple[float, float],
              prefix: str = "near_", dense: int = DENSE, distinct_by: str | None = None) -> DataFrame:
    """Pairs of rows whose two numbers (or times, in seconds) differ by at most ``reach`` each.

    Columns of ``left``, then those of ``right`` with ``prefix``. Nulls, NaN and
    infinities match nothing; repeated rows pair as often as they are there.
    ``distinct_by``: for a table with itself, a column that names rows: each
    pair comes once, the smaller name first, and no row pairs with itself.

    A left row is in one cell of a grid with steps of ``BAND_STEP`` times
    ``reach``; a right row is copied to the cells that its reach meets (two
    each way, of this step), so a pair meets once. Where both sides are the
    same frame and ``distinct_by`` is given, two cells meet from one side only:
    a row is copied to its own cell and to those before it, and the pair is
    turned where the later name comes first. A cell with more than ``dense``
    left rows is split into as many shares; its right rows are copied to each,
    so that no task gets a dense cell whole.
    """
    if min(reach) <= 0:
        raise ValueError("reach must be positive")
    half = left is right and tuple(left_xy) == tuple(right_xy) and distinct_by is not None

    one = _placed(left, left_xy, "one").withColumns({f"c{a}": _band_cell(F.col(f"one_{a}"), r) for a, r in zip("xy", reach)})
    cells = one.groupBy("cx", "cy").count().where(F.col("count") > dense)
    # Dense cells: at most one for each `dense` left rows; broadcast only when their table is small.
    cells = materialize(cells.select("cx", "cy", F.ceil(F.col("count") / dense).cast("int").alias("shares")), "dense-cells")
    cells = checked_broadcast(cells)
    one = one.join(cells, ["cx", "cy"], "left")
    share = F.pmod(F.xxhash64(*[f"one{i}" for i in range(len(left.columns))]), F.coalesce("shares", F.lit(1)))
    one = one.withColumn("share", F.when(F.col("shares").isNull(), 0).otherwise(share).cast("int")).drop("shares")
    two = _band_copies(right, right_xy, reach, half)
    two = two.join(cells, ["cx", "cy"], "left")
    two = two.withColumn("share", F.explode(F.sequence(F.lit(0), F.coalesce("shares", F.lit(1)) - 1))).drop("shares")
    met = one.join(two, ["cx", "cy", "share"])
    for a, r in zip("xy", reach):
        met = met.where(F.abs(F.col(f"one_{a}") - F.col(f"two_{a}")) <= r)
    first, second = ([F.col(f"{name}{i}") for i in range(len(df.columns))] for df, name in ((left, "one"), (right, "two")))
    if distinct_by:
        name, other = first[left.columns.index(distinct_by)], second[right.columns.index(distinct_by)]
        if half:
            met = met.where((name < other) | (name > other) & ~F.col("home"))
            first, second = ([F.when(name < other, x).otherwise(y) for x, y in zip(*sides)] for sides in ((first, second), (second, first)))
        else:
            met = met.where(name < other)
    return met.select(*[x.alias(c) for x, c in zip(first, left.columns)], *[x.alias(f"{prefix}{c}") for x, c in zip(second, right.columns)])
