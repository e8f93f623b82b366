"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame operations only.

A source with target T and size S gives each of its documents T / S copies on
average. The whole part is taken at once; the rest is a mass between 0 and the
document's size. Two open documents move mass from one to the other, in a
random direction that keeps both expectations, until one of them is empty or
full. So a source's total never changes, and the one document that is open at
the end goes to the nearer side: a source ends less than half of that document
from its target.

Documents are dealt over buckets of about FAN_IN; each bucket folds to one open
document, and these are dealt over fewer buckets, and so on: a reduction tree
with log(n) / log(FAN_IN) levels, whatever the share of the largest source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellscope.llm.common import fresh, written

WORD = r"[^\x20\x09-\x0D]+"
FAN_IN = 64
#: A word is so many units of mass: whole numbers, so that sums are exact.
UNIT = 1 << 20
#: Source tables of so many rows at most are broadcast; larger ones are joined by salted keys.
BROADCAST_SOURCES = 10_000
SALTS = 64


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def placed(sizes: DataFrame) -> DataFrame:
    """``sizes`` with ``nth``, the place (from 0) of each row's source in code point order, null last.

    Ranges of sources are numbered each by itself; only one row a range meets in one task.
    """
    order = F.col("source").asc_nulls_last()
    ranges = written(sizes.repartitionByRange(order).withColumn("range", F.spark_partition_id()), "mix-ranges")
    before = F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    starts = ranges.groupBy("range").agg(F.count(F.lit(1)).alias("n")).select("range", F.coalesce(before, F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("range").orderBy(order)) - 1
    return (ranges.withColumn("nth", within).join(F.broadcast(starts), "range")
            .withColumn("nth", F.col("nth") + F.col("before")).drop("range", "before"))


def targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """``sizes`` (source, source_size, ...) with ``target``.

    Sources in code point order, null last, have ``weights`` in turn and
    share ``share`` of all sizes by them. A target stops at ``cap`` times its
    source's size; the excess is shared again by weight until none is above.
    Each round is one aggregate of the source table; a round's level only
    rises, so a source that stopped stays so. share must not exceed cap.
    """
    if not 0 <= share <= cap:
        raise ValueError("share must be between 0 and cap")
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("nth") % len(weights)).cast("int") + 1)
    rows = written(placed(sizes).withColumn("weight", weight).drop("nth"), "mix-weights")  # a row for each source
    most = cap * F.col("source_size")
    total = share * (rows.agg(F.sum("source_size")).first()[0] or 0)
    stopped, stopped_before = F.lit(False), -1
    while True:
        done, rest, n = rows.agg(F.sum(F.when(stopped, most).otherwise(0.0)), F.sum(F.when(stopped, 0.0).otherwise(F.col("weight"))),
                                 F.sum(stopped.cast("long"))).first()
        if not rest or n == stopped_before:
            break
        left, stopped_before = total - done, n
        stopped = F.col("weight") * left / rest > most
    given = most if not rest else F.when(stopped, most).otherwise(F.col("weight") * left / rest)
    return rows.withColumn("target", given.cast("double")).drop("weight")


def _with_sources(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``rows`` joined to their source's row; no task gets all rows of a source."""
    s = sources.withColumnRenamed("source", "its_source")
    if sources.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        return rows.join(F.broadcast(s), F.col("source").eqNullSafe(F.col("its_source"))).drop("its_source")
    salted = s.withColumn("its_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return (rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "h"), F.lit(SALTS)).cast("int"))
            .join(salted, F.col("source").eqNullSafe(F.col("its_source")) & (F.col("salt") == F.col("its_salt")))
            .drop("its_source", "its_salt", "salt"))


def _fold(docs: Column) -> Column:
    """struct(done, open) of an array of open documents (order, u, doc_id, h, size, mass).

    Large documents come first: an open one is then likely settled by the
    smaller ones after it, so that a small one is left.
    """
    def item(x: Column, mass: Column) -> Column:
        return F.struct(x["order"].alias("order"), x["u"].alias("u"), x["doc_id"].alias("doc_id"), x["h"].alias("h"), x["size"].alias("size"), mass.alias("mass"))

    def whole(x: Column) -> Column:
        return (x["mass"] <= 0) | (x["mass"] >= x["size"] * UNIT)

    def merge(acc: Column, x: Column) -> Column:
        r = acc["open"]
        to_r = F.least(r["size"] * UNIT - r["mass"], x["mass"])
        to_x = F.least(r["mass"], x["size"] * UNIT - x["mass"])
        # With probability to_x / (to_r + to_x) towards r: both keep their expectation.
        moved = F.when(x["u"] * (to_r + to_x) < to_x, to_r).otherwise(-to_x)
        two = F.when(r.isNull(), F.array(item(x, x["mass"]))).otherwise(
            F.array(item(r, r["mass"] + moved), item(x, x["mass"] - moved)))
        return F.struct(F.concat(acc["done"], F.filter(two, whole)).alias("done"),
                        F.get(F.filter(two, lambda y: ~whole(y)), F.lit(0)).alias("open"))

    return F.aggregate(F.array_sort(docs), F.struct(F.slice(docs, 1, 0).alias("done"), F.get(F.slice(docs, 1, 0), F.lit(0)).alias("open")), merge)


def _round(rows: DataFrame, levels: int, seed: int) -> DataFrame:
    """(source, doc_id, h, size, mass) with every mass 0 or full, from open rows (..., buckets)."""
    out = None
    for level in range(levels):
        draw = lambda salt: F.xxhash64(F.lit(seed), F.lit(level), F.lit(salt), "source", "doc_id", "h", "size")  # noqa: B023, E731
        fewer = F.ceil(F.col("buckets") / F.lit(float(FAN_IN))).cast("long")
        u = F.pmod(draw("u"), F.lit(1 << 52)) / float(1 << 52)
        dealt = rows.withColumn("buckets", fewer).withColumn("bucket", F.pmod(draw("bucket"), F.col("buckets")))
        folded = dealt.groupBy("source", "buckets", "bucket").agg(
            _fold(F.collect_list(F.struct((-F.col("size")).alias("order"), u.alias("u"), "doc_id", "h", "size", "mass"))).alias("f"))
        step = written(folded, f"mix-level-{level}")
        done = step.select("source", F.explode("f.done").alias("d"))
        open_ = step.where("f.open IS NOT NULL").select("source", "buckets", F.col("f.open").alias("d"))
        if level == levels - 1:  # one bucket a source: its last open document goes to the nearer side
            full = F.when(F.col("d.size") * UNIT <= 2 * F.col("d.mass"), F.col("d.size") * UNIT).otherwise(0)
            last = open_.select("source", F.col("d").withField("mass", full.cast("long")).alias("d"))
            done = done.unionByName(last)
        flat = lambda t, *more: t.select("source", *more, "d.doc_id", "d.h", "d.size", "d.mass")
        out = flat(done) if out is None else out.unionByName(flat(done))
        rows = flat(open_, "buckets")
    return out


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, cap: float = 2.0, seed: int = 0,
        id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(doc_id, h, source, size, source_size, target, copies, taken) for each row of ``docs``.

    size: words of the text (null or empty: 0). copies: whole number of at
    most ceil(cap); taken = copies * size. h: hash of the text, which tells
    rows with the same id apart. A document without words takes the whole
    part of its source's copies. A null source is a source, the last one.
    Null ids and repeated rows are rows like any other. Draws are hashes of
    seed, level, id, text and source: reruns agree whatever the partitions.
    An empty table gives no rows. Other columns are ignored.
    """
    sized = written(docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("h"),
                                F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size")), "mix-sizes")
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("buckets"))
    sources = written(targets(sizes, weights, share, cap), "mix-targets")
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = (_with_sources(sized, sources).withColumn("base", F.floor(copies).cast("long"))
            .withColumn("mass", F.round((copies - F.col("base")) * F.col("size") * UNIT).cast("long")))
    rows = written(rows, "mix-rows")
    is_open = (F.col("mass") > 0) & (F.col("mass") < F.col("size") * UNIT)
    most, levels, reach = sources.agg(F.max("buckets")).first()[0] or 0, 1, FAN_IN
    while reach < most:
        levels, reach = levels + 1, reach * FAN_IN
    closed = rows.where(~is_open).select("source", "doc_id", "h", "size", "mass")
    rounded = closed.unionByName(_round(rows.where(is_open).select("source", "doc_id", "h", "size", "mass", "buckets"), levels, seed))
    one = (F.col("mass") > 0).cast("long")
    base = F.floor(copies).cast("long")
    return _with_sources(rounded, sources).select("doc_id", "h", "source", "size", "source_size", "target",
                                                  (base + one).alias("copies"), ((base + one) * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, cap: float = 2.0, seed: int = 0,
          id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as ``mix`` decides (0 times: it goes)."""
    plan = mix(docs, weights, share, cap, seed, id_col, source_col, text_col)
    h, key, n, nth = (fresh(docs, x) for x in ("mix_h", "mix_key", "mix_copies", "mix_nth"))
    src = fresh(docs, "mix_source")
    # Rows that agree in id, text and source take the decisions in turn.
    per_key = plan.groupBy(F.col("doc_id").alias(key), F.col("h").alias(h + "k"), F.col("source").alias(src)).agg(
        F.array_sort(F.collect_list("copies")).alias(n))
    own = docs.withColumn(h, F.xxhash64(F.col(text_col)))
    joined = own.join(per_key, F.col(id_col).eqNullSafe(F.col(key)) & (F.col(h) == F.col(h + "k"))
                      & F.col(source_col).eqNullSafe(F.col(src)))
    turn = F.row_number().over(Window.partitionBy(id_col, h, source_col).orderBy(h))
    counted = joined.withColumn(nth, turn).withColumn(n, F.get(F.col(n), (F.col(nth) - 1).cast("int")))
    return counted.withColumn(nth, F.explode(F.array_repeat(F.lit(0), F.col(n).cast("int")))).select(*docs.columns)
