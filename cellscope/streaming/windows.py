"""Event-time windows over a stream, with a watermark, expiring state and late rows.

A batch of rows is reduced to counts, sums, least and greatest values of each
(window, keys), which merge in any order. Windows that the watermark has not
passed are the state: one written table an epoch, as large as the open windows
and no larger. A window that it passes is written out once and leaves the
state. Rows that come for such a window are late: they are counted and written
as corrections, so that closed windows and corrections together equal the batch
result, whatever order the rows came in.

Each epoch writes folders of its own from those of the epoch before it, so a
repeated epoch (after a failure) writes the same again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cellscope.functions._util import literal_rows
from cellscope.streaming.area_hour import drop_epochs, epochs

MICROS = 1_000_000
_PARTS = {"n": F.sum, "n_value": F.sum, "total": F.sum, "least": F.min, "most": F.max}
_MARK = "watermark long, n_rows long, n_late long, n_without_time long"


def _micros(ts: str) -> Column:
    return F.unix_micros(F.col(f"`{ts}`").cast("timestamp"))


def windows_of(ts: str, seconds: int, slide: int) -> Column:
    """Starts (microseconds) of the windows that hold ``ts``; none where it is null."""
    at, step = _micros(ts), slide * MICROS
    last = at - F.pmod(at, F.lit(step))
    first = last - F.lit((-(-seconds // slide) - 1) * step)
    held = F.sequence(first, last, F.lit(step).cast("long"))
    return F.filter(held, lambda s: s + F.lit(seconds * MICROS) > at)


def window_parts(rows: DataFrame, ts: str, keys: Sequence[str], value: str, seconds: int, slide: int) -> DataFrame:
    """(window, keys, n, n_value, total, least, most, n_new, seen): one row a window and key, reduced in each task first.

    ``n_new``: rows of which this is the last window (rows without a time: the
    null window); ``seen``: greatest event time.
    """
    at = _micros(ts)
    held = rows.select(at.alias("at"), F.explode_outer(windows_of(ts, seconds, slide)).alias("window"), *[F.col(f"`{k}`") for k in keys],
                       F.col(f"`{value}`").alias("x"))
    is_last = F.col("window").isNull() | (F.col("window") + F.lit(slide * MICROS) > F.col("at"))
    return held.groupBy("window", *keys).agg(F.count(F.lit(1)).alias("n"), F.count("x").alias("n_value"), F.sum("x").alias("total"), F.min("x").alias("least"),
                                             F.max("x").alias("most"), F.count_if(is_last).alias("n_new"), F.max("at").alias("seen"))


def _merged(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    return parts.groupBy("window", *keys).agg(*[f(c).alias(c) for c, f in _PARTS.items()])


class EventWindows:
    """Windows of ``seconds`` every ``slide`` seconds (default: one after the other) by ``keys``, under ``output_dir``.

    ``delay``: seconds that the watermark stays behind the greatest event time
    of all earlier epochs; a window is closed once its end is not after the
    watermark. Rows without an event time are in no window, and are counted; times
    without a zone are taken in the session's.
    Null keys are a key; null values count in ``n`` only. An epoch without rows
    changes nothing. ``keys`` and ``value`` may have any name but those of the
    result's own columns.
    """

    def __init__(self, spark: SparkSession, output_dir: str, ts: str, keys: Sequence[str], value: str, seconds: int,
                 slide: int | None = None, delay: int = 0) -> None:
        taken = {"window", "window_start", "x", "mean", "n_late", *_PARTS} & {k.lower() for k in keys}
        if taken or seconds <= 0 or (slide or seconds) <= 0 or (slide or seconds) > seconds:
            raise ValueError(f"keys with names of the result: {sorted(taken)}" if taken else "windows need 0 < slide <= seconds")
        self.spark, self.base, self.ts, self.keys, self.value = spark, output_dir.rstrip("/"), ts, list(keys), value
        self.seconds, self.slide, self.delay = seconds, slide or seconds, delay

    def _path(self, name: str, epoch: int) -> str:
        return f"{self.base}/{name}/epoch={epoch}"

    def _read(self, name: str, numbers: Sequence[int], like: DataFrame) -> DataFrame:
        paths = [self._path(name, e) for e in numbers]
        return self.spark.read.schema(like.schema).parquet(*paths) if paths else like.limit(0)

    def _mark(self, before: int | None = None) -> tuple[int, tuple]:
        """The last whole epoch (before another) and its marks."""
        done = [e for e in epochs(self.spark, f"{self.base}/mark") if before is None or e < before]
        if not done:
            return -1, (None, 0, 0, 0)
        return max(done), tuple(self.spark.read.schema(_MARK).parquet(self._path("mark", max(done))).first())

    def write_epoch(self, batch: DataFrame, epoch: int) -> None:
        """One epoch: parts of the batch, merged into the state; closed windows, corrections and marks written."""
        last, (watermark, n_rows, n_late, n_without) = self._mark(before=epoch)
        parts = window_parts(batch, self.ts, self.keys, self.value, self.seconds, self.slide)
        parts.write.mode("overwrite").parquet(self._path("parts", epoch))
        parts = self.spark.read.schema(parts.schema).parquet(self._path("parts", epoch))
        late, timed = self._closed(F.col("window"), watermark), F.col("window").isNotNull()
        top, rows, late_rows, without = parts.agg(F.max("seen") - F.lit(self.delay * MICROS), F.sum("n_new"), F.sum(F.when(late, F.col("n_new"))),
                                                  F.sum(F.when(~timed, F.col("n")))).first()
        now = max((w for w in (watermark, top) if w is not None), default=None)
        fresh = parts.where(timed).drop("n_new", "seen")
        fresh.where(late).write.mode("overwrite").parquet(self._path("late", epoch))
        on_time = fresh.where(~late)
        state = self._read("state", [last] if last >= 0 else [], fresh)
        merged = _merged(state.unionByName(on_time), self.keys).withColumn("closed", self._closed(F.col("window"), now))
        path = self._path("merged", epoch)
        merged.write.mode("overwrite").partitionBy("closed").parquet(path)
        merged = self.spark.read.schema(merged.schema).parquet(path)
        for name, part in (("closed", merged.where("closed")), ("state", merged.where("NOT closed"))):
            part.drop("closed").write.mode("overwrite").parquet(self._path(name, epoch))
        # The marks come last: an epoch without them never was.
        literal_rows(self.spark, [[now, n_rows + (rows or 0), n_late + (late_rows or 0), n_without + (without or 0)]], _MARK).coalesce(1).write.mode("overwrite").parquet(
            self._path("mark", epoch))
        for name in ("parts", "state", "mark", "merged"):
            drop_epochs(self.spark, f"{self.base}/{name}", keep=2)

    def _closed(self, window: Column, watermark: int | None) -> Column:
        return F.lit(False) if watermark is None else window + F.lit(self.seconds * MICROS) <= F.lit(watermark)

    def start(self, stream: DataFrame, checkpoint_dir: str, available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
        """Start the query on a streaming frame; ``available_now`` takes what is there and stops."""
        writer = stream.writeStream.foreachBatch(self.write_epoch).option("checkpointLocation", checkpoint_dir)
        if available_now:
            writer = writer.trigger(availableNow=True)
        elif processing_time:
            writer = writer.trigger(processingTime=processing_time)
        return writer.start()

    def marks(self) -> dict[str, int | None]:
        """``watermark`` (microseconds; null before the first row), ``n_rows``, ``n_late`` (rows all of whose windows were closed when
        they came), ``n_without_time``, over all epochs."""
        return dict(zip(("watermark", "n_rows", "n_late", "n_without_time"), self._mark()[1]))

    def result(self, with_open: bool = False) -> DataFrame:
        """(window_start, keys, n, n_value, total, mean, least, most, n_late): closed windows with their corrections.

        ``with_open``: also those still open, then all rows that came are in it.
        ``n_late``: rows of the window that came after it was closed.
        """
        last, _ = self._mark()
        if last < 0:
            raise ValueError("no epoch is written yet")
        done = [e for e in epochs(self.spark, f"{self.base}/closed") if e <= last]
        state = self.spark.read.parquet(self._path("state", last))
        parts = self._read("closed", done, state).withColumn("late", F.lit(0).cast("long"))
        parts = parts.unionByName(self._read("late", done, state).withColumn("late", F.col("n")))
        if with_open:
            parts = parts.unionByName(state.withColumn("late", F.lit(0).cast("long")))
        merged = parts.groupBy("window", *self.keys).agg(*[f(c).alias(c) for c, f in _PARTS.items()], F.sum("late").alias("n_late"))
        return merged.select(F.timestamp_micros("window").alias("window_start"), *self.keys, "n", "n_value", "total",
                             F.try_divide("total", "n_value").alias("mean"), "least", "most", "n_late")
