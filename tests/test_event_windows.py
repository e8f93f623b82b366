"""Event-time windows of a stream against plain Python, in any order of arrival."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from cellscope.session import scratch_path
from cellscope.streaming.windows import EventWindows

SCHEMA = "ts timestamp, k string, v double, window_end string"
START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def table(seed: int, n: int = 300) -> list[tuple]:
    rng = random.Random(seed)
    return [(START + timedelta(seconds=rng.randint(0, 7200)) if rng.random() > 0.05 else None, rng.choice(["hot", "hot", "hot", "a", None]),
             rng.choice([None, rng.randint(-8, 8) / 4]), "other column") for _ in range(n)]


def expected(rows, seconds, slide):
    out = defaultdict(list)
    for ts, k, v, _ in rows:
        if ts is not None:
            at = int((ts - START).total_seconds())
            for s in range(at - at % slide, at - seconds, -slide):
                out[s, k].append(v)
    return {key: (len(vs), len(x := [v for v in vs if v is not None]), sum(x) if x else None, min(x, default=None), max(x, default=None))
            for key, vs in out.items()}


def got(df):
    return {(int((r["window_start"].replace(tzinfo=timezone.utc) - START).total_seconds()), r["k"]): (r["n"], r["n_value"], r["total"], r["least"], r["most"])
            for r in df.select(F.col("window_start"), "k", "n", "n_value", "total", "least", "most").collect()}


@pytest.mark.parametrize("seconds,slide", [(600, 600), (900, 300), (700, 300)])
def test_any_order_equals_batch(spark, seconds, slide):
    rows = table(seconds)
    want = expected(rows, seconds, slide)
    in_time = sorted(rows, key=lambda r: r[0] or START)
    for order in (in_time, in_time[::-1]):
        w = EventWindows(spark, scratch_path(spark, "windows"), "ts", ["k"], "v", seconds, slide, delay=60)
        mark, closed, late_rows, late_by_window = None, set(), 0, 0
        for e, lo in enumerate(range(0, len(order), 100)):
            part = order[lo:lo + 100]
            for ts, *_ in part:
                if ts is not None and mark is not None:
                    at = int((ts - START).total_seconds())
                    ends = [s + seconds for s in range(at - at % slide, at - seconds, -slide)]
                    late_rows += all(x <= mark for x in ends)
                    late_by_window += sum(x <= mark for x in ends)
            w.write_epoch(spark.createDataFrame(part, SCHEMA), e)
            top = max((int((r[0] - START).total_seconds()) for r in part if r[0]), default=None)
            mark = max(x for x in (mark, top - 60) if x is not None)
        assert got(w.result(with_open=True)) == want
        closed = {k: v for k, v in want.items() if k[0] + seconds <= mark}
        assert got(w.result()) == closed
        marks = w.marks()
        assert (marks["n_rows"], marks["n_late"], marks["n_without_time"]) == (len(rows), late_rows, sum(r[0] is None for r in rows))
        assert w.result(with_open=True).agg(F.sum("n_late")).first()[0] == late_by_window
        # The state holds open windows only.
        assert all(r["window"] // 1_000_000 + seconds > mark + int(START.timestamp()) for r in spark.read.parquet(w._path("state", 2)).collect())
    assert late_rows > 0


def test_repeated_epoch_and_empty(spark):
    rows = table(3)
    w = EventWindows(spark, scratch_path(spark, "windows"), "ts", ["k"], "v", 600, delay=0)
    with pytest.raises(ValueError):
        w.result()
    empty = spark.createDataFrame([], SCHEMA)
    w.write_epoch(empty, 0)
    assert w.marks() == {"watermark": None, "n_rows": 0, "n_late": 0, "n_without_time": 0} and w.result(with_open=True).count() == 0
    for e in (1, 1, 2, 2):
        w.write_epoch(spark.createDataFrame(rows[(e - 1) * 150:e * 150], SCHEMA), e)
    before = w.marks()
    w.write_epoch(empty, 3)
    assert w.marks() == before and before["n_rows"] == len(rows)
    assert got(w.result(with_open=True)) == expected(rows, 600, 600)
    for bad in (dict(keys=["n"], seconds=60), dict(keys=["k"], seconds=0), dict(keys=["k"], seconds=60, slide=61)):
        with pytest.raises(ValueError):
            EventWindows(spark, "unused", "ts", value="v", **bad)


def test_stream_resumes(spark):
    """Files in three lots; each start goes on from the checkpoint."""
    rows, base = sorted(table(5), key=lambda r: r[0] or START), scratch_path(spark, "windows")
    w = EventWindows(spark, f"{base}/out", "ts", ["k"], "v", 600, delay=120)
    for i, part in enumerate((rows[:120], rows[200:], rows[120:200])):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.parquet(f"{base}/in/lot={i}")
        w.start(spark.readStream.schema(SCHEMA).parquet(f"{base}/in/*"), f"{base}/checkpoint").awaitTermination()
    assert got(w.result(with_open=True)) == expected(rows, 600, 600) and w.marks()["n_late"] > 0
