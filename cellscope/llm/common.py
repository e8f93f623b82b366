"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellscope.session import ensure_checkpoint_dir

#: ASCII white space, the only separators that the text contracts know.
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


_HELD: dict = {}  # of one Python worker


def held(key, make):
    """``make()``, kept by this Python worker for ``key`` until another model is asked for.

    Workers serve many stages: one that holds a model and its caches for every
    operator would outgrow its executor.
    """
    if key not in _HELD:
        _HELD.clear()
        gc.collect()
        _HELD[key] = make()
    return _HELD[key]


#: Seconds after a worker's last task before it gives its memory back.
IDLE_SECONDS = 1.0
_RUNNING, _IDLE = 0, None


def let_go() -> None:
    """Drop this worker's model and give freed memory back to the system, unless a task runs."""
    if not _RUNNING:
        _HELD.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):  # another C library: nothing to trim
            pass


@contextmanager
def task() -> Iterator[None]:
    """Around the batches of one Python task: a worker that gets no other task soon keeps no memory.

    Workers stay for a minute after a stage; between tasks of one stage the model stays.
    """
    global _RUNNING, _IDLE
    if _IDLE:
        _IDLE.cancel()
    _RUNNING += 1
    try:
        yield
    finally:
        _RUNNING -= 1
        _IDLE = threading.Timer(IDLE_SECONDS, let_go)
        _IDLE.daemon = True
        _IDLE.start()


_SHIPPED: set[str] = set()
#: Rows of an Arrow batch where the session has Spark's default of 10,000: documents are long rows.
ARROW_ROWS = ("spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "2000")


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, once a session, where they may not have it installed, and smaller batches."""
    sc = spark.sparkContext
    if spark.conf.get(ARROW_ROWS[0], ARROW_ROWS[1]) == ARROW_ROWS[1]:
        spark.conf.set(ARROW_ROWS[0], ARROW_ROWS[2])
    if sc.applicationId not in _SHIPPED:
        root = Path(__file__).resolve().parents[2]
        sc.addPyFile(shutil.make_archive(str(Path(tempfile.mkdtemp(dir=sc._temp_dir), "cellscope")), "zip", root, "cellscope"))
        _SHIPPED.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parts_for(spark: SparkSession, rows: int, per_task: int = 250_000) -> int:
    """Tasks for a table of ``rows`` narrow rows: one for each ``per_task``, the cores of the session at least."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // per_task))


def written(df: DataFrame, name: str, parts: int | None = None) -> DataFrame:
    """``df`` written as Parquet in the shared checkpoint folder and read back.

    Cuts the lineage: after a lost executor the readers start from the file.
    ``parts``: for the small result of a shuffle, at most so many tasks and files.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    (df.coalesce(parts) if parts else df).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_order(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """``df`` written in the order of ``keys``, with ``part`` and ``at``, both ascending in that order.

    Ranges split whatever the keys tell apart: the last one should be unique.
    """
    ordered = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id())
    return written(ordered, name).withColumn("part", F.shiftright("at", 33))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def fold_of(doc_id: Column) -> Column:
    """crc32 of the decimal text of ``doc_id`` modulo 3 (null ids: fold of the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3
