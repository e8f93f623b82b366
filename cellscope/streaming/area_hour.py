"""The area-hour job (A3 -> E1 -> A4) as an incremental stream.

New text files dropped into an input folder are split and parsed exactly as
the batch source does, and the running means per (area, hour of day) are
kept in the state store. Groups are hour-of-day buckets, not event-time
windows, so the state is bounded by areas x 24 and needs no watermark.
Each micro-batch rewrites the key-ordered text snapshot of all groups for
its epoch (idempotent on retry), and the checkpoint location makes the
query resume after a failure without double counting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from cellscope.operators.aggregate import area_hour_averages
from cellscope.sources.sinks import area_hour_lines
from cellscope.sources.text import FIELD_SCHEMA, SPLIT_OPTIONS, parse_fields


#: Snapshots that stay: the newest, and some for readers that are still at an older one.
KEEP_EPOCHS = 3


def area_hour_stream(spark: SparkSession, input_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming frame of the area-hour means over the text files of ``input_dir``."""
    reader = spark.readStream.schema(FIELD_SCHEMA).options(**SPLIT_OPTIONS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return area_hour_averages(parse_fields(reader.csv(input_dir)), order=False)


def start_area_hour_stream(spark: SparkSession, input_dir: str, output_dir: str, checkpoint_dir: str,
                           available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Start the stream; every epoch writes ``output_dir/epoch=<n>`` (text lines).

    ``available_now`` processes what is there and stops (batch-like runs);
    otherwise ``processing_time`` (e.g. ``"1 minute"``) keeps it running.
    """
    def write_epoch(batch: DataFrame, epoch_id: int) -> None:
        area_hour_lines(batch).write.mode("overwrite").text(f"{output_dir.rstrip('/')}/epoch={epoch_id}")
        drop_epochs(batch.sparkSession, output_dir, KEEP_EPOCHS)

    writer = (area_hour_stream(spark, input_dir).writeStream.outputMode("complete")
              .foreachBatch(write_epoch).option("checkpointLocation", checkpoint_dir))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def latest_snapshot(spark: SparkSession, output_dir: str) -> DataFrame:
    """The text lines of the newest epoch written by the stream."""
    return spark.read.text(f"{output_dir.rstrip('/')}/epoch={max(epochs(spark, output_dir))}")


def epochs(spark: SparkSession, output_dir: str) -> list[int]:
    """Numbers of the complete snapshots: a listing of folders, not of their files."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(output_dir)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    done = [s.getPath() for s in fs.listStatus(path) if s.getPath().getName().startswith("epoch=")]
    return [int(p.getName().split("=")[1]) for p in done
            if fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]


def drop_epochs(spark: SparkSession, output_dir: str, keep: int) -> None:
    """Delete all snapshots but the ``keep`` newest."""
    for epoch in sorted(epochs(spark, output_dir))[:-keep]:
        old = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{output_dir.rstrip('/')}/epoch={epoch}")
        old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(old, True)
