"""Structured Streaming over captures: window counts, sessions, dedup, control events.

Only closed files are streamed (they appear whole); a trigger of availableNow drains what is there.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.staging import staged_path
from ..operators.merging import merge_sides, sides

#: Timers for the close of a stream are set for this time (year 2200); the mark that closes it has a later one.
CLOSE_MS, MARK = 7_258_118_400_000, "2201-01-01 00:00:00"


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def rocksdb(spark: SparkSession):
    """Streams started inside keep their state in RocksDB, on disk beside the executors, as map states need it."""
    return _setting(spark, "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def stream_capture(spark: SparkSession, folder: str, glob: str = "*", files: int = 16) -> DataFrame:
    """Lines of closed capture files as they appear, with their path and block; at most `files` a trigger, the oldest first.

    A file comes whole in one trigger, so each batch's lines can be numbered in it: `drained(..., each=number_lines)`.
    """
    lines = spark.readStream.option("pathGlobFilter", glob).option("maxFilesPerTrigger", files).text(folder)
    return lines.select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"))


def rotation_counts(stream: DataFrame, hours: int = 12, late: str = "1 hour") -> DataFrame:
    """Messages of each source in tumbling windows."""
    return stream.withWatermark("t", late).groupBy(F.window("t", f"{hours} hours"), "source").agg(F.count("*").alias("n")).select(F.unix_micros("window.start").alias("start_us"), "source", "n")


def sessions(stream: DataFrame, gap_seconds: int, late: str = "1 hour") -> DataFrame:
    """Sessions of a source, parted by silence of gap_seconds."""
    w = F.session_window("t", f"{gap_seconds} seconds")
    return stream.withWatermark("t", late).groupBy(w, "source").agg(F.count("*").alias("n")).select(F.unix_micros("session_window.start").alias("start_us"), F.unix_micros("session_window.end").alias("end_us"), "source", "n")


def control_counts(stream: DataFrame, hours: int = 1, late: str = "1 hour") -> DataFrame:
    """Connection events by window and name."""
    rows = stream.withWatermark("t", late).groupBy(F.window("t", f"{hours} hours"), "source", "event").agg(F.count("*").alias("n"))
    return rows.select(F.unix_micros("window.start").alias("start_us"), "source", "event", "n")


def dedup(stream: DataFrame, key: list[str], late: str = "1 hour") -> DataFrame:
    """First arrival of each key within the watermark."""
    return stream.withWatermark("t", late).dropDuplicatesWithinWatermark(key)


def merged(records: DataFrame, key: list[str], late: str = "1 hour") -> DataFrame:
    """Full outer merge of a primary and a backup stream, as merge_streams has it, each key once the watermark is past it.

    records: side (primary or backup), t (the time in the key, so one for each key), the key, type, us, arrival. Both
    sides meet in one aggregation: state is two records a key of the last `late`, whatever repeats. Records without a
    time, and those more than `late` behind, are left out.
    """
    closes = "closes" if "closes" in records.columns else F.lit(None)
    timed = records.withColumn("t", F.coalesce("t", closes)).withWatermark("t", late)
    both = timed.groupBy("t", *key).agg(*sides(F.col("side"))).where("primary IS NOT NULL OR backup IS NOT NULL")
    return merge_sides(both, key)


def with_close(stream: DataFrame) -> DataFrame:
    """stream with the column closes, and no watermark but that of the marks: no row is ever late."""
    if "closes" not in stream.columns:
        stream = stream.withColumn("closes", F.lit(None).cast("timestamp"))
    return stream.withWatermark("closes", "0 seconds")


def marked(stream: DataFrame) -> tuple[DataFrame, str]:
    """stream with a column closes, null in its rows, and a folder: a file of `close` there is one more row, that closes it."""
    spark = stream.sparkSession
    folder = staged_path(spark, "marks")
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    marks = spark.readStream.schema("closes timestamp").json(folder)
    rows = stream.withColumn("closes", F.lit(None).cast("timestamp")).unionByName(marks, allowMissingColumns=True)
    return rows, folder


def close(spark: SparkSession, folder: str) -> None:
    spark.sql(f"SELECT TIMESTAMP'{MARK}' AS closes").write.mode("append").json(folder)


def drained(result: DataFrame, mode: str, marks: str | None = None, each: Callable[[DataFrame], DataFrame] = lambda batch: batch) -> DataFrame:
    """Runs the stream over all that is there and reads the result back: the last state for complete, all rows for append.

    marks: the folder of `marked`; the stream is closed once it is drained. each: what is done with a batch. Each batch has a folder of its own, so one
    that is run again replaces its rows.
    """
    spark = result.sparkSession
    path = staged_path(spark, f"stream-{uuid.uuid4().hex}")
    part = (lambda i: "") if mode == "complete" else (lambda i: f"/stream_batch={i}")

    def run() -> None:
        write = lambda df, i: each(df).write.mode("overwrite").parquet(f"{path}/out{part(i)}")
        result.writeStream.outputMode(mode).option("checkpointLocation", f"{path}/state").trigger(availableNow=True).foreachBatch(write).start().awaitTermination()

    run()
    if marks is not None:
        close(spark, marks)
        # Keys that are never null in the data may be so in a mark; that alone is no other state.
        with _setting(spark, "spark.sql.streaming.stateStore.stateSchemaCheck", "false"):
            run()
    schema = each(spark.createDataFrame([], result.schema)).schema
    return spark.read.schema(schema).parquet(f"{path}/out").select(*schema.names)
