"""Raw captures: JSON lines with provenance, strict parsing, trades, merged streams, reports and hashes."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

PATH = r"/([^/]+)/([^/]+)/[^/]+$"


def read_capture(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(source, symbol, path, line, value) of plain or gzip JSON lines; lines count from 1 in each file."""
    return number_lines(spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block")))


def number_lines(lines: DataFrame) -> DataFrame:
    """Lines (value, path, block: where their split of the file begins), as read, with their source, symbol and line number.

    A file's splits are counted apart; each line number is the place in its split plus the lines of the splits before.
    A batch of a stream may be numbered too, as it holds whole files.
    """
    lines = lines.select("value", "path", "block", F.monotonically_increasing_id().alias("_id"))
    splits = lines.groupBy("path", "block").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = lines.join(splits.withColumn("_before", before), ["path", "block"]).withColumn("line", F.col("_id") - F.col("_first") + F.col("_before") + 1)
    return numbered.select(F.regexp_extract("path", PATH, 1).alias("source"), F.regexp_extract("path", PATH, 2).alias("symbol"), "path", "line", "value")


def is_json_object(value: Column) -> Column:
    """Strict: what follows a value is an error, so the text must parse inside brackets and inside an object; only objects count."""
    inside = F.try_parse_json(F.concat(F.lit("["), value, F.lit("]"))).isNotNull() & F.try_parse_json(F.concat(F.lit('{"v":'), value, F.lit("}"))).isNotNull()
    return F.coalesce(inside & (F.trim(value).startswith("{")), F.lit(False))


def parse_capture(lines: DataFrame) -> DataFrame:
    """Envelope columns and typed payload ids of each line; broken lines have json_error and nulls. Paths are case-sensitive."""
    data = F.when(is_json_object(F.col("value")), F.try_parse_json("value"))
    get = lambda path, kind: F.try_variant_get("_v", path, kind)
    rows = lines.withColumn("_v", data)
    return rows.select(
        *[c for c in lines.columns if c != "value"], F.col("_v").isNull().alias("json_error"), get("$.recv_time", "string").alias("recv_time"), get("$.recv_ns", "bigint").alias("recv_ns"), get("$.exchange", "string").alias("exchange"),
        get("$.kind", "string").alias("kind"), get("$.data.type", "string").alias("type"), get("$.data.e", "string").alias("e_type"), get("$.data.E", "bigint").alias("event_ms"), get("$.data.U", "bigint").alias("first_id"),
        get("$.data.u", "bigint").alias("last_id"), get("$.data.lastUpdateId", "bigint").alias("snap_id"), get("$.data.time", "string").alias("time"), get("$.data.event", "string").alias("ctl"),
        get("$.data.product_id", "string").alias("product_id"), get("$.data.changes", "array<array<string>>").alias("changes"), get("$.data.bids", "array<array<string>>").alias("bids"), get("$.data.asks", "array<array<string>>").alias("asks"), "_v",
    ).withColumnRenamed("_v", "record")


def read_trades(lines: DataFrame) -> DataFrame:
    """Trades of both exchanges; kind is ws_match for matches only; an id is t, else a."""
    v = lines.withColumn("_v", F.when(is_json_object(F.col("value")), F.try_parse_json("value"))).where("_v IS NOT NULL")
    get = lambda path, kind: F.try_variant_get("_v", path, kind)
    match = F.coalesce(get("$.data.type", "string").isin("match", "last_match"), F.lit(False))
    coin = get("$.exchange", "string").startswith("coinbase")
    return v.select(
        get("$.exchange", "string").alias("exchange"), get("$.symbol", "string").alias("symbol"), F.coalesce(get("$.data.t", "bigint"), get("$.data.a", "bigint"), get("$.data.trade_id", "bigint")).alias("trade_id"),
        F.coalesce(get("$.data.p", "double"), get("$.data.price", "double")).alias("price"), F.coalesce(get("$.data.q", "double"), get("$.data.size", "double")).alias("qty"), get("$.data.side", "string").alias("side"),
        get("$.data.E", "bigint").alias("event_ms"), F.when(coin & match, "ws_match").when(coin, "ws_message").otherwise("ws_trade").alias("kind"),
    )


def write_stream(df: DataFrame, order: list[Column | str], path: str, partitions: int = 200) -> None:
    """A merged stream as gzip JSON lines in merge order: files and their rows are ranges of the order (names or columns, nulls first)."""
    keyed = df.withColumns({f"_o{i}": F.col(c) if isinstance(c, str) else c for i, c in enumerate(order)})
    names = [F.col(f"_o{i}").asc_nulls_first() for i in range(len(order))]
    rows = keyed.repartitionByRange(partitions, *names).sortWithinPartitions(*names)
    rows.select(F.to_json(F.struct(*df.columns)).alias("value")).write.option("compression", "gzip").text(path)


def write_partitions(df: DataFrame, order: list[str], path: str, keys: list[str] = ["source", "d"], partitions: int = 200) -> None:
    """The same as Parquet, a folder a source and day; in each, files and their rows are ranges of the order, nulls first.

    Only the folders that df has rows for are replaced, so a batch that is written again doesn't double its rows.
    """
    by = [F.col(c).asc_nulls_first() for c in [*keys, *order]]
    rows = df.repartitionByRange(partitions, *by).sortWithinPartitions(*by)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def partition_manifest(spark: SparkSession, path: str, order: list[str], keys: list[str] = ["source", "d"]) -> DataFrame:
    """Each file of write_partitions: its keys, place in its folder (from 1), rows, and first and last row of the order."""
    at = F.struct(*order)
    files = spark.read.parquet(path).select(*keys, F.col("_metadata.file_path").alias("path"), at.alias("at"))
    files = files.groupBy(*keys, "path").agg(F.count("*").alias("rows"), F.min("at").alias("first"), F.max("at").alias("last"))
    return files.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy("first", "path")))


def feature_columns(n: int = 10) -> list[str]:
    """Names and order of a feature table's columns, with n levels a side."""
    levels = [f"{side}_{what}_{i}" for i in range(1, n + 1) for side in ("bid", "ask") for what in ("px", "sz")]
    return [
        "ts", "segment_id", "segment_start_time", "segment_start_reason", "gap_from_previous_segment", "row_quality", "updates", "changed_buy_levels", "changed_sell_levels", "removed_buy_levels", "removed_sell_levels",
        "gap_flag", "gap_seconds", "best_bid", "best_ask", "best_bid_size", "best_ask_size", "mid", "spread", "microprice", f"bid_depth_top{n}", f"ask_depth_top{n}", f"imbalance_top{n}", *levels,
    ]


def write_features(df: DataFrame, path: str, n: int = 10, keys: list[str] = ["source", "segment", "bar"], partitions: int = 200) -> None:
    """CSV with a header: the keys that df has, then those of feature_columns(n) that it has, in that order.

    Files and their rows are ranges of the keys. A column that is neither raises ValueError.
    """
    own, fixed = [k for k in keys if k in df.columns], feature_columns(n)
    other = [c for c in df.columns if c not in own and c not in fixed]
    if other:
        raise ValueError(f"not columns of a feature table: {other}")
    rows = df.select(*own, *[c for c in fixed if c in df.columns])
    by = own or [c for c in ("ts",) if c in df.columns]
    if by:
        rows = rows.repartitionByRange(partitions, *by).sortWithinPartitions(*by)
    rows.write.option("header", True).csv(path)


def read_audit(spark: SparkSession, pattern: str) -> DataFrame:
    """One row a JSON report: its path, whether it is broken, and the parsed document."""
    files = spark.read.option("wholetext", True).text(pattern).select(F.col("_metadata.file_path").alias("path"), "value")
    return files.select("path", (~is_json_object(F.col("value"))).alias("corrupt"), F.when(is_json_object(F.col("value")), F.try_parse_json("value")).alias("report"))


def file_catalog(spark: SparkSession, pattern: str, role: str, with_hash: bool = True, whole: int = 1 << 26, opened: Callable[[str], BinaryIO] | None = None) -> DataFrame:
    """role, path, bytes, mtime and sha256 of files of any size; those over `whole` bytes are hashed block by block.

    Spark's reader passes over empty files, so they have no row; hash_files takes them.
    """
    files = spark.read.format("binaryFile").load(pattern)
    cols = [F.lit(role).alias("role"), "path", F.col("length").alias("bytes"), F.col("modificationTime").alias("mtime_utc")]
    if not with_hash:
        return files.select(*cols)
    small = files.where(F.col("length") <= whole).select(*cols, F.sha2("content", 256).alias("sha256"))
    large = files.where(F.col("length") > whole).select(*cols)  # the content isn't read here
    return small.unionByName(_hashed(large, 1 << 22, opened or open_stream))


def open_stream(path: str) -> BinaryIO:
    """A stream of a file's bytes: a path or file: name as it is, any other scheme by pyarrow's file systems (hdfs, s3, gs, abfs)."""
    if path.startswith("file:") or ":" not in path.split("/")[0]:
        path = path.removeprefix("file:")
        return open("/" + path.lstrip("/") if path.startswith("/") else path, "rb")
    system, at = FileSystem.from_uri(path)
    return system.open_input_stream(at)


def _hashed(files: DataFrame, block: int, opened: Callable[[str], BinaryIO]) -> DataFrame:
    """files with sha256."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for path in b.column("path").to_pylist():
                h = hashlib.sha256()
                with opened(path) as f:
                    while part := f.read(block):
                        h.update(part)
                out.append(h.hexdigest())
            yield b.append_column("sha256", pa.array(out, pa.string()))

    return files.mapInArrow(run, StructType([*files.schema.fields, StructField("sha256", StringType())]))


def hash_files(paths: DataFrame, block: int = 1 << 22, opened: Callable[[str], BinaryIO] = open_stream) -> DataFrame:
    """(path, sha256) of files that executors reach, read block by block; opened: opens further schemes."""
    return _hashed(paths.select("path"), block, opened)
