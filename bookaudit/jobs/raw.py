"""Queries of the raw readers over JSON lines that Spark writes from the events, with the SQL they are checked by."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.staging import staged_path
from ..sources import capture
from ..sources.fixtures import ctes, fixture
from ..streaming import windows as W
from . import book, continuity


def _lines(spark: SparkSession, d: str) -> DataFrame:
    """Envelopes as JSON text; every 23rd line is broken."""
    e = fixture(spark, d, "e")
    binance = F.struct(F.when(F.col("id") % 3 != 0, F.col("id")).alias("t"), (F.col("id") + 7).alias("a"), F.col("value").cast("string").alias("p"), F.lit("2.5").alias("q"), F.expr("us div 1000").alias("E"))
    coin = F.struct(F.when(F.col("id") % 5 == 0, "heartbeat").otherwise(F.when(F.col("id") % 2 == 0, "match").otherwise("last_match")).alias("type"), F.col("id").alias("trade_id"), F.col("value").cast("string").alias("price"), F.lit("1").alias("size"), F.lit("buy").alias("side"))
    envelope = lambda exchange, data: F.to_json(F.struct(F.lit(exchange).alias("exchange"), F.lit("BTC").alias("symbol"), F.lit("ws_trade").alias("kind"), data.alias("data")))
    text = F.when(F.col("id") % 2 == 1, envelope("binance", binance)).otherwise(envelope("coinbase", coin))
    return e.select("id", F.when(F.col("id") % 23 == 0, F.concat(text, F.lit(" x"))).otherwise(text).alias("value"))


def parse_capture(spark: SparkSession, d: str) -> DataFrame:
    parsed = capture.parse_capture(_lines(spark, d))
    return parsed.select("id", "json_error", "exchange", "kind", "type", "event_ms")


def read_trades(spark: SparkSession, d: str) -> DataFrame:
    return capture.read_trades(_lines(spark, d))


def _files(spark: SparkSession, d: str) -> str:
    """A folder of captures: one file a source and day, the events in order, in folders s=source/d=day."""
    e = fixture(spark, d, "e").select(F.when(F.col("id") % 2 == 1, "binance").otherwise("coinbase").alias("s"), "d", "id", "props")
    folder = staged_path(spark, "captures")
    rows = e.repartition("s", "d").sortWithinPartitions("s", "d", "id").select("s", "d", F.concat(F.lit('{"id":'), F.col("id").cast("string"), F.lit(',"data":'), "props", F.lit("}")).alias("value"))
    rows.write.partitionBy("s", "d").text(folder)
    return folder


def _placed(lines: DataFrame) -> DataFrame:
    name = lambda c: F.split_part(F.col(c), F.lit("="), F.lit(2))
    return lines.select(name("source").alias("source"), name("symbol").alias("d"), "line", F.regexp_extract("value", r'"id":([0-9]+)', 1).cast("long").alias("id"))


def read_capture(spark: SparkSession, d: str) -> DataFrame:
    return _placed(capture.read_capture(spark, _files(spark, d)))


def stream_capture(spark: SparkSession, d: str) -> DataFrame:
    """The same lines as a stream, a few files a trigger, numbered batch by batch."""
    return _placed(W.drained(W.stream_capture(spark, _files(spark, d)), "append", each=capture.number_lines))


def file_catalog(spark: SparkSession, d: str) -> DataFrame:
    """Sizes and hashes of the files, the larger ones hashed block by block."""
    files = capture.file_catalog(spark, f"{_files(spark, d)}/*/*/*", "raw:capture", whole=1 << 13)
    part = lambda i: F.regexp_extract("path", "/s=([^/]+)/d=([^/]+)/", i)
    return files.select(part(1).alias("source"), part(2).alias("d"), "role", "bytes", "sha256")


def write_stream(spark: SparkSession, d: str) -> DataFrame:
    """Messages of both sources written in merge order and read back: each one's place over all files."""
    out = staged_path(spark, "merged")
    capture.write_stream(fixture(spark, d, "m").select("source", "id", "arrival", "us"), ["us", "source", "arrival"], out, 8)
    lines = capture.read_capture(spark, out)
    ends = lines.groupBy("path").agg(F.max("line").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("path").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # one row a file
    placed = lines.drop("source").join(ends.select("path", before.alias("before")), "path")
    return placed.select((F.col("before") + F.col("line")).alias("place"), F.from_json("value", "source string, arrival long").alias("r")).select("place", "r.*")


def partition_manifest(spark: SparkSession, d: str) -> DataFrame:
    """The merged stream as folders of source and day: rows, ends of the range, and files that begin before the one ahead of them ends."""
    out = staged_path(spark, "folders")
    capture.write_partitions(fixture(spark, d, "m").select("source", "d", "us", "arrival"), ["us", "arrival"], out, partitions=64)
    files = capture.partition_manifest(spark, out, ["us", "arrival"])
    behind = F.lag("last").over(Window.partitionBy("source", "d").orderBy("place"))
    files = files.withColumn("overlaps", F.coalesce(F.col("first") <= behind, F.lit(False)))
    total = files.groupBy("source", F.col("d").cast("string").alias("d")).agg(F.sum("rows").alias("rows"), F.min("first").alias("first"), F.max("last").alias("last"), F.count_if("overlaps").alias("overlaps"))
    return total.select("source", "d", "rows", F.col("first.us").alias("first_us"), F.col("last.us").alias("last_us"), "overlaps")


def write_features(spark: SparkSession, d: str) -> DataFrame:
    """The feature table by way of its CSV files."""
    rows, out = book.book_features(spark, d), staged_path(spark, "features")
    capture.write_features(rows, out, book.N, partitions=8)
    by_place = spark.read.option("header", True).csv(out)
    return by_place.select(*[F.col(c).cast(t).alias(c) for c, t in rows.dtypes])


def read_audit(spark: SparkSession, d: str) -> DataFrame:
    """The quality report of each day as a file, every seventh day's cut short, and what is read of it."""
    day = F.day(F.to_date("d"))
    text = F.when(day % 7 == 0, F.expr("substring(value, 1, length(value) - 1)")).otherwise(F.col("value"))
    out = staged_path(spark, "reports")
    continuity.quality_report(spark, d).select("d", text.alias("value")).repartition("d").write.partitionBy("d").text(out)
    reports = capture.read_audit(spark, f"{out}/d=*/*")
    status = lambda source: F.try_variant_get("report", f"$.sources.{source}.status", "string")
    return reports.select(F.regexp_extract("path", "/d=([^/]+)/", 1).alias("d"), "corrupt", status("binance").alias("primary_status"), status("binance_backup").alias("backup_status"))


QUERIES = [parse_capture, read_trades, read_capture, stream_capture, file_catalog, write_stream, partition_manifest, write_features, read_audit]

LINES = f"""WITH {ctes('e')}, c AS (SELECT CASE WHEN id % 2 = 1 THEN 'binance' ELSE 'coinbase' END AS source, CAST(d AS VARCHAR) AS d, id, '{{"id":' || id || ',"data":' || props || '}}' AS value FROM e)
        """

ORACLE = {
    "parse_capture": f"""WITH {ctes('e')} SELECT id, id % 23 = 0 AS json_error, CASE WHEN id % 23 = 0 THEN NULL WHEN id % 2 = 1 THEN 'binance' ELSE 'coinbase' END AS exchange, CASE WHEN id % 23 <> 0 THEN 'ws_trade' END AS kind,
        CASE WHEN id % 23 <> 0 AND id % 2 = 0 THEN CASE WHEN id % 5 = 0 THEN 'heartbeat' ELSE 'match' END END AS type, CASE WHEN id % 23 <> 0 AND id % 2 = 1 THEN us // 1000 END AS event_ms FROM e""",
    "read_trades": f"""WITH {ctes('e')} SELECT CASE WHEN id % 2 = 1 THEN 'binance' ELSE 'coinbase' END AS exchange, 'BTC' AS symbol, CASE WHEN id % 2 = 1 AND id % 3 = 0 THEN id + 7 ELSE id END AS trade_id, value AS price,
        CAST(CASE WHEN id % 2 = 1 THEN 2.5 ELSE 1.0 END AS DOUBLE) AS qty, CASE WHEN id % 2 = 0 THEN 'buy' END AS side, CASE WHEN id % 2 = 1 THEN us // 1000 END AS event_ms,
        CASE WHEN id % 2 = 1 THEN 'ws_trade' WHEN id % 5 = 0 THEN 'ws_message' ELSE 'ws_match' END AS kind FROM e WHERE id % 23 <> 0""",
    "read_capture": LINES + "SELECT source, d, row_number() OVER (PARTITION BY source, d ORDER BY id) AS line, id FROM c",
    "stream_capture": LINES + "SELECT source, d, row_number() OVER (PARTITION BY source, d ORDER BY id) AS line, id FROM c",
    "file_catalog": LINES + """, f AS (SELECT source, d, string_agg(value || chr(10), '' ORDER BY id) AS content FROM c GROUP BY ALL) SELECT source, d, 'raw:capture' AS role, octet_length(encode(content)) AS bytes, sha256(content) AS sha256 FROM f""",
    "write_stream": f"WITH {ctes('m')} SELECT row_number() OVER (ORDER BY us, source, arrival) AS place, source, arrival FROM m",
    "partition_manifest": f"WITH {ctes('m')} SELECT source, CAST(d AS VARCHAR) AS d, count(*) AS rows, min(us) AS first_us, max(us) AS last_us, 0 AS overlaps FROM m GROUP BY ALL",
    "write_features": book.ORACLE["book_features"],
    "read_audit": continuity.ALL_GRADED + """SELECT d, corrupt, CASE WHEN NOT corrupt THEN p END AS primary_status, CASE WHEN NOT corrupt THEN b END AS backup_status FROM
        (SELECT d, day(CAST(d AS DATE)) % 7 = 0 AS corrupt, max(CASE WHEN source = 'binance' THEN status END) AS p, max(CASE WHEN source = 'binance_backup' THEN status END) AS b FROM graded GROUP BY d)""",
}
