"""Streaming queries over the events file, drained, with the batch SQL they are checked by."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import book as B
from ..operators import merging as G
from ..sources.fixtures import ctes, fixture
from ..streaming import stateful
from ..streaming.book import stream_book_bars as book_bars
from ..streaming import windows as W
from .book import BAR, N, features_sql
from .continuity import ORACLE as BATCH
from .patching import ORACLE as PATCHED
from .patching import RECORDS


def _events(spark: SparkSession, d: str) -> DataFrame:
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").option("maxFilesPerTrigger", 16).parquet(d)


def _stream(spark: SparkSession, d: str) -> DataFrame:
    return _events(spark, d).select(F.col("event_id").alias("id"), F.col("ts").cast("timestamp").alias("t"), F.when(F.col("event_id") % 2 == 0, "binance").otherwise("coinbase").alias("source"), "event_type", "user_id")


def stream_rotation_counts(spark: SparkSession, d: str) -> DataFrame:
    return W.drained(W.rotation_counts(_stream(spark, d)), "complete")


def stream_sessions(spark: SparkSession, d: str) -> DataFrame:
    return W.drained(W.sessions(_stream(spark, d), 900), "complete")


def stream_control_counts(spark: SparkSession, d: str) -> DataFrame:
    rows = _stream(spark, d).where("event_type = 'error'").withColumn("event", F.when(F.col("id") % 3 == 0, "connection_closed").otherwise("reconnect_sleep"))
    return W.drained(W.control_counts(rows, 24), "complete")


def stream_dedup(spark: SparkSession, d: str) -> DataFrame:
    rows = _stream(spark, d).withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    out = W.drained(W.dedup(rows, ["id"]), "append")
    return out.select("id", "source")


def stream_merge(spark: SparkSession, d: str) -> DataFrame:
    """Primary and backup of a stream merged on the dedup key, with the provenance of both."""
    rec = spark.sql(f"WITH {RECORDS.replace('FROM m)', 'FROM {m})')} SELECT * FROM rec", m=fixture(spark, d, "m", _events(spark, d)))
    key = G.dedup_key(*[rec[c] for c in ("type", "kind", "product_id", "symbol", "time", "recv_time", "payload")])
    keyed = rec.select("d", "type", "us", "arrival", F.when(F.col("source") == "coinbase", "primary").otherwise("backup").alias("side"), key.alias("k"))
    keyed = keyed.select("d", "type", "us", "arrival", "side", F.col("k.message").alias("msg_type"), "k.product", "k.time", "k.hash", F.timestamp_micros(F.col("k.time").cast("long")).alias("t"))
    rows, marks = W.marked(keyed)
    out = W.drained(W.merged(rows, ["d", "msg_type", "product", "time", "hash"]), "append", marks)
    return out.withColumn("d", F.col("d").cast("string"))


def _checked(spark: SparkSession, d: str, check) -> DataFrame:
    """Events are minutes apart here, so messages may be days behind."""
    rows, marks = W.marked(fixture(spark, d, "cap", _events(spark, d)))
    with W.rocksdb(spark):
        out = W.drained(check(rows, late=172_800.0), "append", marks)
    return out.withColumn("d", F.col("d").cast("string"))


def stream_seq_gaps(spark: SparkSession, d: str) -> DataFrame:
    return _checked(spark, d, stateful.stream_seq_gaps)


def stream_snapshot_bridge(spark: SparkSession, d: str) -> DataFrame:
    return _checked(spark, d, stateful.stream_snapshot_bridge)


def _messages(spark: SparkSession, d: str) -> DataFrame:
    """Stream of updates with their changes and of snapshots with their levels."""
    change = """transform(sequence(0, CAST(id % 3 AS INT)), j -> named_struct('j', j, 'side', IF((id + j) % 2 = 0, 'buy', 'sell'),
      'price', IF((id + j) % 2 = 0, 100D - ((k + 7 * j) % 20) * 0.5D, 100.5D + ((k + 7 * j) % 20) * 0.5D), 'size', IF((id + j) % 4 = 0, 0D, value)))"""
    level = "flatten(transform(sequence(0, 9), i -> array(named_struct('side', 'buy', 'price', 100D - 0.5D * i, 'size', 1D + i), named_struct('side', 'sell', 'price', 100.5D + 0.5D * i, 'size', 1D + i))))"
    updates = fixture(spark, d, "m", _events(spark, d)).where("source = 'coinbase'").withColumn("c", F.expr(change))
    updates = updates.select("source", "arrival", "us", F.lit(False).alias("is_snapshot"), F.expr("transform(filter(c, x -> (id + x.j) % 31 <> 0), x -> named_struct('side', x.side, 'price', x.price, 'size', x.size))").alias("levels"))
    snaps = fixture(spark, d, "snap", _events(spark, d)).select(F.lit("coinbase").alias("source"), "arrival", "us", F.lit(True).alias("is_snapshot"), F.expr(level).alias("levels"))
    return updates.unionByName(snaps)


def stream_book_bars(spark: SparkSession, d: str) -> DataFrame:
    """Features of every bar, as book_features has them."""
    messages, marks = W.marked(_messages(spark, d))
    with W.rocksdb(spark):
        rows = W.drained(book_bars(messages, BAR, N), "append", marks)
    rows = B.book_features(rows, N)
    return rows.withColumns({c: F.round(c, 9) for c, t in rows.dtypes if t == "double"})


QUERIES = [stream_book_bars, stream_rotation_counts, stream_sessions, stream_control_counts, stream_dedup, stream_merge, stream_seq_gaps, stream_snapshot_bridge]

SRC = f"WITH {ctes('e')}, s AS (SELECT *, CASE WHEN id % 2 = 0 THEN 'binance' ELSE 'coinbase' END AS source FROM e)"
ORACLE = {
    "stream_book_bars": features_sql(),
    "stream_rotation_counts": f"{SRC} SELECT us - us % 43200000000 AS start_us, source, count(*) AS n FROM s GROUP BY ALL",
    "stream_sessions": f"""{SRC}, p AS (SELECT *, CASE WHEN us - lag(us) OVER (PARTITION BY source ORDER BY us) < 900000000 THEN 0 ELSE 1 END AS new FROM s),
        q AS (SELECT *, sum(new) OVER (PARTITION BY source ORDER BY us) AS session FROM p) SELECT min(us) AS start_us, max(us) + 900000000 AS end_us, source, count(*) AS n FROM q GROUP BY source, session""",
    "stream_control_counts": f"{SRC} SELECT us - us % 86400000000 AS start_us, source, CASE WHEN id % 3 = 0 THEN 'connection_closed' ELSE 'reconnect_sleep' END AS event, count(*) AS n FROM s WHERE event_type = 'error' GROUP BY ALL",
    "stream_seq_gaps": BATCH["seq_gaps_arrival"],
    "stream_snapshot_bridge": f"SELECT source, d, segment, snap_id, bridge_status FROM ({BATCH['snapshot_bridge']})",
    "stream_merge": PATCHED["merge_streams"],
    "stream_dedup": f"{SRC} SELECT id, source FROM s",
}
