"""Sharding by sampled splitters (DataFrame functions only).

1. Every record gets a composite key; the last part is a row number that is written once, so keys are
   unique and any range can be split, also inside one hot key.
2. A size-weighted, hash-decided sample of keys (bounded: `oversample` keys a range) gives the
   quantile boundaries of many more ranges than shards.
3. Bytes are counted exactly per range; ranges over twice their share are sampled again and subdivided.
4. Shards are cut at equal bytes along the key order: bytes before a record = bytes of earlier ranges
   (at most `MAX_RANGES` numbers) + a running sum inside its own range.

Defined cases: a null text has no bytes (size 1, crc32 0); null ids sort first; repeated rows are rows of
their own; an empty table gives no rows; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import staged, table, text_or_empty, unit_hash

MIN_RANGES, MAX_RANGES, ROWS_PER_RANGE = 1024, 16384, 100_000


def _literal(rows: list, kind: str) -> Column:
    return F.from_json(F.lit(json.dumps(rows)), kind)


def _range_of(key: Column, splitters: list[dict], kind: str) -> Column:
    """Number of splitters <= key, by bisection over a constant array."""
    if not splitters:
        return F.lit(0)
    steps = [1 << b for b in reversed(range(len(splitters).bit_length()))]
    array = _literal(splitters, f"array<{kind}>")

    def step(pos: Column, by: Column) -> Column:
        inside = (pos + by) <= len(splitters)
        return F.when(inside & (F.get(array, pos + by - 1) <= key), pos + by).otherwise(pos)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), step)


def _boundaries(sample: list[tuple[dict, float]], parts: int) -> list[dict]:
    """Keys at equal steps of the sample's weight; sample is sorted by key."""
    total, seen, out = sum(w for _, w in sample), 0.0, []
    for key, w in sample:
        seen += w
        if len(out) < parts - 1 and seen >= total * (len(out) + 1) / parts:
            while len(out) < parts - 1 and seen >= total * (len(out) + 1) / parts:
                out.append(key)
    return [k for i, k in enumerate(out) if i == 0 or k != out[i - 1]]


def _sampled(keyed: DataFrame, rate: float | Column, seed: int) -> list[tuple[dict, float]]:
    p = F.col("size") * rate
    rows = keyed.where(unit_hash(F.col("key.uid"), F.lit(seed)) < p).select("key", F.greatest(p, F.lit(1.0)).alias("w"))
    return [(r["key"].asDict(), r["w"]) for r in rows.orderBy("key").collect()]


def shard_by_bytes(records: DataFrame, key: list[str], shards: int = 16, oversample: int = 16) -> DataFrame:
    """Adds range, shard and slot to records, which have the columns of `key` and a long `size` >= 1.

    Shards hold consecutive keys; their bytes differ by at most about one record. Slots run from 0 in each
    shard in key order.
    """
    columns = records.columns
    keyed = staged(records.select(F.struct(*key, F.monotonically_increasing_id().alias("uid")).alias("key"), *columns), "shard-keys")
    kind = keyed.schema["key"].dataType.simpleString()
    rows, total = keyed.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    if not rows:
        return records.select(*columns, F.lit(0).alias("range"), F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot")).where("false")
    ranges = max(min(MIN_RANGES, rows), min(MAX_RANGES, rows // ROWS_PER_RANGE))
    splitters = _boundaries(_sampled(keyed, ranges * oversample / total, 1), ranges)

    def measured() -> list:
        placed = keyed.groupBy(_range_of(F.col("key"), splitters, kind).alias("range"))
        return placed.agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).orderBy("range").collect()

    sizes, target = measured(), total / ranges
    over = {r["range"]: r["bytes"] for r in sizes if r["bytes"] > 2 * target and r["n"] > 1}
    if over:
        at = _range_of(F.col("key"), splitters, kind)
        wide = keyed.where(at.isin(sorted(over)))
        extra = _sampled(wide, oversample / target, 2)
        more = _boundaries(extra, max(2, int(2 * sum(over.values()) / target)))
        splitters = [dict(t) for t in sorted({tuple(s.items()) for s in splitters + more}, key=lambda t: tuple((v is not None, v) for _, v in t))]
        sizes = measured()

    bytes_before, rows_before, b, n = {}, {}, 0, 0
    for r in sizes:
        bytes_before[r["range"]], rows_before[r["range"]] = b, n
        b, n = b + r["bytes"], n + r["n"]
    every = range(len(splitters) + 1)
    before = lambda d: F.get(_literal([d.get(i, 0) for i in every], "array<bigint>"), F.col("range"))
    w = Window.partitionBy("range").orderBy("key")
    running = (
        keyed.withColumn("range", _range_of(F.col("key"), splitters, kind))
        .withColumn("_end", F.sum("size").over(w.rowsBetween(Window.unboundedPreceding, 0)) + before(bytes_before))
        .withColumn("_row", F.row_number().over(w) - 1 + before(rows_before))
        .withColumn("shard", F.least(F.lit(shards - 1), F.floor((2 * F.col("_end") - F.col("size")) * shards / F.lit(2.0 * total))).cast("int"))
    )
    cut = staged(running.select(*columns, "range", "shard", "_row"), "shard-cuts")
    first = {r["shard"]: r["at"] for r in cut.groupBy("shard").agg(F.min("_row").alias("at")).collect()}
    start = F.get(_literal([first.get(i, 0) for i in range(shards)], "array<bigint>"), F.col("shard"))
    return cut.withColumn("slot", F.col("_row") - start).drop("_row")


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder a shard, rows in slot order within each file."""
    sharded.repartition("shard", "range").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def document_records(docs: DataFrame) -> DataFrame:
    text = text_or_empty().cast("binary")
    return docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))


def op10_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of near equal bytes, in order of (crc32 of the text, doc_id)."""
    out = shard_by_bytes(document_records(table(spark, sf_dir, "documents")), ["text_crc32", "doc_id"])
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast(T.IntegerType()).alias("grown_shard"))
