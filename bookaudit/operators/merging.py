"""Merging a primary and a backup stream message by message."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quality import in_time_range


def keep_mergeable(records: DataFrame) -> DataFrame:
    return records.where("type IN ('snapshot', 'l2update', 'subscriptions') OR kind = 'control_event'")


def canonical_payload(type_: Column, changes: Column, bids: Column, asks: Column, data: Column) -> Column:
    """JSON text that a record's hash is of: changes, the top ten and sizes of a snapshot, or the whole payload.

    Null changes, bids and asks count as empty lists.
    """
    changes, bids, asks = (F.coalesce(c, F.array().cast("array<array<string>>")) for c in (changes, bids, asks))
    # Names in order, as sorted JSON has them.
    top = F.to_json(F.struct(F.size(asks).alias("asks_len"), F.slice(asks, 1, 10).alias("asks_top"), F.size(bids).alias("bids_len"), F.slice(bids, 1, 10).alias("bids_top")))
    return F.when(type_ == "l2update", F.to_json(changes)).when(type_ == "snapshot", top).otherwise(data)


def dedup_key(type_: Column, kind: Column, product: Column, symbol: Column, time: Column, recv_time: Column, payload: Column) -> Column:
    return F.struct(
        F.coalesce(type_, kind, F.lit("unknown")).alias("message"), F.coalesce(product, symbol, F.lit("")).alias("product"),
        F.coalesce(time, recv_time, F.lit("")).alias("time"), F.sha2(payload, 256).alias("hash"),
    )


def stream_counts(records: DataFrame, keys: list[str], start: int | None = None, end: int | None = None) -> DataFrame:
    rows = in_time_range(records, "us", start, end, closed="both")
    count = lambda t: F.count_if(F.col("type") == t)
    return rows.groupBy(*keys).agg(
        F.count("*").alias("records_seen"), count("l2update").alias("l2updates"), count("snapshot").alias("snapshots"), count("subscriptions").alias("subscriptions"),
        F.count_if(F.coalesce(~F.col("type").isin("l2update", "snapshot", "subscriptions"), F.lit(True)) & (F.col("kind") == "control_event")).alias("controls"),
    )


def sides(side: Column) -> list[Column]:
    """Aggregates of a key's records: of each side the last record, which wins, and the first arrival, which keeps its place."""
    out = []
    for name in ("primary", "backup"):
        arrival = F.when(side == name, F.col("arrival"))
        last = F.max_by(F.struct("type", "us", "arrival"), arrival)
        out.append(F.when(F.max(arrival).isNotNull(), F.struct(last.alias("last"), F.min(arrival).alias("first"))).alias(name))
    return out


def merge_sides(both: DataFrame, key: list[str]) -> DataFrame:
    """One record a key from both sides' aggregates: the primary's, where there is one."""
    here, there = F.col("primary").isNotNull(), F.col("backup").isNotNull()
    source = F.when(here & there, "both").when(here, "primary").otherwise("backup")
    pick = lambda c, name: F.when(here, F.col(f"primary.{c}")).otherwise(F.col(f"backup.{c}")).alias(name)
    return both.select(*key, source.alias("source"), pick("last.type", "type"), pick("last.us", "us"), pick("first", "first"), F.col("primary.last.arrival").alias("primary_arrival"), F.col("backup.last.arrival").alias("backup_arrival"))


def merge_streams(primary: DataFrame, backup: DataFrame, key: list[str]) -> DataFrame:
    """Full outer merge on the dedup key; the primary's record wins. Payloads are joined back by arrival later.

    Both sides meet in one aggregation, which combines a key's records before they are shuffled.
    """
    cols = [*key, "type", "us", "arrival"]
    every = primary.select(*cols, F.lit("primary").alias("side")).unionByName(backup.select(*cols, F.lit("backup").alias("side")))
    return merge_sides(every.groupBy(*key).agg(*sides(F.col("side"))), key)


def merge_order_by_time(merged: DataFrame) -> list[Column]:
    """Sort keys: time, kind of message, primary first, then the place of the key's first record."""
    rank = F.when(F.col("type") == "subscriptions", 0).when(F.col("type") == "snapshot", 1).when(F.col("type") == "l2update", 2).otherwise(3)
    return [F.col("us").asc_nulls_first(), rank, F.when(F.col("source") == "backup", 1).otherwise(0), F.col("first")]


def source_counts(merged: DataFrame, keys: list[str]) -> DataFrame:
    n = lambda s: F.count_if(F.col("source") == s)
    return merged.groupBy(*keys).agg(n("primary").alias("primary_only"), n("backup").alias("backup_only"), n("both").alias("both"))
