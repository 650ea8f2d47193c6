"""Sequence and time continuity of captured streams.

Messages: source, d (day), msg (update, snapshot, control, json_error), arrival (order of the capture), us (event
time, micros), first_id, last_id, snap_id. Sequence checks in arrival order restart at each snapshot; those in id
order don't.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import seconds
from ..functions.sliced import ARRIVALS, MICROS, previous, running, running_sum

KEY = ["source", "d"]


def followed(messages: DataFrame, keys: list[str] = KEY, width: int = ARRIVALS, extra: list[str] = []) -> DataFrame:
    """Snapshots and updates with their segment, the last id-bearing row since the segment's snapshot, and is_gap; extra columns stay."""
    rows = messages.where("msg IN ('update', 'snapshot')").select(*keys, "msg", "arrival", "us", "first_id", "last_id", "snap_id", *extra)
    snapshot = F.col("msg") == "snapshot"
    none = F.lit(None).cast("long")
    seen = F.when(snapshot, F.struct(none.alias("last_id"), none.alias("us"))).when(F.col("last_id").isNotNull(), F.struct("last_id", "us"))
    rows = running(rows, keys, "arrival", {"segment": snapshot.cast("long")}, {"_seen": seen}, width)
    return rows.withColumn("is_gap", F.coalesce(~snapshot & (F.col("first_id") != F.col("_seen.last_id") + 1), F.lit(False)))


def seq_gaps_arrival(messages: DataFrame, keys: list[str] = KEY, width: int = ARRIVALS) -> DataFrame:
    """Updates whose first id isn't the last seen id + 1, in arrival order; missing may be zero or less."""
    rows = followed(messages, keys, width).where("is_gap")
    return rows.select(*keys, "segment", "arrival", F.col("_seen.last_id").alias("prev_last_id"), "first_id", "last_id", (F.col("first_id") - F.col("_seen.last_id") - 1).alias("missing"), F.col("_seen.us").alias("prev_us"), "us")


def seq_gaps_by_id(messages: DataFrame, keys: list[str] = KEY, width: int = 300_000) -> DataFrame:
    """The same test in id order, without restarts; rows without both ids take no part."""
    rows = messages.where("msg = 'update' AND first_id IS NOT NULL AND last_id IS NOT NULL").select(*keys, "first_id", "last_id", "arrival", "us")
    rows = rows.withColumn("_at", F.struct("first_id", "last_id", "arrival"))
    w = Window.partitionBy(*keys, "_slice").orderBy("_at")
    cut = rows.withColumn("_slice", F.floor(F.col("first_id") / F.lit(width))).withColumn("_here", F.struct("last_id", "us"))
    ends = cut.groupBy(*keys, "_slice").agg(F.max_by("_here", "_at").alias("_end"))
    before = ends.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_slice").alias("_s"), F.lag("_end").over(Window.partitionBy(*keys).orderBy("_slice")).alias("_before"))
    on = cut["_slice"] == before["_s"]
    for k in keys:
        on &= cut[k].eqNullSafe(before[f"_{k}"])
    prev = F.coalesce(F.col("_local"), F.col("_before"))
    out = cut.withColumn("_local", F.lag("_here").over(w)).join(before, on, "left").withColumn("_prev", prev).where("first_id <> _prev.last_id + 1")
    return out.select(
        *keys, (F.col("_prev.last_id") + 1).alias("missing_from"), (F.col("first_id") - 1).alias("missing_to"), F.col("_prev.last_id").alias("prev_last_id"),
        F.col("first_id").alias("next_first_id"), F.col("last_id").alias("next_last_id"), F.col("_prev.us").alias("prev_us"), F.col("us").alias("next_us"),
    )


def time_gaps_sorted(updates: DataFrame, keys: list[str] = KEY, width: int = MICROS) -> DataFrame:
    """Differences of consecutive event times in time order: prev_us, us, seconds."""
    rows = updates.where("us IS NOT NULL").select(*keys, "us")
    return previous(rows, keys, "us", F.col("us"), "prev_us", width).where("prev_us IS NOT NULL").withColumn("seconds", seconds(F.col("us") - F.col("prev_us")))


def time_gaps_arrival(updates: DataFrame, threshold: float = 2.0, keys: list[str] = KEY, width: int = ARRIVALS) -> DataFrame:
    """Gaps of at least `threshold` seconds in arrival order, numbered; backward steps are no gaps."""
    rows = updates.where("us IS NOT NULL").select(*keys, "arrival", "us")
    gaps = previous(rows, keys, "arrival", F.col("us"), "start_us", width).withColumn("seconds", seconds(F.col("us") - F.col("start_us"))).where(F.col("seconds") >= threshold)
    return gaps.select(*keys, F.col("arrival").alias("gap_seq"), "start_us", F.col("us").alias("end_us"), "seconds")


def nonmonotone_arrival(updates: DataFrame, keys: list[str] = KEY, width: int = ARRIVALS) -> DataFrame:
    """Number of steps back by more than a millisecond, in arrival order."""
    rows = previous(updates.where("us IS NOT NULL").select(*keys, "arrival", "us"), keys, "arrival", F.col("us"), "prev_us", width)
    return rows.groupBy(*keys).agg(F.count_if(F.col("us") - F.col("prev_us") < -1000).alias("backward_steps"))


def gap_stats(gaps: DataFrame, streams: DataFrame, thresholds: list[float], keys: list[str] = KEY) -> DataFrame:
    """Count, total and largest of the gaps of at least each threshold; zero rows where a stream has none.

    Micros are summed as integers and divided once.
    """
    us = F.round(F.col("seconds") * 1e6).cast("long")
    per = [F.struct(F.lit(float(th)).alias("threshold"), F.count_if(F.col("seconds") >= th).alias("n"), F.sum(F.when(F.col("seconds") >= th, us)).alias("total"), F.max(F.when(F.col("seconds") >= th, us)).alias("top")) for th in thresholds]
    found = gaps.groupBy(*keys).agg(F.array(*per).alias("all"))
    none = F.array(*[F.struct(F.lit(float(th)).alias("threshold"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("total"), F.lit(0).cast("long").alias("top")) for th in thresholds])
    out = streams.select(*keys).distinct().join(found, keys, "left").select(*keys, F.explode(F.coalesce("all", none)).alias("s"))
    zero = F.lit(0).cast("long")
    return out.select(*keys, "s.threshold", F.col("s.n").alias("gaps"), seconds(F.coalesce("s.total", zero)).alias("total_seconds"), seconds(F.coalesce("s.top", zero)).alias("max_seconds"))


def gap_examples(gaps: DataFrame, order: str, columns: list[str], n: int = 20, keys: list[str] = KEY) -> DataFrame:
    """The first n gaps of each stream, numbered."""
    w = Window.partitionBy(*keys).orderBy(order)
    return gaps.withColumn("example", F.row_number().over(w)).where(F.col("example") <= n).select(*keys, "example", *columns)


def numbered_segments(messages: DataFrame, keys: list[str] = KEY, width: int = ARRIVALS) -> DataFrame:
    """Snapshots and updates with the number of snapshots so far (0: before the first)."""
    rows = messages.where("msg IN ('update', 'snapshot')")
    return running_sum(rows, keys, "arrival", (F.col("msg") == "snapshot").cast("long"), "segment", width)


def segment_summary(messages: DataFrame, keys: list[str] = KEY, width: int = ARRIVALS) -> DataFrame:
    """Each snapshot's segment: updates with both ids, whether the first of them bridges the snapshot, sequence gaps."""
    rows = followed(messages, keys, width)
    return summed_segments(rows, keys).where("segment > 0")


def summed_segments(rows: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """segment_summary of rows that are followed(), with segment 0 for what comes before the first snapshot."""
    return segment_rows(rows, keys, [])


def segment_rows(rows: DataFrame, keys: list[str], extra: list[str]) -> DataFrame:
    """The same with extra columns of the snapshots."""
    with_ids = (F.col("msg") == "update") & F.col("first_id").isNotNull() & F.col("last_id").isNotNull()
    first = F.min_by(F.struct("first_id", "last_id"), F.when(with_ids, F.col("arrival")))
    of_snapshot = lambda c: F.max(F.when(F.col("msg") == "snapshot", F.col(c)))
    out = rows.groupBy(*keys, "segment").agg(of_snapshot("us").alias("snapshot_us"), of_snapshot("snap_id").alias("snap_id"), F.count_if(with_ids).alias("updates"), first.alias("f"), F.count_if("is_gap").alias("sequence_gaps"), *[of_snapshot(c).alias(c) for c in extra])
    target = F.col("snap_id") + 1
    bridge = F.when(F.col("updates") > 0, F.coalesce((F.col("f.first_id") <= target) & (target <= F.col("f.last_id")), F.lit(False)))
    return out.select(*keys, "segment", "snapshot_us", "snap_id", "updates", bridge.alias("bridges_snapshot"), "sequence_gaps", *extra)


def bad_segments(segments: DataFrame) -> DataFrame:
    return segments.where("bridges_snapshot = false OR sequence_gaps > 0")


def snapshot_bridge(messages: DataFrame, keys: list[str] = KEY, width: int = ARRIVALS) -> DataFrame:
    """After each snapshot, updates up to its id are stale; the first other one must hold id + 1: ok, gap or none."""
    rows = numbered_segments(messages, keys, width)
    # Stale depends on the segment's snapshot: a left join on the few snapshots.
    snaps = rows.where("msg = 'snapshot'").select(*keys, "segment", F.col("snap_id").alias("_sid"))
    upd = rows.where("msg = 'update'").join(snaps, [*keys, "segment"])
    fresh = upd.where("NOT coalesce(last_id <= _sid, false)")
    first = fresh.groupBy(*keys, "segment").agg(F.min_by(F.struct("first_id", "last_id"), "arrival").alias("f"))
    stale = upd.where("last_id <= _sid").groupBy(*keys, "segment").agg(F.count("*").alias("stale"))
    out = snaps.join(first, [*keys, "segment"], "left").join(stale, [*keys, "segment"], "left")
    holds = F.coalesce((F.col("f.first_id") <= F.col("_sid") + 1) & (F.col("_sid") + 1 <= F.col("f.last_id")), F.lit(False))
    status = F.when(F.col("f").isNull(), "none").when(holds, "ok").otherwise("gap")
    return out.select(*keys, "segment", F.col("_sid").alias("snap_id"), F.coalesce("stale", F.lit(0)).cast("long").alias("stale"), status.alias("bridge_status"))
