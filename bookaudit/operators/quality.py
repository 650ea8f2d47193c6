"""Daily quality of captures: totals, grades, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import grade, seconds
from .continuity import KEY, followed, summed_segments, time_gaps_sorted


def event_us(source: Column, event_ms: Column, data_us: Column, recv_us: Column) -> Column:
    """Event time in micros: the exchange's own, else the receive time."""
    return F.coalesce(F.when(source.startswith("binance"), event_ms * 1000).otherwise(data_us), recv_us)


def classify_message(source: Column, kind: Column, type_: Column, e_type: Column) -> Column:
    ids = source.startswith("binance")
    return (
        F.when(kind == "control_event", "control")
        .when(type_ == "subscriptions", "subscription")
        .when(ids & (kind == "rest_snapshot"), "snapshot")
        .when(ids & ((kind == "ws_depth_update") | (e_type == "depthUpdate")), "update")
        .when(~ids & (type_ == "snapshot"), "snapshot")
        .when(~ids & (type_ == "l2update"), "update")
        .otherwise("other")
    )


def in_time_range(df: DataFrame, us: str, start: int | None, end: int | None, closed: str = "left") -> DataFrame:
    """Rows in [start, end), or [start, end] for closed='both'; rows without time stay."""
    inside = F.lit(True)
    if start is not None:
        inside &= F.col(us) >= start
    if end is not None:
        inside &= (F.col(us) <= end) if closed == "both" else (F.col(us) < end)
    return df.where(F.col(us).isNull() | inside)


def capture_totals(messages: DataFrame, keys: list[str] = KEY, start: int | None = None, end: int | None = None) -> DataFrame:
    """Lines and broken lines of all rows; messages by kind of those in range."""
    inside = F.lit(True)
    if start is not None:
        inside &= F.coalesce(F.col("us") >= start, F.lit(True))
    if end is not None:
        inside &= F.coalesce(F.col("us") < end, F.lit(True))
    count = lambda m: F.count_if((F.col("msg") == m) & inside)
    return messages.groupBy(*keys).agg(
        F.count("*").alias("lines"), F.count_if(F.col("msg") == "json_error").alias("json_errors"), count("update").alias("updates"), count("snapshot").alias("snapshots"),
        count("control").alias("control_events"), count("subscription").alias("subscriptions"), F.sum("bytes").alias("bytes"),
    )


def file_totals(messages: DataFrame, keys: list[str]) -> DataFrame:
    """The same per file; first and last time by arrival among updates with a time, and the smallest and largest."""
    timed = F.when((F.col("msg") == "update") & F.col("us").isNotNull(), F.col("arrival"))
    count = lambda m: F.count_if(F.col("msg") == m)
    return messages.groupBy(*keys).agg(
        F.count("*").alias("lines"), count("json_error").alias("json_errors"), count("update").alias("updates"), count("snapshot").alias("snapshots"), count("control").alias("control_events"),
        F.min_by("us", timed).alias("first_us"), F.max_by("us", timed).alias("last_us"), count("subscription").alias("subscriptions"), F.sum("bytes").alias("bytes"),
        F.min(F.when(F.col("msg") == "update", F.col("us"))).alias("min_us"), F.max(F.when(F.col("msg") == "update", F.col("us"))).alias("max_us"),
    )


def control_counts(messages: DataFrame, keys: list[str] = KEY) -> DataFrame:
    return messages.where("msg = 'control'").groupBy(*keys, F.coalesce("ctl", F.lit("unknown")).alias("event")).agg(F.count("*").alias("n"))


def time_bounds(updates: DataFrame, keys: list[str] = KEY) -> DataFrame:
    return updates.groupBy(*keys).agg(F.min("us").alias("first_us"), F.max("us").alias("last_us"))


def grade_capture(messages: DataFrame, threshold: float = 2.0, keys: list[str] = KEY) -> DataFrame:
    """One graded row a stream and day: totals, gaps over the threshold, sequence gaps, bad segments, status."""
    totals = capture_totals(messages, keys)
    updates = messages.where("msg = 'update'")
    # Micros are summed as integers and divided once, as in gap_stats.
    over = time_gaps_sorted(updates, keys).where(F.col("seconds") >= threshold).withColumn("gap", F.round(F.col("seconds") * 1e6).cast("long"))
    gaps = over.groupBy(*keys).agg(F.count("*").alias("time_gaps"), F.sum("gap").alias("_sum"), F.max("gap").alias("_max"))
    segments = summed_segments(followed(messages, keys), keys).groupBy(*keys).agg(F.sum("sequence_gaps").alias("seq_gaps"), F.count_if(bad_segment()).alias("bad_segments"))
    return graded(totals.join(gaps, keys, "left").join(segments, keys, "left").join(time_bounds(updates, keys), keys, "left"), keys)


def bad_segment() -> Column:
    """Segments of a snapshot (not what comes before the first) that doesn't bridge or has a gap."""
    return (F.col("segment") > 0) & (~F.col("bridges_snapshot") | (F.col("sequence_gaps") > 0))


def graded(out: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """The graded row of totals, gaps (time_gaps, _sum and _max in micros) and segments; what is missing counts as zero."""
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    out = out.select(
        *keys, "lines", "json_errors", "updates", "snapshots", "control_events", "first_us", "last_us", zero("time_gaps").alias("time_gaps"), seconds(zero("_sum")).alias("gap_seconds"),
        seconds(zero("_max")).alias("max_gap_seconds"), zero("seq_gaps").alias("seq_gaps"), zero("bad_segments").alias("bad_segments"),
    )
    return out.withColumn("status", grade(F.col("source"), *map(F.col, ("json_errors", "updates", "seq_gaps", "bad_segments", "time_gaps"))))


def compact_report(graded: DataFrame) -> DataFrame:
    ids = F.col("source").startswith("binance")
    return graded.select("source", "d", "status", "updates", "snapshots", "json_errors", "first_us", "last_us", F.col("time_gaps").alias("gaps_ge"), F.when(ids, F.col("seq_gaps")).alias("sequence_gaps"))


def status_line(graded: DataFrame) -> DataFrame:
    """One text line a source and day."""
    seq = F.when(F.col("source").startswith("binance"), F.col("seq_gaps").cast("string")).otherwise("n/a")
    parts = ["- ", "source", ": ", "status", " | updates=", "updates", " | snapshots=", "snapshots", " | json_errors=", "json_errors", " | gaps>=2s=", "time_gaps", " | seq_gaps="]
    columns = [F.col(p).cast("string") if p.isidentifier() else F.lit(p) for p in parts]
    return graded.select("source", "d", F.concat(*columns, seq).alias("line"))
