"""The nested quality report: files, controls, time and sequence gaps, segments and grade of every stream and day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import grade, is_sequenced, iso, seconds
from ..functions.staging import staged
from .continuity import KEY, followed, gap_examples, nonmonotone_arrival, segment_rows, time_gaps_sorted
from .quality import control_counts, file_totals

#: Thresholds of time gaps in seconds.
STEPS = [0.5, 1, 2, 5, 10, 30, 60]
#: What a status means, as the report prints it.
STATUS_RULES = {
    "OK": "No JSON errors, no unresolved sequence gaps, and no temporal gaps above threshold.",
    "SEGMENTED": "Temporal gaps were observed; use by segments or attempt backup patch before reconstruction.",
    "CAPTURE_GAP_UNRESOLVED": "A Binance U/u sequence discontinuity was observed in the capture and is not patched in this raw report.",
    "DIAGNOSTIC_ONLY": "Data exists but at least one segment does not bridge correctly from its snapshot; keep for diagnostics, exclude from formal reconstruction.",
    "REJECT_CORRUPT_JSON": "At least one JSON line could not be parsed.",
    "REJECT_NO_SNAPSHOT": "No usable snapshot/update basis was found.",
}
TOTALS = ["lines", "json_errors", "updates", "snapshots", "control_events", "subscriptions", "bytes"]


def _list(rows: DataFrame, keys: list[str], name: str, order: list[str], *fields: Column) -> DataFrame:
    """One array of structs a key, in the order of these columns."""
    item = F.struct(*order, F.struct(*fields).alias("_"))
    return rows.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["_"]).alias(name))


def _thresholds(steps: list[float]) -> Column:
    """Map from threshold to count, total and largest of the gaps at least as long; micros are divided once."""
    us = F.round(F.col("seconds") * 1e6).cast("long")
    entries = []
    for step in steps:
        over = F.when(F.col("seconds") >= step, us)
        zero = F.lit(0).cast("long")
        entries += [F.lit(f"{step:g}"), F.struct(F.count(over).alias("count"), seconds(F.coalesce(F.sum(over), zero)).alias("total_seconds"), seconds(F.coalesce(F.max(over), zero)).alias("max_seconds"))]
    return F.create_map(*entries)


def source_reports(messages: DataFrame, threshold: float = 2.0, steps: list[float] = STEPS, examples: int = 20, keys: list[str] = KEY) -> DataFrame:
    """One row a stream and day: its keys and the columns of its report.

    messages also hold path, line, ctl and bytes. Totals are summed from the files' rows; gaps and the rows that
    follow a snapshot are written once, then read for counts and for examples. Examples are the first ones only (the
    feature); files, controls and segments are whole, one entry each. Streams without update ids have no sequence part
    (null) and no bad segments (empty). A stream without updates has zero at every threshold.
    """
    source = F.col("source")
    per_file = staged(file_totals(messages, [*keys, "path"]), "report-files")
    totals = per_file.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in TOTALS], F.min("min_us").alias("_from"), F.max("max_us").alias("_to"))
    files = _list(per_file, keys, "files", ["path"], *[F.col(c) for c in ["path", "bytes", *TOTALS[:5]]], iso(F.col("first_us")).alias("time_first"), iso(F.col("last_us")).alias("time_last"))
    controls = control_counts(messages, keys).groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("event", "n")))).alias("controls"))

    updates = messages.where("msg = 'update'")
    gaps = staged(time_gaps_sorted(updates, keys).where(F.col("seconds") >= min(*steps, threshold)), "report-gaps")
    over = F.count_if(F.col("seconds") >= threshold)
    counted = gaps.groupBy(*keys).agg(_thresholds(steps).alias("_thresholds"), over.alias("_over"))
    shown = gap_examples(gaps.where(F.col("seconds") >= threshold), "us", ["seconds", "prev_us", "us"], examples, keys)
    shown = _list(shown, keys, "_shown", ["example"], F.col("seconds"), iso(F.col("prev_us")).alias("from"), iso(F.col("us")).alias("to"))

    rows = staged(followed(messages.where(is_sequenced(source)), keys, extra=["path", "line"]), "report-followed")
    jumps = rows.where("is_gap")
    missing = F.col("first_id") - F.col("_seen.last_id") - 1
    first = gap_examples(jumps, "arrival", ["arrival", "_seen", "first_id", "last_id", "us", "path", "line"], examples, keys)
    first = _list(
        first, keys, "_jumps", ["example"], F.col("_seen.last_id").alias("prev_u"), F.col("first_id").alias("next_U"), F.col("last_id").alias("next_u"), missing.alias("missing"),
        iso(F.col("us")).alias("time"), iso(F.col("_seen.us")).alias("previous_time"), F.col("path").alias("file"), "line",
    )
    all_segments = segment_rows(rows, keys, ["path", "line"])
    segments = _list(
        all_segments.where("segment > 0"), keys, "segments", ["segment"], F.col("path").alias("snapshot_file"), F.col("line").alias("snapshot_line"), iso(F.col("snapshot_us")).alias("snapshot_time"),
        F.col("snap_id").alias("snapshot_id"), "updates", "bridges_snapshot", "sequence_gaps",
    )
    jumped = all_segments.groupBy(*keys).agg(F.sum("sequence_gaps").alias("_n_jumps"))

    out = totals
    for part in (files, controls, counted, shown, nonmonotone_arrival(updates, keys), jumped, first, segments):
        out = out.join(part, keys, "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    empty = lambda c: F.coalesce(F.col(c), F.array().cast(out.schema[c].dataType))
    none = F.struct(F.lit(0).cast("long").alias("count"), F.lit(0.0).alias("total_seconds"), F.lit(0.0).alias("max_seconds"))
    no_gaps = F.create_map(*[x for step in steps for x in (F.lit(f"{step:g}"), none)])
    bad = F.filter(empty("segments"), lambda s: F.coalesce(~s["bridges_snapshot"], F.lit(False)) | (s["sequence_gaps"] > 0))
    ids = is_sequenced(source)
    bad = F.when(ids, bad).otherwise(F.array().cast(out.schema["segments"].dataType))
    status = grade(source, F.col("json_errors"), F.col("updates"), zero("_n_jumps"), F.size(bad), zero("_over"))
    return out.select(
        *keys, "files", F.struct(*TOTALS).alias("totals"), F.coalesce("controls", F.create_map().cast("map<string,bigint>")).alias("controls"), iso(F.col("_from")).alias("time_first"), iso(F.col("_to")).alias("time_last"),
        F.struct(F.coalesce("_thresholds", no_gaps).alias("thresholds"), empty("_shown").alias(f"examples_ge_{threshold:g}s"), zero("backward_steps").alias("nonmonotone")).alias("temporal_gaps"),
        F.when(ids, F.struct(zero("_n_jumps").alias("count"), empty("_jumps").alias("examples"))).alias("sequence_gaps"),
        F.when(ids, empty("segments")).alias("segments"), bad.alias("bad_segments"), status.alias("status"),
    )


def quality_report(reports: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """One nested JSON document a day: the date, its sources by name with their reports, what a status means."""
    body = F.struct(*[c for c in reports.columns if c not in keys])
    text = reports.select("d", "source", F.to_json(F.create_map("source", body), {"ignoreNullFields": "false"}).alias("text"))
    inner = F.substring("text", 2, F.length("text") - 2)  # "source":{...}
    day = text.groupBy("d").agg(F.transform(F.array_sort(F.collect_list(F.struct("source", inner.alias("text")))), lambda x: x["text"]).alias("_reports"))
    rules = F.to_json(F.struct(*[F.lit(v).alias(k) for k, v in STATUS_RULES.items()]))
    return day.select("d", F.concat(F.lit('{"date":"'), F.col("d").cast("string"), F.lit('","sources":{'), F.array_join("_reports", ","), F.lit('},"status_rules":'), rules, F.lit("}")).alias("value"))
