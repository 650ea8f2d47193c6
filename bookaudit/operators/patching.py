"""Filling gaps of a primary capture from its backup: by update ids and by time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.intervals import CELL, overlapping
from ..functions.scalars import seconds, threshold_count
from ..functions.sliced import ARRIVALS, MICROS, run_steps, running_max
from .continuity import gap_stats, seq_gaps_by_id, time_gaps_sorted

#: Thresholds of the gap counts in a report of a patch by ids and of one by time, in seconds.
ID_THRESHOLDS, TIME_THRESHOLDS = [0.5, 1.0, 2.0, 5.0, 10.0], [1.0, 2.0, 5.0, 10.0, 30.0, 60.0]


def dedup_latest(records: DataFrame, key: list[str], order: str = "arrival") -> DataFrame:
    """One row a key, the last by order."""
    rest = [c for c in records.columns if c not in key]
    return records.groupBy(*key).agg(F.max_by(F.struct(*rest), order).alias("_r")).select(*key, *[F.col(f"_r.{c}").alias(c) for c in rest])


def _buckets(lo: Column, hi: Column, width: int) -> Column:
    return F.explode(F.sequence(F.floor(F.least(lo, hi) / width), F.floor(F.greatest(lo, hi) / width)))


def gap_candidates(gaps: DataFrame, backup: DataFrame, keys: list[str], bits: int = CELL) -> DataFrame:
    """Each gap with the backup messages whose ids overlap it; gaps of any length, and turned ones (from after to) too.

    A turned gap is overlapped by what holds both of its ends, as the test on ids says.
    """
    span = lambda a, b: (F.least(a, b), F.greatest(a, b))
    g = gaps.select(*keys, "missing_from", "missing_to").where("missing_from IS NOT NULL AND missing_to IS NOT NULL")
    b = backup.where("first_id IS NOT NULL AND last_id IS NOT NULL").select(*keys, "first_id", "last_id", "arrival", "us")
    both = overlapping(g, b, keys, span("missing_from", "missing_to"), span("first_id", "last_id"), bits)
    return both.where("last_id >= missing_from AND first_id <= missing_to")


def chain_cover(candidates: DataFrame, keys: list[str]) -> DataFrame:
    """Candidates with their gap's verdict: the run from missing_from without a break until missing_to is reached.

    Adds step (place in the run), complete and kept; a gap is filled as a whole or not at all. A gap of a whole day is
    worked on in ranges; what is put together is one row a gap: its first break and the first step that reaches its end.
    Gaps may be millions, so that isn't broadcast.
    """
    gap = [*keys, "missing_from", "missing_to"]
    rows = run_steps(candidates, gap, ["first_id", "last_id"], "last_id")
    breaks = F.col("first_id") != F.coalesce(F.col("before") + 1, "missing_from")
    reaches = F.col("last_id") >= F.col("missing_to")
    verdict = rows.groupBy(*gap).agg(F.min(F.when(breaks, F.col("step"))).alias("_broken"), F.min(F.when(reaches, F.col("step"))).alias("_reached"))
    complete = F.coalesce(F.col("_reached") < F.coalesce("_broken", F.col("_reached") + 1), F.lit(False))
    out = rows.join(verdict.hint("merge"), gap).withColumn("complete", complete)
    return out.withColumn("kept", F.col("complete") & (F.col("step") <= F.col("_reached"))).select(*candidates.columns, "step", "complete", "kept")


def gap_reports(gaps: DataFrame, chained: DataFrame, keys: list[str]) -> DataFrame:
    """Per gap: complete, patch and candidate records. A gap of no ids that no candidate touches counts as complete."""
    gap = [*keys, "missing_from", "missing_to"]
    found = chained.groupBy(*gap).agg(F.bool_or("complete").alias("complete"), F.count_if("kept").alias("patch_records"), F.count("*").alias("candidate_records"))
    out = gaps.select(*gap, "prev_us", "next_us").join(found.hint("merge"), gap, "left")  # both a row a gap: too many to broadcast
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return out.select(*gap, "prev_us", "next_us", F.coalesce("complete", F.col("missing_from") > F.col("missing_to")).alias("complete"), zero("patch_records"), zero("candidate_records"))


def stream_measures(streams: DataFrame, thresholds: list[float], keys: list[str]) -> DataFrame:
    """Each stream of a key by name, measured on its own rows: records, updates, bounds, sequence gaps and gaps in time.

    streams: stream, the keys, msg, arrival, us, first_id, last_id. temporal_gaps is a map from thresholds as text.
    """
    key = ["stream", *keys]
    updates = streams.where("msg = 'update'")
    totals = streams.groupBy(*key).agg(F.count("*").alias("records"), F.count_if(F.col("msg") == "update").alias("updates"), F.count_if(F.col("msg") == "json_error").alias("json_errors"), F.min("us").alias("first_us"), F.max("us").alias("last_us"))
    sequence = seq_gaps_by_id(updates, key).groupBy(*key).agg(F.count("*").alias("sequence_gaps"))
    label = F.regexp_replace(F.col("threshold").cast("string"), r"\.0$", "")
    found = gap_stats(time_gaps_sorted(updates, key), streams, thresholds, key)
    found = found.groupBy(*key).agg(F.map_from_entries(F.collect_list(F.struct(label, F.struct(F.col("gaps").alias("count"), "total_seconds", "max_seconds")))).alias("temporal_gaps"))  # one a threshold
    return totals.join(sequence, key, "left").join(found, key).withColumn("sequence_gaps", F.coalesce("sequence_gaps", F.lit(0)).cast("long"))


def _side_by_side(measures: DataFrame, keys: list[str], names: list[str], columns: list[str]) -> DataFrame:
    """A struct column for each stream of the measures."""
    pick = lambda n: F.first(F.when(F.col("stream") == n, F.struct(*columns)), ignorenulls=True).alias(n)
    return measures.groupBy(*keys).agg(*map(pick, names))


def _first(rows: DataFrame, keys: list[str], order: list[str], columns: list[str], n: int) -> DataFrame:
    """The first n rows of each key as a list, and how many there are."""
    w = Window.partitionBy(*keys).orderBy(*order)
    some = rows.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("_r", F.struct(*columns).alias("x")))), lambda x: x["x"]).alias("examples"))
    return rows.groupBy(*keys).agg(F.count("*").alias("count")).join(some, keys)


def id_patch_report(primary: DataFrame, backup: DataFrame, merged: DataFrame, gaps: DataFrame, chained: DataFrame, keys: list[str], thresholds: list[float] | None = None, examples: int = 20) -> DataFrame:
    """Report of a patch by ids, one row a key: primary, backup and merged measured alike, and what was done about the gaps.

    primary, backup, merged: keys, msg, arrival, us, first_id, last_id. patch lists the first gaps, and counts all.
    """
    cols = [*keys, "msg", "arrival", "us", "first_id", "last_id"]
    names = ["primary", "backup", "merged"]
    every = [df.select(F.lit(n).alias("stream"), *cols) for n, df in zip(names, (primary, backup, merged))]
    measures = stream_measures(every[0].unionByName(every[1]).unionByName(every[2]), thresholds or ID_THRESHOLDS, keys)
    out = _side_by_side(measures, keys, names, ["records", F.col("updates").alias("depth_updates"), "json_errors", "sequence_gaps", "temporal_gaps"])
    done = gap_reports(gaps, chained, keys)
    sums = done.groupBy(*keys).agg(F.count("*").alias("primary_sequence_gaps_detected"), F.count_if("complete").alias("complete"), F.sum("patch_records").alias("backup_patch_records"))
    listed = _first(done, keys, ["missing_from", "missing_to"], ["missing_from", "missing_to", "prev_us", "next_us", "complete", "patch_records", "candidate_records"], examples)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    patch = F.struct(zero("primary_sequence_gaps_detected"), zero("complete"), zero("backup_patch_records"), F.col("examples").alias("gaps")).alias("patch")
    return out.join(sums, keys, "left").join(listed.drop("count"), keys, "left").select(*keys, "primary", "backup", patch, "merged")


def time_patch_report(primary: DataFrame, backup: DataFrame, gaps: DataFrame, inside: DataFrame, kept: DataFrame, patches: DataFrame, keys: list[str], thresholds: list[float] | None = None, examples: int = 20) -> DataFrame:
    """Report of a patch by time, one row a key of the primary.

    primary, backup: keys, arrival, us of updates. gaps: keys, gap_seq, start_us, end_us. inside: changes of the backup in
    gaps (keys, arrival, parts); kept: those left by dedup_changes; patches: the messages rebuilt of these.
    """
    none = F.lit(None).cast("long")
    row = lambda n, df: df.select(F.lit(n).alias("stream"), *keys, F.lit("update").alias("msg"), "arrival", "us", none.alias("first_id"), none.alias("last_id"))
    every = row("primary", primary).unionByName(row("merged", primary)).unionByName(row("merged", patches))
    measures = stream_measures(every, thresholds or TIME_THRESHOLDS, keys)
    out = _side_by_side(measures, keys, ["primary", "merged"], ["records", "updates", "first_us", "last_us", "temporal_gaps"])
    listed = _first(gaps.withColumn("seconds", gap_seconds("start_us", "end_us")), keys, ["gap_seq"], ["start_us", "end_us", "seconds"], examples)
    count = lambda df, name: df.groupBy(*keys).agg(F.count("*").alias(name))
    in_gaps = inside.groupBy(*keys).agg(F.count("*").alias("changes_seen"), F.count_if(F.col("parts") >= 3).alias("changes_valid"))
    for part in (listed.withColumnRenamed("count", "gaps_detected"), count(backup, "l2updates_seen"), count(in_gap(backup, gaps, keys), "l2updates_inside_primary_gaps"), in_gaps, count(kept, "changes_kept"), count(patches, "patch_l2updates")):
        out = out.join(part, keys, "left")
    zero = lambda c, name=None: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(name or c)
    return out.select(
        *keys,
        F.struct("primary.records", F.col("primary.updates").alias("l2updates"), zero("gaps_detected"), F.col("examples").alias("gaps"), F.col("primary.temporal_gaps").alias("gap_stats")).alias("primary"),
        F.struct(zero("l2updates_seen"), zero("l2updates_inside_primary_gaps"), zero("changes_seen", "changes_seen_inside_gaps"), zero("changes_kept", "changes_kept_inside_gaps"), (zero("changes_valid") - zero("changes_kept")).alias("changes_deduped_inside_gaps")).alias("backup"),
        F.struct("merged.records", F.col("primary.records").alias("primary_records"), zero("patch_l2updates", "backup_patch_records"), F.col("merged.updates").alias("l2updates"), zero("patch_l2updates"), "merged.first_us", "merged.last_us", F.col("merged.temporal_gaps").alias("gap_stats")).alias("merged"),
    )


def report_counts(name: Column, id_reports: DataFrame | None, time_reports: DataFrame | None, keys: list[str], threshold: str = "2") -> DataFrame:
    """What grading and summaries read of the reports: name, records, gaps left, patch records, updates inside gaps."""
    none = F.lit(None).cast("long")
    left = lambda c: threshold_count(F.transform_values(c, lambda _, v: v["count"]), threshold)
    parts = []
    if id_reports is not None:
        parts.append(id_reports.select(*keys, F.concat(F.lit("binance_"), name).alias("name"), "merged.records", "merged.sequence_gaps", left("merged.temporal_gaps").alias("time_gaps"), F.col("patch.backup_patch_records").alias("patch_records"), none.alias("patch_l2updates"), none.alias("backup_inside_gaps")))
    if time_reports is not None:
        parts.append(time_reports.select(*keys, F.concat(F.lit("coinbase_"), name).alias("name"), "merged.records", none.alias("sequence_gaps"), left("merged.gap_stats").alias("time_gaps"), F.col("merged.backup_patch_records").alias("patch_records"), "merged.patch_l2updates", F.col("backup.l2updates_inside_primary_gaps").alias("backup_inside_gaps")))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def with_merge_meta(df: DataFrame, source: str, sources: list[str], filled: Column, extra: dict[str, Column] | None = None, meta: Column | None = None, drop: tuple[str, ...] = ()) -> DataFrame:
    """Adds merge_meta, the provenance struct, and drops helper columns."""
    parts = [F.lit(source).alias("source"), F.array(*map(F.lit, sources)).alias("sources"), filled.alias("gap_filled")]
    parts += [v.alias(k) for k, v in (extra or {}).items()]
    if meta is not None:
        parts.append(meta.alias("source_meta"))
    return df.withColumn("merge_meta", F.struct(*parts)).drop(*drop)


def apply_patches(primary: DataFrame, patches: DataFrame) -> DataFrame:
    """All primary rows and all patch rows, with provenance."""
    none = F.lit(None).cast("long")
    p = with_merge_meta(primary, "primary", ["primary"], F.lit(False), {"missing_from": none, "missing_to": none})
    q = with_merge_meta(patches, "backup_patch", ["backup"], F.lit(True), {"missing_from": F.col("missing_from"), "missing_to": F.col("missing_to")}, drop=("missing_from", "missing_to"))
    return p.unionByName(q, allowMissingColumns=True)


def merge_order_by_id(df: DataFrame) -> list[Column]:
    """Sort keys of the patched stream: rows without ids come first."""
    return [F.coalesce("first_id", F.lit(-1)), F.coalesce("last_id", F.lit(-1)), F.col("us").asc_nulls_first(), F.col("arrival")]


def in_gap(backup: DataFrame, gaps: DataFrame, keys: list[str], width: int = MICROS) -> DataFrame:
    """Backup messages strictly inside a time gap, with the first such gap in detection order. Repeated rows stay.

    Gaps are cut into time buckets; a message meets the list of its bucket's gaps, so no row is made for a pair.
    """
    g = gaps.select(*keys, F.struct("gap_seq", "start_us", "end_us").alias("_gap"), _buckets(F.col("start_us"), F.col("end_us"), width).alias("_bucket"))
    g = g.groupBy(*keys, "_bucket").agg(F.collect_list("_gap").alias("_gaps"))
    b = backup.where("us IS NOT NULL").withColumn("_bucket", F.floor(F.col("us") / width)).join(g, [*keys, "_bucket"])
    first = F.array_min(F.filter("_gaps", lambda x: (x["start_us"] < F.col("us")) & (F.col("us") < x["end_us"])))
    return b.withColumn("_gap", first).where("_gap IS NOT NULL").select(*backup.columns, "_gap.*")


def valid_change(changes: DataFrame, parts: str = "parts") -> DataFrame:
    """Changes of fewer than three parts have no key and are dropped."""
    return changes.where(F.col(parts) >= 3)


def dedup_changes(changes: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each (time, side, price, size) over all gaps: the first by arrival, then place in the message."""
    value = ["us", "side", "price", "size"]
    return changes.groupBy(*keys, *value).agg(F.min(F.struct("arrival", "pos")).alias("_at")).select(*keys, "_at.arrival", "_at.pos", *value)


def rebuilt_messages(changes: DataFrame, keys: list[str]) -> DataFrame:
    """Messages of the changes that are left, in place order; messages without any are gone."""
    listed = F.array_sort(F.collect_list(F.struct("pos", "side", "price", "size")))
    return changes.groupBy(*keys, "arrival", "us").agg(listed.alias("changes"))


def interleave_patches(primary: DataFrame, patches: DataFrame, keys: list[str], width: int = ARRIVALS) -> DataFrame:
    """Primary rows in their own order, each patch before the first primary row of its time or later: adds sort keys _at, _own, _seq.

    Sort by keys, _at (nulls first), _own, _seq.
    """
    p = running_max(primary, keys, "arrival", F.col("us"), "_at", width).withColumns({"_own": F.lit(1), "_seq": F.col("arrival"), "origin": F.lit("primary")})
    q = patches.withColumns({"_at": F.col("us"), "_own": F.lit(0), "_seq": F.col("arrival"), "origin": F.lit("patch")})
    return p.unionByName(q, allowMissingColumns=True)


def pair_quality(graded: DataFrame) -> DataFrame:
    """Primary and backup grades of a day side by side; a missing backup is null."""
    cols = ["status", "updates", "seq_gaps"]
    p = graded.where(~F.col("source").endswith("_backup")).select(F.col("source").alias("exchange"), "d", *[F.col(c).alias(f"primary_{c}") for c in cols])
    b = graded.where(F.col("source").endswith("_backup")).select(F.regexp_replace("source", "_backup$", "").alias("exchange"), "d", *[F.col(c).alias(f"backup_{c}") for c in cols])
    return p.join(b, ["exchange", "d"], "left")


def patchable(paired: DataFrame, raw: DataFrame | None = None) -> DataFrame:
    """Whether the day is patched, and why not. raw: source and d of the raw files there are; without it none is missed."""
    has = F.col("primary_status").isin("SEGMENTED", "CAPTURE_GAP_UNRESOLVED") & (F.col("primary_updates") > 0) & (F.coalesce("backup_updates", F.lit(0)) > 0)
    ids = ~F.col("exchange").startswith("binance") | (F.coalesce("primary_seq_gaps", F.lit(0)) > 0)
    ok, there = F.coalesce(has & ids, F.lit(False)), F.lit(True)
    if raw is not None:
        both = raw.select(F.regexp_replace("source", "_backup$", "").alias("exchange"), "d", F.col("source").endswith("_backup").alias("_backup")).groupBy("exchange", "d").agg((F.count_distinct("_backup") == 2).alias("_both"))
        paired, there = paired.join(both, ["exchange", "d"], "left"), F.coalesce("_both", F.lit(False))
    reason = F.when(~ok, "primary not patchable or backup unavailable").when(~there, "missing primary or backup files").otherwise("")
    return paired.withColumns({"patchable": ok & there, "reason": reason}).drop("_both")


def patch_outcomes(decided: DataFrame, outputs: DataFrame, force: bool = False) -> DataFrame:
    """Adds the outcome of the patch run: skipped, skipped_exists (exchange and d are in outputs, unless force) or ok.

    A failed run is a failed Spark job, and has no row.
    """
    done = outputs.select("exchange", "d").distinct().withColumn("_done", F.lit(not force))
    outcome = F.when(~F.col("patchable"), "skipped").when(F.col("_done"), "skipped_exists").otherwise("ok")
    return decided.join(done, ["exchange", "d"], "left").withColumn("outcome", outcome).drop("_done")


def gap_seconds(start: str, end: str) -> Column:
    return seconds(F.col(end) - F.col(start))
