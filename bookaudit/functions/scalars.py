"""Scalar functions: times, windows, keys, badges and grades."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND = 1_000_000


def seconds(us: Column) -> Column:
    """Float seconds of a difference in micros."""
    return us / F.lit(1e6)


def parse_iso(text: Column) -> Column:
    return F.try_to_timestamp(text)


def ms_time(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def iso(us: Column) -> Column:
    """ISO text with Z; six digits of the second only where there are micros."""
    t = F.timestamp_micros(us)
    whole = F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")
    return F.concat(whole, F.when(us % SECOND != 0, F.concat(F.lit("."), F.lpad(F.pmod(us, F.lit(SECOND)).cast("string"), 6, "0"))).otherwise(""), F.lit("Z"))


def rotation_window(us: Column, hours: int) -> Column:
    """Start, end (micros) and label of the rotation window; the end's hour wraps to 00."""
    if 24 % hours:
        raise ValueError("hours must divide 24")
    start = us - F.pmod(us, F.lit(hours * 3600 * SECOND))
    end = start + hours * 3600 * SECOND
    label = F.concat(F.date_format(F.timestamp_micros(start), "yyyy-MM-dd_HH"), F.lit("-"), F.date_format(F.timestamp_micros(end), "HH"))
    return F.struct(start.alias("start_us"), end.alias("end_us"), label.alias("label"))


def safe_symbol(symbol: Column) -> Column:
    return F.translate(symbol, "/_", "--")


def bytes_to_gb(n: Column) -> Column:
    return F.round(F.coalesce(n, F.lit(0)) / F.lit(float(1 << 30)), 3)


def short_hash(h: Column) -> Column:
    return F.when(F.length(h) > 0, F.substring(h, 1, 16)).otherwise("n/a")


def status_badge(status: Column) -> Column:
    return (
        F.when(status.isNull() | (status == ""), "n/a")
        .when(status.isin("OK", "PATCH_OK"), F.concat(F.lit("GOOD: "), status))
        .when(status.isin("SEGMENTED", "PATCH_PARTIAL"), F.concat(F.lit("WATCH: "), status))
        .otherwise(F.concat(F.lit("CHECK: "), status))
    )


#: How bad a status is.
SCORES = {
    "OK": 0, "PATCH_OK": 0, "SEGMENTED": 1, "PATCH_PARTIAL": 1, "CAPTURE_GAP_UNRESOLVED": 2, "PATCH_FAILED_OR_UNRESOLVED": 2,
    "DIAGNOSTIC_ONLY": 2, "REJECT_CORRUPT_JSON": 3, "REJECT_NO_SNAPSHOT": 3, "NO_UPDATES": 3,
}
PROBLEMS = ["CAPTURE_GAP_UNRESOLVED", "DIAGNOSTIC_ONLY", "REJECT_CORRUPT_JSON", "REJECT_NO_SNAPSHOT", "NO_UPDATES"]


def status_score(status: Column) -> Column:
    scores = F.create_map(*[F.lit(x) for kv in SCORES.items() for x in kv])
    return F.coalesce(F.try_element_at(scores, F.coalesce(status, F.lit(""))), F.lit(9))


def is_sequenced(source: Column) -> Column:
    """Whether the source's messages carry update ids."""
    return source.startswith("binance")


def grade(source: Column, json_errors: Column, updates: Column, seq_gaps: Column, bad_segments: Column, time_gaps: Column) -> Column:
    """The capture grade; the first rule that holds."""
    ids = is_sequenced(source)
    return (
        F.when(json_errors > 0, "REJECT_CORRUPT_JSON")
        .when(updates == 0, "NO_UPDATES")
        .when(ids & (seq_gaps > 0), "CAPTURE_GAP_UNRESOLVED")
        .when(ids & (bad_segments > 0), "DIAGNOSTIC_ONLY")
        .when(time_gaps > 0, "SEGMENTED")
        .otherwise("OK")
    )


def patch_grade(sequence_gaps: Column, time_gaps: Column, patch_records: Column) -> Column:
    open_gaps = (F.coalesce(sequence_gaps, F.lit(0)) > 0) | (F.coalesce(time_gaps, F.lit(0)) > 0)
    return F.when(open_gaps & (patch_records > 0), "PATCH_PARTIAL").when(open_gaps, "PATCH_FAILED_OR_UNRESOLVED").otherwise("PATCH_OK")


def threshold_count(counts: Column, threshold: str) -> Column:
    """Count at a threshold of a map from text thresholds: the exact key, else the smallest number over it, else 0."""
    numeric = F.filter(F.transform(F.map_keys(counts), lambda k: F.struct(F.expr(f"double({float(threshold)})").alias("t"), k.try_cast("double").alias("v"), k.alias("k"))), lambda x: x["v"] >= x["t"])
    nearest = F.array_min(F.transform(numeric, lambda x: F.struct(x["v"].alias("v"), x["k"].alias("k"))))["k"]
    return F.coalesce(F.try_element_at(counts, F.lit(threshold)), F.try_element_at(counts, nearest), F.lit(0))
