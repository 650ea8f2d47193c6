"""Audit of artifacts: file catalogues, manifests, alerts and dashboard tables.

Files: role (raw:<source>, derived:<kind>, ...), d, path, bytes, sha256. Graded: rows of grade_capture.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import PROBLEMS, bytes_to_gb, patch_grade, short_hash, status_score

DATE = r"(\d{4}-\d{2}-\d{2})"


def prune_files(files: DataFrame, start: str, end: str, name: str = "path") -> DataFrame:
    """Files whose name holds a date from start to end, both included; all files where none does."""
    day = F.try_to_date(F.regexp_extract(name, DATE, 1))
    marked = files.withColumn("_hit", F.coalesce(day.between(F.lit(start).cast("date"), F.lit(end).cast("date")), F.lit(False)))
    found = marked.where("_hit").limit(1).count() > 0
    return (marked.where("_hit") if found else marked).drop("_hit")


def discover_dates(files: DataFrame, name: str = "path") -> DataFrame:
    """Distinct dates that are a part of a file name between underscores."""
    base = F.element_at(F.split(name, "/"), -1)
    parts = files.select(F.explode(F.split(base, "_")).alias("part")).where(F.col("part").rlike("^" + DATE + "$"))
    return parts.select(F.try_to_date("part").alias("d")).where("d IS NOT NULL").distinct()


def pending_days(start: str, end: str, outputs: DataFrame, force: bool = False, skip_from: str | None = None) -> DataFrame:
    """Days from start to end without an output (all with force), before skip_from (today, to leave it out)."""
    spark = outputs.sparkSession
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("d"))
    if skip_from is not None:
        days = days.where(F.col("d") < F.lit(skip_from).cast("date"))
    return days if force else days.join(outputs.select("d").distinct(), "d", "left_anti")


def verify_checksums(files: DataFrame, checksums: DataFrame) -> DataFrame:
    """The first token of the checksum file against the computed hash; no checksum is an error."""
    wanted = checksums.select("path", F.lower(F.split(F.trim("line"), r"\s+")[0]).alias("expected_sha256"))
    status = F.when(F.col("expected_sha256").isNull() | (F.col("expected_sha256") == ""), "error").when(F.col("expected_sha256") == F.col("sha256"), "ok").otherwise("checksum_mismatch")
    return files.join(wanted, "path", "left").withColumn("status", status)


def expected_vs_present(expected: DataFrame, catalog: DataFrame) -> DataFrame:
    here = catalog.select("path", F.lit(True).alias("_here")).distinct()
    return expected.join(here, "path", "left").withColumn("status", F.when(F.col("_here"), "present").otherwise("missing")).drop("_here")


def raw_growth(files: DataFrame) -> DataFrame:
    """GB of raw files by day and source; the source is the role's second part."""
    source = F.coalesce(F.get(F.split("role", ":"), F.lit(1)), F.lit("unknown"))
    return files.where("role LIKE 'raw%'").groupBy("d", source.alias("source")).agg(bytes_to_gb(F.sum("bytes")).alias("raw_gb"), F.sum("bytes").alias("bytes"))


def pivot_daily(df: DataFrame, column: str, values: list[str], agg: Column) -> DataFrame:
    """One row a day, one column a value; 0 where there is nothing."""
    return df.groupBy("d").pivot(column, values).agg(agg).na.fill(0)


def overall_status(graded: DataFrame) -> DataFrame:
    """OK, Watch or Check by the worst status of the latest day."""
    latest = graded.agg(F.max("d").alias("d"))
    worst = graded.join(latest, "d").groupBy("d").agg(F.max(status_score(F.col("status"))).alias("score"))
    return worst.withColumn("overall", F.when(F.col("score") == 0, "OK").when(F.col("score") <= 1, "Watch").otherwise("Check"))


def grade_patch(reports: DataFrame) -> DataFrame:
    """Adds the patch status; reports: sequence_gaps, time_gaps, patch_records."""
    return reports.withColumn("status", patch_grade(F.col("sequence_gaps"), F.col("time_gaps"), F.col("patch_records")))


def _alert(rows: DataFrame, severity: Column, kind: str, subject: Column, message: Column) -> DataFrame:
    return rows.select("d", severity.alias("severity"), F.lit(kind).alias("kind"), subject.alias("subject"), message.alias("message"))


def build_alerts(graded: DataFrame, patched: DataFrame, files: DataFrame, days: DataFrame, artifacts: DataFrame) -> DataFrame:
    """All rules' alerts. patched: d, name, status; artifacts: d, path, kind (config, script), status."""
    error, warning, source = F.lit("error"), F.lit("warning"), F.col("source")
    bad, split = graded.where(F.col("status").isin(PROBLEMS)), graded.where("status = 'SEGMENTED'")
    open_patch = patched.where("status <> 'PATCH_OK'")
    without = lambda role: days.join(files.where(F.col("role").startswith(role)).select("d").distinct(), "d", "left_anti")
    none = F.lit(None).cast("string")
    gone = artifacts.where("status = 'missing'")
    parts = [
        _alert(bad, error, "quality_status", source, F.concat("source", F.lit(" quality status is "), "status")),
        _alert(split, warning, "quality_status", source, F.concat("source", F.lit(" has observed capture segments or temporal gaps"))),
        _alert(graded.where("json_errors > 0"), error, "json_errors", source, F.concat("source", F.lit(" has JSON parse errors"))),
        _alert(open_patch, F.when(F.col("status") == "PATCH_PARTIAL", "warning").otherwise("error"), "patched_quality", F.col("name"), F.concat("name", F.lit(" ended as "), "status")),
        _alert(without("raw"), error, "missing_raw_files", none, F.lit("No raw input files were found for this date")),
        _alert(without("derived"), warning, "missing_derived_files", none, F.lit("No derived files were found for this date")),
        _alert(gone.where("kind = 'config'"), warning, "missing_pipeline_config", none, F.lit("Pipeline config file is missing")),
        _alert(gone.where("kind = 'script'"), warning, "missing_pipeline_script", F.col("path"), F.concat(F.lit("Pipeline script is missing: "), "path")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def quality_rows(graded: DataFrame, files: DataFrame, alerts: DataFrame, sources: list[str]) -> DataFrame:
    """One row a day: status by source (n/a where none), numbers of alerts, raw and derived files."""
    status = graded.groupBy("d").pivot("source", sources).agg(F.first("status")).na.fill("n/a", sources)
    n_files = files.groupBy("d").agg(F.count_if(F.col("role").startswith("raw")).alias("raw_files"), F.count_if(F.col("role").startswith("derived")).alias("derived_files"))
    n_alerts = alerts.groupBy("d").agg(F.count("*").alias("alerts"))
    return status.join(n_files, "d", "left").join(n_alerts, "d", "left").na.fill(0, ["raw_files", "derived_files", "alerts"])


def gap_rows(graded: DataFrame) -> DataFrame:
    ids = F.col("source").startswith("binance")
    return graded.select(
        "d", "source", "status", "updates", "snapshots", "json_errors", F.coalesce("time_gaps", F.lit(0)).alias("gaps_ge"), F.round(F.coalesce("gap_seconds", F.lit(0.0)), 6).alias("gap_seconds_ge"),
        F.round(F.coalesce("max_gap_seconds", F.lit(0.0)), 6).alias("max_gap_seconds"), F.when(ids, F.col("seq_gaps")).alias("sequence_gaps"),
    )


def patch_rows(patched: DataFrame) -> DataFrame:
    exchange = F.when(F.col("name").startswith("binance"), "binance").when(F.col("name").startswith("coinbase"), "coinbase").otherwise("unknown")
    return patched.select("d", exchange.alias("exchange"), "status", "records", "patch_records", "sequence_gaps", "time_gaps", F.col("name").alias("report"))


def alert_rows(alerts: DataFrame) -> DataFrame:
    return alerts.select("d", "severity", "kind", "message")


def pipeline_rows(artifacts: DataFrame) -> DataFrame:
    """One row a day: short hash of the config, scripts tracked and missing."""
    sha = F.max(F.when(F.col("kind") == "config", F.col("sha256")))
    script = F.col("kind") == "script"
    return artifacts.groupBy("d").agg(short_hash(sha).alias("config_sha256"), F.count_if(script).alias("scripts_tracked"), F.count_if(script & (F.col("status") == "missing")).alias("missing_scripts"))


def audit_headline(files: DataFrame, alerts: DataFrame) -> DataFrame:
    """One row: days audited, the latest day and its numbers of alerts, raw and derived files, and total GB."""
    role = lambda r: F.col("role").startswith(r)
    day = files.groupBy("d").agg(F.count_if(role("raw")).alias("raw_files"), F.count_if(role("derived")).alias("derived_files"), F.sum(F.when(role("raw"), F.col("bytes"))).alias("raw"), F.sum(F.when(role("derived"), F.col("bytes"))).alias("derived"))
    day = day.join(alerts.groupBy("d").agg(F.count("*").alias("alerts")), "d", "left").withColumn("alerts", F.coalesce("alerts", F.lit(0)))
    out = day.agg(F.count("*").alias("days"), F.max_by(F.struct("d", "alerts", "raw_files", "derived_files"), "d").alias("latest"), bytes_to_gb(F.sum("raw")).alias("raw_gb"), bytes_to_gb(F.sum("derived")).alias("derived_gb"))
    return out.select("days", "latest.*", "raw_gb", "derived_gb")


def run_summary(results: DataFrame) -> DataFrame:
    return results.groupBy("d", "status").agg(F.count("*").alias("n"))


#: The closing lines of a summary.
INTERPRETATION = [
    "Raw files are preserved. Derived files are written separately.",
    "PATCH_OK means the patched output has no remaining detected gap under the current checks.",
    "PATCH_PARTIAL means backup helped but some gap remains documented.",
    "SEGMENTED means usable by segment or after conservative backup patching.",
    "CAPTURE_GAP_UNRESOLVED means the capture did not observe a required continuity interval.",
]
#: Kinds of alerts in the order of a summary.
ALERT_KINDS = ["quality_status", "json_errors", "patched_quality", "missing_raw_files", "missing_derived_files", "missing_pipeline_config", "missing_pipeline_script"]


def _shown(name: str, frame: DataFrame) -> Column:
    """A value as text: None where it is null or the frame lacks it, True and False for booleans."""
    if name not in frame.columns:
        return F.lit("None")
    text = F.initcap(F.col(name).cast("string")) if frame.schema[name].dataType.typeName() == "boolean" else F.col(name).cast("string")
    return F.coalesce(text, F.lit("None"))


def summary_lines(days: DataFrame, graded_lines: DataFrame, patched: DataFrame, alerts: DataFrame, pipeline: DataFrame, sources: list[str]) -> DataFrame:
    """Lines of each day's summary: d, section, place (from 1 within the section), line.

    graded_lines: d, source, line. patched: d, name, status and counts; counts it lacks show as None. pipeline: one row a day with
    config_path, config_status, config_sha256, scripts_tracked, missing_scripts, and config_version, git_available, git_commit and
    git_dirty where known. A source without grades, a day without reports or alerts has a line that says so.
    """
    days = days.select("d").distinct()

    def block(section: int, lines: list[str | Column], rows: DataFrame = days) -> DataFrame:
        listed = F.array(*[F.lit(x) if isinstance(x, str) else x for x in lines])
        return rows.select("d", F.lit(section).alias("section"), F.posexplode(listed).alias("at", "line")).select("d", "section", F.array(F.col("at").cast("string")).alias("order"), "line")

    def listed(section: int, rows: DataFrame, order: list[Column], line: Column) -> DataFrame:
        """A line a row, or "none" on days without rows."""
        key = F.array(*[F.coalesce(c.cast("string"), F.lit("")) for c in order])
        got = days.join(rows.select("d", key.alias("order"), line.alias("line")), "d", "left")
        return got.select("d", F.lit(section).alias("section"), F.coalesce("order", F.array().cast("array<string>")).alias("order"), F.coalesce("line", F.lit("- none")).alias("line"))

    wanted = days.select("d", F.posexplode(F.array(*map(F.lit, sources))).alias("at", "source"))
    missing = F.concat(F.lit("- "), "source", F.lit(": no quality data"))
    quality = wanted.join(graded_lines.select("d", "source", "line"), ["d", "source"], "left").select("d", F.lit(1).alias("section"), F.array(F.lpad(F.col("at").cast("string"), 4, "0")).alias("order"), F.coalesce("line", missing).alias("line"))
    fields = {"records": "records", "patch_records": "patch_records", "patch_l2updates": "patch_l2updates", "backup_inside_gaps": "backup_inside_gaps", "seq_gaps": "sequence_gaps", "gaps>=2s": "time_gaps"}
    report = F.concat(F.lit("- "), "name", F.lit(": "), _shown("status", patched), *[x for label, c in fields.items() for x in (F.lit(f" | {label}="), _shown(c, patched))])
    rank = F.lpad(F.array_position(F.array(*map(F.lit, ALERT_KINDS)), F.col("kind")).cast("string"), 4, "0")
    by_source = F.when(F.col("kind") == "json_errors", F.lit("0001")).otherwise(rank)  # a source's status and errors stand together
    alert = F.concat(F.lit("- "), "severity", F.lit(": "), "message")
    known = days.join(pipeline, "d", "left")
    version = [
        F.concat(F.lit("- config: "), _shown("config_path", known), F.lit(" | status="), _shown("config_status", known), F.lit(" | sha256="), _shown("config_sha256", known)),
        F.concat(F.lit("- config_version: "), _shown("config_version", known)),
        F.concat(F.lit("- git_available: "), _shown("git_available", known), F.lit(" | commit="), _shown("git_commit", known), F.lit(" | dirty="), _shown("git_dirty", known)),
        F.concat(F.lit("- scripts_tracked: "), F.coalesce("scripts_tracked", F.lit(0)).cast("string"), F.lit(" | missing_scripts="), F.coalesce("missing_scripts", F.lit(0)).cast("string")),
    ]
    parts = [
        block(0, [F.concat(F.lit("# LOB Daily Data Summary - "), F.col("d").cast("string")), "", "## Quality"]), quality,
        block(2, ["", "## Gap Patch Reports"]), listed(3, patched, [F.col("name")], report),
        block(4, ["", "## Alerts"]), listed(5, alerts, [by_source, F.col("subject"), rank, F.col("message")], alert),
        block(6, ["", "## Pipeline Version", *version], known),
        block(7, ["", "## Interpretation", *[f"- {x}" for x in INTERPRETATION]]),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    w = Window.partitionBy("d", "section").orderBy("order", "line")
    return out.select("d", "section", F.row_number().over(w).alias("place"), "line")
