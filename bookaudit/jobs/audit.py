"""Queries of the audit operators, with the SQL they are checked by. Files and artifacts are derived from the captures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.staging import staged
from ..operators import audit as A
from ..operators import patching as P
from ..sources.fixtures import ctes, fixture
from . import patching
from .continuity import ALL_GRADED, _text_day
from .continuity import _graded as _grades

START, END = "2024-01-05", "2024-01-20"
SOURCES = ["binance", "binance_backup", "coinbase", "coinbase_backup"]

FILES = """files AS (SELECT d, 'raw:' || source || ':BTC' AS role, 'raw_done/' || source || '/BTC/' || source || '_BTC_' || CAST(d AS STRING) || '_00-12.jsonl.gz' AS path, sum(bytes) * 100000 AS bytes, sha256(source || CAST(d AS STRING)) AS sha256
  FROM cap WHERE day(d) % 9 <> 0 GROUP BY d, source
  UNION ALL SELECT d, 'derived:features', 'features/features_' || CAST(d AS STRING) || '.csv', count(*) * 1000000, sha256('f' || CAST(d AS STRING)) FROM cap WHERE day(d) % 4 <> 0 GROUP BY d)"""
ARTIFACTS = """artifacts AS (SELECT d, 'config' AS kind, 'settings/config.json' AS path, CASE WHEN day(d) % 7 = 0 THEN 'missing' ELSE 'present' END AS status, CASE WHEN day(d) % 7 = 0 THEN NULL ELSE sha256(CAST(d AS STRING)) END AS sha256 FROM cap GROUP BY d
  UNION ALL SELECT d, 'script', source || '.py', CASE WHEN day(d) % 5 = 0 AND source = 'binance' THEN 'missing' ELSE 'present' END, sha256(source) FROM cap GROUP BY d, source)"""


def _sql(spark: SparkSession, d: str, text: str, name: str) -> DataFrame:
    body = text.replace("sha256(source || CAST(d AS STRING)) AS", "sha2(source || CAST(d AS STRING), 256) AS").replace("sha256('f' || CAST(d AS STRING))", "sha2('f' || CAST(d AS STRING), 256)")
    body = body.replace("sha256(CAST(d AS STRING))", "sha2(CAST(d AS STRING), 256)").replace("sha256(source)", "sha2(source, 256)").replace("FROM cap", "FROM {cap}")
    return spark.sql(f"WITH {body} SELECT * FROM {name}", cap=fixture(spark, d, "cap"))


def _graded(spark: SparkSession, d: str) -> DataFrame:
    """The day's grades, as the tables that the quality job leaves."""
    return staged(_grades(spark, d), "grades")


def _files(spark: SparkSession, d: str) -> DataFrame:
    return _sql(spark, d, FILES, "files")


def _artifacts(spark: SparkSession, d: str) -> DataFrame:
    return _sql(spark, d, ARTIFACTS, "artifacts")


def _patched(spark: SparkSession, d: str) -> DataFrame:
    """The graded patch reports of every day, as the tables that the patch job leaves."""
    return staged(A.grade_patch(patching.patch_counts(spark, d)), "patched")


def _alerts(spark: SparkSession, d: str, graded: DataFrame | None = None, patched: DataFrame | None = None) -> DataFrame:
    cap = fixture(spark, d, "cap")
    graded = _graded(spark, d) if graded is None else graded
    return A.build_alerts(graded, _patched(spark, d) if patched is None else patched, staged(_files(spark, d), "files"), cap.select("d").distinct(), _artifacts(spark, d))


def prune_files(spark: SparkSession, d: str) -> DataFrame:
    return A.prune_files(_files(spark, d), START, END).select("path", "bytes")


def discover_dates(spark: SparkSession, d: str) -> DataFrame:
    return _text_day(A.discover_dates(_files(spark, d)))


def pending_days(spark: SparkSession, d: str) -> DataFrame:
    done = _files(spark, d).where("role LIKE 'derived%'")
    return _text_day(A.pending_days(START, END, done, skip_from="2024-01-19"))


def verify_checksums(spark: SparkSession, d: str) -> DataFrame:
    files = _files(spark, d)
    line = F.when(F.dayofmonth("d") % 6 == 0, F.concat(F.sha2("path", 256), F.lit("  "), "path")).otherwise(F.concat(F.upper("sha256"), F.lit("  "), "path"))
    sums = files.where(F.dayofmonth("d") % 8 != 0).select("path", line.alias("line"))
    return A.verify_checksums(files.select("path", "bytes", "sha256"), sums)


def expected_vs_present(spark: SparkSession, d: str) -> DataFrame:
    days = fixture(spark, d, "cap").select("d").distinct()
    expected = days.select(F.explode(F.array(*[F.concat(F.lit(f"raw_done/{s}/BTC/{s}_BTC_"), F.col("d").cast("string"), F.lit("_00-12.jsonl.gz")) for s in SOURCES[:3]])).alias("path"))
    return A.expected_vs_present(expected, _files(spark, d))


def raw_growth(spark: SparkSession, d: str) -> DataFrame:
    return _text_day(A.raw_growth(_files(spark, d)))


def pivot_daily(spark: SparkSession, d: str) -> DataFrame:
    gb = A.raw_growth(_files(spark, d)).withColumn("bytes", F.col("bytes").cast("long"))
    return _text_day(A.pivot_daily(gb, "source", SOURCES[:2], F.sum("bytes")))


def pivot_status(spark: SparkSession, d: str) -> DataFrame:
    return _text_day(A.pivot_daily(_graded(spark, d), "status", ["OK", "SEGMENTED", "CAPTURE_GAP_UNRESOLVED"], F.count("updates")))


def overall_status(spark: SparkSession, d: str) -> DataFrame:
    return _text_day(A.overall_status(_graded(spark, d)))


def grade_patch(spark: SparkSession, d: str) -> DataFrame:
    return _text_day(_patched(spark, d))


def build_alerts(spark: SparkSession, d: str) -> DataFrame:
    return _text_day(_alerts(spark, d))


def alert_rows(spark: SparkSession, d: str) -> DataFrame:
    return _text_day(A.alert_rows(_alerts(spark, d)))


def quality_rows(spark: SparkSession, d: str) -> DataFrame:
    graded = _graded(spark, d)
    return _text_day(A.quality_rows(graded, _files(spark, d), staged(_alerts(spark, d, graded), "alerts"), SOURCES[:3]))


def gap_rows(spark: SparkSession, d: str) -> DataFrame:
    return _text_day(A.gap_rows(_graded(spark, d)))


def patch_rows(spark: SparkSession, d: str) -> DataFrame:
    return _text_day(A.patch_rows(_patched(spark, d)))


def pipeline_rows(spark: SparkSession, d: str) -> DataFrame:
    return _text_day(A.pipeline_rows(_artifacts(spark, d)))


def audit_headline(spark: SparkSession, d: str) -> DataFrame:
    return _text_day(A.audit_headline(_files(spark, d), staged(_alerts(spark, d), "alerts")))


def _decided(spark: SparkSession, d: str) -> DataFrame:
    """Patch decisions of each exchange and day, by grades and by the raw files there are."""
    raw = _files(spark, d).where("role LIKE 'raw:%'").select(F.split("role", ":")[1].alias("source"), "d")
    return P.patchable(P.pair_quality(_graded(spark, d)), raw)


def patch_decisions(spark: SparkSession, d: str) -> DataFrame:
    return _text_day(_decided(spark, d).select("exchange", "d", "patchable", "reason"))


def run_summary(spark: SparkSession, d: str) -> DataFrame:
    done = _files(spark, d).where("role = 'derived:features' AND day(d) % 2 = 0").select(F.lit("binance").alias("exchange"), "d")
    return _text_day(A.run_summary(P.patch_outcomes(_decided(spark, d), done).select("d", F.col("outcome").alias("status"))))


def threshold_count(spark: SparkSession, d: str) -> DataFrame:
    """Count at two seconds of a threshold map that only has some of the keys."""
    cap = fixture(spark, d, "cap").where("msg = 'update'").groupBy("source", "d").agg(F.count("*").alias("n"))
    counts = F.when(F.dayofmonth("d") % 3 == 0, F.create_map(F.lit("2"), F.col("n"), F.lit("10"), F.lit(1).cast("long"))).when(F.dayofmonth("d") % 3 == 1, F.create_map(F.lit("10"), F.col("n") + 1, F.lit("5"), F.col("n") + 2, F.lit("x"), F.lit(7).cast("long")))
    counts = counts.otherwise(F.create_map(F.lit("0.5"), F.col("n")))
    return _text_day(cap.select("source", "d", S.threshold_count(counts, "2").alias("count")))


def badges(spark: SparkSession, d: str) -> DataFrame:
    g = _graded(spark, d)
    sha = F.when(F.dayofmonth("d") % 5 != 0, F.sha2(F.concat("source", F.col("d").cast("string")), 256))
    status = F.when(F.dayofmonth("d") % 11 != 0, F.col("status"))
    return _text_day(g.select("source", "d", S.status_badge(status).alias("badge"), S.short_hash(sha).alias("hash"), S.bytes_to_gb(F.when(F.dayofmonth("d") != 3, F.col("updates") * 12_345_678)).alias("gb")))


def summary_lines(spark: SparkSession, d: str) -> DataFrame:
    from ..operators.quality import status_line

    graded, patched, artifacts, days = _graded(spark, d), _patched(spark, d), _artifacts(spark, d), fixture(spark, d, "cap").select("d")
    pick = lambda c: F.max(F.when(F.col("kind") == "config", F.col(c))).alias(f"config_{c}")
    pipeline = artifacts.groupBy("d").agg(pick("path"), pick("status"), pick("sha256"), (F.dayofmonth("d") % 2 == 0).alias("git_available"), F.count_if(F.col("kind") == "script").alias("scripts_tracked"), F.count_if((F.col("kind") == "script") & (F.col("status") == "missing")).alias("missing_scripts"))
    return _text_day(A.summary_lines(days, status_line(graded.where("dayofmonth(d) % 6 <> 1")), patched.where("dayofmonth(d) % 10 <> 2"), staged(_alerts(spark, d, graded, patched), "alerts"), pipeline, SOURCES))


QUERIES = [
    prune_files, discover_dates, pending_days, verify_checksums, expected_vs_present, raw_growth, pivot_daily, pivot_status, overall_status, grade_patch, build_alerts, alert_rows, quality_rows, gap_rows,
    patch_rows, pipeline_rows, audit_headline, patch_decisions, run_summary, threshold_count, badges, summary_lines,
]

BASE = ALL_GRADED.replace(ctes("cap"), ctes("cap", "m", "chg")) + f", {FILES}, {ARTIFACTS}, days AS (SELECT DISTINCT CAST(d AS VARCHAR) AS d FROM cap), ft AS (SELECT * REPLACE (CAST(d AS VARCHAR) AS d) FROM files) "
PATCH = f"""{patching.PRIMARY}, {patching.CHAIN}, {patching.PATCHED}, {patching.PATCH_MEASURES}, {patching.TIMED}, {patching.INGAP}, {patching.TIME_MEASURES},
pq AS (SELECT CAST(d AS VARCHAR) AS d, 'binance_' || d AS name, records, sequence_gaps, gaps_1 AS time_gaps, coalesce(patched, 0) AS patch_records, CAST(NULL AS BIGINT) AS patch_l2updates, CAST(NULL AS BIGINT) AS backup_inside_gaps FROM pms LEFT JOIN pgp USING (d) WHERE stream = 'merged'
  UNION ALL SELECT CAST(d AS VARCHAR), 'coinbase_' || d, records, NULL, gaps_1, coalesce(tpn.n, 0), coalesce(tpn.n, 0), coalesce(tin.n, 0) FROM tms LEFT JOIN tpn USING (d) LEFT JOIN tin USING (d) WHERE stream = 'merged'),
patched AS (SELECT *, CASE WHEN (sequence_gaps > 0 OR time_gaps > 0) AND patch_records > 0 THEN 'PATCH_PARTIAL' WHEN sequence_gaps > 0 OR time_gaps > 0 THEN 'PATCH_FAILED_OR_UNRESOLVED' ELSE 'PATCH_OK' END AS status FROM pq)"""
ALERTS = PATCH + """,
alerts AS (SELECT d, 'error' AS severity, 'quality_status' AS kind, source AS subject, source || ' quality status is ' || status AS message FROM graded WHERE status IN ('CAPTURE_GAP_UNRESOLVED', 'DIAGNOSTIC_ONLY', 'REJECT_CORRUPT_JSON', 'REJECT_NO_SNAPSHOT', 'NO_UPDATES')
 UNION ALL SELECT d, 'warning', 'quality_status', source, source || ' has observed capture segments or temporal gaps' FROM graded WHERE status = 'SEGMENTED'
 UNION ALL SELECT d, 'error', 'json_errors', source, source || ' has JSON parse errors' FROM graded WHERE json_errors > 0
 UNION ALL SELECT d, CASE WHEN status = 'PATCH_PARTIAL' THEN 'warning' ELSE 'error' END, 'patched_quality', name, name || ' ended as ' || status FROM patched WHERE status <> 'PATCH_OK'
 UNION ALL SELECT d, 'error', 'missing_raw_files', NULL, 'No raw input files were found for this date' FROM days WHERE d NOT IN (SELECT d FROM ft WHERE role LIKE 'raw%')
 UNION ALL SELECT d, 'warning', 'missing_derived_files', NULL, 'No derived files were found for this date' FROM days WHERE d NOT IN (SELECT d FROM ft WHERE role LIKE 'derived%')
 UNION ALL SELECT CAST(d AS VARCHAR), 'warning', 'missing_pipeline_config', NULL, 'Pipeline config file is missing' FROM artifacts WHERE kind = 'config' AND status = 'missing'
 UNION ALL SELECT CAST(d AS VARCHAR), 'warning', 'missing_pipeline_script', path, 'Pipeline script is missing: ' || path FROM artifacts WHERE kind = 'script' AND status = 'missing')"""
FILED = f"WITH {ctes('cap')}, {FILES}, {ARTIFACTS} "
SCORE = "CASE status WHEN 'OK' THEN 0 WHEN 'PATCH_OK' THEN 0 WHEN 'SEGMENTED' THEN 1 WHEN 'PATCH_PARTIAL' THEN 1 WHEN 'CAPTURE_GAP_UNRESOLVED' THEN 2 WHEN 'PATCH_FAILED_OR_UNRESOLVED' THEN 2 WHEN 'DIAGNOSTIC_ONLY' THEN 2 WHEN 'REJECT_CORRUPT_JSON' THEN 3 WHEN 'REJECT_NO_SNAPSHOT' THEN 3 WHEN 'NO_UPDATES' THEN 3 ELSE 9 END"
LINE = """'- ' || source || ': ' || status || ' | updates=' || updates || ' | snapshots=' || snapshots || ' | json_errors=' || json_errors || ' | gaps>=2s=' || time_gaps || ' | seq_gaps='
        || CASE WHEN source LIKE 'binance%' THEN CAST(seq_gaps AS VARCHAR) ELSE 'n/a' END"""
DECIDED = """decided AS (SELECT p.source AS exchange, p.d, CASE WHEN NOT coalesce(p.status IN ('SEGMENTED', 'CAPTURE_GAP_UNRESOLVED') AND p.updates > 0 AND coalesce(b.updates, 0) > 0 AND (p.source NOT LIKE 'binance%' OR p.seq_gaps > 0), false)
  THEN 'primary not patchable or backup unavailable' WHEN (SELECT count(DISTINCT role) FROM ft WHERE ft.d = p.d AND role IN ('raw:' || p.source || ':BTC', 'raw:' || p.source || '_backup:BTC')) < 2 THEN 'missing primary or backup files' ELSE '' END AS reason
  FROM graded p LEFT JOIN graded b ON b.d = p.d AND b.source = p.source || '_backup' WHERE p.source NOT LIKE '%_backup')"""
KINDS = "['quality_status', 'json_errors', 'patched_quality', 'missing_raw_files', 'missing_derived_files', 'missing_pipeline_config', 'missing_pipeline_script']"
GB = "round(coalesce({}, 0) / 1073741824.0, 3)"

ORACLE = {
    "prune_files": FILED + f"SELECT path, CAST(bytes AS BIGINT) AS bytes FROM files WHERE regexp_extract(path, '([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})', 1) BETWEEN '{START}' AND '{END}'",
    "discover_dates": FILED + "SELECT DISTINCT CAST(d AS VARCHAR) AS d FROM files WHERE role LIKE 'raw%'",
    "pending_days": FILED + f"SELECT CAST(x AS VARCHAR) AS d FROM (SELECT CAST(unnest(generate_series(DATE '{START}', DATE '{END}', INTERVAL 1 DAY)) AS DATE) AS x) WHERE x < DATE '2024-01-19' AND x NOT IN (SELECT d FROM files WHERE role LIKE 'derived%')",
    "verify_checksums": FILED + """, s AS (SELECT path, CASE WHEN day(d) % 6 = 0 THEN sha256(path) ELSE sha256 END AS expected_sha256 FROM files WHERE day(d) % 8 <> 0)
        SELECT f.path, CAST(f.bytes AS BIGINT) AS bytes, f.sha256, s.expected_sha256, CASE WHEN s.expected_sha256 IS NULL THEN 'error' WHEN s.expected_sha256 = f.sha256 THEN 'ok' ELSE 'checksum_mismatch' END AS status FROM files f LEFT JOIN s USING (path)""",
    "expected_vs_present": FILED + f""", x AS (SELECT DISTINCT d, s FROM cap CROSS JOIN (SELECT unnest({SOURCES[:3]}) AS s)), p AS (SELECT 'raw_done/' || s || '/BTC/' || s || '_BTC_' || CAST(d AS VARCHAR) || '_00-12.jsonl.gz' AS path FROM x)
        SELECT path, CASE WHEN path IN (SELECT path FROM files) THEN 'present' ELSE 'missing' END AS status FROM p""",
    "raw_growth": FILED + f"SELECT CAST(d AS VARCHAR) AS d, split_part(role, ':', 2) AS source, {GB.format('sum(bytes)')} AS raw_gb, CAST(sum(bytes) AS BIGINT) AS bytes FROM files WHERE role LIKE 'raw%' GROUP BY ALL",
    "pivot_daily": FILED + "SELECT CAST(d AS VARCHAR) AS d, CAST(coalesce(sum(bytes) FILTER (role LIKE 'raw:binance:%'), 0) AS BIGINT) AS binance, CAST(coalesce(sum(bytes) FILTER (role LIKE 'raw:binance_backup:%'), 0) AS BIGINT) AS binance_backup FROM files WHERE role LIKE 'raw%' GROUP BY d",
    "pivot_status": ALL_GRADED + "SELECT d, count(*) FILTER (status = 'OK') AS OK, count(*) FILTER (status = 'SEGMENTED') AS SEGMENTED, count(*) FILTER (status = 'CAPTURE_GAP_UNRESOLVED') AS CAPTURE_GAP_UNRESOLVED FROM graded GROUP BY d",
    "overall_status": ALL_GRADED + f", w AS (SELECT d, max({SCORE}) AS score FROM graded WHERE d = (SELECT max(d) FROM graded) GROUP BY d) SELECT d, score, CASE WHEN score = 0 THEN 'OK' WHEN score <= 1 THEN 'Watch' ELSE 'Check' END AS overall FROM w",
    "grade_patch": BASE + f", {PATCH} SELECT * FROM patched",
    "build_alerts": BASE + f", {ALERTS} SELECT * FROM alerts",
    "alert_rows": BASE + f", {ALERTS} SELECT d, severity, kind, message FROM alerts",
    "quality_rows": BASE + f""", {ALERTS}, q AS (SELECT d, {', '.join(f"coalesce(max(CASE WHEN source = '{s}' THEN status END), 'n/a') AS {s}" for s in SOURCES[:3])} FROM graded GROUP BY d)
        SELECT q.*, (SELECT count(*) FROM ft WHERE ft.d = q.d AND role LIKE 'raw%') AS raw_files, (SELECT count(*) FROM ft WHERE ft.d = q.d AND role LIKE 'derived%') AS derived_files, (SELECT count(*) FROM alerts a WHERE a.d = q.d) AS alerts FROM q""",
    "gap_rows": ALL_GRADED + "SELECT d, source, status, updates, snapshots, json_errors, time_gaps AS gaps_ge, round(gap_seconds, 6) AS gap_seconds_ge, round(max_gap_seconds, 6) AS max_gap_seconds, CASE WHEN source LIKE 'binance%' THEN seq_gaps END AS sequence_gaps FROM graded",
    "patch_rows": BASE + f", {PATCH} SELECT d, split_part(name, '_', 1) AS exchange, status, records, patch_records, sequence_gaps, time_gaps, name AS report FROM patched",
    "pipeline_rows": FILED + "SELECT CAST(d AS VARCHAR) AS d, coalesce(left(max(CASE WHEN kind = 'config' THEN sha256 END), 16), 'n/a') AS config_sha256, count(*) FILTER (kind = 'script') AS scripts_tracked, count(*) FILTER (kind = 'script' AND status = 'missing') AS missing_scripts FROM artifacts GROUP BY d",
    "audit_headline": BASE + f""", {ALERTS}, l AS (SELECT max(d) AS d FROM ft) SELECT (SELECT count(DISTINCT d) FROM ft) AS days, l.d, (SELECT count(*) FROM alerts a WHERE a.d = l.d) AS alerts, (SELECT count(*) FROM ft WHERE ft.d = l.d AND role LIKE 'raw%') AS raw_files,
        (SELECT count(*) FROM ft WHERE ft.d = l.d AND role LIKE 'derived%') AS derived_files, (SELECT {GB.format('sum(bytes)')} FROM ft WHERE role LIKE 'raw%') AS raw_gb, (SELECT {GB.format('sum(bytes)')} FROM ft WHERE role LIKE 'derived%') AS derived_gb FROM l""",
    "patch_decisions": BASE + f", {DECIDED} SELECT exchange, d, reason = '' AS patchable, reason FROM decided",
    "run_summary": BASE + f""", {DECIDED} SELECT d, CASE WHEN reason <> '' THEN 'skipped' WHEN exchange = 'binance' AND day(CAST(d AS DATE)) % 2 = 0 AND d IN (SELECT d FROM ft WHERE role = 'derived:features') THEN 'skipped_exists' ELSE 'ok' END AS status,
        count(*) AS n FROM decided GROUP BY ALL""",
    "threshold_count": f"WITH {ctes('cap')}, c AS (SELECT source, d, count(*) AS n FROM cap WHERE msg = 'update' GROUP BY ALL) SELECT source, CAST(d AS VARCHAR) AS d, CASE day(d) % 3 WHEN 0 THEN n WHEN 1 THEN n + 2 ELSE 0 END AS count FROM c",
    "badges": ALL_GRADED + f""", g AS (SELECT *, CASE WHEN day(CAST(d AS DATE)) % 11 <> 0 THEN status END AS st FROM graded)
        SELECT source, d, CASE WHEN st IS NULL THEN 'n/a' WHEN st = 'OK' THEN 'GOOD: OK' WHEN st = 'SEGMENTED' THEN 'WATCH: SEGMENTED' ELSE 'CHECK: ' || st END AS badge, CASE WHEN day(CAST(d AS DATE)) % 5 <> 0 THEN left(sha256(source || d), 16) ELSE 'n/a' END AS hash,
        {GB.format('CASE WHEN day(CAST(d AS DATE)) <> 3 THEN updates * 12345678 END')} AS gb FROM g""",
    "summary_lines": BASE + f""", {ALERTS}, s AS (SELECT unnest({SOURCES}) AS source, unnest(range(4)) AS pos), ql AS (SELECT d, source, {LINE} AS line FROM graded WHERE day(CAST(d AS DATE)) % 6 <> 1),
        pr AS (SELECT d, '- ' || name || ': ' || status || ' | records=' || records || ' | patch_records=' || patch_records || ' | patch_l2updates=' || coalesce(CAST(patch_l2updates AS VARCHAR), 'None') || ' | backup_inside_gaps=' || coalesce(CAST(backup_inside_gaps AS VARCHAR), 'None') || ' | seq_gaps=' || coalesce(CAST(sequence_gaps AS VARCHAR), 'None') || ' | gaps>=2s=' || time_gaps AS line
          FROM patched WHERE day(CAST(d AS DATE)) % 10 <> 2),
        cf AS (SELECT CAST(d AS VARCHAR) AS d, max(path) FILTER (kind = 'config') AS path, max(status) FILTER (kind = 'config') AS status, max(sha256) FILTER (kind = 'config') AS sha, count(*) FILTER (kind = 'script') AS n, count(*) FILTER (kind = 'script' AND status = 'missing') AS gone FROM artifacts GROUP BY ALL),
        l AS (SELECT d, 0 AS section, unnest(['# LOB Daily Data Summary - ' || d, '', '## Quality']) AS line, unnest([1, 2, 3]) AS k, '' AS k2 FROM days
         UNION ALL SELECT days.d, 1, coalesce(line, '- ' || s.source || ': no quality data'), s.pos, '' FROM days CROSS JOIN s LEFT JOIN ql ON ql.d = days.d AND ql.source = s.source
         UNION ALL SELECT d, 2, unnest(['', '## Gap Patch Reports']), unnest([1, 2]), '' FROM days
         UNION ALL SELECT d, 3, coalesce(line, '- none'), 1, '' FROM days LEFT JOIN pr USING (d)
         UNION ALL SELECT d, 4, unnest(['', '## Alerts']), unnest([1, 2]), '' FROM days
         UNION ALL SELECT d, 5, coalesce('- ' || severity || ': ' || message, '- none'), CASE kind WHEN 'json_errors' THEN 1 ELSE list_position({KINDS}, kind) END, coalesce(subject, '') || chr(1) || list_position({KINDS}, kind) || message FROM days LEFT JOIN alerts USING (d)
         UNION ALL SELECT d, 6, unnest(['', '## Pipeline Version', '- config: ' || path || ' | status=' || status || ' | sha256=' || coalesce(sha, 'None'), '- config_version: None',
           '- git_available: ' || CASE WHEN day(CAST(d AS DATE)) % 2 = 0 THEN 'True' ELSE 'False' END || ' | commit=None | dirty=None', '- scripts_tracked: ' || n || ' | missing_scripts=' || gone]), unnest(range(6)), '' FROM cf
         UNION ALL SELECT d, 7, unnest(['', '## Interpretation', {', '.join(f"'- {x}'" for x in A.INTERPRETATION)}]), unnest(range(7)), '' FROM days)
        SELECT d, section, line, CAST(row_number() OVER (PARTITION BY d, section ORDER BY k, k2, line) AS INTEGER) AS place FROM l""",
}
