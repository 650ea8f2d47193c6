"""Queries of the quality and continuity operators, with the SQL they are checked by."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.staging import staged_path
from ..operators import continuity as C
from ..operators import incremental as I
from ..operators import quality as Q
from ..operators import report as R
from ..sources.fixtures import ctes, fixture

#: Thresholds in seconds that suit the fixture's cadence.
STEPS, THRESHOLD = [60.0, 300.0, 600.0, 1500.0, 3600.0], 1500.0
DAY0 = 1_704_067_200_000_000  # 2024-01-01 in micros
RANGE = (DAY0 + 2 * 86_400_000_000, DAY0 + 20 * 86_400_000_000)


def _text_day(df: DataFrame) -> DataFrame:
    return df.withColumn("d", F.col("d").cast("string"))


def _cap(spark: SparkSession, d: str) -> DataFrame:
    return fixture(spark, d, "cap")


def _updates(spark: SparkSession, d: str) -> DataFrame:
    return _cap(spark, d).where("msg = 'update'")


def event_time(spark: SparkSession, d: str) -> DataFrame:
    raw = fixture(spark, d, "raw")
    return raw.select("id", "source", Q.event_us(*map(F.col, ("source", "event_ms", "data_us", "recv_us"))).alias("event_us"))


def classify_message(spark: SparkSession, d: str) -> DataFrame:
    raw = fixture(spark, d, "raw")
    return raw.select("id", "source", Q.classify_message(*map(F.col, ("source", "kind", "type", "e_type"))).alias("msg"))


def in_time_range(spark: SparkSession, d: str) -> DataFrame:
    raw = event_time(spark, d)
    left = Q.in_time_range(raw, "event_us", *RANGE).withColumn("closed", F.lit("left"))
    return left.unionByName(Q.in_time_range(raw, "event_us", *RANGE, closed="both").withColumn("closed", F.lit("both")))


def capture_totals(spark: SparkSession, d: str) -> DataFrame:
    return _text_day(Q.capture_totals(_cap(spark, d), start=RANGE[0], end=RANGE[1]))


def _half() -> Column:
    return F.floor(F.pmod(F.col("us"), F.lit(86_400_000_000)) / F.lit(43_200_000_000))


def file_totals(spark: SparkSession, d: str) -> DataFrame:
    return _text_day(Q.file_totals(_cap(spark, d).withColumn("half", _half()), ["source", "d", "half"]).drop("subscriptions", "bytes", "min_us", "max_us"))


def control_counts(spark: SparkSession, d: str) -> DataFrame:
    return _text_day(Q.control_counts(_cap(spark, d)))


def time_bounds(spark: SparkSession, d: str) -> DataFrame:
    return _text_day(Q.time_bounds(_updates(spark, d)))


def time_gaps_sorted(spark: SparkSession, d: str) -> DataFrame:
    return _text_day(C.time_gaps_sorted(_updates(spark, d)))


def time_gaps_arrival(spark: SparkSession, d: str) -> DataFrame:
    return _text_day(C.time_gaps_arrival(fixture(spark, d, "m").where("source = 'coinbase'"), THRESHOLD))


def gap_stats(spark: SparkSession, d: str) -> DataFrame:
    updates = _updates(spark, d)
    return _text_day(C.gap_stats(C.time_gaps_sorted(updates), updates, STEPS))


def gap_examples(spark: SparkSession, d: str) -> DataFrame:
    gaps = C.time_gaps_sorted(_updates(spark, d)).where(F.col("seconds") >= THRESHOLD)
    return _text_day(C.gap_examples(gaps, "us", ["prev_us", "us", "seconds"]))


def nonmonotone_arrival(spark: SparkSession, d: str) -> DataFrame:
    return _text_day(C.nonmonotone_arrival(_updates(spark, d)))


def seq_gaps_arrival(spark: SparkSession, d: str) -> DataFrame:
    return _text_day(C.seq_gaps_arrival(_cap(spark, d)))


def seq_gaps_by_id(spark: SparkSession, d: str) -> DataFrame:
    return _text_day(C.seq_gaps_by_id(_cap(spark, d)))


def segment_summary(spark: SparkSession, d: str) -> DataFrame:
    return _text_day(C.segment_summary(_cap(spark, d)))


def bad_segments(spark: SparkSession, d: str) -> DataFrame:
    return _text_day(C.bad_segments(C.segment_summary(_cap(spark, d))))


def snapshot_bridge(spark: SparkSession, d: str) -> DataFrame:
    return _text_day(C.snapshot_bridge(_cap(spark, d)))


def _graded(spark: SparkSession, d: str) -> DataFrame:
    return Q.grade_capture(_cap(spark, d), THRESHOLD)


def grade_capture(spark: SparkSession, d: str) -> DataFrame:
    return _text_day(_graded(spark, d))


def regrade_files(spark: SparkSession, d: str) -> DataFrame:
    """grade_capture from partial results: every second file of 500 messages first, then the others, merged."""
    files = _cap(spark, d).withColumn("file", F.floor(F.col("arrival") / 2000))
    store = staged_path(spark, "partials")
    for turn in (1, 0):
        I.add_files(files.where(F.pmod("file", F.lit(2)) == turn), store, THRESHOLD)
    return _text_day(I.stored_grades(files, store, THRESHOLD))


def compact_report(spark: SparkSession, d: str) -> DataFrame:
    return _text_day(Q.compact_report(_graded(spark, d)))


def status_line(spark: SparkSession, d: str) -> DataFrame:
    return _text_day(Q.status_line(_graded(spark, d)))


def quality_report(spark: SparkSession, d: str) -> DataFrame:
    path = F.concat("source", F.lit("/"), F.col("d").cast("string"), F.lit("_"), _half().cast("string"))
    cap = _cap(spark, d).withColumn("path", path).withColumn("line", F.col("arrival"))
    return _text_day(R.quality_report(R.source_reports(cap, THRESHOLD, STEPS)))


def iso_times(spark: SparkSession, d: str) -> DataFrame:
    e = fixture(spark, d, "e")
    us = F.when(F.col("id") % 3 == 0, F.col("us") - F.pmod("us", F.lit(S.SECOND))).otherwise(F.col("us"))
    text = S.iso(us)
    return e.select("id", text.alias("iso"), F.unix_micros(S.parse_iso(text)).alias("parsed_us"), F.unix_micros(S.ms_time(F.expr("us div 1000"))).alias("ms_us"))


def rotation_window(spark: SparkSession, d: str) -> DataFrame:
    e = fixture(spark, d, "e")
    symbol = F.concat_ws("/", F.lit("BTC"), F.concat(F.lit("U_"), (F.col("id") % 5).cast("string")))
    return e.select("id", S.safe_symbol(symbol).alias("symbol"), S.rotation_window(F.col("us"), 12).alias("w")).select("id", "symbol", "w.start_us", "w.end_us", "w.label")


QUERIES = [
    event_time, classify_message, in_time_range, capture_totals, file_totals, control_counts, time_bounds, time_gaps_sorted, time_gaps_arrival, gap_stats, gap_examples,
    nonmonotone_arrival, seq_gaps_arrival, seq_gaps_by_id, segment_summary, bad_segments, snapshot_bridge, grade_capture, regrade_files, compact_report, status_line, quality_report, iso_times, rotation_window,
]

EVENT_US = "coalesce(CASE WHEN source LIKE 'binance%' THEN event_ms * 1000 ELSE data_us END, recv_us)"
SEG = """seg AS (SELECT *, sum(CASE WHEN msg = 'snapshot' THEN 1 ELSE 0 END) OVER (PARTITION BY source, d ORDER BY arrival) AS segment FROM cap WHERE msg IN ('update', 'snapshot')),
lagged AS (SELECT *, last_value(CASE WHEN msg = 'update' THEN last_id END IGNORE NULLS) OVER w AS prev_last_id, last_value(CASE WHEN msg = 'update' AND last_id IS NOT NULL THEN us END IGNORE NULLS) OVER w AS prev_us
  FROM seg WINDOW w AS (PARTITION BY source, d, segment ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
w1 AS (SELECT source, CAST(d AS VARCHAR) AS d, CAST(segment AS BIGINT) AS segment, CAST(arrival AS BIGINT) AS arrival, prev_last_id, first_id, last_id, first_id - prev_last_id - 1 AS missing, prev_us, us
  FROM lagged WHERE msg = 'update' AND prev_last_id IS NOT NULL AND first_id <> prev_last_id + 1)"""
SEGMENTS = """snaps AS (SELECT source, d, segment, us AS snapshot_us, snap_id FROM seg WHERE msg = 'snapshot'),
firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source, d, segment ORDER BY arrival) AS r, count(*) OVER (PARTITION BY source, d, segment) AS n FROM seg WHERE msg = 'update' AND first_id IS NOT NULL AND last_id IS NOT NULL) WHERE r = 1),
segments AS (SELECT s.source, CAST(s.d AS VARCHAR) AS d, CAST(s.segment AS BIGINT) AS segment, s.snapshot_us, s.snap_id, coalesce(f.n, 0) AS updates,
   CASE WHEN f.n > 0 THEN coalesce(f.first_id <= s.snap_id + 1 AND s.snap_id + 1 <= f.last_id, false) END AS bridges_snapshot,
   (SELECT count(*) FROM w1 WHERE w1.source = s.source AND w1.d = CAST(s.d AS VARCHAR) AND w1.segment = s.segment) AS sequence_gaps
  FROM snaps s LEFT JOIN firsts f ON f.source = s.source AND f.d = s.d AND f.segment = s.segment)"""
SORTED = """w3 AS (SELECT source, CAST(d AS VARCHAR) AS d, prev_us, us, (us - prev_us) / 1e6 AS seconds FROM
  (SELECT source, d, us, lag(us) OVER (PARTITION BY source, d ORDER BY us) AS prev_us FROM cap WHERE msg = 'update' AND us IS NOT NULL) WHERE prev_us IS NOT NULL)"""
STATS = """streams AS (SELECT DISTINCT source, CAST(d AS VARCHAR) AS d FROM cap WHERE msg = 'update')"""
GRADED = f"""tot AS (SELECT source, CAST(d AS VARCHAR) AS d, count(*) AS lines, count(*) FILTER (msg = 'json_error') AS json_errors, count(*) FILTER (msg = 'update') AS updates,
   count(*) FILTER (msg = 'snapshot') AS snapshots, count(*) FILTER (msg = 'control') AS control_events, min(us) FILTER (msg = 'update') AS first_us, max(us) FILTER (msg = 'update') AS last_us FROM cap GROUP BY ALL),
g2 AS (SELECT source, d, count(*) AS time_gaps, sum(us - prev_us) / 1e6 AS gap_seconds, max(us - prev_us) / 1e6 AS max_gap_seconds FROM w3 WHERE seconds >= {THRESHOLD} GROUP BY ALL),
gr AS (SELECT t.source, t.d, lines, json_errors, updates, snapshots, control_events, first_us, last_us, coalesce(time_gaps, 0) AS time_gaps, coalesce(gap_seconds, 0.0) AS gap_seconds, coalesce(max_gap_seconds, 0.0) AS max_gap_seconds,
   (SELECT count(*) FROM w1 WHERE w1.source = t.source AND w1.d = t.d) AS seq_gaps,
   (SELECT count(*) FROM segments s WHERE s.source = t.source AND s.d = t.d AND (s.bridges_snapshot = false OR s.sequence_gaps > 0)) AS bad_segments
  FROM tot t LEFT JOIN g2 USING (source, d)),
graded AS (SELECT *, CASE WHEN json_errors > 0 THEN 'REJECT_CORRUPT_JSON' WHEN updates = 0 THEN 'NO_UPDATES' WHEN source LIKE 'binance%' AND seq_gaps > 0 THEN 'CAPTURE_GAP_UNRESOLVED'
   WHEN source LIKE 'binance%' AND bad_segments > 0 THEN 'DIAGNOSTIC_ONLY' WHEN time_gaps > 0 THEN 'SEGMENTED' ELSE 'OK' END AS status FROM gr)"""
ALL_GRADED = f"WITH {ctes('cap')},\n{SEG},\n{SEGMENTS},\n{SORTED},\n{GRADED} "
BYID = """w2 AS (SELECT source, CAST(d AS VARCHAR) AS d, prev_last_id + 1 AS missing_from, first_id - 1 AS missing_to, prev_last_id, first_id AS next_first_id, last_id AS next_last_id, prev_us, us AS next_us FROM
  (SELECT *, lag(last_id) OVER w AS prev_last_id, lag(us) OVER w AS prev_us FROM cap WHERE msg = 'update' AND first_id IS NOT NULL AND last_id IS NOT NULL WINDOW w AS (PARTITION BY source, d ORDER BY first_id, last_id, arrival))
  WHERE first_id <> prev_last_id + 1)"""


def _iso(us: str) -> str:
    return f"strftime(make_timestamp({us}), '%Y-%m-%dT%H:%M:%S') || CASE WHEN {us} % 1000000 <> 0 THEN '.' || lpad(CAST({us} % 1000000 AS VARCHAR), 6, '0') ELSE '' END || 'Z'"


def _report_sql() -> str:
    step = lambda t: f"""'{t:g}': {{'count': count(*) FILTER (seconds >= {t}), 'total_seconds': coalesce(sum(us - prev_us) FILTER (seconds >= {t}), 0) / 1e6, 'max_seconds': coalesce(max(us - prev_us) FILTER (seconds >= {t}), 0) / 1e6}}"""
    zero = ", ".join(f"'{t:g}': {{'count': CAST(0 AS BIGINT), 'total_seconds': CAST(0 AS DOUBLE), 'max_seconds': CAST(0 AS DOUBLE)}}" for t in STEPS)
    rules = ", ".join(f"'{k}': '{v}'" for k, v in R.STATUS_RULES.items())
    return f"""WITH {ctes('cap')}, capf AS (SELECT *, CAST(d AS VARCHAR) AS day, source || '/' || CAST(d AS VARCHAR) || '_' || CAST(us % 86400000000 // 43200000000 AS VARCHAR) AS path FROM cap),
{SEG.replace('FROM cap ', 'FROM capf ')}, {SEGMENTS}, {SORTED}, {GRADED},
pf AS (SELECT source, day AS d, path, CAST(sum(bytes) AS BIGINT) AS bytes, count(*) AS lines, count(*) FILTER (msg = 'json_error') AS json_errors, count(*) FILTER (msg = 'update') AS updates, count(*) FILTER (msg = 'snapshot') AS snapshots,
  count(*) FILTER (msg = 'control') AS control_events, arg_min(us, arrival) FILTER (msg = 'update') AS first_us, arg_max(us, arrival) FILTER (msg = 'update') AS last_us FROM capf GROUP BY ALL),
fl AS (SELECT source, d, list({{'path': path, 'bytes': bytes, 'lines': lines, 'json_errors': json_errors, 'updates': updates, 'snapshots': snapshots, 'control_events': control_events, 'time_first': {_iso('first_us')}, 'time_last': {_iso('last_us')}}} ORDER BY path) AS files, CAST(sum(bytes) AS BIGINT) AS bytes FROM pf GROUP BY ALL),
cn AS (SELECT source, day AS d, coalesce(ctl, 'unknown') AS event, count(*) AS n FROM capf WHERE msg = 'control' GROUP BY ALL),
cl AS (SELECT source, d, map_from_entries(list((event, n) ORDER BY event)) AS controls FROM cn GROUP BY ALL),
th AS (SELECT source, d, {{{', '.join(map(step, STEPS))}}} AS thresholds FROM w3 WHERE seconds >= {min(STEPS)} GROUP BY ALL),
tx AS (SELECT source, d, list({{'seconds': seconds, 'from': {_iso('prev_us')}, 'to': {_iso('us')}}} ORDER BY us) AS shown FROM (SELECT *, row_number() OVER (PARTITION BY source, d ORDER BY us) AS r FROM w3 WHERE seconds >= {THRESHOLD}) WHERE r <= 20 GROUP BY ALL),
nm AS (SELECT source, day AS d, count(*) FILTER (us - p < -1000) AS nonmonotone FROM (SELECT *, lag(us) OVER (PARTITION BY source, d ORDER BY arrival) AS p FROM capf WHERE msg = 'update') GROUP BY ALL),
jx AS (SELECT source, day AS d, list(json_object('prev_u', prev_last_id, 'next_U', first_id, 'next_u', last_id, 'missing', first_id - prev_last_id - 1, 'time', {_iso('us')}, 'previous_time', {_iso('prev_us')}, 'file', path, 'line', arrival) ORDER BY arrival) AS jumps
  FROM (SELECT *, row_number() OVER (PARTITION BY source, d ORDER BY arrival) AS r FROM lagged WHERE msg = 'update' AND first_id <> prev_last_id + 1) WHERE r <= 20 GROUP BY ALL),
sx AS (SELECT s.source, s.d, s.segment AS num, s.bridges_snapshot = false OR s.sequence_gaps > 0 AS bad, {{'snapshot_file': p.path, 'snapshot_line': p.arrival, 'snapshot_time': {_iso('snapshot_us')}, 'snapshot_id': s.snap_id, 'updates': s.updates, 'bridges_snapshot': s.bridges_snapshot, 'sequence_gaps': s.sequence_gaps}} AS x
  FROM segments s JOIN seg p ON p.msg = 'snapshot' AND p.source = s.source AND p.day = s.d AND p.segment = s.segment),
sl AS (SELECT source, d, list(x ORDER BY num) AS segments, coalesce(list(x ORDER BY num) FILTER (bad), []) AS bad_list FROM sx GROUP BY ALL),
rep AS (SELECT g.source, g.d, CAST(to_json({{'files': files, 'totals': {{'lines': g.lines, 'json_errors': json_errors, 'updates': updates, 'snapshots': snapshots, 'control_events': control_events, 'subscriptions': CAST(0 AS BIGINT), 'bytes': bytes}},
  'controls': coalesce(controls, MAP {{}}), 'time_first': {_iso('first_us')}, 'time_last': {_iso('last_us')}, 'temporal_gaps': {{'thresholds': coalesce(thresholds, {{{zero}}}), 'examples_ge_{THRESHOLD:g}s': coalesce(shown, []), 'nonmonotone': coalesce(nonmonotone, 0)}},
  'sequence_gaps': {{'count': seq_gaps, 'examples': coalesce(jumps, [])}}, 'segments': coalesce(sl.segments, []), 'bad_segments': coalesce(bad_list, []), 'status': status}}) AS VARCHAR) AS report
  FROM graded g JOIN fl USING (source, d) LEFT JOIN cl USING (source, d) LEFT JOIN th USING (source, d) LEFT JOIN tx USING (source, d) LEFT JOIN nm USING (source, d) LEFT JOIN jx USING (source, d) LEFT JOIN sl USING (source, d))
SELECT d, '{{"date":"' || d || '","sources":{{' || string_agg('"' || source || '":' || report, ',' ORDER BY source) || '}},"status_rules":' || CAST(to_json({{{rules}}}) AS VARCHAR) || '}}' AS value FROM rep GROUP BY d"""


ORACLE = {
    "quality_report": _report_sql(),
    "event_time": f"WITH {ctes('raw')} SELECT id, source, {EVENT_US} AS event_us FROM raw",
    "classify_message": f"""WITH {ctes('raw')} SELECT id, source, CASE WHEN kind = 'control_event' THEN 'control' WHEN type = 'subscriptions' THEN 'subscription'
        WHEN source LIKE 'binance%' AND kind = 'rest_snapshot' THEN 'snapshot' WHEN source LIKE 'binance%' AND (kind = 'ws_depth_update' OR e_type = 'depthUpdate') THEN 'update'
        WHEN source NOT LIKE 'binance%' AND type = 'snapshot' THEN 'snapshot' WHEN source NOT LIKE 'binance%' AND type = 'l2update' THEN 'update' ELSE 'other' END AS msg FROM raw""",
    "in_time_range": f"""WITH {ctes('raw')}, t AS (SELECT id, source, {EVENT_US} AS event_us FROM raw)
        SELECT *, 'left' AS closed FROM t WHERE event_us IS NULL OR (event_us >= {RANGE[0]} AND event_us < {RANGE[1]})
        UNION ALL SELECT *, 'both' FROM t WHERE event_us IS NULL OR (event_us BETWEEN {RANGE[0]} AND {RANGE[1]})""",
    "capture_totals": f"""WITH {ctes('cap')}, c AS (SELECT *, coalesce(us >= {RANGE[0]} AND us < {RANGE[1]}, true) AS inside FROM cap)
        SELECT source, CAST(d AS VARCHAR) AS d, count(*) AS lines, count(*) FILTER (msg = 'json_error') AS json_errors, count(*) FILTER (msg = 'update' AND inside) AS updates, count(*) FILTER (msg = 'snapshot' AND inside) AS snapshots,
        count(*) FILTER (msg = 'control' AND inside) AS control_events, count(*) FILTER (msg = 'subscription' AND inside) AS subscriptions, CAST(sum(bytes) AS BIGINT) AS bytes FROM c GROUP BY source, d""",
    "file_totals": f"""WITH {ctes('cap')}, c AS (SELECT *, us % 86400000000 // 43200000000 AS half FROM cap)
        SELECT source, CAST(d AS VARCHAR) AS d, CAST(half AS BIGINT) AS half, count(*) AS lines, count(*) FILTER (msg = 'json_error') AS json_errors, count(*) FILTER (msg = 'update') AS updates, count(*) FILTER (msg = 'snapshot') AS snapshots,
        count(*) FILTER (msg = 'control') AS control_events, arg_min(us, arrival) FILTER (msg = 'update') AS first_us, arg_max(us, arrival) FILTER (msg = 'update') AS last_us FROM c GROUP BY source, d, half""",
    "control_counts": f"WITH {ctes('cap')} SELECT source, CAST(d AS VARCHAR) AS d, coalesce(ctl, 'unknown') AS event, count(*) AS n FROM cap WHERE msg = 'control' GROUP BY ALL",
    "time_bounds": f"WITH {ctes('cap')} SELECT source, CAST(d AS VARCHAR) AS d, min(us) AS first_us, max(us) AS last_us FROM cap WHERE msg = 'update' GROUP BY ALL",
    "time_gaps_sorted": f"WITH {ctes('cap')}, {SORTED} SELECT * FROM w3",
    "time_gaps_arrival": f"""WITH {ctes('m')} SELECT source, CAST(d AS VARCHAR) AS d, arrival AS gap_seq, start_us, us AS end_us, (us - start_us) / 1e6 AS seconds FROM
        (SELECT *, lag(us) OVER (PARTITION BY source, d ORDER BY arrival) AS start_us FROM m WHERE source = 'coinbase') WHERE (us - start_us) / 1e6 >= {THRESHOLD}""",
    "gap_stats": f"""WITH {ctes('cap')}, {SORTED}, {STATS}, th AS (SELECT unnest({STEPS}) AS threshold)
        SELECT s.source, s.d, CAST(threshold AS DOUBLE) AS threshold, count(w3.us) AS gaps, coalesce(sum(w3.us - prev_us), 0) / 1e6 AS total_seconds, coalesce(max(w3.us - prev_us), 0) / 1e6 AS max_seconds
        FROM streams s CROSS JOIN th LEFT JOIN w3 ON w3.source = s.source AND w3.d = s.d AND w3.seconds >= threshold GROUP BY ALL""",
    "gap_examples": f"""WITH {ctes('cap')}, {SORTED} SELECT * FROM (SELECT source, d, CAST(row_number() OVER (PARTITION BY source, d ORDER BY us) AS INTEGER) AS example, prev_us, us, seconds FROM w3 WHERE seconds >= {THRESHOLD}) WHERE example <= 20""",
    "nonmonotone_arrival": f"""WITH {ctes('cap')} SELECT source, CAST(d AS VARCHAR) AS d, count(*) FILTER (us - prev_us < -1000) AS backward_steps FROM
        (SELECT *, lag(us) OVER (PARTITION BY source, d ORDER BY arrival) AS prev_us FROM cap WHERE msg = 'update') GROUP BY source, d""",
    "seq_gaps_arrival": f"WITH {ctes('cap')}, {SEG} SELECT * FROM w1",
    "seq_gaps_by_id": f"WITH {ctes('cap')}, {BYID} SELECT * FROM w2",
    "segment_summary": f"WITH {ctes('cap')}, {SEG}, {SEGMENTS} SELECT * FROM segments",
    "bad_segments": f"WITH {ctes('cap')}, {SEG}, {SEGMENTS} SELECT * FROM segments WHERE bridges_snapshot = false OR sequence_gaps > 0",
    "snapshot_bridge": f"""WITH {ctes('cap')}, {SEG}, sn AS (SELECT source, d, segment, snap_id FROM seg WHERE msg = 'snapshot'),
        u AS (SELECT seg.*, sn.snap_id AS sid FROM seg JOIN sn USING (source, d, segment) WHERE msg = 'update'),
        f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source, d, segment ORDER BY arrival) AS r FROM u WHERE NOT coalesce(last_id <= sid, false)) WHERE r = 1)
        SELECT sn.source, CAST(sn.d AS VARCHAR) AS d, CAST(sn.segment AS BIGINT) AS segment, sn.snap_id, (SELECT count(*) FROM u WHERE u.source = sn.source AND u.d = sn.d AND u.segment = sn.segment AND last_id <= sid) AS stale,
        CASE WHEN f.arrival IS NULL THEN 'none' WHEN coalesce(f.first_id <= sn.snap_id + 1 AND sn.snap_id + 1 <= f.last_id, false) THEN 'ok' ELSE 'gap' END AS bridge_status
        FROM sn LEFT JOIN f USING (source, d, segment)""",
    "grade_capture": ALL_GRADED + "SELECT * FROM graded",
    "regrade_files": ALL_GRADED + "SELECT * FROM graded",
    "compact_report": ALL_GRADED + "SELECT source, d, status, updates, snapshots, json_errors, first_us, last_us, time_gaps AS gaps_ge, CASE WHEN source LIKE 'binance%' THEN seq_gaps END AS sequence_gaps FROM graded",
    "status_line": ALL_GRADED + """SELECT source, d, '- ' || source || ': ' || status || ' | updates=' || updates || ' | snapshots=' || snapshots || ' | json_errors=' || json_errors || ' | gaps>=2s=' || time_gaps || ' | seq_gaps='
        || CASE WHEN source LIKE 'binance%' THEN CAST(seq_gaps AS VARCHAR) ELSE 'n/a' END AS line FROM graded""",
    "iso_times": f"""WITH {ctes('e')}, x AS (SELECT id, us AS raw_us, CASE WHEN id % 3 = 0 THEN us - us % 1000000 ELSE us END AS us FROM e)
        SELECT id, strftime(make_timestamp(us), '%Y-%m-%dT%H:%M:%S') || CASE WHEN us % 1000000 <> 0 THEN '.' || lpad(CAST(us % 1000000 AS VARCHAR), 6, '0') ELSE '' END || 'Z' AS iso, us AS parsed_us, raw_us // 1000 * 1000 AS ms_us FROM x""",
    "rotation_window": f"""WITH {ctes('e')} SELECT id, 'BTC-U-' || (id % 5) AS symbol, us - us % 43200000000 AS start_us, us - us % 43200000000 + 43200000000 AS end_us,
        strftime(make_timestamp(us - us % 43200000000), '%Y-%m-%d_%H') || '-' || strftime(make_timestamp(us - us % 43200000000 + 43200000000), '%H') AS label FROM e""",
}
