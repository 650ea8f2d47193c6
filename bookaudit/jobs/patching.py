"""Queries of the patch and merge operators, with the SQL they are checked by."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sliced import numbered
from ..functions.staging import staged
from ..operators import continuity as C
from ..operators import merging as G
from ..operators import patching as P
from ..sources.fixtures import ctes, fixture
from .continuity import ALL_GRADED, THRESHOLD, _graded, _text_day

DAY = ["d"]


def _streams(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    cap = fixture(spark, d, "cap")
    drop = ("snap_id", "ctl", "bytes")
    return cap.where("source = 'binance' AND msg = 'update'").drop(*drop), P.dedup_latest(cap.where("source = 'binance_backup'").drop(*drop), ["d", "first_id", "last_id"])


def _gaps(primary: DataFrame) -> DataFrame:
    return C.seq_gaps_by_id(primary, DAY)


def dedup_latest(spark: SparkSession, d: str) -> DataFrame:
    m = fixture(spark, d, "m").where("source = 'coinbase_backup'")
    return _text_day(P.dedup_latest(m.select("d", "us", "k", "arrival", "value"), ["d", "us", "k"]))


def gap_candidates(spark: SparkSession, d: str) -> DataFrame:
    primary, backup = _streams(spark, d)
    return _text_day(P.gap_candidates(_gaps(primary), backup, DAY)).select("d", "missing_from", "missing_to", "first_id", "last_id", "us")


def _chained(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Both streams, the gaps and their chains; gaps and chains are written once, as several steps read them."""
    primary, backup = _streams(spark, d)
    gaps = staged(_gaps(primary), "gaps")
    return primary, backup, gaps, staged(P.chain_cover(P.gap_candidates(gaps, backup, DAY), DAY), "chains")


def chain_cover(spark: SparkSession, d: str) -> DataFrame:
    chained = _chained(spark, d)[3]
    return _text_day(chained.where("kept")).select("d", "missing_from", "missing_to", "step", "first_id", "last_id", "us")


def gap_reports(spark: SparkSession, d: str) -> DataFrame:
    _, _, gaps, chained = _chained(spark, d)
    return _text_day(P.gap_reports(gaps, chained, DAY))


def _patched(primary: DataFrame, chained: DataFrame) -> DataFrame:
    patches = chained.where("kept").drop("step", "complete", "kept").withColumns({"msg": F.lit("update"), "source": F.lit("binance")})
    return P.apply_patches(primary, patches)


def _patched_of(spark: SparkSession, d: str) -> DataFrame:
    primary, _, _, chained = _chained(spark, d)
    return _patched(primary, chained)


def with_merge_meta(spark: SparkSession, d: str) -> DataFrame:
    out = _patched_of(spark, d).select("d", "first_id", "last_id", "arrival", "merge_meta.*")
    return _text_day(out).withColumn("sources", F.array_join("sources", ","))


def apply_patches(spark: SparkSession, d: str) -> DataFrame:
    return _patched_of(spark, d).groupBy(F.col("d").cast("string").alias("d"), "merge_meta.source").agg(F.count("*").alias("n"), F.sum("first_id").alias("ids"), F.max("last_id").alias("top"))


def merge_order_by_id(spark: SparkSession, d: str) -> DataFrame:
    patched = _patched_of(spark, d)
    return _text_day(numbered(patched.withColumn("origin", F.col("merge_meta.source")).drop("merge_meta"), DAY, P.merge_order_by_id(patched), "place")).select("d", "first_id", "last_id", "arrival", "us", F.col("origin").alias("source"), "place")


def patch_stats(spark: SparkSession, d: str) -> DataFrame:
    """Sequence and time gaps of the primary, the backup and the patched stream, measured anew."""
    primary, backup, _, chained = _chained(spark, d)
    cols = ["d", "msg", "arrival", "us", "first_id", "last_id"]
    streams = [("primary", primary), ("backup", backup), ("merged", _patched(primary, chained))]
    every = None
    for name, df in streams:
        df = df.select(F.lit(name).alias("stream"), *cols)
        every = df if every is None else every.unionByName(df)
    key = ["stream", "d"]
    seq = C.seq_gaps_by_id(every, key).groupBy(*key).agg(F.count("*").alias("sequence_gaps"))
    big = C.gap_stats(C.time_gaps_sorted(every, key), every, [THRESHOLD], key).select(*key, F.col("gaps").alias("time_gaps"), "max_seconds")
    out = every.groupBy(*key).agg(F.count("*").alias("records")).join(seq, key, "left").join(big, key)
    return _text_day(out.withColumn("sequence_gaps", F.coalesce("sequence_gaps", F.lit(0)).cast("long")))


#: Fixture events are minutes apart: the threshold of a gap stands beside smaller and larger ones.
REPORT_STEPS = [THRESHOLD / 10, float(THRESHOLD), 4.0 * THRESHOLD]


def _id_report(spark: SparkSession, d: str) -> DataFrame:
    """Report of the patches of every day by ids."""
    primary, backup, gaps, chained = _chained(spark, d)
    return P.id_patch_report(primary, backup, _patched(primary, chained), gaps, chained, DAY, REPORT_STEPS)


def _time_report(spark: SparkSession, d: str) -> DataFrame:
    """The same by time."""
    m = fixture(spark, d, "m").select("source", "d", "arrival", "us")
    inside, timed = _gap_changes(spark, d), _time_gaps(spark, d)
    kept = P.dedup_changes(P.valid_change(inside), DAY)
    side = lambda s: m.where(F.col("source") == s).drop("source")
    return P.time_patch_report(side("coinbase"), side("coinbase_backup"), timed, inside, kept, P.rebuilt_messages(kept, DAY), DAY, REPORT_STEPS)


def id_patch_report(spark: SparkSession, d: str) -> DataFrame:
    r = _id_report(spark, d)
    stats = lambda s: [F.col(f"{s}.{c}").alias(f"{s}_{c}") for c in ("records", "depth_updates", "json_errors", "sequence_gaps")] + [F.col(f"{s}.temporal_gaps")[f"{t:g}"]["count"].alias(f"{s}_gaps_{i}") for i, t in enumerate(REPORT_STEPS)]
    gaps = F.array_join(F.transform("patch.gaps", lambda g: F.concat_ws("-", g["missing_from"], g["missing_to"], g["patch_records"])), ",")
    return _text_day(r.select("d", *stats("primary"), *stats("backup"), *stats("merged"), "patch.primary_sequence_gaps_detected", "patch.backup_patch_records", F.coalesce(gaps, F.lit("")).alias("gaps")))


def time_patch_report(spark: SparkSession, d: str) -> DataFrame:
    r = _time_report(spark, d)
    stat = lambda s, i, c: F.col(f"{s}.gap_stats")[f"{REPORT_STEPS[i]:g}"][c].alias(f"{s}_{c}_{i}")
    stats = [stat(s, i, c) for s in ("primary", "merged") for i in range(3) for c in ("count", "max_seconds")]
    return _text_day(r.select("d", "primary.gaps_detected", F.col("primary.records").alias("before"), "backup.*", *[f"merged.{c}" for c in ("records", "primary_records", "backup_patch_records", "patch_l2updates", "first_us", "last_us")], *stats))


def patch_counts(spark: SparkSession, d: str) -> DataFrame:
    """What grading reads of both kinds of reports, each a plan of its own and written once."""
    return P.report_counts(F.col("d").cast("string"), staged(_id_report(spark, d), "id_report"), staged(_time_report(spark, d), "time_report"), DAY, f"{THRESHOLD:g}")


def pair_quality(spark: SparkSession, d: str) -> DataFrame:
    return _text_day(P.pair_quality(_graded(spark, d)))


def patchable(spark: SparkSession, d: str) -> DataFrame:
    return _text_day(P.patchable(P.pair_quality(_graded(spark, d)))).select("exchange", "d", "patchable", "reason")


def _time_gaps(spark: SparkSession, d: str) -> DataFrame:
    return C.time_gaps_arrival(fixture(spark, d, "m").where("source = 'coinbase'"), THRESHOLD, DAY)


def in_gap(spark: SparkSession, d: str) -> DataFrame:
    backup = fixture(spark, d, "m").where("source = 'coinbase_backup'").select("d", "id", "arrival", "us")
    return _text_day(P.in_gap(backup, _time_gaps(spark, d), DAY))


def _gap_changes(spark: SparkSession, d: str) -> DataFrame:
    chg = fixture(spark, d, "chg").where("source = 'coinbase_backup'")
    return P.in_gap(chg, _time_gaps(spark, d), DAY)


def valid_change(spark: SparkSession, d: str) -> DataFrame:
    chg = fixture(spark, d, "chg")
    seen = chg.groupBy("source", "d").agg(F.count("*").alias("seen"))
    kept = P.valid_change(chg).groupBy("source", "d").agg(F.count("*").alias("valid"))
    return _text_day(seen.join(kept, ["source", "d"], "left"))


def dedup_changes(spark: SparkSession, d: str) -> DataFrame:
    return _text_day(P.dedup_changes(P.valid_change(_gap_changes(spark, d)), DAY))


def patch_messages(spark: SparkSession, d: str) -> DataFrame:
    out = P.rebuilt_messages(P.dedup_changes(P.valid_change(_gap_changes(spark, d)), DAY), DAY)
    return _text_day(out).select("d", "arrival", "us", F.size("changes").alias("n"), F.array_join(F.transform("changes", lambda c: c["pos"].cast("string")), ",").alias("places"))


def interleave_patches(spark: SparkSession, d: str) -> DataFrame:
    primary = fixture(spark, d, "m").where("source = 'coinbase'").select("d", "arrival", "us")
    patches = P.rebuilt_messages(P.dedup_changes(P.valid_change(_gap_changes(spark, d)), DAY), DAY).select("d", "arrival", "us")
    mixed = P.interleave_patches(primary, patches, DAY)
    return _text_day(numbered(mixed, DAY, [F.col("_at").asc_nulls_first(), F.col("_own"), F.col("_seq")], "place")).select("d", "origin", "arrival", "us", "place")


RECORDS = """rec AS (SELECT source, d, arrival, us, CASE WHEN id % 50 = 3 THEN 'control_event' ELSE 'ws_message' END AS kind,
  CASE WHEN id % 50 = 1 THEN 'snapshot' WHEN id % 50 = 2 THEN 'subscriptions' WHEN id % 50 IN (3, 4) THEN NULL ELSE 'l2update' END AS type, CASE WHEN id % 2 = 0 THEN 'BTC-USD' END AS product_id, 'ETH-USD' AS symbol,
  CASE WHEN id % 3 <> 0 THEN CAST(us AS STRING) END AS time, CAST(us - 7 AS STRING) AS recv_time, CAST(k AS STRING) || ':' || CAST(id % 29 AS STRING) AS payload FROM m)"""
KEYED = "keyed AS (SELECT *, coalesce(type, kind, 'unknown') AS message, coalesce(product_id, symbol, '') AS product, coalesce(time, recv_time, '') AS at_time, sha256(payload) AS hash FROM rec)"


def _records(spark: SparkSession, d: str) -> DataFrame:
    return spark.sql(f"WITH {RECORDS.replace('FROM m)', 'FROM {m})')} SELECT * FROM rec", m=fixture(spark, d, "m"))


def _key_of(rec: DataFrame):
    return G.dedup_key(*[rec[c] for c in ("type", "kind", "product_id", "symbol", "time", "recv_time", "payload")])


def keep_mergeable(spark: SparkSession, d: str) -> DataFrame:
    return _text_day(G.keep_mergeable(_records(spark, d)).groupBy("source", "d", "kind", "type").agg(F.count("*").alias("n")))


def dedup_key(spark: SparkSession, d: str) -> DataFrame:
    rec = _records(spark, d)
    return rec.select("source", "arrival", _key_of(rec).alias("k")).select("source", "arrival", "k.message", "k.product", "k.time", "k.hash")


def payload_hash(spark: SparkSession, d: str) -> DataFrame:
    """Canonical payload and its hash of update, snapshot and other records; some lists are null, empty or over ten long."""
    k = fixture(spark, d, "m").select("source", "arrival", "id", "us", F.col("k").cast("long").alias("k"))
    text = lambda c: c.cast("string")
    change = F.array(F.when(F.col("id") % 2 == 0, "buy").otherwise("sell"), text(F.col("k")), text(F.col("id") % 29))
    levels = lambda step: F.transform(F.sequence(F.lit(1), F.lit(13)), lambda j: F.array(text(F.col("k") + step * j), text(F.col("id") % 29)))
    bids, asks = F.slice(levels(-1), F.lit(1), (F.col("id") % 14).cast("int")), F.slice(levels(1), F.lit(1), (F.col("id") % 5).cast("int"))
    changes = F.when(F.col("id") % 3 == 1, F.array(change)).when(F.col("id") % 3 == 2, F.array(change, change))
    type_ = F.when(F.col("id") % 4 == 1, "snapshot").when(F.col("id") % 4 == 2, "subscriptions").otherwise("l2update")
    payload = G.canonical_payload(type_, changes, F.when(F.col("id") % 9 != 0, bids), asks, F.concat(F.lit('{"id":'), text(F.col("id")), F.lit("}")))
    return k.select("source", "arrival", payload.alias("payload"), F.sha2(payload, 256).alias("hash"))


def stream_counts(spark: SparkSession, d: str) -> DataFrame:
    return _text_day(G.stream_counts(_records(spark, d), ["source", "d"]))


def _merged(spark: SparkSession, d: str) -> DataFrame:
    rec = _records(spark, d)
    keyed = rec.select("source", "d", "type", "us", "arrival", _key_of(rec).alias("k")).select("source", "d", "type", "us", "arrival", F.col("k.message").alias("msg_type"), "k.product", "k.time", "k.hash")
    return G.merge_streams(keyed.where("source = 'coinbase'"), keyed.where("source = 'coinbase_backup'"), ["d", "msg_type", "product", "time", "hash"])


def merge_streams(spark: SparkSession, d: str) -> DataFrame:
    return _text_day(_merged(spark, d))


def merge_order_by_time(spark: SparkSession, d: str) -> DataFrame:
    merged = _merged(spark, d)
    return _text_day(numbered(merged, DAY, G.merge_order_by_time(merged), "place")).select("d", "us", "type", "source", "first", "place")


def source_counts(spark: SparkSession, d: str) -> DataFrame:
    return _text_day(G.source_counts(_merged(spark, d), ["d"]))


QUERIES = [
    dedup_latest, gap_candidates, chain_cover, gap_reports, with_merge_meta, apply_patches, merge_order_by_id, patch_stats, id_patch_report, time_patch_report, pair_quality, patchable, in_gap, valid_change, dedup_changes,
    patch_messages, interleave_patches, keep_mergeable, dedup_key, payload_hash, stream_counts, merge_streams, merge_order_by_time, source_counts,
]

PRIMARY = """prim AS (SELECT * FROM cap WHERE source = 'binance' AND msg = 'update'),
back AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY d, first_id, last_id ORDER BY arrival DESC) AS r FROM cap WHERE source = 'binance_backup') WHERE r = 1),
gaps AS (SELECT d, prev_last_id + 1 AS missing_from, first_id - 1 AS missing_to, prev_us, us AS next_us FROM
  (SELECT *, lag(last_id) OVER w AS prev_last_id, lag(us) OVER w AS prev_us FROM prim WHERE first_id IS NOT NULL AND last_id IS NOT NULL WINDOW w AS (PARTITION BY d ORDER BY first_id, last_id, arrival)) WHERE first_id <> prev_last_id + 1),
cand AS (SELECT g.d, g.missing_from, g.missing_to, b.first_id, b.last_id, b.us, b.arrival FROM gaps g JOIN back b ON b.d = g.d AND b.last_id >= g.missing_from AND b.first_id <= g.missing_to)"""
CHAIN = """ch0 AS (SELECT *, row_number() OVER w AS step, coalesce(lag(last_id) OVER w + 1, missing_from) AS expected FROM cand WINDOW w AS (PARTITION BY d, missing_from, missing_to ORDER BY first_id, last_id)),
ch1 AS (SELECT *, min(CASE WHEN first_id <> expected THEN step END) OVER g AS broken, min(CASE WHEN last_id >= missing_to THEN step END) OVER g AS reached FROM ch0 WINDOW g AS (PARTITION BY d, missing_from, missing_to)),
ch AS (SELECT *, coalesce(reached < coalesce(broken, reached + 1), false) AS complete, coalesce(reached < coalesce(broken, reached + 1), false) AND step <= reached AS kept FROM ch1)"""
PATCHED = """pat AS (SELECT d, arrival, us, first_id, last_id, 'primary' AS source, 'primary' AS sources, false AS gap_filled, CAST(NULL AS BIGINT) AS missing_from, CAST(NULL AS BIGINT) AS missing_to FROM prim
  UNION ALL SELECT d, arrival, us, first_id, last_id, 'backup_patch', 'backup', true, missing_from, missing_to FROM ch WHERE kept)"""
SEQ = f"WITH {ctes('cap')},\n{PRIMARY},\n{CHAIN},\n{PATCHED} "
TIMED = f"""tg AS (SELECT d, arrival AS gap_seq, start_us, us AS end_us FROM (SELECT *, lag(us) OVER (PARTITION BY d ORDER BY arrival) AS start_us FROM m WHERE source = 'coinbase') WHERE (us - start_us) / 1e6 >= {THRESHOLD})"""
INGAP = """kc AS (SELECT * FROM (SELECT c.*, row_number() OVER (PARTITION BY d, us, side, price, size ORDER BY arrival, pos) AS r FROM chg c
  WHERE source = 'coinbase_backup' AND parts >= 3 AND EXISTS (SELECT 1 FROM tg WHERE tg.d = c.d AND tg.start_us < c.us AND c.us < tg.end_us)) WHERE r = 1)"""
MERGED = """pk AS (SELECT d, message, product, at_time, hash, arg_max(type, arrival) AS type, arg_max(us, arrival) AS us, max(arrival) AS arrival, min(arrival) AS first FROM keyed WHERE source = 'coinbase' GROUP BY ALL),
bk AS (SELECT d, message, product, at_time, hash, arg_max(type, arrival) AS type, arg_max(us, arrival) AS us, max(arrival) AS arrival, min(arrival) AS first FROM keyed WHERE source = 'coinbase_backup' GROUP BY ALL),
mg AS (SELECT d, message AS msg_type, product, at_time AS time, hash, CASE WHEN pk.arrival IS NOT NULL AND bk.arrival IS NOT NULL THEN 'both' WHEN pk.arrival IS NOT NULL THEN 'primary' ELSE 'backup' END AS source,
  CASE WHEN pk.arrival IS NOT NULL THEN pk.type ELSE bk.type END AS type, CASE WHEN pk.arrival IS NOT NULL THEN pk.us ELSE bk.us END AS us, CASE WHEN pk.arrival IS NOT NULL THEN pk.first ELSE bk.first END AS first,
  pk.arrival AS primary_arrival, bk.arrival AS backup_arrival FROM pk FULL JOIN bk USING (d, message, product, at_time, hash))"""
REC = f"WITH {ctes('m')},\n{RECORDS},\n{KEYED} "
PAIRS = """pq AS (SELECT p.source AS exchange, p.d, p.status AS primary_status, p.updates AS primary_updates, p.seq_gaps AS primary_seq_gaps, b.status AS backup_status, b.updates AS backup_updates, b.seq_gaps AS backup_seq_gaps
  FROM graded p LEFT JOIN graded b ON b.d = p.d AND b.source = p.source || '_backup' WHERE p.source NOT LIKE '%_backup')"""

GAPS_AT = ", ".join(f"count(*) FILTER ((us - p) / 1e6 >= {t}) AS gaps_{i}, coalesce(max(us - p) FILTER ((us - p) / 1e6 >= {t}), 0) / 1e6 AS max_{i}" for i, t in enumerate(REPORT_STEPS))
PATCH_MEASURES = f"""pev AS (SELECT 'primary' AS stream, d, arrival, us, first_id, last_id FROM prim UNION ALL SELECT 'backup', d, arrival, us, first_id, last_id FROM back UNION ALL SELECT 'merged', d, arrival, us, first_id, last_id FROM pat),
psq AS (SELECT stream, d, count(*) AS records, count(*) FILTER (first_id <> p + 1) AS sequence_gaps FROM (SELECT *, lag(last_id) OVER (PARTITION BY stream, d ORDER BY first_id, last_id, arrival) AS p FROM pev) GROUP BY ALL),
ptm AS (SELECT stream, d, {GAPS_AT} FROM (SELECT *, lag(us) OVER (PARTITION BY stream, d ORDER BY us) AS p FROM pev) GROUP BY ALL),
pms AS (SELECT * FROM psq JOIN ptm USING (stream, d)),
pgr AS (SELECT *, row_number() OVER (PARTITION BY d ORDER BY missing_from, missing_to) AS r FROM (SELECT g.d, g.missing_from, g.missing_to, count(*) FILTER (ch.kept) AS n FROM gaps g LEFT JOIN ch USING (d, missing_from, missing_to) GROUP BY g.d, g.missing_from, g.missing_to)),
pgp AS (SELECT d, count(*) AS detected, CAST(sum(n) AS BIGINT) AS patched, string_agg(missing_from || '-' || missing_to || '-' || n, ',' ORDER BY r) FILTER (r <= 20) AS gaps FROM pgr GROUP BY d)"""
TIME_MEASURES = f"""tpm AS (SELECT DISTINCT d, arrival, us FROM kc),
tev AS (SELECT 'primary' AS stream, d, us FROM m WHERE source = 'coinbase' UNION ALL SELECT 'merged', d, us FROM m WHERE source = 'coinbase' UNION ALL SELECT 'merged', d, us FROM tpm),
tms AS (SELECT stream, d, count(*) AS records, min(us) AS first_us, max(us) AS last_us, {GAPS_AT} FROM (SELECT *, lag(us) OVER (PARTITION BY stream, d ORDER BY us) AS p FROM tev) GROUP BY ALL),
tin AS (SELECT d, count(*) AS n FROM m WHERE source = 'coinbase_backup' AND EXISTS (SELECT 1 FROM tg WHERE tg.d = m.d AND tg.start_us < m.us AND m.us < tg.end_us) GROUP BY d),
tch AS (SELECT d, count(*) AS seen, count(*) FILTER (parts >= 3) AS valid FROM chg c WHERE source = 'coinbase_backup' AND EXISTS (SELECT 1 FROM tg WHERE tg.d = c.d AND tg.start_us < c.us AND c.us < tg.end_us) GROUP BY d),
tkc AS (SELECT d, count(*) AS n FROM kc GROUP BY d), tpn AS (SELECT d, count(*) AS n FROM tpm GROUP BY d), tgn AS (SELECT d, count(*) AS n FROM tg GROUP BY d), tbk AS (SELECT d, count(*) AS n FROM m WHERE source = 'coinbase_backup' GROUP BY d)"""

ORACLE = {
    "id_patch_report": SEQ + f""", {PATCH_MEASURES} SELECT CAST(d AS VARCHAR) AS d, {", ".join(f"{s}.records AS {s}_records, {s}.records AS {s}_depth_updates, 0::BIGINT AS {s}_json_errors, {s}.sequence_gaps AS {s}_sequence_gaps, " + ", ".join(f"{s}.gaps_{i} AS {s}_gaps_{i}" for i in range(3)) for s in ("primary", "backup", "merged"))},
        coalesce(detected, 0) AS primary_sequence_gaps_detected, coalesce(patched, 0) AS backup_patch_records, coalesce(gaps, '') AS gaps
        FROM (SELECT * FROM pms WHERE stream = 'primary') AS primary LEFT JOIN (SELECT * FROM pms WHERE stream = 'backup') AS backup USING (d) LEFT JOIN (SELECT * FROM pms WHERE stream = 'merged') AS merged USING (d) LEFT JOIN pgp USING (d)""".replace("AS primary LEFT", "AS prime LEFT").replace("primary.", "prime."),
    "time_patch_report": f"""WITH {ctes('m', 'chg')}, {TIMED}, {INGAP}, {TIME_MEASURES} SELECT CAST(d AS VARCHAR) AS d, coalesce(tgn.n, 0) AS gaps_detected, p.records AS before, coalesce(tbk.n, 0) AS l2updates_seen, coalesce(tin.n, 0) AS l2updates_inside_primary_gaps,
        coalesce(seen, 0) AS changes_seen_inside_gaps, coalesce(tkc.n, 0) AS changes_kept_inside_gaps, coalesce(valid, 0) - coalesce(tkc.n, 0) AS changes_deduped_inside_gaps, g.records, p.records AS primary_records, coalesce(tpn.n, 0) AS backup_patch_records,
        coalesce(tpn.n, 0) AS patch_l2updates, g.first_us, g.last_us, {", ".join(f"{x}.gaps_{i} AS {s}_count_{i}, {x}.max_{i} AS {s}_max_seconds_{i}" for x, s in (("p", "primary"), ("g", "merged")) for i in range(3))}
        FROM (SELECT * FROM tms WHERE stream = 'primary') AS p JOIN (SELECT * FROM tms WHERE stream = 'merged') AS g USING (d) LEFT JOIN tgn USING (d) LEFT JOIN tbk USING (d) LEFT JOIN tin USING (d) LEFT JOIN tch USING (d) LEFT JOIN tkc USING (d) LEFT JOIN tpn USING (d)""",
    "dedup_latest": f"WITH {ctes('m')} SELECT CAST(d AS VARCHAR) AS d, us, k, max(arrival) AS arrival, arg_max(value, arrival) AS value FROM m WHERE source = 'coinbase_backup' GROUP BY d, us, k",
    "gap_candidates": SEQ + "SELECT CAST(d AS VARCHAR) AS d, missing_from, missing_to, first_id, last_id, us FROM cand",
    "chain_cover": SEQ + "SELECT CAST(d AS VARCHAR) AS d, missing_from, missing_to, CAST(step AS INTEGER) AS step, first_id, last_id, us FROM ch WHERE kept",
    "gap_reports": SEQ + """, r AS (SELECT d, missing_from, missing_to, bool_or(complete) AS complete, count(*) FILTER (kept) AS p, count(*) AS c FROM ch GROUP BY ALL)
        SELECT CAST(d AS VARCHAR) AS d, missing_from, missing_to, prev_us, next_us, coalesce(complete, missing_from > missing_to) AS complete, coalesce(p, 0) AS patch_records, coalesce(c, 0) AS candidate_records
        FROM gaps LEFT JOIN r USING (d, missing_from, missing_to)""",
    "with_merge_meta": SEQ + "SELECT CAST(d AS VARCHAR) AS d, first_id, last_id, arrival, source, sources, gap_filled, missing_from, missing_to FROM pat",
    "apply_patches": SEQ + "SELECT CAST(d AS VARCHAR) AS d, source, count(*) AS n, CAST(sum(first_id) AS BIGINT) AS ids, max(last_id) AS top FROM pat GROUP BY d, source",
    "merge_order_by_id": SEQ + """SELECT CAST(d AS VARCHAR) AS d, first_id, last_id, arrival, us, source,
        CAST(row_number() OVER (PARTITION BY d ORDER BY coalesce(first_id, -1), coalesce(last_id, -1), us NULLS FIRST, arrival) AS INTEGER) AS place FROM pat""",
    "patch_stats": SEQ + f""", ev AS (SELECT 'primary' AS stream, d, arrival, us, first_id, last_id FROM prim UNION ALL SELECT 'backup', d, arrival, us, first_id, last_id FROM back UNION ALL SELECT 'merged', d, arrival, us, first_id, last_id FROM pat),
        s AS (SELECT stream, d, count(*) FILTER (first_id <> p + 1) AS sequence_gaps FROM (SELECT *, lag(last_id) OVER (PARTITION BY stream, d ORDER BY first_id, last_id, arrival) AS p FROM ev) GROUP BY ALL),
        t AS (SELECT stream, d, count(*) FILTER ((us - p) / 1e6 >= {THRESHOLD}) AS time_gaps, coalesce(max(us - p) FILTER ((us - p) / 1e6 >= {THRESHOLD}), 0) / 1e6 AS max_seconds, count(*) AS records
          FROM (SELECT *, lag(us) OVER (PARTITION BY stream, d ORDER BY us) AS p FROM ev) GROUP BY ALL)
        SELECT stream, CAST(d AS VARCHAR) AS d, records, sequence_gaps, time_gaps, max_seconds FROM s JOIN t USING (stream, d)""",
    "pair_quality": ALL_GRADED + f", {PAIRS} SELECT * FROM pq",
    "patchable": ALL_GRADED + f""", {PAIRS}, o AS (SELECT exchange, d, coalesce(primary_status IN ('SEGMENTED', 'CAPTURE_GAP_UNRESOLVED') AND primary_updates > 0 AND coalesce(backup_updates, 0) > 0
        AND (exchange NOT LIKE 'binance%' OR coalesce(primary_seq_gaps, 0) > 0), false) AS patchable FROM pq)
        SELECT *, CASE WHEN patchable THEN '' ELSE 'primary not patchable or backup unavailable' END AS reason FROM o""",
    "in_gap": f"""WITH {ctes('m')}, {TIMED} SELECT CAST(d AS VARCHAR) AS d, id, arrival, us, gap_seq, start_us, end_us FROM
        (SELECT m.d, m.id, m.arrival, m.us, tg.gap_seq, tg.start_us, tg.end_us, row_number() OVER (PARTITION BY m.d, m.id, m.arrival ORDER BY tg.gap_seq) AS r
         FROM m JOIN tg ON tg.d = m.d AND tg.start_us < m.us AND m.us < tg.end_us WHERE m.source = 'coinbase_backup') WHERE r = 1""",
    "valid_change": f"WITH {ctes('m', 'chg')} SELECT source, CAST(d AS VARCHAR) AS d, count(*) AS seen, count(*) FILTER (parts >= 3) AS valid FROM chg GROUP BY ALL",
    "dedup_changes": f"WITH {ctes('m', 'chg')}, {TIMED}, {INGAP} SELECT CAST(d AS VARCHAR) AS d, arrival, pos, us, side, price, size FROM kc",
    "patch_messages": f"WITH {ctes('m', 'chg')}, {TIMED}, {INGAP} SELECT CAST(d AS VARCHAR) AS d, arrival, us, CAST(count(*) AS INTEGER) AS n, string_agg(CAST(pos AS VARCHAR), ',' ORDER BY pos) AS places FROM kc GROUP BY d, arrival, us",
    "interleave_patches": f"""WITH {ctes('m', 'chg')}, {TIMED}, {INGAP}, pm AS (SELECT DISTINCT d, arrival, us FROM kc),
        x AS (SELECT d, 'primary' AS origin, arrival, us, max(us) OVER (PARTITION BY d ORDER BY arrival) AS at_us, 1 AS own FROM m WHERE source = 'coinbase' UNION ALL SELECT d, 'patch', arrival, us, us, 0 FROM pm)
        SELECT CAST(d AS VARCHAR) AS d, origin, arrival, us, CAST(row_number() OVER (PARTITION BY d ORDER BY at_us NULLS FIRST, own, arrival) AS INTEGER) AS place FROM x""",
    "keep_mergeable": REC + "SELECT source, CAST(d AS VARCHAR) AS d, kind, type, count(*) AS n FROM rec WHERE type IN ('snapshot', 'l2update', 'subscriptions') OR kind = 'control_event' GROUP BY ALL",
    "dedup_key": REC + "SELECT source, arrival, message, product, at_time AS time, hash FROM keyed",
    "payload_hash": f"""WITH {ctes('m')}, x AS (SELECT source, arrival, id, [CASE WHEN id % 2 = 0 THEN 'buy' ELSE 'sell' END, CAST(k AS VARCHAR), CAST(id % 29 AS VARCHAR)] AS ch,
        CASE WHEN id % 9 <> 0 THEN [[CAST(k - j AS VARCHAR), CAST(id % 29 AS VARCHAR)] FOR j IN range(1, 1 + id % 14)] ELSE [] END AS bids, [[CAST(k + j AS VARCHAR), CAST(id % 29 AS VARCHAR)] FOR j IN range(1, 1 + id % 5)] AS asks FROM m),
        p AS (SELECT source, arrival, CASE id % 4 WHEN 1 THEN CAST(to_json({{'asks_len': len(asks), 'asks_top': asks[1:10], 'bids_len': len(bids), 'bids_top': bids[1:10]}}) AS VARCHAR) WHEN 2 THEN '{{"id":' || id || '}}'
          ELSE CAST(to_json(CASE id % 3 WHEN 1 THEN [ch] WHEN 2 THEN [ch, ch] ELSE [] END) AS VARCHAR) END AS payload FROM x)
        SELECT source, arrival, payload, sha256(payload) AS hash FROM p""",
    "stream_counts": REC + """SELECT source, CAST(d AS VARCHAR) AS d, count(*) AS records_seen, count(*) FILTER (type = 'l2update') AS l2updates, count(*) FILTER (type = 'snapshot') AS snapshots, count(*) FILTER (type = 'subscriptions') AS subscriptions,
        count(*) FILTER (coalesce(type NOT IN ('l2update', 'snapshot', 'subscriptions'), true) AND kind = 'control_event') AS controls FROM rec GROUP BY source, d""",
    "merge_streams": REC + f", {MERGED} SELECT * REPLACE (CAST(d AS VARCHAR) AS d) FROM mg",
    "merge_order_by_time": REC + f""", {MERGED} SELECT CAST(d AS VARCHAR) AS d, us, type, source, first, CAST(row_number() OVER (PARTITION BY d ORDER BY us NULLS FIRST, CASE type WHEN 'subscriptions' THEN 0 WHEN 'snapshot' THEN 1 WHEN 'l2update' THEN 2 ELSE 3 END,
        CASE WHEN source = 'backup' THEN 1 ELSE 0 END, first) AS INTEGER) AS place FROM mg""",
    "source_counts": REC + f", {MERGED} SELECT CAST(d AS VARCHAR) AS d, count(*) FILTER (source = 'primary') AS primary_only, count(*) FILTER (source = 'backup') AS backup_only, count(*) FILTER (source = 'both') AS both FROM mg GROUP BY d",
}
