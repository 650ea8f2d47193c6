"""Capture-like tables derived from `events`, as one SQL text for Spark and for the SQL they are checked by.

e: the events with micros and day; raw: envelopes of both exchanges; cap: a sequence-style capture (primary with
gaps, backup, snapshots, control events, broken lines); m / chg / snap: a time-style capture with book changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

MICROS = {"spark": "unix_micros(CAST(ts AS TIMESTAMP))", "duckdb": "epoch_us(CAST(ts AS TIMESTAMP))"}

E = """e AS (SELECT event_id AS id, {us} AS us, CAST(CAST(ts AS TIMESTAMP) AS DATE) AS d, day(CAST(ts AS TIMESTAMP)) AS dn,
  event_type, value, user_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k, props FROM {events})"""
RAW = """raw AS (SELECT id, 4 * id AS arrival, CASE id % 4 WHEN 0 THEN 'binance' WHEN 1 THEN 'binance_backup' WHEN 2 THEN 'coinbase' ELSE 'coinbase_backup' END AS source,
  CASE WHEN event_type = 'error' THEN 'control_event' WHEN id % 4 < 2 AND id % 9 = 0 THEN 'rest_snapshot' WHEN id % 4 < 2 AND id % 5 <> 0 THEN 'ws_depth_update' ELSE 'ws_message' END AS kind,
  CASE WHEN id % 4 < 2 THEN NULL WHEN id % 13 = 0 THEN 'subscriptions' WHEN id % 11 = 0 THEN 'snapshot' WHEN id % 17 = 0 THEN 'heartbeat' ELSE 'l2update' END AS type,
  CASE WHEN id % 4 < 2 AND id % 5 = 0 THEN 'depthUpdate' ELSE NULL END AS e_type,
  CASE WHEN id % 4 < 2 AND id % 7 <> 0 THEN us // 1000 ELSE NULL END AS event_ms,
  CASE WHEN id % 4 >= 2 AND id % 7 <> 0 THEN us - 500 ELSE NULL END AS data_us,
  CASE WHEN id % 101 = 0 THEN NULL ELSE us END AS recv_us, us, d, dn, k, value, event_type FROM e)"""
CAP = """cap AS (
 SELECT 'binance' AS source, d, 'update' AS msg, 4 * id + CASE WHEN id % 11 = 0 AND dn % 5 = 4 THEN 9 ELSE 0 END AS arrival, us,
   3 * id + 1 AS first_id, 3 * id + 3 AS last_id, CAST(NULL AS BIGINT) AS snap_id, CAST(NULL AS STRING) AS ctl, CAST(length(props) AS BIGINT) AS bytes
   FROM e WHERE NOT (dn % 3 = 0 AND id % 10 IN (3, 4))
 UNION ALL SELECT 'binance_backup', d, 'update', 4 * id, us, 3 * id + 1, 3 * id + 3, NULL, NULL, CAST(length(props) AS BIGINT) FROM e WHERE id % 7 <> 0
 UNION ALL SELECT 'binance', d, 'snapshot', 4 * id - 2, us, NULL, NULL, 3 * id + CASE WHEN dn % 3 = 1 AND id % 100 = 50 THEN 90 ELSE 0 END, NULL, CAST(length(props) AS BIGINT)
   FROM e WHERE id % 50 = 0
 UNION ALL SELECT 'binance', d, 'control', 4 * id + 2, us, NULL, NULL, NULL,
   CASE k % 4 WHEN 0 THEN 'connection_closed' WHEN 1 THEN 'connection_timeout' WHEN 2 THEN 'reconnect_sleep' ELSE NULL END, CAST(length(props) AS BIGINT)
   FROM e WHERE event_type = 'error' AND id % 4 = 0
 UNION ALL SELECT 'binance', d, 'json_error', 4 * id + 3, us, NULL, NULL, NULL, NULL, CAST(length(props) AS BIGINT) FROM e WHERE dn = 10 AND id % 97 = 0)"""
M = """m AS (
 SELECT 'coinbase' AS source, id, d, 4 * id + CASE WHEN id % 11 = 0 THEN 9 ELSE 0 END AS arrival, us, k, value FROM e WHERE NOT (dn % 3 = 0 AND id % 40 BETWEEN 10 AND 19)
 UNION ALL SELECT 'coinbase_backup', id, d, 4 * id, us, k, value FROM e WHERE id % 7 <> 0
 UNION ALL SELECT 'coinbase_backup', id, d, 4 * id + 1, us, k, value FROM e WHERE id % 7 <> 0 AND id % 9 = 0)"""
CHG = """j AS (SELECT 0 AS j UNION ALL SELECT 1 UNION ALL SELECT 2),
chg AS (SELECT source, d, arrival, us, j AS pos, CASE WHEN (id + j) % 2 = 0 THEN 'buy' ELSE 'sell' END AS side,
  CASE WHEN (id + j) % 2 = 0 THEN CAST(100 AS DOUBLE) - ((k + 7 * j) % 20) * CAST(0.5 AS DOUBLE) ELSE CAST(100.5 AS DOUBLE) + ((k + 7 * j) % 20) * CAST(0.5 AS DOUBLE) END AS price,
  CASE WHEN (id + j) % 4 = 0 THEN CAST(0 AS DOUBLE) ELSE value END AS size, CASE WHEN (id + j) % 31 = 0 THEN 2 ELSE 3 END AS parts
  FROM m CROSS JOIN j WHERE j <= id % 3)"""
SNAP = "snap AS (SELECT 4 * id - 2 AS arrival, us, d FROM e WHERE id % 400 = 0)"
ORDER = {"e": E, "raw": RAW, "cap": CAP, "m": M, "chg": CHG, "snap": SNAP}
NEEDS = {"e": [], "raw": ["e"], "cap": ["e"], "m": ["e"], "chg": ["e", "m"], "snap": ["e"]}


def ctes(*names: str) -> str:
    """WITH-list for DuckDB of these tables and what they need, in order."""
    wanted = {x for n in names for x in [*NEEDS[n], n]}
    return ",\n".join(ORDER[n] for n in ORDER if n in wanted).format(us=MICROS["duckdb"], events="events")


def fixture(spark: SparkSession, sf_dir: str, name: str, events: DataFrame | None = None) -> DataFrame:
    """One of the tables; events: a stream of the events instead of the file."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet") if events is None else events
    text = ",\n".join(ORDER[n] for n in ORDER if n in {*NEEDS[name], name}).replace("//", "div")
    return spark.sql("WITH " + text.format(us=MICROS["spark"], events="{events}") + f" SELECT * FROM {name}", events=events)
