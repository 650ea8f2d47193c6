"""Queries of the book operators, with the SQL they are checked by. Bars of 600 s stand for 1 s."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.staging import staged
from ..operators import book as B
from ..sources.fixtures import ctes, fixture
from .continuity import THRESHOLD

BAR, N = 600, 10


def _updates(spark: SparkSession, d: str) -> DataFrame:
    return fixture(spark, d, "m").where("source = 'coinbase'")


def _assigned(spark: SparkSession, d: str) -> DataFrame:
    snaps = fixture(spark, d, "snap").withColumn("source", F.lit("coinbase"))
    return B.assign_segments(_updates(spark, d), snaps)


def _barred(spark: SparkSession, d: str) -> DataFrame:
    return B.assign_bars(_assigned(spark, d), BAR)


def _changes(spark: SparkSession, d: str) -> DataFrame:
    return fixture(spark, d, "chg").where("source = 'coinbase' AND parts >= 3")


def _events(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    barred = staged(_barred(spark, d), "barred")
    i = F.explode(F.sequence(F.lit(0), F.lit(9)))
    levels = B.segment_starts(_assigned(spark, d)).select("source", "segment", i.alias("i"), F.explode(F.array(F.lit("buy"), F.lit("sell"))).alias("side"))
    price = F.when(F.col("side") == "buy", 100 - 0.5 * F.col("i")).otherwise(100.5 + 0.5 * F.col("i"))
    levels = levels.select("source", "segment", "side", price.alias("price"), (1.0 + F.col("i")).alias("size"))
    return staged(B.level_events(barred, _changes(spark, d), levels), "levels"), staged(B.emitted_bars(barred, BAR), "bars")


def assign_segments(spark: SparkSession, d: str) -> DataFrame:
    return _assigned(spark, d).groupBy("source", "segment").agg(F.count_if(~F.col("is_snapshot")).alias("updates"), F.min("arrival").alias("first"), F.max("arrival").alias("last"))


def segment_lag(spark: SparkSession, d: str) -> DataFrame:
    return B.segment_starts(_assigned(spark, d))


def assign_bars(spark: SparkSession, d: str) -> DataFrame:
    return _barred(spark, d).select("source", "segment", "arrival", "us", "bar")


def flag_bar_gaps(spark: SparkSession, d: str) -> DataFrame:
    return B.flag_bar_gaps(_barred(spark, d), THRESHOLD)


def bar_activity(spark: SparkSession, d: str) -> DataFrame:
    return B.bar_activity(_barred(spark, d), _changes(spark, d))


def book_asof(spark: SparkSession, d: str) -> DataFrame:
    events, bars = _events(spark, d)
    return B.book_asof(events, bars, BAR, chunk_bars=36)


def book_top_n(spark: SparkSession, d: str) -> DataFrame:
    return B.book_top_n(book_asof(spark, d), N)


def book_features(spark: SparkSession, d: str) -> DataFrame:
    events, bars = _events(spark, d)
    rows = B.book_features(B.replay_book(events, bars, BAR, N), N)
    doubles = [c for c, t in rows.dtypes if t == "double"]
    return rows.withColumns({c: F.round(c, 9) for c in doubles})


QUERIES = [assign_segments, segment_lag, assign_bars, flag_bar_gaps, bar_activity, book_asof, book_top_n, book_features]

SEGMENTED = """seg AS (SELECT *, CAST(sum(CASE WHEN is_snapshot THEN 1 ELSE 0 END) OVER (PARTITION BY source ORDER BY arrival) AS BIGINT) AS segment FROM
  (SELECT source, arrival, us, false AS is_snapshot FROM m WHERE source = 'coinbase' UNION ALL SELECT 'coinbase', arrival, us, true FROM snap)),
bar AS (SELECT source, segment, arrival, us, max(us - us % 600000000) OVER (PARTITION BY source, segment ORDER BY arrival) AS bar FROM seg WHERE NOT is_snapshot AND segment > 0)"""
LEVELS = """fb AS (SELECT source, segment, min(bar) AS lo, max(bar) AS hi FROM bar GROUP BY ALL),
ev AS (SELECT source, segment, bar, side, price, arg_max(size, at_place) AS size FROM (
   SELECT b.source, b.segment, b.bar, c.side, c.price, c.size, b.arrival * 10 + c.pos AS at_place FROM bar b JOIN chg c ON c.source = b.source AND c.arrival = b.arrival AND c.parts >= 3
   UNION ALL SELECT f.source, f.segment, f.lo, side, CASE WHEN side = 'buy' THEN 100 - 0.5 * i ELSE 100.5 + 0.5 * i END, 1.0 + i, -1 FROM fb f CROSS JOIN (SELECT unnest(['buy', 'sell']) AS side) CROSS JOIN (SELECT unnest(range(10)) AS i)) GROUP BY ALL),
spans AS (SELECT source, segment, lo, CASE WHEN segment = max(segment) OVER () THEN hi ELSE hi - 600000000 END AS hi FROM fb),
bars AS (SELECT source, segment, unnest(range(lo, hi + 1, 600000000)) AS bar FROM spans),
lead0 AS (SELECT *, lead(bar) OVER (PARTITION BY source, segment, side, price ORDER BY bar) AS until FROM ev),
state AS (SELECT b.source, b.segment, b.bar, l.side, CAST(l.price AS DOUBLE) AS price, CAST(l.size AS DOUBLE) AS size FROM bars b JOIN lead0 l ON l.source = b.source AND l.segment = b.segment AND l.bar <= b.bar AND (l.until IS NULL OR l.until > b.bar) WHERE l.size > 0),
top AS (SELECT *, CAST(row_number() OVER (PARTITION BY source, segment, bar, side ORDER BY CASE WHEN side = 'buy' THEN -price ELSE price END) AS INTEGER) AS level FROM state)"""
BASE = f"WITH {ctes('m', 'chg', 'snap')},\n{SEGMENTED} "


def features_sql(levels: str = LEVELS) -> str:
    one = lambda side, what, i: f"max(CASE WHEN side = '{side}' AND level = {i} THEN {what} END)"
    cols = [f"round({one(side, what, i)}, 9) AS {name}_{label}_{i}" for i in range(1, N + 1) for side, name in (("buy", "bid"), ("sell", "ask")) for what, label in (("price", "px"), ("size", "sz"))]
    return f"""{BASE}, {levels}, t AS (SELECT source, segment, bar, {one('buy', 'price', 1)} AS bb, {one('sell', 'price', 1)} AS ba, {one('buy', 'size', 1)} AS bs, {one('sell', 'size', 1)} AS az,
        sum(CASE WHEN side = 'buy' THEN size END) AS bd, sum(CASE WHEN side = 'sell' THEN size END) AS ad, {', '.join(cols)} FROM top WHERE level <= {N} GROUP BY ALL)
        SELECT * EXCLUDE (bb, ba, bs, az, bd, ad), bb AS best_bid, ba AS best_ask, bs AS best_bid_size, az AS best_ask_size, (bb + ba) / 2 AS mid, ba - bb AS spread, round((ba * bs + bb * az) / (bs + az), 9) AS microprice,
        round(bd, 9) AS bid_depth_top10, round(ad, 9) AS ask_depth_top10, round((bd - ad) / (bd + ad), 9) AS imbalance_top10 FROM t WHERE bb IS NOT NULL AND ba IS NOT NULL"""


ORACLE = {
    "assign_segments": BASE + "SELECT source, segment, count(*) FILTER (NOT is_snapshot) AS updates, min(arrival) AS first, max(arrival) AS last FROM seg GROUP BY source, segment",
    "segment_lag": BASE + """, p AS (SELECT *, last_value(CASE WHEN NOT is_snapshot AND segment > 0 THEN us END IGNORE NULLS) OVER (PARTITION BY source ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_us FROM seg)
        SELECT source, segment, us AS start_us, CASE WHEN segment = 1 THEN 'initial_snapshot' ELSE 'resync_snapshot' END AS reason, greatest(0.0, coalesce((us - last_us) / 1e6, 0.0)) AS gap_from_previous_segment FROM p WHERE is_snapshot""",
    "assign_bars": BASE + "SELECT * FROM bar",
    "flag_bar_gaps": BASE + f""", l AS (SELECT *, lag(us) OVER w AS pu, lag(bar) OVER w AS pb FROM bar WINDOW w AS (PARTITION BY source, segment ORDER BY arrival)),
        g AS (SELECT source, segment, pb AS bar, max((us - pu) / 1e6) AS gap FROM l WHERE (us - pu) / 1e6 >= {THRESHOLD} GROUP BY ALL), b AS (SELECT source, segment, bar, count(*) AS updates FROM bar GROUP BY ALL), f AS (SELECT source, segment, arg_min(bar, arrival) AS fb FROM bar GROUP BY ALL)
        SELECT source, segment, b.bar, updates, CASE WHEN gap IS NULL THEN 0 ELSE 1 END AS gap_flag, coalesce(gap, 0.0) AS gap_seconds, CASE WHEN gap IS NOT NULL THEN 'gap_in_segment' WHEN b.bar = fb THEN 'segment_start' ELSE 'clean' END AS row_quality
        FROM b JOIN f USING (source, segment) LEFT JOIN g USING (source, segment, bar)""",
    "bar_activity": BASE + """, a AS (SELECT b.source, b.segment, b.bar, count(*) FILTER (side = 'buy') AS changed_buy, count(*) FILTER (side = 'sell') AS changed_sell, count(*) FILTER (side = 'buy' AND size <= 0) AS removed_buy, count(*) FILTER (side = 'sell' AND size <= 0) AS removed_sell,
        count(DISTINCT b.arrival) AS updates FROM bar b LEFT JOIN chg c ON c.source = b.source AND c.arrival = b.arrival AND c.parts >= 3 GROUP BY ALL) SELECT * FROM a""",
    "book_asof": f"{BASE}, {LEVELS} SELECT * FROM state",
    "book_top_n": f"{BASE}, {LEVELS} SELECT * FROM top WHERE level <= {N}",
    "book_features": features_sql(),
}
