"""Order books: segments, bars, states and features. State crosses midnight: keys are streams, not days.

Updates: arrival, us. Changes: arrival, us, pos, side, price, size. Snapshots: arrival, us (receive time).
"""

from __future__ import annotations

from bisect import bisect_left, insort

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.intervals import cover, over
from ..functions.scalars import SECOND, seconds
from ..functions.sliced import ARRIVALS, previous, running_max, running_sum
from ..functions.staging import staged

STREAM = ["source"]


def assign_segments(updates: DataFrame, snapshots: DataFrame, keys: list[str] = STREAM, width: int = ARRIVALS) -> DataFrame:
    """Updates and snapshots with their segment (0: before the first snapshot, to be skipped)."""
    rows = updates.select(*keys, "arrival", "us", F.lit(False).alias("is_snapshot")).unionByName(snapshots.select(*keys, "arrival", "us", F.lit(True).alias("is_snapshot")))
    return running_sum(rows, keys, "arrival", F.col("is_snapshot").cast("long"), "segment", width)


def segment_starts(assigned: DataFrame, keys: list[str] = STREAM, width: int = ARRIVALS) -> DataFrame:
    """Per snapshot: start, reason, and seconds since the last update of the book before it (0 at least)."""
    seen = F.when(~F.col("is_snapshot") & (F.col("segment") > 0), F.col("us"))
    rows = previous(assigned, keys, "arrival", seen, "last_us", width).where("is_snapshot")
    lag = F.greatest(F.lit(0.0), F.coalesce(seconds(F.col("us") - F.col("last_us")), F.lit(0.0)))
    reason = F.when(F.col("segment") == 1, "initial_snapshot").otherwise("resync_snapshot")
    return rows.select(*keys, "segment", F.col("us").alias("start_us"), reason.alias("reason"), lag.alias("gap_from_previous_segment"))


def assign_bars(assigned: DataFrame, bar_seconds: int = 1, keys: list[str] = STREAM, width: int = ARRIVALS) -> DataFrame:
    """Updates of the book with their bar (micros): the largest bar of the segment so far, so late updates fall in the open one."""
    rows = assigned.where("NOT is_snapshot AND segment > 0").drop("is_snapshot")
    floor = F.col("us") - F.pmod(F.col("us"), F.lit(bar_seconds * SECOND))
    return running_max(rows, [*keys, "segment"], "arrival", floor, "bar", width)


def flag_bar_gaps(barred: DataFrame, threshold: float = 2.0, keys: list[str] = STREAM, width: int = ARRIVALS) -> DataFrame:
    """Bars with updates: a gap of `threshold` seconds to the previous update marks the bar before it."""
    segment = [*keys, "segment"]
    rows = previous(barred, segment, "arrival", F.struct("us", "bar"), "_prev", width)
    diff = seconds(F.col("us") - F.col("_prev.us"))
    gaps = rows.where(diff >= threshold).groupBy(*segment, F.col("_prev.bar").alias("bar")).agg(F.max(diff).alias("gap_seconds"))
    bars = barred.groupBy(*segment, "bar").agg(F.count("*").alias("updates")).join(gaps, [*segment, "bar"], "left")
    first = barred.groupBy(*segment).agg(F.min_by("bar", "arrival").alias("_first"))
    quality = F.when(F.col("gap_seconds").isNotNull(), "gap_in_segment").when(F.col("bar") == F.col("_first"), "segment_start").otherwise("clean")
    out = bars.join(first, segment)
    return out.select(*segment, "bar", "updates", F.col("gap_seconds").isNotNull().cast("int").alias("gap_flag"), F.coalesce("gap_seconds", F.lit(0.0)).alias("gap_seconds"), quality.alias("row_quality"))


def bar_activity(barred: DataFrame, changes: DataFrame, keys: list[str] = STREAM) -> DataFrame:
    """Per bar: messages, changed and removed levels by side."""
    segment = [*keys, "segment", "bar"]
    rows = barred.select(*segment, "arrival").join(changes.select(*keys, "arrival", "side", "size"), [*keys, "arrival"], "left")
    n = lambda side, gone=False: F.count_if((F.col("side") == side) & ((F.col("size") <= 0) if gone else F.lit(True)))
    out = rows.groupBy(*segment).agg(n("buy").alias("changed_buy"), n("sell").alias("changed_sell"), n("buy", True).alias("removed_buy"), n("sell", True).alias("removed_sell"))
    return out.join(barred.groupBy(*segment).agg(F.count("*").alias("updates")), segment)


def level_events(barred: DataFrame, changes: DataFrame, snapshot_levels: DataFrame, keys: list[str] = STREAM) -> DataFrame:
    """(keys, segment, bar, side, price, size): the last size of each level in each bar; a snapshot belongs to its segment's first bar.

    snapshot_levels: keys, segment, side, price, size.
    """
    segment = [*keys, "segment"]
    live = barred.select(*segment, "bar", "arrival").join(changes, [*keys, "arrival"]).select(*segment, "bar", "side", "price", "size", "arrival", "pos")
    first = barred.groupBy(*segment).agg(F.min_by("bar", "arrival").alias("bar"))
    start = snapshot_levels.join(first, segment).select(*segment, "bar", "side", "price", "size", F.lit(-1).cast("long").alias("arrival"), F.lit(0).alias("pos"))
    return live.unionByName(start).groupBy(*segment, "bar", "side", "price").agg(F.max_by("size", F.struct("arrival", "pos")).alias("size"))


def emitted_bars(barred: DataFrame, bar_seconds: int, keys: list[str] = STREAM) -> DataFrame:
    """(keys, segment, lo, hi) of the bars that get a row: all from first to last, but for the open bar at a resync."""
    spans = barred.groupBy(*keys, "segment").agg(F.min("bar").alias("lo"), F.max("bar").alias("hi"))
    last = F.max("segment").over(Window.partitionBy(*keys))  # one row a segment
    return spans.withColumn("_last", last).withColumn("hi", F.when(F.col("segment") == F.col("_last"), F.col("hi")).otherwise(F.col("hi") - bar_seconds * SECOND)).where("lo <= hi").drop("_last")


def chunk_seeds(events: DataFrame, bars: DataFrame, chunk_us: int, keys: list[str] = STREAM) -> tuple[DataFrame, DataFrame]:
    """Level events by chunk of time, and the live levels each later chunk starts from.

    A level that last changed in chunk a and next changes in chunk b seeds a + 1 .. b.
    """
    segment = [*keys, "segment"]
    chunk = lambda c: F.floor(F.col(c) / F.lit(chunk_us))
    placed = events.withColumn("chunk", chunk("bar"))
    ends = placed.groupBy(*segment, "side", "price", "chunk").agg(F.max_by("size", "bar").alias("size"))
    w = Window.partitionBy(*segment, "side", "price").orderBy("chunk")
    until = ends.withColumn("_next", F.lead("chunk").over(w)).join(bars.select(*segment, chunk("hi").alias("_end")), segment)
    until = until.withColumn("_to", F.least(F.coalesce("_next", "_end"), "_end")).where("size > 0 AND _to > chunk")
    seeds = until.select(*segment, F.explode(F.sequence(F.col("chunk") + 1, F.col("_to"))).alias("chunk"), "side", "price", "size")
    return placed, seeds


def book_asof(events: DataFrame, bars: DataFrame, bar_seconds: int, chunk_bars: int = 1800, keys: list[str] = STREAM) -> DataFrame:
    """(keys, segment, bar, side, price, size) of every live level at the end of every emitted bar.

    Each chunk holds its seeds and its own changes; a size lasts until the level's next change in the chunk.
    """
    segment, step = [*keys, "segment"], bar_seconds * SECOND
    placed, seeds = chunk_seeds(events, bars, chunk_bars * step, keys)
    start = seeds.withColumn("bar", F.col("chunk") * (chunk_bars * step))
    rows = placed.select(*segment, "chunk", "bar", "side", "price", "size").withColumn("_own", F.lit(1)).unionByName(start.select(*segment, "chunk", "bar", "side", "price", "size").withColumn("_own", F.lit(0)))
    w = Window.partitionBy(*segment, "chunk", "side", "price").orderBy("bar", "_own")
    rows = rows.withColumn("_until", F.coalesce(F.lead("bar").over(w), (F.col("chunk") + 1) * (chunk_bars * step)) - step)
    rows = rows.join(bars, segment).withColumn("_from", F.greatest("bar", "lo")).withColumn("_to", F.least("_until", "hi")).where("size > 0 AND _from <= _to")
    # Chunk borders needn't be bars.
    first = F.ceil((F.col("_from") - F.col("lo")) / F.lit(step)) * step + F.col("lo")
    rows = rows.withColumn("_from", first).where("_from <= _to")
    return rows.select(*segment, F.explode(F.sequence("_from", "_to", F.lit(step))).alias("bar"), "side", "price", "size")


def book_top_n(levels: DataFrame, n: int = 10, keys: list[str] = STREAM) -> DataFrame:
    """The n best levels of each side of each bar."""
    best = F.when(F.col("side") == "buy", -F.col("price")).otherwise(F.col("price"))
    w = Window.partitionBy(*keys, "segment", "bar", "side").orderBy(best)
    return levels.withColumn("level", F.row_number().over(w)).where(F.col("level") <= n)


class Book:
    """Live levels of both sides by price. Prices are kept sorted (bids negated), so that the best come first."""

    def __init__(self, n: int) -> None:
        self.n = n
        self.clear()

    def clear(self) -> None:
        self.prices: dict[str, list[float]] = {"buy": [], "sell": []}
        self.sizes: dict[str, dict[float, float]] = {"buy": {}, "sell": {}}
        self.best: dict[str, list | None] = {"buy": None, "sell": None}

    def set(self, side: str, price: float, size: float) -> None:
        """A size of 0 or less removes the level."""
        prices, sizes, place = self.prices[side], self.sizes[side], -price if side == "buy" else price
        if size > 0:
            if place not in sizes:
                insort(prices, place)
            sizes[place] = size
        elif sizes.pop(place, None) is not None:
            del prices[bisect_left(prices, place)]
        self.best[side] = None

    def top(self) -> tuple[list, list] | None:
        """The best n bids and asks; None while a side is empty."""
        if not (self.prices["buy"] and self.prices["sell"]):
            return None
        for side, sign in (("buy", -1), ("sell", 1)):
            if self.best[side] is None:
                self.best[side] = [{"px": sign * p, "sz": self.sizes[side][p]} for p in self.prices[side][: self.n]]
        return self.best["buy"], self.best["sell"]


TOP = "bids array<struct<px: double, sz: double>>, asks array<struct<px: double, sz: double>>"


def _best(n: int):
    """Of (place, px, sz) structs in a column: the n best by place, as (px, sz)."""
    return lambda c: F.transform(F.slice(F.array_sort(c), 1, n), lambda x: F.struct(x["px"].alias("px"), x["sz"].alias("sz")))


def _by_chunk(events: DataFrame, bars: DataFrame, n: int, chunk_bars: int, keys: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What each chunk of bars needs to know its best levels: own sizes, sizes that hold for a whole chunk, and the worst place of use.

    A level with changes in a chunk brings its size at the chunk's start. Between two chunks with changes a level keeps
    its size; such a stretch is held by the nodes of its binary cover (see functions.intervals), so one that lasts for
    weeks costs some tens of rows. All levels of a node live through all of its chunks, so only its n best are kept. Levels
    that live through a whole chunk give it a bound: what is behind the n-th of them is never among the n best there.
    """
    level = [*keys, "segment", "side", "price"]
    at = [*keys, "segment", "side", "chunk"]
    placed = events.withColumn("chunk", F.floor(F.col("b") / F.lit(chunk_bars)))
    ends = placed.groupBy(*level, "chunk").agg(F.max_by("size", "b").alias("size"), F.min("size").alias("least"))
    w = Window.partitionBy(*level).orderBy("chunk")
    ends = ends.withColumns({"before": F.lag("size").over(w), "next": F.lead("chunk").over(w)}).join(bars.select(*keys, "segment", F.floor(F.col("hi") / F.lit(chunk_bars)).alias("last")), [*keys, "segment"])
    place = F.when(F.col("side") == "buy", -F.col("price")).otherwise(F.col("price"))
    ends = staged(ends.withColumn("place", place).where("chunk <= last"), "book-ends")
    own = placed.select(*at, "price", "b", "size", F.lit(1).alias("order")).unionByName(ends.where("before > 0").select(*at, "price", (F.col("chunk") * chunk_bars).cast("long").alias("b"), F.col("before").alias("size"), F.lit(0).alias("order")))

    until = F.coalesce(F.col("next") - 1, F.col("last"))
    quiet = ends.where("size > 0").withColumn("until", until).where("until > chunk")
    nodes = quiet.select(*[c for c in at if c != "chunk"], "place", "price", "size", F.inline(cover(F.col("chunk") + 1, F.col("until"), 40)))
    best = Window.partitionBy(*keys, "segment", "side", "level", "node").orderBy("place")
    nodes = staged(nodes.withColumn("r", F.row_number().over(best)).where(F.col("r") <= n), "book-nodes")
    used = nodes.groupBy(*keys, "segment").agg(F.collect_set("level").alias("levels"))  # at most one a level of the tree
    span = bars.select(*keys, "segment", F.explode(F.sequence(F.floor(F.col("lo") / F.lit(chunk_bars)), F.floor(F.col("hi") / F.lit(chunk_bars)))).alias("chunk"))
    under = span.join(used, [*keys, "segment"]).select(*keys, "segment", "chunk", F.explode("levels").alias("level")).withColumn("node", over(F.col("chunk"), F.col("level")))
    whole = under.join(nodes, [*keys, "segment", "level", "node"]).select(*at, "place", "price", "size")
    whole = staged(whole, "book-whole")

    through = whole.select(*at, "place").unionByName(ends.where("before > 0 AND least > 0").select(*at, "place"))
    # At most n of a chunk and side are gathered: the window leaves no more.
    nth = through.withColumn("r", F.row_number().over(Window.partitionBy(*at).orderBy("place"))).where(F.col("r") == n).select(*at, F.col("place").alias("bound"))
    return own, whole, nth


def replay_book(events: DataFrame, bars: DataFrame, bar_seconds: int, n: int = 10, chunk_bars: int = 64, keys: list[str] = STREAM) -> DataFrame:
    """(keys, segment, bar, bids, asks): the n best levels of both sides at the end of each emitted bar; none while a side is empty.

    The best levels are worked out where one of them may change, and hold until the next such bar of the chunk. All
    bars are multiples of bar_seconds, as assign_bars has them.
    """
    step = bar_seconds * SECOND
    number = lambda c: (F.col(c) / F.lit(step)).cast("long")
    events = events.withColumn("b", number("bar")).drop("bar")
    bars = bars.withColumns({"lo": number("lo"), "hi": number("hi")})
    chunk, group = [*keys, "segment", "chunk"], [*keys, "segment", "chunk", "side"]
    own, whole, nth = _by_chunk(events, bars, n, chunk_bars, keys)
    place = F.when(F.col("side") == "buy", -F.col("price")).otherwise(F.col("price"))
    near = own.withColumn("place", place).join(nth, group, "left").where("place <= coalesce(bound, place)")
    w = Window.partitionBy(*group, "price").orderBy("b", "order")
    end = (F.col("chunk") + 1) * chunk_bars
    near = near.withColumn("until", F.coalesce(F.lead("b").over(w), end))

    # Bars where a level begins or ends, and the first of each chunk.
    spans = bars.select(*keys, "segment", "lo", "hi", F.explode(F.sequence(F.floor(F.col("lo") / F.lit(chunk_bars)), F.floor(F.col("hi") / F.lit(chunk_bars)))).alias("chunk"))
    spans = spans.select(*chunk, F.greatest("lo", F.col("chunk") * chunk_bars).alias("begin"), F.least("hi", F.col("chunk") * chunk_bars + chunk_bars - 1).alias("end"))
    size = F.struct("side", "place", "price", "size", "b", "until")
    items = near.where("b < until").select(*chunk, size.alias("x")).unionByName(whole.select(*chunk, F.struct("side", "place", "price", "size", (F.col("chunk") * chunk_bars).cast("long").alias("b"), end.alias("until")).alias("x")))
    found = near.groupBy(*chunk).agg(F.collect_set("b").alias("at"))  # at most a chunk's bars
    points = spans.join(found, chunk, "left").withColumn("at", F.filter(F.coalesce("at", F.array().cast("array<bigint>")), lambda b: (b > F.col("begin")) & (b <= F.col("end"))))
    points = points.withColumn("at", F.array_sort(F.concat(F.array("begin"), "at")))
    stops = F.transform("at", lambda b, i: F.struct(b.alias("b"), F.coalesce(F.get("at", i + 1), F.col("end") + 1).alias("stop")))
    points = points.select(*chunk, F.explode(stops).alias("p")).select(*chunk, "p.b", "p.stop")

    live = points.join(items, chunk).where("x.size > 0 AND x.b <= b AND b < x.until")
    one = F.struct(F.col("x.place").alias("place"), F.col("x.price").alias("px"), F.col("x.size").alias("sz"))
    side = lambda s: F.collect_list(F.when(F.col("x.side") == s, one))
    tops = live.groupBy(*chunk, "b", "stop").agg(side("buy").alias("bids"), side("sell").alias("asks")).where("size(bids) > 0 AND size(asks) > 0")
    tops = tops.withColumns({"bids": _best(n)(F.col("bids")), "asks": _best(n)(F.col("asks"))})
    return tops.select(*keys, "segment", F.explode(F.transform(F.sequence(F.col("b"), F.col("stop") - 1), lambda b: b * step)).alias("bar"), "bids", "asks")


def book_features(top: DataFrame, n: int = 10) -> DataFrame:
    """Mid, spread, microprice, depth, imbalance and n levels a side (null: no such level); top: bids and asks, best first."""
    px = lambda side, i: F.get(side, F.lit(i))["px"]
    sz = lambda side, i: F.get(side, F.lit(i))["sz"]
    depth = lambda side: F.aggregate(side, F.lit(0.0), lambda a, x: a + x["sz"])
    bid, ask, bid_sz, ask_sz = px("bids", 0), px("asks", 0), sz("bids", 0), sz("asks", 0)
    rows = top.where("size(bids) > 0 AND size(asks) > 0")
    bd, ad = depth("bids"), depth("asks")
    ratio = lambda a, b: F.when(b != 0, a / b)
    levels = {f"{name}_{what}_{i + 1}": get(side, i) for i in range(n) for side, name in (("bids", "bid"), ("asks", "ask")) for what, get in (("px", px), ("sz", sz))}
    return rows.withColumns(
        {
            "best_bid": bid, "best_ask": ask, "best_bid_size": bid_sz, "best_ask_size": ask_sz, "mid": (bid + ask) / 2, "spread": ask - bid,
            "microprice": ratio(ask * bid_sz + bid * ask_sz, bid_sz + ask_sz), f"bid_depth_top{n}": bd, f"ask_depth_top{n}": ad, f"imbalance_top{n}": ratio(bd - ad, bd + ad), **levels,
        }
    ).drop("bids", "asks")
