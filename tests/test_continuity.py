"""Sliced windows and gap rules against plain sequential versions."""

import datetime
import gzip
import random

import pytest
from pyspark.sql import functions as F

from bookaudit.functions import sliced
from bookaudit.operators import book, continuity, patching
from bookaudit.sources import capture

DAY = datetime.date(2024, 1, 1)
SCHEMA = "source string, d date, msg string, arrival long, us long, first_id long, last_id long, snap_id long"


def stream(seed, n=300):
    rng, rows, u = random.Random(seed), [], 0
    for a in range(n):
        if rng.random() < 0.05:
            rows.append(("binance", DAY, "snapshot", a, a * 1000, None, None, u + rng.randint(-2, 2)))
            continue
        lo = u + 1 + rng.choice([0, 0, 0, 0, 3, -1])
        u = lo + rng.randint(0, 2)
        rows.append(("binance", DAY, "update", a, a * 1000, lo if rng.random() > 0.05 else None, u if rng.random() > 0.05 else None, None))
    return rows


def plain_gaps(rows):
    out, prev = [], None
    for _, _, msg, a, _, lo, hi, _ in rows:
        if msg == "snapshot":
            prev = None
            continue
        if prev is not None and lo is not None and lo != prev + 1:
            out.append((a, prev, lo, lo - prev - 1))
        if hi is not None:
            prev = hi
    return out


@pytest.mark.parametrize("width", [7, 50, 10_000])
def test_gaps_by_arrival_dont_depend_on_slices(spark, width):
    rows = stream(width)
    got = continuity.seq_gaps_arrival(spark.createDataFrame(rows, SCHEMA), width=width).orderBy("arrival").select("arrival", "prev_last_id", "first_id", "missing").collect()
    assert [tuple(r) for r in got] == plain_gaps(rows)


@pytest.mark.parametrize("width", [5, 1000])
def test_gaps_by_id(spark, width):
    rows = [r for r in stream(3) if r[2] == "update"]
    prev, want = None, []
    for lo, hi, _ in sorted((r[5], r[6], r[3]) for r in rows if r[5] is not None and r[6] is not None):
        if prev is not None and lo != prev + 1:
            want.append((prev + 1, lo - 1))
        prev = hi
    got = continuity.seq_gaps_by_id(spark.createDataFrame(rows, SCHEMA), width=width).select("missing_from", "missing_to").collect()
    assert sorted(tuple(r) for r in got) == sorted(want)


@pytest.mark.parametrize("width", [3, 1000])
def test_running_values(spark, width):
    rng = random.Random(1)
    rows = [("a", i, rng.randint(0, 99) if rng.random() > 0.2 else None) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, o long, v long")
    top = {r["o"]: r["m"] for r in sliced.running_max(df, ["k"], "o", F.col("v"), "m", width).collect()}
    total = {r["o"]: r["m"] for r in sliced.running_sum(df, ["k"], "o", F.col("v"), "m", width).collect()}
    best, added = None, 0
    for _, o, v in rows:
        best = v if best is None else best if v is None else max(best, v)
        added += v or 0
        assert top[o] == best and total[o] == added


def test_empty_and_null_streams(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert continuity.seq_gaps_arrival(empty).count() == 0 and continuity.segment_summary(empty).count() == 0
    nulls = spark.createDataFrame([(None, None, "update", 1, None, None, None, None), (None, None, "update", 2, 5, 1, 1, None)], SCHEMA)
    assert continuity.seq_gaps_arrival(nulls).count() == 0 and continuity.time_gaps_sorted(nulls).count() == 0


def cover(gap, backup):
    """A plain version of the all-or-nothing run."""
    expected, kept = gap[0], []
    for lo, hi in sorted(b for b in backup if not (b[1] < gap[0] or b[0] > gap[1])):
        if lo != expected:
            return None
        kept.append((lo, hi))
        expected = hi + 1
        if expected > gap[1]:
            break
    return kept if expected > gap[1] else None


@pytest.mark.parametrize("width", [2, 1000])
def test_chains(spark, width):
    rng = random.Random(5)
    gaps = sorted({(a, a + rng.randint(-3, 8)) for a in rng.sample(range(10, 400), 40)})
    backup = sorted({(a, a + rng.randint(0, 2)) for a in rng.choices(range(400), k=260)})
    g = spark.createDataFrame([(DAY, a, b, 0, 0) for a, b in gaps], "d date, missing_from long, missing_to long, prev_us long, next_us long")
    b = spark.createDataFrame([(DAY, lo, hi, i, i) for i, (lo, hi) in enumerate(backup)], "d date, first_id long, last_id long, arrival long, us long")
    chained = patching.chain_cover(patching.gap_candidates(g, b, ["d"], width), ["d"])
    got = {(r["missing_from"], r["missing_to"]): (r["complete"], r["patch_records"]) for r in patching.gap_reports(g, chained, ["d"]).collect()}
    for gap in gaps:
        kept = cover(gap, backup)
        assert got[gap] == (kept is not None, len(kept or [])), gap


@pytest.mark.parametrize("width", [4, 1000])
def test_interleave(spark, width):
    rng = random.Random(2)
    primary = [(DAY, i, rng.randint(0, 100)) for i in range(60)]
    patches = [(DAY, 1000 + i, rng.randint(0, 110)) for i in range(20)]
    want, left = [], sorted((us, a) for _, a, us in patches)
    for _, a, us in primary:
        while left and left[0][0] <= us:
            want.append(left.pop(0)[1])
        want.append(a)
    want += [a for _, a in left]
    schema = "d date, arrival long, us long"
    mixed = patching.interleave_patches(spark.createDataFrame(primary, schema), spark.createDataFrame(patches, schema), ["d"], width)
    got = mixed.orderBy(F.col("_at").asc_nulls_first(), "_own", "_seq").collect()
    assert [r["arrival"] for r in got] == want


@pytest.mark.parametrize("chunk_bars", [2, 5, 1000])
def test_book_replay(spark, chunk_bars):
    """Replay from chunk seeds equals one pass over the changes."""
    rng, s = random.Random(9), 1_000_000
    changes = []
    for a in range(120):
        us = a * 700_000 + rng.randint(-900_000, 0)
        for pos in range(rng.randint(1, 3)):
            side = rng.choice(["buy", "sell"])
            price = float(100 - rng.randint(0, 6) if side == "buy" else 101 + rng.randint(0, 6))
            changes.append(("c", a + 1, max(us, 0), pos, side, price, float(rng.choice([0, 1, 2, 3]))))
    updates = spark.createDataFrame(sorted({(c[0], c[1], c[2]) for c in changes}), "source string, arrival long, us long")
    snaps = spark.createDataFrame([("c", 0, 0)], "source string, arrival long, us long")
    levels = spark.createDataFrame([("c", 1, "buy", 99.0, 5.0), ("c", 1, "sell", 102.0, 5.0)], "source string, segment long, side string, price double, size double")
    barred = book.assign_bars(book.assign_segments(updates, snaps), 1)
    bars = book.emitted_bars(barred, 1)
    events = book.level_events(barred, spark.createDataFrame(changes, "source string, arrival long, us long, pos int, side string, price double, size double"), levels)
    got = {r["bar"]: ([tuple(x) for x in r["bids"]], [tuple(x) for x in r["asks"]]) for r in book.replay_book(events, bars, 1, 3, chunk_bars).collect()}
    flat = {}
    for r in book.book_top_n(book.book_asof(events, bars, 1, chunk_bars), 3).orderBy("level").collect():
        flat.setdefault(r["bar"], {"buy": [], "sell": []})[r["side"]].append((r["price"], r["size"]))
    state, want, open_bar = {"buy": {99.0: 5.0}, "sell": {102.0: 5.0}}, {}, None

    def emit(bar):
        if state["buy"] and state["sell"]:
            want[bar] = (sorted(state["buy"].items(), reverse=True)[:3], sorted(state["sell"].items())[:3])

    for a in sorted({c[1] for c in changes}):
        mine = [c for c in changes if c[1] == a]
        bar = mine[0][2] // s * s
        open_bar = bar if open_bar is None else open_bar
        while bar > open_bar:
            emit(open_bar)
            open_bar += s
        for _, _, _, _, side, price, size in mine:
            if size > 0:
                state[side][price] = size
            else:
                state[side].pop(price, None)
    emit(open_bar)
    assert got == want
    assert {b: (v["buy"], v["sell"]) for b, v in flat.items() if v["buy"] and v["sell"]} == want


def test_raw_lines(spark, tmp_path):
    folder = tmp_path / "raw_done" / "binance" / "BTCUSDT"
    folder.mkdir(parents=True)
    good = '{"recv_time":"2026-01-01T00:00:00.12Z","recv_ns":1,"exchange":"binance","symbol":"BTCUSDT","kind":"ws_depth_update","data":{"e":"depthUpdate","E":1767225600100,"U":11,"u":13,"b":[["100.0","1.5"]],"a":[]}}'
    lines = [good, "", '{"a":1} x', "[1]", "5", '{"a":', good + good, '{"data":{"U":1}}']
    with gzip.open(folder / "binance_BTCUSDT_2026-01-01_00-12.jsonl.gz", "wt") as f:
        f.write("\n".join(lines) + "\n")
    read = capture.read_capture(spark, str(folder))
    rows = capture.parse_capture(read).orderBy("line").collect()
    assert [r["line"] for r in rows] == list(range(1, 9))
    assert [r["json_error"] for r in rows] == [False, True, True, True, True, True, True, False]
    assert (rows[0]["source"], rows[0]["symbol"], rows[0]["first_id"], rows[0]["last_id"], rows[0]["e_type"], rows[0]["event_ms"]) == ("binance", "BTCUSDT", 11, 13, "depthUpdate", 1767225600100)
    out = str(tmp_path / "merged")
    capture.write_stream(read.select("line", "value"), [F.col("line")], out, 2)
    assert spark.read.text(out).count() == 8
    catalog = capture.file_catalog(spark, f"{folder}/*.gz", "raw:binance").collect()
    assert capture.hash_files(spark.createDataFrame([(str(folder / "binance_BTCUSDT_2026-01-01_00-12.jsonl.gz"),)], "path string")).first()["sha256"] == catalog[0]["sha256"]


def test_reports(spark, tmp_path):
    (tmp_path / "quality_2024-01-01.json").write_text('{"date": "2024-01-01"}')
    (tmp_path / "quality_2024-01-02.json").write_text("{broken")
    rows = {r["path"][-15:-5]: r["corrupt"] for r in capture.read_audit(spark, f"{tmp_path}/quality_*.json").collect()}
    assert rows == {"2024-01-01": False, "2024-01-02": True}
    capture.write_features(spark.createDataFrame([(1, 2.0)], "bar long, mid double"), str(tmp_path / "features"))
    assert spark.read.option("header", True).csv(str(tmp_path / "features")).columns == ["bar", "mid"]
