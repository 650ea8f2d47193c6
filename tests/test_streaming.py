"""Streams cut over several triggers against the batch forms."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from bookaudit.operators import book as B
from bookaudit.operators import merging as G
from bookaudit.sources import capture
from bookaudit.streaming import stateful
from bookaudit.streaming import windows as W
from bookaudit.streaming.book import stream_book_bars

DAY = 86_400_000_000
MESSAGES = "source string, d date, msg string, arrival long, us long, first_id long, last_id long, snap_id long"


def streamed(spark, folder, rows, schema, parts):
    """The rows as a stream of `parts` files, one a trigger."""
    for i in range(parts):
        cut = rows[i * len(rows) // parts : (i + 1) * len(rows) // parts]
        spark.createDataFrame(cut, schema).coalesce(1).write.mode("append").parquet(str(folder))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))


def walked(rows):
    """Gaps and bridges, message by message."""
    gaps, bridges, at = [], [], {}

    def passed(source, d, s):
        if s["wait"]:
            bridges.append((source, d, s["segment"], s["snap"], "none"))

    for source, d, msg, arrival, us, first_id, last_id, snap_id in rows:
        s = at.setdefault((source, d), {"segment": 0, "last": None, "us": None, "snap": None, "wait": False})
        if msg == "snapshot":
            passed(source, d, s)
            s.update(segment=s["segment"] + 1, last=None, us=None, snap=snap_id, wait=True)
        elif msg == "update":
            if s["last"] is not None and first_id is not None and first_id != s["last"] + 1:
                gaps.append((source, d, s["segment"], arrival, s["last"], first_id, last_id, first_id - s["last"] - 1, s["us"], us))
            if last_id is not None:
                s.update(last=last_id, us=us)
            if s["wait"] and not (last_id is not None and s["snap"] is not None and last_id <= s["snap"]):
                holds = None not in (first_id, last_id, s["snap"]) and first_id <= s["snap"] + 1 <= last_id
                bridges.append((source, d, s["segment"], s["snap"], "ok" if holds else "gap"))
                s["wait"] = False
    for (source, d), s in at.items():
        passed(source, d, s)
    return gaps, bridges


def capture_rows():
    day, out, last = [pd.Timestamp("2024-05-01").date(), pd.Timestamp("2024-05-02").date()], [], 0
    for i in range(240):
        d = day[i >= 120]
        us = int(pd.Timestamp(d).value // 1000) + i * 1_000_000
        if i % 23 == 5:
            out.append(("x", d, "snapshot", i, us, None, None, None if i % 46 == 5 else last + i % 9))
        elif i % 17 == 3:
            out.append(("x", d, "control", i, us, None, None, None))
        else:
            first = last + 1 + (3 if i % 7 == 0 else 0)
            ids = (None, None) if i % 31 == 0 else (first, first + 2)
            last = ids[1] or last
            out.append(("x", d, "update", i, None if i % 29 == 0 else us, *ids, None))
    return out


def checked(spark, folder, rows, parts, late):
    """Gaps and bridges of the rows as a stream that is closed."""
    out = []
    for check in (stateful.stream_seq_gaps, stateful.stream_snapshot_bridge):
        stream, marks = W.marked(streamed(spark, folder / check.__name__, rows, MESSAGES, parts))
        with W.rocksdb(spark):
            out.append(sorted(map(tuple, W.drained(check(stream, late), "append", marks).collect()), key=repr))
    return out


@pytest.mark.parametrize("parts,shuffle", [(1, False), (5, False), (6, True)])
def test_gaps_and_bridges_over_triggers(spark, tmp_path, parts, shuffle):
    """The same as message by message, also where files come in any order."""
    rows = capture_rows()
    rows += [("y", rows[-1][1], "snapshot", 500, rows[-1][4], None, None, 10**6), ("y", rows[-1][1], "update", 501, rows[-1][4], 5, 6, None)]  # never answered
    gaps, bridges = walked(rows)
    assert gaps and {b[-1] for b in bridges} == {"ok", "gap", "none"}
    if shuffle:
        rows = random.Random(3).sample(rows, len(rows))
    got = checked(spark, tmp_path, rows, parts, late=200_000.0)
    assert got == [sorted(gaps, key=repr), sorted(bridges, key=repr)]


def test_what_waits_is_released_in_order(spark, tmp_path):
    """Without a close, what is younger than `late` waits; with a close it comes, and all is in order."""
    rows = [r for r in capture_rows() if r[4] is not None]
    gaps, _ = walked(rows)
    rows[5], rows[30] = rows[30], rows[5]  # 25 seconds apart
    stream, marks = W.marked(streamed(spark, tmp_path, rows, MESSAGES, 4))
    with W.rocksdb(spark):
        open_ = W.drained(stateful.stream_seq_gaps(stream, 40.0), "append").collect()
        closed = W.drained(stateful.stream_seq_gaps(stream, 40.0), "append", marks).collect()
    last = max(r[4] for r in rows) - 40_000_000
    assert sorted(map(tuple, closed), key=repr) == sorted(gaps, key=repr)
    assert sorted(map(tuple, open_), key=repr) == sorted((g for g in gaps if g[-1] <= last), key=repr)


def test_messages_further_behind_are_not_dropped(spark, tmp_path):
    d, later = pd.Timestamp("2024-05-01").date(), pd.Timestamp("2024-05-09").date()
    us = lambda day: int(pd.Timestamp(day).value // 1000)
    rows = [("x", d, "update", 1, us(d), 1, 3, None), ("x", later, "update", 3, us(later), 1, 3, None), ("x", later, "update", 4, us(later) + 1, 6, 6, None), ("x", d, "update", 2, us(d) + 1, 9, 9, None)]
    gaps, _ = checked(spark, tmp_path, rows, 4, late=60.0)
    assert [(g[1], g[7]) for g in gaps] == [(d, 5), (later, 2)]


@pytest.mark.parametrize("parts", [1, 3])
def test_merge_of_two_streams(spark, tmp_path, parts):
    """Repeated keys, keys of one side and of both, over triggers, as the batch merge has them."""
    rng = random.Random(8)
    rows = []
    for i in range(400):
        t = 60_000_000 * (i // 4) + DAY
        rows.append((rng.choice(("primary", "backup")), rng.choice("abc") + str(i // 4), rng.choice((None, "l2update")), t, i))
    schema = "side string, k string, type string, us long, arrival long"
    stream, marks = W.marked(streamed(spark, tmp_path, rows, schema, parts).withColumn("t", F.timestamp_micros("us")))
    got = W.drained(W.merged(stream, ["k"], "1 hour"), "append", marks).collect()
    table = spark.createDataFrame(rows, schema)
    want = G.merge_streams(table.where("side = 'primary'"), table.where("side = 'backup'"), ["k"]).collect()
    assert {r["source"] for r in want} == {"primary", "backup", "both"}
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_each_batch_has_a_folder(spark, tmp_path):
    """So a batch that is run again replaces its rows."""
    stream = streamed(spark, tmp_path / "in", [("a", i) for i in range(10)], "source string, n long", 5)
    out = W.drained(stream, "append")
    files = {f.split("/out/")[1].split("/")[0] for f in out.inputFiles()}
    assert files == {f"stream_batch={i}" for i in range(5)} and out.count() == 10 and out.columns == ["source", "n"]


@pytest.mark.parametrize("parts", [1, 4])
def test_book_bars_over_triggers(spark, tmp_path, parts):
    schema = "source string, arrival long, us long, is_snapshot boolean, levels array<struct<side: string, price: double, size: double>>"
    rows = []
    for i in range(200):
        us = 1_000_000 * (i // 3) - (2_000_000 if i % 19 == 0 else 0) + DAY
        if i in (4, 90, 150):
            rows.append(("x", i, us, True, [(s, 100.0 + (k if s == "sell" else -k - 1), 1.0 + k) for s in ("buy", "sell") for k in range(3)]))
        elif i % 13 == 0:
            rows.append(("x", i, us, False, None))
        else:
            side = "buy" if i % 2 else "sell"
            rows.append(("x", i, us, False, [(side, 100.0 + (i % 5 if side == "sell" else -(i % 5) - 1), 0.0 if i % 3 == 0 else float(i))]))
    stream, marks = W.marked(streamed(spark, tmp_path, rows, schema, parts))
    with W.rocksdb(spark):
        got = W.drained(stream_book_bars(stream, 1, 2), "append", marks).collect()
    table = spark.createDataFrame(rows, schema)
    assigned = B.assign_segments(table.where("NOT is_snapshot"), table.where("is_snapshot"))
    barred = B.assign_bars(assigned, 1)
    changes = table.where("NOT is_snapshot").selectExpr("source", "arrival", "posexplode(levels) AS (pos, x)").select("source", "arrival", "pos", "x.*")
    start = assigned.where("is_snapshot").select("source", "segment", "arrival").join(table, ["source", "arrival"]).selectExpr("source", "segment", "explode(levels) AS x").select("source", "segment", "x.*")
    bars = B.emitted_bars(barred, 1)
    want = B.replay_book(B.level_events(barred, changes, start), bars, 1, 2, chunk_bars=7).collect()
    assert len(want) > 40 and sorted(map(repr, got)) == sorted(map(repr, want))


def test_capture_lines_arrive_with_their_path(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"a": 1}\n{"a": 2}\n')
    (tmp_path / "b.part").write_text("open\n")
    got = W.drained(W.stream_capture(spark, str(tmp_path), "*.jsonl", 1), "append").collect()
    assert sorted(r["value"] for r in got) == ['{"a": 1}', '{"a": 2}'] and all(r["path"].endswith("/a.jsonl") for r in got)


@pytest.mark.parametrize("split", ["64", "100m"])
def test_lines_are_numbered_over_triggers_and_splits(spark, tmp_path, split):
    """A file's splits are read by several tasks, and a trigger takes some of the files."""
    folder, want = tmp_path / "raw_done" / "binance" / "BTC", set()
    folder.mkdir(parents=True)
    for f in range(5):
        lines = [f"file {f} line {i} " + "x" * (i * 7 % 50) for i in range(1, 41)]
        (folder / f"{f}.jsonl").write_text("\n".join(lines) + "\n")
        want |= {("binance", "BTC", f"{f}.jsonl", i, x) for i, x in enumerate(lines, 1)}
    with W._setting(spark, "spark.sql.files.maxPartitionBytes", split), W._setting(spark, "spark.sql.files.openCostInBytes", "0"):
        stream = W.stream_capture(spark, str(folder), "*.jsonl", 2)
        got = W.drained(stream, "append", each=capture.number_lines).collect()
        batch = capture.read_capture(spark, str(folder)).collect()
    for rows in (got, batch):
        assert len(rows) == len(want) and {(r["source"], r["symbol"], r["path"].rsplit("/", 1)[1], r["line"], r["value"]) for r in rows} == want
