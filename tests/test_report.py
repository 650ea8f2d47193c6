"""The nested report against one sequential walk over each stream's messages."""

import datetime
import json
import random

from bookaudit.operators import report

DAY = datetime.date(2024, 1, 1)
START = 1_704_067_200_000_000
SCHEMA = "source string, d date, path string, line long, msg string, arrival long, us long, first_id long, last_id long, snap_id long, ctl string, bytes long"
STEPS = [0.5, 2, 10]


def messages(source, seed, n=400):
    rng, rows, u, us = random.Random(seed), [], 0, START
    for a in range(n):
        us += rng.choice([100_000, 100_000, 600_000, 2_500_000, 11_000_000, -300_000])
        kind = rng.choices(["update", "snapshot", "control", "subscription", "other"], [80, 6, 6, 4, 4])[0]
        path, line = f"{source}_{a // 150}", a % 150 + 1
        first = last = snap = ctl = None
        if kind == "update":
            first = u + 1 + rng.choice([0] * 8 + [4, -1])
            last = u = first + rng.randint(0, 2)
            first = None if rng.random() < 0.04 else first
            last = None if rng.random() < 0.04 else last
        if kind == "snapshot":
            snap = None if rng.random() < 0.1 else u + rng.randint(-2, 2)
        if kind == "control":
            ctl = rng.choice(["connect", "close", None])
        rows.append((source, DAY, path, line, kind, a, None if rng.random() < 0.05 else us, first, last, snap, ctl, 10 + a % 7))
    return rows


def iso(us):
    if us is None:
        return None
    t = datetime.datetime(1970, 1, 1) + datetime.timedelta(microseconds=us)
    return t.isoformat() + "Z"


def walked(source, rows, threshold=2.0, examples=20):
    ids = source.startswith("binance")
    names = {"update": "updates", "snapshot": "snapshots", "control": "control_events", "json_error": "json_errors", "subscription": "subscriptions"}
    totals = dict.fromkeys(report.TOTALS, 0)
    files, controls, segments, jumps, segment, seen = {}, {}, [], [], None, None
    for _, _, path, line, kind, _, us, first, last, snap, ctl, size in rows:
        file = files.setdefault(path, {"path": path, "bytes": 0, **dict.fromkeys(report.TOTALS[:5], 0), "time_first": None, "time_last": None})
        for one in (file, totals):
            one["lines"] += 1
            one["bytes"] += size
            if names.get(kind) in one:
                one[names[kind]] += 1
        if kind == "control":
            controls[ctl or "unknown"] = controls.get(ctl or "unknown", 0) + 1
        if kind == "snapshot":
            segment, seen = {"snapshot_file": path, "snapshot_line": line, "snapshot_time": iso(us), "snapshot_id": snap, "updates": 0, "bridges_snapshot": None, "sequence_gaps": 0}, None
            segments.append(segment)
        if kind != "update":
            continue
        if us is not None:
            file["time_first"], file["time_last"] = file["time_first"] or iso(us), iso(us)
        if segment and first is not None and last is not None:
            segment["updates"] += 1
            if segment["bridges_snapshot"] is None:
                segment["bridges_snapshot"] = snap_id_ok(segment["snapshot_id"], first, last)
        if seen and first is not None and first != seen[0] + 1:
            jumps.append({"prev_u": seen[0], "next_U": first, "next_u": last, "missing": first - seen[0] - 1, "time": iso(us), "previous_time": iso(seen[1]), "file": path, "line": line})
            if segment:
                segment["sequence_gaps"] += 1
        if last is not None:
            seen = (last, us)
    times = [r[6] for r in rows if r[4] == "update" and r[6] is not None]
    ordered = sorted(times)
    gaps = [(b - a, a, b) for a, b in zip(ordered, ordered[1:])]
    over = [g for g in gaps if g[0] >= threshold * 1e6]
    level = lambda s: [g[0] for g in gaps if g[0] >= s * 1e6]
    bad = [s for s in segments if s["bridges_snapshot"] is False or s["sequence_gaps"]] if ids else []
    status = "REJECT_CORRUPT_JSON" if totals["json_errors"] else "NO_UPDATES" if not totals["updates"] else "CAPTURE_GAP_UNRESOLVED" if ids and jumps else "DIAGNOSTIC_ONLY" if bad else "SEGMENTED" if over else "OK"
    return {
        "files": [files[p] for p in sorted(files)], "totals": totals, "controls": controls, "time_first": iso(min(times, default=None)), "time_last": iso(max(times, default=None)),
        "temporal_gaps": {
            "thresholds": {f"{s:g}": {"count": len(level(s)), "total_seconds": sum(level(s)) / 1e6, "max_seconds": max(level(s), default=0) / 1e6} for s in STEPS},
            "examples_ge_2s": [{"seconds": g / 1e6, "from": iso(a), "to": iso(b)} for g, a, b in over[:examples]], "nonmonotone": sum(b - a < -1000 for a, b in zip(times, times[1:])),
        },
        "sequence_gaps": {"count": len(jumps), "examples": jumps[:examples]} if ids else None, "segments": segments if ids else None, "bad_segments": bad, "status": status,
    }


def snap_id_ok(snap, first, last):
    return snap is not None and first <= snap + 1 <= last


def test_report_equals_a_walk(spark):
    streams = {"binance": messages("binance", 1), "binance_backup": messages("binance_backup", 2, 60), "coinbase": messages("coinbase", 3)}
    streams["binance_idle"] = [("binance_idle", DAY, "f", 1, "control", 0, START, None, None, None, "connect", 5)]
    streams["coinbase_broken"] = [("coinbase_broken", DAY, "f", 1, "json_error", 0, None, None, None, None, None, 5), ("coinbase_broken", DAY, "f", 2, "update", 1, START, None, None, None, None, 5)]
    rows = [r for s in streams.values() for r in s]
    random.Random(5).shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA)
    (got,) = report.quality_report(report.source_reports(df, steps=STEPS)).collect()
    document = json.loads(got["value"])
    assert document["date"] == "2024-01-01" and list(document["sources"]) == sorted(streams) and document["status_rules"] == report.STATUS_RULES
    for source, s in streams.items():
        assert document["sources"][source] == walked(source, s), source
    assert len(document["sources"]["binance"]["sequence_gaps"]["examples"]) == 20  # the walk's count is larger
    assert document["sources"]["binance_idle"]["status"] == "NO_UPDATES" and document["sources"]["binance_idle"]["segments"] == []


def test_empty_capture_has_no_reports(spark):
    assert report.quality_report(report.source_reports(spark.createDataFrame([], SCHEMA))).collect() == []
