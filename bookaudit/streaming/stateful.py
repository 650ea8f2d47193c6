"""Stateful checks of a stream of capture messages: running sequence gaps and snapshot bridges.

Files may come in any order. Messages of a source wait in its state until the latest event time seen is `late` beyond
theirs, and are released in the order of arrival, so what comes out equals the batch forms as long as no message is
further behind than that. One that is isn't dropped: it is taken when it comes. State: the messages of the last
`late` of each source, in blocks (see `waiting`), and a few numbers a day; messages are read, held and released in parts,
so that a trigger of any size fits. A stream that is closed (see `windows.marked`) releases what waits and
answers what is open, by a timer set for that time. Needs the RocksDB state store.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from .waiting import Waiting
from .windows import CLOSE_MS, with_close

INPUT = ["msg", "arrival", "us", "first_id", "last_id", "snap_id"]
WAITING = pa.schema([("d", pa.string()), ("msg", pa.string()), *((c, pa.int64()) for c in INPUT[1:])])
GAPS = "source string, d string, segment long, arrival long, prev_last_id long, first_id long, last_id long, missing long, prev_us long, us long"
GAP_STATE = "segment long, last_id long, us long"
BRIDGES = "source string, d string, segment long, snap_id long, bridge_status string"
BRIDGE_STATE = "segment long, snap_id long, open boolean"
LATE = 600.0


def _plain(values) -> tuple:
    return tuple(None if v is None or v is pd.NA else int(v) for v in values)


def _segmented(rows: pd.DataFrame, segment: int) -> pd.DataFrame:
    """Snapshots and updates, each with its segment: the snapshots so far."""
    rows = rows.loc[rows["msg"].isin(["snapshot", "update"]), INPUT].reset_index(drop=True)
    return rows.assign(segment=segment + (rows["msg"] == "snapshot").cumsum())


class InOrder(StatefulProcessor):
    """Runs step on a source's messages in the order of arrival, a day at a time; end makes the last rows of a day."""

    def __init__(self, step: Callable, schema: str, state: str, late: float, end: Callable | None = None) -> None:
        self.step, self.state, self.late, self.end = step, state, round(late * 1e6), end
        self.names = [c.split()[0] for c in schema.split(", ")]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = Waiting(handle, WAITING)
        self.high = handle.getValueState("high", "us long")
        self.days = handle.getMapState("days", "d string", self.state)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if key[0] is None:  # a mark that closes the stream
            return
        seen = [self.high.get()[0]] if self.high.exists() else []
        latest = self.waiting.add(rows)
        seen += [] if latest is None else [latest]
        if seen:
            self.high.update((max(seen),))
        self.handle.registerTimer(CLOSE_MS)
        for ready in self.waiting.taken(max(seen) - self.late if seen else None):
            yield from self._stepped(key, ready)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        for rest in self.waiting.taken():
            yield from self._stepped(key, rest)
        if self.end is not None:
            for (d,), state in list(self.days.iterator()):
                found, after = self.end(tuple(state))
                self.days.updateValue((d,), after)
                yield found.assign(source=key[0], d=d)[self.names]

    def close(self) -> None:
        pass

    def _stepped(self, key: tuple, rows: pa.Table) -> Iterator[pd.DataFrame]:
        for d, part in rows.to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get).groupby("d", sort=True):
            state = tuple(self.days.getValue((d,))) if self.days.containsKey((d,)) else None
            found, after = self.step(part, state)
            self.days.updateValue((d,), after)
            yield found.assign(source=key[0], d=d)[self.names]


def _gaps(messages: pd.DataFrame, state: tuple | None) -> tuple[pd.DataFrame, tuple]:
    segment, last, last_us = state or (0, None, None)
    rows = _segmented(messages, segment)
    carried = pd.DataFrame({"segment": [segment], "last_id": [last], "us": [last_us]}).astype("Int64")
    updates = pd.concat([carried, rows[rows["msg"] == "update"]], ignore_index=True)
    # The place of the last update with an id, up to each row and before it, in its segment.
    seen = pd.Series(updates.index, dtype="Int64").where(updates["last_id"].notna()).groupby(updates["segment"]).ffill()
    before = seen.groupby(updates["segment"]).shift()
    now, prior = updates[before.notna()].reset_index(drop=True), updates.loc[before.dropna()].reset_index(drop=True)
    now = now.assign(prev_last_id=prior["last_id"], prev_us=prior["us"], missing=now["first_id"] - prior["last_id"] - 1)
    end = rows["segment"].iloc[-1] if len(rows) else segment
    latest = seen[updates["segment"] == end].dropna()
    after = updates.loc[latest.iloc[-1], ["last_id", "us"]] if len(latest) else (None, None)
    return now[(now["missing"] != 0).fillna(False).astype(bool)], _plain([end, *after])


def stream_seq_gaps(messages: DataFrame, late: float = LATE) -> DataFrame:
    """Updates whose first id doesn't follow the last one seen, restarted at each snapshot. late: seconds."""
    return _run(messages, InOrder(_gaps, GAPS, GAP_STATE, late), GAPS)


def _bridges(messages: pd.DataFrame, state: tuple | None) -> tuple[pd.DataFrame, tuple]:
    segment, snap, waiting = state or (0, None, False)
    rows = _segmented(messages, segment)
    begun = rows.loc[rows["msg"] == "snapshot", ["segment", "snap_id"]]
    if waiting:
        begun = pd.concat([pd.DataFrame({"segment": [segment], "snap_id": [snap]}).astype("Int64"), begun])
    updates = rows[rows["msg"] == "update"].drop(columns="snap_id").merge(begun, on="segment").sort_values("arrival", kind="stable")
    stale = (updates["last_id"] <= updates["snap_id"]).fillna(False).astype(bool)
    first = updates[~stale].drop_duplicates("segment")
    holds = ((first["first_id"] <= first["snap_id"] + 1) & (first["snap_id"] + 1 <= first["last_id"])).fillna(False).astype(bool)
    first = first.assign(bridge_status=holds.map({True: "ok", False: "gap"}))[["segment", "snap_id", "bridge_status"]]
    if len(begun):
        segment, snap = _plain(begun.iloc[-1])
        waiting = segment not in set(first["segment"])
        passed = begun[~begun["segment"].isin([*first["segment"], segment])]
        first = pd.concat([first, passed.assign(bridge_status="none")], ignore_index=True)
    return first, (segment, snap, waiting)


def _unanswered(state: tuple) -> tuple[pd.DataFrame, tuple]:
    segment, snap, waiting = state
    rows = [(segment, snap, "none")] if waiting else []
    return pd.DataFrame(rows, columns=["segment", "snap_id", "bridge_status"]).astype({"segment": "Int64", "snap_id": "Int64"}), (segment, snap, False)


def stream_snapshot_bridge(messages: DataFrame, late: float = LATE) -> DataFrame:
    """For each snapshot, as soon as an update that isn't stale comes: whether it holds the snapshot's id + 1 (ok or gap).

    none: the next snapshot came before one, or the stream was closed. late: seconds.
    """
    return _run(messages, InOrder(_bridges, BRIDGES, BRIDGE_STATE, late, _unanswered), BRIDGES)


def _run(messages: DataFrame, processor: InOrder, schema: str) -> DataFrame:
    rows = with_close(messages).select("source", F.col("d").cast("string").alias("d"), *INPUT, "closes")
    out = rows.groupBy("source").transformWithStateInPandas(processor, schema, "append", "eventTime")
    return out.withColumn("d", F.col("d").cast("date"))
