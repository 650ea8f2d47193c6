"""The order book of a stream, bar by bar."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.scalars import SECOND
from ..operators.book import TOP, Book
from .waiting import Waiting
from .windows import CLOSE_MS, with_close


COLUMNS = ["source", "segment", "bar", "bids", "asks"]
LEVELS = {"sides": pa.string(), "prices": pa.float64(), "sizes": pa.float64()}
MESSAGES = pa.schema([("arrival", pa.int64()), ("us", pa.int64()), ("is_snapshot", pa.bool_()), *((c, pa.list_(t)) for c, t in LEVELS.items())])
#: Bars of a batch that comes out.
BARS = 1 << 12


class BookBars(StatefulProcessor):
    """One stream's book. State: its live levels, one map entry each, and its segment and open bar.

    A trigger's messages are put in order by their blocks in the state and worked on in parts, so that one of any size
    fits. It reads the levels once and writes back those it changed. A timer set for the close of the stream makes the open
    bar's row.
    """

    def __init__(self, bar_seconds: int, n: int) -> None:
        self.step, self.n = bar_seconds * SECOND, n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = Waiting(handle, MESSAGES)
        self.levels = handle.getMapState("levels", "side string, price double", "size double")
        self.open = handle.getValueState("open", "segment long, bar long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if key[0] is None:  # a mark that closes the stream
            return
        self.waiting.add(rows)
        segment, bar = self.open.get() if self.open.exists() else (0, None)
        book, out, changed, renewed = self._book(), [], {}, False
        for part in self.waiting.taken():
            for us, is_snapshot, levels in _messages(part):
                if is_snapshot:  # the open bar goes
                    segment, bar, changed, renewed = segment + 1, None, {}, True
                    book.clear()
                elif not segment:
                    continue
                elif us is not None:
                    at = us - us % self.step
                    while bar is not None and bar < at:
                        if top := book.top():
                            out.append((*key, segment, bar, *top))
                        bar += self.step
                        if len(out) >= BARS:
                            yield pd.DataFrame(out, columns=COLUMNS)
                            out = []
                    bar = at if bar is None else bar
                for side, price, size in levels:
                    book.set(side, price, size)
                    changed[side, price] = size
        if renewed:
            self.levels.clear()
        for level, size in changed.items():
            if size > 0:
                self.levels.updateValue(level, (size,))
            elif not renewed:
                self.levels.removeKey(level)
        self.open.update((segment, bar))
        self.handle.registerTimer(CLOSE_MS)
        yield pd.DataFrame(out, columns=COLUMNS)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        segment, bar = self.open.get()
        top = self._book().top() if bar is not None else None
        self.open.update((segment, None))
        yield pd.DataFrame([(*key, segment, bar, *top)] if top else [], columns=COLUMNS)

    def _book(self) -> Book:
        book = Book(self.n)
        for (side, price), (size,) in self.levels.iterator():
            book.set(side, price, size)
        return book

    def close(self) -> None:
        pass


def _messages(rows: pa.Table) -> Iterator[tuple[int | None, bool, list[tuple[str, float, float]]]]:
    """Time, whether it is a snapshot, and levels of each message."""
    lists = [rows[c].combine_chunks() for c in LEVELS]
    levels, counts = zip(*(x.flatten().to_pylist() for x in lists)), lists[0].value_lengths().fill_null(0).to_pylist()
    for us, is_snapshot, n in zip(rows["us"].to_pylist(), rows["is_snapshot"].to_pylist(), counts):
        yield us, is_snapshot, list(islice(levels, n))


def stream_book_bars(messages: DataFrame, bar_seconds: int = 1, n: int = 10) -> DataFrame:
    """(source, segment, bar, bids, asks) of each bar once it is closed by an update of a later bar.

    messages: source, arrival, us, is_snapshot, levels (side, price, size; a size of 0 removes). A late update falls in
    the open bar, as one without a time does; a snapshot begins a segment and drops the open bar; updates before the
    first snapshot are skipped; a bar without both sides has no row. The last bar of a stream comes when it is closed
    (see `windows.marked`). Needs the RocksDB state store.
    """
    level = lambda c: F.col(f"levels.{c}").alias(f"{c}s")
    rows = with_close(messages).select("source", "arrival", "us", "is_snapshot", level("side"), level("price"), level("size"), "closes").groupBy("source")
    return rows.transformWithStateInPandas(BookBars(bar_seconds, n), f"source string, segment long, bar long, {TOP}", "append", "eventTime")
