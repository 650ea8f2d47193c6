"""Rows of a key that wait in its state, in order of arrival: as many as there are, with a few blocks of them in memory."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql.streaming import StatefulProcessorHandle

#: Rows that are sorted at once, and rows of a block: n rows that came in no order are merged from n / RUN blocks at a time.
RUN, BLOCK = 1 << 17, 1 << 12
FIRST, LAST = -(2**63), 2**63 - 1
IN_ORDER = [("arrival", "ascending"), ("_run", "ascending")]


class Waiting:
    """Map state of blocks, each sorted by arrival and kept as Arrow: the place of its first row and its number lead to its rows.

    Rows come in runs, which are sorted and cut into blocks, and leave in order, merged from the blocks that overlap. A
    row without an arrival is the last; of rows with one arrival, the one that came first is first.
    """

    def __init__(self, handle: StatefulProcessorHandle, schema: pa.Schema) -> None:
        self.blocks = handle.getMapState("waiting", "first long, block long", "rows binary")
        self.input, self.schema = schema, schema.append(pa.field("_run", pa.int64()))

    def add(self, parts: Iterator[pd.DataFrame]) -> int | None:
        """Takes the rows; the latest us among them."""
        self.next = max((k[1] for k in self.blocks.keys()), default=-1) + 1
        run, size, high = [], 0, []
        for part in parts:
            columns = [pa.array(part[f.name], f.type, from_pandas=True) for f in self.input]
            high += [] if (us := part["us"].dropna()).empty else [int(us.max())]
            high = [max(high)] if high else []
            run.append(pa.table([*columns, pa.array(np.full(len(part), self.next), pa.int64())], schema=self.schema))
            size += len(part)
            if size >= RUN:
                self._put(_sorted(run))
                run, size = [], 0
        if size:
            self._put(_sorted(run))
        return high[0] if high else None

    def taken(self, until: int | None = None) -> Iterator[pa.Table]:
        """Rows in order, in parts, up to the first whose us is greater than until, and out of the state; others stay."""
        keys = sorted((k[0], k[1]) for k in self.blocks.keys())
        self.next = max((k[1] for k in keys), default=-1) + 1
        rest, size, enough = [], 0, 0
        for i, key in enumerate(keys):
            with pa.ipc.open_stream(bytes(self.blocks.getValue(key)[0])) as rows:
                rest.append(rows.read_all())
            self.blocks.removeKey(key)
            size += len(rest[-1])
            if size < enough and i + 1 < len(keys):
                continue
            rows = _sorted(rest)
            at = _numbers(rows, "arrival", LAST)
            end = len(rows) if i + 1 == len(keys) else int(np.searchsorted(at, keys[i + 1][0]))
            young = np.flatnonzero(_numbers(rows, "us", FIRST)[:end] > until) if until is not None else ()
            if len(young):
                end = int(np.searchsorted(at, at[young[0]]))
            if end:
                yield rows.slice(0, end).drop_columns("_run")
            if len(young):
                self._put(rows.slice(end))
                return
            rest, size = [rows.slice(end).combine_chunks()], len(rows) - end
            enough = max(RUN, 2 * size)

    def _put(self, rows: pa.Table) -> None:
        for at in range(0, len(rows), BLOCK):
            block, sink = rows.slice(at, BLOCK), pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, self.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as out:
                out.write_table(block)
            self.blocks.updateValue((int(_numbers(block.slice(0, 1), "arrival", LAST)[0]), self.next), (sink.getvalue().to_pybytes(),))
            self.next += 1


def _sorted(parts: list[pa.Table]) -> pa.Table:
    rows = pa.concat_tables(parts).combine_chunks()
    return rows.take(pc.sort_indices(rows, sort_keys=IN_ORDER)).combine_chunks()


def _numbers(rows: pa.Table, name: str, null: int) -> np.ndarray:
    return rows[name].fill_null(null).to_numpy()
