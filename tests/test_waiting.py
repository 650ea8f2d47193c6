"""Messages of a trigger of any size are put in order in parts, with a few blocks of them in memory."""

import random

import pandas as pd
import pytest

from bookaudit.streaming import book, stateful, waiting

from .test_streaming import capture_rows, walked


class States:
    """Stands for a processor's handle."""

    def __init__(self):
        self.values = {}

    def getValueState(self, name, schema):
        return Value()

    def getMapState(self, name, key, value):
        return self.values.setdefault(name, Map())

    def registerTimer(self, ms):
        pass


class Value:
    now = None

    def exists(self):
        return self.now is not None

    def get(self):
        return self.now

    def update(self, value):
        self.now = value


class Map(dict):
    def iterator(self):
        return iter(list(self.items()))

    def containsKey(self, key):
        return key in self

    def getValue(self, key):
        return self[key]

    updateValue, removeKey = dict.__setitem__, dict.__delitem__


@pytest.fixture(autouse=True)
def small(monkeypatch):
    monkeypatch.setattr(waiting, "RUN", 40)
    monkeypatch.setattr(waiting, "BLOCK", 7)


def messages(n, rng, repeats):
    rows = [("a" if i < n // 2 else "b", "update", i // repeats, 1000 * i, i, i, None) for i in range(n)]
    rows += [("b", "control", None, None, None, None, None)]
    return rng.sample(rows, len(rows))


def frames(rows, n):
    for i in range(0, len(rows), n):
        yield pd.DataFrame(rows[i : i + n], columns=["d", *stateful.INPUT])


@pytest.mark.parametrize("late", [0.0, 0.3, 10.0])
def test_messages_are_stepped_on_in_order_and_in_parts(late):
    """What is younger than late waits, over triggers, and comes at the close; no part holds all rows."""
    rng, seen = random.Random(6), []

    def step(part, state):
        seen.append(part)
        return part, (1, 1, 1)

    p = stateful.InOrder(step, "source string, d string, arrival long", stateful.GAP_STATE, late)
    p.init(States())
    rows = messages(2000, rng, 1)
    for cut in (rows[:900], rows[900:]):
        list(p.handleInputRows(("x",), frames(cut, 23), None))
    ready = [x for part in seen for x in part["us"].dropna()]
    assert all(us <= 1_999_000 - late * 1e6 for us in ready)
    list(p.handleExpiredTimer(("x",), None, None))
    assert sorted(x for part in seen for x in part["arrival"].dropna()) == list(range(2000)) and sum(map(len, seen)) == 2001
    assert max(map(len, seen)) < 1200
    assert p.waiting.blocks == {}
    if late == 10.0:
        assert [x for part in seen for x in part["arrival"].dropna()] == list(range(2000))


def test_equal_arrivals_keep_the_order_of_runs():
    w = waiting.Waiting(States(), stateful.WAITING)
    for run in range(5):
        w.add(frames([("a", "update", i // 9, None, run, None, None) for i in range(30)], 30))
    out = [(r["arrival"], r["first_id"]) for t in w.taken() for r in t.to_pylist()]
    assert out == sorted(out) and len(out) == 150


def test_book_bars_come_in_parts(monkeypatch):
    """Bars leave as they are made, as one list of the sorted messages makes them."""
    monkeypatch.setattr(book, "BARS", 5)
    rng, rows = random.Random(2), []
    for i in range(600):
        sides = ["buy", "sell"] if i % 200 == 0 else [rng.choice(["buy", "sell"])]
        rows.append((i, 700_000 * i, i % 200 == 0, sides, [99.0 - i % 3 if s == "buy" else 101.0 + i % 3 for s in sides], [1.0 + i % 5] * len(sides)))
    rows.append((600, None, False, None, None, None))
    columns = book.MESSAGES.names
    p = book.BookBars(1, 3)
    p.init(States())
    mixed = rng.sample(rows, len(rows))
    got = list(p.handleInputRows(("x",), iter([pd.DataFrame(mixed[i : i + 17], columns=columns) for i in range(0, len(mixed), 17)]), None))
    live, segment, bar, want = book.Book(3), 0, None, []
    for _, us, is_snapshot, *levels in rows:
        if is_snapshot:
            segment, bar = segment + 1, None
            live.clear()
        elif us is not None:
            at = us - us % 1_000_000
            while bar is not None and bar < at:
                want.append(("x", segment, bar, *(live.top() or ())))
                bar += 1_000_000
            bar = at if bar is None else bar
        for level in zip(*levels) if levels[0] else ():
            live.set(*level)
    assert [tuple(r) for part in got for r in part.itertuples(index=False)] == [w for w in want if len(w) == 5]
    assert len(got) > 10 and p.waiting.blocks == {}


def test_gaps_and_bridges_in_parts():
    """As message by message, whatever the parts."""
    rows = capture_rows()
    got = []
    for step, schema, state, end in ((stateful._gaps, stateful.GAPS, stateful.GAP_STATE, None), (stateful._bridges, stateful.BRIDGES, stateful.BRIDGE_STATE, stateful._unanswered)):
        p = stateful.InOrder(step, schema, state, 30.0, end)
        p.init(States())
        mixed = [(str(r[1]), *r[2:]) for r in random.Random(4).sample(rows, len(rows))]
        out = [*p.handleInputRows(("x",), frames(mixed, 11), None), *p.handleExpiredTimer(("x",), None, None)]
        got.append(sorted((tuple(None if pd.isna(v) else v for v in r) for part in out for r in part.astype(object).itertuples(index=False)), key=repr))
    want = [sorted(((r[0], str(r[1]), *r[2:]) for r in x), key=repr) for x in walked(rows)]
    assert got == want and all(want)
