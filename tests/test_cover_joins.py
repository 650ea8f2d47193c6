"""Covers are many rows in a small file: no plan may broadcast them."""

import pytest

import __spark_entry__ as entry
from bookaudit.functions import intervals
from bookaudit.operators import patching as P


def joins_of_covers(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Join" in line and "_node" in line]


def test_covers_are_not_broadcast(spark):
    """Nor where they are small by the size of their file."""
    gaps = spark.createDataFrame([(1, 10 * i, 10 * i + 5) for i in range(100)], "d int, missing_from long, missing_to long")
    backup = spark.createDataFrame([(1, 10 * i + 2, 10 * i + 3, i, i) for i in range(100)], "d int, first_id long, last_id long, arrival long, us long")
    found = P.gap_candidates(gaps, backup, ["d"])
    joins = joins_of_covers(found)
    assert joins and all("SortMergeJoin" in x for x in joins)
    assert found.count() == 100


def test_ends_of_runs_are_not_broadcast(spark):
    """A row a gap at least."""
    rows = [(1, 10 * i, 10 * i + 5, 10 * i, 10 * i + 5, i, i) for i in range(100)]
    found = P.chain_cover(spark.createDataFrame(rows, "d int, missing_from long, missing_to long, first_id long, last_id long, arrival long, us long"), ["d"])
    joins = [line for line in found._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in line and "_slice" in line]
    assert joins and all("SortMergeJoin" in x for x in joins)
    assert found.where("kept").count() == 100


def test_verdicts_of_gaps_are_not_broadcast(spark):
    """A row a gap, in the chains and in the reports."""
    rows = [(1, 10 * i, 10 * i + 5, 10 * i, 10 * i + 5, i, i) for i in range(100)]
    chained = P.chain_cover(spark.createDataFrame(rows, "d int, missing_from long, missing_to long, first_id long, last_id long, arrival long, us long"), ["d"])
    gaps = spark.createDataFrame([(1, 10 * i, 10 * i + 5, i, i) for i in range(101)], "d int, missing_from long, missing_to long, prev_us long, next_us long")
    reports = P.gap_reports(gaps, chained, ["d"])
    assert sum(r["complete"] for r in reports.collect()) == 100
    joins = [line for line in reports._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in line]  # as it ran
    assert joins and all("SortMergeJoin" in x for x in joins)


@pytest.mark.parametrize("name,covers", [("patch_stats", 1), ("id_patch_report", 1), ("time_patch_report", 0)])
def test_chains_are_worked_out_once(spark, monkeypatch, name, covers):
    """And not at all for a report by time."""
    made = []
    staged = intervals.staged
    monkeypatch.setattr(intervals, "staged", lambda df, what: made.append(what) or staged(df, what))
    entry.queries()[name](spark, "/root/testdata/sf0.001")
    assert made == ["cover"] * covers
