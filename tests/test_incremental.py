"""Grades of files that come one by one against the grade of the whole day."""

import pytest
from pyspark.sql import functions as F

from bookaudit.operators import incremental as I
from bookaudit.operators import quality as Q
from tests.test_report import SCHEMA, messages


@pytest.fixture(scope="module")
def captured(spark):
    """Two streams in files of 50 messages (times go back and forth over their borders), one of a single file, one without updates."""
    rows = [*messages("binance", 1), *messages("binance_backup", 2), *messages("coinbase", 3, 30)]
    rows.append(("coinbase_backup", rows[0][1], "x", 1, "control", 0, None, None, None, None, "close", 1))
    return spark.createDataFrame(rows, SCHEMA).withColumn("file", F.floor(F.col("arrival") / 50)).cache()


def as_set(df):
    return {tuple(r) for r in df.collect()}


@pytest.mark.parametrize("size", [1, 3, 50, 1000])
def test_merged_files_equal_the_day(spark, captured, size):
    files = captured.withColumn("file", F.floor(F.col("arrival") / size))
    assert as_set(I.merge_partials(I.file_partials(files, 2.0), 2.0)) == as_set(Q.grade_capture(captured, 2.0))


def test_a_new_file_is_all_that_is_read(spark, captured, tmp_path):
    store = str(tmp_path / "store")
    listed = captured.select("source", "d", "file").distinct()
    assert I.new_files(listed, store).count() == listed.count()
    first = captured.where("file NOT IN (2, 5)")
    assert as_set(I.add_files(first, store)) == as_set(Q.grade_capture(first))
    assert {r["file"] for r in I.new_files(listed, store).collect()} == {2, 5}
    late = captured.where("file = 5")  # the later of both files comes first
    assert as_set(I.add_files(late, store)) == as_set(Q.grade_capture(captured.where("file <> 2 AND source LIKE 'binance%'")))
    for _ in range(2):  # a run that is tried again changes nothing
        I.add_files(captured.where("file = 2"), store)
    assert I.new_files(listed, store).count() == 0
    assert as_set(I.stored_grades(captured, store)) == as_set(Q.grade_capture(captured))
    assert as_set(I.stored_grades(captured, store, 10.0)) == as_set(Q.grade_capture(captured, 10.0))
    with pytest.raises(Exception, match="larger threshold"):
        I.stored_grades(captured, store, 1.0).collect()


def test_empty_messages(spark, captured, tmp_path):
    assert I.add_files(captured.where("false"), str(tmp_path / "none")).count() == 0
