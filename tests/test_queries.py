"""Registered queries of the library against their SQL at the smallest size."""

import duckdb
import pytest
from pyspark.sql import Row

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
NAMES = ["grade_capture", "regrade_files", "quality_report", "file_totals", "gap_stats", "segment_summary", "snapshot_bridge", "chain_cover", "merge_order_by_id", "interleave_patches", "merge_streams", "flag_bar_gaps", "book_features", "build_alerts", "parse_capture", "read_trades", "read_capture", "stream_capture", "file_catalog", "write_stream", "partition_manifest", "read_audit", "stream_sessions", "payload_hash", "patch_decisions", "run_summary", "summary_lines", "stream_book_bars", "stream_seq_gaps", "in_gap"]


def plain(v):
    if isinstance(v, Row):
        return tuple(plain(x) for x in v)
    if isinstance(v, float):
        return round(v, 9)
    return v


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    con.sql(f"CREATE VIEW events AS SELECT * FROM '{DATA}/events.parquet'")
    return con


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, sql, name):
    got, want = entry.queries()[name](spark, DATA), sql.sql(entry.oracle_sql()[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    rows = sorted(repr([plain(r[c]) for c in columns]) for r in got.collect())
    at = [want.columns.index(c) for c in columns]
    assert rows == sorted(repr([plain(r[i]) for i in at]) for r in want.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() == 60
