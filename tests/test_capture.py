"""Merged streams, features and hashes on disk."""

import csv
import gzip
import hashlib
import io
import json

import pytest

from pyspark.sql import functions as F

from bookaudit.sources import capture


def test_files_and_rows_are_in_order(spark, tmp_path):
    """Names and columns mixed in the order; nulls come first."""
    rows = [(None if i % 10 == 0 else i * 7 % 100, i) for i in range(200)]
    df = spark.createDataFrame(rows, "us long, arrival long").repartition(5)
    capture.write_stream(df, ["us", -F.col("arrival")], str(tmp_path / "out"), partitions=4)
    files = sorted((tmp_path / "out").glob("part-*.gz"))
    assert len(files) > 1
    got = [json.loads(line) for f in files for line in gzip.open(f, "rt")]
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, -r[1]))
    assert [(r.get("us"), r["arrival"]) for r in got] == want


def test_partitions_are_in_order_and_written_once(spark, tmp_path):
    rows = [(s, d, None if i % 50 == 0 else i * 7 % 100, i) for s in ("a", "b") for d in ("2024-01-01", "2024-01-02") for i in range(200)]
    df = spark.createDataFrame(rows, "source string, d string, us long, arrival long").repartition(5)
    path = str(tmp_path / "out")
    for batch in (df, df.where("source = 'a'"), df.where("source = 'a'")):  # the second and third replace a's folders only
        capture.write_partitions(batch, ["us", "arrival"], path, partitions=9)
    manifest = capture.partition_manifest(spark, path, ["us", "arrival"]).orderBy("source", "d", "place").collect()
    assert len(manifest) > 4 and sum(m["rows"] for m in manifest) == len(rows)
    key = lambda at: (at[0] is not None, at[0] or 0, at[1])
    for source, d in {r[:2] for r in rows}:
        files = [m for m in manifest if m["source"] == source and str(m["d"]) == d]
        assert [m["path"] for m in files] == sorted(m["path"] for m in files)
        got = [(r["us"], r["arrival"]) for m in files for r in spark.read.parquet(m["path"]).collect()]
        assert got == sorted((r[2:] for r in rows if r[:2] == (source, d)), key=key)
        for one, following in zip(files, files[1:]):
            assert key(one["last"]) < key(following["first"])


def test_features_keep_their_columns_and_order(spark, tmp_path):
    df = spark.createDataFrame([(1.5, i * 37 % 50, 2.0, 0.25) for i in range(50)], "mid double, bar long, ask_px_2 double, best_bid double")
    capture.write_features(df, str(tmp_path / "out"), n=2, partitions=4)
    files = sorted((tmp_path / "out").glob("part-*.csv"))
    tables = [list(csv.reader(open(f))) for f in files]
    assert len(files) > 1 and all(t[0] == ["bar", "best_bid", "mid", "ask_px_2"] for t in tables)
    rows = [dict(zip(t[0], r)) for t in tables for r in t[1:]]
    assert [int(r["bar"]) for r in rows] == list(range(50))
    assert {(r["mid"], r["ask_px_2"], r["best_bid"]) for r in rows} == {("1.5", "2.0", "0.25")}
    with pytest.raises(ValueError, match="extra"):
        capture.write_features(df.withColumn("extra", F.lit(1)), str(tmp_path / "no"))


def test_files_of_any_size_and_scheme_are_hashed(spark, tmp_path):
    want = {}
    for name, size in {"small.bin": 10, "empty.bin": 0, "a large one.bin": 3_000_000}.items():
        data = bytes(i * 31 % 251 for i in range(size))
        (tmp_path / name).write_bytes(data)
        want[name] = (size, hashlib.sha256(data).hexdigest())
    for whole in (1 << 26, 100, -1):  # all whole, one in blocks, all in blocks
        got = capture.file_catalog(spark, f"{tmp_path}/*.bin", "raw:x", whole=whole).collect()
        assert {r["path"].rsplit("/", 1)[1]: (r["bytes"], r["sha256"]) for r in got} == {k: v for k, v in want.items() if v[0]} and all(r["mtime_utc"] for r in got)
    paths = spark.createDataFrame([(p,) for f in want for p in (f"{tmp_path}/{f}", f"file:{tmp_path}/{f}", f"file://{tmp_path}/{f}")], "path string")
    for r in capture.hash_files(paths, block=1000).collect():
        assert r["sha256"] == want[r["path"].rsplit("/", 1)[1]][1]
    own = lambda path: io.BytesIO(path.encode())
    assert capture.hash_files(spark.createDataFrame([("shop://bucket/x",)], "path string"), opened=own).first()["sha256"] == hashlib.sha256(b"shop://bucket/x").hexdigest()
    with pytest.raises(Exception, match="shop"):
        capture.hash_files(spark.createDataFrame([("shop://bucket/x",)], "path string")).collect()
