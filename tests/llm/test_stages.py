"""Stages of the pipeline and the sharding query row by row against plain Python."""

import collections
import zlib

import pytest

import corpus_pipeline
from bookaudit.llm import mixing, quality, sharding
from tests.llm.test_llm import DOCS, LABELS, corpus, labelled, lower, shingles

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(4), DOCS).repartition(3, "n_chars").cache()


def rows_of(df):
    return collections.Counter(map(tuple, df.collect()))


def test_exact_stage(spark, docs):
    got, largest = rows_of(corpus_pipeline.exact(spark, docs, "")), {}
    rows = [r for r in docs.collect() if r["doc_id"] is not None]
    for r in rows:
        largest[lower(r["text"])] = max(largest.get(lower(r["text"]), -1), r["doc_id"])
    want = {(r["doc_id"], r["text"]) for r in rows if largest[lower(r["text"])] == r["doc_id"]}
    assert {(r[0], r[1]) for r in got if r[0] is not None} == want


def test_near_stage(spark, docs):
    """One document of each class of linked sets stays, the one with the smallest id, as it was."""
    one = docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    rows = {r["doc_id"]: r for r in one.collect()}
    sets, root = {i: shingles(r["text"]) for i, r in rows.items()}, {i: i for i in rows}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if a != b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) and root[b] < root[a]:
                    root[a], changed = root[b], True
    want = collections.Counter(tuple(rows[i]) for i in rows if root[i] == i)
    assert len(want) < len(rows)
    assert rows_of(corpus_pipeline.near(spark, one, "")) == want


def test_quality_and_mix_stages(spark, tmp_path):
    rows, labels = labelled(200)
    docs, labels = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    good = {r["doc_id"] for r in quality.quality_scores(docs, labels).where("score >= 0.5").collect()}
    assert rows_of(corpus_pipeline.quality(spark, docs, str(tmp_path))) == collections.Counter(tuple(r) for r in docs.collect() if r["doc_id"] in good)
    kept = {r["doc_id"] for r in mixing.mixed(docs).where("kept").collect()}
    assert rows_of(corpus_pipeline.mix(spark, docs, "")) == collections.Counter(tuple(r) for r in docs.collect() if r["doc_id"] in kept)


def test_sharding_query(spark, tmp_path):
    got = sharding.op10_sampled_splitters(spark, DATA)
    rows = got.collect()
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    assert all((r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(texts[r["doc_id"]]) + 1, zlib.crc32(texts[r["doc_id"]]), "bytes", None) for r in rows)
    size, slots = collections.Counter(), collections.defaultdict(list)
    for r in rows:
        size[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert set(size) <= set(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    mean, largest = sum(size.values()) / 16, max(r["size"] for r in rows)
    assert all(mean - largest <= size[k] <= mean + largest for k in range(16))


def test_written_shards(spark, docs, tmp_path):
    """Files of a shard hold its rows in slot order, and all rows come back."""
    sharded = sharding.shard_by_bytes(sharding.document_records(docs), ["text_crc32", "doc_id"], 4).cache()
    sharding.write_shards(sharded, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    columns = sorted(sharded.columns)
    assert rows_of(back.select(columns)) == rows_of(sharded.select(columns))
    for file in {r["f"] for r in back.selectExpr("_metadata.file_path AS f").collect()}:
        slots = [r["slot"] for r in spark.read.parquet(file).coalesce(1).collect()]
        assert slots == sorted(slots)
