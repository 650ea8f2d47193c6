"""Mixing decides on rows, whatever their ids, and rakes many cells as it rakes few."""

import collections

import numpy as np

from bookaudit.llm import mixing

DOCS = "doc_id long, text string, lang string, source string"


def test_rows_of_one_id_have_their_own_fate(spark):
    rows = [(None if i % 2 else 7, f"text number{i} some words", "en", "s") for i in range(400)]
    docs = spark.createDataFrame([*rows, rows[0]], DOCS)
    want = collections.Counter((r["doc_id"], r["kept"]) for r in mixing.mixed(docs).collect())
    left = mixing.keep_mixed(docs)
    got = left.collect()
    assert left.columns == docs.columns
    assert {i: n for (i, kept), n in want.items() if kept} == collections.Counter(r["doc_id"] for r in got)
    assert 250 < len(got) < 350 and not collections.Counter(map(tuple, got)) - collections.Counter([*rows, rows[0]])


def test_many_cells_are_raked_like_few(spark):
    """Sparse cells, whose margins take more than 20 rounds to agree."""
    rng = np.random.default_rng(3)
    docs = []
    for i in range(240):
        lang = f"l{min(i // 40 + int(rng.integers(0, 2)), 5)}"
        docs.append((i, " ".join(["word", "extended"[: int(rng.integers(3, 9))]] * int(rng.integers(1, 300))), lang, f"s{i // 4}"))
    docs = spark.createDataFrame(docs, DOCS)
    few = {r["doc_id"]: r for r in mixing.mixed(docs, temper=0.2).collect()}
    many = {r["doc_id"]: r for r in mixing.mixed(docs, temper=0.2, small_cells=0).collect()}
    assert few.keys() == many.keys()
    for i, r in few.items():
        assert abs(many[i]["probability"] - r["probability"]) < 1e-6 and abs(many[i]["weight"] - r["weight"]) < 1e-6 * r["weight"] and many[i]["kept"] == r["kept"]


def test_topics_are_the_nearest_centers_and_their_plan_stays_short(spark):
    """A plan with a term a number of each centre has 14 times this length, and the driver keeps many copies of it."""
    rng = np.random.default_rng(4)
    centers = rng.standard_normal((mixing.TOPICS, mixing.DIMENSIONS)) / 6
    centers[6] = centers[2]
    vectors = rng.standard_normal((500, mixing.DIMENSIONS)).astype(np.float32)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    rows = [(i, None if i % 9 == 0 else v.tolist()) for i, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "i long, vector array<float>").repartition(3)
    got = {r["i"]: r["t"] for r in frame.select("i", mixing.nearest_center(centers)("vector").alias("t")).collect()}
    far = ((vectors[:, None].astype(float) - centers) ** 2).sum(2)
    want = [-1 if i % 9 == 0 else 6 if k == 2 else k for i, k in enumerate(far.argmin(1).tolist())]
    assert [got[i] for i in range(len(rows))] == want and 6 in want
    docs = spark.createDataFrame([(i, f"words{i % 5} of text{i % 7}", "en", "s") for i in range(60)], DOCS)
    assert len(mixing.keep_mixed(docs)._jdf.queryExecution().toString()) < 20_000
