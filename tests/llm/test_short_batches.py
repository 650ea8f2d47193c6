"""Batches of few words, words made to collide in polynomial hashes, and equal rows over many shards."""

import collections

import numpy as np
import pytest

from bookaudit.llm import near_dedup, packing
from bookaudit.llm.common import batch_bytes
from bookaudit.llm.words import keyed_hashes, word_bounds, word_hashes


@pytest.mark.parametrize("n", range(7))
def test_batches_of_few_words(spark, n):
    text = " ".join("abcdefg"[:n])
    docs = spark.createDataFrame([(1, text), (2, text), (3, None)], "doc_id long, text string").coalesce(1)
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in near_dedup.near_classes(docs).collect())
    size = 0 if not n else max(1, n - 4)
    assert got == [(1, size, 1), (2, size, 1 if n else 2), (3, 0, 3)]


def test_a_long_text_before_a_short_one(spark):
    docs = spark.createDataFrame([(1, "long text of words " * 70_000), (2, "x y z"), (3, "x y z")], "doc_id long, text string").coalesce(1)
    assert {r["doc_id"]: r["component_id"] for r in near_dedup.near_classes(docs).collect()} == {1: 1, 2: 2, 3: 2}


def test_words_of_equal_polynomial_hash_differ(spark):
    bits = [bin(i).count("1") % 2 for i in range(1024)]
    a, b = "".join("ab"[x] for x in bits), "".join("ba"[x] for x in bits)
    import pyarrow as pa

    data, offsets = batch_bytes(pa.array([f"{a} {b} {a.upper()}"]))
    starts, ends, _ = word_bounds(data, offsets)
    assert len(set(word_hashes(data, starts, ends).tolist())) == 1  # the weak ones meet
    h = keyed_hashes(data, starts, ends, b"k" * 16)
    assert h[0] == h[2] != h[1] and (h != keyed_hashes(data, starts, ends, b"l" * 16)).all()
    docs = spark.createDataFrame([(1, f"one two {a} four five"), (2, f"one two {b} four five")], "doc_id long, text string")
    assert {r["component_id"] for r in near_dedup.near_classes(docs).collect()} == {1, 2}


def test_packing_of_equal_rows(spark):
    """Equal rows over several shards: none is drawn with all of its copies or without any."""
    text = " ".join("some words of a text that is repeated".split() * 12)
    docs = spark.range(40_000).selectExpr("7L AS doc_id", f"'{text}' AS text").repartition(4)
    rows = packing.pack_documents(docs).groupBy("sequence_id").sum("length").collect()
    length = len(packing.text_tokenizer(packing.default_tokenizer())(text)) + 1
    assert 40_000 * length > packing.SHARD_TOKENS
    assert sum(r[1] for r in rows) == 40_000 * length
    sizes = collections.Counter(r[1] for r in rows)
    assert sizes[1024] >= len(rows) - 8 and max(sizes) == 1024
    assert np.isclose(sum(k * v for k, v in sizes.items()), 40_000 * length)
