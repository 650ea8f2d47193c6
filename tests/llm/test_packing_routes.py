"""Neighbours meet wherever they lie, and a window's seed asks on."""

import random

import numpy as np

from bookaudit.llm import packing


def subject_docs(subjects, each, seed=5):
    """Texts of random subjects' own words among common ones; a subject's texts lie far apart."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(3))
    common, own = [word() for _ in range(300)], [[word() for _ in range(25)] for _ in range(subjects)]
    return [(i, " ".join(rng.choice(own[i % subjects] if rng.random() < 0.4 else common) for _ in range(90))) for i in range(subjects * each)]


def test_neighbours_of_other_files_share_windows(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_TOKENS", 20_000)
    subjects = 40
    docs = spark.createDataFrame(subject_docs(subjects, 30), "doc_id long, text string").repartition(6, "doc_id")
    pieces = packing.pack_documents(docs).select("doc_id", "length", "sequence_id").collect()
    windows = {}
    for p in pieces:
        windows.setdefault(p["sequence_id"], []).append(p["doc_id"] % subjects)
    same = [w.count(w[0]) / len(w) for w in windows.values() if len(w) > 2]
    assert {p["doc_id"] for p in pieces} == set(range(subjects * 30))
    assert np.mean(same) > 0.6


def test_asks_again_when_the_list_runs_out(monkeypatch):
    """Short documents: more fill a window than one list holds. The seed's kind comes first, then the others."""
    monkeypatch.setattr(packing, "NEIGHBOURS", 4)
    docs = [np.array([10 + i % 2, 100 + i, 0], "<u2") for i in range(200)]
    idf = np.full(packing.VOCABULARY, 1.0)
    idf[0] = 1e-9
    order = [p[0] % 2 for p in packing.Packer(0, idf, 3.0).pack(docs)]
    assert order == [0] * 100 + [1] * 100
