"""Fill-in-the-middle against plain string slices, and round trips."""

import hashlib
import random

import numpy as np

from bookaudit.llm import fill_middle as M


def plain(doc_id, text, seed="1"):
    text = text or ""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(text) + 1), h[1] % (len(text) + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(text), "plain", None, None, text
    if h[3] % 100 < 20:
        return len(text), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(text), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def texts():
    rng = random.Random(3)
    letters = ["a", "b", " ", "\n", "é", "ß", "中", "文", "😀", "𝄞", "<", "P", ">", "S", "M", "\x00", "́"]
    some = ["".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(300)]
    return [None, "", "x", "😀", "a<P>b", "<M>", "<P", "<S", "ends <", *some, "aé中😀" * 400_000, "a" * 1_500_000, "é" + "a" * 1_100_000 + "é"]


def test_against_slices(spark):
    rows = [(i if i % 17 else None, i, t) for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id long, row long, text string").coalesce(2)
    got = {r["row"]: r["o"] for r in M.fill_in_middle(docs, "o").collect()}
    digests = {r["row"]: r["o"] for r in M.fill_in_middle(docs, "o", digests=True).collect()}
    forms = set()
    for doc_id, row, text in rows:
        o, want = got[row], plain(doc_id, text)
        assert (o["n"], o["form"], o["prefix_chars"], o["middle_chars"], o["output"]) == want
        assert M.restore(o["output"].encode(), o["form"]).decode() == (text or "")
        if o["form"] != "plain":
            assert o["prefix"] + o["middle"] + o["suffix"] == text
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        assert (digests[row]["output_sha256"], digests[row]["restored_sha256"]) == (sha(want[-1]), sha(text or ""))
        forms.add(o["form"])
    assert forms == {"plain", "psm", "spm"}


def test_runs_are_maximal_across_pieces(monkeypatch):
    monkeypatch.setattr(M, "PIECE", 7)
    texts = ["aé中😀", "", "aaaaaaaaaaaaaaaaaaaé", "éééééééé", "b"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    runs = M.TextRuns(data, offsets)
    assert runs.units.tolist() == [len(t) for t in texts]
    assert (np.diff(runs.width) != 0).all() and len(runs.unit) == 7  # a, é, 中, 😀, a..., é..., b
    for i, t in enumerate(texts):
        for k in range(len(t) + 1):
            assert runs.cut(np.array([i]), np.array([k]))[0] - offsets[i] == len(t[:k].encode())


def test_other_columns_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "some text", "own"), (1, "some text", "own")], "doc_id long, text string, _fim string")
    out = M.transform_documents(docs)
    assert out.columns == docs.columns and len(set(out.collect())) == 1
    assert M.transform_documents(docs.limit(0)).count() == 0
