"""Training-data operators against brute force on small tables that hold nulls, empties, ties and repeats."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from bookaudit.llm import exact_dedup, html_extract, mixing, near_dedup, packing, quality, sharding, suffix_dedup, topk, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars int, topic string, score double"
LABELS = "doc_id long, quality int, toxic int"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(n))


def corpus(seed=1):
    """Texts with copies, near copies, a shared passage, nulls, empties, a long one and repeated rows."""
    rng = random.Random(seed)
    base = [words(rng, rng.randint(20, 120)) for _ in range(30)]
    passage = words(rng, 60)
    texts = [*base, base[0].upper(), base[0], base[1], None, "", "  \n ", "one two", "one two", passage + base[2], "x " + passage, words(rng, 4000), "naïve é " + base[3]]
    for b in base[5:9]:
        w = b.split()
        for k in range(3):
            v = list(w)
            v[(k * 7) % len(v)] = "changed"
            texts.append(" ".join(v))
    rows = [(i, t, "en" if i % 3 else None, "hot" if i % 2 else f"s{i % 5}", len(t or ""), "clash", 0.5) for i, t in enumerate(texts)]
    return [*rows, rows[0], (None, "no id", "en", "s1", 5, "clash", 0.5), (None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), DOCS).repartition(3, "n_chars").cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def test_exact(docs, empty):
    rows = docs.collect()
    groups = collections.defaultdict(list)
    for r in rows:
        groups[lower(r["text"])].append(r["doc_id"])
    got = exact_dedup.exact_groups(docs).collect()
    assert len(got) == len(rows)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for r in got:
        ids = [i for i in by_sha[r["text_sha256"]] if i is not None]
        assert r["group_size"] == len(by_sha[r["text_sha256"]]) and r["keep_id"] == (max(ids) if ids else None)
    assert sum(r["kept"] for r in got) == len(groups)
    left = exact_dedup.drop_copies(docs)
    assert left.columns == docs.columns and left.count() == len(groups)
    assert exact_dedup.exact_groups(empty).count() == 0 and exact_dedup.drop_copies(empty).count() == 0


def test_quotient_filters_merge():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 50, 400).astype(np.uint64) * np.uint64(2**57)
    one, counts = exact_dedup._run(values)
    a, b = exact_dedup._run(values[:150]), exact_dedup._run(values[150:])
    both = exact_dedup._run(np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]]))
    assert (both[0] == one).all() and (both[1] == counts).all()


def shingles(t):
    w = [x for x in __import__("re").split(r"[\x20\x09-\x0d]+", lower(t)) if x]
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def test_near(docs, empty):
    rows = [r for r in docs.collect() if r["doc_id"] is not None]
    sets = {r["doc_id"]: shingles(r["text"]) for r in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    got = near_dedup.near_classes(docs, leaders=1, block=2).collect()
    assert len(got) == docs.count()
    for r in got:
        if r["doc_id"] is not None:
            assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(sets[r["doc_id"]]), root(r["doc_id"]), root(r["doc_id"]) == r["doc_id"])
    assert near_dedup.drop_near_copies(docs).columns == docs.columns
    assert near_dedup.near_classes(empty).count() == 0


def test_sketches_merge():
    rng = np.random.default_rng(3)
    a, b = (rng.integers(0, 2**63, 500, dtype=np.uint64) for _ in "ab")
    regs = near_dedup.registers_of(np.concatenate([a, b, a, b]), np.array([500, 500, 1000]))
    assert (np.maximum(regs[0], regs[1]) == regs[2]).all()


def test_repeats(docs, empty):
    rows = [(r["doc_id"], (r["text"] or "").encode()) for r in docs.collect()]
    seen = collections.Counter(t[i : i + 200] for _, t in rows for i in range(len(t) - 199))
    want = collections.Counter()
    for i, t in rows:
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - 199):
            if seen[t[k : k + 200]] > 1:
                gone[k : k + 200] = True
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(t) else 0
        want[i, len(t), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(t, np.uint8)[~gone].tobytes()).hexdigest()] += 1
    got = collections.Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_dedup.repeated_spans(docs).collect())
    assert got == want and sum(r[2] for r in want) > 0
    assert suffix_dedup.repeated_spans(empty).count() == 0


def test_difference_cover():
    d = suffix_dedup.difference_cover()
    assert {(a - b) % suffix_dedup.MODULUS for a in d for b in d} == set(range(suffix_dedup.MODULUS))


def test_packing(docs, empty):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    odd = ["a  b   c ", " x\r\n\n y", "don't it's_we'll 12³ ½ Ⅷ ٣٤", "a\u0085b\u001cc", "é ‍ ﻿", "<|endoftext|> z", "a <|endoftext|> b<|endoftext|>", "tail ", "a" + " \n" * 5000 + "b"]
    odd += ["".join(f"a{chr(c)}1 {chr(c)}{chr(c)} {chr(c)}b\n" for c in range(at, at + 512) if not 0xD800 <= c < 0xE000) for at in range(0, 0x110000, 512)]  # every code point
    fast = packing.TextTokenizer(packing.default_tokenizer())
    for t in [*odd, *(r["text"] or "" for r in docs.collect())]:
        assert fast(t) == tok.encode(t, add_special_tokens=False).ids, t
    pieces = packing.pack_documents(docs).collect()
    assert sum(p["length"] for p in pieces) == sum(len(tok.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in docs.collect())
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append((p["offset"], p["length"]))
    for r in docs.collect():
        if r["doc_id"] in (None, 0):
            continue
        ids, at = [*tok.encode(r["text"] or "", add_special_tokens=False).ids, 0], 0
        for p in sorted(by_doc[r["doc_id"]], key=lambda p: p["start"]):
            part = np.array(ids[at : at + p["length"]], "<u4").tobytes()
            assert (p["start"], p["doc_tokens"], p["ids_crc32"]) == (at, len(ids), zlib.crc32(part))
            at += p["length"]
        assert at == len(ids)
    for s in by_sequence.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= 1024
    assert sum(sum(n for _, n in s) < 1024 for s in by_sequence.values()) <= 4
    assert packing.pack_documents(empty).count() == 0


def test_top_k(spark):
    rng = np.random.default_rng(7)
    center = rng.normal(size=(5, 16))
    rows = [(i, [float(np.float32(x)) for x in center[i % 5] * (1 + i % 7 / 3) + rng.normal(size=16) * 0.05]) for i in range(400)]
    rows += [(900, rows[3][1]), (1000, rows[3][1]), (1001, None), (1002, [1.0, None]), (1100, [float("nan")] * 16), (1200, []), (None, rows[0][1]), (1300, [0.0] * 16)]
    vectors = topk.integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int" if False else "vec_id long, embedding array<float>"))
    got = collections.defaultdict(list)
    for r in topk.top_k(vectors, vectors.where("vec_id % 100 = 0"), 10, buckets=4, block=37).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    fine = {i: np.floor(1024 * np.array(np.float32(v), float)).astype(int) for i, v in rows if i is not None and v and len(v) == 16 and None not in v and np.isfinite(np.array(v, float)).all()}
    queries = [i for i in fine if i % 100 == 0]
    assert set(got) == set(queries)
    for q in queries:
        best = sorted(((-int(fine[q] @ v), i) for i, v in fine.items() if i != q))[:10]
        assert sorted(got[q]) == [(k + 1, i, -s) for k, (s, i) in enumerate(best)]
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(topk.integer_vectors(none), topk.integer_vectors(none)).count() == 0


def test_shards(spark, docs, empty):
    for df in (docs, spark.createDataFrame([(1, "same" * 50, "en", "s", 1, "t", 0.0)] * 200, DOCS)):
        rows = sharding.shard_by_bytes(sharding.document_records(df), ["text_crc32", "doc_id"], 16).collect()
        assert len(rows) == df.count()
        size, slots = collections.Counter(), collections.defaultdict(list)
        for r in rows:
            size[r["shard"]] += r["size"]
            slots[r["shard"]].append(r["slot"])
        total, largest = sum(size.values()), max(r["size"] for r in rows)
        assert max(size.values()) <= total / 16 + largest
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard_by_bytes(sharding.document_records(empty), ["text_crc32", "doc_id"]).count() == 0


def test_pages(spark):
    def page(i, host, article):
        noise = '<nav><ul><li><a href="/x">menu</a></ul></nav><div class="ad">buy</div><div class="cookie-notice">we use</div><aside>side</aside>'
        return (i, f"https://{host}/p{i}", f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var a='</p><p>no';</script></head><body>{noise}{article}<div class='comments'><p>reader says</p></div><footer>&copy; x</footer></body></html>")

    long = "Some words in the main text of this page, which go on. " * 5
    rows = [page(i, "a.example", f'<div class="post-{i}"><h1>Title {i}</h1><p>{long}<p>Fish &amp; chips&nbsp;a  b<br>c</div>') for i in range(6)]
    rows.append(page(7, "a.example", '<div class="post-7"><p>short</p></div><div class="other"><p>' + long * 3 + "</p></div>"))
    rows += [(8, "https://b.example/x", None), (9, None, "<p>plain"), (10, "bad url", ""), rows[0]]
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in html_extract.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[2][0] == f"Title 2\n{long.strip()}\nFish & chips a b c"
    assert got[7][0] == (long * 3).strip()  # the host's path has too little text here, the page's own best container wins
    assert got[8] == ("", 0) and got[9] == ("plain", 5) and got[10] == ("", 0)
    assert html_extract.main_texts(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def labelled(n=400):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(n):
        text, low, toxic = words(rng, 60), i % 4 == 0, i % 5 == 0
        if low:
            text = "".join(w + rng.choice(["%%% ", "### "]) for w in text.split())
        if toxic:
            w = text.split()
            for _ in range(4):
                w.insert(rng.randint(0, len(w)), rng.choice(["idiot", "moron", "scum", "loser"]))
            text = " ".join(w)
        rows.append((i, text, "en", "s", len(text), None, None))
        labels.append((i, int(not low), int(toxic)))
    return rows, labels + [(99_999, 1, 1), (None, 1, 0), (3, None, None)]


def test_classifiers(spark, docs, empty):
    rows, labels = labelled()
    df, lab = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)
    for scores, k, fold, truth in ((quality.quality_scores(df, lab), 4, 2, lambda i: int(i % 4 != 0)), (toxicity.toxicity_scores(df, lab), 3, 1, lambda i: int(i % 5 == 0))):
        got = scores.collect()
        held = [r for r in got if zlib.crc32(str(r["doc_id"]).encode()) % k == fold]
        assert len(got) == len(rows) and all(r["held_out"] for r in held) and sum(r["held_out"] for r in got) == len(held)
        assert sum(r["predicted"] == truth(r["doc_id"]) for r in held) / len(held) > 0.93
    none = spark.createDataFrame([], LABELS)
    assert {r["score"] for r in quality.quality_scores(docs, none).collect()} == {0.5}
    assert {r["score"] for r in toxicity.toxicity_scores(docs, none).collect()} == {0.5}
    assert toxicity.toxicity_scores(empty, lab).count() == 0 and quality.quality_scores(empty, lab).count() == 0
    kept = quality.drop_rejected(df, lab)
    assert kept.columns == df.columns and abs(kept.count() - 300) < 15


def test_mixing(docs, empty):
    got = mixing.mixed(docs, keep_share=0.6).collect()
    assert len(got) == docs.count()
    total = sum(r["tokens"] for r in got)
    assert abs(sum(r["tokens"] * r["probability"] for r in got) - 0.6 * total) < 1e-6 * total
    mass = collections.Counter()
    for r in got:
        mass[r["source"]] += r["tokens"] * r["weight"] / total
    own = collections.Counter()
    for r in got:
        own[r["source"]] += r["tokens"] / total
    want = {s: x**0.7 for s, x in own.items()}
    assert all(abs(mass[s] - want[s] / sum(want.values())) < 1e-3 for s in want)
    assert mixing.mixed(empty).count() == 0 and mixing.keep_mixed(docs).columns == docs.columns
    many = {(r["doc_id"], r["tokens"]): r["probability"] for r in mixing.mixed(docs, keep_share=0.6, small_cells=0).collect()}
    assert all(abs(many[r["doc_id"], r["tokens"]] - r["probability"]) < 0.02 for r in got if r["tokens"])


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    rows, labels = labelled(300)
    rows += [(1000 + r[0], r[1].upper(), *r[2:]) for r in rows[:20]]
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, LABELS).write.parquet(str(tmp_path / "labels.parquet"))
    d, counts = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, d, str(tmp_path)).write.parquet(str(tmp_path / str(k)))
        out = spark.read.parquet(str(tmp_path / str(k)))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == d.columns
        d = out
        counts.append((name, d.count()))
    assert counts[0][1] < 320 and counts[1][1] <= counts[0][1] and d.select(F.sum("length")).first()[0] > 0
