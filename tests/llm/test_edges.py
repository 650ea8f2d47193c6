"""Repeated ids, clashing columns, huge values and packed remainders."""

import collections

import numpy as np
from pyspark.sql import functions as F

from bookaudit.llm import exact_dedup, near_dedup, quality, suffix_dedup, topk
from bookaudit.llm.common import with_flag


def test_remainders_round_trip_and_merge():
    rng = np.random.default_rng(2)
    for bits in (10, 16, 21):
        low = rng.integers(0, 1 << (64 - bits), 500, dtype=np.uint64)
        assert (exact_dedup._unpacked(exact_dedup._packed(low, bits), bits) == low).all()
    stack, every = [], []
    for _ in range(40):
        new = rng.integers(0, 3000, 100).astype(np.uint64)
        every.append(new)
        stack = exact_dedup._merged([*stack, exact_dedup._run(new)])
        assert len(stack) <= 12
    values, counts = exact_dedup._merged(stack, True)[0]
    want = collections.Counter(np.concatenate(every).tolist())
    assert dict(zip(values.tolist(), counts.tolist())) == want


def test_repeated_fingerprints(spark):
    values = [5, -5, 5, 2**62, -(2**63), -(2**63), 7, -5, 5]
    got = exact_dedup.repeated_fingerprints(spark.createDataFrame([(v,) for v in values], "fp long").repartition(3), len(values)).collect()
    assert {r["fp"]: r["n"] for r in got} == {5: 3, -5: 2, -(2**63): 2}


def test_clashing_columns_stay(spark):
    rows = [(i, f"some words of text number {i // 2} and more of it", "own", "flag", "row", i) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _own string, _flag string, _row string, _quality_stats int")
    docs = docs.withColumns({"_fp": F.lit(1), "_piece": F.lit(2), "lang": F.lit("en"), "source": F.lit("s")})
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    from bookaudit.llm import mixing

    for left in (exact_dedup.drop_copies(docs), near_dedup.drop_near_copies(docs), quality.drop_rejected(docs, labels), mixing.keep_mixed(docs)):
        assert left.columns == docs.columns
        assert all((r["_own"], r["_flag"], r["_row"], r["_quality_stats"], r["_fp"]) == ("own", "flag", "row", r["doc_id"], 1) for r in left.collect())


def test_one_id_with_two_texts(spark):
    """Texts of one id don't join each other's classes."""
    a, b = "a b c d e f g h i j k l m n o p q r s t u v w x y z", "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17 18 19 20 21 22 23 24"
    docs = spark.createDataFrame([(1, a), (1, b), (2, a + " aa"), (3, b + " 25"), (2, a + " aa")], "doc_id long, text string")
    assert sorted((r["doc_id"], r["text"]) for r in near_dedup.drop_near_copies(docs).collect()) == sorted([(1, a), (1, b)])


def test_top_k_of_repeated_ids_and_huge_values(spark):
    rows = [(100, [1.0, 2.0]), (100, [1.0, 2.0]), (1, [3.0, 1.0]), (1, [3.0, 1.0]), (1, [0.0, 5.0]), (2, [1.0, 1.0]), (3, [1e30, -1e30]), (4, [2.0, 2.0]), (200, [-1e30, 1e30])]
    v = topk.integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = collections.defaultdict(list)
    for r in topk.top_k(v, v.where("vec_id % 100 = 0"), 3, buckets=2, block=2).orderBy("rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    whole = {i: [int(np.floor(np.clip(1024 * x, -4.6e18, 4.6e18))) for x in e] for i, e in rows}
    score = collections.defaultdict(lambda: -(10**60))
    for q, a in rows:
        for c, b in rows:
            if q % 100 == 0 and c != q:
                s = sum(int(np.floor(np.clip(1024 * x, -4.6e18, 4.6e18))) * int(np.floor(np.clip(1024 * y, -4.6e18, 4.6e18))) for x, y in zip(a, b))
                score[q, c] = max(score[q, c], min(max(s, 1 - 2**63), 2**63 - 1))
    assert whole.keys() == {100, 1, 2, 3, 4, 200}
    for q in (100, 200):
        assert got[q] == sorted(((c, s) for (p, c), s in score.items() if p == q), key=lambda x: (-x[1], x[0]))[:3]


def test_with_flag_never_misses(spark):
    wanted = spark.range(0, 3000, 3).select((F.col("id") * 7919).alias("k"), F.lit("x").alias("other"))
    got = with_flag(spark.range(3000).select((F.col("id") * 7919).alias("key")), ["key"], wanted, "hit").where("hit").count()
    assert 1000 <= got < 1020


def test_texts_made_to_collide_are_kept(spark):
    """Thue-Morse words collide under every polynomial hash modulo 2**64; they aren't repeats."""
    word = "a"
    while len(word) < 4096:
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    head, tail = "".join(chr(65 + i % 26) for i in range(40)), "-" * 20
    texts = [(1, head + word[:1024] + tail), (2, head[::-1] + other[:1024] + tail)]
    seen = collections.Counter(t[i : i + 200] for _, t in texts for i in range(len(t) - 199))
    got = {r["doc_id"]: r["n_removed"] for r in suffix_dedup.repeated_spans(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    for i, t in texts:
        gone = {k + j for k in range(len(t) - 199) if seen[t[k : k + 200]] > 1 for j in range(200)}
        assert got[i] == len(gone)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("suffix_texts")]
