"""Spelling variants against all pairs, in the automaton and in Spark, with and without split regions."""

import random
import re
import zlib
from collections import Counter

import pytest

from bookaudit.llm import spelling as S


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[k + 1 :] == b[k + 1 :] or a[k + 1 :] == b[k:] or a[k:] == b[k + 1 :]


def plain(words, ratio=5):
    links = {w: [v for v in words if near(w, v)] for w in words}
    top = {w: min(((-words[v], v) for v in vs), default=None) for w, vs in links.items()}
    form = {w: t for w, t in top.items() if t and -t[0] >= ratio * words[w]}
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root][1]
        out.append((w, form[w][1] if w in form else None, root, n, len(links[w]), -form[w][0] if w in form else None))
    return sorted(out)


def some_words(rng, n, alphabet="abé"):
    words = {"".join(rng.choices(alphabet, k=rng.randint(6, 11))) for _ in range(n)}
    words |= {"prefix" + "".join(rng.choices(alphabet, k=rng.randint(0, 6))) for _ in range(n)}  # one hot beginning
    words |= {"".join(rng.choices(alphabet, k=rng.randint(0, 6))) + "ending" for _ in range(n)}
    return {w: rng.choice([5, 6, 30, 200, 1000]) for w in sorted(words)}


def test_automaton_numbers_and_errors():
    words = sorted(some_words(random.Random(1), 60))
    automaton = S.Automaton(words)
    for k, w in enumerate(words):
        state, number = automaton.walk(0, 0, w)
        assert automaton.final[state] and number == k
        found = automaton.one_error(w, 0, len(w))
        assert {words[i] for i in found} == {v for v in words if near(w, v)}
        half = len(w) // 2
        assert {words[i] for i in automaton.one_error(w, half, len(w))} == {v for v in words if near(w, v) and v[:half] == w[:half]}
    assert len(automaton.next) < sum(map(len, words))
    S.Automaton([])


@pytest.mark.parametrize("group", [S.GROUP, 3])
def test_variants_against_all_pairs(spark, group):
    words = some_words(random.Random(7), 120)
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    got = S.variants(table, group=group).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert sorted(map(tuple, got)) == plain(words)


def test_vocabulary(spark, monkeypatch):
    rng = random.Random(9)
    pool = list(some_words(rng, 30, "abÀé×"))
    docs = [(i if i % 9 else None, " ".join(rng.choices(pool, k=rng.randint(0, 60))).replace("a", rng.choice("aA"))) for i in range(200)] + [(1, None), (2, ""), (3, "a1b2"), (3, "x" * 50_000 + " prefix")]
    want = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c < "\x80" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            want[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 7 == 0 else run] += 1
    table = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, word int").repartition(3)
    got = {r["word"]: r["n"] for r in S.vocabulary(table, damage=7).collect()}
    assert got == {w: n for w, n in want.items() if len(w) >= 6 and n >= 5}
    monkeypatch.setattr(S, "PIECE", 10)
    assert [w for p in S.runs("abc def" * 9 + "Éa-b") for w in p] == re.findall("[A-Za-zÀ-ÿ]+", ("abc def" * 9 + "Éa-b"))


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert S.variants(S.vocabulary(docs)).count() == 0
