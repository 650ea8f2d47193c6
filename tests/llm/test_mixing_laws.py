"""All margins of the mix, the sample against its probabilities, and what a topic is."""

import collections
import random

import pytest

from bookaudit.llm import mixing

DOCS = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(3))
    common, own = [word() for _ in range(100)], [[word() for _ in range(60)] for _ in range(4)]
    rows = []
    for i in range(1200):
        subject = own[i % 4]
        text = " ".join(rng.choice(subject if rng.random() < 0.6 else common) for _ in range(rng.randint(40, 200)))
        rows.append((i, text, ("en", "en", "de", "fr", None)[i % 5], f"s{i % 3 if i % 7 else 9}"))
    return spark.createDataFrame([*rows, (5000, None, "en", "s1"), (5001, " ", "xx", "s1")], DOCS).repartition(3)


def test_every_margin_meets_its_target(docs):
    targets = {"lang": {"en": 0.3, "de": 0.3}, "topic": {"0": 0.2}}
    rows = mixing.mixed(docs, targets, keep_share=0.5).collect()
    total = sum(r["tokens"] for r in rows)
    for margin in ("source", "lang", "topic"):
        own, mass = collections.Counter(), collections.Counter()
        for r in rows:
            own[r[margin]] += r["tokens"] / total
            mass[r[margin]] += r["tokens"] * r["weight"] / total
        want = {v: targets[margin].get(v, x) if margin in targets else x**0.7 for v, x in own.items()}
        for v, x in want.items():
            assert abs(mass[v] - x / sum(want.values())) < 1e-6, (margin, v)


def test_the_sample_follows_its_probabilities(docs):
    rows = mixing.mixed(docs, keep_share=0.5).collect()
    by = collections.defaultdict(list)
    for r in rows:
        assert 0 <= r["probability"] <= 1 and (r["tokens"] > 0 or r["topic"] == "-1")
        by[round(r["probability"], 9)].append(r["kept"])
    expected = sum(p * len(kept) for p, kept in by.items())
    assert abs(sum(r["kept"] for r in rows) - expected) < 4 * sum(p * (1 - p) * len(k) for p, k in by.items()) ** 0.5
    assert abs(sum(r["tokens"] * r["probability"] for r in rows) / sum(r["tokens"] for r in rows) - 0.5) < 1e-6


def test_topics_follow_subjects(docs):
    """Each of the four subjects' documents fall in clusters that hold hardly any other subject's."""
    by = collections.defaultdict(collections.Counter)
    for r in mixing.mixed(docs).collect():
        if r["tokens"]:
            by[r["topic"]][r["doc_id"] % 4] += 1
    assert sum(c.most_common(1)[0][1] for c in by.values()) > 0.95 * 1200
