"""Line rules against a plain version, by hand-written texts and edge cases."""

import random
import re

from pyspark.sql import functions as F

from bookaudit.llm import line_rules as L

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SENTENCES = ["The cat sat on the mat today.", "a b c d e", "Terms  of Use | Privacy", "x | y | z.", "wow!! such!! noise!!", "### $$ %% a.", "© 2020 by us. All rights reserved.", "", "   ", "čau、世界。 ok", "…", "tail\r", "same line here.", "one two three four five one two three four five."]


def plain(text):
    """The counts of one text, by loops."""
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    repeated = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    out = {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in L.SYMBOLS for c in text), "n_repeat_words": len(repeated), "n_dup_lines": 0, "n_lines": 0, "lost_words": 0, "lost_punctuation": 0, "lost_navigation": 0, "lost_boilerplate": 0}
    seen, kept = set(), []
    for line in text.split("\n"):
        ws = WORD.findall(line)
        if not ws:
            kept.append(line)
            continue
        out["n_lines"] += 1
        out["n_dup_lines"] += line in seen
        seen.add(line)
        p = not any(m in line for m in L.MARKS) or 2 * sum(c in L.SYMBOLS for c in line) > len(ws) or 5 * sum("!!" in w or "??" in w for w in ws) > len(ws)
        separators = sum(w in L.SEPARATORS for w in ws)
        n = separators >= 2 and 5 * separators >= len(ws)
        b = len(ws) <= 40 and any(x in " ".join(line.lower().split()) for x in L.PHRASES)
        for flag, c in ((p, "lost_punctuation"), (n, "lost_navigation"), (b, "lost_boilerplate")):
            out[c] += flag
        if p or n or b:
            out["lost_words"] += len(ws)
        else:
            kept.append(line)
    return out, "\n".join(kept)


def test_against_loops(spark):
    rng = random.Random(4)
    texts = [None, "", " ", "\n", "\n\n", "word", "a\nb\n", "é" * 50, "x " * 30, ("w " * 7 + ".\n") * 4] + ["\n".join(rng.choices(SENTENCES, k=rng.randint(1, 9))) for _ in range(150)]
    texts += ["long. " * 300_000, "z" * 1_200_000, "line of words.\n" * 90_000]  # each more than a slice
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(2)
    got = {r["doc_id"]: r["o"] for r in L.line_report(docs, "o").select("doc_id", "o").collect()}
    for i, text in enumerate(texts[:-3]):
        counts, left = plain(text)
        assert {c: got[i][c] for c in L.COUNTS} == counts and got[i]["clean_text"] == left, text
    long = got[len(texts) - 3]
    assert (long["n_words"], long["n_repeat_words"], long["lost_words"], long["base_failed"]) == (300_000, 300_000, 0, True)
    assert got[len(texts) - 1]["n_dup_lines"] == 89_999


def test_clean_documents_stay(spark):
    good = "This is a line of plain prose with an end. It goes on a little.\nAnd here is another one of them, which is fine too."
    rows = [(1, good, "a"), (1, good, "b"), (2, good + "\nHome | News | Sport | About", "a"), (None, good, "a"), (3, "Home | News | Sport | About\n" * 3 + "Only this is text.", "a"), (4, None, "a"), (5, "few words.", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _lines string")
    left = L.clean_lines(docs)
    assert left.columns == docs.columns
    assert sorted(map(str, left.collect())) == sorted(map(str, docs.where("doc_id IS NULL OR doc_id < 3").withColumn("text", F.lit(good)).collect()))
    assert L.clean_lines(docs.limit(0)).count() == 0
