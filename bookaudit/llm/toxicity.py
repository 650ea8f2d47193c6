"""Toxicity by weak supervision.

1. Lexicon: words and word beginnings far more common in toxic than in clean training texts (from a bounded
   sample of labelled rows). The strongest are one voter each, beside pattern voters on how many lexicon words
   a text has and how densely.
2. Label model: votes follow a Gaussian with class means (the voters' accuracies) and one covariance (their
   correlations, so that voters which fire together aren't counted twice). Fitted by EM over all documents:
   labelled training rows keep their label, all others get the posterior. Sums are votes x votes in size.
3. A linear classifier learns the posterior labels from counts in the text and scores every document.

Defined cases: null text is the empty text and is scored; labels that are null or have no document are left
out; without labels of both classes the score is their share of ones (0.5 without labels); an empty table
gives no rows. Only the text is ever scored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold, staged, table, text_or_empty, unit_hash
from .quality import training_labels

#: Bounds: labelled rows to find the lexicon in, entries kept, entries that are voters of their own, rows to fit the classifier on.
LEXICON_ROWS, ENTRIES, VOTERS, FIT_ROWS = 20_000, 400, 40, 40_000
PREFIXES = range(4, 9)


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "\\P{L}+"), lambda w: F.length(w) >= 4)


def find_lexicon(docs: DataFrame, train: DataFrame, least_share: float = 0.01, lift: float = 20.0) -> list[str]:
    """Word beginnings of 4 to 8 letters (`abcd`) and whole words (`abcdef$`) that are `lift` times as common in toxic texts.

    A word counts once for each different word before it, so a passage copied many times counts once.
    """
    n = train.count()
    bounded = train.where(unit_hash(F.col("doc_id"), F.lit(5)) < min(1.0, LEXICON_ROWS / max(n, 1)))
    rows = staged(docs.join(bounded, "doc_id").select("label", words_of(text_or_empty()).alias("words")), "toxic-lexicon")
    size = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic, clean = size.get(1, 0), size.get(0, 0)
    if not toxic or not clean:
        return []
    pairs = F.array_distinct(F.zip_with("words", F.concat(F.array(F.lit("")), "words"), lambda w, before: F.struct(w.alias("word"), F.xxhash64(before).alias("before"))))
    seen = rows.select("label", F.explode(pairs).alias("p")).where("p.word IS NOT NULL").select("p.word", "p.before", "label").distinct()
    vocabulary = seen.groupBy("word").agg(F.sum("label").alias("bad"), F.sum(1 - F.col("label")).alias("good"))
    begins = [F.when(F.length("word") > k, F.substring("word", 1, k)) for k in PREFIXES]
    entries = F.filter(F.array(*begins, F.concat("word", F.lit("$"))), lambda e: e.isNotNull())
    counts = vocabulary.select(F.explode(entries).alias("entry"), "bad", "good").groupBy("entry").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    share, other = F.col("bad") / toxic, (F.col("good") + 0.5) / (clean + 1)
    best = counts.where((F.col("bad") >= 3) & (share >= least_share) & (share >= lift * other))
    out: list[str] = []
    found = best.orderBy(F.desc("bad"), F.length("entry"), "entry").limit(4 * ENTRIES).collect()
    for entry in (r["entry"] for r in sorted(found, key=lambda r: (len(r["entry"]), -r["bad"], r["entry"]))):
        if not any(entry.startswith(e) for e in out if not e.endswith("$")):
            out.append(entry)
    strength = {r["entry"]: r["bad"] for r in found}
    return sorted(out, key=lambda e: (-strength[e], e))[:ENTRIES]


def with_hits(docs: DataFrame, lexicon: list[str]) -> DataFrame:
    """(doc_id, n_words, hits: entries of the lexicon in order, with repeats, bangs: number of exclamation marks)."""
    text = text_or_empty()
    words = docs.select("doc_id", words_of(text).alias("words"), (F.length(text) - F.length(F.translate(text, "!", ""))).alias("bangs"))
    groups = [[e for e in lexicon if not e.endswith("$") and len(e) == k] for k in PREFIXES]
    whole = [e[:-1] for e in lexicon if e.endswith("$")]

    def entry(w: Column) -> Column:
        found = [F.when(F.substring(w, 1, k).isin(g), F.substring(w, 1, k)) for k, g in zip(PREFIXES, groups) if g]
        return F.coalesce(*found, *([F.when(w.isin(whole), F.concat(w, F.lit("$")))] if whole else []), F.lit(None).cast("string"))

    hits = F.filter(F.transform("words", entry), lambda e: e.isNotNull()) if lexicon else F.array().cast("array<string>")
    return words.select("doc_id", F.size("words").alias("n_words"), hits.alias("hits"), "bangs")


def voters(lexicon: list[str]) -> list[Column]:
    """Each gives 1 (toxic), -1 (clean) or 0 (no vote)."""
    n, different = F.size("hits"), F.size(F.array_distinct("hits"))
    dense = n / F.greatest(F.col("n_words"), F.lit(1))
    one = lambda cond: F.when(cond, 1.0).otherwise(0.0)
    out = [one(F.array_contains("hits", s)) for s in lexicon[:VOTERS]]
    out += [one(n >= 2), one(n >= 4), one(different >= 2), one(dense >= 0.01), -one(n == 0), -one(n == 1), -one((n > 0) & (dense < 0.001)), one(F.col("bangs") >= 3)]
    return out


def features(lexicon: list[str]) -> list[Column]:
    n = F.size("hits")
    at_least = [F.when(n >= k, 1.0).otherwise(0.0) for k in (1, 2, 3, 5)]
    dense = F.least(F.lit(1.0), 20 * n / F.greatest(F.col("n_words"), F.lit(1)))
    per_stem = [F.least(F.lit(2.0), F.size(F.array_remove(F.transform("hits", lambda w: w == F.lit(s)), False))).cast("double") for s in lexicon[:VOTERS]]
    return [*at_least, dense, F.size(F.array_distinct("hits")) / 4.0, *per_stem]


def _moments(weights: np.ndarray | None, bias: float):
    """mapInPandas: sums for the M step of a partition; weights None: labelled rows only."""

    def run(batches):
        total = None
        for pdf in batches:
            if not len(pdf):
                continue
            V = np.stack(pdf["votes"].to_numpy())
            y = pdf["label"].to_numpy(dtype=float)
            known = ~np.isnan(y)
            p = np.where(known, np.nan_to_num(y), 0.0)
            if weights is not None:
                p = np.where(known, p, 1 / (1 + np.exp(-np.clip(V @ weights + bias, -30, 30))))
                known = np.ones(len(p), bool)
            V, p = V[known], p[known]
            part = np.concatenate([[len(p), p.sum()], p @ V, V.sum(0), (V.T @ V).ravel()]) if len(p) else None
            total = part if total is None else total if part is None else total + part
        if total is not None:
            yield pd.DataFrame({"i": np.arange(len(total)), "s": total})

    return run


def label_model(voted: DataFrame, m: int, rounds: int = 3, ridge: float = 0.02) -> tuple[np.ndarray, float] | None:
    """Weights and bias of the posterior log odds; voted: votes array<double>, label (null where unknown)."""
    weights, bias = None, 0.0
    for _ in range(1 + rounds):
        sums = voted.mapInPandas(_moments(weights, bias), "i int, s double").groupBy("i").agg(F.sum("s").alias("s")).collect()
        s = np.zeros(2 + 2 * m + m * m)  # votes x votes numbers, whatever the corpus
        for r in sums:
            s[r["i"]] = r["s"]
        n, ones, toxic, every, second = s[0], s[1], s[2 : 2 + m], s[2 + m : 2 + 2 * m], s[2 + 2 * m :].reshape(m, m)
        if ones < 1 or n - ones < 1:
            return None
        mean1, mean0 = toxic / ones, (every - toxic) / (n - ones)
        cov = second / n - (ones / n) * np.outer(mean1, mean1) - (1 - ones / n) * np.outer(mean0, mean0)
        weights = np.linalg.solve(cov + ridge * np.eye(m), mean1 - mean0)
        bias = float(-weights @ (mean1 + mean0) / 2 + np.log(ones / (n - ones)))
    return weights, bias


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    train = staged(training_labels(labels, "toxic", 3, 1), "toxic-labels")
    lexicon = find_lexicon(docs, train)
    hits = staged(with_hits(docs, lexicon), "toxic-hits")
    known = hits.join(train, "doc_id", "left")
    votes = voters(lexicon)
    voted = staged(known.select(F.array(*votes).alias("votes"), F.col("label").cast("double").alias("label"), F.array(*features(lexicon)).alias("x"), F.xxhash64("doc_id", F.lit(9)).alias("_h")), "toxic-votes")
    model = label_model(voted, len(votes))
    out = hits.select("doc_id", F.coalesce(fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"), F.array(*features(lexicon)).alias("x"))
    if model is None:
        n, ones = train.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
        score = F.lit(ones / n if n else 0.5)
    else:
        weights, bias = model
        odds = F.aggregate(F.zip_with("votes", F.array(*map(F.lit, weights.tolist())), lambda v, w: v * w), F.lit(bias), lambda a, b: a + b)
        posterior = F.coalesce("label", 1 / (1 + F.exp(-odds)))
        rows = voted.count()
        some = voted.where(unit_hash(F.col("_h")) < min(1.0, FIT_ROWS / max(rows, 1))).select("x", posterior.alias("p"))
        # A soft label is two rows with weights p and 1 - p.
        both = some.select(array_to_vector("x").alias("features"), F.explode(F.array(F.struct(F.lit(1.0).alias("label"), F.col("p").alias("w")), F.struct(F.lit(0.0).alias("label"), (1 - F.col("p")).alias("w")))).alias("y"))
        both = both.select("features", "y.label", "y.w").where("w > 1e-3")
        fitted = LogisticRegression(weightCol="w", regParam=1e-4, maxIter=60).fit(both)
        terms = F.zip_with("x", F.array(*map(F.lit, fitted.coefficients.toArray().tolist())), lambda x, w: x * w)
        score = 1 / (1 + F.exp(-F.aggregate(terms, F.lit(float(fitted.intercept)), lambda a, b: a + b)))
    return out.select("doc_id", "held_out", score.alias("score")).withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def op4_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
