"""Quality by a sparse rule ensemble.

1. Statistics of each whole text (shares of byte classes, repeats of words and lines, lengths).
2. A random forest on the labelled training rows; every path from a root to a node is a conjunctive rule.
3. A lasso logistic model weighs the rules; most weights become zero.
4. The rules left are compiled into one Spark column expression over the statistics.

Defined cases: null text is the empty text (all statistics zero) and is scored; labels without a matching
document, null labels and null ids are left out of training; with fewer than two classes of labels the score
is their share of ones (0.5 without labels); an empty table gives no rows. Only the text is ever scored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fold, staged, table, unused_name
from .words import slices, word_bounds, word_hashes

#: Bytes of each class.
CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "stop": b".?", "comma": b",;:", "bang": b"!",
    "symbol": b"#$%&*@^~_+=\\/<>", "bracket": b"()[]{}", "pipe": b"|", "line": b"\n", "high": bytes(range(128, 256)),
}
STATS = [*CLASSES, "words", "word_len", "longest", "distinct", "repeat", "bigram_repeat", "line_repeat", "line_words"]
STATS_TYPE = T.StructType([T.StructField(s, T.DoubleType()) for s in STATS])


def _distinct(row: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """Different values of each row."""
    order = np.lexsort((value, row))
    r, v = row[order], value[order]
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (v[1:] != v[:-1])
    return np.bincount(r[new], minlength=n)


def _piece(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    n = len(offsets) - 1
    out, size = {}, np.maximum(np.diff(offsets), 1)
    kind = np.zeros(256, np.uint8)
    for k, chars in enumerate(CLASSES.values(), 1):
        kind[list(chars)] = k
    row_of = np.repeat(np.arange(n), np.diff(offsets))
    counts = np.bincount(row_of * 16 + kind[data], minlength=16 * n).reshape(n, 16)
    for k, name in enumerate(CLASSES, 1):
        out[name] = counts[:, k] / size
    starts, ends, row = word_bounds(data, offsets)
    words = np.bincount(row, minlength=n)
    some = np.maximum(words, 1)
    h = word_hashes(data, starts, ends) if len(starts) else np.zeros(0, np.uint64)
    out["words"] = np.log1p(words)
    out["word_len"] = np.bincount(row, weights=ends - starts, minlength=n) / some
    longest = np.zeros(n)
    np.maximum.at(longest, row, ends - starts)
    out["longest"] = np.log1p(longest)
    out["distinct"] = _distinct(row, h, n) / some
    same_row = row[1:] == row[:-1]
    out["repeat"] = np.bincount(row[1:][same_row & (h[1:] == h[:-1])], minlength=n) / some
    pair, pair_row = (h[1:] * np.uint64(3) ^ h[:-1])[same_row], row[1:][same_row]
    pairs = np.bincount(pair_row, minlength=n)
    out["bigram_repeat"] = 1 - _distinct(pair_row, pair, n) / np.maximum(pairs, 1) * (pairs > 0) - (pairs == 0)
    # A line is the run of words before the next line end: its hash is the sum of mixed word hashes in order.
    breaks = np.cumsum(data == 10)
    line = breaks[starts] + row  # rows part lines too
    cuts = np.flatnonzero(np.diff(line, prepend=-1) != 0) if len(line) else np.zeros(0, np.int64)
    if len(cuts):
        place = (np.arange(len(h)) - np.repeat(cuts, np.diff(np.append(cuts, len(h))))).astype(np.uint64)
        sums = np.add.reduceat(h * (np.uint64(2) * place + np.uint64(1)), cuts)
    else:
        sums = np.zeros(0, np.uint64)
    lines = np.bincount(row[cuts], minlength=n)
    out["line_repeat"] = (lines - _distinct(row[cuts], sums, n)) / np.maximum(lines, 1)
    out["line_words"] = np.log1p(words / np.maximum(lines, 1))
    return out


@F.arrow_udf(STATS_TYPE)
def text_statistics(text: pa.Array) -> pa.Array:
    parts = [_piece(data, offsets) for _, _, data, offsets in slices(text)]
    columns = [np.concatenate([p[s] for p in parts]) if parts else np.zeros(0) for s in STATS]
    return pa.StructArray.from_arrays([pa.array(c, pa.float64()) for c in columns], names=STATS)


def _paths(tree) -> list[tuple]:
    """Every root-to-node path of a fitted tree, as a tuple of (statistic, '<=' or '>', threshold)."""
    out, stack = [], [(tree._call_java("rootNode"), ())]
    while stack:
        node, path = stack.pop()
        if path:
            out.append(path)
        if node.subtreeDepth() > 0:
            split = node.split()
            name, at = STATS[split.featureIndex()], float(split.threshold())
            stack.append((node.leftChild(), (*path, (name, "<=", at))))
            stack.append((node.rightChild(), (*path, (name, ">", at))))
    return out


def _rule(path: tuple, at) -> Column:
    """One conjunction as a 0/1 column; `at` gives the column of a statistic."""
    parts = [(at(s) <= t) if op == "<=" else (at(s) > t) for s, op, t in path]
    cond = parts[0]
    for p in parts[1:]:
        cond &= p
    return cond.cast("double")


def fit_rules(labelled: DataFrame, trees: int = 12, depth: int = 3, lasso: float = 0.001, seed: int = 11) -> tuple[list[tuple[tuple, float]], float]:
    """labelled: stats (struct), label 0/1. Returns the rules with their weights, and the intercept."""
    n, ones = labelled.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not n or ones in (0, n):
        share = min(max(ones / n, 0.01), 0.99) if n else 0.5
        return [], math.log(share / (1 - share))
    at = lambda s: F.col(f"stats.{s}")
    rows = labelled.select(F.col("label").cast("double").alias("label"), array_to_vector(F.array(*map(at, STATS))).alias("features"), "stats")
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, subsamplingRate=0.7, featureSubsetStrategy="0.5").fit(rows)
    paths = sorted({p for tree in forest.trees for p in _paths(tree)}, key=str)
    if not paths:
        share = ones / n
        return [], math.log(share / (1 - share))
    rules = rows.select("label", array_to_vector(F.array(*[_rule(p, at) for p in paths])).alias("features"))
    model = LogisticRegression(elasticNetParam=1.0, regParam=lasso, standardization=False, maxIter=60).fit(rules)
    return [(p, float(w)) for p, w in zip(paths, model.coefficients) if w], float(model.intercept)


def compiled(rules: list[tuple[tuple, float]], intercept: float, at) -> Column:
    """The ensemble as one column expression: the probability of label 1."""
    total = F.lit(intercept)
    for path, w in rules:
        total = total + F.lit(w) * _rule(path, at)
    return 1 / (1 + F.exp(-total))


def training_labels(labels: DataFrame, column: str, folds: int, held_out: int) -> DataFrame:
    """(doc_id, label) of the rows to learn from; an id with several labels counts once, with the larger."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(column).isin(0, 1) & (fold("doc_id", folds) != held_out))
    return rows.groupBy("doc_id").agg(F.max(column).alias("label"))


def fitted_score(measured: DataFrame, labels: DataFrame):
    """Function of a statistics getter to the score column; measured: doc_id, stats."""
    train = training_labels(labels, "quality", 4, 2)
    labelled = staged(measured.where(fold("doc_id", 4) != 2).join(train, "doc_id").select("label", "stats"), "quality-train")
    rules, intercept = fit_rules(labelled)
    return lambda at: compiled(rules, intercept, at)


def measure(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", text_statistics("text").alias("stats"))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    measured = staged(measure(docs), "quality-stats")
    score = fitted_score(measured, labels)(lambda s: F.col(f"stats.{s}"))
    out = measured.select("doc_id", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), score.alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def drop_rejected(docs: DataFrame, labels: DataFrame, reject_below: float = 0.5) -> DataFrame:
    """docs without the rows whose score is under reject_below: those where label 0 is likelier."""
    measured = staged(measure(docs), "quality-stats")
    score = fitted_score(measured, labels)
    name = unused_name("_quality_stats", docs)
    return docs.withColumn(name, text_statistics("text")).where(score(lambda s: F.col(f"{name}.{s}")) >= reject_below).select(*docs.columns)


def op8_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
