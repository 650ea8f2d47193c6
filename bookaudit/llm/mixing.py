"""Mixing sources to target weights by iterative proportional fitting.

1. Topics: words are counted by hash over all documents; a document is the sum of its words' tf-idf weights,
   projected at random to `DIMENSIONS` numbers of length 1; k-means over all documents gives `TOPICS` clusters.
2. Tokens (words) are summed by cell: source, language, topic.
3. The cells' masses are raked: scaled to each margin's targets in turn until all margins agree.
4. A cell's sampling probability is its raked over its present mass, times one factor that is calibrated so
   that the expected tokens are `keep_share` of the corpus, with no probability over 1.
5. Each document stays if a hash of its id and text is below its cell's probability.

Targets default to the corpus's own shares to the power `temper`, which lifts small sources, languages and topics.

Defined cases: a null source or language is a value of its own (''); a null or wordless text counts 0 tokens,
has topic -1 and, in a cell without tokens, probability keep_share; values without a target keep their share;
an empty table gives no rows; rows equal in id and text share their place, and so their fate within a cell.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import staged, table, text_or_empty, unit_hash
from .words import slices, word_bounds, word_hashes

#: Clusters, numbers a document is projected to, places words are hashed to.
TOPICS, DIMENSIONS, TERMS = 8, 32, 1 << 16
#: Rounds of k-means at most, the move of a centre that ends it, and vectors to begin from.
MEANS_ROUNDS, MEANS_MOVE, BEGIN = 10, 1e-2, 1024
MARGINS = ("source", "lang", "topic")
#: Up to so many cells are raked on the driver and joined by broadcast; more are raked in Spark.
SMALL_CELLS = 100_000
#: Raking ends when no cell's mass changes by more in a round, on both paths.
ROUNDS, TOLERANCE = 100, 1e-9


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of each row; then row, place and count of each of its different words."""
    starts, ends, row = word_bounds(data, offsets)
    n = len(offsets) - 1
    key = row * TERMS + (word_hashes(data, starts, ends) % np.uint64(TERMS)).astype(np.int64) if len(starts) else np.zeros(0, np.int64)
    key, count = np.unique(key, return_counts=True)
    return np.bincount(row, minlength=n), key // TERMS, key % TERMS, count


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df = np.zeros(TERMS, np.int64)
    for b in batches:
        for _, _, data, offsets in slices(b.column(0)):
            df += np.bincount(_terms(data, offsets)[2], minlength=TERMS)
    some = np.flatnonzero(df)
    yield pa.RecordBatch.from_pydict({"term": pa.array(some), "df": pa.array(df[some])})


def term_weights(docs: DataFrame) -> np.ndarray:
    """Inverse document frequency of each place over all documents; at most TERMS numbers reach the driver."""
    counted = docs.select("text").mapInArrow(_frequencies, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    df, n = np.zeros(TERMS), docs.count()
    df[counted["term"].to_numpy()] = counted["df"].to_numpy()
    return np.log1p(n / (df + 1)).astype(np.float32)


def _projected(weights: np.ndarray):
    """Arrow function: tokens and the projected unit vector of each text (null without words)."""

    @F.arrow_udf(T.StructType([T.StructField("tokens", T.LongType()), T.StructField("vector", T.ArrayType(T.FloatType()))]))
    def project(text: pa.Array) -> pa.Array:
        signs = np.random.default_rng(20240609).choice(np.array([-1, 1], np.float32), (TERMS, DIMENSIONS)) * weights[:, None]
        tokens, vectors = [np.zeros(0, np.int64)], [np.zeros((0, DIMENSIONS), np.float32)]
        for _, _, data, offsets in slices(text):
            words, row, place, count = _terms(data, offsets)
            out = np.zeros((len(words), DIMENSIONS), np.float32)
            if len(row):
                some, cuts = np.unique(row, return_index=True)
                out[some] = np.add.reduceat(signs[place] * (1 + np.log(count.astype(np.float32)))[:, None], cuts)
            tokens.append(words)
            vectors.append(out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9))
        tokens, vectors = np.concatenate(tokens), np.concatenate(vectors)
        ends = np.arange(len(tokens) + 1, dtype=np.int32) * DIMENSIONS
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(vectors.ravel()), mask=pa.array(tokens == 0))
        return pa.StructArray.from_arrays([pa.array(tokens), lists], names=["tokens", "vector"])

    return project


def _sums(centers: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(centers), DIMENSIONS + 1))
        for b in batches:
            x = np.asarray(b.column(0).flatten(), np.float64).reshape(-1, DIMENSIONS)
            at = (x @ centers.T - (centers**2).sum(1) / 2).argmax(1)
            np.add.at(total, at, np.hstack([x, np.ones((len(x), 1))]))
        yield pa.RecordBatch.from_pydict({"i": pa.array(np.arange(total.size)), "s": pa.array(total.ravel())})

    return run


def topic_centers(vectors: DataFrame) -> np.ndarray:
    """k-means over all rows of vectors (one column of unit vectors): sums by cluster in Spark, TOPICS centres on the driver."""
    begin = vectors.orderBy(F.xxhash64("vector"), "vector").limit(BEGIN).toArrow()["vector"].combine_chunks().flatten()
    sample, rng = np.asarray(begin, np.float64).reshape(-1, DIMENSIONS), np.random.default_rng(7)
    centers = sample[:1]
    while len(centers) < TOPICS:  # far ones are likelier
        far = np.maximum(((sample[:, None] - centers) ** 2).sum(2).min(1), 1e-12)
        centers = np.vstack([centers, sample[rng.choice(len(sample), p=far / far.sum())]])
    for _ in range(MEANS_ROUNDS):
        sums = vectors.mapInArrow(_sums(centers), "i long, s double").groupBy("i").agg(F.sum("s").alias("s")).toArrow()
        total = np.zeros(TOPICS * (DIMENSIONS + 1))
        total[sums["i"].to_numpy()] = sums["s"].to_numpy()
        total = total.reshape(TOPICS, -1)
        new = np.where(total[:, -1:] > 0, total[:, :-1] / np.maximum(total[:, -1:], 1), centers)
        moved, centers = np.abs(new - centers).max(), new
        if moved < MEANS_MOVE:
            break
    return centers


def nearest_center(centers: np.ndarray):
    """Arrow function: the place of the centre nearest to each vector, the last of equally near ones; -1 without a vector.

    Not a column expression: with a term a number of each centre, its plans fill the driver's memory.
    """
    half = np.array([c @ c / 2 for c in centers])

    @F.arrow_udf(T.IntegerType())
    def nearest(vector: pa.Array) -> pa.Array:
        # All vectors have length 1, so it is the centre with the largest product less half its square.
        x = np.asarray(vector.flatten(), np.float64).reshape(-1, DIMENSIONS)
        fit = x[:, :1] * centers[:, 0]
        for i in range(1, DIMENSIONS):  # added in order, so that equal centres fit equally
            fit += x[:, i : i + 1] * centers[:, i]
        out = np.full(len(vector), -1, np.int32)
        out[np.asarray(vector.is_valid())] = len(centers) - 1 - (fit - half)[:, ::-1].argmax(1)
        return pa.array(out)

    return nearest


def celled(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, the document's cell, its tokens and its place in [0, 1); further columns as they are."""
    cell = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("source", "lang")]
    rows = docs.select("doc_id", *cell, _projected(term_weights(docs))("text").alias("p"), unit_hash(F.col("doc_id"), F.xxhash64(text_or_empty())).alias("place"), *more)
    rows = staged(rows.select("doc_id", "source", "lang", "p.tokens", "p.vector", "place", *more), "mix-vectors")
    worded = rows.select("vector").where("vector IS NOT NULL")
    topic = F.lit(-1)
    if worded.limit(1).count():
        topic = nearest_center(topic_centers(worded))("vector")
    return rows.select("doc_id", "source", "lang", topic.cast("string").alias("topic"), "tokens", "place", *more)


def _targets(cells: pd.DataFrame, margin: str, given: dict | None, temper: float) -> pd.Series:
    """Share of each value of a margin; adds up to 1."""
    own = cells.groupby(margin)["tokens"].sum() / cells["tokens"].sum()
    if given is None:
        share = own**temper
    else:
        share = own.copy()
        for value, weight in given.items():
            if value in share.index:
                share[value] = weight
    return share / share.sum()


def rake(cells: pd.DataFrame, targets: dict | None = None, temper: float = 0.7, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> pd.Series:
    """The cells' masses after raking; they add up to 1."""
    mass = cells["tokens"] / cells["tokens"].sum()
    shares = {m: _targets(cells, m, (targets or {}).get(m), temper) for m in MARGINS}
    for _ in range(rounds):
        before = mass
        for m in MARGINS:
            now = mass.groupby(cells[m]).transform("sum")
            mass = mass * np.where(now > 0, cells[m].map(shares[m]) / now.where(now > 0, 1.0), 0.0)
        if (mass - before).abs().max() < tolerance:
            break
    return mass


def probabilities(tokens: np.ndarray, mass: np.ndarray, keep_share: float) -> np.ndarray:
    """min(1, factor * mass / share of tokens), the factor by bisection so that expected tokens are keep_share of all."""
    ratio = np.divide(mass * tokens.sum(), tokens, out=np.zeros(len(tokens)), where=tokens > 0)
    lo, hi = 0.0, max(1.0, 1 / max(ratio[ratio > 0].min(initial=1.0), 1e-12))
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if (np.minimum(1, mid * ratio) * tokens).sum() < keep_share * tokens.sum() else (lo, mid)
    return np.where(tokens > 0, np.minimum(1, hi * ratio), keep_share)


def _raked_in_spark(cells: DataFrame, targets: dict | None, temper: float, keep_share: float, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> DataFrame:
    """The same for many cells: masses by sums of each margin, the factor by repeated sums; nothing but sums on the driver."""
    spark = cells.sparkSession
    total = cells.agg(F.sum("tokens")).first()[0]
    if not total:
        return cells.select(*MARGINS, F.lit(1.0).alias("weight"), F.lit(keep_share).alias("probability"))
    out = cells.where("tokens > 0").withColumn("mass", F.col("tokens") / total)
    for m in MARGINS:
        own = cells.groupBy(m).agg((F.sum("tokens") / total).alias("own"))
        given = (targets or {}).get(m)
        if given is None:
            own = own.withColumn("share", F.pow("own", F.lit(temper)))
        else:
            wanted = spark.createDataFrame([(v, float(x)) for v, x in given.items()], f"{m} string, wanted double")
            own = own.join(wanted, m, "left").withColumn("share", F.coalesce("wanted", "own"))
        norm = own.agg(F.sum("share")).first()[0]
        out = out.join(own.select(m, (F.col("share") / norm).alias(f"_{m}")), m)
    for _ in range(rounds):
        out = out.withColumn("before", F.col("mass"))
        for m in MARGINS:
            now = out.groupBy(m).agg(F.sum("mass").alias("now"))
            fitted = F.when(F.col("now") > 0, F.col("mass") * F.col(f"_{m}") / F.col("now")).otherwise(0.0)
            out = staged(out.join(now, m).withColumn("mass", fitted).drop("now"), "rake-round")
        change = out.agg(F.max(F.abs(F.col("mass") - F.col("before")))).first()[0]
        out = out.drop("before")
        if change < tolerance:
            break
    ratio = F.col("mass") * total / F.col("tokens")
    least = out.where("mass > 0").agg(F.min(ratio)).first()[0]
    lo, hi = 0.0, max(1.0, 1 / max(min(least, 1.0), 1e-12))
    while True:  # 15 factors between the two a pass, until no number lies between them
        factors = [f for f in (lo + (hi - lo) * k / 16 for k in range(1, 16)) if lo < f < hi]
        if not factors:
            break
        got = out.agg(*(F.sum(F.least(F.lit(1.0), f * ratio) * F.col("tokens")).alias(f"f{k}") for k, f in enumerate(factors))).first()
        short = [f for f, x in zip(factors, got) if x < keep_share * total]
        lo, hi = max(short, default=lo), min((f for f in factors if f not in short), default=hi)
        if hi <= lo:  # sums that differ by rounding
            break
    return out.select(*MARGINS, ratio.alias("weight"), F.least(F.lit(1.0), hi * ratio).alias("probability"))


def _fitted(rows: DataFrame, targets: dict | None, keep_share: float, temper: float, small_cells: int) -> DataFrame:
    """rows of celled() with weight, probability and kept."""
    cells = staged(rows.groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens")), "mix-cells")
    n = cells.count()
    if n <= small_cells:
        table_ = cells.toPandas().sort_values(list(MARGINS), ignore_index=True)
        if table_["tokens"].sum() > 0:
            mass = rake(table_, targets, temper)
            table_["weight"] = np.where(table_["tokens"] > 0, mass * table_["tokens"].sum() / table_["tokens"].clip(lower=1), 1.0)
            table_["probability"] = probabilities(table_["tokens"].to_numpy(float), mass.to_numpy(float), keep_share)
        else:
            table_["weight"], table_["probability"] = 1.0, keep_share
        fitted = F.broadcast(rows.sparkSession.createDataFrame(table_[[*MARGINS, "weight", "probability"]], ", ".join(f"{m} string" for m in MARGINS) + ", weight double, probability double"))
    else:
        fitted = _raked_in_spark(cells, targets, temper, keep_share)
    out = rows.join(fitted, list(MARGINS), "left").withColumns({"weight": F.coalesce("weight", F.lit(1.0)), "probability": F.coalesce("probability", F.lit(keep_share))})
    return out.withColumn("kept", F.col("place") < F.col("probability"))


def mixed(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, keep_share: float = 0.75, temper: float = 0.7, small_cells: int = SMALL_CELLS) -> DataFrame:
    """One row per row of docs: doc_id, source, lang, topic, tokens, weight, probability, kept.

    targets: shares wanted by margin and value, such as {"lang": {"en": 0.5}}.
    """
    rows = celled(docs)
    return _fitted(rows, targets, keep_share, temper, small_cells).select("doc_id", *MARGINS, "tokens", "weight", "probability", "kept")


def keep_mixed(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, keep_share: float = 0.75, temper: float = 0.7, small_cells: int = SMALL_CELLS) -> DataFrame:
    """docs without the rows that the sample leaves out. Each row goes through with its own cell and place."""
    whole = docs.select("doc_id", "text", "source", "lang", F.struct(*docs.columns).alias("_row"))
    rows = celled(whole, "_row")
    return _fitted(rows, targets, keep_share, temper, small_cells).where("kept").select("_row.*")


def op5_raking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents"))
