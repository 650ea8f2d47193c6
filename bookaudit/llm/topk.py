"""Exact top-k inner products by norm-bucketed retrieval.

1. Vectors become integers floor(1024 * x). Candidates are grouped by length into buckets (quantiles of
   the norm); a bucket is cut into blocks of bounded size, so equal vectors spread over many tasks.
2. First pass: every query meets the longest vectors; its k-th score there is a floor for its result.
3. Second pass: floor / (|q| * longest of the bucket) is the bucket's local cosine threshold. A bucket whose
   threshold is over 1 is skipped. Otherwise each block takes coordinate pruning where the threshold is high
   (candidates must be close to the query in its largest coordinates) and length pruning where it is low
   (only vectors of at least floor / |q|); what is left is verified by exact integer products.

Defined cases: vectors that are null, empty or hold null or non-finite components take no part; a row without
id takes no part; a query never meets rows with its own id; ties go to the smaller id; fewer than k
candidates give fewer rows. Vectors of other lengths than the query's aren't compared with it. Ids that come
again: a pair of ids counts once, with the largest score of its rows. Components count as at most 4.6e18 after
scaling; scores are exact while they fit a long and are its limit beyond.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import staged, table

BUCKETS, BLOCK, QUERY_BLOCK, COORDINATE_FROM = 16, 8192, 8192, 0.75
LARGEST = 4.6e18


def integer_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 1024) -> DataFrame:
    """(vec_id, v array<long>, dim, norm2 long) of the rows that take part."""
    x = F.transform(F.col(vec_col), lambda c: c.cast("double"))
    fine = F.col(id_col).isNotNull() & (F.size(x) > 0) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    v = vectors.where(fine).select(F.col(id_col).cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(F.least(F.greatest(c * scale, F.lit(-LARGEST)), F.lit(LARGEST))).cast("long")).alias("v"))
    return v.select("vec_id", "v", F.size("v").alias("dim"), F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c).alias("norm2"))


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    if len(ids) > 4 * k:
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = np.flatnonzero(scores >= kth)
        return keep[np.lexsort((ids[keep], -scores[keep]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def _block_scores(k: int, prune: bool):
    """cogroup: a block of candidates with the queries that have to meet it."""

    def score(key, cand: pd.DataFrame, quer: pd.DataFrame) -> pd.DataFrame:
        out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
        if len(cand) and len(quer):
            cand = cand.sort_values(["norm2", "vec_id"], ascending=[False, True])
            ids, C = cand["vec_id"].to_numpy(), np.stack(cand["v"].to_numpy()).astype(np.int64)
            # Products of doubles are exact while they stay under 2**53, those of longs under 2**63; else Python's own.
            most = float(np.abs(C).max(initial=0)) * float(max(np.abs(np.asarray(q)).max(initial=0) for q in quer["v"])) * C.shape[1]
            M = C.astype(np.float64 if most < 2**52 else np.int64 if most < 2**62 else object)
            again = len(np.unique(ids)) < len(ids)
            length = np.sqrt(cand["norm2"].to_numpy())
            unit = C / np.maximum(length, 1e-9)[:, None]
            rest = np.sqrt(np.maximum(0.0, 1 - unit**2))
            for qid, q, qn2, floor in zip(quer["vec_id"], quer["v"], quer["norm2"], quer["floor"]):
                q = np.asarray(q, dtype=np.int64)
                qn = float(np.sqrt(qn2))
                pick = np.arange(len(ids))
                if prune and np.isfinite(floor) and floor > 0 and qn > 0:
                    threshold = floor / (qn * max(length[0], 1e-9))
                    if threshold > 1 + 1e-6:
                        continue
                    pick = pick[: np.searchsorted(-length, -(floor / qn) * (1 - 1e-9) + 1e-6, side="right")]
                    if threshold >= COORDINATE_FROM:
                        for f in np.argsort(-np.abs(q))[:3]:
                            u = q[f] / qn
                            most = u * unit[pick, f] + np.sqrt(max(0.0, 1 - u * u)) * rest[pick, f]
                            pick = pick[most * length[pick] * qn >= floor - 1e-6 * (1 + floor)]
                pick = pick[ids[pick] != qid]
                if not len(pick):
                    continue
                got = M[pick] @ q.astype(M.dtype)
                got = np.clip(got, 1 - 2**63, 2**63 - 1).astype(np.int64) if M.dtype == object else got.astype(np.int64)
                if again:  # the best row of each id
                    order = np.lexsort((-got, ids[pick]))
                    order = order[np.concatenate([[True], ids[pick][order][1:] != ids[pick][order][:-1]])]
                    pick, got = pick[order], got[order]
                best = _best(ids[pick], got, k)
                out["query_id"].append(np.full(len(best), qid))
                out["vec_id"].append(ids[pick][best])
                out["score"].append(got[best])
        if not out["query_id"]:
            return pd.DataFrame({c: np.zeros(0, np.int64) for c in out})
        return pd.DataFrame({c: np.concatenate(v) for c, v in out.items()})

    return score


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, buckets: int = BUCKETS, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k largest integer products of each query.

    Both inputs are results of integer_vectors.
    """
    vectors, queries = staged(vectors, "topk-vectors"), staged(queries, "topk-queries")
    rows, n_queries = vectors.count(), queries.count()
    cuts = sorted(set(vectors.approxQuantile("norm2", [i / buckets for i in range(1, buckets)], 0.001))) if rows else []
    # Bucket 0 holds the longest vectors.
    bucket = sum((F.when(F.col("norm2") < c, 1).otherwise(0) for c in cuts), F.lit(0))
    placed = vectors.withColumn("bucket", bucket)
    info = placed.groupBy("dim", "bucket").agg(F.count("*").alias("n"), F.sqrt(F.max("norm2")).alias("longest"))
    info = info.withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))  # at most `buckets` rows a dimension
    info = staged(info.withColumn("seen", F.sum("n").over(Window.partitionBy("dim").orderBy("bucket")) - F.col("n")), "topk-buckets")
    q_blocks = max(1, -(-n_queries // QUERY_BLOCK))
    queries = queries.withColumn("qblock", F.pmod(F.xxhash64("vec_id"), F.lit(q_blocks)).cast("int"))
    # A candidate goes to its block once for each block of queries that has to meet its bucket.
    cand = placed.join(F.broadcast(info.select("dim", "bucket", "blocks")), ["dim", "bucket"])
    cand = cand.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(7)), F.col("blocks")).cast("int"))
    key = ["dim", "bucket", "block", "qblock"]

    def met(who: DataFrame, where: DataFrame, prune: bool) -> DataFrame:
        pairs = who.join(F.broadcast(where), "dim")
        if prune:
            pairs = pairs.where(F.isnan("floor") | (F.col("floor") <= F.sqrt("norm2") * F.col("longest") * (1 + 1e-9) + 1e-6))
        asked = staged(pairs.select("dim", "bucket", "qblock").distinct(), "topk-asked")  # buckets x query blocks at most
        pairs = pairs.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(*key, "vec_id", "v", "norm2", "floor")
        these = cand.join(asked, ["dim", "bucket"]).select(*key, "vec_id", "v", "norm2")
        return these.groupBy(*key).cogroup(pairs.groupBy(*key)).applyInPandas(_block_scores(k, prune), "query_id long, vec_id long, score long")

    first = info.where("bucket = 0 OR (seen < 64)")
    once = lambda df: df.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    floors = staged(once(met(queries.withColumn("floor", F.lit(float("nan"))), first, False)), "topk-first")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    kth = floors.withColumn("r", F.row_number().over(w)).where(F.col("r") == k).select(F.col("query_id").alias("_q"), F.col("score").cast("double").alias("floor"))
    known = queries.join(kth, queries["vec_id"] == kth["_q"], "left").withColumn("floor", F.coalesce("floor", F.lit(float("nan")))).drop("_q")
    rest = met(known, info.join(first.select("dim", "bucket"), ["dim", "bucket"], "left_anti"), True)
    ranked = once(floors.unionByName(rest)).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op9_norm_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten best of each vector whose id is divisible by 100, over all embeddings."""
    v = integer_vectors(table(spark, sf_dir, "embeddings"))
    return top_k(v, v.where("vec_id % 100 = 0"))


ORACLE = {
    "op9_norm_buckets": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v FROM embeddings
                   WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.vec_id AS query_id, c.vec_id, max(CAST(list_dot_product(q.v, c.v) AS BIGINT)) AS score
              FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0 GROUP BY q.vec_id, c.vec_id),
        r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
        SELECT * FROM r WHERE rank <= 10"""
}
