"""Exact dedup by counting quotient filters.

1. Each partition builds a counting quotient filter of its texts' 64-bit fingerprints: the high bits are the
   quotient, which names a run; the run holds the sorted remainders (the bits below, packed) with counts.
2. Filters merge without loss: runs of one quotient are merged by sorted remainders, counts add up.
3. Fingerprints counted more than once go to byte verification: their whole normalised texts are compared.
   Texts that only share a fingerprint part there.

Texts are equal when identical after lower-casing A-Z only. Defined cases: null text is the empty text;
of equal texts the row with the largest doc_id stays (null ids last; of rows with one id and one text, one
stays); an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, staged, table, text_or_empty, unused_name, with_flag

#: A run holds about this many fingerprints; at least so many quotients.
PER_RUN, MIN_RUNS = 500_000, 1024


def _run(fingerprints: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct remainders and their added counts."""
    values, at = np.unique(fingerprints, return_inverse=True)
    return values, np.bincount(at, weights=counts, minlength=len(values)).astype(np.int64)


def _merged(stack: list[tuple[np.ndarray, np.ndarray]], all_of_it: bool = False) -> list[tuple[np.ndarray, np.ndarray]]:
    """The stack of sorted values after merging its last ones while they are about as long, so that each value is merged a few times at most."""
    while len(stack) > 1 and (all_of_it or len(stack[-2][0]) <= 2 * len(stack[-1][0])):
        (v, c), (w, d) = stack.pop(), stack.pop()
        stack.append(_run(np.concatenate([v, w]), np.concatenate([c, d])))
    return stack


def _packed(remainders: np.ndarray, bits: int) -> bytes:
    """The low 64 - bits bits of each, in whole bytes."""
    return remainders.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : (71 - bits) // 8].tobytes()


def _unpacked(data: bytes, bits: int) -> np.ndarray:
    width = (71 - bits) // 8
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return out.view("<u8")[:, 0]


def _partition_filter(bits: int):
    """mapInArrow: one filter a partition; one row for each quotient that isn't empty."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
        for b in batches:  # at most one entry a distinct text of the partition
            stack = _merged([*stack, _run(b.column(0).to_numpy().view(np.uint64))])
        values, counts = _merged(stack, True)[0]
        quotient = (values >> np.uint64(64 - bits)).astype(np.int64)
        remainder = values & np.uint64((1 << (64 - bits)) - 1)
        cuts = np.flatnonzero(np.diff(quotient, prepend=-1))
        ends = np.append(cuts[1:], len(quotient))
        yield pa.RecordBatch.from_pydict(
            {
                "quotient": pa.array(quotient[cuts], pa.int64()),
                "remainders": pa.array([_packed(remainder[a:b], bits) for a, b in zip(cuts, ends)], pa.binary()),
                "counts": pa.array([counts[a:b].astype("<u4").tobytes() for a, b in zip(cuts, ends)], pa.binary()),
            }
        )

    return build


def _merge_runs(bits: int):
    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        """Fingerprints with a count over one, from the runs of one quotient."""
        remainders = np.concatenate([_unpacked(x, bits) for x in pdf["remainders"]])
        counts = np.concatenate([np.frombuffer(x, "<u4") for x in pdf["counts"]])
        remainders, counts = _run(remainders, counts)
        more = counts > 1
        values = (np.uint64(pdf["quotient"].iloc[0]) << np.uint64(64 - bits)) | remainders[more]
        return pd.DataFrame({"fp": values.view(np.int64), "n": counts[more]})

    return merge


def repeated_fingerprints(fingerprints: DataFrame, rows: int) -> DataFrame:
    """(fp, n) of all values of the one long column that occur more than once, by merged quotient filters."""
    bits = max(MIN_RUNS, rows // PER_RUN).bit_length() - 1
    filters = fingerprints.mapInArrow(_partition_filter(bits), "quotient long, remainders binary, counts binary")
    return filters.groupBy("quotient").applyInPandas(_merge_runs(bits), "fp long, n long")


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256, repeated_id.

    repeated_id: another row has this doc_id and this text too.
    """
    norm = ascii_lower(text_or_empty())
    digests = staged(
        docs.select("doc_id", F.xxhash64(norm).alias("fp"), F.sha2(norm.cast("binary"), 256).alias("text_sha256"), F.monotonically_increasing_id().alias("uid")),
        "exact-digests",
    )
    repeated = staged(repeated_fingerprints(digests.select("fp"), digests.count()), "exact-repeated")
    # Byte verification: texts that can't be repeated stay where they are; of the others one row for each different text of a
    # partition is sent, once. A text that the bitmap lets through without need is alone in its group and does no harm.
    texts = with_flag(docs.select(norm.alias("norm")).withColumn("fp", F.xxhash64("norm")), ["fp"], repeated, "_may").where("_may")
    texts = texts.select(F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"), "norm").groupBy("text_sha256", "norm").agg(F.count("*").alias("n"))
    texts = texts.groupBy("text_sha256").agg(F.count("*").alias("texts"))
    texts = texts.select("text_sha256", F.when(F.col("texts") == 1, F.lit(True)).otherwise(F.raise_error(F.lit("two texts with one SHA-256"))).alias("verified"))
    row = F.struct(F.col("doc_id").isNotNull(), "doc_id", "uid")
    groups = with_flag(digests, ["fp"], repeated, "_may").where("_may").groupBy("fp", "text_sha256").agg(F.max(row).alias("last"), F.count("*").alias("n"))
    groups = groups.join(repeated.select("fp"), "fp")
    groups = groups.join(texts, "text_sha256").where("verified").where("n > 1").select("text_sha256", "last", "n")
    # Written first, so that both sides of the join are plain shuffles and a hot digest's rows can be split.
    out = digests.join(staged(groups, "exact-classes"), "text_sha256", "left")
    keep = F.coalesce(F.col("last.doc_id"), F.when(F.col("last").isNull(), F.col("doc_id")))
    return out.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (F.col("last").isNull() | (F.col("last.uid") == F.col("uid"))).alias("kept"),
        "text_sha256",
        (F.col("last.doc_id").eqNullSafe(F.col("doc_id")) & F.col("last").isNotNull() & (F.col("last.uid") != F.col("uid"))).alias("repeated_id"),
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """docs without the rows whose text another row with a larger id (or the same id) has."""
    groups = staged(exact_groups(docs), "exact-groups")
    norm = ascii_lower(text_or_empty())
    gone = groups.where("NOT kept AND NOT repeated_id").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha")).distinct()
    own = unused_name("_own", docs)
    gone = gone.withColumnsRenamed({"_id": f"{own}i", "_sha": f"{own}s"})
    marked = docs.withColumn(own, F.sha2(norm.cast("binary"), 256))
    left = marked.join(gone, marked["doc_id"].eqNullSafe(gone[f"{own}i"]) & (marked[own] == gone[f"{own}s"]), "left_anti")
    if groups.where("repeated_id").limit(1).count():  # rows with one id and one text: one of them stays
        left = left.dropDuplicates(["doc_id", own])
    return left.select(*docs.columns)


def op1_counting_quotient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts over all documents."""
    return exact_groups(table(spark, sf_dir, "documents")).drop("repeated_id")


ORACLE = {
    "op1_counting_quotient": """
        WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents),
        g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
        SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, d.text_sha256 FROM d JOIN g USING (text_sha256)"""
}
