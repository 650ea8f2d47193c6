"""Removal of repeated 200-byte strings by difference-cover sampling.

The difference-cover construction sorts sampled suffixes first and orders all others through them: for a
difference cover D of the residues modulo v, any two positions i, j have a shift k < v with i + k and j + k
both in the sample. Only equality of 200-byte prefixes matters here, so it stops at that depth:

1. Sample: positions whose residue is in a perfect difference set modulo 133 (12 of 133 positions). Each gets
   the name of its tuple, the next 68 bytes. The names are sorted by ranges of the name; adjacent equal ones
   are repeats. Two equal 200-byte strings share a sampled tuple at some shift (132 + 68 = 200), so only
   windows over a repeated name can be repeated.
2. Recursion: the remaining suffixes - every window of 200 bytes that covers a repeated name, sampled or not -
   are named by all their 200 bytes; the names are merged by ranges and adjacent ones compared.
3. Windows with an equal neighbour mark their bytes; runs of marked bytes are removed.

Names are 64-bit hashes of all the bytes, mixed word by word with random keys that are drawn anew in each run, so no
text can be made to collide; a window's is sent with 56 bits beside its range of about a million names, so the chance
that a window is taken for a repeat of another is about 1e-11, at any size of the corpus. Names move between tasks as
packed sorted arrays, one row for each piece of text and range, and answers come back as bit masks; texts are written
once in a bucketed table, which every pass reads without a shuffle and which is dropped at the end.

Defined cases: null text is the empty text; texts under 200 bytes keep all; matches never cross documents;
repeated rows match each other; an empty table gives no rows; other columns aren't read.
"""

from __future__ import annotations

import hashlib
import secrets
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batch_bytes, mix64, remove, shared_dir, staged, table

LENGTH, PRIME = 200, 11
MODULUS = PRIME * PRIME + PRIME + 1
TUPLE = LENGTH - MODULUS + 1
#: Bytes of text a row of the bucketed table holds (one document at least), and names a range aims at.
PIECE, NAMES_PER_RANGE = 2 << 20, 1 << 20
#: Bytes of a name that are sent, beside its range: a sampled name only has to rule out, a window's decides.
SAMPLE_WIDTH, WINDOW_WIDTH = 5, 7


def difference_cover(q: int = PRIME) -> list[int]:
    """A perfect difference set modulo q*q+q+1: the powers of a generator of GF(q**3) without a square term."""
    v = q * q + q + 1
    for a in range(q):
        for b in range(q):
            for c in range(1, q):
                x, found = (0, 1, 0), []  # x[i]: coefficient of t**i, with t**3 = a t**2 + b t + c
                power = (1, 0, 0)
                for i in range(v):
                    if power[2] == 0:
                        found.append(i)
                    k = power[2]
                    power = (k * c % q, (power[0] + k * b) % q, (power[1] + k * a) % q)
                if len(found) == q + 1 and len({(m - n) % v for m in found for n in found}) == v:
                    return found
    raise ValueError(q)


COVER = np.zeros(MODULUS, bool)
COVER[difference_cover()] = True


def new_keys() -> list[int]:
    """One random 64-bit number for each word of a window."""
    return [secrets.randbits(64) for _ in range(LENGTH // 8 + 1)]


def _names(text: Text, at: np.ndarray, size: int, keys: list[int]) -> np.ndarray:
    """Keyed hash of the `size` bytes from each place on; the last word may overlap the one before it."""
    h = np.full(len(at), keys[-1] ^ size, np.uint64)
    for k, i in zip(keys, [*range(0, size - 7, 8), *([size - 8] if size % 8 else [])]):
        h = (h ^ text.words[at + i] ^ np.uint64(k)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
    return mix64(h)


class Text:
    """One piece of the table: its documents end to end."""

    def __init__(self, data: bytes, sizes: np.ndarray) -> None:
        self.data = np.frombuffer(data, np.uint8)
        self.sizes = sizes
        self.first = np.cumsum(sizes) - sizes
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)]).astype(np.uint64)
        self.words = np.zeros(len(self.data), np.uint64)  # the 8 bytes from each place on
        for k in range(8):
            self.words |= padded[k : k + len(self.data)] << np.uint64(8 * k)
        size = np.repeat(sizes, sizes)
        self.place = np.arange(len(self.data)) - np.repeat(self.first, sizes)
        self.left = size - self.place
        self.long = size >= LENGTH

    def sampled(self) -> np.ndarray:
        return np.flatnonzero(self.long & (self.left >= TUPLE) & COVER[self.place % MODULUS])

    def windows_over(self, at: np.ndarray) -> np.ndarray:
        """Starts of the windows that hold a tuple at one of these positions."""
        lo = np.maximum(at - (MODULUS - 1), at - self.place[at])
        steps = np.zeros(len(self.data) + 1, np.int64)
        np.add.at(steps, lo, 1)
        np.add.at(steps, at + 1, -1)
        return np.flatnonzero((np.cumsum(steps[:-1]) > 0) & (self.left >= LENGTH))


def _folded(names: np.ndarray, bits: int, width: int) -> np.ndarray:
    """The name's range (its first `bits` bits) above its last `width` bytes, or what is left beside the range."""
    low = min(8 * width, 64 - bits)
    return ((names >> np.uint64(64 - bits)) << np.uint64(low)) | (names & np.uint64((1 << low) - 1))


def _part(values: np.ndarray, bits: int, width: int) -> np.ndarray:
    return (values >> np.uint64(min(8 * width, 64 - bits))).astype(np.int64)


def _unpacked(data: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return out.view("<u8")[:, 0]


def _ranges(names: np.ndarray, bits: int, width: int, chunk: int) -> pa.RecordBatch:
    """Sorted distinct names by range, `width` bytes each, with a flag for those that occur more than once in this piece."""
    values, counts = np.unique(_folded(names, bits, width), return_counts=True)
    part = _part(values, bits, width)
    packed = (values & np.uint64((1 << min(8 * width, 64 - bits)) - 1)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    cuts = np.flatnonzero(np.diff(part, prepend=-1)) if len(part) else np.zeros(0, np.int64)
    ends = np.append(cuts[1:], len(part)).astype(np.int64)
    return pa.RecordBatch.from_pydict(
        {
            "part": pa.array(part[cuts], pa.int64()),
            "chunk": pa.array(np.full(len(cuts), chunk), pa.int64()),
            "names": pa.array([packed[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary()),
            "twice": pa.array([np.packbits(counts[a:b] > 1).tobytes() for a, b in zip(cuts, ends)], pa.binary()),
        }
    )


def _merge(width: int):
    return lambda pdf: _merged_range(pdf, width)


def _merged_range(pdf: pd.DataFrame, width: int) -> pd.DataFrame:
    """All of one range: which names of each piece have an equal one anywhere."""
    parts = [_unpacked(x, width) for x in pdf["names"]]
    twice = np.concatenate([np.unpackbits(np.frombuffer(t, np.uint8), count=len(p)).astype(bool) for t, p in zip(pdf["twice"], parts)])
    every = np.concatenate(parts)
    order = np.argsort(every, kind="stable")
    same = np.zeros(len(every) + 1, bool)
    same[1:-1] = every[order][1:] == every[order][:-1]  # adjacent names
    repeated = twice.copy()
    repeated[order] |= same[1:] | same[:-1]
    masks, at = [], 0
    for p in parts:
        masks.append(np.packbits(repeated[at : at + len(p)]).tobytes() if repeated[at : at + len(p)].any() else None)
        at += len(p)
    out = pd.DataFrame({"part": pdf["part"], "chunk": pdf["chunk"], "mask": masks, "n": [len(p) for p in parts]})
    return out[out["mask"].notna()]


def _repeated(names: np.ndarray, bits: int, width: int, answers: list[dict]) -> np.ndarray:
    """Which of these names are repeated, by the answers of the ranges (those without one: none)."""
    values, back = np.unique(_folded(names, bits, width), return_inverse=True)
    part = _part(values, bits, width)
    found = np.zeros(len(values), bool)
    for a in answers or []:
        lo, hi = np.searchsorted(part, [a["part"], a["part"] + 1])
        if hi - lo != a["n"]:
            raise ValueError("a piece of text changed between passes")
        found[lo:hi] = np.unpackbits(np.frombuffer(a["mask"], np.uint8), count=a["n"]).astype(bool)
    return found[back]


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, Text]]:
    for b in batches:
        for i in range(len(b)):
            row = b.slice(i, 1)
            yield row, row.column("chunk")[0].as_py(), Text(row.column("data")[0].as_buffer(), np.array(row.column("sizes")[0].as_py(), np.int64))


def _sample_names(bits: int, keys: list[int]):
    def run(batches):
        for _, chunk, text in _texts(batches):
            yield _ranges(_names(text, text.sampled(), TUPLE, keys), bits, SAMPLE_WIDTH, chunk)

    return run


def _candidates(row: pa.RecordBatch, text: Text, bits: int, keys: list[int]) -> np.ndarray:
    at = text.sampled()
    return text.windows_over(at[_repeated(_names(text, at, TUPLE, keys), bits, SAMPLE_WIDTH, row.column("sample")[0].as_py())])


def _window_names(bits: int, bits_w: int, keys: list[int]):
    def run(batches):
        for row, chunk, text in _texts(batches):
            yield _ranges(_names(text, _candidates(row, text, bits, keys), LENGTH, keys), bits_w, WINDOW_WIDTH, chunk)

    return run


def _removed(bits: int, bits_w: int, keys: list[int]):
    def run(batches):
        for row, _, text in _texts(batches):
            at = _candidates(row, text, bits, keys)
            at = at[_repeated(_names(text, at, LENGTH, keys), bits_w, WINDOW_WIDTH, row.column("windows")[0].as_py())]
            steps = np.zeros(len(text.data) + 1, np.int64)
            np.add.at(steps, at, 1)
            np.add.at(steps, at + LENGTH, -1)
            gone = np.cumsum(steps[:-1]) > 0
            begins = gone & ~(np.concatenate([[False], gone[:-1]]) & (text.place > 0)) if len(gone) else gone
            ends = np.cumsum(text.sizes)
            total = lambda m: np.concatenate([[0], np.cumsum(m)])
            n_gone, n_spans = total(gone), total(begins)
            kept = [hashlib.sha256(text.data[a:b][~gone[a:b]].tobytes()).hexdigest() for a, b in zip(text.first, ends)]
            yield pa.RecordBatch.from_arrays(
                [
                    row.column("doc_ids").combine_chunks().flatten() if isinstance(row.column("doc_ids"), pa.ChunkedArray) else row.column("doc_ids").flatten(),
                    pa.array(text.sizes),
                    pa.array(n_gone[ends] - n_gone[text.first]),
                    pa.array(n_spans[ends] - n_spans[text.first]),
                    pa.array(kept, pa.string()),
                    pa.array([np.packbits(gone[a:b]).tobytes() if gone[a:b].any() else None for a, b in zip(text.first, ends)], pa.binary()),
                ],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"],
            )

    return run


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    base, n = TaskContext.get().partitionId() << 32, 0
    for b in batches:
        data, offsets = batch_bytes(b.column(1))
        lo = 0
        while lo < len(b):
            hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + PIECE, side="right")) - 1)
            ids = b.column(0).slice(lo, hi - lo)
            ids = ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([base + n], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, hi - lo], pa.int32()), ids),
                    pa.array([np.diff(offsets[lo : hi + 1]).tolist()], pa.list_(pa.int64())),
                    pa.array([data[offsets[lo] : offsets[hi]].tobytes()], pa.binary()),
                ],
                names=["chunk", "doc_ids", "sizes", "data"],
            )
            n, lo = n + 1, hi


def _bits(names: int) -> int:
    return max(6, (names // NAMES_PER_RANGE).bit_length())


def repeated_spans(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed (bit mask of its bytes, null: none)."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    buckets = max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    name = f"suffix_texts_{uuid.uuid4().hex}"
    pieces = docs.select("doc_id", "text").mapInArrow(_pieces, f"chunk long, doc_ids array<{kind}>, sizes array<long>, data binary")
    folder, keys = f"{shared_dir(spark)}/{name}", new_keys()
    pieces.write.format("parquet").option("compression", "zstd").option("path", folder).bucketBy(buckets, "chunk").saveAsTable(name)
    texts = spark.table(name)
    total = texts.agg(F.coalesce(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)), F.lit(0))).first()[0]
    answer = "part long, chunk long, mask binary, n int"

    def answers(names: DataFrame, label: str, width: int) -> DataFrame:
        merged = staged(names.groupBy("part").applyInPandas(_merge(width), answer), f"suffix-{label}")
        return merged.repartition(buckets, "chunk").groupBy("chunk").agg(F.collect_list(F.struct("part", "mask", "n")).alias(label))

    bits = _bits(total * int(COVER.sum()) // MODULUS)
    named = "part long, chunk long, names binary, twice binary"
    sample = answers(texts.select("chunk", "sizes", "data").mapInArrow(_sample_names(bits, keys), named), "sample", SAMPLE_WIDTH)
    sampled = texts.join(sample, "chunk", "left")
    bits_w = _bits(total // 8)
    windows = answers(sampled.select("chunk", "sizes", "data", "sample").mapInArrow(_window_names(bits, bits_w, keys), named), "windows", WINDOW_WIDTH)
    both = sampled.join(windows, "chunk", "left").select("chunk", "doc_ids", "sizes", "data", "sample", "windows")
    out = staged(both.mapInArrow(_removed(bits, bits_w, keys), f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed binary"), "suffix-removed")
    spark.sql(f"DROP TABLE {name}")
    remove(spark, folder)
    return out


def op7_difference_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans(table(spark, sf_dir, "documents")).drop("removed")
