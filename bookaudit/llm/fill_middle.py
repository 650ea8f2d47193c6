"""Fill-in-the-middle transformation over run-length encoded texts.

A text's code points are put into classes by the bytes they take in UTF-8 (1 to 4). Maximal runs of one class are
stored as (units before it, bytes before it, bytes a unit). A cut after k units needs no walk over the text: binary
search finds the run that holds unit k, and its byte is run's byte + (k - run's unit) * bytes a unit. ASCII texts are
one run. `TextRuns` holds the runs of many texts end to end, so one search cuts a whole slice of texts.

A text is written as it is (plain) if it is empty, holds a marker, or its draw says so; else as `<P>` prefix `<S>`
suffix `<M>` middle (psm) or `<S>` suffix `<P>` prefix `<M>` middle (spm). Texts with markers are never cut, and no
marker can arise across a cut, so `restore` finds the pieces by the first marker of each kind.

Defined cases: null texts count as empty; a null id draws from `1:`; rows with one id are transformed alike; very long
texts are one row of a slice; other columns are kept by `fill_in_middle`; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table, unused_name
from .words import slices

P, S, M = "<P>", "<S>", "<M>"
PIECE = 1 << 20
SEED, PLAIN_FROM, SPM_BELOW = "1", 90, 20
_UNIT_BYTES = np.zeros(256, np.int8)  # by lead byte; 0: not a lead
_UNIT_BYTES[:0x80], _UNIT_BYTES[0xC0:0xE0], _UNIT_BYTES[0xE0:0xF0], _UNIT_BYTES[0xF0:] = 1, 2, 3, 4


class TextRuns:
    """Runs of the texts data[offsets[i]:offsets[i + 1]]; units are numbered through all of them."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        if data.max(initial=0) < 0x80:  # a unit a byte: one run
            self.unit = self.byte = np.zeros(1, np.int64)
            self.width = np.ones(1, np.int64)
            self.first, self.units = offsets[:-1].astype(np.int64), np.diff(offsets).astype(np.int64)
            return
        found, before, units, last = [], np.empty(len(offsets), np.int64), 0, 0
        for lo in range(0, len(data), PIECE):  # bounds the memory of a long text
            kind = _UNIT_BYTES[data[lo : lo + PIECE]]
            lead = np.flatnonzero(kind)
            kind = kind[lead].astype(np.int64)
            here = slice(*np.searchsorted(offsets, [lo, lo + PIECE]))
            before[here] = units + np.searchsorted(lead, offsets[here] - lo)
            new = np.flatnonzero(np.diff(kind, prepend=last))
            found.append(np.stack([new + units, lead[new] + lo, kind[new]]))
            units, last = units + len(lead), kind[-1] if len(kind) else last
        before[np.searchsorted(offsets, len(data)) :] = units
        self.unit, self.byte, self.width = np.concatenate(found, axis=1)
        self.first, self.units = before[:-1], np.diff(before)

    def cut(self, row: np.ndarray, units: np.ndarray) -> np.ndarray:
        """Bytes of data before the given number of units of each row."""
        k = self.first[row] + units
        run = np.searchsorted(self.unit, k, side="right") - 1
        return self.byte[run] + (k - self.unit[run]) * self.width[run]


def composed(form: str, prefix: bytes, middle: bytes, suffix: bytes) -> bytes:
    p, s, m = P.encode(), S.encode(), M.encode()
    if form == "plain":
        return prefix + middle + suffix
    return b"".join((p, prefix, s, suffix, m, middle) if form == "psm" else (s, suffix, p, prefix, m, middle))


def restore(output: bytes, form: str) -> bytes:
    """The text of an output, from it and its form alone."""
    if form == "plain":
        return output
    first, second = (P, S) if form == "psm" else (S, P)
    a, rest = output[len(first) :].split(second.encode(), 1)
    b, middle = rest.split(M.encode(), 1)
    return a + middle + b if form == "psm" else b + middle + a


_FIELDS = [("n", T.LongType()), ("form", T.StringType()), ("prefix_chars", T.LongType()), ("middle_chars", T.LongType())]
_TEXTS = ["prefix", "middle", "suffix", "output"]
_DIGESTS = ["output_sha256", "restored_sha256"]


def _transformer(names: list[str]):
    """A function of (text, first cut, second cut, plain, spm) columns; names: its last columns, texts or digests."""

    @F.arrow_udf(T.StructType([T.StructField(*f) for f in _FIELDS] + [T.StructField(c, T.StringType()) for c in names]))
    def transformed(text: pa.Array, h1: pa.Array, h2: pa.Array, plain: pa.Array, spm: pa.Array) -> pa.Array:
        draws = [x.to_numpy(zero_copy_only=False) for x in (h1, h2, plain, spm)]
        out: dict[str, list] = {c: [] for c in [f[0] for f in _FIELDS] + names}
        for lo, hi, data, offsets in slices(text):
            runs = TextRuns(data, offsets)
            a, b, as_is, swapped = (x[lo:hi] for x in draws)
            cuts = np.sort(np.stack([a, b]) % (runs.units + 1), axis=0)
            at = np.stack([offsets[:-1], *(runs.cut(np.arange(hi - lo), c) for c in cuts), offsets[1:]])
            whole = data.tobytes()
            for i in range(hi - lo):
                pieces = [whole[s:e] for s, e in zip(at[:-1, i], at[1:, i])]
                original = whole[at[0, i] : at[3, i]]
                marked = any(x.encode() in original for x in (P, S, M))
                form = "plain" if not original or marked or as_is[i] else "spm" if swapped[i] else "psm"
                output = composed(form, *pieces)
                found = {"n": int(runs.units[i]), "form": form, "prefix_chars": None, "middle_chars": None, "output": output}
                if form != "plain":
                    found |= {"prefix_chars": int(cuts[0, i]), "middle_chars": int(cuts[1, i] - cuts[0, i]), **dict(zip(("prefix", "middle", "suffix"), pieces))}
                if names is _DIGESTS:
                    found |= {"output_sha256": hashlib.sha256(output).hexdigest(), "restored_sha256": hashlib.sha256(restore(output, form)).hexdigest()}
                for c in out:
                    out[c].append(found.get(c))
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64()] + [pa.string()] * len(names)
        return pa.StructArray.from_arrays([_array(v, k) for v, k in zip(out.values(), kinds)], list(out))

    return transformed.asNondeterministic()  # not worked out once more in a filter on its result


def _array(values: list, kind: pa.DataType) -> pa.Array:
    if pa.types.is_string(kind) and any(isinstance(v, bytes) for v in values):
        return pa.array(values, pa.binary()).cast(kind)
    return pa.array(values, kind)


def draws(doc_id: Column, seed: str = SEED) -> list[Column]:
    """The four draws of a document: 8-digit groups of a SHA-256, as longs."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(h, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def fill_in_middle(docs: DataFrame, name: str, seed: str = SEED, plain_from: int = PLAIN_FROM, spm_below: int = SPM_BELOW, digests: bool = False) -> DataFrame:
    """docs with a struct column: n, form, prefix_chars, middle_chars, and prefix, middle, suffix, output (or the digests)."""
    h = draws(F.col("doc_id"), seed)
    run = _transformer(_DIGESTS if digests else _TEXTS)
    return docs.withColumn(name, run(F.col("text"), h[0], h[1], h[2] % 100 >= plain_from, h[3] % 100 < spm_below))


def transform_documents(docs: DataFrame, **rates: int) -> DataFrame:
    """docs with their texts transformed; the columns of docs."""
    name = unused_name("_fim", docs)
    out = fill_in_middle(docs, name, **rates).withColumn("text", F.col(f"`{name}`.output"))
    return out.select(*(F.col(f"`{c}`") for c in docs.columns))


def op12_class_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return fill_in_middle(docs, "fim", digests=True).select("doc_id", "fim.*")


ORACLE = {
    "op12_class_runs": """
WITH h AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
d AS (
  SELECT doc_id, text, length(text)::BIGINT AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
  FROM h),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM d),
p AS (SELECT *, substring(text, 1, a) AS pre, substring(text, a + 1, b - a) AS mid, substring(text, b + 1, n - b) AS suf FROM c),
o AS (
  SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
    CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END AS output
  FROM p),
q AS (SELECT *, strpos(output, '<P>') AS ip, strpos(output, '<S>') AS isx, strpos(output, '<M>') AS im, length(output) AS k FROM o)
SELECT doc_id, n, form, prefix_chars, middle_chars, sha256(output) AS output_sha256,
  sha256(CASE form WHEN 'plain' THEN output
    WHEN 'psm' THEN substring(output, 4, isx - 4) || substring(output, im + 3, k) || substring(output, isx + 3, im - isx - 3)
    ELSE substring(output, ip + 3, im - ip - 3) || substring(output, im + 3, k) || substring(output, 4, ip - 4) END) AS restored_sha256
FROM q"""
}
