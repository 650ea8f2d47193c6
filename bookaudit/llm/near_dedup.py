"""Near-duplicate classes by SetSketch registers.

1. Sketch: each text's set of five-word shingles becomes 128 registers, the exponentially spaced truncated
   minima of independent hashes. Registers of unions are maxima of registers, so sketches merge. Equal sets are
   one node from here on. Words are hashed by a key drawn for the run, over all of their bytes, so that no text can
   be made to look like another.
2. Bands: four registers each; nodes that share a band are candidates. A pair at the threshold shares none with
   probability (1 - 0.75**4)**32 = 5e-6, the only loss there is.
3. Leaders: `LEADERS` nodes of each bucket (the smallest by a hash, so mostly the same ones in all buckets of a
   group) meet its other members. The joint likelihood of the registers estimates each pair's similarity; likely
   pairs are verified on full sets, the best of each node first. This finds nearly all classes.
4. The rest, exactly: only pairs of one bucket and different classes are left. A shingle counts if it occurs in
   two classes; a node that has fewer such than 0.75 of its shingles can't be linked with another class and is
   done. In each bucket that still holds two classes, blocks of the members outside the largest class meet blocks
   of all members; in a block all pairs that the counts allow are verified by bit sets. No pair becomes a row
   unless it is a link, and no task holds more than two blocks.

Texts are read a second time only for nodes that share a band, found by a bitmap of bounded size.

Defined cases: null and wordless texts have no shingles and are linked with nothing; fewer than five words are
one shingle; rows without id are linked with nothing and stay; rows that have one id and different texts are
documents of their own in everything but the id they report; rows equal in id and text share their fate; an
empty table gives no rows; other columns aren't read.
"""

from __future__ import annotations

import secrets
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import mix64, staged, table, text_or_empty, unused_name, with_flag
from .words import keyed_hashes, slices, word_bounds

REGISTERS, BAND, WIDTH = 128, 4, 5
SPACING, RATE, TOP = 1.001, 20.0, 65534  # base of the spacing, rate of the exponentials, largest register - 1
PERCENT = 75
#: Estimated similarity from which a leader's pair is tried at once; the others wait for step 4.
LIKELY = 0.55
#: Leaders of a bucket; members of a block and shingles of it.
LEADERS, BLOCK, BLOCK_SHINGLES = 2, 256, 1 << 20
_rng = np.random.default_rng(20240607)
MULTIPLIERS = _rng.integers(0, 2**63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _rng.integers(0, 2**63, WIDTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, key: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row, end to end, and how many each row has. key: see keyed_hashes."""
    n = len(offsets) - 1
    starts, ends, row = word_bounds(data, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(n, np.int64)
    h = keyed_hashes(data, starts, ends, key)
    words = np.bincount(row, minlength=n)
    first = np.cumsum(words) - words
    left = first[row] + words[row] - np.arange(len(h))  # words from here to the end of the row
    value = np.zeros(len(h), np.uint64)
    for k, c in enumerate(_PLACE):  # short texts: the words there are
        part = np.zeros(len(h), np.uint64)
        part[: max(len(h) - k, 0)] = h[k:] * c
        value += np.where(left > k, part, np.uint64(0))
    keep = (left >= WIDTH) | ((words[row] < WIDTH) & (np.arange(len(h)) == first[row]))
    value, row = mix64(value[keep] ^ np.minimum(words[row[keep]], WIDTH).astype(np.uint64)), row[keep]
    order = np.lexsort((value, row))
    value, row = value[order], row[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    return value[new], np.bincount(row[new], minlength=n)


def registers_of(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One row of registers a set; sets without shingles give zeros."""
    out = np.zeros((len(counts), REGISTERS), np.uint16)
    some = np.flatnonzero(counts)
    if len(some):
        cuts = (np.cumsum(counts) - counts)[some]
        least = np.empty((len(some), REGISTERS), np.uint64)
        for j, a in enumerate(MULTIPLIERS):
            least[:, j] = np.minimum.reduceat(values * a, cuts)
        x = -np.log1p(-(least.astype(np.float64) + 1.0) / 2.0**64 * (1 - 1e-16)) / RATE
        out[some] = np.clip(np.floor(1 - np.log(np.maximum(x, 1e-300)) / np.log(SPACING)), 0, TOP + 1).astype(np.uint16)
    return out


def _sketches(key: bytes):
    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """doc_id, fp, text -> doc_id, fp, n, two digests of the set, registers."""
        for b in batches:
            for lo, hi, data, offsets in slices(b.column(2)):
                values, counts = shingle_sets(data, offsets, key)
                ends = np.concatenate([[0], np.cumsum(counts)])
                sums = np.concatenate([[0], np.cumsum(values, dtype=np.uint64)]).astype(np.uint64)
                sums2 = np.concatenate([[0], np.cumsum(mix64(values ^ np.uint64(0xA5A5A5A5)), dtype=np.uint64)]).astype(np.uint64)
                columns = [
                    b.column(0).slice(lo, hi - lo),
                    b.column(1).slice(lo, hi - lo),
                    pa.array(counts.astype(np.int64)),
                    pa.array((sums[ends[1:]] - sums[ends[:-1]]).view(np.int64)),
                    pa.array((sums2[ends[1:]] - sums2[ends[:-1]]).view(np.int64)),
                    pa.array([r.tobytes() for r in registers_of(values, counts)], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "fp", "n", "d0", "d1", "registers"])

    return sketched


def full_sets(key: bytes):
    """A function of a text column: its set of shingle hashes."""

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def full_set(text: pa.Array) -> pa.Array:
        values, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for _, _, data, offsets in slices(text):
            v, c = shingle_sets(data, offsets, key)
            values.append(v)
            counts.append(c)
        ends = np.concatenate([[0], np.cumsum(np.concatenate(counts))]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(values).view(np.int64)))

    return full_set


@F.arrow_udf(T.DoubleType())
def likely_jaccard(a: pa.Array, b: pa.Array, na: pa.Array, nb: pa.Array) -> pa.Array:
    """The Jaccard similarity of the largest joint likelihood, on a grid of hundredths."""
    if not len(a):
        return pa.array([], pa.float64())
    A, B = (np.frombuffer(b"".join(x.to_pylist()), np.uint16).reshape(-1, REGISTERS) for x in (a, b))
    na, nb = na.to_numpy(zero_copy_only=False).astype(float), nb.to_numpy(zero_copy_only=False).astype(float)
    more, less = (A > B).sum(1), (A < B).sum(1)
    same = REGISTERS - more - less
    u = na / (na + nb)
    v = 1 - u
    p = lambda x: -np.log1p(-np.clip(x, 0, 1) * (SPACING - 1) / SPACING) / np.log(SPACING)
    log = lambda x: np.log(np.maximum(x, 1e-12))
    best, at = np.full(len(u), -np.inf), np.zeros(len(u))
    for j in np.linspace(0, 1, 101):
        j = np.minimum(j, np.minimum(u / v, v / u))  # no more than the sizes allow
        up, down = p(u - v * j), p(v - u * j)
        fit = more * log(up) + less * log(down) + same * log(1 - up - down)
        better = fit > best
        best, at = np.where(better, fit, best), np.where(better, j, at)
    return pa.array(at)


#: Not moved into the filter on its result, where it would be worked out once more.
likely_jaccard = likely_jaccard.asNondeterministic()


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, comp): the smallest node reachable over edges (a, b); min labels with pointer jumps until nothing changes."""
    both = staged(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{name}-edges")
    labels = staged(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("comp"), F.lit(True).alias("moved")), f"{name}-labels")
    while labels.where("moved").limit(1).count():
        seen = both.join(labels.select(F.col("node").alias("b"), "comp"), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("m"))
        step = labels.join(seen, "node").select("node", F.col("comp").alias("old"), F.least("comp", "m").alias("comp"))
        jump = step.select(F.col("node").alias("_n"), F.col("comp").alias("_c"))
        step = step.join(jump, step["comp"] == jump["_n"], "left").withColumn("new", F.least("comp", F.coalesce("_c", "comp")))
        labels = staged(step.select("node", F.col("new").alias("comp"), (F.col("new") < F.col("old")).alias("moved")), f"{name}-labels")
    return labels.select("node", "comp")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    left = sets.select(F.col("node").alias("a"), F.col("set").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("set").alias("sb"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b").withColumn("i", F.size(F.array_intersect("sa", "sb")))
    return both.where(100 * F.col("i") >= PERCENT * (F.size("sa") + F.size("sb") - F.col("i"))).select("a", "b")


def _joined(comps: DataFrame, edges: DataFrame) -> DataFrame:
    """comps (node, comp) after joining the classes at both ends of each edge (a, b)."""
    A, B = (comps.select(F.col("node").alias(s), F.col("comp").alias(f"c{s}")) for s in "ab")
    between = edges.join(A, "a").join(B, "b").where("ca <> cb").select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct()
    between = staged(between, "near-between")
    if not between.limit(1).count():
        return comps
    found = components(between, "near").select(F.col("node").alias("comp"), F.col("comp").alias("_new"))
    return staged(comps.join(found, "comp", "left").select("node", F.coalesce("_new", "comp").alias("comp")), "near-comps")


def _apart(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """Pairs whose ends aren't of one class."""
    A, B = (comps.select(F.col("node").alias(s), F.col("comp").alias(f"c{s}")) for s in "ab")
    return pairs.join(A, "a").join(B, "b").where("ca <> cb").select("a", "b")


def led(active: DataFrame, nodes: DataFrame, sets: DataFrame, comps: DataFrame, leaders: int) -> DataFrame:
    """comps after each bucket's leaders have met its other members."""
    w = Window.partitionBy("bucket").orderBy(F.xxhash64("node"), F.col("node"))
    chosen = active.withColumn("r", F.row_number().over(w)).where(F.col("r") <= leaders)
    listed = staged(chosen.groupBy("bucket").agg(F.collect_list("node").alias("leaders")), "near-leaders")  # at most `leaders` each
    meets = active.join(listed, "bucket").groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("leaders"))).alias("others"))
    pairs = meets.select("node", F.explode("others").alias("other")).where("node <> other").select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
    A, B = (nodes.select(F.col("node").alias(s), F.col("n").alias(f"n{s}"), F.col("registers").alias(f"r{s}")) for s in "ab")
    sized = pairs.join(A, "a").join(B, "b").where(100 * F.least("na", "nb") >= PERCENT * F.greatest("na", "nb"))
    likely = staged(sized.select("a", "b", likely_jaccard("ra", "rb", "na", "nb").alias("j")).where(F.col("j") >= LIKELY), "near-likely")
    ends = likely.select(F.explode(F.array("a", "b")).alias("node"), "a", "b", "j")
    best = staged(ends.groupBy("node").agg(F.max(F.struct("j", "a", "b")).alias("p")).select("p.a", "p.b").distinct(), "near-first")
    comps = _joined(comps, _verified(best, sets))
    return _joined(comps, _verified(_apart(likely.join(best, ["a", "b"], "left_anti"), comps), sets))


def _links(pdf: pd.DataFrame) -> pd.DataFrame:
    """Links of one pair of blocks; columns node, comp, n, set (packed hashes that two classes have), outer, inner."""
    sets = [np.frombuffer(x, np.uint64) for x in pdf["set"]]
    size = np.array([len(x) for x in sets])
    vocabulary, at = np.unique(np.concatenate(sets), return_inverse=True)
    bits = np.zeros((len(sets), -(-len(vocabulary) // 64) * 8), np.uint8)
    row = np.repeat(np.arange(len(sets)), size)
    np.bitwise_or.at(bits, (row, at >> 3), np.uint8(1) << (at & 7).astype(np.uint8))
    bits = bits.view(np.uint64)
    node, comp, n = (pdf[c].to_numpy() for c in ("node", "comp", "n"))
    outer, inner = np.flatnonzero(pdf["outer"]), np.flatnonzero(pdf["inner"])
    found, step = [], max(1, (1 << 22) // max(bits.shape[1], 1))
    for x in outer:
        most = np.minimum(size[x], size[inner])
        ys = inner[(comp[inner] != comp[x]) & (100 * most >= PERCENT * (n[x] + n[inner] - most))]
        for k in range(0, len(ys), step):
            y = ys[k : k + step]
            i = np.bitwise_count(bits[y] & bits[x]).sum(1, dtype=np.int64)
            y = y[100 * i >= PERCENT * (n[x] + n[y] - i)]
            # One link to each other class says the same as all of them.
            found += [(node[x], node[z]) for z in y[np.unique(comp[y], return_index=True)[1]]]
    return pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)


def settled(active: DataFrame, nodes: DataFrame, sets: DataFrame, comps: DataFrame, block: int = BLOCK, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """comps after all pairs of one bucket and different classes are settled."""
    rows = active.join(comps, "node")
    mixed = rows.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("bucket")
    rows = staged(rows.join(mixed, "bucket"), "near-mixed")
    shingles = rows.select("node", "comp").distinct().join(sets, "node").select("node", "comp", F.explode("set").alias("s"))
    shared = shingles.groupBy("s").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("s")
    cut = shingles.join(shared, "s").groupBy("node").agg(F.collect_list("s").alias("set"))  # no more than the text's own
    cut = cut.join(nodes.select("node", "n"), "node").where(100 * F.size("set") >= PERCENT * F.col("n"))
    cut = staged(cut.select("node", "n", F.size("set").alias("d"), packed("set").alias("set")), "near-shared")
    rows = staged(rows.join(cut.select("node", "d"), "node"), "near-left")
    classes = rows.groupBy("bucket", "comp").agg(F.count("*").alias("c"), F.sum("d").alias("d"))
    sums = classes.groupBy("bucket").agg(F.max(F.struct("c", "comp", "d")).alias("top"), F.sum("c").alias("c"), F.sum("d").alias("d"), F.count("*").alias("classes")).where("classes > 1")
    blocks = lambda c, d: F.ceil(F.greatest(c / block, d / block_shingles)).cast("int")
    sums = sums.select("bucket", F.col("top.comp").alias("largest"), blocks(F.col("c"), F.col("d")).alias("inner_blocks"), blocks(F.col("c") - F.col("top.c"), F.col("d") - F.col("top.d")).alias("outer_blocks"))
    placed = rows.join(sums, "bucket").withColumns({"h": F.xxhash64("node", F.lit(3)), "out": F.col("comp") != F.col("largest")})
    own_inner, own_outer = F.pmod("h", F.col("inner_blocks")).cast("int"), F.pmod("h", F.col("outer_blocks")).cast("int")
    tile = lambda i, o, inner, outer: F.struct(i.alias("i"), o.alias("o"), inner.alias("inner"), outer.alias("outer"))
    yes, no = F.lit(True), F.lit(False)
    as_inner = F.transform(F.sequence(F.lit(0), F.col("outer_blocks") - 1), lambda o: tile(own_inner, o, yes, F.col("out") & (own_outer == o)))
    as_outer = F.transform(F.filter(F.sequence(F.lit(0), F.col("inner_blocks") - 1), lambda i: F.col("out") & (i != own_inner)), lambda i: tile(i, own_outer, no, yes))
    tiles = placed.select("bucket", "node", "comp", F.explode(F.concat(as_inner, as_outer)).alias("t")).select("bucket", "t.*", "node", "comp")
    tiles = tiles.join(cut.select("node", "n", "set"), "node")
    return _joined(comps, tiles.groupBy("bucket", "i", "o").applyInPandas(_links, "a long, b long"))


@F.arrow_udf(T.BinaryType())
def packed(values: pa.Array) -> pa.Array:
    """Each list of longs as bytes."""
    ends = values.offsets.to_numpy()
    flat = np.asarray(values.values.to_numpy(zero_copy_only=False), np.int64)
    return pa.array([flat[a:b].tobytes() for a, b in zip(ends, ends[1:])], pa.binary())


def row_classes(docs: DataFrame, leaders: int = LEADERS, **blocks: int) -> DataFrame:
    """doc_id, fp (hash of the text), n and rep of each row of docs; rep (doc_id, fp): the row that stands for the class, null where n is 0 or the id null."""
    key = secrets.token_bytes(16)
    rows = docs.select("doc_id", F.xxhash64(text_or_empty()).alias("fp"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    sketches = rows.mapInArrow(_sketches(key), f"doc_id {kind}, fp long, n long, d0 long, d1 long, registers binary")
    sketches = staged(sketches.withColumn("uid", F.monotonically_increasing_id()), "near-sketches")
    digest = ["n", "d0", "d1"]
    own = F.min(F.struct("doc_id", "fp")).alias("rep")
    nodes = staged(sketches.where("n > 0 AND doc_id IS NOT NULL").groupBy(*digest).agg(F.min("uid").alias("node"), own, F.min("registers").alias("registers")), "near-nodes")
    bands = F.transform(F.sequence(F.lit(0), F.lit(REGISTERS // BAND - 1)), lambda b: F.xxhash64(F.substring("registers", b * (2 * BAND) + 1, F.lit(2 * BAND)), b))
    members = nodes.select("node", F.explode(bands).alias("bucket"))
    shared = members.groupBy("bucket").agg(F.count("*").alias("c")).where("c > 1").select("bucket")
    active = staged(members.join(shared, "bucket"), "near-members")
    some = staged(active.select("node").distinct().join(nodes, "node"), "near-active")
    comps = staged(some.select("node", F.col("node").alias("comp")), "near-comps")
    wanted = some.select("rep.doc_id", "rep.fp", "node")
    texts = with_flag(rows, ["doc_id", "fp"], wanted, "_wanted").where("_wanted").select("doc_id", "fp", "text").dropDuplicates(["doc_id", "fp"])
    sets = staged(texts.join(wanted, ["doc_id", "fp"]).select("node", full_sets(key)("text").alias("set")), "near-sets")
    comps = settled(active, some, sets, led(active, some, sets, comps, leaders), **blocks)
    joined = staged(some.join(comps, "node").select(*digest, "comp", "rep"), "near-joined")
    top = joined.groupBy("comp").agg(F.min("rep").alias("_rep"))
    classes = nodes.select(*digest, "rep").join(joined.join(top, "comp").select(*digest, "_rep"), digest, "left").select(*digest, F.coalesce("_rep", "rep").alias("rep"))
    out = sketches.drop("registers").join(staged(classes, "near-classes"), digest, "left")
    return out.select("doc_id", "fp", "n", F.when(F.col("doc_id").isNotNull(), F.col("rep")).alias("rep"))


def near_classes(docs: DataFrame, leaders: int = LEADERS, **blocks: int) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id, kept."""
    out = row_classes(docs, leaders, **blocks).select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("rep.doc_id", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """docs with one document of each class, the one with the smallest id."""
    gone = row_classes(docs).where((F.col("doc_id") != F.col("rep.doc_id")) | (F.col("fp") != F.col("rep.fp"))).select("doc_id", "fp").distinct()
    gone = staged(gone, "near-gone")
    fp, flag = unused_name("_fp", docs), unused_name("_flag", docs)
    rows = with_flag(docs.withColumn(fp, F.xxhash64(text_or_empty())), ["doc_id", fp], gone, flag)
    gone = gone.select(F.col("doc_id").alias(f"{fp}i"), F.col("fp").alias(f"{fp}h"))
    sure, rest = rows.where(~F.col(flag)), rows.where(F.col(flag))
    rest = rest.join(gone, (rest["doc_id"] == gone[f"{fp}i"]) & (rest[fp] == gone[f"{fp}h"]), "left_anti")
    return sure.unionByName(rest).select(*docs.columns)


def op6_setsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(table(spark, sf_dir, "documents"))
