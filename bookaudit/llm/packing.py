"""Packing by lexical retrieval.

1. Texts become token ids once; each document ends with id 0. Document frequencies of all ids are counted over
   the whole corpus (at most one number an id of the vocabulary).
2. Every document is routed by its BM25 weights, projected to `DIMENSIONS` numbers: to the nearest of k-means
   centroids over the whole corpus, fitted on a sample and numbered so that near ones follow one another. The
   sample's share of each cluster deals neighbouring clusters to tasks; a cluster over a task's share is split by a
   hash. A task orders its documents by centroid, second nearest centroid and ids, and cuts them into shards of
   bounded tokens, so neighbours meet wherever they lie.
3. Each shard has a BM25 inverted index over token ids, with the corpus's document frequencies and mean length.
4. A window's seed - its first document, or the rest of one cut at the last window's end - asks the index, with its
   `QUERY_TERMS` rarest terms that unused documents have, for its nearest unused documents, which fill the window greedily, and asks again when these run out; where none
   is left, the next unused one does. A document that doesn't fit is cut; its rest opens and seeds the next
   window. A window open at a shard's end goes on with the next shard, so each task pads one window at most.

Neighbours that the routing sends to another shard aren't found; the README has the measured share.

Defined cases: a null text is the empty text (the one id 0); any id, repeated rows too, is a document of its
own; an empty table gives no rows; other columns aren't read.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import staged, table

SEQUENCE, VOCABULARY, END = 1024, 50_257, 0
SHARD_TOKENS = 1 << 21
#: Terms of a query, and answers read at once: a seed asks again, with the next terms too, until no unused document shares one.
QUERY_TERMS, NEIGHBOURS = 24, 64
#: Centroids a shard and at most (beyond, shards are ranges within a cluster); sampled documents a centroid; rounds of k-means.
DIMENSIONS, CENTROIDS, MOST_CENTROIDS, SAMPLED, ROUNDS = 128, 2, 4096, 32, 10
#: Shards a task.
TASK_SHARDS = 2
K1, B = 1.2, 0.75


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


#: Fixed value: the word pattern of the file's pre-tokenizer (byte level, with its own pattern).
WORD_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Runs of white space from this length on go to the file's tokenizer; the faster one's pattern looks ahead by recursion.
WHITE_RUN = 4096


class TextTokenizer:
    """The ids that `tokenizers` gives with the file, without special tokens added.

    Most texts take the same merges and word pattern through `tiktoken`, which is about five times as fast; the tests
    hold both equal over every code point. Texts with an added token of the file (such as <|endoftext|>) or a very
    long run of white space go to `tokenizers` itself.
    """

    def __init__(self, path: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(path) as f:
            vocabulary = json.load(f)["model"]["vocab"]
        # Byte-level vocabularies write bytes as letters: printable ones as they are, the others from U+0100 on.
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [b for b in range(256) if b not in printable]
        byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(other)}
        ranks = {bytes(map(byte.__getitem__, t)): i for t, i in vocabulary.items() if t not in self.added}
        self.fast = tiktoken.Encoding("words", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.white = re.compile(r"\s{%d}" % WHITE_RUN)

    def __call__(self, text: str) -> list[int]:
        if any(t in text for t in self.added) or (len(text) >= WHITE_RUN and self.white.search(text)):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        return self.fast(text)


_TOKENIZERS: dict[str, TextTokenizer] = {}


def text_tokenizer(path: str) -> TextTokenizer:
    """One for each file and process."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = TextTokenizer(path)
    return _TOKENIZERS[path]


def as_bytes(ids: list[int]) -> bytes:
    """A document's ids and its end as little-endian 16-bit numbers."""
    return struct.pack(f"<{len(ids) + 1}H", *ids, END)


def _tokenized(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        ids_of = text_tokenizer(path)
        for b in batches:
            for at in range(0, len(b), 256):
                part = b.slice(at, 256)
                ids = [as_bytes(ids_of(t or "")) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    return run


def token_ids(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """(doc_id, ids): little-endian 16-bit ids of each whole text, then id 0."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_tokenized(tokenizer or default_tokenizer()), f"doc_id {kind}, ids binary")


_PLACES = np.zeros(1 << 16, np.int32)


def distinct(ids: np.ndarray) -> np.ndarray:
    """The different ids of a document, in the order of their last occurrences; no sort."""
    places, at = ids.astype(np.intp), np.arange(len(ids), dtype=np.int32)
    _PLACES[places] = at
    return ids[_PLACES[places] == at]


def counted(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(different ids, occurrences of each)."""
    terms = distinct(ids)
    _PLACES[terms] = np.arange(len(terms))
    return terms, np.bincount(_PLACES[ids], minlength=len(terms))


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df = np.zeros(VOCABULARY, np.int64)
    for b in batches:
        for ids in b.column(0):
            df[distinct(np.frombuffer(ids.as_buffer(), "<u2"))] += 1
    some = np.flatnonzero(df)
    yield pa.RecordBatch.from_pydict({"id": pa.array(some), "df": pa.array(df[some])})


_PROJECTION: list[np.ndarray] = []


def projected(docs: list[np.ndarray], idf: np.ndarray, mean: float) -> np.ndarray:
    """One row a document: its BM25 weights by token id, projected at random."""
    if not _PROJECTION:
        _PROJECTION.append(np.random.default_rng(20240608).standard_normal((VOCABULARY, DIMENSIONS), np.float32))
    out = np.zeros((len(docs), DIMENSIONS), np.float32)
    for i, ids in enumerate(docs):
        terms, tf = counted(ids)
        weight = idf[terms] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(ids) / mean))
        out[i] = weight.astype(np.float32) @ _PROJECTION[0][terms]
    return out


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)


def centroids_of(sample: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(mean, centroids): spherical k-means of the sample less its mean; each centroid is followed by the nearest one that is left."""
    center = sample.mean(0)
    vectors = _unit(sample - center)
    rng = np.random.default_rng(7)
    found = vectors[rng.choice(len(vectors), min(k, len(vectors)), replace=False)]
    for _ in range(ROUNDS):
        at = np.concatenate([(part @ found.T).argmax(1) for part in np.array_split(vectors, len(vectors) // 4096 + 1)])
        order = np.argsort(at, kind="stable")
        some, cuts = np.unique(at[order], return_index=True)
        found[some] = _unit(np.add.reduceat(vectors[order], cuts))
    left, chain = np.ones(len(found), bool), [0]
    for _ in range(len(found) - 1):
        left[chain[-1]] = False
        chain.append(int(np.where(left, found @ found[chain[-1]], -np.inf).argmax()))
    return center, found[chain]


def _sampled(idf: np.ndarray, mean: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            docs = [np.frombuffer(x.as_buffer(), "<u2") for x in b.column(0)]
            vectors = projected(docs, idf, mean)
            yield pa.RecordBatch.from_arrays([pa.array([v.tobytes() for v in vectors], pa.binary()), pa.array([len(d) for d in docs])], names=["vector", "tokens"])

    return run


def dealt(share: np.ndarray, tasks: int) -> tuple[np.ndarray, np.ndarray]:
    """First task and number of tasks of each cluster, in order: about 1 / tasks of the tokens each."""
    before = np.concatenate([[0.0], np.cumsum(share)]) * tasks
    first = np.minimum(before[:-1].astype(np.int64), tasks - 1)
    last = np.minimum(np.maximum(np.ceil(before[1:] - 1e-9).astype(np.int64) - 1, first), tasks - 1)
    alone = share * tasks <= 1  # such a cluster stays whole, where its middle lies
    middle = np.minimum(((before[:-1] + before[1:]) / 2).astype(np.int64), tasks - 1)
    return np.where(alone, middle, first), np.where(alone, 1, last - first + 1)


def _routed(idf: np.ndarray, mean: float, center: np.ndarray, centroids: np.ndarray, first_task: np.ndarray, n_tasks: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, len(b), 256):
                part = b.slice(at, 256)
                vectors = projected([np.frombuffer(x.as_buffer(), "<u2") for x in part.column(1)], idf, mean)
                near = _unit(vectors - center) @ centroids.T
                rows = np.arange(len(near))
                first = near.argmax(1)
                near[rows, first] = -np.inf
                h = part.column(2).to_numpy(zero_copy_only=False)
                task = first_task[first] + h % n_tasks[first]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(first), pa.array(near.argmax(1)), pa.array(task.astype(np.int32))], names=["doc_id", "ids", "h", "cluster", "second", "task"])

    return run


def routed(tokens: DataFrame, n: int, total: int, idf: np.ndarray, mean: float) -> DataFrame:
    """(doc_id, ids, cluster) in tasks of similar documents, in their order; n documents of total ids."""
    shards = -(-total // SHARD_TOKENS)
    k = min(max(1, CENTROIDS * shards), MOST_CENTROIDS) if shards > 1 else 1
    out = tokens.select("doc_id", "ids")
    if k == 1:
        return out.select("doc_id", "ids", F.lit(0).cast("long").alias("cluster")).coalesce(1)
    parts = max(1, n // (SAMPLED * k))
    out = out.withColumn("h", F.xxhash64(F.monotonically_increasing_id(), F.lit(5)))  # by row: equal rows are drawn and dealt apart
    some = out.where(F.pmod("h", F.lit(parts)) == 0).select("ids")  # about SAMPLED a centroid, and never over twice as many
    sample = some.mapInArrow(_sampled(idf, mean), "vector binary, tokens long").limit(2 * SAMPLED * k).toArrow()
    vectors = np.frombuffer(b"".join(sample["vector"].to_pylist()), np.float32).reshape(-1, DIMENSIONS)
    if not len(vectors):  # next to impossible: one cluster
        vectors, sample = np.zeros((1, DIMENSIONS), np.float32), pa.table({"tokens": [1]})
    center, centroids = centroids_of(vectors, k)
    at = np.concatenate([(x @ centroids.T).argmax(1) for x in np.array_split(_unit(vectors - center), len(vectors) // 4096 + 1)])
    share = np.bincount(at, weights=sample["tokens"].to_numpy(), minlength=len(centroids))
    tasks = -(-shards // TASK_SHARDS)
    first, many = dealt(share / share.sum(), tasks)
    kind = tokens.schema["doc_id"].dataType.simpleString()
    out = out.select("doc_id", "ids", "h").mapInArrow(_routed(idf, mean, center, centroids, first, many), f"doc_id {kind}, ids binary, h long, cluster long, second long, task int")
    return out.repartitionById(tasks, "task").sortWithinPartitions("cluster", "second", "h").select("doc_id", "ids", "cluster")


class Shard:
    """An inverted index over one shard's documents."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean: float) -> None:
        self.n, self.idf = len(docs), idf
        sizes = np.array([len(d) for d in docs])
        every, owner = np.concatenate(docs), np.repeat(np.arange(self.n), sizes)
        order = np.argsort(every, kind="stable")  # by term, and by document within a term
        every, owner = every[order], owner[order]
        new = np.flatnonzero(np.concatenate([[True], (every[1:] != every[:-1]) | (owner[1:] != owner[:-1])]))
        term, self.doc, tf = every[new], owner[new], np.diff(np.append(new, len(every)))
        self.weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * sizes[self.doc] / mean))
        self.start = np.searchsorted(term, np.arange(VOCABULARY + 1))

    def nearest(self, ids: np.ndarray, used: np.ndarray) -> list[int]:
        """Unused documents with the best BM25 score for the rarest terms of ids that unused documents have."""
        terms = distinct(ids)
        terms = terms[np.lexsort((terms, -self.idf[terms]))]
        chosen = []
        for t in terms.tolist():
            span = slice(self.start[t], self.start[t + 1])
            if span.stop > span.start and not used[self.doc[span]].all():
                chosen.append(span)
                if len(chosen) == QUERY_TERMS:
                    break
        if not chosen:
            return []
        scores = np.bincount(np.concatenate([self.doc[s] for s in chosen]), weights=np.concatenate([self.weight[s] for s in chosen]), minlength=self.n)
        scores[used] = 0
        k = min(NEIGHBOURS, self.n)
        top = np.argpartition(-scores, k - 1)[:k]
        top = top[scores[top] > 0]
        return top[np.lexsort((top, -scores[top]))].tolist()


class Packer:
    """Windows of one task; pieces are (doc, start, length, crc, doc tokens, sequence, offset)."""

    def __init__(self, first_sequence: int, idf: np.ndarray, mean: float) -> None:
        self.sequence, self.offset, self.seed = first_sequence, 0, None
        self.idf, self.mean = idf, mean

    def place(self, doc: int, ids: np.ndarray, out: list) -> None:
        at = 0
        while at < len(ids):
            piece = ids[at : at + SEQUENCE - self.offset]
            if self.offset == 0:
                self.seed = ids
            out.append((doc, at, len(piece), zlib.crc32(piece.astype("<u4").tobytes()), len(ids), self.sequence, self.offset))
            at, self.offset = at + len(piece), self.offset + len(piece)
            if self.offset == SEQUENCE:
                self.sequence, self.offset = self.sequence + 1, 0
                self.seed = None

    def pack(self, docs: list[np.ndarray]) -> list:
        """Places every document of a shard once."""
        shard, used, out, following = Shard(docs, self.idf, self.mean), np.zeros(len(docs), bool), [], 0
        near: list[int] = []
        asked = None
        for _ in range(len(docs)):
            if self.seed is not None and (asked is not self.seed or not near):  # another seed, or its list has run out
                near, asked = shard.nearest(self.seed, used)[::-1], self.seed
            if self.seed is not None and near:
                doc = near.pop()
            else:
                while used[following]:
                    following += 1
                doc = following
            used[doc] = True
            self.place(doc, docs[doc], out)
        return out


def shards_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[np.ndarray]]]:
    """(doc_ids, their token ids) a shard: cut between clusters once half full, else where it is full."""
    doc_ids, docs, tokens, last = [], [], 0, None
    for b in batches:
        for i, (ids, cluster) in enumerate(zip(b.column(1), b.column(2).to_pylist())):
            if tokens >= SHARD_TOKENS or (cluster != last and 2 * tokens >= SHARD_TOKENS):
                yield pa.concat_arrays(doc_ids), docs
                doc_ids, docs, tokens = [], [], 0
            doc_ids.append(b.column(0).slice(i, 1))
            docs.append(np.frombuffer(ids.as_buffer(), "<u2"))
            tokens, last = tokens + len(docs[-1]), cluster
    if docs:
        yield pa.concat_arrays(doc_ids), docs


def _packed(idf: np.ndarray, mean: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(TaskContext.get().partitionId() << 40, idf, mean)
        for doc_ids, docs in shards_of(batches):
            rows = list(zip(*packer.pack(docs)))
            columns = [doc_ids.take(pa.array(rows[0], pa.int64())), *(pa.array(r, pa.int64()) for r in rows[1:])]
            yield pa.RecordBatch.from_arrays(columns, names=PIECE)

    return run


PIECE = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def packed_pieces(tokens: DataFrame) -> DataFrame:
    """The pieces of every document; tokens is a result of token_ids that was written once."""
    ways = corpus_weights(tokens)
    kind = tokens.schema["doc_id"].dataType.simpleString()
    return routed(tokens, *ways).mapInArrow(_packed(*ways[2:]), f"doc_id {kind}, " + ", ".join(f"{c} long" for c in PIECE[1:]))


def corpus_weights(tokens: DataFrame) -> tuple[int, int, np.ndarray, float]:
    """Documents, ids, each id's inverse document frequency, mean length."""
    n, total = tokens.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("ids")), F.lit(0)) / 2).first()
    counted = tokens.select("ids").mapInArrow(_frequencies, "id long, df long").groupBy("id").agg(F.sum("df").alias("df")).toArrow()
    df = np.zeros(VOCABULARY)  # one number an id of the vocabulary
    df[counted["id"].to_numpy()] = counted["df"].to_numpy()
    idf = np.log1p((n - df + 0.5) / (df + 0.5)) + 1e-9
    return n, int(total), idf, total / max(n, 1)


def pack_documents(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    return packed_pieces(staged(token_ids(docs, tokenizer), "pack-tokens"))


def op2_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
