"""Spelling variants: words of a corpus within one edit of each other, by automata read from both ends.

1. Words: maximal runs of letters, lower-cased A-Z, counted a batch first and then over the corpus. Damage (for tests
   of recall) drops one letter of runs that a hash picks. Words of `SHORTEST` code points and `LEAST` occurrences stay.
2. Regions: if two words differ by one edit, the edit lies in one half of the first, and the other half is matched
   exactly: as a prefix or as a suffix. So each word asks two regions, (0, half) and (half, end), and may be the answer
   to regions of words of its own length, one more or one less; the key of a region is what lies around it. Keys with
   over `GROUP` possible answers are asked by halves of their region instead (again, until the region is one letter),
   so a prefix that a third of all words begin with makes no large group. No pair of words becomes a row unless it is
   one edit apart.
3. Automata: a task reads its regions in the order of their keys, `CHUNK` answers at a time, and builds one minimal
   acyclic automaton of the answers, of the words as they are or read backwards. States count the words below them, so
   a walk gives a word's number (a minimal perfect hash), which finds its count in an array. A word walks what lies
   before its region exactly, then takes one error, and must reach the end.
4. Links are deduplicated over both directions. A word's form is its most frequent neighbour (ties: the smallest) if
   that has `RATIO` times its occurrences. Roots follow forms by pointer jumping; counts grow fivefold a step, so a
   chain has some 25 steps at most.

Defined cases: null texts have no words; a null id counts as an empty one in the damage; rows with one id are rows of
their own; very long texts are read by pieces; other columns aren't read; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import staged, table, with_flag

RUN, NO_RUN = re.compile("[A-Za-zÀ-ÿ]+"), re.compile("[^A-Za-zÀ-ÿ]")
SHORTEST, LEAST, RATIO, DAMAGE = 6, 5, 5, 199
GROUP, CHUNK, PIECE = 2000, 20_000, 1 << 20


def runs(text: str) -> Iterator[list[str]]:
    """The runs of letters of a text, a piece at a time, lower-cased A-Z."""
    at = 0
    while at < len(text):
        end = NO_RUN.search(text, min(at + PIECE, len(text)))
        end = end.start() if end else len(text)
        yield RUN.findall(text[at:end].encode().lower().decode())
        at = end + 1


def damaged(prefix: int, run: str, damage: int) -> str:
    """run, or run without one code point if damage divides the crc32 of `<doc_id>:<run>`; prefix: the crc32 of `<doc_id>:`."""
    h = zlib.crc32(run.encode(), prefix)
    if h % damage:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1 :]


def _counts(shortest: int, damage: int | None):
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """doc_id (text), text -> word, n of a batch."""
        total: Counter = Counter()
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                own: Counter = Counter()
                for piece in runs(text or ""):
                    own.update(piece)
                prefix = zlib.crc32(f"{doc_id or ''}:".encode())
                for run, n in own.items():
                    if len(run) >= shortest:
                        word = damaged(prefix, run, damage) if damage else run
                        if len(word) >= shortest:
                            total[word] += n
            if len(total) > 200_000:
                yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"])
                total = Counter()
        yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"])

    return counted


def vocabulary(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST, damage: int | None = None) -> DataFrame:
    """word, n: the words of at least `shortest` code points with at least `least` occurrences."""
    rows = docs.select(F.col("doc_id").cast("string"), "text")
    return rows.mapInArrow(_counts(shortest, damage), "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


class Automaton:
    """Minimal acyclic automaton of sorted words; the number of a word is its place in their order."""

    def __init__(self, words: list[str]) -> None:
        # By state: does a word end here; words below; letter -> (state, words of this state before that branch).
        self.final, self.below, self.next = [False], [0], [{}]
        self._known: dict[tuple, int] = {}
        path, previous = [0], ""
        for word in words:
            k = 0
            while k < len(previous) and k < len(word) and previous[k] == word[k]:
                k += 1
            self._close(path, previous, k)
            for c in word[k:]:
                self.final.append(False)
                self.below.append(0)
                self.next.append({})
                self.next[path[-1]][c] = len(self.next) - 1
                path.append(len(self.next) - 1)
            self.final[path[-1]] = True
            previous = word
        self._close(path, previous, 0)
        self._number(0)

    def _close(self, path: list[int], word: str, k: int) -> None:
        """Nothing more comes below the path's states after the first k letters: equal ones are merged."""
        while len(path) > k + 1:
            state = path.pop()
            self._number(state)
            same = self._known.setdefault((self.final[state], *self.next[state].items()), state)
            self.next[path[-1]][word[len(path) - 1]] = same

    def _number(self, state: int) -> None:
        n = int(self.final[state])
        for c, t in self.next[state].items():
            self.next[state][c] = (t, n)
            n += self.below[t]
        self.below[state] = n

    def walk(self, state: int, number: int, letters: str) -> tuple[int, int]:
        """State (-1: none) and number after the letters."""
        for c in letters:
            step = self.next[state].get(c)
            if step is None:
                return -1, 0
            state, number = step[0], number + step[1]
        return state, number

    def one_error(self, word: str, start: int, end: int) -> list[int]:
        """Numbers of the words that differ from word by one letter more, less or other, between start and end."""
        found: list[int] = []
        state, number = self.walk(0, 0, word[:start])
        for i in range(start, end + 1):
            if state < 0:
                break
            tail, rest = word[i:], word[i + 1 :]
            for c, (t, before) in self.next[state].items():
                self._finish(found, t, number + before, tail)  # one letter more
                if i < end and c != word[i]:
                    self._finish(found, t, number + before, rest)  # another
            if i < end:
                self._finish(found, state, number, rest)  # one less
                state, number = self.walk(state, number, word[i])
        return found

    def _finish(self, found: list[int], state: int, number: int, letters: str) -> None:
        state, number = self.walk(state, number, letters)
        if state >= 0 and self.final[state]:
            found.append(number)


def _linked(answers: dict[str, int], asks: list[tuple[str, int, int]], backward: bool) -> pa.RecordBatch:
    spelt = sorted(answers)
    counts = np.array([answers[w] for w in spelt], np.int64)  # by word number
    automaton = Automaton(spelt)
    rows = dict.fromkeys((word, k) for word, start, end in asks for k in automaton.one_error(word, start, end))
    turn = (lambda w: w[::-1]) if backward else (lambda w: w)
    number = np.array([k for _, k in rows], np.int64)
    columns = [pa.array([turn(w) for w, _ in rows], pa.string()), pa.array([turn(spelt[k]) for k in number], pa.string()), pa.array(counts[number])]
    return pa.RecordBatch.from_arrays(columns, ["word", "near", "near_n"])


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (backward, key, word, n, ask, before, after), ordered by the first two -> links word, near, near_n.

    before, after: the letters of word around the region that it asks.
    """
    answers: dict[str, int] = {}
    asks: list[tuple[str, int, int]] = []
    last = None
    for b in batches:
        for backward, key, word, n, ask, before, after in zip(*(c.to_pylist() for c in b.columns)):
            full = len(answers) >= CHUNK or len(asks) >= CHUNK
            if last is not None and (backward != last[0] or full and key != last[1]):
                yield _linked(answers, asks, last[0])
                answers, asks = {}, []
            last = backward, key
            spelt, before, after = (word[::-1], after, before) if backward else (word, before, after)
            if ask:
                asks.append((spelt, before, len(word) - after))
            else:
                answers[spelt] = n
    if last is not None:
        yield _linked(answers, asks, last[0])


def _keyed(rows: DataFrame) -> DataFrame:
    """rows (word, n, ask, size, before, after) with the key of their region: what lies around it."""
    around = F.concat_ws("|", F.expr("left(word, before)"), F.expr("right(word, after)"))
    return rows.withColumns({"backward": F.col("after") > F.col("before"), "key": around})


def regions(words: DataFrame, shortest: int, group: int = GROUP) -> DataFrame:
    """Asks and answers of all words by region; no key but those of one-letter regions has over `group` answers."""
    n = F.length("word")
    role = lambda size, ask: F.struct(size.alias("size"), F.lit(ask).alias("ask"))
    roles = F.filter(F.array(role(n, True), role(n - 1, False), role(n, False), role(n + 1, False)), lambda r: r["size"] >= shortest)
    half = F.floor(F.col("size") / 2).cast("int")
    sides = F.array(F.struct(half.alias("before"), F.lit(0).alias("after")), F.struct(F.lit(0).alias("before"), (F.col("size") - half).alias("after")))
    rows = words.select("word", "n", F.inline(roles)).select("word", "n", "ask", "size", F.inline(sides))
    rows, done = staged(_keyed(rows), "spelling-regions"), []
    wide = F.col("size") - F.col("before") - F.col("after") > 1
    while True:
        large = staged(rows.where(wide & ~F.col("ask")).groupBy("key", "size").count().where(F.col("count") > group), "spelling-large")
        if not large.limit(1).count():
            return _all([*done, rows])
        flagged = staged(with_flag(rows, ["key", "size"], large, "large").withColumn("large", F.col("large") & wide), "spelling-flagged")
        done.append(flagged.where("NOT large").drop("large"))
        mid = F.col("before") + F.floor((F.col("size") - F.col("before") - F.col("after")) / 2).cast("int")
        parts = F.array(F.struct(mid.alias("before"), F.col("after").alias("after")), F.struct(F.col("before").alias("before"), (F.col("size") - mid).alias("after")))
        rows = staged(_keyed(flagged.where("large").select("word", "n", "ask", "size", F.inline(parts))), "spelling-regions")


def _all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def links(words: DataFrame, shortest: int = SHORTEST, group: int = GROUP) -> DataFrame:
    """word, near, near_n: every ordered pair of words one edit apart, once. words: word, n."""
    rows = staged(regions(words, shortest, group), "spelling-asked")
    parts = max(int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows.count() // (5 * CHUNK))
    dealt = rows.select("backward", "key", "word", "n", "ask", "before", "after").repartition(parts, "backward", "key").sortWithinPartitions("backward", "key")
    return dealt.mapInArrow(_neighbours, "word string, near string, near_n long").dropDuplicates(["word", "near"])


def roots(forms: DataFrame) -> DataFrame:
    """word, root: the end of each word's chain of forms. forms: word, form."""
    now = staged(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "spelling-roots")
    while now.where("moved").limit(1).count():
        ahead = now.select(F.col("word").alias("_at"), F.col("root").alias("_on"))
        found = now.join(ahead, now["root"] == ahead["_at"], "left")
        now = staged(found.select("word", F.coalesce("_on", "root").alias("root"), F.col("_on").isNotNull().alias("moved")), "spelling-roots")
    return now.select("word", "root")


def variants(words: DataFrame, shortest: int = SHORTEST, ratio: int = RATIO, group: int = GROUP) -> DataFrame:
    """words (word, n) with form, root, n_near, form_n."""
    words = staged(words.select("word", "n"), "spelling-words")
    best = links(words, shortest, group).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word"))).alias("top"))
    found = words.join(best, "word", "left").withColumn("fits", -F.col("top.n") >= ratio * F.col("n"))
    found = found.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(F.col("fits"), F.col("top.word")).alias("form"), F.when(F.col("fits"), -F.col("top.n")).alias("form_n"))
    found = staged(found, "spelling-forms")
    ends = roots(found.where("form IS NOT NULL"))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_two_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(vocabulary(table(spark, sf_dir, "documents"), damage=DAMAGE))
