"""Quality rules, lines first: rules fail single lines, failed lines go, and documents that lose too much text go.

A text is split at \\n. A line with a word fails if one of these holds (w: its words, `[^\\x20\\x09-\\x0D]+`):

* punctuation: it has no sentence mark at all, or over half as many symbols `[#*$%&|<>]` as words, or `!!`, `??` in
  more than a fifth of its words;
* navigation: two words or more, and a fifth of all at least, are separators as between entries of a menu;
* boilerplate: it has at most `BOILERPLATE_WORDS` words and holds a phrase of notices and page furniture.

Lines without a word belong to no rule and stay. A document is rejected if the lines that failed held more than
`MOST_LOST` percent of its words, or if it fails the base: under `LEAST_WORDS` words, or more than `MOST_REPEATED`
percent of its words in five-word windows that occur twice or more in the text.

Words, lines and windows are compared exactly (as dictionary codes and ranks of tuples of codes), a slice of at most
1 MiB or one text at a time.

Defined cases: null and empty texts have no words and fail the base; rows with one id are rows of their own; a
null id stays null; other columns are kept whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table, unused_name
from .words import codes, slices, word_bounds

LEAST_WORDS, MOST_REPEATED, MOST_LOST = 10, 20, 50
WINDOW, BOILERPLATE_WORDS = 5, 40
SYMBOLS = "#*$%&|<>"
MARKS = (".", "!", "?", ";", ":", "…", "。", "！", "？", "।", "؟")
SEPARATORS = ("|", "/", ">", "»", "›", "•", "·", "::")
PHRASES = (
    "all rights reserved", "terms of use", "terms of service", "terms and conditions", "privacy policy", "cookie policy", "accept cookies", "use of cookies",
    "uses cookies", "enable javascript", "click here", "read more", "sign up", "sign in", "log in", "subscribe to our", "share this", "follow us on",
    "skip to content", "back to top", "powered by", "copyright ©", "copyright (c)", "© 20", "lorem ipsum",
)
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "lost_words", "lost_punctuation", "lost_navigation", "lost_boilerplate"]


def ranks(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Codes of pairs of codes."""
    return np.unique(a * (b.max(initial=0) + 1) + b, return_inverse=True)[1].astype(np.int64)


def repeated_words(word: np.ndarray, row: np.ndarray, n_rows: int) -> np.ndarray:
    """Per row: words in windows of five that occur twice or more in the row. word: codes; row: ascending."""
    n = len(word) - WINDOW + 1
    if n < 1:
        return np.zeros(n_rows, np.int64)
    two = ranks(word[:-1], word[1:])
    window = ranks(ranks(two[:-2], two[2:])[:n], word[WINDOW - 1 :])
    own = np.flatnonzero(row[:n] == row[WINDOW - 1 :])  # windows inside a row
    _, at, times = np.unique(window[own] * n_rows + row[own], return_inverse=True, return_counts=True)
    found = own[times[at] > 1]
    edge = np.zeros(len(word) + 1, np.int64)
    np.add.at(edge, found, 1)
    np.add.at(edge, found + WINDOW, -1)
    return np.bincount(row[np.cumsum(edge[:-1]) > 0], minlength=n_rows)


def _of(places: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """How many places lie in each of n consecutive spans."""
    return np.bincount(np.searchsorted(starts, places, side="right") - 1, minlength=n)


def _marks(data: np.ndarray) -> np.ndarray:
    """Places of sentence marks."""
    found = [np.flatnonzero(np.isin(data, np.frombuffer("".join(m for m in MARKS if m < "\x80").encode(), np.uint8)))]
    if data.max(initial=0) > 127:
        for m in (m.encode() for m in MARKS if m > "\x80"):
            hit = data[: max(len(data) - len(m) + 1, 0)] == m[0]
            for k in range(1, len(m)):
                hit = hit & (data[k : len(hit) + k] == m[k])
            found.append(np.flatnonzero(hit))
    return np.concatenate(found)


def line_stats(data: np.ndarray, offsets: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Counts of each row; start, end and fate (True: it stays) of each line."""
    n = len(offsets) - 1
    starts, ends, row = word_bounds(data, offsets)
    breaks = np.flatnonzero(data == 10)
    first = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    # A break at the end of a row begins a last, empty line there, which comes before the next row's.
    line_row = np.repeat(np.arange(n), 1 + _of(breaks, offsets[:-1], n) if n else 0)
    last = np.append(first[1:], len(data))
    last = last - np.append(line_row[1:] == line_row[:-1], [False])[: len(last)]  # without the break itself
    line = np.searchsorted(first, starts, side="right") - 1
    lines = len(first)
    words = np.bincount(line, minlength=lines)
    word, spelt = codes(data, starts, ends)
    symbols = np.flatnonzero(np.isin(data, np.frombuffer(SYMBOLS.encode(), np.uint8)))
    marks, symbol = _of(_marks(data), first, lines), _of(symbols, first, lines)
    is_separator = pc.is_in(spelt, pa.array([s.encode() for s in SEPARATORS], spelt.type)).to_numpy(zero_copy_only=False)
    is_loud = pc.or_(pc.match_substring(spelt, "!!"), pc.match_substring(spelt, "??")).to_numpy(zero_copy_only=False)
    separators, loud = (np.bincount(line[flag[word]], minlength=lines) if len(word) else np.zeros(lines, np.int64) for flag in (is_separator, is_loud))
    some = words > 0
    punctuation = some & ((marks == 0) | (2 * symbol > words) | (5 * loud > words))
    navigation = some & (separators >= 2) & (5 * separators >= words)
    short = np.flatnonzero(some & (words <= BOILERPLATE_WORDS))
    kind, spelling = codes(data, first[short], last[short])
    has = pc.match_substring_regex(spelling, "|".join(pc_quote(p) for p in PHRASES), ignore_case=True).to_numpy(zero_copy_only=False)
    boilerplate = np.zeros(lines, bool)
    boilerplate[short] = has[kind] if len(kind) else False
    stays = ~(punctuation | navigation | boilerplate)
    whole = np.flatnonzero(some)
    same, _ = codes(data, first[whole], last[whole])
    distinct = np.unique(same * n + line_row[whole])
    per_row = lambda flags: np.bincount(line_row[flags], minlength=n)
    letters = np.bincount(row, weights=ends - starts, minlength=n).astype(np.int64)
    tails = _of(np.flatnonzero((data & 0xC0) == 0x80), offsets[:-1], n) if n else 0  # all lie in words
    counts = {
        "n_words": np.bincount(row, minlength=n), "word_chars": letters - tails, "n_symbols": np.bincount(line_row, weights=symbol, minlength=n).astype(np.int64),
        "n_dup_lines": per_row(some) - np.bincount(distinct % n if n else distinct, minlength=n), "n_repeat_words": repeated_words(word, row, n), "n_lines": per_row(some),
        "lost_words": np.bincount(line_row, weights=words * ~stays, minlength=n).astype(np.int64), "lost_punctuation": per_row(punctuation), "lost_navigation": per_row(navigation), "lost_boilerplate": per_row(boilerplate),
    }
    return counts, np.stack([first, last]), line_row, stays


def pc_quote(phrase: str) -> str:
    """The phrase as a pattern; any white space between its words."""
    return r"\s+".join("".join(c if c.isalnum() or c > "\x80" else f"\\{c}" for c in w) for w in phrase.split())


def _texts(data: np.ndarray, spans: np.ndarray, line_row: np.ndarray, stays: np.ndarray, n: int) -> list[str]:
    """What is left of each row: the lines that stay, joined by \\n."""
    cut = np.searchsorted(line_row, np.arange(n + 1))
    whole = data.tobytes()
    left = lambda a, b: b"\n".join(whole[s:e] for s, e in spans[:, a:b][:, stays[a:b]].T)
    return [left(a, b).decode() for a, b in zip(cut, cut[1:])]


@F.arrow_udf(T.StructType([T.StructField(c, T.LongType()) for c in COUNTS] + [T.StructField("clean_text", T.StringType())]))
def _measured(text: pa.Array, with_text: pa.Array) -> pa.Array:
    counts, texts = {c: [np.zeros(0, np.int64)] for c in COUNTS}, []
    for lo, hi, data, offsets in slices(text):
        found, *lines = line_stats(data, offsets)
        for c in COUNTS:
            counts[c].append(found[c].astype(np.int64))
        texts += _texts(data, *lines, hi - lo) if with_text[lo].as_py() else [None] * (hi - lo)
    return pa.StructArray.from_arrays([pa.array(np.concatenate(counts[c])) for c in COUNTS] + [pa.array(texts, pa.string())], [*COUNTS, "clean_text"])


#: Not moved into a filter on its result, where it would be worked out once more.
_measured = _measured.asNondeterministic()


def line_report(docs: DataFrame, name: str, with_text: bool = True) -> DataFrame:
    """docs with a struct column: the counts, clean_text (null without with_text), base_failed and kept."""
    found = docs.withColumn(name, _measured("text", F.lit(with_text)))
    n = lambda c: F.col(f"`{name}`.{c}")
    base = (n("n_words") < LEAST_WORDS) | (100 * n("n_repeat_words") > MOST_REPEATED * n("n_words"))
    loses = 100 * n("lost_words") > MOST_LOST * n("n_words")
    return found.withColumn(name, F.col(f"`{name}`").withField("base_failed", base).withField("kept", ~base & ~loses))


def clean_lines(docs: DataFrame) -> DataFrame:
    """The documents that stay, with the lines that stay; the columns of docs."""
    name = unused_name("_lines", docs)
    kept = line_report(docs, name).where(f"`{name}`.kept")
    return kept.withColumn("text", F.col(f"`{name}`.clean_text")).select(*(F.col(f"`{c}`") for c in docs.columns))


def op11_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_report(docs, "lines", with_text=False).select("doc_id", *(f"lines.{c}" for c in COUNTS), "lines.base_failed", "lines.kept")


_WORDS = r"[^\x20\x09-\x0D]+"
_LIST = lambda values: ", ".join("'" + v.replace("'", "''") + "'" for v in values)
ORACLE = {
    "op11_line_rules": rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '{_WORDS}') AS ws, string_split(text, chr(10)) AS ls FROM d),
l AS (SELECT doc_id, line, regexp_extract_all(line, '{_WORDS}') AS lw FROM (SELECT doc_id, unnest(ls) AS line FROM w)),
s AS (
  SELECT doc_id, line, len(lw) AS words, length(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) AS symbols,
    len(list_filter(lw, lambda x: x IN ({_LIST(SEPARATORS)}))) AS seps, len(list_filter(lw, lambda x: contains(x, '!!') OR contains(x, '??'))) AS loud,
    regexp_matches(line, '[.!?;:…。！？।؟]') AS marked,
    regexp_matches(line, '(?i){"|".join(pc_quote(p) for p in PHRASES)}') AS phrase
  FROM l WHERE len(lw) > 0),
r AS (
  SELECT *, (NOT marked OR 2 * symbols > words OR 5 * loud > words) AS bad_p, (seps >= 2 AND 5 * seps >= words) AS bad_n, (words <= {BOILERPLATE_WORDS} AND phrase) AS bad_b FROM s),
t AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines, sum(CASE WHEN bad_p OR bad_n OR bad_b THEN words ELSE 0 END) AS lost_words,
    count_if(bad_p) AS lost_punctuation, count_if(bad_n) AS lost_navigation, count_if(bad_b) AS lost_boilerplate
  FROM r GROUP BY doc_id),
v AS (SELECT doc_id, i, ws[i:i + {WINDOW - 1}] AS win FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM w)),
x AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS c FROM v) WHERE c > 1),
y AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM x, range({WINDOW}) AS o(k) GROUP BY doc_id),
z AS (
  SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(lost_words, 0)::BIGINT AS lost_words,
    coalesce(lost_punctuation, 0)::BIGINT AS lost_punctuation, coalesce(lost_navigation, 0)::BIGINT AS lost_navigation, coalesce(lost_boilerplate, 0)::BIGINT AS lost_boilerplate
  FROM w LEFT JOIN t USING (doc_id) LEFT JOIN y USING (doc_id)),
b AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed FROM z)
SELECT *, NOT base_failed AND NOT (100 * lost_words > {MOST_LOST} * n_words) AS kept FROM b"""
}
