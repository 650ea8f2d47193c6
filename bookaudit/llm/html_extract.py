"""Main text of web pages by consensus paths of each host.

1. On each page, containers (elements that hold blocks of text) are scored by their text outside links; a block
   counts in full for its container, half for the next one up, a quarter for the one above.
2. The page's best container votes for its generalised path: tags and first classes from the body down, digits
   as `#`. Spark sums the votes by host and path.
3. Every page's blocks are read again with its host's `PATHS` strongest paths; the first path whose text here is at
   least `SHARE` of the page's own best score gives the main text. Pages of other templates, where no path of the host
   holds that much, use their own best container, the one they voted for.

Menus, headers, footers, sidebars, notices, adverts, forms and comments inside it are left out by tag, role and
class words; a <header> inside an article stays. Words of a name after `with`, `no` and the like say nothing of the
element. A name with other words too (related-work, form-factor) is noise only outside articles and with a second
sign: it holds under `DOUBTFUL` characters or a third of them in links. An element named as noise that holds the
page's heading or article and over `WHOLE` of its text is its content.
Defined cases: null html is empty and gives an empty text; a null url is the host ''; unclosed and stray tags are
tolerated, self-closed ones are empty, and embedded ones (svg, iframe, ...) that aren't closed end at the next block or
with their parent; pages without blocks give an empty text; repeated
rows are rows of their own; an empty table gives no rows; other columns aren't read.
"""

from __future__ import annotations

import html as htmllib
import re
from collections import Counter
from dataclasses import dataclass, field
from itertools import takewhile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import staged, table

#: By the rules of HTML: a quote opens a value only after `=`, and a tag that isn't closed runs to the end. No part is
#: ever given back, so each character is read once or twice, whatever the page.
_IN_TAG = r"""(?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+|["'])*+"""
TOKEN = re.compile(
    r"<(?:!--.*?(?:-->|\Z)|[!?][^>]*+(?:>|\Z)|(?:(script|style)\b" + _IN_TAG + r"(?<!/)>.*?(?:</\1\s*>|\Z))"
    r"|(?:(noscript|template|textarea|svg|iframe|select|object)\b" + _IN_TAG + r"(?<!/)>(?:(?!<\2\b).)*?</\2\s*>)"
    r"|(/?)([a-z][a-z0-9:-]*+)(" + _IN_TAG + r")(?:>|\Z))",
    re.S | re.I,
)
#: Of those above, the ones that reach the stack: self-closed, not closed, or around another one.
EMBEDDED = set("noscript template textarea svg iframe select object".split())
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
# Fixed values of HTML: elements without an end tag, and elements that begin a block.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6"
    " head header hgroup hr legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul caption".split()
)
CONTAINER = set("body article blockquote center details div main section table tbody tr td fieldset figure".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
NOISE_TAGS = set("head title nav footer aside form button menu dialog label legend".split())
NOISE_ROLES = set("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar note".split())
NOISE_WORDS = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs crumbs sidebar aside"
    " footer header masthead topbar comment comments disqus reply replies respond discussion cookie cookies consent gdpr notice notices alert popup modal overlay newsletter"
    " subscribe subscription signup login social share sharing related recommended recommendations widget toolbar pagination pager search form copyright disclaimer skip tracking".split()
)
#: Words that say where or how large an element is. A name is surely noise only if all its words are of these or of
#: those above: related-posts is, related-work isn't.
PLACE_WORDS = set(
    "area article articles bar block body bottom box button buttons card cards container content center column entry entries first footer global group headline header inner item items"
    " label last left link links list main media module news outer page pages panel post posts row right section site slot stories story text title top unit user users view wrap wrapper zone".split()
)
#: Of a name such as content-with-sidebar, only the words before these count.
TURNS = set("has with without no not is".split())
#: Share of a page's text.
WHOLE = 0.9
#: Elements within each other; deeper ones count as part of the one above them, as browsers do it.
DEPTH = 512
#: Characters from which an element that a word of its name alone calls noise is text, unless a third of them are links.
DOUBTFUL = 200
#: Paths a host, and the share of the page's best score that the text under one must have.
PATHS, SHARE = 64, 0.8
WORD = re.compile(r"[a-z]+|[A-Z][a-z]*")


@dataclass
class Element:
    tag: str
    noise: bool
    holder: int  # of its nearest container
    named: int = -1  # where the outermost element above begins that is noise by its names alone
    inside: bool = False  # an article


@dataclass
class Page:
    """Blocks of text in page order, and the containers above them."""

    parents: list[int] = field(default_factory=lambda: [-1])
    paths: list[str] = field(default_factory=lambda: [""])
    blocks: list[tuple[int, str, int]] = field(default_factory=list)  # container, text, characters in links


def _is_noise(tag: str, attributes: dict[str, str], above: list[Element], inside: bool) -> tuple[bool, bool]:
    """Is an element noise, and is that doubtful; inside: an article, or an element that was taken for one."""
    if tag in NOISE_TAGS or attributes.get("role", "").lower() in NOISE_ROLES:
        return True, False
    if tag == "header":
        return not any(e.tag in ("article", "main") for e in above), False
    if tag in ("html", "body", "main", "article"):
        return False, False
    doubtful = False
    for words in ([w.lower() for w in WORD.findall(n)] for n in f"{attributes.get('class', '')} {attributes.get('id', '')}".split()):
        words = list(takewhile(lambda w: w not in TURNS, words))
        if any(w in NOISE_WORDS for w in words):
            if all(w in NOISE_WORDS or w in PLACE_WORDS for w in words):
                return True, False
            doubtful = not inside
    return doubtful, doubtful


def read_page(source: str) -> Page:
    exempt: set[int] = set()
    while True:
        page, more = _read(source, exempt)
        if not more:
            return page
        exempt |= more


def _read(source: str, exempt: set[int]) -> tuple[Page, set[int]]:
    """The page, and where elements begin that are noise by their names but text by what they hold; exempt: such that aren't noise."""
    page, stack, parts, links, at = Page(), [], [], 0, 0
    # By where an element that is noise by its names begins: its characters, those in links; with a heading or article; unsure.
    dropped, linked, headed, unsure = Counter(), Counter(), set(), set()

    def close_block() -> None:
        nonlocal links
        if parts:
            text = " ".join(htmllib.unescape("".join(parts)).split())
            if text:
                page.blocks.append((stack[-1].holder if stack else 0, text, min(links, len(text))))
            parts.clear()
        links = 0

    def add(piece: str) -> None:
        nonlocal links
        if stack and stack[-1].named >= 0:
            dropped[stack[-1].named] += len(piece.strip())
            linked[stack[-1].named] += len(piece.strip()) * any(e.tag == "a" for e in stack[-4:])
        if piece and not (stack and stack[-1].noise):
            parts.append(piece)
            if any(e.tag == "a" for e in stack[-4:]):
                links += len(piece)

    def pop_to(index: int) -> None:
        if any(e.tag in BLOCK for e in stack[index:]):
            close_block()
        del stack[index:]

    for m in TOKEN.finditer(source):
        add(source[at : m.start()])
        at = m.end()
        tag = (m[4] or "").lower()
        if not tag or tag in VOID:
            if tag == "hr":
                close_block()
            elif tag:
                add(" ")
            continue
        if m[3]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].tag == tag:
                    pop_to(i)
                    break
                if stack[i].tag in CONTAINER and tag not in BLOCK:
                    break
            continue
        if tag in BLOCK:
            open_ = next((i for i, e in enumerate(stack) if e.tag in EMBEDDED), None)
            if open_ is not None and tag not in ("option", "optgroup", "title"):
                pop_to(open_)
            close_block()
            ends = CLOSES.get(tag, set()) | {"p"}
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].tag in ends:
                    pop_to(i)
                    if stack and tag in ("td", "th", "tr") and stack[-1].tag in ends:
                        continue
                    break
                if stack[i].tag in CONTAINER or stack[i].tag in ("ul", "ol", "dl", "table"):
                    break
        if (m[5] or "").rstrip().endswith("/") and tag not in BLOCK or len(stack) >= DEPTH:
            continue
        attributes = {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(m[5] or "")}
        above = stack[-1] if stack else None
        named = above.named if above else -1
        inside = bool(above and above.inside) or tag in ("article", "main") or m.start() in exempt
        noise = bool(above and above.noise) or tag in EMBEDDED or _is_noise(tag, {"role": attributes.get("role", "")}, stack, inside)[0]
        if not noise and m.start() not in exempt:
            noise, doubtful = _is_noise(tag, attributes, stack, inside)
            if noise:
                named = m.start()
                unsure |= {named} if doubtful else set()
        if named >= 0 and tag in ("h1", "main", "article"):
            headed.add(named)
        holder = above.holder if above else 0
        if tag in CONTAINER and not noise:
            first = (attributes.get("class", "").split() or [""])[0]
            step = tag + ("." + re.sub(r"\d+", "#", first) if first else "")
            page.parents.append(holder)
            page.paths.append(f"{page.paths[holder]}>{step}")
            holder = len(page.parents) - 1
        stack.append(Element(tag, noise, holder, named, inside))
    add(source[at:])
    close_block()
    whole = sum(len(text) for _, text, _ in page.blocks) + sum(dropped.values())
    texts = {k for k in unsure if dropped[k] >= DOUBTFUL and 3 * linked[k] < dropped[k]}
    return page, texts | {k for k in headed if dropped[k] > WHOLE * whole}


def best_container(page: Page) -> tuple[str, float] | None:
    scores = [0.0] * len(page.parents)
    for holder, text, links in page.blocks:
        value, share = (len(text) - links) * (1 - links / len(text)), 1.0
        while holder >= 0 and share >= 0.25:
            scores[holder] += value * share
            holder, share = page.parents[holder], share / 2
    top = max(range(len(scores)), key=lambda i: (scores[i], -i))
    return (page.paths[top], scores[top]) if scores[top] > 0 else None


PARSED = T.StructType(
    [
        T.StructField("best", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("blocks", T.ArrayType(T.StructType([T.StructField("path", T.StringType()), T.StructField("text", T.StringType())]))),
    ]
)


@F.arrow_udf(PARSED)
def parsed(source: pa.Array) -> pa.Array:
    """A page's best container and all of its blocks, each with the path of its container."""
    best, paths, texts, ends = [], [], [], [0]
    for text in source.to_pylist():
        page = read_page(text or "")
        best.append(best_container(page) or (None, None))
        paths += [page.paths[holder] for holder, _, _ in page.blocks]
        texts += [block for _, block, _ in page.blocks]
        ends.append(len(texts))
    blocks = pa.StructArray.from_arrays([pa.array(paths, pa.string()), pa.array(texts, pa.string())], names=["path", "text"])
    blocks = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), blocks)
    return pa.StructArray.from_arrays([pa.array([b[0] for b in best], pa.string()), pa.array([b[1] for b in best], pa.float64()), blocks], names=["best", "score", "blocks"])


def host_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1), F.lit(""))


def host_paths(read: DataFrame, keep: int = PATHS) -> DataFrame:
    """(host, paths): each host's most voted generalised paths, strongest first; read: host, best, score."""
    votes = read.where("best IS NOT NULL").groupBy("host", "best").agg(F.count("*").alias("pages"), F.sum("score").alias("score"))
    w = Window.partitionBy("host").orderBy(F.desc("pages"), F.desc("score"), "best")
    top = votes.withColumn("r", F.row_number().over(w)).where(F.col("r") <= keep)
    return top.groupBy("host").agg(F.transform(F.array_sort(F.collect_list(F.struct("r", "best"))), lambda x: x["best"]).alias("paths"))


def main_texts(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row. Pages are parsed once; votes and re-extraction read the blocks."""
    read = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), parsed("html").alias("p"))
    read = staged(read.select("page_id", "url", "host", "p.best", "p.score", "p.blocks"), "page-blocks")
    paths = staged(host_paths(read), "host-paths")

    def under(path: Column) -> Column:
        return F.filter("blocks", lambda b: (b["path"] == path) | F.startswith(b["path"], F.concat(path, F.lit(">"))))

    length = lambda p: F.aggregate(under(p), F.lit(0), lambda n, b: n + F.char_length(b["text"]))
    here = F.filter("paths", lambda p: F.greatest(F.lit(1.0), SHARE * F.col("score")) <= length(p))
    chosen = read.join(paths, "host", "left").withColumn("chosen", F.coalesce(F.get(here, F.lit(0)), "best"))
    text = F.coalesce(F.array_join(F.transform(under(F.col("chosen")), lambda b: b["text"]), "\n"), F.lit(""))
    return chosen.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.char_length("text").cast("long"))


def op3_consensus_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(table(spark, sf_dir, "pages"))
