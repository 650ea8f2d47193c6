"""Main text is not swallowed by self-closed or unclosed elements or by names of wrappers."""

import time

import pytest

from bookaudit.llm import html_extract
from bookaudit.llm.html_extract import read_page

ARTICLE = "<article><h1>Title</h1><p>" + "Main text of the page. " * 20 + "</p></article>"
WANT = ["Title", ("Main text of the page. " * 20).strip()]


def texts(source):
    return [text for _, text, _ in read_page(source).blocks]


@pytest.mark.parametrize(
    "before",
    [
        "<svg class=icon/>", '<svg viewBox="0 0 1 1"/>', "<iframe src='x'/>", "<object data=x>", "<svg><path d='M0'>", "<select><option>no", "<noscript>no",
        "<div><a href=x><svg><path/></a></div>", "<svg><g><svg><text>no</text></svg></g></svg>", "<script src='x'/>", "<select><option>no</select>", "<svg><title>no</title></svg>",
    ],
)
def test_embedded_elements(before):
    assert texts(f"<body>{before}{ARTICLE}</body>") == WANT
    assert texts(f"<body>{before}{ARTICLE}<svg><text>no</text></svg></body>") == WANT


def test_names_of_wrappers():
    for name in ("content-with-sidebar", "page-no-comments", "has-sidebar", "layout-sidebar-right", "newsletter-page"):
        assert texts(f"<body><div class='{name}'>{ARTICLE}</div></body>") == WANT
    for name in ("sidebar", "post-comments", "cookie-notice with-image"):
        assert texts(f"<body>{ARTICLE}<div class='{name}'><p>no</p></div></body>") == WANT


def test_tags_are_scanned_by_the_rules():
    for tag in ("<div class=a data-t=it's>", '<div title=5" wide>', "<div class='x' \" id=y>", "<div a = 'b>c' d>"):
        assert texts(f"<body>{tag}{ARTICLE}</div></body>") == WANT
    assert texts(f"<body>{ARTICLE}<p>end <a href='x") == [*WANT, "end"]


@pytest.mark.parametrize("piece", ["<a ", "<a b='", '<a b="', "<!x ", "<svg ", "<svg><g>", "<!--", "</a ", "<script ", "<div><p>x", "<b =", "&amp", "<select><object>"])
def test_hostile_pages_take_linear_time(piece):
    began = time.process_time()
    read_page(ARTICLE + piece * (200_000 // len(piece)))
    assert time.process_time() - began < 6


def test_words_alone_drop_no_article_text():
    for tag in ('section class="related-work"', 'div class="form-factor"', 'div id="banner-year"'):
        got = texts(f"<body><article><h1>Title</h1><{tag}><p>{WANT[1]}</p></{tag.split()[0]}></article></body>")
        assert got == WANT
    for name in ("related-posts", "share", "ad-slot", "comments", "newsletter-box", "relatedArticles"):
        assert texts(f"<body><article><h1>Title</h1><p>{WANT[1]}</p><div class='{name}'><p>no</p></div></article></body>") == WANT


def test_doubtful_names_need_a_second_sign():
    for name in ("form-factor", "comment-on-policy", "header-image", "banner-year"):
        assert texts(f"<body><div class='entry'><h1>Title</h1><div class='{name}'><p>{WANT[1]}</p></div></div></body>") == WANT
        links = f"<div class='{name}'>" + "<a href=x>another story</a> " * 20 + "</div>"
        assert texts(f"<body><div class='entry'><h1>Title</h1><p>{WANT[1]}</p></div>{links}<div class='{name}'><p>no</p></div></body>") == WANT
    assert texts(f"<body><div class='header-image'><h1>Title</h1><div class='form-factor'><p>{WANT[1]}</p></div></div></body>") == WANT
    assert texts(f"<body>{ARTICLE}<div class='comments'><p>{WANT[1]}</p></div></body>") == WANT


def test_second_template_of_a_host(spark):
    """A short block under the host's common path doesn't stand for a page whose article lies elsewhere."""
    page = lambda cls, text: f"<body><div class='{cls}'><p>{text}</p></div>"
    body = "This is the text of an ordinary page of this host. " * 12
    rows = [(i, "https://h.example/a", page("box", body) + "</body>") for i in range(3)]
    rows.append((3, "https://h.example/b", page("box", "A teaser of the other stories. " * 9) + "<div class='story'><p>" + "The article itself, elsewhere. " * 29 + "</p></div></body>"))
    got = {r["page_id"]: r["text"] for r in html_extract.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[i] for i in range(3)] == [body.strip()] * 3
    assert got[3] == ("The article itself, elsewhere. " * 29).strip()
