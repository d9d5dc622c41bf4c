"""Main text of pages: exact texts, odd markup, and every page of the table by another way."""

from __future__ import annotations

import html
import re
import time

import pytest

from playtrail.llm import queries
from playtrail.llm.html_text import extract_main_text, main_text

SMALL = "/root/testdata/sf0.001"
SCHEMA = "page_id long, url string, html string, text string, n_chars string"
PARTS = [f"The {k} thing, as was said, is of some length. It goes on for a while." for k in "abcde"]
ARTICLE = "".join(f"<p>{p}</p>" for p in PARTS)
TEXT = "\n\n".join(PARTS)


def readers(count, times):
    one = "I liked it, and would read more of it. Thanks to all of you, really. " * times
    return "".join(f"<p>Reader {i}: {one}</p>" for i in range(count))


UNWANTED = [
    "<section class=comments>{}</section>",
    "<div id=comments>{}</div>",
    "<div class='user-comments'>{}</div>",
    "<div class='comment-list'>{}</div>",
    "<aside>{}</aside>",
    "<footer>{}</footer>",
    "<form action=x>{}</form>",
    "<div class='sponsored-content'>{}</div>",
    "<div class='cookie-notice'>{}</div>",
    "<nav>{}</nav>",
    "<div role=complementary>{}</div>",
    "<section class=comments><article>{}</article><article>{}</article></section>",
]


@pytest.mark.parametrize("times", [1, 2, 3])
@pytest.mark.parametrize("count", [2, 6, 20])
@pytest.mark.parametrize("unwanted", UNWANTED)
@pytest.mark.parametrize("wrap", ["article", "main", "div", "section"])
def test_what_is_longer_than_the_article_does_not_replace_it(wrap, unwanted, count, times):
    part = readers(count, times)
    part = unwanted.format(*[part] * unwanted.count("{}"))
    beside = f"<body><nav><a href=x>Menu</a></nav><{wrap}>{ARTICLE}</{wrap}>{part}</body>"
    assert main_text(beside) == TEXT
    before = f"<body>{part}<{wrap}>{ARTICLE}</{wrap}></body>"
    assert main_text(before) == TEXT
    inside = f"<body><{wrap}>{ARTICLE}{part}</{wrap}></body>"
    assert main_text(inside) == TEXT


@pytest.mark.parametrize("unwanted", UNWANTED)
def test_one_sentence_is_an_article_too(unwanted):
    part = unwanted.format(*[readers(9, 3)] * unwanted.count("{}"))
    assert main_text(f"<body><article><p>{PARTS[0]}</p></article>{part}</body>") == PARTS[0]
    if "form" not in unwanted:
        assert main_text(f"<body><div><p>{PARTS[0]}</p></div>{part}</body>") == PARTS[0]


@pytest.mark.parametrize("end", ["<div>Copyright 2024. All rights.</div>", "<p><a href=x>Imprint.</a></p>", ""])
@pytest.mark.parametrize("wrap", ["<form>{}</form>", "<div class=widget>{}</div>", "<div class='page-header'>{}</div>"])
def test_a_layout_around_the_article(wrap, end):
    assert main_text("<body>" + wrap.format(f"<div>{ARTICLE}</div><footer>End.</footer>") + end + "</body>").startswith(TEXT)


def test_a_marked_page_without_anything_else_keeps_its_text():
    assert main_text(f"<body><aside>{ARTICLE}</aside></body>") == TEXT
    assert main_text(f"<body><article><form>{ARTICLE}</form></article></body>") == TEXT


def test_comment_articles_beside_the_article():
    page = f"<body><article>{ARTICLE}</article><article class=comment>{readers(3, 3)}</article></body>"
    assert main_text(page) == TEXT


@pytest.mark.parametrize("raw", ["<svg><svg><text>in.</text></svg><text>more, too.</text></svg>", "<template><template>a</template>b.</template>"])
def test_nested_raw_elements(raw):
    assert main_text(f"<article>{ARTICLE}{raw}</article>") == TEXT


def test_markup_that_does_not_close():
    assert main_text("<div><p>One, two.<p>Three, four.<ul><li>a, b.<li>c, d.</ul>") == (
        "One, two.\n\nThree, four.\n\na, b.\n\nc, d."
    )
    assert main_text("<p>a, <b>b.</i></b></u> c</p></div></p>d, e.") == "a, b. c\n\nd, e."
    assert main_text("<article><p>x, y.</p><script>open, never. closed") == "x, y."


@pytest.mark.parametrize(
    "page",
    [
        "<div>" * 100_000 + "Deep, text.",
        "<div><span>" * 50_000 + "Deep, text." + "</b>" * 50_000,
        "<i>" * 100_000 + "Deep, text." + "</p>" * 100_000,
        "<p><span>" * 50_000 + "Deep, text.",
        "<b>" + "<i>" * 50_000 + "<div>" + "</b>" * 50_000 + "Deep, text.",
        "<article>" * 50_000 + "Deep, text." + "</article>" * 50_000,
        "<aside>" * 100_000 + "Deep, text.",
        "<li><b>" * 50_000 + "Deep, text.",
    ],
)
def test_depth_costs_nothing(page):
    start = time.perf_counter()
    assert main_text(page) == "Deep, text."
    assert time.perf_counter() - start < 6


def independent(page):
    """For the one template of the table: the blocks of its article by splitting at block tags."""
    body = re.search("<article>(.*)</article>", page, re.S)[1]
    body = re.sub(r"(?s)<!--.*?-->|<(script|style)\b.*?</\1>", "", body)
    body = re.sub(r"(?s)<(div|section) class=\"(?:ad|comments?|share|related)\">.*?</\1>", "\x00", body)
    blocks = re.split(r"(?i)</?(?:article|p|h[1-6]|ul|ol|li|div|section|blockquote|table|tr|td|th|pre)\b[^>]*>|\x00", body)
    texts = [" ".join(html.unescape(re.sub("<[^>]*>", " " if "<br" in b else "", b) if "<br" not in b else re.sub("<(?!br)[^>]*>", "", b).replace("<br>", " ").replace("<br/>", " ")).split()) for b in blocks]
    return "\n\n".join(t for t in texts if t)


def test_every_page_of_the_table(llm):
    rows = {r["page_id"]: r for r in queries.op8_html_text(llm, SMALL).collect()}
    pages = llm.read.parquet(f"{SMALL}/pages.parquet").collect()
    assert len(rows) == len(pages)
    for page in pages:
        row = rows[page["page_id"]]
        assert row["text"] == independent(page["html"]), page["html"]
        assert (row["url"], row["n_chars"]) == (page["url"], len(row["text"]))


def test_empty_table_repeats_and_other_columns(llm):
    rows = [(1, "u", f"<article>{ARTICLE}</article>", "x", "y")] * 3 + [(None, None, None, None, None), (2, "", " ", "", "")]
    df = llm.createDataFrame(rows, SCHEMA)
    got = sorted((tuple(r) for r in extract_main_text(df).collect()), key=str)
    want = [(1, "u", TEXT, len(TEXT))] * 3 + [(None, None, "", 0), (2, "", "", 0)]
    assert got == sorted(want, key=str)
    assert extract_main_text(df.limit(0)).collect() == []
