"""Pages whose article must be whole."""

import pytest

from clicksieve.llm import html_extraction

LONG = "A sentence of the article, long enough to be scored, with commas, and with words."
SIDE = "Something else on the site, that nobody came to read here, whatever it says to them."
BODY = f"<p>{LONG}</p><p>{LONG}</p><p>{LONG}</p>"
TEXT = f"{LONG} {LONG} {LONG}"


@pytest.mark.parametrize(
    "name",
    [
        "no-sidebar", "page has-sidebar", "content-sidebar-wrap", "post category-social", "tag-search", "with-comments",
        "introduction-to-advertising", "related-work", "share-price", "left-sidebar", "sidebar",
    ],
)
@pytest.mark.parametrize("tag", ["div", "article", "section"])
def test_names_that_only_contain_a_word_take_nothing_out(name, tag):
    for attribute in ("class", "id"):
        page = f'<body><{tag} {attribute}="{name}"><div>{BODY}</div><div class="sidebar"><p>{SIDE}</p></div></{tag}></body>'
        assert html_extraction.extract(page) == TEXT
        page = f'<body><div><{tag} {attribute}="{name}">{BODY}</{tag}></div></body>'
        assert html_extraction.extract(page) == TEXT


@pytest.mark.parametrize(
    "name", ["sidebar", "sidebar-left", "reader-comments", "commentList", "cookie_notice", "site-footer", "ad-slot-3", "article__share", "post related-posts"]
)
@pytest.mark.parametrize("times", [1, 3, 8])
def test_other_parts_are_taken_out_however_long(name, times):
    page = f'<body><div id="content">{BODY}</div><div class="{name}">{f"<p>{SIDE}</p>" * times}</div></body>'
    assert html_extraction.extract(page) == TEXT
    page = f'<body><div id="content">{BODY}<div class="{name}">{f"<p>{SIDE}</p>" * times}</div></div></body>'
    assert html_extraction.extract(page) == TEXT


@pytest.mark.parametrize(
    "page",
    [
        f"<article><p>{LONG}</p></article><article><p>{LONG}</p><p>{LONG}</p></article>",
        f"<article><p>{LONG}</p><p>{LONG}</p></article><div><p>{LONG}</p></div>",
        f"<div><main><p>{LONG}</p><p>{LONG}</p></main><div>{LONG}</div></div>",
        f"<article><p>{LONG}</p><p>{LONG}</p></article>{LONG}",
    ],
)
def test_an_article_goes_on_in_siblings(page):
    menu = '<div><a href="/">Home</a> <a href="/x">News</a></div>'
    assert html_extraction.extract(f"<body>{menu}{page}<footer>End</footer></body>") == TEXT


def test_text_and_inline_elements_beside_the_best_are_kept():
    page = f"<div>Lead <b>text</b>. <div class=body>{BODY}</div> Closing <em>text</em> <a href='/'>here</a>.</div>"
    assert html_extraction.extract(page) == f"Lead text. {TEXT} Closing text here."
    page = f"<body><div><a href='/'>Home</a> | <a href='/x'>News</a><div class=body>{BODY}</div><span>The end.</span></div></body>"
    assert html_extraction.extract(page) == f"{TEXT} The end."
