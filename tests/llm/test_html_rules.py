"""Names, roles, broken markup and the part that densities and neighbours play in an article."""

import time

import pytest

from paytrail.llm import html_text

PROSE = "This is the long text of the article that we all have to read with care and it is good. " * 3
OTHER = "I think that this is a very good block and I have read it with a lot of care and it is not the end of it."
LINKS = "<ul><li><a href='/a'>One more page of the site</a></li><li><a href='/b'>Another page of it</a></li></ul>"


def page(inside="", beside=""):
    return f"<html><body><article><p>{PROSE}</p>{inside}</article>{beside}</body></html>"


@pytest.mark.parametrize("attribute", [
    'class="reader-comments"', 'class="article-comments"', 'class="comments-reader"', 'class="box-ad"', 'class="ad-300x250"',
    'class="privacy-banner"', 'class="site-alert"', 'role="alert"', 'role="complementary"', 'role="contentinfo"',
    'role="navigation"', 'role="search"', 'class="footer-site"', 'id="newsletter_box"', 'class="cookie-notice"',
])
def test_what_is_beside_the_article_stays_out(attribute):
    block = f"<div {attribute}><p>{OTHER}</p></div>"
    assert html_text.main_text(page(block)) == html_text.main_text(page("", block)) == PROSE.strip()


@pytest.mark.parametrize("attribute", ['class="has-sidebar"', 'class="article-header"', 'class="search-results"', 'class="no-ads-here"', 'class="adventure"'])
def test_loose_names_are_no_asides(attribute):
    assert OTHER in html_text.main_text(page(f"<div {attribute}><p>{OTHER}</p></div>"))


def test_a_comment_that_is_an_article_stays_out_and_an_only_article_stays():
    comment = f'<article class="comment"><p>{OTHER}</p></article>'
    assert html_text.main_text(page(comment)) == html_text.main_text(page("", comment)) == PROSE.strip()
    only = f'<body><article class="promo-content"><p>{OTHER}</p></article></body>'
    assert html_text.main_text(only) == OTHER


def test_stop_words_links_and_neighbours_decide_inside_an_article(monkeypatch):
    caption, advert = "A view of the old harbour", "Buy now and save"
    text = page(f"{LINKS}<p>{caption}</p><p>{PROSE}</p>{LINKS}<p>{advert}</p>{LINKS}")
    lines = html_text.main_text(text).split("\n")
    assert lines == [PROSE.strip(), caption, PROSE.strip()]
    monkeypatch.setattr(html_text, "STOP_WORDS", frozenset())
    assert caption not in html_text.main_text(text) and PROSE.strip() in html_text.main_text(text)
    monkeypatch.undo()
    monkeypatch.setattr(html_text, "MAIN_LINK_DENSITY", 1.0)
    assert advert in html_text.main_text(text)


@pytest.mark.parametrize("text", [
    "<a " * 300_000, "<a" * 300_000, "<!" * 300_000, '<a "' * 200_000, "<a x='" * 200_001 + "y>z", "<select>" * 100_000, "<!--" * 200_000,
], ids=range(7))
def test_broken_markup_takes_time_in_proportion(text):
    start = time.process_time()
    html_text.main_text(text)
    assert time.process_time() - start < 4


def test_quotes_and_comments_in_tags():
    assert html_text.main_text(f'<p title="a > b" data-x=\'">\'>{OTHER}</p><!-- <p>gone</p> --><p>{PROSE}</p>') == f"{OTHER}\n{PROSE.strip()}"
    assert html_text.main_text(f"<p title='never closed>{OTHER}</p>") == OTHER


def test_repeated_rows_empty_tables_and_nulls(spark, table):
    pages = table([(1, "u", page(), 7), (1, "u", page(), 7), (2, None, None, None), (None, "u", "", None)], "page_id long, url string, html string, text long")
    found = sorted(html_text.extract(pages).collect(), key=repr)
    assert [(r.page_id, r.text, r.n_chars) for r in found] == [
        (1, PROSE.strip(), len(PROSE.strip()))] * 2 + [(2, "", 0), (None, "", 0)]
    assert html_text.extract(pages.limit(0)).collect() == []
