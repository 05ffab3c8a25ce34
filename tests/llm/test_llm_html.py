"""Main text that stands in more than one element."""

import html
import re
import time

import pytest

from tagmeans.llm import registry
from tagmeans.llm.html_text import main_text

A = [f"Sentence {i} of the first part tells of rivers and of the towns that lie along their banks." for i in range(7)]
B = [f"Sentence {i} of the second part goes on with harbours, ships and the weather over the sea." for i in range(4)]
NAV = '<nav><a href="/">Home</a><a href="/n">News</a></nav>'
FOOT = "<footer>Imprint and terms of use</footer>"


def p(texts):
    return "".join(f"<p>{t}</p>" for t in texts)


@pytest.mark.parametrize("tag", ["div", "section", "article"])
@pytest.mark.parametrize("around", ["body", "main"])
def test_two_parts(tag, around):
    both = f"<{tag}>{p(A)}</{tag}><{tag}>{p(B)}</{tag}>"
    both = f"<main>{both}</main>" if around == "main" else both
    assert main_text(f"<html><body>{NAV}{both}{FOOT}</body></html>") == "\n".join(A + B)


def test_lead_before_the_article():
    page = f"<html><body>{NAV}<main><h1>Towns</h1><p>{B[0]}</p><article>{p(A)}</article></main>{FOOT}</body></html>"
    assert main_text(page) == "\n".join(["Towns", B[0], *A])


def test_one_article_stays_alone():
    page = f"<html><body>{NAV}<div><a href='/x'>More</a></div><article><h1>T</h1>{p(A)}</article>{FOOT}</body></html>"
    assert main_text(page) == "\n".join(["T", *A])


@pytest.mark.parametrize("part", ["<div>a", "<span>", "<i>", "<p>x", "<li>", "<td>a<table>", "</b>", "<form><div>", "<a href=x>y"])
def test_deep_pages_take_linear_time(part):
    """Some 100,000 elements in each other; quadratic time would be minutes."""
    began = time.process_time()
    main_text(part * 100_000)
    assert time.process_time() - began < 20


@pytest.mark.parametrize("name", ["related-work", "notice-period", "share-note", "notice-of-intent", "social-history", "commentary"])
def test_names_that_articles_use(name):
    page = f"<html><body>{NAV}<article>{p(A)}<section class='{name}'>{p(B)}</section></article>{FOOT}</body></html>"
    assert main_text(page) == "\n".join(A + B)


@pytest.mark.parametrize("name", ["commentlist", "comments-area", "cookiebar", "related-posts", "share buttons", "notice", "social-links"])
def test_names_that_set_apart(name):
    for attr in ("class", "id"):
        page = f"<html><body>{NAV}<article>{p(A)}<div {attr}='{name}'>{p(B)}</div></article>{FOOT}</body></html>"
        assert main_text(page) == "\n".join(A)
    assert main_text(f"<html><body><article>{p(A)}<section id='discussion'>{p(B)}</section></article></body></html>") == "\n".join(A)


def test_forms():
    page = f"<html><body>{NAV}<form>{p(A)}<input value='x'><button>Go</button></form>{FOOT}</body></html>"
    assert main_text(page) == "\n".join(A)
    page = f"<html><body>{NAV}<article>{p(A)}<form><p>Sign up here</p><label>Name</label></form></article>{FOOT}</body></html>"
    assert main_text(page) == "\n".join(A)


def test_whole_query_against_the_markup(spark):
    """All pages of sf0.001: the blocks of the page's article, read off its markup."""
    sf = "/root/testdata/sf0.001"
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    want = {}
    for r in pages:
        article, = re.findall(r"<article>(.*?)</article>", r.html, re.S)
        blocks = [" ".join(html.unescape(re.sub(r"<br\s*/?>", " ", b)).split())
                  for b in re.split(r"</?(?:p|h1)>", re.sub(r"</?[bi]>|<!--.*?-->", "", article, flags=re.S))]
        want[r.page_id] = (r.url, "\n".join(b for b in blocks if b))
    got = {r.page_id: (r.url, r.text) for r in registry.QUERIES["op3_html_text"](spark, sf).collect()}
    assert got == want
