"""Pages whose main text was lost or mixed up: names of raw elements, forms around a page, comments by id, short marked articles, headers."""

import time

import pytest

from quarrykit.llm import html_extract


def words(n, letter="w"):
    return " ".join(f"{letter}{k}" for k in range(n))


TWO = f"<p>{words(60)}</p><p>{words(62, 'v')}</p>"
WHOLE = f"{words(60)} {words(62, 'v')}"
LEARNED = html_extract.weights(html_extract.count_features(f"<body><nav><ul><li><a>Home</a></li></ul></nav><article><h1>A title</h1>{TWO}</article><footer>Imprint of a page</footer></body>"))


@pytest.mark.parametrize("learned", [{}, LEARNED])
@pytest.mark.parametrize(
    "html,text",
    [
        (f"<body><title-bar>x</title-bar>{TWO}</body>", WHOLE),
        (f"<template-x></template-x>{TWO}", WHOLE),
        (f"<p>{words(60)}</p><svg width='1'/><p>{words(62, 'v')}</p>", WHOLE),
        (f"<p>{words(60)}</p><svg-icon name='x'></svg-icon><p>{words(62, 'v')}</p>", WHOLE),
        (f"<p>{words(60)}</p><svg><text>drawn</text></svg><script>var a = '<p>no</p>';</script><p>{words(62, 'v')}</p>", WHOLE),
        (f"<svg>{TWO}", WHOLE),
        (f"<title>T</title><style>p {{}}</style>{TWO}<script>never closed <p>x</p>", WHOLE),
        (f"<form><div class='content'>{TWO}</div><input type='submit'></form>", WHOLE),
        (f"{TWO}<form><p>Sign up here for news</p><label>Mail</label><input></form>", WHOLE),
        (f"<main>{TWO}<div id='disqus_thread'><p>{words(30, 'c')}</p></div></main>", WHOLE),
        (f"{TWO}<div id='disqus_thread'><p>{words(30, 'c')}</p></div>", WHOLE),
        (f"<article>{TWO}</article><div class='comment-thread'><p>{words(30, 'c')}</p></div>", WHOLE),
        ("<ul>" + f"<li><a href='x'>{words(10, 't')}</a></li>" * 50 + f"</ul><article><p>{words(12)}</p></article>", words(12)),
        ("<div>" + f"<div><a href='x'>{words(10, 't')}</a></div>" * 50 + f"</div><article><p>{words(12)}</p></article>", words(12)),
        (f"<article><header><h2>Title</h2></header>{TWO}</article>", f"Title {WHOLE}"),
        (f"<header><h2>Site</h2></header><article>{TWO}</article>", WHOLE),
    ],
)
def test_article_alone(html, text, learned):
    assert html_extract.extract(html, learned) == text


def test_a_mark_yields_to_prose_around_it():
    html = "".join(f"<p>{words(60, c)}</p>" for c in "abcdefgh") + f"<div class='box'><article><p>{words(8, 'z')}</p></article></div>"
    assert html_extract.extract(html, LEARNED).startswith("a0 a1")


def test_parsing_stays_linear():
    began = time.perf_counter()
    for odd in ("<svg>" * 100_000, "<svg></svg>" * 60_000, "<form>" * 40_000 + "x " * 1000, "<title-" * 60_000, "<template>" * 50_000 + "</svg>" * 50_000):
        html_extract.extract(odd + TWO, LEARNED)
    assert time.perf_counter() - began < 20


def test_marked_articles_of_the_table_are_whole(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").where("html rlike '<article>'").limit(250)
    import re
    from html import unescape

    made = {r.page_id: r.text for r in html_extract.main_text(pages, html_extract.learn(pages)).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        inner = re.sub(r"<(script|style|aside|form|nav|figure)\b.*?</\1>|<!--.*?-->", " ", inner, flags=re.S)
        plain = " ".join(unescape(re.sub(r"<[^>]+>", " ", inner)).split())
        got = made[r.page_id]
        assert set(got.split()) <= set(plain.split()) | {"."} or len(set(got.split()) - set(plain.split())) <= 2
        assert len(got.split()) >= 0.5 * len(plain.split())
