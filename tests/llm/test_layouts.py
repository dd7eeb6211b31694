"""Main text under clutter names, headlines in headers, unclosed quotes, and pages made to be slow."""

import time

import pytest

from selvatrace.llm import html_text

PARAGRAPH = "The harvest began late that year, and few of the growers minded it. Rain had kept the roads closed."
BODY = "<h1>A Late Harvest</h1>" + f"<p>{PARAGRAPH}</p>" * 3
TEXT = "\n".join(["A Late Harvest"] + [PARAGRAPH] * 3)


def main_text(source):
    return html_text.main_text([html_text.Page(source)], html_text.trained())[0]


@pytest.mark.parametrize(
    "source",
    [
        f'<form action="/"><article>{BODY}</article></form>',
        f'<body><form id="form1"><div id="main">{BODY}</div></form></body>',
        f'<div class="banner-hero"><article>{BODY}</article></div>',
        f'<div class="social-wrap"><article>{BODY}</article></div>',
        f'<nav><a href="/">Home</a> <a href="/b">Shop</a></nav><article>{BODY}</article><footer>Copyright 2020</footer>',
        f'<article><header><h1>A Late Harvest</h1></header>{BODY.split("</h1>")[1]}</article>',
        f'<form id="f"><nav><a href="/">Home</a></nav><article>{BODY}</article><div class="comments"><p>I liked it.</p></div></form>',
    ],
)
def test_main_text_wherever_it_lies(source):
    assert main_text(source) == TEXT


def test_quotes_without_end():
    text = lambda s: [t for _, t in html_text.Page(s).blocks]
    assert text('<p title="oops>Hello <b>there</b></p>') == ["Hello there"]
    assert text("<p title='a > b'>one</p><p it's>two</p>") == ["one", "two"]
    assert text('<p>one</p><p title="two') == ["one"]
    assert text("<p>1 < 2</p>< 3") == ["1 < 2", "< 3"]


@pytest.mark.parametrize(
    "source",
    ["<a " * 35_000 + '" >', '<a x=">"' * 13_000, "<a x=\"'" * 15_000, "<b>" * 20_000 + "<p>x</p>" * 5_000, "<div>" * 10_000 + "<li>a</li>" * 5_000, "<!x" * 35_000],
)
def test_long_hostile_pages(source):
    trees = html_text.trained()
    start = time.perf_counter()
    html_text.main_text([html_text.Page(source)], trees)
    assert time.perf_counter() - start < 2
