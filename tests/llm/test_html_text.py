import pytest

from pulsegrid.llm.html_text import extract_text, main_text, smoothed

import numpy as np

LONG = "A long enough sentence of the article itself, with words that go on for a while."


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("<p></p>", ""), ("plain words", "plain words"), ("<script>x</script><style>p{}</style>", ""),
    (f"<nav><ul><li><a href=/>Home</a></li></ul></nav><article><h1>T</h1><p>{LONG}</p><p>Short &amp; x</p></article>"
     "<footer>&copy; y</footer>", f"T\n\n{LONG}\n\nShort & x"),
    (f"<body><div class='content'><p>{LONG}<p>Two\n  lines<br>more</div><div id='user-comments'><p>me too</p></div></body>",
     f"{LONG}\n\nTwo lines more"),
    (f"<main><header>Site</header><p>{LONG}</p><aside>Side</aside><form><p>Mail</p></form></main>", LONG),
    (f"<div role=navigation>Menu</div><div class=ad>Buy</div><p>{LONG}</p><div style='display: none'>hid</div>", LONG),
    (f"<article><p><b>{LONG}<br><p>Unclosed <i>tags</p></article>", f"{LONG}\n\nUnclosed tags"),
    (f"<article><p>{LONG}</p><section class='comments'><article><p>Reader's word</p></article></section></article>", LONG),
])
def test_pages(html, text):
    assert main_text(html) == text


def test_frame(spark):
    page = f"<article><p>{LONG}é</p></article>"
    rows = [(1, "u", page), (1, "u", page), (2, None, None), (None, "v", "<p>" + "x " * 50_000)]
    frame = spark.createDataFrame([(*r, "x", 5) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    found = extract_text(frame).collect()
    assert sorted(((r.page_id or 0), r.n_chars) for r in found) == [(0, 99_999), (1, len(LONG) + 1), (1, len(LONG) + 1), (2, 0)]
    assert extract_text(frame.limit(0)).count() == 0


def test_smoothing_keeps_a_constant():
    assert np.allclose(smoothed(np.full(9, 3.0)), 3.0)
    assert main_text("<div>" * 3000 + LONG) == LONG


@pytest.mark.parametrize("html, text", [
    (f"<div class='content has-sidebar'><article><p>{LONG}</p></article></div>", LONG),
    (f"<div class='no-comments'><p>{LONG}</p></div>", LONG),
    (f"<div class='page-sidebar'><main><p>{LONG}</p></main></div><div class='sidebar'><p>Side</p></div>", LONG),
    (f"<article><section id='discussion'><p>{LONG}</p></section><section id='related-work'><p>{LONG}</p></section></article>",
     f"{LONG}\n\n{LONG}"),
    (f"<section id='discussion'><h2 id='notice-periods'>Periods</h2><p>{LONG}</p></section>", f"Periods\n\n{LONG}"),
    (f"<article><div class='article-header'><h1>Title</h1></div><p>{LONG}</p><div class='ad'>Buy</div></article>", f"Title\n\n{LONG}"),
    (f"<article><p>{LONG}</p></article><section class='related'><article><p>{LONG} Another.</p></article></section>", LONG),
    (f"<div><h2>A</h2><p>{LONG}</p><blockquote>Q</blockquote><table><tr><td>c</td></tr></table><p>{LONG}</p></div>",
     f"A\n\n{LONG}\n\nQ\n\nc\n\n{LONG}"),
])
def test_names_of_layouts_and_sections_lose_nothing(html, text):
    assert main_text(html) == text


@pytest.mark.parametrize("box", [
    "<div class='comment-list'>", "<div id='comments'>", "<section id='comments'>", "<div class='related-posts'>",
    "<div class='newsletter-signup'>", "<div class='ad-slot'>", "<div class='comments-area'>", "<div class='cookie-bar'>",
    "<ul class='shareButtons'>", "<div class='post-comments'>", "<aside>", "<div role='complementary'>"])
@pytest.mark.parametrize("page", ["<article><p>{long}</p>{box}</article>", "<div class='page'><p>{long}</p></div>{box}"])
def test_foreign_boxes(box, page):
    end = f"</{box[1:].split()[0].rstrip('>')}>"
    assert main_text(page.format(long=LONG, box=f"{box}<p>{LONG} By a reader.</p>{end}")) == LONG


@pytest.mark.parametrize("box", ["<div class='share-price-table'>", "<section id='ad-hoc-analysis'>", "<div class='discussion-of-results'>",
                                 "<div class='header-image-text'>", "<section id='menu-of-the-day'>"])
def test_boxes_that_only_sound_foreign(box):
    end = f"</{box[1:].split()[0]}>"
    assert main_text(f"<article><p>{LONG}</p>{box}<p>{LONG} More.</p>{end}</article>") == f"{LONG}\n\n{LONG} More."


def test_headers_of_main():
    assert main_text(f"<main><header><h1>Title</h1></header><p>{LONG}</p></main>") == f"Title\n\n{LONG}"
    assert main_text(f"<main><header><a href=/>Site</a> name</header><h1>Title</h1><p>{LONG}</p></main>") == f"Title\n\n{LONG}"


def test_generated_pages():
    """Pages put together from known blocks: the text is that of the article's blocks, in order."""
    import html
    import random

    draw = random.Random(12)
    words = "the of river mill stone é & < \"quoted\" long-lived water 12 house".split(" ")

    def sentence(n):
        return " ".join(draw.choices(words, k=n)).strip()

    def block(text):
        inner = html.escape(text).replace(" ", draw.choice([" ", "  ", "\n", "&#32; "]), 1)
        tag = draw.choice(["p", "h2", "blockquote", "p", "p"])
        return f"<{tag}>{inner}</{tag}>" if draw.random() < 0.7 else f"<p>{inner}"

    foreign = ["<nav><ul><li><a href=/>{t}</a></ul></nav>", "<footer><p>{t}</footer>", "<aside><p>{t}</p></aside>", "<form><label>{t}</label></form>",
               "<div class='ad-slot'><p>{t}</p></div>", "<ul class='share-links'><li>{t}</ul>", "<div id='comments'><p>{t}</p></div>",
               "<script>var a = '<p>{t}</p>';</script>", "<style>p {{ }}</style>", "<!-- <p>{t}</p> -->", "<div class='cookie-notice'>{t}</div>",
               "<section class='related-posts'><h3>{t}</h3></section>"]
    for _ in range(300):
        want, out = [], []
        for _ in range(draw.randint(1, 8)):
            text = " ".join(sentence(draw.randint(1, 40)).split())
            want.append(text)
            out.append(block(text))
            if draw.random() < 0.4:
                out.append("</p>" + draw.choice(foreign).format(t=html.escape(sentence(5))))
        around = [draw.choice(foreign).format(t=html.escape(sentence(draw.randint(1, 30)))) for _ in range(4)]
        page = f"<html><body>{around[0]}{around[1]}<article>{''.join(out)}</article>{around[2]}{around[3]}</body></html>"
        assert main_text(page) == "\n\n".join(want), page
