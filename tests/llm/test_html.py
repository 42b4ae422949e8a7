"""Main text of generated pages: no article element, misleading classes, furniture of all kinds."""

from __future__ import annotations

import html as entities
import random
import re
import time

import duckdb

from loomwork.llm import html, queries

VOWELS, CONSONANTS = "aeiou", "bcdfglmnprst"


def sentence(rng, n):
    words = ["".join(rng.choice(CONSONANTS) + rng.choice(VOWELS) for _ in range(rng.randint(1, 4))) for _ in range(n)]
    return " ".join(words).capitalize() + "."


def links(rng, n):
    return "<ul>" + "".join(f'<li><a href="/{k}">{sentence(rng, 1)}</a></li>' for k in range(n)) + "</ul>"


def article(rng):
    """Markup of an article and its text: a title, perhaps a by-line and a date, paragraphs of all lengths, a list, an advert inside."""
    title = sentence(rng, rng.randint(2, 8))
    parts, texts = [f"<h1>{title}</h1>"], [title]
    if rng.random() < 0.4:
        for x in (f"By {sentence(rng, 2)}", f"{rng.randint(1, 28)} May"):
            parts.append(f"<p>{x}</p>")
            texts.append(x)
    for _ in range(rng.randint(3, 9)):
        x = sentence(rng, rng.choice((4, 25, 40, 60)))
        if rng.random() < 0.2:
            parts.append(f"<p>{x[:10]}<b>{x[10:]}</b> &amp; &lt;x&gt;</p>")
            texts.append(f"{x} & <x>")
        else:
            parts.append(f"<p>{x}</p>")
            texts.append(x)
        if rng.random() < 0.15:
            parts.append(f'<div class="{rng.choice(("ad", "share", "newsletter-signup"))}"><p>{sentence(rng, 5)}</p><p>{sentence(rng, 3)}</p><p>{sentence(rng, 3)}</p></div>')
        if rng.random() < 0.15:
            items = [sentence(rng, 5) for _ in range(3)]
            parts.append("<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>")
            texts += items
    return "".join(parts), "\n".join(texts)


def page(rng, layout):
    body, text = article(rng)
    nav = f"<nav>{links(rng, rng.randint(3, 9))}</nav>"
    ad = f'<div class="ad">{sentence(rng, 6)}</div>' if rng.random() < 0.6 else ""
    foot = f"<footer>&copy; {sentence(rng, 12)}</footer>"
    side = f'<div class="sidebar"><h3>{sentence(rng, 3)}</h3><p>{sentence(rng, 30)}</p></div>'
    talk = '<div id="comments">' + "".join(f"<div class='comment'><p>{sentence(rng, 20)}</p></div>" for _ in range(rng.randint(1, 4))) + "</div>"
    misleading = rng.choice(("sidebar", "promo-box", "content ads-enabled", "comments-open", "with-sidebar", "footer-above", "related"))
    made = {
        "wrapped": f"{nav}{ad}<div>{body}</div>{foot}",
        "misleading": f'{nav}{ad}<div class="{misleading}">{body}</div>{foot}',
        "bare": f"{nav}{ad}{body}{foot}",
        "columns": f'<div id="page"><header><p>{sentence(rng, 3)}</p></header>{nav}<div class="row"><div class="c1">{body}</div>{side}</div>{talk}{foot}</div>',
        "form": f'<form action="/"><div class="top">{nav}</div><div class="x1">{body}</div>{side}{foot}</form>',
        "table": f"<table><tr><td>{links(rng, 5)}</td><td>{body}</td><td>{links(rng, 4)}</td></tr></table>{foot}",
        "unmarked": f'<div class="a1">{links(rng, 6)}</div><div class="a2">{body}</div><div class="a3">{links(rng, 8)}</div><div>{sentence(rng, 4)}</div>',
        "teaser": f"{nav}<div>{body}</div><article><p>{sentence(rng, 9)}</p></article>{foot}",
        "section": f"{nav}<section><div><div>{body}</div></div></section><aside>{sentence(rng, 40)}</aside>{foot}",
    }
    return f"<!DOCTYPE html><html><head><title>{sentence(rng, 4)}</title><style>p{{}}</style></head><body>{made[layout]}</body></html>", text


LAYOUTS = ("wrapped", "misleading", "bare", "columns", "form", "table", "unmarked", "teaser", "section")


def test_pages_without_an_article_element_or_with_misleading_classes():
    rng = random.Random(20)
    wrong = []
    for k in range(360):
        layout = LAYOUTS[k % len(LAYOUTS)]
        text, want = page(rng, layout)
        assert "<article" not in text or layout == "teaser"
        if html.main_text(text) != want:
            wrong.append(layout)
    assert len(wrong) <= 3, wrong


def test_the_bounds_decide_on_marked_pages_too(sf_dir):
    """Lines that names and words leave in, and that the surge and dive points cut: on every page that marks its article, with
    lines before and after it that no name or word tells."""
    rng = random.Random(21)
    for _ in range(60):
        body, want = article(rng)
        before, after = sentence(rng, rng.randint(1, 9)), sentence(rng, rng.randint(1, 9))
        text = f"<body><div>{before}</div><nav>{links(rng, 4)}</nav><article>{body}</article><div>{after}</div><p>{links(rng, 3)}</p></body>"
        found = html.blocks(text)
        left = [line.text for line, out in zip(found.lines, html.against(found), strict=True) if line.text and not out]
        assert before in left and after in left
        assert html.main_text(text) == want


def test_marked_unmarked_and_bare_pages_have_equal_texts(sf_dir):
    for (text,) in duckdb.sql(f"select html from '{sf_dir}/pages.parquet'").fetchall():
        want = html.main_text(text)
        assert want and want == html.main_text(re.sub(r"(?<=<)article|(?<=</)article", "div", text)) == html.main_text(re.sub(r"</?article>", "", text))


def test_tags_without_partners_cost_no_walk():
    def seconds(text):
        began = time.perf_counter()
        html.main_text(text)
        return time.perf_counter() - began

    for part in ("<div></x></span></nav>", "<article></main></div>", "<div><p></p></article>", "<a href='"):
        assert seconds(part * 20_000) < 12 * max(0.02, seconds(part * 4000))


def test_short_ends_and_link_lines_of_the_article():
    long = " ".join(["sentence"] * 40)
    assert html.main_text(f"<div><h1>Title of it</h1><p>By A. Lee</p><p>2 May</p><p>{long}</p><p>So.</p><p>It</p><p>is.</p><p>Yes.</p></div>").split("\n") == ["Title of it", "By A. Lee", "2 May", long, "So.", "It", "is.", "Yes."]
    assert html.main_text(f"<nav><a>x</a></nav><div><h1>T</h1><p>{long}</p><p>See <a href='/'>all of the story here</a></p></div><footer>f</footer>").split("\n")[-1] == "See all of the story here"


def test_query_equals_an_independent_extractor(spark, sf_dir):
    pages = {i: (u, h) for i, u, h in duckdb.sql(f"select page_id, url, html from '{sf_dir}/pages.parquet'").fetchall()}
    rows = queries.op9_html(spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for r in rows:
        inner = pages[r.page_id][1].partition("<article>")[2].partition("</article>")[0]
        parts = (" ".join(entities.unescape(re.sub(r"</?(?:b|br)>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner))
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id][0], want := "\n".join(p for p in parts if p), len(want))
