import itertools
import random

from ledgerlens.llm import html_text as H
from ledgerlens.llm import queries
from llm_cases import SMALL_SF

PAGE = """<!DOCTYPE html><html class="no-comments"><head><title>T</title><script>var a="</p><p>x</p>";</script>
<style>p{}</style></head><body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></ul></nav>
<div class="cookie-notice">We use cookies on this site to make it work.</div>
<article class="post"><header><h1>A &amp; B</h1></header><p>First  line,<br>second
line of <b>bold</b><i>ness</i>.<div class="ad">Buy now, this is a very good offer.</div><p>Last &eacute; paragraph<!-- no -->.
<form><label>Mail</label><input><p>Subscribe to our letter today.</p></form><ul><li>one<li>two</ul>
<table><tr><td>c1<td>c2</table><section id="comments"><p>Great article, thank you so much for it!</p></section>
<p hidden>secret</p></article><aside><p>Related stories that you may like to read.</p></aside>
<footer>&copy; 2020 Site. All rights reserved.</footer></body></html>"""


def test_page():
    assert H.main_text(PAGE).split("\n") == ["A & B", "First line, second line of boldness.", "Last é paragraph.",
                                             "one", "two", "c1", "c2"]


def test_broken_pages():
    assert H.main_text(None) == H.main_text("") == H.main_text("<p></p>") == ""
    text = "A long enough sentence, with several words in it, that reads as content. " * 3
    assert H.main_text(f"<div><p>{text}") == text.strip()
    assert H.main_text(f"<p>{text}<p class=\"x") == text.strip()
    assert H.main_text(f"<article>3 < 4 and 5 > 2 {text}</span></article>") == f"3 < 4 and 5 > 2 {text.strip()}"
    assert H.main_text("<article>x <script>never closed") == "x"
    assert H.main_text("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"
    assert len(H.main_text("<article>" + "<p>some words.</p>" * 5000).split("\n")) == 5000


def test_inline_boilerplate_loses_only_itself():
    text = "A long enough sentence, with several words in it, that reads as content."
    for ad in ('<span class="ad">Buy</span>', '<a class="share" href="/s"><b>Share</b> this</a> <span id="ads">Buy</span>'):
        for line in (f"{ad} {text}", f"{text} {ad}", f"{ad} {text} {ad}"):
            assert H.main_text(f"<article><p>{line}</p></article>") == text, line
        assert H.main_text(f"<article><p>{ad}</p><p>{text}</p></article>") == text
    (block,) = H.blocks(f'<div><p><a class="ad" href="/">Buy</a> {text}</p></div>')
    assert block.context.name == "p" and block.linked == 0
    (block,) = H.blocks(f'<div><p><span class="ad">{text}</span> </p></div>')
    assert block.context.boilerplate


def test_only_whole_attributes_count():
    text = "A long enough sentence, with several words in it, that reads as content."
    for attributes in ('title="the hidden truth"', 'data-hidden="false"', 'data-id="share-5"', "title='a class=ad b'",
                       'data-class=ad', 'data-x="1" alt="role=navigation"', 'title="style=display:none"', 'x-role="menu"'):
        assert H.main_text(f"<article><p {attributes}>{text}</p></article>") == text, attributes
        assert H.main_text(f"<article><div {attributes}><p>{text}</p></div></article>") == text, attributes
    assert H.main_text(f'<article><p>{text} <a href="/p?id=related-12">More</a></p></article>') == f"{text} More"
    for attributes in ("hidden", "HIDDEN=''", "title=x hidden", "style='color:red;display: none'", "aria-hidden=true",
                       'class="ad"', "class=ad", "id = 'share-5'", 'data-hidden="false"class="ad"', "role=navigation"):
        assert H.main_text(f"<article><p {attributes}>{text}</p></article>") == "", attributes


def test_cut_is_minimal():
    rng = random.Random(5)
    for _ in range(200):
        n = rng.randint(1, 7)
        scores = [rng.uniform(-3, 3) for _ in range(n)]
        links = [(i, j, rng.uniform(0, 2)) for i in range(n) for j in range(i) if rng.random() < 0.5]

        def cost(labels):
            return sum(abs(z) for z, y in zip(scores, labels) if (z > 0) != y) + \
                sum(w for i, j, w in links if labels[i] != labels[j])

        best = min(cost(x) for x in itertools.product([False, True], repeat=n))
        assert abs(cost(H.min_cut(scores, links)) - best) < 1e-6


def test_query_and_odd_rows(spark):
    rows = queries.op8_html_text(spark, SMALL_SF).collect()
    assert len(rows) == 50 and all(r["n_chars"] == len(r["text"]) > 0 for r in rows)
    pages = spark.createDataFrame([(1, None, None, 1), (1, None, None, 1), (2, "u", "", 1), (3, "u", "😀 plain text only, no markup at all.", 1)],
                                  "page_id long, url string, html string, text int")
    got = sorted((r["page_id"], r["text"], r["n_chars"]) for r in H.extract(pages).collect())
    assert got[:3] == [(1, "", 0), (1, "", 0), (2, "", 0)] and got[3][2] == len(got[3][1])
    assert H.extract(pages.where("false")).collect() == []
