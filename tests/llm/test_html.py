"""Main texts of pages."""

import numpy as np
from datamove.llm import html_text
from datamove.llm.html_text import content_blocks, extract_text, smoothed

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h2>Site</h2></header><nav><ul><li><a href="/a">Home</a></li></ul></nav><!-- ad --><div class="ad">Buy now, it is cheap.</div>
<div id="cookie-notice">We use cookies.</div><article><h1>Title &amp; more</h1><p><b>First  para&shy;graph<br>goes
on.<p>Second &#x3c;one&gt;.</p><p>X.</p><form><input name=q>Search</form><aside>Side</aside></article>
<section class="comments"><p>A reader says a very long thing about the article that goes on and on.</p></section><footer>&copy; me</footer></body></html>"""


def test_article_without_its_surroundings():
    assert content_blocks(PAGE) == ["Title & more", "First para\xadgraph goes on.", "Second <one>.", "X."]


def test_page_without_an_article_element():
    long = "This is a long paragraph of the main text, with a lot of words and few tags in it. " * 3
    page = f"<body><div><a href=x>One</a> <a href=y>Two</a></div><div><p>{long}</p><p>{long}</p></div><div><a>More</a><a>Links</a><a>Here</a></div></body>"
    assert content_blocks(page) == [long.strip()] * 2


def test_edges(spark):
    pages = [None, "", "plain  words", "<nav>Menu</nav>", "<p>open <b>tags", "<![x broken", "<p>a</p>" * 3000, "&lt;p&gt; &amp;amp;", "<p>twice</p>", "<p>twice</p>"]
    frame = spark.createDataFrame([(i, h, "mine") for i, h in enumerate(pages)], "page_id long, html string, text string")
    found = {r["page_id"]: r["text"] for r in extract_text(frame, ["page_id"]).collect()}
    assert [found[i] for i in (0, 1, 2, 3, 4)] == ["", "", "plain words", "", "open tags"]
    assert found[6] == "\n\n".join(["a"] * 3000) and found[7] == "<p> &amp;" and found[8] == found[9] == "twice"
    assert extract_text(frame.limit(0), ["page_id"]).collect() == []


def test_smoothing_keeps_the_level():
    assert np.allclose(smoothed(np.ones(50))[4:-4], 1) and len(smoothed(np.ones(1))) == 1


def test_whole_table(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    rows = extract_text(pages, ["page_id", "html"]).collect()
    assert len(rows) == pages.count()
    for row in rows:
        assert row["text"] and "track(" not in row["text"] and "©" not in row["text"]


LONG = "A paragraph of the main text that goes on for a while, with many words and hardly any tags in between. "


def test_ratios_part_regions_that_markup_does_not_name():
    links = "".join(f"<p><a href=/{i}>Topic {i}</a></p>" for i in range(12))
    page = (
        f"<div>{links}</div><div><p><b>Buy</b> <i>now</i></p></div>"
        f"<div><h1>Title</h1><p>{LONG * 2}</p><p>Short.</p><div><p><a>Tag</a> <a>Tag</a></p></div><p>{LONG * 3}</p></div><div><p><a>Top</a></p></div>"
    )
    assert content_blocks(page) == ["Title", (LONG * 2).strip(), "Short.", (LONG * 3).strip()]


def test_regions_of_an_article_are_parted_too():
    rail = "".join(f"<p><a href=/{i}>Story {i}</a></p>" for i in range(9))
    page = f"<article><h1>Title</h1><p>{LONG * 2}</p><div>{rail}</div><p>{LONG}</p><p>End.</p></article>"
    assert content_blocks(page) == ["Title", (LONG * 2).strip(), LONG.strip(), "End."]


def test_sparse_regions_go_without_a_name(monkeypatch):
    monkeypatch.setattr(html_text, "NAMES", frozenset())
    monkeypatch.setattr(html_text, "OUTSIDE", html_text.OUTSIDE - {"nav", "footer", "aside", "form"})
    page = f"<nav><ul>{'<li><a href=x>Link</a>' * 8}</ul></nav><div class=ad>Buy now.</div><article><h1>T</h1>{f'<p>{LONG}</p>' * 5}</article><footer>me</footer>"
    assert content_blocks(page) == ["T", *[LONG.strip()] * 5]


def test_an_article_of_few_lines_is_taken_as_marked():
    page = "<nav><ul><li><a>One</a></ul></nav><div>A much longer line than all that the article has.</div><article><h1>T</h1><p><b>Short</b></article>"
    assert content_blocks(page) == ["T", "Short"]


def test_threshold_and_smoothing_decide_pages(spark, monkeypatch):
    html = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("html").collect()[:500]]
    before = [content_blocks(h or "") for h in html]
    for name, value, least in (("LAMBDA", 1e9, 200), ("LAMBDA", 3.5, 3), ("SIGMA", 0.2, 1)):
        with monkeypatch.context() as other:
            other.setattr(html_text, name, value)
            assert sum(content_blocks(h or "") != b for h, b in zip(html, before)) >= least, (name, value)
