import html
import re

import numpy as np
import pytest

from mobility.llm import html_text as op
from tests.conftest import SF_MID


@pytest.fixture(scope="module")
def model(spark):
    return op.train(spark.read.parquet(f"{SF_MID}/pages.parquet"))


def _article(page):
    """The marked article's blocks, by plain pattern matching."""
    body = re.search("<article>(.*?)(</article>|$)", page, re.S)[1]
    blocks = re.split(r"</?(?:p|h1|br|div|article)\b[^>]*>", body)
    texts = (" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in blocks)
    return "\n".join(t for t in texts if t)


def test_every_page_gives_its_article(spark, model):
    pages = spark.read.parquet(f"{SF_MID}/pages.parquet")
    rows = op.extract(pages, model).collect()
    assert len(rows) == pages.count()
    assert [r.page_id for r in rows if r.text != _article(r.html) or r.n_chars != len(r.text)] == []


PAGE = """<html><head><title>t</title><script>var x = "<p>no</p>";</script></head><body><header><h1>Site</h1></header>
<div class="cookie-notice">We use cookies here</div><nav><a href=1>Home</a> <a href=2>News</a></nav>
<{0}><h1>My title</h1><p>The first paragraph of an article   with a lot of text &amp; &eacute;t&eacute;, and more of it.</p>
<div class="sponsored">Buy this great thing now</div><p>The second <b>bold</b>&nbsp;paragraph goes on for a while, too<p>A third one that is not closed
</{1}><aside class="sidebar"><p>Other stories that you may like to read</p></aside><section id="comments"><p>Great post! I agree very much.</p>
</section><form>Subscribe <input></form><footer>(c) 2020</footer></body></html>"""
TEXT = ("My title\nThe first paragraph of an article with a lot of text & été, and more of it.\n"
        "The second bold paragraph goes on for a while, too\nA third one that is not closed")


@pytest.mark.parametrize("tags", [("article", "article"), ("main", "main"), ('div id="content"', "div")])
def test_pages_unlike_those_learned_from(model, tags):
    assert op.main_text([PAGE.format(*tags).encode()], model) == [TEXT]


def test_decoding_is_consistent_and_the_likeliest():
    rng = np.random.default_rng(2)
    for _ in range(60):
        n = int(rng.integers(1, 11))
        parent = [-1, *(int(rng.integers(0, i)) for i in range(1, n))]
        odds = rng.normal(0, 2, n)
        best = max(sum(odds[i] for i in range(1, n) if k >> i & 1) for k in range(1 << n)
                   if k & 1 and all(not k >> i & 1 or k >> parent[i] & 1 for i in range(1, n)))
        kept = op.decode(parent, odds)
        assert all(not kept[i] or kept[parent[i]] for i in range(1, n))
        assert np.isclose(odds[1:][kept[1:]].sum(), best)


def test_boosting_fits_what_one_split_cannot():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    model = op.BoostedTrees.fit(x[:1000], y[:1000])
    assert ((model.log_odds(x[1000:]) > 0) == y[1000:]).mean() > 0.9


def test_defined_cases(spark, model):
    rows = [(1, None), (2, ""), (2, ""), (None, "<p"), (4, "<div>" * 20_000), (5, "</p></div>&amp;"), (6, "<script>x"), (7, "<!-- <p>x</p>")]
    df = spark.createDataFrame(rows, "page_id long, html string").selectExpr("*", "'u' AS url", "1 AS TEXT")
    got = op.extract(df, model)
    assert got.columns == ["page_id", "html", "url", "text", "n_chars"] and got.count() == 8
    assert {r.text for r in got.where("page_id <> 5").collect()} == {""}
    assert op.extract(df.limit(0), model).count() == 0
    assert op.train(df.limit(0)) is op.UNTRAINED and op.train(df) is op.UNTRAINED


@pytest.mark.parametrize("inside", ['<div class="notices">', '<div class="sidebars">', '<section id="feedback">', '<div class="reader-responses">'])
def test_what_lies_in_an_article_but_is_none_of_it(model, inside):
    close = "</section>" if "section" in inside else "</div>"
    page = (f"<html><body><article><h1>My title</h1><p>{'The first paragraph of an article. ' * 4}</p>{inside}"
            f"<p>Something else that readers say or see</p>{close}<p>{'And a last one of it. ' * 5}</p></article></body></html>")
    assert "Something else" not in op.main_text([page.encode()], model)[0]
    assert op.main_text([page.encode()], model)[0].count("\n") == 2


def test_elements_within_a_line_break_no_block(model):
    line = ("one <my-tag>two</my-tag> three <ruby>four<rt>five</rt></ruby> <picture><img src=x></picture>six "
            "<input value=y>seven <x-y:z>eight</x-y:z> <meter>nine</meter><br>ten")
    page = (f"<html><body><article><h1>Title of the page</h1><p>{line} {'and more words of the text ' * 5}</p>"
            f"<p>{'A second paragraph of the article. ' * 6}</p></article></body></html>")
    got = op.main_text([page.encode()], model)[0].split("\n")
    assert got[1] == "one two three fourfive six seven eight nine" and got[2].startswith("ten and more")


def test_long_and_broken_markup_takes_linear_time(model):
    import time
    for text in ("<a " * 350_000, "<!-- " * 200_000, "<p" * 500_000, "<a \"" * 250_000, "<b>" * 100_000 + "x" + "</b>" * 100_000):
        start = time.perf_counter()
        op.main_text([text.encode()], model)
        assert time.perf_counter() - start < 5
    assert op.main_text([b"<article><p>" + b"Kept text of it. " * 20 + b"</p><!-- a > b"], model) == [("Kept text of it. " * 20).strip()]
