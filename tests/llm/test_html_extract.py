import html as entities
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablemargin.llm import html_extract
from tablemargin.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def main_of(page):
    return "\n".join(t for r, t in html_extract.blocks(page) if r == html_extract.KEEP)


def test_query_against_the_template(spark):
    """Pages of the shared tables hold one article of headings and paragraphs; a few regular expressions read that."""
    pages = {p.page_id: p for p in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    got = QUERIES["op10_html_extract"](spark, SF_DIR).collect()
    assert len(got) == len(pages)
    for r in got:
        body = re.search(r"<article>(.*?)(?:</article>|\Z)", pages[r.page_id].html, re.S).group(1)
        parts = re.split(r"<h1>|</h1>|<p>|</p>", re.sub(r"</?b>|<br>", " ", body))
        want = "\n".join(x for x in (" ".join(entities.unescape(p).split()) for p in parts) if x)
        assert (r.text, r.n_chars, r.url) == (want, len(want), pages[r.page_id].url)


def test_chrome_inside_and_outside_the_article():
    page = """<html><head><title>T</title><script>var a = "</p><article>no";</script></head><body class="has-sidebar">
    <header>Logo</header><nav>Menu</nav><div id="cookie-notice">We use cookies</div><main><article class="post with-comments">
    <h1>A &amp; B&nbsp;title</h1><div class="share-buttons">Share</div><p>One <b>bold</b>, <span class="ad">advert</span>text<br>goes on.
    <p>Two &lt;three&gt; &#233;</p><aside>Side</aside><form>Mail <input value="x > y"></form><ul><li>first<li>second</ul>
    <section class="comments"><article class="comment">Nice!</article></section></article></main>
    <div role="complementary">Bar</div><footer>Foot</footer></body></html>"""
    assert main_of(page) == "A & B title\nOne bold, text goes on.\nTwo <three> é\nfirst\nsecond"


@pytest.mark.parametrize("page,want", [
    (None, ""), ("", ""), ("<article><p>cut off <b>he", "cut off he"), ("<article>a < b <p>c</article>", "a < b\nc"),
    ("<article><script>x", ""), ("<article>x<!-- y --> z</article>", "x z"), ("<ARTICLE><P CLASS='Ad'>x<P>y</ARTICLE>", "y"),
    ("<article><p>a</p></div></p>b</article>", "a\nb"), ("<article>" + "<div>" * 3000 + "deep", "deep"),
    ("<article>" + "word " * 50000 + "</article>", ("word " * 50000).strip())])
def test_odd_pages(page, want):
    assert main_of(page) == want


@pytest.mark.parametrize("wrapper", ['class="layout has-sidebar"', 'class="no-sidebar"', 'class="page--with-sidebar x"', 'id="post-navigation-wrap"',
                                     'class="overlay"', 'class="site-header-fixed"'])
@pytest.mark.parametrize("name", ["div", "section", "app-root"])
def test_an_article_in_a_wrapper_with_the_name_of_chrome(name, wrapper):
    page = f'<body><nav>n</nav><{name} {wrapper}><article><p>the text</p><div class="nav">no</div></article><aside>no</aside></{name}></body>'
    assert main_of(page) == "the text"


def test_other_articles_in_chrome_are_dropped():
    page = """<main><p>own</p><div class="related"><article>teaser</article></div></main><div class="sidebar"><article>teaser</article></div>
    <div class="comments"><article>Nice!</article></div><div class="x-nav" hidden><article>no</article></div><nav><article>no</article></nav>"""
    assert main_of(page) == "own"
    assert main_of('<div class="content sidebar"><main>own</main></div>') == "own"


def pages_of(n, url="http://h.example/{}"):
    """Pages without a marked article: two lines that every page has around text of its own."""
    out = []
    for i in range(n):
        own = " ".join(f"own{i}x{k}" for k in range(12))
        out.append((i, url.format(i), f"<body><div>welcome to the home of all the good things we sell</div><div>{own}</div>"
                                      f"<div>short {i}</div><div>read our terms and come back soon to see more of it</div></body>"))
    return out


@pytest.mark.parametrize("shard_pages", [2000, 3])
def test_repeated_runs_of_a_host_are_removed(spark, shard_pages):
    rows = pages_of(20) + [(50, "http://other.example/", pages_of(1)[0][2]), (51, None, "<p>alone</p>"), (52, "http://h.example/z", None)]
    rows += [rows[0]] * 5
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("old"))
    got = html_extract.extract(df, shard_pages=shard_pages).collect()
    assert len(got) == len(rows)
    for r in got:
        own = " ".join(f"own{r.page_id}x{k}" for k in range(12))
        if r.page_id < 20:
            assert r.text == f"{own}\nshort {r.page_id}" and r.n_chars == len(r.text)
    by_id = {r.page_id: r.text for r in got}
    # Once on its host, the same lines are text; repeated rows of a page are one page.
    assert by_id[50].startswith("welcome to") and by_id[51] == "alone" and by_id[52] == ""


def test_copies_of_an_article_stay(spark):
    rows = [(i, "http://h.example/", "<nav>a b</nav><article><p>" + "the same words again " * 20 + "</article>") for i in range(6)]
    got = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert all(r.text == ("the same words again " * 20).strip() for r in got)


def test_copies_of_a_page_without_a_marked_article_stay(spark):
    """Copies with page_ids of their own count as one page; what also stands on other pages of the host is removed."""
    text = " ".join(f"w{k}" for k in range(40))
    rows = [(i, f"http://h.example/?page={i}", f"<nav>page {i} of all</nav><div>{text}</div>") for i in range(6)]
    rows += [(100 + i, u, h) for i, u, h in pages_of(5, "http://g.example/{}")]
    rows += [(200 + i, "http://g.example/copy", pages_of(1)[0][2]) for i in range(4)]
    got = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), shard_pages=2).collect()
    by_id = {r.page_id: r.text for r in got}
    assert len(got) == len(rows) and all(by_id[i] == text for i in range(6))
    own = [" ".join(f"own{i}x{k}" for k in range(12)) + f"\nshort {i}" for i in range(5)]
    assert [by_id[100 + i] for i in range(5)] == own and all(by_id[200 + i] == own[0] for i in range(4))


def test_suffix_array_against_sorting():
    rng = np.random.default_rng(4)
    for n in (0, 1, 2, 50, 300):
        tokens = rng.integers(0, 3, n)
        want = sorted(range(n), key=lambda i: tokens[i:].tolist())
        order = html_extract.suffix_array(tokens)
        assert order.tolist() == want
        if n:
            common = html_extract.common_prefixes(tokens, order, 4)
            for k in range(1, n):
                a, b = tokens[want[k - 1]:].tolist(), tokens[want[k]:].tolist()
                same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
                assert common[k] == min(same, 4)


def test_empty_table(spark):
    assert html_extract.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize("shard_pages", [2000, 2])
def test_loose_blocks_of_pages_with_an_article_are_judged_by_repetition(spark, shard_pages):
    """What stands outside a marked article is removed where it repeats on the host, and stays where it does not."""
    menu = "welcome to the home of all the good things we sell"
    rows = [(i, f"http://h.example/{i}", f"<div>{menu}</div><article><p>article {i}</p></article><div>a note of page {i}</div>") for i in range(6)]
    # A teaser that repeats what other pages have inside their articles; the articles keep it.
    shared = "one two three four five six seven eight nine"
    rows += [(10 + i, f"http://g.example/{i}", f"<article><p>own {i}</p><p>{shared}</p></article>") for i in range(4)]
    rows += [(20, "http://g.example/all", f"<div>{shared}</div><div>list of all</div>")]
    got = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), shard_pages=shard_pages).collect()
    by_id = {r.page_id: r.text for r in got}
    assert len(got) == len(rows) and all(by_id[i] == f"article {i}\na note of page {i}" for i in range(6))
    assert all(by_id[10 + i] == f"own {i}\n{shared}" for i in range(4)) and by_id[20] == "list of all"
