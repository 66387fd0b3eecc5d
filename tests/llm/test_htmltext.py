"""HTML extraction: blocks and zones by hand, covered runs against a naive search, whole pages in Spark."""
import random
from collections import defaultdict

import numpy as np
import pytest

from fieldlens.llm import htmltext, queries


def text(page, removed=()):
    return htmltext.main_text(htmltext.blocks(page), removed)[0]


def test_article_alone():
    page = ("<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{a:b}</style><script>var t='<p>no</p>';</script></head>"
            "<body class='has-sidebar'><header><a href='/'>Site</a></header><nav><ul><li>One<li>Two</ul></nav>"
            "<div class=\"ad\">Buy &lt;now&gt;</div><article class='post'><header><h1>Head &amp line</h1></header>"
            "<p>First <b>bold<br>word</b>\n  and&nbsp;more.<p>Second &#233;&#x1F600; &copy;"
            "<aside>Beside</aside><form><input value='x'><p>Name</p></form><div class='share'>Share</div>"
            "<ul><li>a<li>b</ul><table><tr><td>1<td>2</table><p>1 < 2 & 3</p></article>"
            "<section id='comments'><article class='comment'><p>Nice</p></article></section>"
            "<div role=alert>Cookies!</div><footer>&copy; end</footer>")
    assert text(page) == ("Head & line\n\nFirst bold word and more.\n\nSecond é\U0001F600 ©\n\na\n\nb\n\n1\n\n2\n\n1 < 2 & 3")


def test_odd_pages():
    assert text(None) == text("") == text("<p></p><!-- a") == ""
    assert text("just words\n here") == "just words here"
    assert text("<main><p>a<script>x</main>") == "a"
    assert text("<div class=sidebar>never closed<article><p>kept</article>") == "kept"
    assert text("<div><div class='cookie-notice'>c</div><p>text <span class=ad>buy</span> more</p></div></div>") == "text\n\nmore"
    assert text("<p title='a > b'>x</p a><b><i>y</b>z</i>") == "x\n\nyz"
    assert text("&am; &bogus; &#0;") == "&am; &bogus; �"
    assert text("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"
    assert text("<a \"" * 3000).startswith("<a")


def naive(pages, run):
    seen = defaultdict(set)
    for k, p in enumerate(pages):
        for i in range(len(p) - run + 1):
            seen[tuple(p[i:i + run])].add(k)
    return [[i for i in range(len(p) - run + 1) if len(seen[tuple(p[i:i + run])]) > 1 and 0 not in p[i:i + run]] for p in pages]


@pytest.mark.parametrize("run", [1, 2, 3, 5, 8])
def test_runs_equal_a_naive_search(run):
    rng = random.Random(run)
    for _ in range(20):
        pages = [[rng.choice([0, 1, 1, 2, 3, 2 ** 32 - 1]) for _ in range(rng.randint(1, 60))] for _ in range(rng.randint(1, 6))]
        runs, hashes = htmltext.repeated_runs([np.array(p) for p in pages], run)
        assert [r.tolist() for r in runs] == naive(pages, run)
        whole = {tuple(p[i:i + run]) for p in pages for i in range(len(p) - run + 1) if 0 not in p[i:i + run]}
        assert len(hashes) == len(set(hashes.tolist())) == len(whole)
    assert htmltext.repeated_runs([]) [0] == []


def own(k, n=30):
    rng = random.Random(k)
    return " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(n)) + "."


CHROME = "<div class=x1><p>Welcome to our site, find all of our offers here today</p></div>"
END = "<div class=x2><p>All rights are reserved by us and our many good friends</p></div>"


def site(n, host="h.example"):
    rows = [(k, f"http://{host}/{k}", f"<html><body>{CHROME}<div><h2>{own(k, 4)}</h2><p>{own(k)}</p></div>{END}</body></html>") for k in range(n)]
    want = {k: f"{own(k, 4)}\n\n{own(k)}" for k in range(n)}
    return rows, want


def check(spark, rows, want, **kind):
    got = htmltext.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), **kind).collect()
    assert len(got) == len(rows)
    assert {r["page_id"]: r["text"] for r in got} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    return got


@pytest.mark.parametrize("array,broadcast", [(1 << 20, 1 << 20), (150, 1 << 20), (60, 0)])
def test_hosts_lose_what_repeats(spark, array, broadcast):
    rows, want = site(40)
    # The same words on one page of another host are no boilerplate there.
    rows.append((100, "http://other.example/", f"<body>{CHROME}<p>{own(100)}</p>"))
    want[100] = f"Welcome to our site, find all of our offers here today\n\n{own(100)}"
    # An article is text though it stands on two pages, and though its page has chrome.
    rows += [(k, f"http://h.example/{k}", f"<body>{CHROME}<p>{k}</p><article><p>{own(200)}</p></article>{END}") for k in (200, 201)]
    want |= {200: own(200), 201: own(200)}
    # Equal pages are one page; near copies with nothing of their own keep their text.
    rows += [(k, "http://two.example/", f"<p>{own(300)}</p>") for k in (300, 301)]
    rows += [(k, f"http://three.example/{k}", f"<p>{own(302)}</p><!-- {k} -->") for k in (302, 303)]
    want |= {300: own(300), 301: own(300), 302: own(302), 303: own(302)}
    got = check(spark, rows, want, array=array, broadcast=broadcast)
    assert {r["n_repeated"] for r in got if r["page_id"] < 40} == {2}


def test_a_run_that_only_two_arrays_share(spark):
    rows = [(k, "http://h.example/", f"<p>{own(k, 60)}</p>" + (CHROME if k in (3, 17) else "")) for k in range(20)]
    check(spark, rows, {k: own(k, 60) for k in range(20)}, array=50)


def test_edge_cases(spark, empty, edge):
    rows = [(1, None, None), (2, None, ""), (None, "not a url", "<p>x</p>"), (4, "http://u@H.example:80/a", "<p>" + own(4, 50_000)),
            (5, "http://h.example/b", "<p>" + own(4, 50_000) + "<p>tail of this one page only")]
    got = htmltext.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in got} == {1: "", 2: "", None: "x", 4: own(4, 50_000), 5: "tail of this one page only"}
    clash = spark.createDataFrame([("u", "<p>a", 1, "x", "y", "z")], "url string, html string, removed int, page string, Text string, host string")
    out = htmltext.extract(clash)
    assert [tuple(r) for r in out.collect()] == [("u", "<p>a", 1, "x", "z", "a", 1, 0)]
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert htmltext.extract(none).count() == 0


def test_query_over_the_given_pages(spark, sf_check):
    import html
    import re
    got = {r["page_id"]: r["text"] for r in queries.op11_html_text(spark, sf_check).collect()}
    pages = spark.read.parquet(f"{sf_check}/pages.parquet").collect()
    assert len(got) == len(pages)
    for p in pages:  # all are of one template
        article = re.search("<article>(.*)</article>", p["html"], re.S)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split("</?(?:p|h1)>", article)]
        assert got[p["page_id"]] == "\n\n".join(x for x in parts if x)
