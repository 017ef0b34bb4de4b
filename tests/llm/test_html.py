import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from episodica.llm import html
from episodica.llm.urlfilter import host


def test_extract():
    page = """<html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><a>menu</a></nav><!-- c --><div class="ad-box">buy</div>
      <article><header>by me</header><h1>Head&amp;line</h1><p>One <b>two</b>three<br>four<p>five&nbsp;six <form>no</form><div class="comments"><article>comment</article></div></article><footer>foot</footer></body></html>"""
    assert html.extract(page) == "Head&line One twothree four five six"
    assert html.extract(None) == html.extract("") == ""
    assert html.extract("<p>just <i>text</i>") == "just text"
    assert html.extract("<div>" * 5000 + "deep") == "deep"
    assert html.extract("<article>" + "<p>long text</p>" * 20_000) == " ".join(["long text"] * 20_000)
    assert html.extract("<article><p>a<table><tr><td>b<p>c</table>d</article>") == "a b c d"


def site(r, n, k, main):
    """Pages of one layout: a menu, a notice that repeats, a slot with a text of its own, the main text."""
    say = lambda m: " ".join("".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(m))
    for i in range(n):
        paragraphs = [say(20) for _ in range(r.randrange(2, 30))]
        title, slot = say(4), say(6)
        page = f"<body><div><ul>{''.join(f'<li><a>{say(1)}</a></li>' for _ in range(6))}</ul></div><div>Only here: read on</div><div>{slot}</div>"
        page += f"<{main}><h1>{title}</h1>{''.join(f'<p>{p}' for p in paragraphs)}</{main}><div>{say(7)}</div></body>"
        yield k * 1000 + i, f"http://h{k}.example/{i}", page, " ".join([title, *paragraphs])


@pytest.mark.parametrize("main", ["div", "article"])
@pytest.mark.parametrize("limit", [10_000, -1])
def test_tree_alone_finds_the_main_text(spark, main, limit):
    r = random.Random(8)
    rows = [x for k in range(2) for x in site(r, 30, k, main)]
    # hosts of few pages are judged by the tree of all pages
    rows += [x for k in range(2, 8) for x in site(r, 3, k, main)]
    df = spark.createDataFrame([x[:3] for x in rows], "page_id long, url string, html string")
    for roles in (True, False):
        got = {x.page_id: x.text for x in html.main_text(df, broadcast_paths=limit, roles=roles).collect()}
        assert all(got[i] == want for i, _, _, want in rows)


def test_importance_is_that_of_plain_counting(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    pages = pages.unionByName(pages.limit(40))
    seen, values = set(), defaultdict(lambda: (Counter(), Counter()))
    for url, page in [(x.h, x.html) for x in pages.select(host(F.col("url")).alias("h"), "html").collect()]:
        for p, path, _, style, content, _, _ in html.page_stats(page):
            if (url, path, p) not in seen:
                seen.add((url, path, p))
                values[url, path][0][style] += 1
                values[url, path][1][content] += 1

    def entropy(c):
        m = sum(c.values())
        return -sum(n / m * math.log(n / m, m) for n in c.values()) if m > 1 else 1.0

    rows = [(x.h, *s) for x in pages.select(host(F.col("url")).alias("h"), "html").collect() for s in html.page_stats(x.html)]
    stats = spark.createDataFrame(rows, "host string, page long, path long, parent long, style long, content long, flags long, chars long").dropDuplicates(["host", "path", "page"])
    got = {(x.host, x.path): (x.m, x.style, x.content) for x in html._importance(stats, ["host"]).collect()}
    assert got.keys() == values.keys()
    for k, (style, content) in values.items():
        assert got[k][0] == sum(style.values()) and got[k][1] == pytest.approx(entropy(style), abs=1e-9) and got[k][2] == pytest.approx(entropy(content), abs=1e-9)


def test_repeated_text_goes_and_headings_stay(spark):
    rows = [(i, f"http://h.example/{i}", f'<article><h1>same head</h1><div class="box">Read the guide first</div><p>body {i}</p></article>') for i in range(12)]
    rows += [(100, None, None), (101, "http://h.example/x", "<article><div class='box'>Read the guide first</div></article>"), (0, "http://h.example/0", rows[0][2])]
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], "page_id long, url string, html string, path string, host string, text string")
    out = html.main_text(df)
    assert out.columns == [*df.columns, "text_"] and out.count() == len(rows)
    got = {r.page_id: r.text_ for r in out.collect()}
    assert all(got[i] == f"same head body {i}" for i in range(12))
    assert got[100] == "" and got[101] == "Read the guide first"
    assert {(r.path, r.host, r.text) for r in out.collect()} == {("x", "y", "z")}
    assert html.main_text(df.where("false")).count() == 0
