"""The page parser: any string is a page, in time in proportion to its length; names inside articles."""

import random
import time
from html.parser import HTMLParser

import pytest

from episodica.llm import html

BAD = {
    "declaration": "<article>x<![abc[y]]></article>",
    "tags without an end": "<b" * 500_000,
    "spaced tags without an end": "<b " * 300_000,
    "unmatched ends": "<div>" * 60_000 + "</b>" * 120_000,
    "paragraphs behind tables": "<p><table>" + "<div>" * 100_000 + "x",
    "open quotes": "<a b='x>y " * 100_000,
    "many attributes": "<a " + "b=c " * 200_000 + ">x</a>",
    "open comment": "<!-- " * 200_000,
    "open scripts": "<script>" * 120_000,
    "half references": "&#" + "1" * 1_000_000 + ";" + "&#x" * 100_000 + "&" * 100_000,
    "angle brackets": "<" * 1_000_000,
    "spaces in a tag": "<a" + " " * 1_000_000,
    "equals": "<a " + "=" * 1_000_000 + ">",
    "slashes": "<a " + "/" * 1_000_000 + ">",
}


@pytest.mark.parametrize("name", BAD)
def test_bad_pages(name):
    page = BAD[name]
    began = time.process_time()
    html.extract(page)
    html.page_stats(page)
    # far above what it takes on a slow machine, far below what time growing with the square would take
    assert time.process_time() - began < 15 * max(len(page) / 1e6, 0.4)


def test_fuzz():
    rng = random.Random(4)
    bits = ["<", ">", "</", "<!", "<!--", "-->", "<![", "]]>", "<?", "&", "&#", "&#x41", "&amp;", ";", "=", '"', "'", "/", " ", "\n", "\x00", "é", "a", "p", "div", "article", "script", "table", "class", "x y", "<p>", "</p>", "<div>", "</div>", "<article>", "</article>", "<title>", "</title>", "<br/>"]
    for _ in range(4_000):
        page = "".join(rng.choices(bits, k=rng.randint(0, 60)))
        assert isinstance(html.extract(page), str) and isinstance(html.page_stats(page), list)
        html.extract(page, frozenset({1, 2}), False)


def test_as_the_standard_parser_on_plain_pages(spark, sf):
    """On the given pages the tree of tags is that of the standard library's parser."""

    class Events(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.seen = []

        def handle_starttag(self, tag, attrs):
            self.seen.append((tag, tuple((k, v or "") for k, v in attrs)))

        def handle_endtag(self, tag):
            self.seen.append(tag)

        def handle_data(self, data):
            self.seen.append(" ".join(data.split()))

    class Ours(html.Dom):
        def __init__(self):
            super().__init__()
            self.seen = []

        def start(self, tag, attrs, alone):
            self.seen.append((tag, tuple(attrs.items())))
            super().start(tag, attrs, alone)

        def close(self, tag):
            self.seen.append(tag)
            super().close(tag)

        def text(self, data, raw=False):
            super().text(data, raw)
            self.seen.append(" ".join(self.stack[-1][0].children[-1].split()))

    for r in spark.read.parquet(f"{sf}/pages.parquet").collect():
        theirs, ours = Events(), Ours()
        theirs.feed(r.html or "")
        theirs.close()
        ours.feed(r.html or "")
        assert [x for x in theirs.seen if x] == [x for x in ours.seen if x]


def test_references():
    assert html.extract("<p>&#65;&#0000000000065;&#x0000000041; &amp;lt; &eacute; &#99999999999; &#x1F600; &nope; &#; 1 & 2</p>") == "AAA &lt; é � \U0001f600 &nope; &#; 1 & 2"


@pytest.mark.parametrize(
    ("name", "kept"),
    [("reply-text", True), ("social-history", True), ("ad-hoc", True), ("search-results", True), ("form-of-life", True), ("share-bar", False), ("ad-slot", False), ("comments", False), ("social_links", False), ("related", False)],
)
def test_names_inside_an_article(name, kept):
    page = f'<body><article><h1>Title</h1><div class="{name}"><p>planted words</p></div><p id="{name}">more of them</p><p>end</p></article></body>'
    assert html.extract(page) == ("Title planted words more of them end" if kept else "Title end")
