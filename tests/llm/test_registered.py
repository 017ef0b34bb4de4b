"""The registered queries over the smallest tables, against their SQL or plain loops."""

import hashlib
import os
import re

import duckdb
import pytest

from episodica.llm import html, ngram_join, pii, queries
from tests.llm.test_ngram_join import brute as brute_groups
from tests.llm.test_pii import plain as plain_pii
from tests.llm.test_secrets import PLAIN
from tests.llm.test_urls_quality import brute as brute_quality

sha = lambda s: hashlib.sha256(s.encode()).hexdigest()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in os.listdir(sf):
        con.execute(f"create view {t.split('.')[0]} as select * from '{sf}/{t}'")
    return con


@pytest.fixture(scope="module")
def texts(spark, sf):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, sf, duck, name):
    df = queries.QUERIES[name](spark, sf)
    want = duck.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(repr, (tuple(r[c] for c in names) for r in df.collect()))) == sorted(map(repr, want.fetchall()))


def test_op1(spark, sf, texts):
    rows = queries.op1_pii(spark, sf).collect()
    assert {r.doc_id for r in rows} == set(texts) and len(rows) == len(texts)
    trees, bars = pii.model()
    for r in rows:
        base = plain_pii(texts[r.doc_id])
        assert [r[f"n_{k}"] for k in pii.KINDS] == [len(base[k]) for k in pii.KINDS]
        assert r.base_sha256 == sha(",".join(f"{k}:{s}:{e}" for k in pii.KINDS for s, e in base[k]))
        assert r.spans == ",".join(f"{k}:{s}:{e}" for k, s, e in pii.find(texts[r.doc_id], trees, bars)[1])


def test_op5(spark, sf, texts):
    rows = queries.op5_secrets(spark, sf).collect()
    assert {r.doc_id for r in rows} == set(texts) and len(rows) == len(texts)
    kinds = ("assign", "access", "hex")
    for r in rows:
        base = sorted((m.start(), k, m.end()) for k, (p, ok) in enumerate(PLAIN) for m in p.finditer(texts[r.doc_id]) if ok(m))
        assert [r[f"n_{k}"] for k in kinds] == [sum(k == i for _, k, _ in base) for i in range(3)]
        said = [f"{kinds[k]}:{s}:{e}" for s, k, e in base]
        assert r.base_sha256 == sha(",".join(said)) and [x for x in r.spans.split(",") if x and not x.startswith("random")] == said


def test_op5_counts_each_kind(spark, tmp_path):
    assign, access, hexes = "Password: 'hunter2hunter2'", "AKIAABCDEFGHIJKL", "0123456789abcdef" * 2
    rows = {1: ([assign], (1, 0, 0)), 2: ([access, access], (0, 2, 0)), 3: ([hexes, "x", assign, access, assign], (2, 1, 1)), 4: ([], (0, 0, 0)), 5: ([hexes] * 3, (0, 0, 3))}
    spark.createDataFrame([(i, "\n".join(bits)) for i, (bits, _) in rows.items()], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op5_secrets(spark, str(tmp_path)).collect()
    assert {r.doc_id: (r.n_assign, r.n_access, r.n_hex) for r in got} == {i: n for i, (_, n) in rows.items()}


def test_op6(spark, sf, texts):
    got = sorted(((r.doc_id, r.class_id, r.n_links) for r in queries.op6_ngram_join(spark, sf).collect()), key=repr)
    assert got == brute_groups(list(texts.items()))
    assert ngram_join.runs() == 8


def test_op7(spark, sf):
    rows = queries.op7_html(spark, sf).collect()
    pages = {r.page_id: (r.url, r.html) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        # every page of these tables has one article and no role inside it
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id][0], html.extract(pages[r.page_id][1]), len(r.text)) and r.text


def test_op8(spark, sf, texts):
    rows = queries.op8_toxicity(spark, sf).collect()
    assert {r.doc_id for r in rows} == set(texts) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)


def test_op10(spark, sf, texts):
    rows = queries.op10_quality(spark, sf).collect()
    assert len(rows) == len(texts)
    around, total = {}, 0
    for t in texts.values():
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        total += len(lines)
        for i, x in enumerate(lines):
            around.setdefault(x, []).append((lines[i - 1] if i else None, lines[i + 1] if i + 1 < len(lines) else None))
    boiler = {x for x, c in around.items() if len(x) <= 200 and len(set(c)) >= max(10, total * 1e-4) and 2 * len(set(c)) >= len(c)}
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) == brute_quality(texts[r.doc_id], boiler)
