import random
import re

import pytest

from pyspark.sql import functions as F

from episodica.llm import secrets

PLAIN = (
    (re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m[2]) >= 8),
    (re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
    (re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 32),
)
BITS = ["password", "Secret", "TOKEN", "api_key", "apikey", ":", "=", " ", '"', "'", "abc", "12345678", "AKIA", "ABCDEFGHIJKL", "deadbeef", "deadbeef", "\n", "é\U0001f600", "_", "x" * 20]


SIGNS = "A-Za-z0-9+/_=-"
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"


@pytest.fixture(scope="module")
def model(spark):
    sql, bars = secrets.train(spark)
    return [float(x) for x in re.search(r"split\('([^']*)'", sql)[1].split(",")], bars


def brute(text, model):
    """All spans by plain loops: base patterns, then tokens over the bar of their length."""
    values, bars = model
    base = sorted((m.start(), k, m.end()) for k, (p, ok) in enumerate(PLAIN) for m in p.finditer(text) if ok(m))
    added = []
    for m in re.finditer(f"[{SIGNS}]+", text):
        t = m[0]
        if len(t) < 8 or not (re.search("[0-9]", t) or re.search("[a-z][A-Z]", t)) or any(s < m.end() and m.start() < e for s, _, e in base):
            continue
        mean = sum(values[ord(a) * 128 + ord(b)] for a, b in zip(t, t[1:])) / (len(t) - 1)
        if mean > bars[sum(len(t) >= n for n in secrets.LENGTHS) - 1]:
            added.append((m.start(), 3, m.end()))
    return sorted(base + added)


def test_all_spans_are_those_of_plain_loops(spark, model):
    r = random.Random(5)
    token = lambda n: "".join(r.choice(LETTERS) for _ in range(n))
    bits = [*BITS, *(token(n) for n in (7, 8, 11, 12, 17, 19, 20, 40)), "getUserName2", "2024-01-05", "some/path/file1", " ", " "]
    texts = ["".join(r.choice(bits) for _ in range(r.randrange(30))) for _ in range(300)] + [None, "", "deadbeef" * 9000, "a1b2 " * 5000, "password=abcdefgh " * 2500, token(30_000)]
    df = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in enumerate(texts)], "doc_id long, text string, secrets string, t string, row string")
    out = secrets.scan(df.unionByName(df.limit(3)))
    assert out.columns == [*df.columns, "secrets_"] and out.count() == len(texts) + 3
    for x in out.collect():
        t = x.text or ""
        assert [(s.s, s.k, s.e) for s in x.secrets_] == brute(t, model)
        assert all(t[s.s : s.e] == s.t for s in x.secrets_) and (x.secrets, x.t, x.row) == ("x", "y", "z")


def test_planted_tokens_are_found_and_ordinary_ones_left(spark):
    r = random.Random(11)
    planted = [(n, f"word {''.join(r.choice(LETTERS) for _ in range(n))}. next") for n in (8, 9, 12, 17, 19, 24) for _ in range(100)]
    plain = "see version 12.04.2024 of getUserAccount and user_account_17 in /usr/local/lib64/file-name2 on 2024-01-05 or README4 with 4041894974608795 and UTF-8 to i18n_messages or src/main2/java".split()
    ordinary = [(0, f"{a} {b}") for a in plain for b in plain] + [(0, "ungkeitververfassunggebundesverein Donaudampfschifffahrt 1234567890123")]
    out = secrets.scan(spark.createDataFrame(planted + ordinary, "n int, text string")).select("n", F.size("secrets").alias("k")).collect()
    for n in (8, 9, 12, 17, 19, 24):
        assert sum(x.k == 1 for x in out if x.n == n) >= 93, n
    assert not any(x.k for x in out if x.n == 0)


def test_empty(rows, none):
    assert secrets.scan(rows).columns == [*rows.columns, "secrets"] and secrets.scan(rows).count() == rows.count()
    assert secrets.scan(none).count() == 0
