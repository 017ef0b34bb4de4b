import random
from collections import Counter

import pytest

from episodica.llm import ngram_join


def sets(t):
    w = (t or "").lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(docs):
    s = [sets(t) for _, t in docs]
    up, links = list(range(len(docs))), Counter()

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            both = len(s[i] & s[j])
            if both and 5 * both >= 4 * len(s[i] | s[j]):
                links[i] += 1
                links[j] += 1
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        least.setdefault(root(i), []).append(d)
    first = {k: min((x for x in v if x is not None), default=None) for k, v in least.items()}
    return sorted(((d, first[root(i)], links[i]) for i, (d, _) in enumerate(docs)), key=repr)


@pytest.fixture
def docs():
    r = random.Random(9)
    word = lambda: "w" + str(r.randrange(3000))
    out = []
    for g in range(12):
        base = [word() for _ in range(r.choice([3, 6, 60, 120]))]
        for _ in range(r.choice([1, 2, 3, 60])):
            w = list(base)
            for _ in range(r.randrange(4)):
                w[r.randrange(len(w))] = word()
            out.append((len(out) * 7 % 1000 + 1000 * g, " ".join(w)))
    common = " ".join(word() for _ in range(40))
    out += [(50_000 + i, common + " " + " ".join(word() for _ in range(r.choice([2, 60])))) for i in range(80)]
    return out + [(90_000, None), (90_001, ""), (None, out[0][1]), (None, "only here is this"), out[1], out[1]]


@pytest.mark.parametrize("limits", [(128, 256, 1 << 20), (4, 8, 1 << 20), (128, 256, 500)])
def test_against_brute_force(spark, docs, limits, monkeypatch):
    monkeypatch.setattr(ngram_join, "SMALL", limits[0])
    monkeypatch.setattr(ngram_join, "TILE", limits[1])
    monkeypatch.setattr(ngram_join, "MASS", limits[2])
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, cid string")
    got = sorted(((r.doc_id, r.class_id, r.n_links) for r in ngram_join.join(df).collect()), key=repr)
    assert got == brute(docs)
    kept = ngram_join.keep_one(df)
    assert kept.columns == df.columns
    groups = {c for _, c, _ in brute([d for d in docs if d[0] is not None])}
    assert kept.where("doc_id is not null").count() == len(groups)


def test_hot_keys_are_dealt(spark):
    """A class with over a thousand documents, and a component with as many sets."""
    base = [f"w{i}" for i in range(100)]
    near = [" ".join([*base[:k], f"x{k}_{j}", *base[k + 1 :]]) for k in range(100) for j in range(11)]
    docs = [(i, " ".join(base)) for i in range(1200)] + [(5000 + i, t) for i, t in enumerate(near)]
    got = {r.doc_id: (r.class_id, r.n_links) for r in ngram_join.join(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert {v[0] for v in got.values()} == {0} and got[0][1] == 1199 + len(near)
    s = [sets(t) for t in near[:40]]
    every = [sets(t) for t in near]
    for i in range(40):
        assert got[5000 + i][1] == 1200 + sum(5 * len(s[i] & o) >= 4 * len(s[i] | o) for j, o in enumerate(every) if j != i)


def test_keep_one_is_the_same_each_time(spark, none):
    rows = [(1, "a b c d e f", "z"), (1, "a b c d e f", "y"), (2, "a b c d e f", "x"), (3, "long " * 30_000, "l"), (None, None, "n"), (None, None, "m")]
    df = spark.createDataFrame(rows, "doc_id long, text string, row string").selectExpr("*", "1 as th", "2 as cid", "map('a', 1) as m")
    kept = ngram_join.keep_one(df)
    assert kept.columns == df.columns
    got = sorted(map(repr, kept.collect()))
    assert len(got) == 3 and got == sorted(map(repr, ngram_join.keep_one(df.repartition(5)).collect()))


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.join(df).count() == 0 and ngram_join.keep_one(df).count() == 0
