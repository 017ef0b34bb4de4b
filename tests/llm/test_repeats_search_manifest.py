"""Operators 11 to 13 against plain loops, on awkward rows and small partitions."""

import hashlib
import math
import random
import re
from collections import Counter

import pytest

from episodica.llm import lexical, manifest, repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
key = lambda x: (x is not None, x or 0)


def plain_strip(docs):
    """docs in order -> (n_words, n_removed, kept) of each."""
    seen, out = set(), []
    for text in docs:
        words = WORD.findall(text or "")
        gone = set()
        for i in range(len(words) - 19):
            run = tuple(words[i : i + 20])
            if run in seen:
                gone.update(range(i, i + 20))
            seen.add(run)
        out.append((len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return out


def some_texts(n, seed=5):
    rng = random.Random(seed)
    names = ["w%d" % i for i in range(60)]
    passages = [" ".join(rng.choices(names, k=rng.randint(18, 70))) for _ in range(12)]
    made = []
    for _ in range(n):
        parts = [" ".join(rng.choices(names, k=rng.randint(0, 40)))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages).split()
            cut = rng.randint(0, max(0, len(p) - 19))
            parts += [" ".join(p[cut:]), " ".join(rng.choices(names, k=rng.randint(0, 9)))]
        made.append("\n".join(parts))
    made += made[:10] + ["la " * 50, "la " * 21, "do re " * 30]
    return made


@pytest.mark.parametrize("broadcast", [32 << 20, 0])
def test_strip(spark, monkeypatch, broadcast):
    monkeypatch.setattr(repeats, "BROADCAST_BYTES", broadcast)
    monkeypatch.setattr(repeats, "ROWS", 40)
    texts = some_texts(150)
    rows = [(i * 3 - 50, t, i) for i, t in enumerate(texts)]
    shuffled = rows[:]
    random.Random(1).shuffle(shuffled)
    df = spark.createDataFrame(shuffled, "doc_id long, text string, n_words int").repartition(7)
    got = repeats.strip(df)
    assert got.columns == ["doc_id", "text", "n_words", "n_words_", "n_removed", "kept"]
    have = {r.doc_id: (r.n_words_, r.n_removed, r.kept) for r in got.collect()}
    want = dict(zip((r[0] for r in rows), plain_strip(texts), strict=True))
    assert have == want and any(w[1] for w in want.values())


def test_strip_awkward(spark, rows, none):
    got = repeats.strip(rows).collect()
    assert len(got) == rows.count() and repeats.strip(none).count() == 0
    for r in got:
        words = WORD.findall(r.text or "")
        assert r.n_words == len(words)
        # only the long text repeats itself; everything else is shorter than a window or stands once
        if r.doc_id == 4:
            assert (r.n_removed, r.kept) == (29_999, "word")
        else:
            assert (r.n_removed, r.kept) == (0, " ".join(words))


def test_strip_equal_rows(spark):
    text = " ".join(f"x{i}" for i in range(25))
    df = spark.createDataFrame([(7, text)] * 5 + [(None, text + " tail"), (9, "short one")] * 2, "doc_id long, text string")
    got = Counter((r.doc_id, r.n_removed, r.kept) for r in repeats.strip(df).collect())
    assert got == {(None, 0, text + " tail"): 1, (None, 26, ""): 1, (7, 25, ""): 5, (9, 0, "short one"): 2}


def test_paths(spark):
    """A passage held by several sources is one path with its own words, whichever source each part came from."""
    w = [f"p{i}" for i in range(90)]
    docs = [" ".join(w[:45]), "a " + " ".join(w[20:]), "b " + " ".join(w)]
    got = repeats.paths(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")).collect()
    seen = Counter(tuple(d.split()[i : i + 20]) for d in docs for i in range(len(d.split()) - 19))
    edges = Counter(tuple(r.words[i : i + 20]) for r in got for i in range(len(r.words) - 19))
    assert edges == Counter({k: 1 for k, n in seen.items() if n > 1})
    assert sorted(len(r.words) for r in got) == [90]


def plain_search(docs, items, k):
    terms = lambda t: TERM.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))
    counted = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    n_docs, length = sum(n > 0 for *_, n in counted), sum(n for *_, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for q, text in items:
        found = []
        for i, c, n in counted:
            m = 10 + (90 * n * n_docs) // length
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if c[t])
            if s > 0:
                found.append((-s, (i is None, i or 0), i))
        out += [(q, rank, i, -s) for rank, (s, _, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize(("broadcast", "limit"), [(32 << 20, 200_000), (200, 20)])
def test_search(spark, monkeypatch, broadcast, limit):
    monkeypatch.setattr(lexical, "BROADCAST_BYTES", broadcast)
    monkeypatch.setattr(lexical, "LIST", limit)
    monkeypatch.setattr(lexical, "CHUNK", 2_000)
    monkeypatch.setattr(lexical, "HEAD", 5)
    monkeypatch.setattr(lexical, "PROBES", 6)
    rng = random.Random(3)
    names = [f"T{i}" for i in range(40)]
    docs = [(i, " ".join(rng.choices(names, weights=range(40, 0, -1), k=rng.randint(0, 60)))) for i in range(200)]
    docs += [(None, docs[3][1]), (500, docs[3][1]), (500, docs[3][1]), (501, None), (502, "")]
    items = [("a", "T1 t2 T39, T38"), ("b", " ".join(names)), ("c", "nothing here"), ("d", None), ("e", "T39"), ("f", docs[3][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = lexical.search(df, spark.createDataFrame(items, "item_id string, text string"), k=4)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_search(docs, items, 4)


def test_search_awkward(spark, rows, none):
    items = spark.createDataFrame([(1, "another text"), (1, "another text"), (2, None)], "item_id int, text string")
    got = lexical.search(rows, items).collect()
    assert [r.doc_id for r in got][:1] == [1] and len({(r.item_id, r.rank) for r in got}) == len(got)
    assert lexical.search(none, items).count() == 0 and lexical.search(rows, items.where("false")).count() == 0


def runs_up(nodes):
    while len(nodes) > 1:
        yield nodes
        nodes = [sha("".join(nodes[i : i + 8])) for i in range(0, len(nodes), 8)]
    yield nodes


def plain_manifest(rows):
    """(doc_id, group, leaf, lefts, rights, subroot, root) of each row, as a bag."""
    field = lambda x: "-" if x is None else f"{len(str(x).encode())}:{x}"
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((key(r[0]), sha("".join(map(field, r))), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: list(runs_up([leaf for _, leaf, _ in sorted(groups[g], key=lambda x: x[:2])])) for g in names}
    top = list(runs_up([trees[g][-1][0] for g in names]))

    def proof(levels, i):
        sides = []
        for nodes in levels[:-1]:
            begin = i - i % 8
            sides.append(("".join(nodes[begin:i]), "".join(nodes[i + 1 : begin + 8])))
            i //= 8
        return sides

    out = []
    for place, g in enumerate(names):
        for i, (_, leaf, r) in enumerate(sorted(groups[g], key=lambda x: x[:2])):
            sides = proof(trees[g], i) + proof(top, place)
            out.append((r[0], g, leaf, [s[0] for s in sides], [s[1] for s in sides], trees[g][-1][0], top[-1][0]))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("n", "part"), [(1, 100), (8, 3), (65, 7), (700, 37), (700, 10_000)])
def test_prove(spark, monkeypatch, n, part):
    monkeypatch.setattr(manifest, "ROWS", part)
    rng = random.Random(n)
    langs = [None, "en", "en", "en", "de", "é", "z", "-"]
    rows = [(rng.choice([None, i, i % 50]), "s", rng.choice(langs), i % 3, f"text {i % 40} é") for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    got = manifest.prove(df)
    assert got.columns == ["lang", "doc_id", "leaf", "subroot", "root", "lefts", "rights"]
    have = sorted(((r.doc_id, r.lang, r.leaf, r.lefts, r.rights, r.subroot, r.root) for r in got.collect()), key=repr)
    assert have == plain_manifest(rows)


def test_prove_fold(spark, rows, none):
    from pyspark.sql import functions as F

    got = manifest.prove(rows, carry={"leaf": F.upper("text")})
    assert got.columns == ["lang", "doc_id", "leaf", "leaf_", "subroot", "root", "lefts", "rights"]
    folded = got.withColumn("folded", manifest.fold(F.col("leaf_"), F.col("lefts"), F.col("rights"))).collect()
    assert len(folded) == rows.count() and all(r.folded == r.root for r in folded) and len({r.root for r in folded}) == 1
    changed = got.withColumn("folded", manifest.fold(F.sha2("leaf_", 256), F.col("lefts"), F.col("rights")))
    assert changed.where("folded = root").count() == 0 and manifest.prove(none).count() == 0
