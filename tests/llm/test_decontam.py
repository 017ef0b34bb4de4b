import random
import re

from episodica.llm import decontam


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(docs, items):
    windows = {}
    for i, t in items:
        w = words(t)
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add(str(i))
    out = []
    for d, t in docs:
        w, hit, ids = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if got := windows.get(tuple(w[k : k + n])):
                    hit |= set(range(k, k + n))
                    ids |= got
        out.append((d, len(w), len(hit), sorted(ids), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def test_against_brute_force(spark):
    r = random.Random(1)
    word = lambda: r.choice("ab cd ef gh é1 J".split()) + str(r.randrange(4))
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([1, 3, 5, 12, 13, 14, 20, 40, 40])] + [(20, None), (21, "..."), (None, "zz yy xx ww"), (7, "a second text of item seven with more than thirteen words in it to be sure")]
    items.append(items[6])
    docs = []
    for d in range(60):
        parts = [" ".join(word() for _ in range(r.randrange(30)))]
        i = r.choice(items)[1] or ""
        w = i.split()
        cut = r.randrange(len(w) + 1)
        parts.append(", ".join(w[cut : cut + r.choice([12, 13, 14, 40])]).upper())
        parts.append(" ".join(word() for _ in range(r.randrange(200))))
        docs.append((d % 50, " ".join(parts)))
    docs += [(100, None), (None, ""), (None, items[7][1]), docs[0], (101, " ".join(word() for _ in range(6000)) + " " + items[8][1] + " " + " ".join(items[7][1] for _ in range(60)))]
    df = spark.createDataFrame([(*x, "q", 1, 2) for x in docs], "doc_id long, text string, items string, th int, fp int")
    it = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, [(("" if i is None else i), t) for i, t in items])
    for limit in (1 << 25, 0):
        got = sorted(((x.doc_id, x.n_words, x.n_hit, list(x["items"]), x.contaminated) for x in decontam.decontaminate(df, it, limit).collect()), key=repr)
        known = [(a, b, c, [i for i in ids if i], f) for a, b, c, ids, f in want]
        assert got == known
    kept = decontam.clean(df, it)
    assert kept.columns == df.columns and kept.count() == sum(not x[4] for x in want)


def test_empty(spark):
    docs, items = spark.createDataFrame([(1, "a b c")], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert [x.contaminated for x in decontam.decontaminate(docs, items).collect()] == [False]
    assert decontam.decontaminate(docs.where("false"), items).count() == 0
