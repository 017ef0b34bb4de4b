import random
import re
from collections import Counter

from episodica.llm import quality, urlfilter


def rule_of(url):
    m = re.search("://", url or "")
    rest = url[m.end() :] if m else ""
    host = re.sub("[A-Z]", lambda x: x[0].lower(), re.match("[^/?#]*", rest)[0])
    path = re.match("[^?#]*", rest[len(host) :])[0]
    fit = [r for r in urlfilter.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fit, key=lambda r: len(r.key), default=None)
    return host, path, best and best.key, best.verdict if best else "allow"


def test_urls(spark):
    r = random.Random(4)
    urls = [None, "", "no scheme", "http://", "http://net", "http://net/", "http://NET/x?y", "x://a.b.example.net/en/1#z", "http://example.com/de", "http://example.com/de/?a", "http://notnet/en/", "http://org/fr/", "http://a.org?x=/fr/"]
    urls += [f"http{r.choice(['', 's'])}://{r.choice(['', 'www.', 'M.'])}{r.choice(['example', 'other'])}.{r.choice(['net', 'com', 'org'])}{r.choice(['', '/', '/en/', '/de/', '/fr/', '/en'])}{r.choice(['', 'p', '?q', '#f'])}{i}" for i in range(300)]
    urls += ["http://" + "a." * 300 + "net/" + "p" * 5000, "http://x.org/fr/"]
    df = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, rule string, keys string")
    want = [rule_of(u) for u in urls]
    for rate in (None, 0.9):
        out = urlfilter.judge(df, first_rate=rate).orderBy("page_id")
        assert out.columns == [*df.columns, "host", "path", "rule_", "verdict"]
        assert [(g.host, g.path, g.rule_, g.verdict, g.rule, g["keys"]) for g in out.collect()] == [(*w, "x", "y") for w in want]
    assert urlfilter.judge(df.where("false")).count() == 0
    assert {r.verdict for r in urlfilter.judge(df, ()).collect()} == {"allow"}


def test_lists_beyond_one_broadcast(spark, monkeypatch):
    """Levels that don't fit are dealt over shards; results stay exact."""
    hosts = [f"h{i}.example" for i in range(3000)]
    rules = spark.createDataFrame([(h, "/a/" if i % 3 else "/", "block" if i % 2 else "allow") for i, h in enumerate(hosts) if i % 5 == 0], "host string, path string, verdict string")
    df = spark.createDataFrame([(i, f"http://www.{h}/{'a' if i % 4 else 'b'}/c") for i, h in enumerate(hosts)], "page_id long, url string")
    plain = {(r.host, r.path): r.verdict for r in rules.collect()}

    def want(i, h):
        path = f"/{'a' if i % 4 else 'b'}/c"
        fit = [(len(p), h + p, v) for p in ("/", "/a/") if path.startswith(p) and (v := plain.get((h, p)))]
        return max(fit)[1:] if fit else (None, "allow")

    monkeypatch.setattr(urlfilter, "MAX_BITS", 2048)
    got = {r.page_id: (r.rule, r.verdict) for r in urlfilter.judge(df, rules).collect()}
    assert got == {i: want(i, h) for i, h in enumerate(hosts)}


def repeats(w):
    c = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    return len({k for i in range(len(w) - 2) if c[tuple(w[i : i + 3])] > 1 for k in (i, i + 1, i + 2)})


def brute(text, boiler):
    """n_words and so on to kept, by plain loops."""
    word, text = r"[^\x20\x09-\x0D]+", text or ""
    w = re.findall(word, text)
    lines = [x for x in text.split("\n") if re.search(word, x)]
    lost = 0
    for i, x in enumerate(lines):
        own = re.findall(word, x)
        n = sum(map(len, own))
        bars = len(re.findall(r"\s[|»›→•·]\s", x)) >= 3
        shout = len(own) >= 5 and x.upper() == x and x.lower() != x and x.isupper()
        if x in lines[:i] or 10 * len(re.findall(r"[#*$%&|<>]", x)) > n or not re.search("[.!?…。！？।؟]", x) or bars or shout or (len(x) <= 200 and x in boiler):
            lost += n
    failed = len(w) < 50 or 100 * repeats(w) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), repeats(w), failed, not failed and 2 * lost <= sum(map(len, w))


def test_quality_against_plain_loops(spark):
    r = random.Random(6)
    say = lambda n: " ".join("".join(r.choice("abcdefghij") for _ in range(r.randrange(1, 8))) for _ in range(n))
    notice = ["Read our terms of use first.", "Home | News | Sport | More.", "We use cookies here."]
    texts = []
    for _ in range(120):
        lines = [r.choice([say(12) + ".", say(9) + ".", say(8), (say(6) + "!").upper(), say(3) + " ### $$$.", *notice, "", " "]) for _ in range(r.randrange(1, 14))]
        texts.append("\n".join(lines + r.choice([[], lines[:2]])))
    texts += ["".join(r.choice(["ab ", "c\t", "d\n", "#", "é ", "e|f ", "\x0b", "\r\n", "ab c d\n"]) for _ in range(r.randrange(200))) for _ in range(150)]
    # copies of one text don't make its lines boilerplate, nor do near copies
    same = "\n".join(say(15) + "." for _ in range(8))
    texts += [same] * 60 + [same.replace(same.split()[k], "zz", 1) for k in range(60)] + [None, "", "a.", "word. " * 20_000]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, quality string")
    around = {}
    for t in texts:
        lines = [x for x in (t or "").split("\n") if x.strip(" \t\n\v\f\r")]
        for i, x in enumerate(lines):
            around.setdefault(x, Counter())[tuple(lines[i - 1 : i] if i else [None]) + tuple(lines[i + 1 : i + 2] or [None])] += 1
    total = sum(sum(c.values()) for c in around.values())
    boiler = {x for x, c in around.items() if len(x) <= 200 and len(c) >= max(10, total * 1e-4) and 2 * len(c) >= sum(c.values())}
    assert set(notice) <= boiler and not any(x in boiler for x in same.split("\n"))
    out = quality.assess(df)
    assert out.columns == [*df.columns, "quality_"]
    for x in out.collect():
        assert tuple(x.quality_)[:7] == brute(x.text, boiler), x.text
        assert x.quality == "x"
    assert {x.quality_.kept for x in out.collect()} == {True, False}


def test_quality_rows(rows, none):
    out = quality.assess(rows)
    assert out.columns == [*rows.columns, "quality"] and out.count() == rows.count()
    assert quality.clean(none).count() == 0 and quality.assess(none).count() == 0
    good = " ".join(f"Line{i} has{i} words{i} of{i} its{i} own." for i in range(20))
    assert quality.judge(good)[6] and quality.judge(good + "\nno stop in this line\nA | b | c | d.")[7] == good


def test_long_hosts(spark):
    """A host of any number of labels is cut to those that some rule can have, in a moment."""
    import time

    hosts = ["a." * 50_000 + "example.net", "x" * 100_000 + ".org", "." * 30_000, "net", "b.example.com"]
    pages = spark.createDataFrame([(i, f"http://{h}/en/1") for i, h in enumerate(hosts)], "page_id long, url string")
    urlfilter.judge(pages.limit(1)).collect()
    began = time.time()
    got = {r.page_id: (r.host, r.rule, r.verdict) for r in urlfilter.judge(pages).collect()}
    assert time.time() - began < 60
    assert got[0] == (hosts[0], "example.net/en/", "allow") and got[3][1:] == ("net/", "block") and [got[i][1] for i in (1, 2, 4)] == [None] * 3
