import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from episodica.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    luhn = lambda d: sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0
    return {
        "email": [m.span() for m in EMAIL.finditer(text)],
        "ip": [m.span() for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))],
        "card": [m.span() for m in CARD.finditer(text) if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))],
        "phone": [m.span() for m in PHONE.finditer(text) if 8 <= len(digits(m[0])) <= 15],
    }


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet="a1.@+-() 4_%é", max_size=40))
def test_base_spans_are_the_plain_patterns(text):
    assert pii.base_spans(text) == plain(text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["4041894974608795", "4041-8949-7460-8795", " ", "+1 (565) 555-5579", "1.2.3.4", "300.1.1.1", "x@y.z", "@", "."]), max_size=12))
def test_base_spans_on_pieces(parts):
    assert pii.base_spans("".join(parts)) == plain("".join(parts))


def test_long_runs_end():
    assert pii.base_spans("a" * 300_000)["email"] == []
    assert pii.base_spans("9" * 300_000)["ip"] == []


def brute(text, trees, bars):
    """All spans of one text by plain loops: each proposal scored alone, each overlap looked for."""
    base = pii.base_spans(text)
    strict = [x for v in base.values() for x in v]
    loose = [(float(trees.score(np.array([pii.features(text, *c)], float))[0]), c) for c in pii.proposals(text) if not any(c[1] < e and s < c[2] for s, e in strict)]
    added = []
    for p, (kind, s, e, _) in sorted(loose, key=lambda x: (-x[0], x[1][1], -x[1][2])):
        if p >= bars[kind] and not any(s < y and x < e for _, x, y in added):
            added.append((kind, s, e))
    return sorted([(k, *x) for k in base for x in base[k]] + added, key=lambda x: (pii.ALL_KINDS.index(x[0]), *x[1:]))


def test_all_spans_are_those_of_plain_loops(spark):
    trees, bars = pii.model()
    writer = pii.Writer(7)
    texts = [writer.text()[0] for _ in range(200)] + ["".join(writer.text()[0] for _ in range(60)), "a at b dot c " * 3000, "1" * 5000, "", None]
    assert [s for _, s in pii.find_all(texts, trees, bars)] == [brute(t, trees, bars) if t else [] for t in texts]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id int, text string, pii string")
    out = pii.detect(df)
    assert out.columns == [*df.columns, "pii_"]
    for r in out.collect():
        assert r.pii == "x" and r.pii_.spans == ",".join(f"{k}:{s}:{e}" for k, s, e in (brute(r.text, trees, bars) if r.text else []))


def test_planted_spans_are_found_precisely():
    trees, bars = pii.model()
    writer, right, found, planted = pii.Writer(1234), 0, 0, 0
    for _ in range(600):
        text, spans = writer.text()
        base, got = pii.find(text, trees, bars)
        strict = {x for v in base.values() for x in v}
        added = [(s, e) for _, s, e in got if (s, e) not in strict]
        fits = lambda a, b: 5 * (min(a[1], b[1]) - max(a[0], b[0])) >= 4 * (max(a[1], b[1]) - min(a[0], b[0]))
        planted += len(spans)
        found += sum(any(fits(a, x) for a in [*added, *strict]) for x in spans)
        right += len(added) - sum(any(fits(a, x) for x in spans) for a in added)
    assert found / planted > 0.97 and right < 0.03 * planted


def test_threshold_counts_whole_runs_of_equal_scores():
    scores, truth = np.array([0.9, 0.8, 0.8, 0.8, 0.7]), np.array([1.0, 1.0, 1.0, 0.0, 0.0])
    assert pii.threshold(scores, truth, 1.0) == 0.9
    assert pii.threshold(scores, truth, 0.75) == 0.8
    assert pii.threshold(scores, 1 - truth, 0.99) == pii.threshold(np.zeros(0), np.zeros(0)) == 2.0


def test_model_adds_loose_spans_and_leaves_prose():
    trees, bars = pii.model()
    base, spans = pii.find("mail joe (at) foo (dot) com or call (555) 123-4567, card 7536784127813050 4845168114407329", trees, bars)
    assert not any(base.values()) and [s[0] for s in spans] == ["email", "card", "card", "phone"]
    assert pii.find("We stay at home. Order 555 123 4567 of 12 items, version 1.2.3 at 3. It is 12:30:45 there", trees, bars)[1] == []


def test_scrub(rows, none):
    out = pii.scrub(rows)
    assert out.columns == rows.columns and out.count() == rows.count()
    got = [r for r in out.collect() if r.doc_id == 1 and r.source]
    assert len(got) == 2 and got[0].text == "Call me at [EMAIL] or [PHONE]." and got[0].n_chars == len(got[0].text)
    assert pii.scrub(none).count() == 0
    assert {r.text for r in out.where("doc_id = 2").collect()} == {None}
