from collections import Counter

import pytest

from episodica.llm import mixing


def edf(weights, slots):
    """Plain earliest deadline first: the source of each slot."""
    v, done, out = sum(weights.values()), Counter(), []
    for t in range(slots):
        ready = [(-(-(done[k] + 1) * v // w), k) for k, w in sorted(weights.items()) if done[k] * v // w <= t]
        k = min(ready)[1]
        done[k] += 1
        out.append(k)
    return out


@pytest.mark.parametrize("chunk,step", [(65_536, 512), (700, 64)])
def test_less_than_one_block_off_the_asked_weights(spark, chunk, step, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK", chunk)
    monkeypatch.setattr(mixing, "STEP", step)
    weights = {"=a": 3337, "=b": 3338, "=c": 3325} if chunk > 1000 else {"=a": 337, "=b": 338, "=c": 331, "=d": 7}
    v = sum(weights.values())
    plan = mixing.timetable(spark.createDataFrame(list(weights.items()), "key string, weight long")).collect()
    assert {r.period for r in plan} == {v} and sorted(r.slot for r in plan) == list(range(v))
    by_slot = {r.slot: r.key for r in plan}
    assert [by_slot[t] for t in range(v)] == edf(weights, v)
    seen = Counter()
    for t in range(15 * v if chunk > 1000 else 3 * v):
        seen[by_slot[t % v]] += 1
        assert all(abs(seen[k] * v - w * (t + 1)) < v for k, w in weights.items())


def test_rows_follow_the_timetable(spark):
    n = {"a": 3000, "b": 1000, "c": 200, "d": 40}
    df = spark.createDataFrame([(i * 10 + k, s) for k, (s, m) in enumerate(n.items()) for i in range(m)], "doc_id long, source string")
    weights = {"=a": 50, "=b": 30, "=c": 15, "=d": 5}
    out = mixing.interleave(df, spark.createDataFrame(list(weights.items()), "key string, weight long"), block_rows=8).collect()
    assert len(out) == sum(n.values()) == len({r.doc_id for r in out})
    blocks = {r.slot: "=" + r.source for r in out}
    assert len({(r.source, r.block) for r in out}) == len(blocks)
    want = edf(weights, max(blocks) + 1)
    assert all(want[t] == k for t, k in blocks.items())
    assert max(Counter((r.slot, r.place) for r in out).values()) == 1 and max(r.place for r in out) == 7


def test_weights_with_a_long_period(spark):
    weights = {"=a": 1_000_003, "=b": 999_983}
    df = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(300)], "doc_id long, source string")
    out = mixing.interleave(df, spark.createDataFrame(list(weights.items()), "key string, weight long"), block_rows=4).collect()
    want = edf(weights, 80)
    assert len(out) == 300 and all(want[r.slot] == "=" + r.source for r in out)


def test_hot_ids_and_equal_rows(spark, monkeypatch):
    data = [(None, "a", f"t{i}") for i in range(500)] + [(7, "a", "same")] * 300 + [(i, "b", "x") for i in range(100)] + [(None, None, None)] * 50
    df = spark.createDataFrame(data, "doc_id long, source string, text string")
    plain = mixing.interleave(df, block_rows=8)
    monkeypatch.setattr(mixing, "HOT", 20)
    monkeypatch.setattr(mixing, "PIECE", 16)
    hot = mixing.interleave(df, block_rows=8)
    assert hot.columns == plain.columns
    key = lambda r: tuple(map(repr, r))
    assert sorted(hot.collect(), key=key) == sorted(plain.collect(), key=key)
    assert len({(r.slot, r.place) for r in plain.collect()}) == len(data)


def test_awkward_rows(rows, none):
    out = mixing.interleave(rows)
    assert out.columns == [*rows.columns, "block", "slot", "place"] and out.count() == rows.count()
    assert mixing.interleave(none).count() == 0
    clash = rows.selectExpr("*", "7 as q", "'mine' as block", "8 as row", "9 as key", "10 as `at`", "map('a', 1) as m")
    out = mixing.interleave(clash)
    assert out.columns == [*clash.columns, "block_", "slot", "place"]
    assert {(r.q, r.block, r.row, r.key, r["at"]) for r in out.collect()} == {(7, "mine", 8, 9, 10)} and out.count() == rows.count()
