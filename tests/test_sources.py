import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from episodica import streaming
from episodica.functions import verdicts as V
from episodica.operators import inject, legacy, report
from episodica.sources import datasets as D


def test_read_and_rewrite_a_folder(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    for ep in (0, 1, 2):
        folder = tmp_path / "data" / "chunk-000"
        folder.mkdir(parents=True, exist_ok=True)
        pq.write_table(pa.table({"timestamp": [0.0, 0.02, 0.04], "observation.state": [[0.0, float(ep)]] * 3, "frame_index": [0, 1, 2], "ignored": ["x"] * 3}), folder / f"episode_{ep:06d}.parquet")
    (tmp_path / "meta").mkdir()
    (tmp_path / "meta" / "episodes.jsonl").write_text("\n".join(json.dumps({"episode_index": e, "tasks": [f"t{e}"], "length": 3}) for e in (0, 1, 2)))
    frames = D.read_episodes(spark, str(tmp_path))
    assert frames.count() == 9 and frames.where("eef is null").count() == 9
    assert {(r.episode, r.task) for r in D.tasks(spark, str(tmp_path)).collect()} == {(0, "t0"), (1, "t1"), (2, "t2")}
    good = spark.createDataFrame([(2,), (0,), (2,)], "episode long")
    D.write_episodes(report.reindex(frames, good).select("episode_index", "frame_index", "index", "t"), f"{tmp_path}/out")
    back = spark.read.parquet(f"{tmp_path}/out").orderBy("index").collect()
    assert [(r["episode_index"], r["frame_index"], r["index"]) for r in back] == [(0, 0, 0), (0, 1, 1), (0, 2, 2), (1, 0, 3), (1, 1, 4), (1, 2, 5)]


def test_metadata_rules():
    assert D.version({}) == "v2.1" and D.version({"codebase_version": "3.0"}) == "v3.0"
    assert D.groups({"state": {"a": {"start": 0, "end": 2}, "b": {"start": 1, "end": 2, "original_key": "x"}, "c": {"start": 1}}}) == {"a": (0, 2)}
    assert D.action_column({"observation.state": {"shape": [3]}, "action.a": {"shape": [2]}, "action.b": {"shape": [3]}}) == "action.b"
    assert D.cameras({"features": {"observation.images.top": {}, "action": {}}}) == ["top"]


def test_last_object(spark):
    texts = ['pre {"a": 1} mid {"b": {"c": 2}} post', '{ open {"score": 1}', '{"a": "x"\n"b": 2,}', "no json", None, '{"a": 1} {bad}', "{" * 200 + '"a": 1}']
    got = [r.o for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(V.last_object(F.col("t")).alias("o")).collect()]
    assert got == ['{"b": {"c": 2}}', '{"score": 1}', '{"a": "x", "b": 2}', None, None, '{"a": 1}', '{"a": 1}']


def test_verdict_stream(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for k, score in enumerate((0.5, 1.0)):
        (folder / f"{k}.json").write_text(json.dumps({"video": "v", "task": "t", "score": score}))
        streaming.upsert(streaming.verdict_stream(spark, str(folder)), f"{tmp_path}/table", f"{tmp_path}/cp").awaitTermination()
    rows = streaming.current(spark, f"{tmp_path}/table").collect()
    assert [(r.video, r.score) for r in rows] == [("v", 1.0)]


def test_quantiles_are_pandas(spark):
    r = np.random.default_rng(1)
    v = np.round(r.normal(size=200), 1)
    df = spark.createDataFrame([(i, float(x)) for i, x in enumerate(v)], "episode long, v double")
    got = {x.episode: x.quantile for x in report.quantiles(df, "v").collect()}
    want = pd.qcut(v, 4, labels=False, duplicates="drop")
    assert [got[i] for i in range(200)] == want.tolist()


def arc(t, q, cutoff=10.0, pad=5):
    """One joint by numpy's transform."""
    n = int(2 ** np.ceil(np.log2(len(t) * pad)))
    freq = np.fft.fftfreq(n, np.mean(np.diff(t)))
    at = np.flatnonzero((freq >= 0) & (freq <= cutoff))
    a, f = np.abs(np.fft.rfft(np.gradient(q, t), n=n))[at], freq[at]
    a = a / a.max()
    end = np.flatnonzero(a > 0.05)[-1] + 1
    return 0.0 if f[end - 1] == 0 else -np.hypot(np.diff(f[:end]) / f[end - 1], np.diff(a[:end])).sum()


def test_sparc_is_numpy(spark):
    r, rows, want = np.random.default_rng(3), [], {}
    for e, (n, rate) in enumerate([(2, 50), (3, 10), (7, 25), (51, 50), (52, 50), (205, 15), (333, 200), (3000, 100)]):
        t = np.cumsum(r.uniform(0.8, 1.2, n)) / rate
        q = np.stack([np.sin(t * 3) + 0.01 * r.normal(size=n), r.normal(size=n).cumsum()], axis=1)
        rows += [(e, i, float(t[i]), [float(x) for x in q[i]]) for i in range(n)]
        want |= {(e, j): arc(t, q[:, j]) for j in range(2)}
    schema = "episode long, frame_index int, t double, state array<double>"
    odd = [(90, 0, 0.0, [1.0]), (91, 0, 0.0, [1.0]), (91, 1, 0.1, [None]), (91, 2, 0.2, [2.0]), (92, 0, 0.0, [1.0]), (92, 1, 0.0, [2.0]), (93, 0, 0.0, None)]
    got = {(x.episode, x.joint): (x.sparc, x.score) for x in legacy.sparc(spark.createDataFrame(rows + odd, schema).repartition(5)).collect()}
    assert got.pop((91, 0)) == (None, None) and got.pop((92, 0)) == (None, None)
    assert {k: v[0] for k, v in got.items()} == pytest.approx(want, abs=1e-9)


def test_sparc_and_noise(spark):
    t = np.arange(64) * 0.02
    frames = spark.createDataFrame([(1, i, float(x), [float(np.sin(x)), 1.0]) for i, x in enumerate(t)], "episode long, frame_index int, t double, state array<double>")
    rows = legacy.sparc(frames).orderBy("joint").collect()
    assert len(rows) == 2 and rows[0].sparc < 0 and 0 < rows[0].score <= 1 and rows[1].sparc == pytest.approx(-1)
    s = spark.range(2000).select(F.expr("id % 20").alias("episode"), (F.col("id") / 20).cast("int").alias("frame_index"), F.lit(0).alias("joint"), F.lit(0.0).alias("q"), F.lit(0.0).alias("command"))
    a = inject.motion_noise(s)
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, inject.motion_noise(s.repartition(7)).collect()), key=repr)
    hit = a.where("corrupted_state")
    n = {tuple(r)[:2]: r["count"] for r in a.groupBy("corrupted_state", "corrupted_action").count().collect()}
    assert n[True, False] > 0 and n[False, True] > 0 and n[True, True] > 0
    assert a.where("corrupted <> (corrupted_state or corrupted_action) or not corrupted_action and command <> 0 or corrupted_action and command = 0").isEmpty()
    assert 0 < hit.count() < 2000 and abs(hit.agg(F.stddev("q")).first()[0] - 0.05) < 0.01
    assert inject.log(a).first()["total_episodes"] == 20
