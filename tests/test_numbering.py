"""Places and running sums by ranges against a plain loop."""

import random

from pyspark.sql import functions as F

from episodica.operators import detail, report
from episodica.operators.numbering import before
from episodica.sources import rewrite


def test_before(spark):
    draw = random.Random(5)
    keys = {draw.randrange(1 << 40) for _ in range(200)} | set(range(4000, 4300)) | {-1, -5000, 0, 4095, 4096, (1 << 28) - 1, 1 << 28, (1 << 62), -(1 << 62), None}
    rows = [(k, draw.choice((None, 0, 3, 1 << 33))) for k in keys]
    draw.shuffle(rows)
    d = before(spark.createDataFrame(rows, "k long, n long"), "k", place=1, total=F.col("n"))
    assert d.columns == ["k", "n", "place", "total"]
    total, want = 0, []
    for place, (k, n) in enumerate(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))):
        want.append((k, n, place, total))
        total += n or 0
    assert {tuple(r) for r in d.collect()} == set(want)
    again = before(spark.createDataFrame([(7, 2), (3, 1)], "k int, place int"), "k", place=F.col("place"))
    assert sorted(map(tuple, again.collect())) == [(3, 0), (7, 1)]
    assert before(d.limit(0), "k", place=1).collect() == []


def test_windows_stay_inside_ranges(spark):
    frames = spark.range(50).select((F.col("id") % 5).alias("episode"), F.col("id").cast("int").alias("frame_index"), F.col("id").cast("double").alias("t"), F.array("id").alias("state"), F.array("id").alias("action"))
    good = frames.select("episode")
    splits = spark.createDataFrame([("train", 0, 3), ("none", 9, 12)], "name string, start long, stop long")
    meta = frames.groupBy("episode").agg(F.count("*").alias("length"))
    plans = [report.reindex(frames, good), report.reindex_meta(meta, good), report.rebuild_splits(splits, good), rewrite.numbered(good), detail.by_episode(frames), detail.eval_split(good, 0.5)]
    for d in plans:
        text = d._jdf.queryExecution().optimizedPlan().toString()
        # a window is within an episode, within a range, or over ranges of 2^28 keys
        for x in text.splitlines():
            if "Window [" in x and "], [__range" not in x and "], [episode" not in x:
                assert "[__key" in x, x
    assert {tuple(r) for r in report.rebuild_splits(splits, good).collect()} == {("train", "0:3"), ("none", "12:9")}
    assert [r.start for r in detail.by_episode(frames).orderBy("episode").collect()] == [0, 10, 20, 30, 40]
