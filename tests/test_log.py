"""The verdict log: order of commits, large and small files, failed and repeated appends, compaction."""

import pytest

from pyspark.sql import functions as F

from episodica.functions import replies as R
from episodica.functions.verdicts import latest
from episodica.sources import datasets as D

FIELDS = "video string, task string, score double, note string"


def last(spark, path):
    return {(r.video, r.task): r.score for r in latest(D.read_verdicts(spark, path)).collect()}


def test_order_of_commits(spark, tmp_path):
    path = f"{tmp_path}/log"
    verdict = lambda score, note="": spark.createDataFrame([("a.mp4", "t", score, note)], FIELDS)
    assert R.append_verdicts(verdict(0.0), path) == 1
    assert R.append_verdicts(verdict(1.0), path) == 2
    assert last(spark, path) == {("a.mp4", "t"): 1.0}
    # a later file that is larger, then many small ones
    big = spark.range(2000).select(F.lit("a.mp4").alias("video"), F.lit("t").alias("task"), F.lit(0.5).alias("score"), F.concat(F.lit("x"), F.col("id")).alias("note"))
    assert R.append_verdicts(big.repartition(3), path) == 3
    assert last(spark, path) == {("a.mp4", "t"): 0.5}
    many = spark.createDataFrame([("a.mp4", "t", i / 8, str(i)) for i in range(9)], FIELDS).repartition(5)
    assert R.append_verdicts(many, path, order="score") == 4
    assert last(spark, path) == {("a.mp4", "t"): 1.0}


def test_failed_append(spark, tmp_path):
    path = f"{tmp_path}/log"
    good = spark.createDataFrame([("a.mp4", "t", 0.0, "")], FIELDS)
    R.append_verdicts(good, path)
    with pytest.raises(Exception, match="boom"):
        R.append_verdicts(good.withColumn("note", F.raise_error(F.lit("boom")).cast("string")), path)
    assert last(spark, path) == {("a.mp4", "t"): 0.0}
    assert R.append_verdicts(good.withColumn("score", F.lit(1.0)), path) == 2
    assert last(spark, path) == {("a.mp4", "t"): 1.0} and D.read_verdicts(spark, path).count() == 2


def test_number_taken(spark, tmp_path, monkeypatch):
    """Another writer's claim that is never followed by its commit is given up after a while."""
    path = tmp_path / "log"
    good = spark.createDataFrame([("a.mp4", "t", 0.0, "")], FIELDS)
    path.mkdir()
    (path / f"_claim-{1:019d}").touch()
    monkeypatch.setattr(D, "CLAIM_S", 0)
    assert R.append_verdicts(good, str(path)) == 1 and last(spark, str(path)) == {("a.mp4", "t"): 0.0}


def test_compaction(spark, tmp_path):
    path = f"{tmp_path}/log"
    for score in (0.0, 0.5, 1.0):
        R.append_verdicts(spark.createDataFrame([("a.mp4", "t", score, "é"), (f"{score}.mp4", "t", score, "")], FIELDS), path)
    before = last(spark, path)
    D.compact_verdicts(spark, path)
    assert last(spark, path) == before and D.read_verdicts(spark, path).count() == len(before)
    D.compact_verdicts(spark, path)
    assert R.append_verdicts(spark.createDataFrame([("a.mp4", "t", 0.25, "")], FIELDS), path) == 4
    assert last(spark, path) == before | {("a.mp4", "t"): 0.25}
    D.compact_verdicts(spark, path)
    assert last(spark, path) == before | {("a.mp4", "t"): 0.25} and len([p for p in (tmp_path / "log").iterdir() if p.name.startswith("commit=")]) == 1


def test_plain_file(spark, tmp_path):
    at = tmp_path / "log.jsonl"
    at.write_text('{"video": "a", "task": "t", "score": 0.0}\nnot json\n{"video": "a", "task": "t", "score": 1.0}\n')
    assert last(spark, str(at)) == {("a", "t"): 1.0}
