import json

from pyspark.sql import functions as F

from episodica.operators import fit
from episodica.sources import datasets as D
from episodica.sources import state


def test_state_is_replaced_whole(spark, tmp_path):
    root = f"{tmp_path}/state"
    assert state.load_state(spark, root) is None
    a = spark.createDataFrame([(1, 2.0)], "episode int, duration_s double")
    profile = fit.Profile(threshold=0.7)
    state.save_state(a, root, {"profile": profile.to_json(), "calibration": None})
    rows, documents = state.load_state(spark, root)
    assert rows.collect() == a.collect() and fit.Profile.from_json(documents["profile"]) == profile and documents["calibration"] is None
    state.save_state(rows.withColumn("duration_s", F.lit(3.0)), root, {})
    rows, documents = state.load_state(spark, root)
    assert rows.first().duration_s == 3.0 and documents == {}
    assert len([p for p in (tmp_path / "state").iterdir() if not p.name.startswith(".")]) == 2
    manifest = tmp_path / "state" / "manifest.json"
    for text in ("{ not json", json.dumps({"version": state.VERSION + 1, "measures": "x"}), "[]"):
        for p in (manifest, manifest.with_name(".manifest.json.crc")):
            p.unlink(missing_ok=True)
        manifest.write_text(text)
        assert state.load_state(spark, root) is None


def test_scores_file(spark, tmp_path):
    rows = spark.createDataFrame([(2, "top", 0.5, {"smoothness": 0.1}), (1, "top", None, {"smoothness": 0.2}), (1, "left", 1.0, {"smoothness": None})], "episode_id int, camera_type string, aggregate_score double, per_attribute_scores struct<smoothness:double>")
    state.write_scores(rows, str(tmp_path), "scores.json")
    got = json.loads((tmp_path / "scores.json").read_text())
    assert [(r["episode_id"], r["camera_type"], r["aggregate_score"], r["per_attribute_scores"]["smoothness"]) for r in got] == [(1, "left", 1.0, None), (1, "top", None, 0.2), (2, "top", 0.5, 0.1)]
    back = D.read_scores(spark, f"{tmp_path}/scores.json")
    assert set(back.columns) == {"episode_id", "camera_type", "aggregate_score", "smoothness"} and back.count() == 3
    state.write_scores(rows.limit(0), str(tmp_path), "none.json")
    assert json.loads((tmp_path / "none.json").read_text()) == []


def test_folder_rules(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    for chunk, value in ((0, 1.0), (1, 2.0)):
        at = tmp_path / "data" / f"chunk-{chunk:03d}"
        at.mkdir(parents=True)
        pq.write_table(pa.table({"timestamp": [0.0], "observation.state": [[value]]}), at / "episode_000000.parquet")
    pq.write_table(pa.table({"timestamp": [0.0], "observation.state": [[5.0]]}), tmp_path / "data" / "chunk-000" / "episode_000005.parquet")
    assert sorted((r.episode, r.state[0]) for r in D.read_episodes(spark, str(tmp_path)).collect()) == [(0, 2.0), (5, 5.0)]
    (tmp_path / "meta").mkdir()
    (tmp_path / "meta" / "tasks.jsonl").write_text('\n  \n{"task_index": 0, "task": "fold"}\n{"task_index": 1, "task": "no"}')
    assert D.default_task(spark, str(tmp_path)) == "fold"
    (tmp_path / "meta" / "tasks.jsonl").write_text("")
    assert D.default_task(spark, str(tmp_path)) == ""
    at = tmp_path / "meta" / "episodes" / "chunk-000"
    at.mkdir(parents=True)
    for k in (0, 1):
        pq.write_table(pa.table({"episode_index": [k], "length": [3]}), at / f"file-{k:03d}.parquet")
    assert D.read_meta_v30(spark, str(tmp_path)).count() == 2
    clips = spark.createDataFrame([(1, "wrist"), (1, "base")], "episode int, camera string")
    assert D.default_camera({"features": {"observation.images.top": {}}}, clips) == "top" and D.default_camera({}, clips) == "base" and D.default_camera({}) is None
    assert D.rename_channels({"features": {"a": {"names": ["height", "rgb"]}, "b": {"names": None}}}) == {"features": {"a": {"names": ["height", "channels"]}, "b": {"names": None}}}
