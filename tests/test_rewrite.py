"""A folder of kept episodes against the rules, file by file."""

import json

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from episodica.sources import rewrite


def make(root, episodes=(0, 1, 2, 3), size=2):
    (root / "meta").mkdir(parents=True)
    for e in episodes:
        data = root / "data" / f"chunk-{e // size:03d}"
        data.mkdir(parents=True, exist_ok=True)
        n = e + 1
        rows = {"timestamp": [0.02 * k for k in range(n)], "frame_index": list(range(n)), "episode_index": [e] * n, "index": list(range(100, 100 + n)), "task_index": [e % 2] * n, "observation.state": [[float(e), 1.0]] * n}
        pq.write_table(pa.table(rows), data / f"episode_{e:06d}.parquet")
        clip = root / "videos" / f"chunk-{e // size:03d}" / "observation.images.top"
        clip.mkdir(parents=True, exist_ok=True)
        (clip / f"episode_{e:06d}.mp4").write_bytes(b"clip %d" % e)
    lines = lambda rows: "\n".join(json.dumps(r) for r in rows)
    (root / "meta" / "episodes.jsonl").write_text(lines({"episode_index": e, "tasks": [f"t{e}"], "length": e + 1} for e in episodes))
    (root / "meta" / "episodes_stats.jsonl").write_text(lines({"episode_index": e, "stats": {"episode_index": {"min": [e], "mean": [e + 0.5]}}} for e in episodes))
    (root / "meta" / "tasks.jsonl").write_text(lines([{"task_index": 0, "task": "a"}, {"task_index": 1, "task": "b"}]))
    info = {"codebase_version": "v2.1", "chunks_size": size, "features": {"observation.images.top": {}, "observation.state": {}}, "splits": {"train": "0:4"}, "total_episodes": len(episodes), "fps": 50}
    (root / "meta" / "info.json").write_text(json.dumps(info))


def test_save_filtered(spark, tmp_path):
    root, out = tmp_path / "in", tmp_path / "out"
    make(root)
    good = spark.createDataFrame([(3,), (1,), (2,), (3,)], "episode long")
    info = rewrite.save_filtered(spark, str(root), str(out), good)
    assert info["total_episodes"] == 3 and info["total_frames"] == 9 and info["total_videos"] == 3 and info["splits"] == {"train": "0:2"} and info["fps"] == 50
    assert json.loads((out / "meta" / "info.json").read_text()) == info
    files = sorted(p.relative_to(out).as_posix() for p in out.rglob("*") if p.is_file() and not p.name.startswith("."))
    data = ["data/chunk-000/episode_000000.parquet", "data/chunk-000/episode_000001.parquet", "data/chunk-001/episode_000002.parquet"]
    meta = ["meta/episodes.jsonl", "meta/episodes_stats.jsonl", "meta/info.json", "meta/tasks.jsonl"]
    video = [f"videos/chunk-{n // 2:03d}/observation.images.top/episode_{n:06d}.mp4" for n in range(3)]
    assert files == data + meta + video
    at = 0
    for new, old in enumerate((1, 2, 3)):
        t = pq.ParquetFile(out / data[new]).read()
        assert t.column_names == ["timestamp", "frame_index", "episode_index", "index", "task_index", "observation.state"]
        n = old + 1
        assert t["frame_index"].to_pylist() == list(range(n)) and t["episode_index"].to_pylist() == [new] * n and t["index"].to_pylist() == list(range(at, at + n))
        assert t["observation.state"].to_pylist() == [[float(old), 1.0]] * n
        at += n
        assert (out / video[new]).read_bytes() == b"clip %d" % old
    read = lambda name: [json.loads(x) for x in (out / "meta" / name).read_text().splitlines()]
    assert read("episodes.jsonl") == [{"episode_index": n, "tasks": [f"t{o}"], "length": o + 1} for n, o in enumerate((1, 2, 3))]
    assert read("episodes_stats.jsonl") == [{"episode_index": n, "stats": {"episode_index": {"min": [o], "mean": [o + 0.5]}}} for n, o in enumerate((1, 2, 3))]
    assert read("tasks.jsonl") == [{"task_index": 0, "task": "a"}, {"task_index": 1, "task": "b"}]
    with pytest.raises(FileExistsError):
        rewrite.save_filtered(spark, str(root), str(out), good, overwrite=False)
    with pytest.raises(ValueError):
        rewrite.save_filtered(spark, str(root), f"{root}/", good)
    with pytest.raises(ValueError):
        rewrite.save_filtered(spark, str(root), f"{tmp_path}/none", good.limit(0))


def test_save_filtered_combined_files(spark, tmp_path):
    root, out = tmp_path / "in", tmp_path / "out"
    lengths, at, rows = [2, 3, 1, 4, 2], 0, []
    for e, n in enumerate(lengths):
        f = e // 2
        rows.append({"episode_index": e, "length": n, "dataset_from_index": at, "dataset_to_index": at + n, "data/chunk_index": 0, "data/file_index": f, "videos/observation.images.top/chunk_index": 0, "videos/observation.images.top/file_index": f, "videos/observation.images.top/from_timestamp": float(at), "videos/observation.images.top/to_timestamp": float(at + n), "tasks": [f"t{e}"]})
        at += n
    (root / "meta" / "episodes" / "chunk-000").mkdir(parents=True)
    pq.write_table(pa.Table.from_pylist(rows), root / "meta" / "episodes" / "chunk-000" / "file-000.parquet")
    (root / "data" / "chunk-000").mkdir(parents=True)
    (root / "videos" / "observation.images.top" / "chunk-000").mkdir(parents=True)
    for f in range(3):
        frames = [{"episode_index": r["episode_index"], "frame_index": i, "index": r["dataset_from_index"] + i, "observation.state": [float(r["episode_index"])]} for r in rows if r["data/file_index"] == f for i in range(r["length"])]
        pq.write_table(pa.Table.from_pylist(frames), root / "data" / "chunk-000" / f"file-{f:03d}.parquet")
        (root / "videos" / "observation.images.top" / "chunk-000" / f"file-{f:03d}.mp4").write_bytes(b"clip %d" % f)
    info = {"codebase_version": "v3.0", "chunks_size": 1000, "features": {"observation.images.top": {}}, "splits": {"train": "0:5"}}
    (root / "meta" / "info.json").write_text(json.dumps(info))
    (root / "meta" / "stats.json").write_text("{}")

    got = rewrite.save_filtered(spark, str(root), str(out), spark.createDataFrame([(3,), (1,), (4,)], "episode long"))
    assert (got["total_episodes"], got["total_frames"], got["total_videos"], got["splits"]) == (3, 9, 3, {"train": "0:2"})
    files = sorted(p.relative_to(out).as_posix() for p in out.rglob("*") if p.is_file() and not p.name.startswith("."))
    assert files == [f"data/chunk-000/file-{f:03d}.parquet" for f in range(3)] + ["meta/episodes/chunk-000/file-000.parquet", "meta/info.json", "meta/stats.json"] + [f"videos/observation.images.top/chunk-000/file-{f:03d}.mp4" for f in range(3)]
    meta = pq.ParquetFile(out / files[3]).read().to_pylist()
    assert list(meta[0]) == list(rows[0])
    want = [(0, 3, 0, 3, 0, 0, ["t1"]), (1, 4, 3, 7, 1, 1, ["t3"]), (2, 2, 7, 9, 2, 2, ["t4"])]
    assert [(r["episode_index"], r["length"], r["dataset_from_index"], r["dataset_to_index"], r["data/file_index"], r["videos/observation.images.top/file_index"], r["tasks"]) for r in meta] == want
    data = [r for f in files[:3] for r in pq.ParquetFile(out / f).read().to_pylist()]
    assert [r["index"] for r in data] == list(range(9)) and [r["episode_index"] for r in data] == [0] * 3 + [1] * 4 + [2] * 2
    assert [r["observation.state"][0] for r in data] == [1.0] * 3 + [3.0] * 4 + [4.0] * 2 and [r["frame_index"] for r in data] == [0, 1, 2, 0, 1, 2, 3, 0, 1]
