"""A corrupted copy of a small dataset, with a made-up clip format."""

import json

import numpy as np
import pyarrow.parquet as pq
import pytest
from test_rewrite import make

from episodica.sources import faults


def codec():
    """Reads and writes clips of a made-up format; nested, so that tasks get them by value."""

    def decode(path):
        raw = open(path.removeprefix("file:"), "rb").read()
        fps, n, h, w = np.frombuffer(raw[:16], "<i4")
        return float(fps), iter(np.frombuffer(raw[16:], np.uint8).reshape(n, h, w))

    def encode(path, fps, frames):
        a = np.stack(list(frames))
        with open(path.removeprefix("file:"), "wb") as f:
            f.write(np.array([fps, *a.shape], "<i4").tobytes() + a.tobytes())

    return decode, encode


decode, encode = codec()


def add(root, episodes):
    for e in episodes:
        at = root / "data" / f"chunk-{e // 2:03d}" / f"episode_{e:06d}.parquet"
        t = pq.ParquetFile(at).read()
        pq.write_table(t.append_column("action", [[[0.5, -0.5, float(e)]] * t.num_rows]), at)
        clip = next((root / "videos").rglob(f"episode_{e:06d}.mp4"))
        encode(str(clip), e % 2 * 20, np.random.default_rng(e).integers(0, 256, (3, 12, 17), dtype=np.uint8))


def test_blur_and_draws():
    x = np.random.default_rng(0).integers(0, 256, (9, 7, 3), dtype=np.uint8)
    sigma, half = 0.3 * ((9 - 1) * 0.5 - 1) + 0.8, 4
    w = np.exp(-(np.arange(-half, half + 1) ** 2) / (2 * sigma**2))
    w /= w.sum()
    wide = np.pad(x.astype(float), ((half, half), (half, half), (0, 0)), "reflect")
    plain = sum(w[i] * w[j] * wide[i : i + 9, j : j + 7] for i in range(9) for j in range(9))
    assert np.abs(faults.blurred(x, 9).astype(float) - plain).max() <= 0.5 + 1e-9
    for shape in ((1, 1), (1, 5), (2, 3)):
        assert faults.blurred(np.full(shape, 7, np.uint8), 9).tolist() == np.full(shape, 7).tolist()
    same = [list(faults.faulty([x, x], name, 1, 0.7)) for name in ("a", "a", "b")]
    assert np.array_equal(same[0][1], same[1][1]) and not np.array_equal(same[0][0], same[0][1]) and not np.array_equal(same[0][0], same[2][0])
    assert np.array_equal(next(faults.faulty([x], "a", 1, 0.0)), x)


def test_corrupt_dataset(spark, tmp_path):
    root, out = tmp_path / "in", tmp_path / "out"
    episodes = tuple(range(24))
    make(root, episodes)
    add(root, episodes)
    run = lambda at, **kw: {r.episode: (r.video, r.state, r.action) for r in faults.corrupt_dataset(spark, str(root), str(at), **{"probability": 0.5, "decode": decode, "encode": encode} | kw).collect()}
    got = run(out)
    assert set(got) == set(episodes) and {v for v, _, _ in got.values()} == {True, False} and {s for _, s, _ in got.values()} == {True, False}
    names = lambda r: sorted(p.relative_to(r).as_posix() for p in r.rglob("*") if p.is_file() and not p.name.startswith("."))
    assert names(out) == sorted([*names(root), "corruption_log.json"])
    log = json.loads((out / "corruption_log.json").read_text())
    assert log["total_episodes"] == 24 and log["corruption_probability"] == 0.5 and log["corruption_types"]["timestep_corruption"]["base_rate"] == 0.2
    assert {int(k): (v["video_corrupted"], v["state_corrupted"], v["action_corrupted"]) for k, v in log["corrupted_episodes"].items()} == got
    for name in names(root):
        a, b = root / name, out / name
        if name.endswith(".mp4"):
            e = int(a.stem[-6:])
            assert (a.read_bytes() != b.read_bytes()) == got[e][0]
            if got[e][0]:
                (f0, x), (f1, y) = decode(str(a)), decode(str(b))
                assert f1 == (f0 or 30) and np.array_equal(np.stack(list(y)), np.stack(list(faults.faulty(x, name, 42, 0.7))))
        elif name.endswith(".parquet"):
            e = int(a.stem[-6:])
            x, y = pq.ParquetFile(a).read(), pq.ParquetFile(b).read()
            assert x.column_names == y.column_names and [c for c in x.column_names if not x[c].equals(y[c])] and str(y.schema.field("action").type) == "list<element: float>"
            for c, hit in (("observation.state", got[e][1]), ("action", got[e][2])):
                moved = np.abs(np.array(x[c].to_pylist(), np.float32) - np.array(y[c].to_pylist(), np.float32))
                assert (moved.max() > 0) == hit and moved.max() < 0.5
                assert not hit or len(set(moved[moved.max(axis=1) > 0][0].tolist())) > 1
            assert all(x[c].equals(y[c]) for c in ("timestamp", "frame_index", "episode_index", "index", "task_index"))
        else:
            assert a.read_bytes() == b.read_bytes()
    again = tmp_path / "again"
    assert run(again) == got and all((out / n).read_bytes() == (again / n).read_bytes() for n in names(out) if n.endswith(".mp4"))
    assert not any(map(any, run(again, probability=0.0, decode=None, encode=None).values()))
    for error, kw in ((ValueError, {"probability": 1.5}), (FileExistsError, {"overwrite": False}), (ValueError, {"decode": None})):
        with pytest.raises(error):
            run(again, **kw)
    with pytest.raises(ValueError):
        run(f"{root}/")


def test_a_failed_clip_leaves_nothing(spark, tmp_path):
    def broken(path, fps, frames):
        open(path.removeprefix("file:"), "wb").write(b"half")
        raise RuntimeError("stopped")

    (tmp_path / "a.mp4").write_bytes(np.array([10, 0, 1, 1], "<i4").tobytes())
    clips = spark.createDataFrame([("a.mp4", f"{tmp_path}/a.mp4", f"{tmp_path}/out/a.mp4", True)], "name string, source string, target string, hit boolean")
    with pytest.raises(Exception, match="stopped"):
        faults.rewrite_clips(clips, decode, broken)
    assert list((tmp_path / "out").iterdir()) == []
