"""Header boxes of hand-built clips, and replies that are asked for once."""

import io
import os

import pytest

from episodica.sources import judge, video


def box(kind, *parts, wide=False):
    body = b"".join(parts)
    return ((1).to_bytes(4) + kind + (len(body) + 16).to_bytes(8) if wide else (len(body) + 8).to_bytes(4) + kind) + body


def timed(kind, scale, ticks, version=0):
    w = 8 if version else 4
    return box(kind, bytes([version, 0, 0, 0]), bytes(2 * w), scale.to_bytes(4), ticks.to_bytes(w), bytes(4))


def track(handler, scale, ticks, n, version=0):
    sizes = box(b"stsz", bytes(4), bytes(4), n.to_bytes(4), b"".join((9).to_bytes(4) for _ in range(n)))
    hdlr = box(b"hdlr", bytes(8), handler, bytes(12))
    return box(b"trak", box(b"tkhd", bytes(80)), box(b"mdia", timed(b"mdhd", scale, ticks, version), hdlr, box(b"minf", box(b"stbl", box(b"stsd", bytes(8)), sizes))))


FTYP, SOUND = box(b"ftyp", b"isom", bytes(4)), track(b"soun", 48000, 96000, 7)
CLIPS = {
    "end": (FTYP + box(b"mdat", bytes(5000)) + box(b"moov", timed(b"mvhd", 1000, 9999), SOUND, track(b"vide", 15360, 38400, 75)), (2.5, 75)),
    "wide": (FTYP + box(b"mdat", bytes(50), wide=True) + box(b"moov", timed(b"mvhd", 1000, 1), track(b"vide", 600, 1 << 33, 3, 1)), ((1 << 33) / 600, 3)),
    "silent": (box(b"moov", timed(b"mvhd", 1000, 1500), track(b"vide", 600, 0, 4)), (1.5, 4)),
    "unknown": (box(b"moov", timed(b"mvhd", 1000, 1500), track(b"vide", 600, (1 << 32) - 1, 4)), (1.5, 4)),
    "pieces": (box(b"moov", timed(b"mvhd", 1000, 0), track(b"vide", 600, 0, 0), box(b"mvex", box(b"mehd", bytes(4), (2500).to_bytes(4)))), (2.5, None)),
    "rest": ((0).to_bytes(4) + box(b"moov", timed(b"mvhd", 1000, 10), track(b"vide", 30, 60, 60))[4:], (2.0, 60)),
    "sound": (box(b"moov", timed(b"mvhd", 1000, 10), SOUND), (None, None)),
    "cut": (FTYP + box(b"moov", track(b"vide", 30, 60, 60))[:-40], (None, None)),
    "zero": (b"\0\0\0\2moov" + bytes(20), (None, None)),
    "none": (b"", (None, None)),
    "text": (b"this is no clip at all, whatever its name", (None, None)),
}


def test_clip_header():
    for name, (raw, want) in CLIPS.items():
        assert video.clip_header(io.BytesIO(raw), len(raw)) == want, name
    whole = CLIPS["end"][0]
    for n in range(0, len(whole), 7):
        video.clip_header(io.BytesIO(whole[:n]), n)


def test_with_ends(spark, tmp_path):
    for name, (raw, _) in CLIPS.items():
        (tmp_path / f"{name}.mp4").write_bytes(raw)
    rows = [(f"{n}.mp4", 0.0, None) for n in CLIPS] + [("end.mp4", 1.0, 2.0), ("lost.mp4", 0.0, None), (None, None, None)]
    got = video.with_ends(spark.createDataFrame(rows, "path string, from_s double, to_s double"), str(tmp_path)).collect()
    want = [(f"{n}.mp4", 0.0, w[0], *w) for n, (_, w) in CLIPS.items()] + [("end.mp4", 1.0, 2.0, 2.5, 75), ("lost.mp4", 0.0, None, None, None), (None,) * 5]
    assert sorted((tuple(r[c] for c in ("path", "from_s", "to_s", "duration_s", "n_frames")) for r in got), key=repr) == sorted(want, key=repr)


def test_replies_are_asked_for_once(spark, tmp_path):
    calls, store = tmp_path / "calls", f"{tmp_path}/replies"
    calls.mkdir()

    def client(v, task, way, folder=str(calls)):
        import uuid

        open(os.path.join(folder, f"{v}-{way}-{uuid.uuid4().hex}"), "w").close()
        n = sum(name.startswith(f"{v}-") for name in os.listdir(folder))
        if way == "new":
            raise RuntimeError("status 400")
        if v == "v3" and n < 3:
            raise RuntimeError("status 503")
        if v == "v5" and not os.path.exists(os.path.join(folder, "mended")):
            raise ValueError("no such clip")
        return {"message": {"content": f"{v} {task}"}, "finish_reason": "stop", "prompt_tokens": 1, "completion_tokens": 2}

    jobs = spark.createDataFrame([(f"v{i}", "t") for i in range(10)] + [("v1", "t"), (None, "t"), ("v2", None)], "video string, task string")
    asked = lambda v: sum(x.startswith(f"{v}-old") for x in os.listdir(calls))
    run = lambda: {r.video: r for r in judge.ask_stored(jobs, client, store, ("new", "old"), concurrency=3, retries=2, wait_s=0.01, size=2).collect()}
    got = run()
    assert set(got) == {f"v{i}" for i in range(10)} and {v for v, r in got.items() if r.failed} == {"v5"} and "no such clip" in got["v5"].failed
    assert '"v1 t"' in got["v1"].message and asked("v1") == 1 and asked("v5") == 3 and asked("v3") in (2, 3)
    before = {f"v{i}": asked(f"v{i}") for i in range(10)}
    (calls / "mended").touch()
    again = run()
    assert not any(r.failed for r in again.values()) and '"v5 t"' in again["v5"].message
    assert {v: asked(v) - n for v, n in before.items()} == {v: int(v == "v5") for v in before}
    assert judge.ask_stored(jobs.limit(0), client, f"{tmp_path}/empty").collect() == []


def test_media_and_server(tmp_path):
    (tmp_path / "a.mp4").write_bytes(b"abc")
    assert judge.media(f"{tmp_path}/a.mp4") == f"file://{tmp_path}/a.mp4" and judge.media(f"{tmp_path}/a.mp4", True) == "data:video/mp4;base64,YWJj"
    assert judge.is_up(lambda: 200) and judge.is_up(lambda: 404) and not judge.is_up(lambda: 503) and not judge.is_up(lambda: 1 // 0)
    with pytest.raises(OSError):
        judge.media(f"{tmp_path}/b.mp4", True)
