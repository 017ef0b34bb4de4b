"""Readers and writers of episode folders.

    meta/info.json, meta/modality.json, meta/episodes.jsonl, meta/tasks.jsonl
    data/**/episode_000012.parquet
    videos/**/<camera>/episode_000012.mp4

Everything goes through Spark's file sources, so any file system that Spark
reads will do.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.verdicts import latest

#: Column names on disk and here.
CHANNELS = {
    "timestamp": "t", "observation.state": "state", "action.wbc": "action", "observation.eef_state": "eef", "observation.projected_gravity": "gravity",
    "observation.left_hand_q": "left_hand", "observation.right_hand_q": "right_hand", "frame_index": "frame_index",
}
VIDEO_SUFFIXES = ("mp4", "mov", "mkv", "avi", "webm", "m4v")


def episode_number(name: Column) -> Column:
    return F.regexp_extract(name, r"_(\d+)\.", 1).cast("int")


def superseded(paths: Iterable[str]) -> list[str]:
    """Files whose episode has a file with a greater path; mostly none. One slash stands behind the scheme."""
    last: dict[int, str] = {}
    lost = []
    for p in sorted(re.sub(r"^([a-z0-9]+:)/+", r"\1/", p) for p in paths):
        number = re.search(r"_(\d+)\.[^/]*$", p)
        if number:
            lost += [last[int(number[1])]] if int(number[1]) in last else []
            last[int(number[1])] = p
    return lost


def read_episodes(spark: SparkSession, root: str) -> DataFrame:
    """All frames with their episode, channels renamed; absent channels are NULL, other columns are never read.

    Of several files of one episode the one with the greatest path counts.
    """
    raw = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "episode_*.parquet").option("mergeSchema", True).parquet(f"{root}/data")
    twice = superseded(raw.inputFiles())
    if twice:
        raw = raw.where(~F.regexp_replace("_metadata.file_path", "^([a-z0-9]+:)/+", "$1/").isin(*twice))
    cols = [episode_number(F.col("_metadata.file_name")).alias("episode")]
    for disk, name in CHANNELS.items():
        kind = "double" if name == "t" else "int" if name == "frame_index" else "array<double>"
        cols.append((F.col(f"`{disk}`") if disk in raw.columns else F.lit(None)).cast(kind).alias(name))
    d = raw.select(*cols)
    if "frame_index" not in raw.columns:
        from pyspark.sql import Window as W

        d = d.withColumn("frame_index", (F.row_number().over(W.partitionBy("episode").orderBy("t")) - 1).cast("int"))
    return d


def read_json(spark: SparkSession, path: str) -> dict:
    """A small JSON document."""
    return json.loads("\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect()))


def version(info: Mapping) -> str:
    v = str(info.get("codebase_version") or "v2.1")
    return v if v.startswith("v") else f"v{v}"


def cameras(info: Mapping) -> list[str]:
    return [k.removeprefix("observation.images.") for k in info.get("features", {}) if k.startswith("observation.images.")]


def default_camera(info: Mapping, videos: DataFrame | None = None) -> str | None:
    """The first camera of the info document, else the first by name of those that have clips."""
    named = cameras(info)
    if named or videos is None:
        return named[0] if named else None
    return videos.agg(F.min("camera")).first()[0]


def rename_channels(info: Mapping) -> dict:
    """The document with ``rgb`` among the names of image axes read as ``channels``."""
    fix = lambda v: {**v, "names": ["channels" if n == "rgb" else n for n in v["names"]]} if isinstance(v.get("names"), list) else v
    return {**info, "features": {k: fix(v) for k, v in info.get("features", {}).items()}}


def groups(modality: Mapping) -> dict[str, tuple[int, int]]:
    """Joint groups: entries of state with a start and an end and without another key of their own."""
    return {k: (int(v["start"]), int(v["end"])) for k, v in modality.get("state", {}).items() if "start" in v and "end" in v and not v.get("original_key")}


def action_column(features: Mapping) -> str | None:
    """``action``, else the ``action.*`` as wide as the state, else the first."""
    if "action" in features:
        return "action"
    width = (features.get("observation.state", {}).get("shape") or [None])[-1]
    names = [k for k in features if k.startswith("action.")]
    return next((k for k in names if (features[k].get("shape") or [None])[-1] == width), names[0] if names else None)


def tasks(spark: SparkSession, root: str) -> DataFrame:
    """episode and its first task."""
    schema = "episode_index long, tasks array<string>, length long"
    return spark.read.schema(schema).json(f"{root}/meta/episodes.jsonl").select(F.col("episode_index").alias("episode"), F.get("tasks", F.lit(0)).alias("task"))


def default_task(spark: SparkSession, root: str) -> str:
    """The task on the first line of tasks.jsonl that isn't blank; empty without one."""
    first = spark.read.text(f"{root}/meta/tasks.jsonl").where(F.trim("value") != "").limit(1).select(F.get_json_object("value", "$.task").alias("task")).first()
    return (first["task"] if first else None) or ""


def read_meta_v30(spark: SparkSession, root: str) -> DataFrame:
    """The episode table of a v3.0 folder, all of its files."""
    return spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "file-*.parquet").option("mergeSchema", True).parquet(f"{root}/meta/episodes")


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    """A score file (one JSON array, or a line per row) with the scores of single attributes as columns of their own."""
    d = spark.read.option("multiLine", True).json(path)
    return d.select(*[c for c in d.columns if c != "per_attribute_scores"], "per_attribute_scores.*")


def resolve_tasks(rows: DataFrame, known: DataFrame, default: str | None = None) -> DataFrame:
    return rows.join(known, "task_index", "left").withColumn("task", F.coalesce("task", F.lit(default)))


def videos(spark: SparkSession, root: str, camera: str | None = None) -> DataFrame:
    """episode, camera and path of each clip; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{root}/videos").select("path")
    d = files.where(F.lower(F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1)).isin(*VIDEO_SUFFIXES))
    d = d.select(episode_number(F.element_at(F.split("path", "/"), -1)).alias("episode"), F.element_at(F.split("path", "/"), -2).alias("camera"), "path")
    return d.where(F.col("camera") == camera) if camera else d


def video_segments(meta: DataFrame, camera: str, duration: Column | None = None) -> DataFrame:
    """Adds path, from_s and to_s of a camera's clip; NULL where the metadata has no such camera."""
    at = lambda k: F.col(f"`videos/{camera}/{k}`")
    if f"videos/{camera}/chunk_index" not in meta.columns:
        return meta.withColumns({"path": F.lit(None).cast("string"), "from_s": F.lit(None).cast("double"), "to_s": F.lit(None).cast("double")})
    path = F.format_string(f"videos/{camera}/chunk-%03d/file-%03d.mp4", at("chunk_index").cast("long"), at("file_index").cast("long"))
    end = at("to_timestamp").cast("double")
    return meta.withColumns({"path": path, "from_s": F.coalesce(at("from_timestamp").cast("double"), F.lit(0.0)), "to_s": F.coalesce(end, duration) if duration is not None else end})


def check_manifest(jobs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Jobs with a video (or path) and a task, and the lines that lack one."""
    d = jobs.withColumn("video", F.coalesce("video", "path"))
    ok = F.col("video").isNotNull() & F.col("task").isNotNull()
    return d.where(ok).select("line", "video", "task"), d.where(~ok).select("line")


VERDICTS = T.StructType([T.StructField(n, T.StringType()) for n in ("video", "task", "predicate_holds", "goal_predicate", "observed_final_state", "note", "error")] + [T.StructField("episode", T.LongType()), T.StructField("score", T.DoubleType()), T.StructField("cached", T.BooleanType())])


_COMMIT = "commit={:019d}"


def _log_folder(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def commit_verdicts(verdicts: DataFrame, path: str) -> int:
    """Verdicts with their ``line`` as the log's next commit, a folder renamed into place."""
    spark, name = verdicts.sparkSession, uuid.uuid4().hex
    fs, at = _log_folder(spark, path)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs.mkdirs(at)
    staged = hadoop(at, f"_staged-{name}")
    verdicts.write.option("ignoreNullFields", False).json(staged.toString())
    try:
        while True:
            number = max(_commits(fs, at).values(), default=0) + 1
            # a file is made by one writer alone, so two never share a number
            claim = hadoop(at, f"_claim-{number:019d}")
            if fs.createNewFile(claim):
                if number > max(_commits(fs, at).values(), default=0):
                    break
                fs.delete(claim, False)
                continue
            if not fs.exists(hadoop(at, _COMMIT.format(number))) and fs.getFileStatus(claim).getModificationTime() < (time.time() - CLAIM_S) * 1000:
                fs.delete(claim, False)  # its writer is gone
            time.sleep(0.05)
        fs.rename(staged, hadoop(at, _COMMIT.format(number)))
        fs.delete(claim, False)
    finally:
        fs.delete(staged, True)
    return number


#: Seconds after which an unfinished commit's claim on its number is given up.
CLAIM_S = 600


def compact_verdicts(spark: SparkSession, path: str) -> None:
    """The last verdict of each (video, task) as one commit in place of all commits so far, under the number of the last."""
    fs, at = _log_folder(spark, path)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    known = _commits(fs, at)
    old = sorted(known, key=lambda n: (known[n], n))
    if len(old) < 2:
        return
    rows = _lines(spark, [f"{path}/{n}" for n in old])
    staged = f"{path}/_staged-{uuid.uuid4().hex}"
    latest(rows, "line").withColumn("line", F.struct(F.col("line.commit").alias("commit"), F.col("line.line").alias("line"))).write.option("ignoreNullFields", False).json(staged)
    # the merged rows carry their own commits, so a reader that meets old and new ones finds the same last verdicts
    fs.rename(hadoop(staged), hadoop(at, f"{_COMMIT.format(known[old[-1]])}-{uuid.uuid4().hex}"))
    for n in old:
        fs.delete(hadoop(at, n), True)


def _commits(fs, at) -> dict[str, int]:
    """The commits of a log by the names of their folders."""
    names = [f.getPath().getName() for f in fs.listStatus(at)]
    return {n: int(n[len("commit=") :].split("-")[0]) for n in names if n.startswith("commit=")}


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines with their order: commit, then line. Merged lines carry both."""
    merged = T.StructType([*VERDICTS.fields, T.StructField("line", T.StringType())])
    v = F.from_json("value", merged).alias("v")
    raw = spark.read.text(paths).select(v, F.regexp_extract(F.col("_metadata.file_path"), r"/commit(?:=|%3D)([0-9]+)", 1).alias("number"), F.col("_metadata.file_modification_time").alias("written"), F.monotonically_increasing_id().alias("row"))
    number = F.coalesce(F.get_json_object("v.line", "$.commit").cast("long"), F.when(F.col("number") == "", 0).otherwise(F.col("number").cast("long")))
    line = F.coalesce(F.get_json_object("v.line", "$.line").cast("long"), F.expr("try_cast(v.line as bigint)"), F.col("row"))
    return raw.where("v.video is not null").select(F.struct(number.alias("commit"), F.when(number == 0, F.col("written")).alias("written"), line.alias("line")).alias("line"), *[f"v.{f.name}" for f in VERDICTS.fields])


def read_verdicts(spark: SparkSession, path: str) -> DataFrame:
    """Verdict lines with ``line``, their order; lines that aren't JSON are left out.

    path: a log of commits, one file of lines, or a folder of such files. Commits follow
    their numbers; plain files stand before them, by the time when they were written.
    """
    fs, at = _log_folder(spark, path)
    if not fs.getFileStatus(at).isDirectory():
        return _lines(spark, [path])
    return _lines(spark, [f"{path}/{n}" for n in _commits(fs, at)] or [path])


def write_episodes(frames: DataFrame, path: str) -> None:
    """Reindexed frames, one folder per episode, zstd."""
    frames.repartition("episode_index").sortWithinPartitions("episode_index", "frame_index").write.option("compression", "zstd").partitionBy("episode_index").parquet(path)


def write_table(df: DataFrame, path: str, fmt: str = "csv") -> None:
    flat = df.select(*[F.concat_ws("; ", c).alias(c) if t == "array<string>" else F.col(c) for c, t in df.dtypes if fmt != "csv" or not t.startswith(("map", "struct")) and (t == "array<string>" or not t.startswith("array"))])
    (flat.write.option("header", True).csv(path) if fmt == "csv" else flat.write.json(path))
