"""A judge of clips as a plug-in: no network is used until a client is given."""

from __future__ import annotations

import base64
import hashlib
import json
import mimetypes
import time
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import replies
from .rewrite import Folder, file_system, place_file

#: (video, task, way) -> message, finish_reason, prompt_tokens, completion_tokens
Client = Callable[[str, str, str], dict]
#: The ways of asking for structured output, the newest first.
WAYS = ("response_format", "structured_outputs", "guided_json")
REPLY = "video string, task string, message string, finish_reason string, prompt_tokens int, completion_tokens int, failed string"
_NAMES = [c.split()[0] for c in REPLY.split(", ")]


def sampling_step(frames: int, most: int) -> int:
    """Every which frame is sent so that about ``most`` are; 1 where there are no more than that, or no bound."""
    return 1 if most <= 0 or frames <= most else max(1, round(frames / most))


def _asked(client: Client, ways: Sequence[str], concurrency: int, retries: int, wait_s: float) -> Callable[[list[tuple[str, str]]], list[tuple]]:
    """A function from jobs to rows of REPLY that asks several at once and stays with the way that a server took."""
    at = [0]

    def one(job: tuple[str, str]) -> tuple:
        way, tries = at[0], 0
        while True:
            try:
                r = client(*job, ways[way])
                return (*job, json.dumps(r["message"]), r.get("finish_reason"), r.get("prompt_tokens") or 0, r.get("completion_tokens") or 0, None)
            except Exception as e:
                if "400" in str(e) and way + 1 < len(ways):
                    way += 1
                    at[0] = max(at[0], way)
                elif "400" not in str(e) and tries < retries:
                    time.sleep(wait_s * 2**tries)
                    tries += 1
                else:
                    return (*job, None, None, 0, 0, f"{type(e).__name__}: {e}")

    def many(jobs: list[tuple[str, str]]) -> list[tuple]:
        with ThreadPoolExecutor(concurrency) as pool:
            return list(pool.map(one, jobs))

    return many


def ask(jobs: DataFrame, client: Client, ways: Sequence[str] = ("plain",), concurrency: int = 1, retries: int = 0, wait_s: float = 1.0) -> DataFrame:
    """A reply for each (video, task), or the error in ``failed``; a task asks ``concurrency`` at once.

    Where a server rejects a way of asking (an error that holds 400), the next one is
    tried, and the task stays with it. Other errors are tried again ``retries`` times, each after twice the wait.
    A job's error is its own; the others go on. A lost task asks again; see ``ask_stored``.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        many = _asked(client, ways, concurrency, retries, wait_s)
        for batch in batches:
            yield pd.DataFrame(many(list(zip(batch["video"], batch["task"]))), columns=_NAMES)

    return jobs.select("video", "task").mapInPandas(run, REPLY)


def ask_stored(jobs: DataFrame, client: Client, root: str, ways: Sequence[str] = ("plain",), concurrency: int = 8, retries: int = 2, wait_s: float = 1.0, size: int = 64) -> DataFrame:
    """As ``ask``, with the replies of every ``size`` jobs written to a file below the shared folder ``root`` as soon as they are there.

    A task that runs again finds the files of its earlier run and asks for the rest alone, and so does
    a later call: jobs with a reply are not asked again, jobs that failed are. Repeated jobs are asked once.
    """
    spark, folder = jobs.sparkSession, Folder(jobs.sparkSession, root)
    home = folder.qualified()

    def stored() -> DataFrame:
        found = spark.read.schema(REPLY).json(f"{root}/*.jsonl") if folder.exists() else spark.createDataFrame([], REPLY)
        rest = [c for c in _NAMES if c not in ("video", "task")]
        best = F.min_by(F.struct(*rest), F.struct(F.col("failed").isNotNull(), "message"))
        return found.groupBy("video", "task").agg(best.alias("r")).select("video", "task", "r.*")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        many = _asked(client, ways, concurrency, retries, wait_s)
        held: list[tuple[str, str]] = []
        n = 0

        def commit(some: list[tuple[str, str]]) -> None:
            at = f"{home}/{hashlib.sha256(json.dumps(some).encode()).hexdigest()}.jsonl"
            system, path = file_system(at)
            known = []
            if system.get_file_info(path).is_file:
                with system.open_input_stream(path) as f:
                    rows = [json.loads(x) for x in f.read().decode().splitlines()]
                known = [tuple(r.get(c) for c in _NAMES) for r in rows if r.get("failed") is None]
            have = {r[:2] for r in known}
            left = [j for j in some if j not in have]
            if not left:
                return
            text = "\n".join(json.dumps(dict(zip(_NAMES, r))) for r in known + many(left))

            def write(to: str) -> None:
                system, path = file_system(to)
                with system.open_output_stream(path) as f:
                    f.write(text.encode())

            place_file(at, write)

        for batch in batches:
            for job in zip(batch["video"], batch["task"]):
                held.append(job)
                if len(held) == size:
                    commit(held)
                    held, n = [], n + size
        if held:
            commit(held)
        yield pd.DataFrame({"n": [n + len(held)]})

    wanted = jobs.select("video", "task").where("video is not null and task is not null").distinct()
    todo = wanted.join(stored().where("failed is null"), ["video", "task"], "left_anti")
    # the order makes the same files of the same partition
    ordered = todo.repartition("video", "task").sortWithinPartitions("video", "task")
    ordered.mapInPandas(run, "n long").agg(F.sum("n")).collect()
    return stored().join(wanted, ["video", "task"], "left_semi") if folder.exists() else spark.createDataFrame([], REPLY)


def is_up(client: Callable[[], int]) -> bool:
    """Whether a server answers: any status under 500 counts, an error or a worse status doesn't. The client gives the status."""
    try:
        return client() < 500
    except Exception:
        return False


def media(path: str, inline: bool = False) -> str:
    """A clip as a URL: its place, or the whole of it in base64; for clients, in tasks."""
    system, at = file_system(path)
    if not inline:
        return path if "://" in path else "file://" + at
    with system.open_input_stream(at) as f:
        return f"data:{mimetypes.guess_type(at)[0] or 'video/mp4'};base64,{base64.b64encode(f.read()).decode()}"


def evaluate(jobs: DataFrame, client: Client, ways: Sequence[str] = ("plain",), max_tokens: int = 10000, root: str | None = None) -> DataFrame:
    """A verdict for each job, as ``replies.judged`` makes it; jobs that failed have their error and no score. ``root`` keeps the replies."""
    d = replies.judged(ask_stored(jobs, client, root, ways) if root else ask(jobs, client, ways), max_tokens)
    bad = F.col("failed").isNotNull()
    blank = {c: F.when(~bad, F.col(c)) for c in ("observed_final_state", "goal_predicate", "predicate_holds", "score")}
    return d.withColumns(blank | {"note": F.when(bad, "").otherwise(F.col("note")), "error": F.coalesce("failed", "error")}).drop("failed")
