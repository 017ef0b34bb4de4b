"""What a session keeps: measured episodes and the small documents fitted on them, and files of scores.

A state is a folder of measures and one manifest that names it. The manifest is
renamed into place last, so readers see the earlier state or the new one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from . import datasets
from .rewrite import Folder

VERSION = 1


def save_state(measures: DataFrame, root: str, documents: Mapping[str, str | None]) -> None:
    """documents: name and JSON text, such as a calibration's or a profile's ``to_json``."""
    spark = measures.sparkSession
    folder, at = Folder(spark, root), f"measures-{uuid.uuid4().hex}"
    measures.write.parquet(f"{root}/{at}")
    before = _manifest(spark, folder)
    text = json.dumps({"version": VERSION, "measures": at, "documents": dict(documents)})
    folder.put_lines(spark.createDataFrame([(text,)], "value string"), "manifest.json", f"_manifest-{uuid.uuid4().hex}")
    if before:
        folder.remove(before["measures"])


def _manifest(spark: SparkSession, folder: Folder) -> dict | None:
    if not folder.exists("manifest.json"):
        return None
    try:
        got = datasets.read_json(spark, f"{folder.root}/manifest.json")
    except ValueError:
        return None
    return got if isinstance(got, dict) and got.get("version") == VERSION and folder.exists(str(got.get("measures"))) else None


def load_state(spark: SparkSession, root: str) -> tuple[DataFrame, dict[str, str | None]] | None:
    """Measures and documents; None where there is no state, or one that is damaged or of another version."""
    got = _manifest(spark, Folder(spark, root))
    return (spark.read.parquet(f"{root}/{got['measures']}"), got["documents"]) if got else None


def write_scores(rows: DataFrame, root: str, name: str, order: tuple[str, ...] = ("episode_id", "camera_type")) -> None:
    """Rows as one JSON array in one file, in the given order; a single task streams it."""
    w = W.orderBy("__last", *[F.col(f"__r.{c}") for c in order])
    line = F.to_json("__r", {"ignoreNullFields": "false"})
    end = rows.sparkSession.createDataFrame([(True,)], "__last boolean").withColumn("__r", F.lit(None).cast(T.StructType(rows.schema.fields)))
    d = rows.select(F.lit(False).alias("__last"), F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("__r")).unionByName(end)
    d = d.withColumn("__n", F.row_number().over(w))
    text = F.when(F.col("__last"), F.when(F.col("__n") == 1, "[]").otherwise("]")).otherwise(F.concat(F.when(F.col("__n") == 1, "[").otherwise(","), line))
    Folder(rows.sparkSession, root).put_lines(d.select(text.alias("value")), name, f"_scores-{uuid.uuid4().hex}")
