"""Verdict logs as a stream. The batch engine doesn't need this; it is an addition."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..functions.verdicts import latest
from ..sources.datasets import VERDICTS


def verdict_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The verdicts of a folder of files, one file a batch, in the order in which they were written."""
    return spark.readStream.schema(VERDICTS).option("maxFilesPerTrigger", 1).json(folder)


def upsert(stream: DataFrame, table_path: str, checkpoint: str) -> StreamingQuery:
    """Each batch's verdicts are a partition of their own, which a repeated batch replaces; read them with ``current``."""
    from pyspark.sql import functions as F

    def put(batch: DataFrame, number: int) -> None:
        batch.withColumn("line", F.monotonically_increasing_id()).write.mode("overwrite").parquet(f"{table_path}/batch={number}")

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, table_path: str) -> DataFrame:
    """The last verdict of each (video, task)."""
    from pyspark.sql import functions as F

    return latest(spark.read.parquet(table_path).withColumn("__order", F.struct("batch", "line")), "__order").drop("__order", "batch", "line")
