"""Helpers shared by the text operators."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate rows: spark.checkpoint.dir, or the checkpoint folder set on the context.

    Only a session on a single machine (master local) may have neither: it gets
    a temporary folder. On a cluster that is an error, since executors don't
    share local folders.
    """
    sc = spark.sparkContext
    given = sc.getConf().get("spark.checkpoint.dir", None)
    known = sc._jsc.sc().getCheckpointDir()
    if given or not known.isEmpty():
        return given or known.get()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="episodica-checkpoint-"))
    return sc._jsc.sc().getCheckpointDir().get()


def settle(df: DataFrame) -> DataFrame:
    """The same rows with their lineage cut by a checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def column(name: str) -> Column:
    """A column by its plain name, whatever signs that has."""
    return F.col("`" + name.replace("`", "``") + "`")


def packed(df: DataFrame) -> Column:
    """The whole row as one struct, so that no working column can clash with the row's own."""
    return F.struct(*[column(c) for c in df.columns])


def unpacked(df: DataFrame, row: str = "row") -> list[Column]:
    """The columns of a packed row under their own names."""
    return [column(row).getField(f.name).alias(f.name) for f in df.schema[row].dataType.fields]


def free(name: str, df: DataFrame) -> str:
    """The name for a new column: with underscores behind it where the input has such a column already."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def ends(lengths: str) -> str:
    """Running sums of an array of lengths, in pieces of 1000 so that long arrays aren't copied for each element."""
    sums = "aggregate({a}, cast(array() as array<bigint>), (acc, x) -> array_append(acc, coalesce(try_element_at(acc, -1), 0L) + x))"
    return f"""
      transform(array(transform(if(size({lengths}) = 0, cast(array() as array<int>), sequence(0, (size({lengths}) - 1) div 1000)), c -> {sums.format(a=f'slice({lengths}, c * 1000 + 1, 1000)')})),
        chunks -> flatten(zip_with(chunks, {sums.format(a='transform(chunks, z -> element_at(z, -1))')}, (z, s) -> transform(z, v -> v + s - element_at(z, -1)))))[0]"""


def spread_join(big: DataFrame, small: DataFrame, key: str, by: list[str], how: str = "inner", parts: int = 64) -> DataFrame:
    """big joined with small (one settled row a key, ``c`` = rows of big with the key), keys with many rows dealt by a salt.

    A key is hot with a thousandth of big's rows or more, so there are at most a
    thousand, which are broadcast; a hot key's rows are dealt by the hash of the
    columns ``by`` over as many parts, each of which has its own copy of small's
    row. Rows without a key are dealt too.
    """
    total = small.agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    hot = F.col("c") >= max(1000, total / 1000)
    keys = small.where(hot).select(key, F.lit(parts).alias("parts"))
    dealt = big.join(F.broadcast(keys), key, "left").withColumn("salt", F.when(F.col("parts").isNotNull() | F.col(key).isNull(), F.pmod(F.xxhash64(*by), F.lit(parts))).otherwise(F.lit(0)).cast("int")).drop("parts")
    copies = small.withColumn("salt", F.explode(F.when(hot, F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(F.lit(0))))).drop("c")
    return dealt.join(copies, [key, "salt"], how).drop("salt")


def sha_hex(c: Column) -> Column:
    return F.sha2(F.encode(c, "UTF-8"), 256)


def series_udf(fn: Callable[[pd.Series], pd.DataFrame], returns):
    """A pandas UDF that turns batches of one text column into structs."""

    def run(batches):
        for batch in batches:
            yield fn(batch)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(run, returns)
