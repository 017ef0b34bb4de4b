"""Mixing sources to target weights by Pfair scheduling, with Spark expressions only.

A source's rows are put in an order of their own (by md5 of doc_id, then a hash
of the row) and cut into blocks of ``block_rows``. With weights w and their sum
V, block k (from 0) of a source is released at floor(k * V / w) and due at
ceil((k + 1) * V / w), in whole numbers and without any rounding of the shares.
Slot by slot the released block that is due first is taken (ties: the lesser
key), so after any number of slots a source is less than one block away from its
share of the weights asked for. The timetable repeats after V divided by the
weights' greatest common divisor; that period is worked out, or only as many
slots as the rows need, where these are fewer. It is a sequence in which each
slot depends on the one before, so one task makes it, from the weights alone, in
pieces of ``CHUNK`` slots; at one slot a block of any size it is small beside
the rows.

When a source has no blocks left its slots stay empty and the others go on in
their proportions: every row gets a slot and none is dropped or repeated. The
order of the mixture is (slot, place).

Row numbers are made from prefixes of the order: each source's rows are counted
by prefix (long enough for ``ROWS`` rows in each on average), numbered within a
prefix, and shifted by the counts before it, so a source with any share of the
rows is spread over thousands of groups. Where a prefix still holds over ``HOT``
rows (null or repeated doc_ids), it is cut by the row's hash as well, and equal
rows are counted, numbered at once and written out again in pieces.

Null sources form a source of their own; null doc_ids and repeated rows are
numbered too. Texts of any length are only moved. An empty table gives no rows.
All columns of the input are kept; where one is called block, slot or place, the
new one gets an underscore behind its name. Rows with columns of maps are not
gathered with their equals.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import column, free, packed, settle, unpacked

BLOCK_ROWS = 32
ROWS = 50_000
HOT = 200_000
PIECE = 10_000
CHUNK = 65_536
STEP = 512
BROADCAST_ROWS = 200_000


def _key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("null"))


def default_weights(keys: DataFrame) -> DataFrame:
    """key, weight: a stand-in for a chosen mixture, from 1 to 9 by the key's md5."""
    return keys.select("key", (F.conv(F.substring(F.md5("key"), 1, 2), 16, 10).cast("long") % 9 + 1).alias("weight"))


def _units(weights: DataFrame) -> DataFrame:
    """key and weight without their greatest common divisor, in one row: s (sorted), period."""
    one = weights.agg(F.array_sort(F.collect_list(F.struct("key", "weight"))).alias("s")).where("size(s) > 0")
    gcd = "aggregate(sequence(1, 96), struct(g as a, x.weight as b), (e, i) -> if(e.b = 0, e, struct(e.b as a, e.a % e.b as b)), e -> e.a)"
    one = one.withColumn("g", F.expr(f"aggregate(s, 0L, (g, x) -> {gcd})"))
    one = one.select(F.expr("transform(s, x -> struct(x.key as key, x.weight div g as w))").alias("s"))
    return one.withColumn("period", F.expr("aggregate(s, 0L, (a, x) -> a + x.w)"))


def timetable(weights: DataFrame, slots: int | None = None) -> DataFrame:
    """key, w (weight without common divisors), period, job and slot: one period, or its first slots.

    weights: key and a whole-number weight above 0, one row for each key.
    """
    state = _units(weights).withColumn("done", F.expr("transform(s, x -> 0L)"))
    if slots is None or slots > CHUNK:
        row = state.select("period").first()
        slots = 0 if row is None else min(row[0], slots or row[0])
    pick = "array_min(transform(s, (x, i) -> if(acc.done[i] * period div x.w <= t, struct((acc.done[i] * period + period + x.w - 1) div x.w as due, i as i), null))).i"
    one = f"""aggregate(array({pick}), acc, (a, p) -> struct(
        transform(a.done, (d, i) -> if(i = p, d + 1, d)) as done, array_append(a.plan, struct(p as i, a.done[p] as job, t as slot)) as plan))"""
    empty = "cast(array() as array<struct<i:int,job:bigint,slot:bigint>>)"
    parts = []
    for start in range(0, max(slots, 1), CHUNK):
        end = min(start + CHUNK, slots)
        run = f"""
          aggregate(sequence({start}L, least({end}L, period) - 1, {STEP}L), struct(done as done, array({empty}) as plans), (out, at) ->
            aggregate(array(aggregate(sequence(at, least(at + {STEP}L, {end}L, period) - 1), struct(out.done as done, {empty} as plan), (acc, t) -> {one})), out,
              (o, r) -> struct(r.done as done, array_append(o.plans, r.plan) as plans)))"""
        ran = state.withColumn("r", F.expr(run))
        if slots > CHUNK:
            ran = settle(ran)
        parts.append(ran.select("s", "period", F.explode_outer(F.flatten("r.plans")).alias("p")))
        state = ran.select("s", "period", F.col("r.done").alias("done"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where("p is not null").select(F.expr("s[p.i].key").alias("key"), F.expr("s[p.i].w").alias("w"), "period", "p.job", "p.slot")


def _small(df: DataFrame, rows: int) -> DataFrame:
    """A hint to broadcast, where so many short rows are few."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _numbered(docs: DataFrame, source_col: str, id_col: str, total: int) -> DataFrame:
    """row, key and at: each row's place in its source's order, from 0."""
    length = max(3, math.ceil(math.log(max(total, 1) / ROWS, 16)))
    key, md5 = _key(column(source_col)), F.md5(F.coalesce(column(id_col).cast("string"), F.lit("")))
    tie = F.lpad(F.hex(F.xxhash64(*[column(c) for c, kind in docs.dtypes if "map<" not in kind])), 16, "0")
    sizes = settle(docs.select(key.alias("key"), F.substring(md5, 1, length).alias("bucket")).groupBy("key", "bucket").agg(F.count("*").alias("n")))
    hot = sizes.where(F.col("n") > HOT).select("key", F.col("bucket").alias("prefix")).withColumn("hot", F.lit(True))
    n_hot = hot.count()
    alike = n_hot and not any("map<" in kind for _, kind in docs.dtypes)
    # equal rows are gathered only where some prefix is hot, since that moves every row once more
    given = docs.groupBy(*[column(c) for c in docs.columns]).agg(F.count("*").alias(free("copies", docs))) if alike else docs
    copies = column(given.columns[-1]) if alike else F.lit(1)
    rows = given.select(F.struct(*[column(c) for c in docs.columns]).alias("row") if alike else packed(docs).alias("row"), key.alias("key"), F.concat(md5, tie).alias("order"), copies.cast("long").alias("n"))
    rows = rows.withColumn("bucket", F.substring("order", 1, length))
    if n_hot:
        marked = rows.withColumnRenamed("bucket", "prefix").join(_small(hot, n_hot), ["key", "prefix"], "left")
        rows = marked.select("row", "key", "order", "n", F.when(F.col("hot"), F.substring("order", 1, 36)).otherwise(F.col("prefix")).alias("bucket"))
        sizes = settle(rows.groupBy("key", "bucket").agg(F.sum("n").alias("n")))
    before = W.partitionBy("key").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("key", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = W.partitionBy("key", "bucket").orderBy("order")
    if not n_hot:
        rows = rows.withColumn("rn", F.row_number().over(within) - 1).join(starts, ["key", "bucket"])
        return rows.select("row", "key", (F.col("start") + F.col("rn")).alias("at"))
    ahead = F.coalesce(F.sum("n").over(within.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumn("rn", ahead).join(starts, ["key", "bucket"]).withColumn("first", F.col("start") + F.col("rn"))
    pieces = rows.select("row", "key", "first", "n", F.explode(F.expr(f"sequence(0L, n - 1, {PIECE}L)")).alias("from"))
    pieces = pieces.repartition("key", "first", "from")
    return pieces.select("row", "key", F.explode(F.expr(f"sequence(first + from, first + least(from + {PIECE}L, n) - 1)")).alias("at"))


def interleave(docs: DataFrame, weights: DataFrame | None = None, source_col: str = "source", id_col: str = "doc_id", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """All rows with block, slot and place (from 0, within the block).

    weights: key (see ``_key``) and a whole-number weight above 0, the target.
    Sources without one get the weight 1. Default: ``default_weights``.
    """
    counts = settle(docs.groupBy(_key(column(source_col)).alias("key")).agg(F.count("*").alias("n")))
    given = weights if weights is not None else default_weights(counts)
    given = given.where("key is not null and weight > 0").groupBy("key").agg(F.max(F.col("weight").cast("long")).alias("weight"))
    asked = settle(counts.join(given, "key", "left").select("key", "n", F.coalesce("weight", F.lit(1)).cast("long").alias("weight")))
    sources, total, v = asked.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    need = f"ceil(cast((n + {block_rows - 1}) div {block_rows} as decimal(38, 0)) * {v}L / weight)"
    slots = asked.agg(F.coalesce(F.max(F.expr(need)).cast("long"), F.lit(0))).first()[0]
    plan = timetable(asked.select("key", "weight"), slots)
    if slots > CHUNK:
        plan = settle(plan)
    rate = _units(asked.select("key", "weight")).select("period", F.explode("s").alias("x")).select("x.key", "x.w", "period")
    cut = _numbered(docs, source_col, id_col, total).join(_small(rate, sources), "key")
    cut = cut.withColumn("block", F.expr(f"at div {block_rows}")).withColumn("place", F.expr(f"cast(at % {block_rows} as int)")).withColumn("job", F.expr("block % w"))
    placed = cut.join(_small(plan.select("key", "job", F.col("slot").alias("first")), slots), ["key", "job"]).withColumn("slot", F.expr("block div w * period + first"))
    new = [F.col(c).alias(free(c, docs)) for c in ("block", "slot", "place")]
    return placed.select(*unpacked(placed), *new)
