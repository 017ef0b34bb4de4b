"""Ranked lexical search by TPUT over term-partitioned postings.

Tasks turn runs of documents, called blocks, into short lists: a term, and for
each of the block's documents that hold it the place in the block and what it
adds to a score for each unit of the term's weight, the most valuable first. The
lists of the queries' terms are written once, partitioned by term; a term of
over ``LIST`` postings is dealt over as many parts as it needs. Every query then
takes three rounds over all its lists:

1. Heads: the ``HEAD`` most valuable postings of each term. Documents' sums over
   them bound their scores from below; the ``PROBES`` best are scored exactly, and
   their k-th best score bounds that of the k-th best document.
2. A uniform threshold: the greatest t for which a document that gains at most t
   in every list, or a list's greatest value if that is less, stays under that
   bound times ``SLACK``. Each list is read down to the least t of its queries, and
   what was read is summed by block. A document that isn't read can't be among the
   k best; what one may still gain in unread lists bounds its score from above.
3. Lookups: documents whose upper bound reaches the k-th best lower bound get
   their exact score from all their postings.

Sums are whole numbers, so nothing that could tie is left out, and the result is
exact. Where fewer than k documents come out of the heads, the threshold is 0,
which reads the query's lists whole. ``HEAD``, ``PROBES`` and ``SLACK`` only say how much
is read in which round: a lower threshold reads more and leaves less to look up.

Terms are maximal runs of letters, digits and code points above 0x7F, with A-Z
lower-cased. What is broadcast is counted first: terms and pairs to look up are
broadcast below ``BROADCAST_BYTES`` and shuffled beyond that; queries with more
terms than that are taken in parts, one after the other.

Null and empty texts have no terms: such documents aren't counted in N and never
found, such queries have no rows. Repeated documents are found as often as they
stand there; equal query rows are one query, and rows of the same id but another
text are queries of their own. Equal scores are ordered by id, null ids last.
Texts of any length are read whole. Empty tables give no rows. Only the columns
named are read; others, whatever their names, don't come back.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql import types as T

from .common import column, settle, shared_folder

K = 10
HEAD = 100
PROBES = 100
SLACK = 0.5
LIST = 200_000
#: Code points of a block's texts.
CHUNK = 6_000_000
BROADCAST_BYTES = 32 << 20

_NOT_TERM = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWERED = str.maketrans(_UPPER, _LOWER)
#: From ``most``, the lists' greatest values in ascending order, and ``bound``: with the lists before a place at
#: their greatest and the others at t, the sum stays under the bound up to this t; the best place's t is taken.
_THRESHOLD = """aggregate(most, struct(0L as before, 0L as at, 0L as t),
  (a, x) -> struct(a.before + x as before, a.at + 1 as at, greatest(a.t, (cast(coalesce(bound, 0) * {slack} as bigint) - 1 - a.before) div (size(most) - a.at)) as t), a -> a.t)"""

_NOT_TERM = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWERED = str.maketrans(_UPPER, _LOWER)


def terms(text: Column) -> Column:
    """The terms of a text in order, with repeats; an empty array for null."""
    return F.coalesce(F.filter(F.split(F.translate(text, _UPPER, _LOWER), _NOT_TERM), lambda w: w != ""), F.array().cast("array<string>"))


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each block a row without term (its documents' ids, how many have terms, and all their terms), then a row for each term.

    at, tf and n are 4-byte numbers side by side: places in the block, occurrences, and the document's terms.
    """
    for batch in batches:
        texts, begin, size = batch.column("text"), 0, 0
        for i in range(len(texts)):
            size += len(texts[i].as_py() or "")
            if size >= CHUNK or i == len(texts) - 1:
                yield _block(batch.slice(begin, i + 1 - begin))
                begin, size = i + 1, 0


def _block(part: pa.RecordBatch) -> pa.RecordBatch:
    found = [_TERM.findall((t or "").translate(_LOWERED)) for t in part.column("text").to_pylist()]
    n = np.array([len(f) for f in found], np.int64)
    codes, names = pd.factorize(np.array([t for f in found for t in f], dtype=object)) if n.sum() else (np.zeros(0, np.int64), np.zeros(0, object))
    pairs, tf = np.unique(codes * len(found) + np.repeat(np.arange(len(found)), n), return_counts=True)
    code, at = pairs // len(found), pairs % len(found)
    cuts = np.searchsorted(code, np.arange(len(names) + 1))
    packed = [x.astype("<i4").tobytes() for x in (at, tf, n[at])]
    lists = [[None, *(b[4 * s : 4 * e] for s, e in zip(cuts[:-1], cuts[1:], strict=True))] for b in packed]
    rows = 1 + len(names)
    ids = pa.ListArray.from_arrays(pa.array([0] + [len(found)] * rows, pa.int32()), part.column("id"))
    counts = [pa.array([int(x)] + [None] * (rows - 1), pa.int64()) for x in ((n > 0).sum(), n.sum())]
    block = pa.array([part.column("rid")[0].as_py()] * rows, pa.int64())
    return pa.RecordBatch.from_arrays([block, pa.array([None, *names], pa.string()), *[pa.array(x, pa.binary()) for x in lists], ids, *counts], names=["block", "term", "at", "tf", "n", "ids", "docs", "words"])


def _valued(total: int, length: int):
    """The lists with c in place of tf and n, in order of falling c."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ats, cs = [], []
            for at, tf, n in zip(*(batch.column(x).to_pylist() for x in ("at", "tf", "n")), strict=True):
                at, tf, n = (np.frombuffer(x, "<i4") for x in (at, tf, n))
                m = 10 + 90 * n.astype(np.int64) * total // length
                c = 1_000_000_000 * tf.astype(np.int64) // (1000 * tf.astype(np.int64) + 8 * m)
                order = np.argsort(-c, kind="stable")
                ats.append(at[order].tobytes())
                cs.append(c[order].astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("tid"), batch.column("block"), batch.column("part"), pa.array(ats, pa.binary()), pa.array(cs, pa.binary())], names=["tid", "block", "part", "at", "c"])

    return run


def _heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """tid, block, at and c: the HEAD best postings of each term that a task reads; its lists come term by term."""
    tid, held = None, []

    def out() -> pa.RecordBatch:
        block, at, c = (np.concatenate(x) for x in zip(*held, strict=True))
        best = np.argsort(-c, kind="stable")[:HEAD]
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(best), tid)), pa.array(block[best]), pa.array(at[best]), pa.array(c[best])], names=["tid", "block", "at", "c"])

    for batch in batches:
        for t, b, at, c in zip(*(batch.column(x).to_pylist() for x in ("tid", "block", "at", "c")), strict=True):
            if t != tid and held:
                yield out()
                held = []
            at, c = np.frombuffer(at, "<i4")[:HEAD].astype(np.int64), np.frombuffer(c, "<i4")[:HEAD].astype(np.int64)
            tid = t
            held.append((np.full(len(at), b), at, c))
            if len(held) > 100:
                best = out()
                held = [tuple(best.column(x).to_numpy() for x in ("block", "at", "c"))]
    if held:
        yield out()


def _cut(low: dict[int, int]):
    """The lists down to each term's least threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for t, b, at, c in zip(*(batch.column(x).to_pylist() for x in ("tid", "block", "at", "c")), strict=True):
                end = int(np.searchsorted(-np.frombuffer(c, "<i4").astype(np.int64), -low[t], side="right")) if t in low else 0
                if end:
                    rows.append((t, b, at[: 4 * end], c[: 4 * end]))
            cols = list(zip(*rows, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(cols, (pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["tid", "block", "at", "c"])

    return run


_LISTS = "tid long, block long, at binary, c binary"
_PAIRS = "qid long, block long, at long, sum long"


def _lists_of(table: pa.Table) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """A block's lists by term."""
    return {t: (np.frombuffer(a, "<i4"), np.frombuffer(c, "<i4").astype(np.int64)) for t, a, c in zip(*(table.column(x).to_pylist() for x in ("tid", "at", "c")), strict=True)}


def _pairs(block: int, found: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.Table:
    q = np.concatenate([np.zeros(0, np.int64), *(np.full(len(at), q) for q, at, _ in found)])
    at, sums = (np.concatenate([np.zeros(0, np.int64), *(f[i] for f in found)]).astype(np.int64) for i in (1, 2))
    return pa.table({"qid": pa.array(q, pa.int64()), "block": pa.array(np.full(len(q), block), pa.int64()), "at": pa.array(at), "sum": pa.array(sums)})


def _bounded(queries: dict[int, tuple[int, int, list[tuple[int, int, int]]]]):
    """A block's documents whose upper bound reaches the query's bound, with their lower bound.

    queries: qid -> (bound, threshold, its terms' (tid, weight, greatest value)).
    """

    def run(lists: pa.Table) -> pa.Table:
        known, found = _lists_of(lists), []
        size = max((int(at.max()) + 1 for at, _ in known.values()), default=0)
        for q, (bound, bar, terms) in queries.items():
            low, unread, rest = np.zeros(size, np.int64), np.zeros(size, np.int64), 0
            for tid, w, most in terms:
                rest += min(bar, most)
                if tid in known:
                    at, c = known[tid]
                    end = np.searchsorted(-c, -(bar // w + 1), side="right")
                    low[at[:end]] += w * c[:end]
                    unread[at[:end]] -= min(bar, most)
            at = np.flatnonzero((low > 0) & (low + unread + rest >= bound))
            found.append((q, at, low[at]))
        return _pairs(lists.column("block")[0].as_py(), found)

    return run


def _scored(queries: dict[int, list[tuple[int, int]]]):
    """The whole scores of a block's pairs."""

    def run(lists: pa.Table, pairs: pa.Table) -> pa.Table:
        if not len(lists) or not len(pairs):
            return _pairs(0, [])
        known, found = _lists_of(lists), []
        frame = pairs.to_pandas()
        size = max(max(int(at.max()) + 1 for at, _ in known.values()), int(frame["at"].max()) + 1)
        for q, at in frame.groupby("qid")["at"]:
            sums = np.zeros(size, np.int64)
            for tid, w in queries[q]:
                if tid in known:
                    sums[known[tid][0]] += w * known[tid][1]
            found.append((q, at.to_numpy(), sums[at.to_numpy()]))
        return _pairs(lists.column("block")[0].as_py(), found)

    return run


def _small(df: DataFrame, bytes_of: str) -> DataFrame:
    """A hint to broadcast where the rows' bytes, counted, are few."""
    size = df.agg(F.coalesce(F.sum(F.expr(bytes_of)), F.lit(0))).first()[0]
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def _kept(df: DataFrame, folder: str) -> DataFrame:
    """The rows written to a table and read again."""
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


def postings(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(lists: tid, block, at and c, partitioned by term; tid and its weight w; block, at and id).

    wanted: settled term and tid. Lists of terms of weight 0 are left out.
    """
    base = f"{shared_folder(docs.sparkSession)}/postings-{uuid.uuid4().hex}"
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), column(id_col).alias("id"), column(text_col).cast("string").alias("text"))
    ids = T.StructField("ids", T.ArrayType(rows.schema["id"].dataType))
    kind = T.StructType([*T.StructType.fromDDL("block long, term string, at binary, tf binary, n binary"), ids, *T.StructType.fromDDL("docs long, words long")])
    known = rows.mapInArrow(_index, kind).join(_small(wanted, "octet_length(term) + 16"), "term", "left").where("docs is not null or tid is not null")
    raw = _kept(known.drop("term"), f"{base}-raw")
    total, length = raw.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))).first()
    weight = F.floor(1000 * F.log((2 * F.lit(total) + 2) / (2 * F.col("df") + 1)))
    weights = settle(raw.where("tid is not null").groupBy("tid").agg(F.expr("sum(octet_length(at) div 4)").alias("df")).withColumn("w", weight).where("w > 0"))
    parts = _small(weights.select("tid", F.ceil(F.col("df") / LIST).cast("int").alias("parts")), "16")
    dealt = raw.where("tid is not null").join(parts, "tid").select("tid", "block", F.pmod(F.xxhash64("block"), F.col("parts")).alias("part"), "at", "tf", "n")
    lists = dealt.mapInArrow(_valued(total, max(length, 1)), "tid long, block long, part long, at binary, c binary").repartition("tid", "part").sortWithinPartitions("tid", "block").drop("part")
    return _kept(lists, f"{base}-lists"), weights.select("tid", "w"), raw.where("docs is not null").select("block", F.posexplode_outer("ids").alias("at", "id"))


def search(docs: DataFrame, queries: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text", query_col: str = "item_id", query_text: str = "text") -> DataFrame:
    """query_col, rank, id_col and score: the k best documents of each query, of score above 0."""
    asked = settle(queries.select(column(query_col).alias("q"), column(query_text).cast("string").alias("text")).distinct().select(F.monotonically_increasing_id().alias("qid"), "q", F.array_distinct(terms(F.col("text"))).alias("t")))
    pairs = asked.select("qid", F.explode_outer("t").alias("term")).where("term is not null")
    wanted = settle(pairs.select("term").distinct().select("term", F.monotonically_increasing_id().alias("tid")))
    lists, weights, ids = postings(docs, wanted, id_col, text_col)
    needs = settle(pairs.join(wanted, "term").join(weights, "tid").select("qid", "tid", "w"))
    heads = lists.mapInArrow(_heads, "tid long, block long, at long, c long")
    order = W.partitionBy("tid").orderBy(F.desc("c"), "block", "at")
    heads = settle(heads.withColumn("place", F.row_number().over(order)).where(F.col("place") <= HEAD))
    needs = settle(needs.join(heads.where("place = 1").select("tid", F.col("c").alias("top")), "tid").select("qid", "tid", "w", F.expr("w * top").alias("most")))
    shares = max(1, -(-needs.count() * 40 // BROADCAST_BYTES))
    some = [needs.where(F.pmod(F.xxhash64("qid"), F.lit(shares)) == i) for i in range(shares)] if shares > 1 else [needs]
    exact = reduce(DataFrame.unionByName, [_rounds(lists, heads, n, k) for n in some])
    named = ids.join(_small(exact, "40"), ["block", "at"])
    best = W.partitionBy("qid").orderBy(F.desc("sum"), F.asc_nulls_last("id"), "block", "at")
    top = named.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return top.join(_small(asked.select("qid", "q"), "octet_length(cast(q as string)) + 24"), "qid").select(F.col("q").alias(query_col), F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), F.col("sum").alias("score"))


def _rounds(lists: DataFrame, heads: DataFrame, needs: DataFrame, k: int) -> DataFrame:
    """qid, block, at and sum: the k best of each query and whatever ties with them, settled."""
    own: dict[int, list[tuple[int, int]]] = {}
    for r in needs.collect():  # of counted size
        own.setdefault(r.qid, []).append((r.tid, r.w))
    scored = _scored(own)

    def exact(pairs: DataFrame) -> DataFrame:
        met = lists.join(_small(settle(pairs.select("block").distinct()), "16"), "block", "left_semi")
        return met.groupBy("block").cogroup(pairs.groupBy("block")).applyInArrow(scored, _PAIRS)

    lower = heads.join(_small(needs, "40"), "tid").groupBy("qid", "block", "at").agg(F.sum(F.expr("w * c")).alias("sum"))
    bounds = _kth(exact(settle(_best(lower, PROBES).select("qid", "block", "at"))), k)
    bars = needs.groupBy("qid").agg(F.array_sort(F.collect_list("most")).alias("most"), F.collect_list(F.struct("tid", "w", "most")).alias("terms")).join(bounds, "qid", "left")
    bars = bars.select("qid", "terms", F.coalesce("bound", F.lit(0)).alias("bound"), F.expr(_THRESHOLD.format(slack=SLACK)).alias("bar"))
    asked = {r.qid: (r.bound, r.bar, [(t.tid, t.w, t.most) for t in r.terms]) for r in bars.collect()}
    lows: dict[int, int] = {}
    for _, bar, terms_ in asked.values():
        for tid, w, _ in terms_:
            lows[tid] = min(lows.get(tid, 1 << 62), bar // w + 1)
    read = settle(lists.mapInArrow(_cut(lows), _LISTS).groupBy("block").applyInArrow(_bounded(asked), _PAIRS))
    done = settle(exact(read.select("qid", "block", "at")))
    return settle(done.join(_small(settle(_kth(done, k)), "24"), "qid", "left").where("sum > 0 and sum >= coalesce(bound, 0)").select("qid", "block", "at", "sum"))


def _best(sums: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("qid").orderBy(F.desc("sum"), "block", "at")
    return sums.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def _kth(sums: DataFrame, k: int) -> DataFrame:
    """qid and bound: the k-th best sum of each query that has so many."""
    return _best(sums, k).groupBy("qid").agg(F.count("*").alias("n"), F.min("sum").alias("bound")).where(F.col("n") >= k).select("qid", "bound")
