"""Removing long repeats by compaction of a De Bruijn graph of words.

Every run of ``K`` words is an edge between the two runs of K - 1 words at its
ends. A word is removed if it is covered by an edge's occurrence that is not the
edge's first; the first is that of the smallest id, then of the earliest start.

* Seeds. Only edges that may repeat become rows. Of the runs of ``SEED`` words in
  each edge the one of least hash is the edge's seed, so that equal edges have
  equal seeds. Seeds are counted over all texts; an edge whose seed stands in one
  place only can't repeat and goes no further.
* Edges. The others are grouped by 96 bits of hash, counted, and reduced to the
  place where they first occur: their source coordinate, one number made of the
  document's rank and the start. Both are partial sums, so a group of a
  million copies leaves each task as one row.
* Paths. Edges that follow one another in the source and occur equally often make
  a path without branches; a document is sent its paths, not its edges. `paths`
  goes on across sources: where exactly one path ends at a node and exactly one
  begins, a join on nodes links them, and doubling joins follow the links.
* Spans. What is covered by occurrences outside a document's own paths is sent to
  its text as spans of words, and removed.

Texts are joined with what is sent to them by id and a hash of the row; what is
sent is broadcast below ``BROADCAST_BYTES``, which are counted, and beyond that
both sides shuffle. There are 2^63 source coordinates: rows times the words of
the longest text may not pass that.

Null and empty texts have no words. Null ids come before all others; rows of the
same id are ordered by a hash of the row. Of equal rows one stands first and the
others after it, so they lose every word that an edge covers. Texts are read whole,
in time in proportion to their words. An empty table gives no rows. Columns named
like the new ones stay, and the new ones get an underscore behind their names.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql import types as T

from .common import column, free, settle

K = 20
SEED = 8
ROWS = 200_000
MAX_PARTS = 20_000
BROADCAST_BYTES = 32 << 20
#: Code points that a task works on at once.
CHUNK = 2_000_000

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of pairs of hashes; the order of a pair matters."""
    x = a * _A ^ (b << np.uint64(31) | b >> np.uint64(33)) * _B
    x ^= x >> np.uint64(29)
    x *= _C
    return x ^ x >> np.uint64(32)


def _runs(h: np.ndarray, k: int, made: dict[int, np.ndarray] | None = None) -> np.ndarray:
    """Hashes of all runs of k hashes, put together from runs of powers of two."""
    if made is None:
        made = {1: h}
    if k not in made:
        low = 1 << (k.bit_length() - 1)
        if low == k:
            half = _runs(h, k // 2, made)
            made[k] = _mix(half[: -(k // 2)], half[k // 2 :]) if len(half) > k // 2 else half[:0]
        else:
            a, b = _runs(h, low, made), _runs(h, k - low, made)
            made[k] = _mix(a[: max(len(h) - k + 1, 0)], b[low : low + max(len(h) - k + 1, 0)])
    return made[k]


def _least(x: np.ndarray, w: int, pick=np.minimum) -> np.ndarray:
    """The least of every w neighbours."""
    if len(x) < w:
        return x[:0]
    span, out = 1, x
    while span < w:
        step = min(span, w - span)
        out = pick(out[: len(out) - step], out[step:])
        span += step
    return out


class _Chunk:
    """The words of some texts one after the other, and the runs that stay inside a text."""

    def __init__(self, texts: list[str | None]):
        self.words = [_WORD.findall(t or "") for t in texts]
        self.sizes = np.array([len(w) for w in self.words], dtype=np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        codes, names = pd.factorize(np.array([w for ws in self.words for w in ws], dtype=object)) if self.sizes.sum() else (np.zeros(0, np.int64), np.zeros(0, object))
        hashed = lambda key: pd.util.hash_array(np.asarray(names, dtype=object), hash_key=key, categorize=False)[codes] if len(names) else np.zeros(0, np.uint64)
        self.a, self.b = hashed("first-word-hash-"), hashed("other-word-hash-")
        self.doc = np.repeat(np.arange(len(texts)), self.sizes)

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """(places of all edges, the seed of each)."""
        total = len(self.a)
        if total < K:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(self.doc[: total - K + 1] == self.doc[K - 1 :])
        return at, _least(_runs(self.a, SEED), K - SEED + 1)[at]

    def seeds(self) -> np.ndarray:
        """The places of the runs that are some edge's seed, each once."""
        at, least = self.edges()
        grams = _runs(self.a, SEED)
        if not len(at):
            return np.zeros(0, np.int64)
        w = K - SEED + 1
        known = np.zeros(len(grams) + w - 1, np.uint64)
        known[at + w - 1] = least
        return np.flatnonzero(_least(known, w, np.maximum)[: len(grams)] == grams)

    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        return _runs(self.a, K), _runs(self.b, K)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _chunks(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[tuple[pa.RecordBatch, _Chunk]]:
    for batch in batches:
        texts, begin, size = batch.column(text), 0, 0
        lengths = [len(t) if (t := texts[i].as_py()) else 0 for i in range(len(texts))]
        for i, n in enumerate(lengths):
            size += n
            if size >= CHUNK or i == len(lengths) - 1:
                part = batch.slice(begin, i + 1 - begin)
                yield part, _Chunk(part.column(text).to_pylist())
                begin, size = i + 1, 0


def _count_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, c in _chunks(batches, "text"):
        fp, n = np.unique(_runs(c.a, SEED)[c.seeds()], return_counts=True)
        yield pa.RecordBatch.from_arrays([_signed(fp), pa.array(n)], names=["fp", "n"])


def _own_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, rh and fp: each document's seeds, each once."""
    for part, c in _chunks(batches, "text"):
        at = c.seeds()
        doc, fp = c.doc[at], _runs(c.a, SEED)[at]
        order = np.lexsort((fp, doc))
        doc, fp = doc[order], fp[order]
        new = np.flatnonzero((doc[1:] != doc[:-1]) | (fp[1:] != fp[:-1])) + 1
        new = np.r_[0, new] if len(doc) else new
        rows = pa.array(doc[new].astype(np.int64))
        yield pa.RecordBatch.from_arrays([part.column("id").take(rows), part.column("rh").take(rows), _signed(fp[new])], names=["id", "rh", "fp"])


def _marked(part: pa.RecordBatch, c: _Chunk) -> np.ndarray:
    """The places of the edges whose seed repeats, by 32 bits of it; edges too many are found not to repeat."""
    at, least = c.edges()
    held = part.column("fps")
    known = np.unique(held.flatten().to_numpy(zero_copy_only=False)).astype(np.int32) if held.null_count < len(held) else np.zeros(0, np.int32)
    return at[np.isin(least.view(np.int64).astype(np.int32), known)]


def _windows(shift: int):
    """h1, h2, pos and n: the edges of a chunk whose seed repeats, with their first place and number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, c in _chunks(batches, "text"):
            at = _marked(part, c)
            h1, h2 = (h[at] for h in c.hashes()) if len(at) else (np.zeros(0, np.uint64),) * 2
            h2 = h2.view(np.int64).astype(np.int32)
            copies = part.column("c").to_numpy(zero_copy_only=False).astype(np.int64)
            doc = c.doc[at]
            pos = (part.column("ord").to_numpy(zero_copy_only=False).astype(np.int64)[doc] << shift) + at - c.begins[doc]
            order = np.lexsort((pos, h2, h1))
            h1, h2, pos, n = h1[order], h2[order], pos[order], copies[doc][order]
            new = np.flatnonzero(np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]) if len(h1) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([_signed(h1[new]), pa.array(h2[new]), pa.array(pos[new]), pa.array(np.add.reduceat(n, new) if len(new) else n)], names=["h1", "h2", "pos", "n"])

    return run


def _intervals(at: np.ndarray) -> list[dict[str, int]]:
    """Ascending places as runs (start and len)."""
    if not len(at):
        return []
    cut = np.flatnonzero(np.diff(at) > 1)
    first, last = at[np.r_[0, cut + 1]], at[np.r_[cut, len(at) - 1]]
    return [{"start": int(x), "len": int(y - x + 1)} for x, y in zip(first, last, strict=True)]


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("len", pa.int64())]))


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, rh, ord, c and runs: where the edges of each document start whose seed repeats."""
    for part, c in _chunks(batches, "text"):
        at = _marked(part, c)
        cuts = np.searchsorted(at, np.r_[c.begins, len(c.a)])
        runs = [_intervals(at[s:e] - b) for s, e, b in zip(cuts[:-1], cuts[1:], c.begins, strict=True)]
        yield pa.RecordBatch.from_arrays([*[part.column(n) for n in ("id", "rh", "ord", "c")], pa.array(runs, _RUNS)], names=["id", "rh", "ord", "c", "runs"])


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, rh, c and spans: the words covered by edges that stand outside the document's own paths."""
    each = lambda runs: np.concatenate([np.zeros(0, np.int64), *(np.arange(r["start"], r["start"] + r["len"]) for r in runs or ())])
    for part in batches:
        spans = []
        for runs, paths in zip(part.column("runs").to_pylist(), part.column("paths").to_pylist(), strict=True):
            again = np.setdiff1d(each(runs), each(paths), assume_unique=True)
            covered = [{"start": r["start"], "len": r["len"] + K - 1} for r in _intervals(again)]
            spans.append(covered)
        yield pa.RecordBatch.from_arrays([*[part.column(n) for n in ("id", "rh", "c")], pa.array(spans, _RUNS)], names=["id", "rh", "c", "spans"])


def _stripped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows with made: n_words, n_removed and kept (the words left, joined by spaces)."""
    for batch in batches:
        sizes, removed, kept = [], [], []
        for text, spans in zip(batch.column("text"), batch.column("spans"), strict=True):
            words = _WORD.findall(text.as_py() or "")
            sizes.append(len(words))
            left, at = [], 0
            for s in spans.as_py() or ():
                left += words[at : s["start"]]
                at = max(at, s["start"] + s["len"])
            left += words[at:]
            removed.append(len(words) - len(left))
            kept.append(" ".join(left))
        made = pa.StructArray.from_arrays([pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], names=["n_words", "n_removed", "kept"])
        names = [n for n in batch.schema.names if n != "spans"]
        yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], made], names=[*names, "made"])


def _small(df: DataFrame, bytes_of: str) -> DataFrame:
    """A hint to broadcast where the rows' bytes, counted, are few."""
    size = df.agg(F.coalesce(F.sum(F.expr(bytes_of)), F.lit(0))).first()[0]
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


_ID = "coalesce(octet_length(cast(id as string)), 0) + 32"


def _ranked(ids: DataFrame) -> DataFrame:
    """ids with ord, their place in order of id and rh: from each range partition's rows and the rows before it."""
    ids = settle(ids)
    parts = min(MAX_PARTS, max(1, math.ceil(ids.count() / ROWS)))
    placed = settle(ids.repartitionByRange(parts, "id", "rh").sortWithinPartitions("id", "rh").withColumn("mid", F.monotonically_increasing_id()).select("*", F.shiftright("mid", 33).alias("pid")))
    before, start = [], 0
    for r in placed.groupBy("pid").count().orderBy("pid").collect():
        before.append((r["pid"], start))
        start += r["count"]
    starts = F.broadcast(ids.sparkSession.createDataFrame(before, "pid long, start long"))
    return placed.join(starts, "pid").select("id", "rh", "c", "words", (F.col("start") + F.expr("mid & 8589934591L")).alias("ord"))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """docs with id, rh (a hash of the row) and text, its own columns as c0, c1 and so on."""
    hashed = [column(c) for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    return docs.select(column(id_col).alias("id"), F.xxhash64(*hashed).alias("rh"), column(text_col).cast("string").alias("text"), *[column(c).alias(f"c{i}") for i, c in enumerate(docs.columns) if c not in (id_col, text_col)])


def _graph(texts: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """(documents whose seeds repeat: id, rh, text, ord, c, fps; paths: ord, start, len, n; copies of a row beyond the first)."""
    own = texts.select("id", "rh", "text")
    id_kind = own.schema["id"]
    counted = F.expr("length(regexp_replace(text, '[^\\\\x20\\\\x09-\\\\x0D]+', 'w'))")
    ids = _ranked(own.groupBy("id", "rh").agg(F.count("*").alias("c"), F.max(F.coalesce(counted, F.lit(0))).alias("words")))
    ids = settle(ids)
    longest, rows, extra = ids.agg(F.max("words"), F.count("*"), F.sum(F.col("c") - 1)).first()
    shift = max(int(longest or 0), 1).bit_length()
    if shift + max(int(rows), 1).bit_length() > 63:
        raise ValueError("rows times words of the longest text pass 2^63")

    seeds = settle(own.select("text").mapInArrow(_count_seeds, "fp long, n long").groupBy("fp").agg(F.sum("n").alias("n")).where("n > 1").select("fp"))
    kind = T.StructType([id_kind, *T.StructType.fromDDL("rh long, fp long")])
    hits = own.mapInArrow(_own_seeds, kind).join(_small(seeds, "16"), "fp", "left_semi").groupBy("id", "rh").agg(F.collect_set(F.expr("cast((fp << 32) >> 32 as int)")).alias("fps"))
    same = F.expr("a.id <=> b.id and a.rh = b.rh")
    marked = settle(hits.alias("a").join(_small(ids, _ID).alias("b"), same).select("a.id", "a.rh", "b.ord", "b.c", "a.fps"))

    sent = _small(marked, _ID + " + 16 + 4 * size(fps)")
    # a row's copies are told apart later; here one stands for all
    met = own.alias("a").join(sent.alias("b"), same).select("a.id", "a.rh", "a.text", "b.ord", "b.c", "b.fps")
    edges = met.mapInArrow(_windows(shift), "h1 long, h2 int, pos long, n long").groupBy("h1", "h2").agg(F.min("pos").alias("pos"), F.sum("n").alias("n"))
    first = edges.select(F.shiftright("pos", shift).alias("ord"), F.expr(f"pos & {(1 << shift) - 1}L").alias("s"), "n")
    within = W.partitionBy("ord").orderBy("s")
    broken = (F.lag("s").over(within) + 1 == F.col("s")) & (F.lag("n").over(within) == F.col("n"))
    runs = first.withColumn("new", F.when(broken, 0).otherwise(1)).withColumn("run", F.sum("new").over(within))
    found = runs.groupBy("ord", "run").agg(F.min("s").alias("start"), F.count("*").alias("len"), F.first("n").alias("n")).drop("run")
    return met, found, int(extra or 0)


def strip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with n_words, n_removed and kept, the text without its repeats."""
    texts = _texts(docs, id_col, text_col)
    met, found, extra = _graph(texts)
    mine = found.groupBy("ord").agg(F.collect_list(F.struct("start", "len")).alias("paths"))
    run, id_kind = "array<struct<start: long, len: long>>", met.schema["id"]
    runs = met.mapInArrow(_candidates, T.StructType([id_kind, *T.StructType.fromDDL(f"rh long, ord long, c long, runs {run}")]))
    spans = runs.dropDuplicates(["ord"]).join(mine, "ord", "left").mapInArrow(_spans, T.StructType([id_kind, *T.StructType.fromDDL(f"rh long, c long, spans {run}")]))
    spans = settle(spans.where("size(spans) > 0 or c > 1"))
    sent = _small(spans, _ID + " + 24 + 32 * size(spans)")
    met = texts.alias("a").join(sent.alias("b"), F.expr("a.id <=> b.id and a.rh = b.rh"), "left").select("a.*", "b.c", "b.spans")
    kept_fields = [f for f in met.schema.fields if f.name != "spans"]
    done = met.mapInArrow(_stripped, T.StructType([*kept_fields, *T.StructType.fromDDL("made struct<n_words: long, n_removed: long, kept: string>")]))
    if extra:
        done = _copies(done)
    own = {id_col: "id", text_col: "text"}
    return done.select(*[F.col(own.get(c, f"c{i}")).alias(c) for i, c in enumerate(docs.columns)], *[F.col(f"made.{n}").alias(free(n, docs)) for n in ("n_words", "n_removed", "kept")])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each path of a document: id, ord, start, n, its words, and hashes of the nodes at its ends."""
    for part, c in _chunks(batches, "text"):
        nodes, rows = (_runs(x, K - 1) for x in (c.a, c.b)), []
        low, high = nodes
        for i, paths in enumerate(part.column("paths").to_pylist()):
            for p in paths:
                at, end = c.begins[i] + p["start"], c.begins[i] + p["start"] + p["len"]
                rows.append((i, p["start"], p["n"], c.words[i][p["start"] : p["start"] + p["len"] + K - 1], *(f"{low[x]:x}-{high[x]:x}" for x in (at, end))))
        doc, *cols = list(zip(*rows, strict=True)) or [()] * 6
        took = [part.column(x).take(pa.array(doc, pa.int64())) for x in ("id", "ord")]
        kinds = (pa.int64(), pa.int64(), pa.list_(pa.string()), pa.string(), pa.string())
        yield pa.RecordBatch.from_arrays([*took, *[pa.array(x, k) for x, k in zip(cols, kinds, strict=True)]], names=["id", "ord", "start", "n", "words", "begin", "end"])


def paths(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The compacted paths of repeated edges: words, and pieces (id, start, n: where each part first occurs, and how often)."""
    texts = _texts(docs.select(column(id_col), column(text_col)), id_col, text_col)
    met, found, _ = _graph(texts)
    mine = settle(found.where("n > 1").groupBy("ord").agg(F.collect_list(F.struct("start", "len", "n")).alias("paths")))
    met = met.join(_small(mine, "24 + 32 * size(paths)"), "ord").select("id", "text", "ord", "paths")
    kind = T.StructType([texts.schema["id"], *T.StructType.fromDDL("ord long, start long, n long, words array<string>, begin string, end string")])
    pieces = settle(met.mapInArrow(_pieces, kind).dropDuplicates(["ord", "start"]).withColumn("p", F.monotonically_increasing_id()))
    ends = pieces.select(F.col("end").alias("node"), F.col("p").alias("a"), F.lit(None).cast("long").alias("b"))
    both = ends.unionByName(pieces.select(F.col("begin").alias("node"), F.lit(None).cast("long").alias("a"), F.col("p").alias("b")))
    alone = both.groupBy("node").agg(F.count("a").alias("na"), F.count("b").alias("nb"), F.max("a").alias("a"), F.max("b").alias("b")).where("na = 1 and nb = 1 and a <> b")
    links = settle(alone.select("a", "b"))
    chains = _chains(pieces.select("p"), links)
    circles = chains.where("up is not null")
    if not circles.isEmpty():  # a circle is cut before its least path
        cut = circles.select(F.col("low").alias("b")).distinct()
        chains = _chains(pieces.select("p"), settle(links.join(cut, "b", "left_anti")))
    part = F.struct("far", "words", F.struct("id", "start", "n").alias("piece"))
    whole = pieces.join(chains, "p").groupBy("root").agg(F.array_sort(F.collect_list(part)).alias("x"))
    joined = F.flatten(F.transform("x", lambda x, i: F.when(i == 0, x["words"]).otherwise(F.slice(x["words"], F.lit(K), F.greatest(F.size(x["words"]) - K + 1, F.lit(0))))))
    return whole.select(joined.alias("words"), F.col("x.piece").alias("pieces"))


def _chains(paths: DataFrame, links: DataFrame) -> DataFrame:
    """For each path p of chains a -> b: root (the chain's first), far (links up to it), low (the least path met) and up (null at the root).

    Each round doubles how far a path looks back; in a circle up never ends.
    """
    state = paths.join(links.select(F.col("b").alias("p"), F.col("a").alias("up")), "p", "left")
    state = state.select("p", "up", F.coalesce("up", "p").alias("root"), F.when(F.col("up").isNull(), 0).otherwise(1).cast("long").alias("far"), F.least("p", F.coalesce("up", "p")).alias("low"))
    for _ in range(max(links.count(), 1).bit_length() + 1):
        state = settle(state)
        if state.where("up is not null").isEmpty():
            break
        back = state.select(F.col("p").alias("up"), F.col("up").alias("up2"), F.col("root").alias("root2"), F.col("far").alias("far2"), F.col("low").alias("low2"))
        met = state.join(back, "up", "left")
        state = met.select("p", F.col("up2").alias("up"), F.coalesce("root2", "root").alias("root"), (F.col("far") + F.coalesce("far2", F.lit(0))).alias("far"), F.least("low", "low2").alias("low"))
    return state


def _copies(done: DataFrame) -> DataFrame:
    """Of equal rows one keeps its first occurrences; every edge of the others stands earlier, in that one."""
    alone = done.where(F.coalesce(F.col("c"), F.lit(1)) == 1)
    one = done.where("c > 1").dropDuplicates(["id", "rh"])
    each = one.select("*", F.explode(F.expr("sequence(1L, c)")).alias("copy"))
    again = (F.col("copy") > 1) & (F.col("made.n_words") >= K)
    each = each.withColumn("made", F.when(again, F.struct("made.n_words", F.col("made.n_words").alias("n_removed"), F.lit("").alias("kept"))).otherwise(F.col("made")))
    return alone.unionByName(each.drop("copy"))
