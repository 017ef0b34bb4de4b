"""Similarity join of texts by a chosen-path scheme on word 5-grams.

A document is the set of its distinct runs of five lower-cased words (of all its
words, if fewer). Documents with one set, told apart by 128 bits of hash, form a
class; the join finds all pairs of different sets with a Jaccard similarity of
4/5 or more.

Candidates: each run puts every set into the bucket of one sampled token, its
least under a hash of the run's own; so two sets share a bucket with the
probability of their similarity. A bucket of more than ``SMALL`` sets is split
again by two further sampled tokens, and so on, unless its sets are alike
already (their tokens collide with a rate of ``ALIKE`` or more), since then
splitting multiplies rows without making buckets smaller. Runs are repeated
until a pair at the threshold is missed with at most 1 - ``RECALL`` in buckets
that aren't split; a split in two keeps it with a probability of 0.96. Missing a
pair gets less likely with its similarity. README has the recall measured.

Verification: a bucket is compared by brute force, in square tiles of at most
``TILE`` sets and about ``MASS`` tokens a side, each a task's worth of its own, so
no bucket meets in one task. Intersections are exact. A pair that meets in
several buckets is counted in the least of them. A tile gives out a spanning
forest of its links and each set's count of links, never the pairs. Components
of the forests are found by star contraction, as joins whose hot nodes are
salted.

Result: doc_id, class_id (the least doc_id of the component; nulls last) and
n_links, the number of other documents with similarity of 4/5 or more, copies
included. Null texts and texts without words link with nothing, and their class
is their own doc_id. Texts of any length are read whole; one text's set has to
fit a task. Rows are told apart by (doc_id, hash of the text), so repeated rows
count as copies of each other. Of further columns ``join`` gives none and
``keep_one`` all, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column, packed, settle, spread_join, unpacked

WORDS = 5
NUM, DEN = 4, 5
RECALL = 0.99999
SMALL = 128
TILE = 512
MASS = 1 << 20
ALIKE = 0.2
DEPTH = 6
POOL = 16
SLICE_CHARS = 4 << 20

_ODD = np.random.default_rng(5).integers(1 << 62, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def runs(recall: float = RECALL) -> int:
    return math.ceil(math.log(1 - recall) / math.log(1 - NUM / DEN) - 1e-9)


def _mix(v: np.ndarray, k: int) -> np.ndarray:
    v = v * _ODD[k]
    v ^= v >> np.uint64(31)
    v = v * _ODD[(k + 17) % 64]
    return v ^ (v >> np.uint64(29))


def shingles(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all texts' distinct shingles, sorted within a text, and where each text's begin."""
    lists = pc.utf8_split_whitespace(pc.utf8_lower(pa.array([t or "" for t in texts], pa.large_string())))
    coded = lists.flatten().dictionary_encode()
    vocabulary = coded.dictionary.to_pylist()
    if not vocabulary:
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    own = np.array([xxhash.xxh64_intdigest(w) for w in vocabulary], np.uint64)
    ids = np.asarray(coded.indices)
    doc = np.repeat(np.arange(len(texts)), np.diff(np.asarray(lists.offsets)))
    real = np.array([bool(w) for w in vocabulary])[ids]
    h, doc = own[ids[real]], doc[real]
    counts = np.bincount(doc, minlength=len(texts))
    starts = np.concatenate([[0], np.cumsum(counts)])
    n = len(h)
    long = np.arange(n) + WORDS <= starts[doc + 1] if n else np.zeros(0, bool)
    value = np.zeros(n, np.uint64)
    for j in range(WORDS):
        value[: max(n - j, 0)] += h[j:] * _ODD[j]
    flat, where = value[long], doc[long]
    few = np.nonzero((counts > 0) & (counts < WORDS))[0]
    if len(few):
        whole = np.array([(h[starts[d] : starts[d + 1]] * _ODD[: counts[d]]).sum(dtype=np.uint64) for d in few], np.uint64)
        flat, where = np.concatenate([flat, whole]), np.concatenate([where, few])
    flat = _mix(flat, 20)
    order = np.lexsort((flat, where))
    flat, where = flat[order], where[order]
    new = np.ones(len(flat), bool)
    new[1:] = (flat[1:] != flat[:-1]) | (where[1:] != where[:-1])
    flat, where = flat[new], where[new]
    return flat, np.searchsorted(where, np.arange(len(texts) + 1))


def _slices(texts: list[str | None]):
    at, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= SLICE_CHARS or i == len(texts) - 1:
            yield at, i + 1
            at, size = i + 1, 0


def _identity(flat: np.ndarray, starts: np.ndarray) -> list[bytes]:
    """16 bytes for each set, from order-free sums and its size."""
    n = np.diff(starts).astype(np.uint64)
    sums = [np.concatenate([[np.uint64(0)], np.cumsum(_mix(flat, k), dtype=np.uint64)]) for k in (21, 22, 25, 26)]
    a, b, c, d = ((s[starts[1:]] - s[starts[:-1]]) for s in sums)
    both = np.column_stack([_mix(a + _mix(b, 23) + n, 24), _mix(c + _mix(d, 27) + n, 28)])
    return [row.tobytes() for row in both]


def _sign(batches, n_signs: int):
    for batch in batches:
        texts, out = batch["text"].tolist(), []
        for a, b in _slices(texts):
            flat, starts = shingles(texts[a:b])
            n, full = np.diff(starts), np.diff(starts) > 0
            sig = np.zeros((b - a, n_signs), np.int64)
            if full.any():
                for k in range(n_signs):
                    sig[full, k] = np.minimum.reduceat(_mix(flat, 30 + k), starts[:-1][full]).view(np.int64)
            key = [k if f else None for k, f in zip(_identity(flat, starts), full)]
            out.append(pd.DataFrame({"key": pd.Series(key, dtype=object), "n": n.astype(np.int32), "sig": list(sig)}))
        rows = pd.concat(out, ignore_index=True) if out else pd.DataFrame({"key": pd.Series([], dtype=object), "n": [], "sig": []})
        yield pd.concat([batch[["doc_id", "th"]].reset_index(drop=True), rows], axis=1)


def _sets(batches):
    """key and shingles of the wanted documents."""
    for batch in batches:
        texts = batch["text"].tolist()
        for a, b in _slices(texts):
            flat, starts = shingles(texts[a:b])
            ids = _identity(flat, starts)
            yield pd.DataFrame({"key": ids, "set": [flat[s:e].view(np.int64) for s, e in zip(starts[:-1], starts[1:])]})


def shared(sets: list[np.ndarray]) -> np.ndarray:
    """How many members each two of the sets have in common."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    token = np.concatenate(sets)
    order = np.argsort(token, kind="stable")
    token, owner = token[order], owner[order]
    first = np.ones(len(token), bool)
    first[1:] = token[1:] != token[:-1]
    code = np.cumsum(first) - 1
    several = np.bincount(code)[code] > 1 if len(code) else np.zeros(0, bool)
    owner, code = owner[several], code[several]
    inter = np.zeros((n, n), np.float32)
    if len(code):
        code = np.cumsum(np.concatenate([[True], code[1:] != code[:-1]])) - 1
        width = 4096
        cuts = np.searchsorted(code, np.arange(0, code[-1] + 1 + width, width))
        for k in range(len(cuts) - 1):
            o, c = owner[cuts[k] : cuts[k + 1]], code[cuts[k] : cuts[k + 1]] - k * width
            if len(o):
                m = np.zeros((n, min(width, int(c.max()) + 1)), np.float32)
                m[o, c] = 1
                inter += m @ m.T
    return np.rint(inter).astype(np.int64)


def similar(sets: list[np.ndarray], left: np.ndarray | None = None) -> np.ndarray:
    """Which two sets have a similarity of NUM / DEN or more, as a symmetric matrix; with left, only between its True and False."""
    sizes, both = np.array([len(s) for s in sets], np.int64), shared(sets)
    ok = ((DEN + NUM) * both >= NUM * (sizes[:, None] + sizes[None, :])) & (both > 0)
    if left is not None:
        ok &= left[:, None] != left[None, :]
    np.fill_diagonal(ok, False)
    return ok


def _tile(rows: list[tuple]) -> list[tuple[int, int, int]]:
    """cid, least cid of its component in the tile, links counted here."""
    cids = np.array([r[1] for r in rows], np.int64)
    sides = np.array([r[2] for r in rows])
    ok = similar([r[4] for r in rows], None if sides[0] == 0 else sides == 1)
    if not ok.any():
        return []
    # a pair counts here if no lesser bucket has both
    earlier = [np.asarray(r[5], np.int64) for r in rows]
    counted = ok & (shared([b[b < rows[0][3]] for b in earlier]) == 0)
    links = counted @ np.array([r[6] for r in rows], np.int64)
    root = np.full(len(rows), -1)
    for k in np.argsort(cids, kind="stable"):
        if root[k] < 0:
            new = np.zeros(len(rows), bool)
            new[k] = True
            while new.any():
                root[new] = k
                new = ok[new].any(axis=0) & (root < 0)
    return [(int(cids[k]), int(cids[root[k]]), int(links[k])) for k in np.nonzero(ok.any(axis=0))[0]]


def _tiles(batches):
    """Rows come sorted by tile; a tile may go on into the next batch."""
    held: list[tuple] = []
    for batch in batches:
        out = []
        for row in zip(batch["tile"], batch["cid"], batch["side"], batch["bucket"], batch["set"], batch["buckets"], batch["copies"]):
            if held and held[-1][0] != row[0]:
                out += _tile(held)
                held = []
            held.append(row)
        if out:
            yield pd.DataFrame(out, columns=["cid", "root", "links"])
    if held and (out := _tile(held)):
        yield pd.DataFrame(out, columns=["cid", "root", "links"])


def _buckets(classes: DataFrame, n_runs: int) -> DataFrame:
    """bucket, size, mass (its sets' tokens) and cid: the buckets of two or more sets in which pairs are compared."""
    node = F.transform(F.sequence(F.lit(0), F.lit(n_runs - 1)), lambda r: F.xxhash64(r, F.get("sig", r)))
    rows, done = classes.select("cid", "n", F.explode(node).alias("bucket")), []
    for depth in range(DEPTH):
        # written first, so that a very large bucket is an input that adaptive execution can split
        sizes = settle(rows.groupBy("bucket").agg(F.count("*").alias("size"), F.sum("n").alias("mass")).where("size > 1"))
        sized = settle(rows.join(sizes, "bucket"))
        done.append(sized.where(F.col("size") <= SMALL))
        large = sized.where(F.col("size") > SMALL)
        if not large.limit(1).count():
            break
        if depth == DEPTH - 1:
            done.append(large)
            break
        one = F.pmod(F.xxhash64("bucket", F.lit(1)), F.lit(POOL))
        other = F.pmod(one + 1 + F.pmod(F.xxhash64("bucket", F.lit(2)), F.lit(POOL - 1)), F.lit(POOL))
        split = large.join(classes.select("cid", "sig"), "cid").select("bucket", "size", "cid", "n", F.explode(F.array(one, other)).alias("c"), "sig")
        split = settle(split.select("bucket", "size", "cid", "n", "c", F.xxhash64("bucket", "c", F.get("sig", (F.col("c") + n_runs).cast("int"))).alias("child")))
        rates = split.groupBy("bucket", "size", "child").agg(F.count("*").alias("m")).groupBy("bucket", "size").agg((F.sum(F.col("m") * F.col("m")) / 2 / F.col("size") / F.col("size")).alias("rate"))
        alike = settle(rates.where(F.col("rate") >= ALIKE).select("bucket"))
        done.append(large.join(alike, "bucket", "left_semi"))
        rows = split.join(alike, "bucket", "left_anti").select("cid", "n", F.col("child").alias("bucket"))
    out = done[0].select("bucket", "size", "mass", "cid")
    for d in done[1:]:
        out = out.unionByName(d.select("bucket", "size", "mass", "cid"))
    return out


def _tile_rows(buckets: DataFrame) -> DataFrame:
    """tile, bucket, cid and side; small buckets with the same members count once."""
    few = (F.col("size") <= SMALL) & (F.col("mass") <= MASS)
    small = buckets.where(few).groupBy("bucket").agg(F.array_sort(F.collect_set("cid")).alias("cids"))
    once = small.groupBy(F.xxhash64("cids").alias("h"), F.size("cids").alias("k")).agg(F.min(F.struct("bucket", "cids")).alias("b")).where("k > 1")
    one = once.select(F.col("b.bucket").alias("bucket"), F.explode("b.cids").alias("cid")).select(F.col("bucket").alias("tile"), "bucket", "cid", F.lit(0).alias("side"))
    # no aggregation stands here, so adaptive execution can split a very large bucket
    large = buckets.where(~few).withColumn("nb", F.ceil(F.greatest(F.col("size") / TILE, F.col("mass") / MASS)).cast("int"))
    large = large.withColumn("side", F.pmod(F.xxhash64("cid", "bucket"), F.col("nb")).cast("int"))
    spread = large.select("bucket", "cid", "side", F.explode(F.expr("sequence(0, nb - 1)")).alias("o"))
    # a tile of two blocks has sides 1 and 2, a tile of one block has side 0
    side = F.when(F.col("side") == F.col("o"), 0).when(F.col("side") < F.col("o"), 1).otherwise(2)
    many = spread.select(F.xxhash64("bucket", F.least("side", "o"), F.greatest("side", "o")).alias("tile"), "bucket", "cid", side.alias("side"))
    return one.unionByName(many)


def components(edges: DataFrame) -> DataFrame:
    """cid and root for every node of the edges (cid, root) that isn't a root itself, by star contraction."""
    e = settle(edges.where("cid <> root").select(F.col("cid").alias("u"), F.col("root").alias("v")).distinct())
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = settle(both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("c")).select("u", F.least("u", "m").alias("m"), "c"))
        e = settle(spread_join(both, least, "u", ["v"]).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        down = settle(e.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("c")))
        e = spread_join(e, down, "u", ["v"]).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = settle(e.unionByName(down.select("u", F.col("m").alias("v"))).distinct())
        # done when no node has two roots and no root has one
        per = e.groupBy("u").agg(F.count("*").alias("c"))
        ends = e.select(F.col("v").alias("u")).distinct()
        if not per.where("c > 1").limit(1).count() and not per.join(ends, "u", "left_semi").limit(1).count():
            return e.select(F.col("u").alias("cid"), F.col("v").alias("root"))


def _joined(docs: DataFrame, recall: float) -> DataFrame:
    """doc_id, th, n_links, and the class's least row as rep: struct(last, doc_id, th)."""
    n_runs = runs(recall)
    keyed = docs.select("doc_id", F.xxhash64("text").alias("th"), "text")
    key = T.StructField("key", T.BinaryType())
    schema = T.StructType([keyed.schema["doc_id"], T.StructField("th", T.LongType()), key, T.StructField("n", T.IntegerType()), T.StructField("sig", T.ArrayType(T.LongType()))])
    signed = settle(keyed.mapInPandas(lambda batches: _sign(batches, n_runs + POOL), schema))
    row = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "th")
    classes = signed.where("key is not null").groupBy("key").agg(F.min(row).alias("rep"), F.count("*").alias("copies"), F.min("n").alias("n"), F.min("sig").alias("sig"))
    # written at once, so these numbers never change
    classes = settle(classes.withColumn("cid", F.monotonically_increasing_id()))

    tiles = settle(_tile_rows(_buckets(classes, n_runs)))
    own = tiles.select("cid", "bucket").distinct().groupBy("cid").agg(F.collect_list("bucket").alias("buckets"))
    wanted = settle(own.join(classes.select("cid", "key", "rep", "copies"), "cid"))
    reps = wanted.select(F.col("rep.doc_id").alias("doc_id"), F.col("rep.th").alias("th")).distinct()
    texts = keyed.alias("a").join(reps.alias("b"), F.expr("a.doc_id <=> b.doc_id and a.th <=> b.th"), "left_semi").select("a.text")
    sets = texts.mapInPandas(_sets, T.StructType([key, T.StructField("set", T.ArrayType(T.LongType()))])).dropDuplicates(["key"])
    # joined by key, by which the sets, the largest rows of all, are dealt already
    full = sets.join(tiles.join(wanted, "cid"), "key").select("tile", "cid", "side", "bucket", "set", "buckets", "copies")
    out = T.StructType([T.StructField("cid", T.LongType()), T.StructField("root", T.LongType()), T.StructField("links", T.LongType())])
    found = settle(full.repartition("tile").sortWithinPartitions("tile").mapInPandas(_tiles, out))

    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    roots = components(found)
    grouped = settle(classes.select("cid", "key", "rep", "copies").join(roots, "cid", "left").withColumn("root", F.coalesce("root", "cid")))
    least = settle(grouped.groupBy("root").agg(F.min("rep").alias("first"), F.count("*").alias("c")))
    known = spread_join(grouped, least, "root", ["cid"]).join(links, "cid", "left")
    known = settle(known.select("key", "first", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.col("copies").alias("c")))
    got = spread_join(signed.select("doc_id", "th", "key"), known, "key", ["doc_id", "th"], "left")
    return got.select("doc_id", "th", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("first", row).alias("rep"))


def join(docs: DataFrame, recall: float = RECALL) -> DataFrame:
    """doc_id, class_id and n_links, a row for each document."""
    return _joined(docs, recall).select("doc_id", F.col("rep.doc_id").alias("class_id"), "n_links")


def keep_one(docs: DataFrame, recall: float = RECALL) -> DataFrame:
    """One document of each component, with its columns: the one of the least doc_id, then text hash, then hash of all its columns."""
    got = _joined(docs, recall).where("doc_id <=> rep.doc_id and th <=> rep.th").select("doc_id", "th").distinct()
    tie = F.xxhash64(*[column(c) for c, kind in docs.dtypes if "map<" not in kind])
    rows = docs.select(packed(docs).alias("row"), column("doc_id").alias("id"), F.xxhash64("text").alias("h"), tie.alias("tie"))
    kept = rows.join(got, F.expr("id <=> doc_id and h <=> th"), "left_semi").groupBy("id", "h").agg(F.min_by("row", "tie").alias("row"))
    return kept.select(*unpacked(kept))
