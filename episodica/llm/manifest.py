"""A Merkle manifest of a table: a digest for every row, group and table, and a proof for every row.

A row's leaf is the SHA-256 of its fields, each written as byte count, ``:`` and
value, or ``-`` where null, so that no two rows of different fields look alike.
The leaves of a group ascend by the row's id; while a group has several nodes,
every ``FAN`` consecutive ones become the SHA-256 of their digests, and what is
left is the group's subroot. Subroots, ordered by group, make the root likewise.
A row's proof is what stands left and right of its node in each run, from the
leaf to the root; `fold` gives the root back from a leaf and its proof.

Leaves are made where the texts are, and only they move: they are sorted over
range partitions of about ``ROWS`` leaves, whatever their groups. Rows of each
group are counted by partition; running sums of the counts say where in its group
each partition begins. A partition then builds all subtrees that are complete
and aligned inside it, in one pass that holds no more than a run a level, and
gives away the ragged nodes left at its two edges, 2 * (FAN - 1) a level at most.
These few are shuffled by coordinate (group, level, place), level by level, until
only subroots are left; proofs go back down the same way and meet their
partition's leaves by partition number. A group may hold all rows, or one.

Null groups are a group of their own, before all others; groups are ordered by
their bytes. Null ids stand before all others, and rows of the same id are
ordered by leaf. Repeated rows are leaves side by side, each with a proof of its
own. Texts of any length are read once. An empty table has no leaves and gives no
rows. The columns that come back are the new ones and those that the caller asks
to carry; of names that clash, the new one gets an underscore behind it.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql import types as T

from .common import column, free, settle

FAN = 8
ROWS = 100_000
#: Partitions of the sorted leaves at most: two numbers for each are sent to all tasks.
MAX_PARTS = 20_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_RAGGED = "pid long, g string, start long, total long, level int, idx long, h string"


def leaf(fields: Sequence[Column]) -> Column:
    """The digest of a row's fields."""
    said = [F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in fields]
    return F.sha2(F.concat(*said), 256)


def fold(start: Column, lefts: Column, rights: Column) -> Column:
    """The root that a leaf and its proof give."""
    sides = F.zip_with(lefts, rights, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    return F.aggregate(sides, start, lambda h, x: F.sha2(F.concat(x["a"], h, x["b"]), 256))


def proof_digest(lefts: Column, rights: Column) -> Column:
    """The digest of all siblings of a proof, level by level, from left to right."""
    return F.sha2(F.array_join(F.zip_with(lefts, rights, lambda a, b: F.concat(a, b)), ""), 256)


def _hash(digests: Sequence[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def _sizes(total: int) -> list[int]:
    """The number of nodes on each level of a group of so many leaves."""
    out = [total]
    while out[-1] > 1:
        out.append(-(-out[-1] // FAN))
    return out


class _Subtrees:
    """Complete aligned subtrees over a group's leaves from place ``start`` on, added one by one.

    ``give(level, idx, h)`` is called for each node whose parent can't be made here.
    With ``keep``, all nodes stay in ``levels``: for each level its first place and digests.
    """

    def __init__(self, start: int, total: int, give, keep: bool = False):
        self.next, self.sizes, self.give = start, _sizes(total), give
        self.runs: list[list[str]] = [[] for _ in self.sizes]
        self.begun = [0] * len(self.sizes)
        self.levels: list[tuple[int, list[str]]] | None = [(0, []) for _ in self.sizes] if keep else None

    def add(self, h: str) -> None:
        level, idx = 0, self.next
        self.next += 1
        while True:
            if self.levels is not None:
                first, held = self.levels[level]
                self.levels[level] = (idx if not held else first, held)
                held.append(h)
            if self.sizes[level] == 1:
                return self.give(level, idx, h)
            run = self.runs[level]
            if not run:
                self.begun[level] = idx
            run.append(h)
            if idx % FAN != FAN - 1 and idx != self.sizes[level] - 1:
                return None
            self.runs[level] = []
            if self.begun[level] % FAN:
                return self._leave(level, run)
            level, idx, h = level + 1, idx // FAN, _hash(run)

    def _leave(self, level: int, run: list[str]) -> None:
        for k, h in enumerate(run):
            self.give(level, self.begun[level] + k, h)

    def end(self) -> None:
        for level, run in enumerate(self.runs):
            self._leave(level, run)
            self.runs[level] = []


def _sorted(leaves: DataFrame) -> DataFrame:
    """The leaves with pid (their partition) and at (their place in it), sorted by g, o and h over range partitions."""
    parts = min(MAX_PARTS, max(1, math.ceil(leaves.count() / ROWS)))
    by = ["g", "o", "h", "tie"]
    ranged = leaves.repartitionByRange(parts, *by).sortWithinPartitions(*by).withColumn("mid", F.monotonically_increasing_id())
    return settle(ranged.select("g", "h", "carried", F.shiftright("mid", 33).alias("pid"), F.expr("mid & 8589934591L").alias("at")))


def _edges(placed: DataFrame) -> dict[int, tuple[int, int, int]]:
    """For each partition: where its first group begins in the group, and the sizes of its first and last groups."""
    counts = placed.groupBy("pid", "g").agg(F.count("*").alias("n"), F.min("at").alias("at"))
    group = W.partitionBy("g")
    before = group.orderBy("pid").rowsBetween(W.unboundedPreceding, -1)
    spans = counts.select("pid", "at", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"), F.sum("n").over(group).alias("total"))
    ends = spans.groupBy("pid").agg(F.min_by("start", "at").alias("start"), F.min_by("total", "at").alias("first"), F.max_by("total", "at").alias("last"))
    return {r.pid: (r.start, r.first, r.last) for r in ends.collect()}


def _ragged(placed: DataFrame) -> DataFrame:
    """The nodes whose parents no single partition can make, and the subroots that one can."""
    edges = placed.sparkSession.sparkContext.broadcast(_edges(placed))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        tree, g, held, pid = None, None, [], None

        def close(last: bool) -> None:
            """Build the group's leaves, held back until its size is known: it ends here or is the partition's last."""
            nonlocal tree, held
            if tree is None:
                start, total = 0, edges.value[pid][2] if last else len(held)
                tree = _open(start, total)
            for h in held:
                tree.add(h)
            tree.end()
            tree, held = None, []

        def _open(start: int, total: int) -> _Subtrees:
            name = g
            return _Subtrees(start, total, lambda level, idx, h: rows.append((pid, name, start, total, level, idx, h)))

        def out() -> pa.RecordBatch:
            cols = list(zip(*rows, strict=True)) or [()] * 7
            rows.clear()
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=[f.split()[0] for f in _RAGGED.split(", ")])

        for batch in batches:
            for p, name, h in zip(batch.column("pid").to_pylist(), batch.column("g").to_pylist(), batch.column("h").to_pylist(), strict=True):
                if pid is None:
                    pid, g = p, name
                    tree = _open(*edges.value[p][:2])
                elif name != g:
                    close(False)
                    g = name
                if tree is not None:
                    tree.add(h)
                else:
                    held.append(h)
            if rows:
                yield out()
        if pid is not None:
            close(True)
            yield out()

    return settle(placed.select("pid", "g", "h").mapInArrow(build, _RAGGED))


def _upper(ragged: DataFrame, grouped: bool) -> DataFrame:
    """The ragged nodes with the proof from there up (lefts, rights), their group's subroot and the root.

    With ``grouped``, proofs go on through the table's own tree over subroots; else a group's subroot is the root.
    """
    height = len(_sizes(ragged.agg(F.max("total")).first()[0] or 1)) - 1
    level = lambda k: ragged.where(F.col("level") == k).select("g", "total", "idx", "h")
    alone = lambda k: F.col("total") <= FAN**k
    nodes, runs, subroots = level(0), [], None
    for k in range(height + 1):
        found = nodes.where(alone(k)).select("g", "total", F.col("h").alias("subroot"))
        subroots = found if subroots is None else subroots.unionByName(found)
        if k < height:
            up = nodes.where(~alone(k)).groupBy("g", "total", F.expr(f"idx div {FAN}").alias("up")).agg(F.array_sort(F.collect_list(F.struct("idx", "h"))).alias("run"))
            runs.append(settle(up.withColumn("h", F.sha2(F.array_join(F.col("run.h"), ""), 256))))
            nodes = runs[k].select("g", "total", F.col("up").alias("idx"), "h").unionByName(level(k + 1))
    subroots = settle(subroots)
    known = _over_subroots(subroots) if grouped else subroots.select("g", "total", "subroot", F.col("subroot").alias("root"), *[F.array().cast("array<string>").alias(n) for n in ("lefts", "rights")])
    known = settle(known)
    # a node's proof: its run's others, then its parent's proof; a subroot's is its group's
    paths = met = None
    for k in range(height, -1, -1):
        here = known.where(alone(k) & (F.col("total") > (FAN ** (k - 1) if k else 0))).select("g", F.lit(0).cast("long").alias("idx"), "lefts", "rights")
        if k < height:
            spread = runs[k].select("g", "up", "run", F.explode("run.idx").alias("idx"))
            side = lambda sign: F.expr(f"array_join(transform(filter(run, x -> x.idx {sign} idx), x -> x.h), '')")
            down = spread.select("g", "up", "idx", side("<").alias("l"), side(">").alias("r")).join(paths.withColumnRenamed("idx", "up"), ["g", "up"])
            here = here.unionByName(down.select("g", "idx", F.concat(F.array("l"), "lefts").alias("lefts"), F.concat(F.array("r"), "rights").alias("rights")))
        paths = settle(here)
        here = ragged.where(F.col("level") == k).join(paths, ["g", "idx"])
        met = here if met is None else met.unionByName(here)
    return met.join(known.select("g", "subroot", "root"), "g").select("pid", "g", "start", "total", "level", "idx", "lefts", "rights", "subroot", "root")


def _over_subroots(subroots: DataFrame) -> DataFrame:
    """subroots with root and the proof of each in the table's own tree, which is ordered by group."""
    carried = F.struct("g", "total", "subroot").alias("carried")
    got = _prove(subroots.select(F.lit("").alias("g"), F.struct("g").alias("o"), F.col("subroot").alias("h"), F.lit(0).cast("long").alias("tie"), carried), False)
    return got.select("carried.*", "root", "lefts", "rights")


def _prove(leaves: DataFrame, grouped: bool) -> DataFrame:
    """carried, h, lefts, rights, subroot and root for each settled leaf (g: group, o: order, h: digest, tie, carried)."""
    placed = _sorted(leaves)
    tops = settle(_upper(_ragged(placed), grouped))
    kind = T.StructType([placed.schema["carried"], *T.StructType.fromDDL("h string, lefts array<string>, rights array<string>, subroot string, root string")])

    def join(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        """The proofs of one partition's leaves: siblings out of its own subtrees, then the proof of the ragged node above."""
        mine, known = mine.sort_by("at"), {}
        for r in theirs.to_pylist():
            known.setdefault(r["g"], []).append(r)
        groups, hs = mine.column("g").to_pylist(), mine.column("h").to_pylist()
        lefts, rights, subroots, at = [], [], [], 0
        while at < len(hs):
            rows, end = known[groups[at]], at
            tree = _Subtrees(rows[0]["start"], rows[0]["total"], lambda *_: None, keep=True)
            while end < len(hs) and groups[end] == groups[at]:
                tree.add(hs[end])
                end += 1
            proofs = _Proofs(tree.levels, {(r["level"], r["idx"]): (r["lefts"], r["rights"]) for r in rows})
            for k in range(end - at):
                ls, rs = proofs.of(0, rows[0]["start"] + k)
                lefts.append(ls)
                rights.append(rs)
            subroots += [rows[0]["subroot"]] * (end - at)
            at = end
        texts, root = pa.list_(pa.string()), theirs.column("root")[0].as_py()
        made = {"lefts": pa.array(lefts, texts), "rights": pa.array(rights, texts), "subroot": pa.array(subroots, pa.string()), "root": pa.array([root] * len(hs), pa.string())}
        return pa.table({"carried": mine.column("carried"), "h": mine.column("h"), **made})

    return placed.groupBy("pid").cogroup(tops.groupBy("pid")).applyInArrow(join, kind)


class _Proofs:
    """Proofs of the nodes in kept levels; those of the nodes in ``known`` are given."""

    def __init__(self, levels: list[tuple[int, list[str]]], known: dict[tuple[int, int], tuple[list[str], list[str]]]):
        self.levels, self.known = levels, known

    def of(self, level: int, idx: int) -> tuple[list[str], list[str]]:
        if (level, idx) in self.known:
            return self.known[level, idx]
        first, held = self.levels[level]
        place = idx % FAN
        run = held[idx - place - first : idx - place - first + FAN]
        ls, rs = self.of(level + 1, idx // FAN)
        got = (["".join(run[:place]), *ls], ["".join(run[place + 1 :]), *rs])
        if level:
            self.known[level, idx] = got
        return got


def prove(docs: DataFrame, group_col: str = "lang", id_col: str = "doc_id", fields: Sequence[str] = FIELDS, carry: Mapping[str, Column] | None = None) -> DataFrame:
    """group_col, id_col, leaf, subroot, root, lefts, rights and the carried columns, a row for each row of docs.

    ``carry``: further columns by name, expressions over docs.
    """
    carry = carry or {}
    g = F.coalesce(F.concat(F.lit("="), column(group_col).cast("string")), F.lit(""))
    carried = F.struct(column(group_col).alias("k0"), column(id_col).alias("k1"), *[c.alias(f"c{i}") for i, c in enumerate(carry.values())])
    leaves = settle(docs.select(g.alias("g"), F.struct(column(id_col)).alias("o"), leaf([column(f) for f in fields]).alias("h"), F.monotonically_increasing_id().alias("tie"), carried.alias("carried")))
    got = _prove(leaves, True)
    kept = got.select(F.col("carried.k0").alias(group_col), F.col("carried.k1").alias(id_col), *[F.col(f"carried.c{i}").alias(n) for i, n in enumerate(carry)], F.struct("h", "subroot", "root", "lefts", "rights").alias("__made"))
    return kept.select(*[column(c) for c in kept.columns[:-1]], *[F.col(f"__made.{f}").alias(free(n, kept)) for f, n in (("h", "leaf"), ("subroot", "subroot"), ("root", "root"), ("lefts", "lefts"), ("rights", "rights"))])
