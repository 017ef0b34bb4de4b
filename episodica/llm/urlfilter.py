"""URL rules by Bloom filter cascades: exact membership without joins.

A rule is a host and a path prefix; it fits its host and all subdomains, where
the url's path starts with the rule's, and the longest rule wins. A url's keys
are its host's suffixes at label borders, each with the path's prefixes of the
lengths and up to as many labels as rules have (no other key can match a rule). A key is known by two
64-bit hashes.

The universe is every distinct key of the corpus. Level 0 of a cascade holds the
listed keys; level 1 holds the universe's keys that level 0 takes wrongly;
level 2 those listed keys that level 1 takes wrongly, and so on until none is
left. A key of the universe is listed if the first level that doesn't take it is
odd. One cascade has the block rules, one the allow rules.

A level's bits are gathered by aggregation into packed pieces of ``PIECE`` bits;
only these pieces come to the driver, never keys, and go to the executors as a
broadcast of at most ``MAX_BITS`` bits a level. A longer list is dealt by hash
into as many shards as it takes: each shard has cascades of its own, the rows
pass through them shard after shard, and the longest rule of all shards wins, so
there is no size beyond which a url isn't judged.

Null urls, and urls without ``://``, have an empty host and path and no rule.
Urls without a rule get the default verdict, allow. A key that is listed with
several verdicts has the first in order of the alphabet. Urls of any length are
read whole; repeated rows are judged row by row; an empty table gives no rows.
Columns of the input are kept; where one is called host, path, rule or verdict,
the new one gets an underscore behind its name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column, free, packed, settle, unpacked

MAX_BITS = 1 << 28
MAX_LEVELS = 64
PIECE = 1 << 16
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def key(self) -> str:
        return self.host + self.path


#: The rules of the registered query.
RULES = (Rule("net", "/", "block"), Rule("example.net", "/en/", "allow"), Rule("example.com", "/de/", "block"), Rule("org", "/fr/", "allow"))


@dataclass(frozen=True)
class Level:
    bits: int
    hashes: int
    seed: int
    data: np.ndarray

    def takes(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.ones(len(a), bool)
        for at in positions(a, b, self.bits, self.hashes, self.seed):
            out &= (self.data[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1
        return out


class TooLarge(Exception):
    """A level needs more than MAX_BITS bits."""


def host(url: Column) -> Column:
    at = F.instr(url, "://")
    rest = F.substring(url, at + 3, F.char_length(url))
    found = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(F.when(at > 0, found), F.lit(""))


def path(url: Column) -> Column:
    at = F.instr(url, "://")
    rest = F.substring(url, at + 3, F.char_length(url))
    return F.coalesce(F.when(at > 0, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)), F.lit(""))


def keys(host_col: str, path_col: str, lengths: list[int], most: int) -> Column:
    """All keys of a url, longest first; of hosts the suffixes of up to so many labels, whatever the host's length."""
    labels = F.split(F.substring_index(F.col(host_col), ".", -most), r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fit = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: F.char_length(F.col(path_col)) >= n)
    all_keys = F.flatten(F.transform(suffixes, lambda s: F.transform(fit, lambda n: F.concat(s, F.substring(F.col(path_col), F.lit(1), n)))))
    sized = F.transform(F.array_distinct(all_keys), lambda k: F.struct((-F.char_length(k)).alias("n"), k.alias("k")))
    return F.transform(F.array_sort(sized), lambda x: x["k"])


def positions(a: np.ndarray, b: np.ndarray, bits: int, hashes: int, seed: int) -> Iterator[np.ndarray]:
    """The bits of keys with the hashes a and b, hash by hash."""
    a = (a ^ (np.uint64(seed + 1) * _ODD[0])) * _ODD[1]
    a, b = a ^ (a >> np.uint64(32)), b | np.uint64(1)
    for j in range(hashes):
        v = a + np.uint64(j) * b
        v = (v ^ (v >> np.uint64(29))) * _ODD[0]
        yield (v ^ (v >> np.uint64(32))) % np.uint64(bits)


def listed(levels: list[Level], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether keys of the universe are listed: the first level that doesn't take one is odd, or all take it and the last is even."""
    out, open_ = np.full(len(a), len(levels) % 2 == 1), np.ones(len(a), bool)
    for i, level in enumerate(levels):
        at = np.nonzero(open_)[0]
        wrong = at[~level.takes(a[at], b[at])]
        out[wrong], open_[wrong] = i % 2 == 1, False
    return out


def _hashed(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("a"), F.xxhash64(F.lit(1), key).alias("b")]


def _level(keys_df: DataFrame, n: int, rate: float, seed: int) -> Level:
    """The Bloom filter of n keys (columns a and b)."""
    bits = max(64, math.ceil(-n * math.log(rate) / math.log(2) ** 2))
    bits = (bits + 63) // 64 * 64
    if bits > MAX_BITS:
        raise TooLarge
    hashes = min(16, max(1, round(bits / n * math.log(2))))

    def words(batches):
        for batch in batches:
            a, b = (batch[c].to_numpy().view(np.uint64) for c in ("a", "b"))
            at = np.unique(np.concatenate(list(positions(a, b, bits, hashes, seed)) or [np.zeros(0, np.uint64)]))
            word, first = np.unique(at >> np.uint64(5), return_index=True)
            if len(word):
                yield pd.DataFrame({"w": word.astype(np.int64), "v": np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(31)), first).astype(np.int64)})

    def pack(piece: pd.DataFrame) -> pd.DataFrame:
        k = int(piece["w"].iloc[0]) * 32 // PIECE
        data = np.zeros(PIECE // 32, np.uint32)
        data[piece["w"].to_numpy() - k * PIECE // 32] = piece["v"].to_numpy().astype(np.uint32)
        return pd.DataFrame({"k": [k], "data": [data.tobytes()]})

    rows = keys_df.select("a", "b").mapInPandas(words, "w long, v long").groupBy("w").agg(F.bit_or("v").alias("v"))
    data = np.zeros((bits + PIECE - 1) // PIECE * PIECE // 8, np.uint8)
    for k, piece in rows.groupBy((F.col("w") * 32 / PIECE).cast("long").alias("k")).applyInPandas(pack, "k long, data binary").collect():
        data[k * PIECE // 8 : (k + 1) * PIECE // 8] = np.frombuffer(piece, np.uint8)
    return Level(bits, hashes, seed, data)


def _where_taken(keys_df: DataFrame, level: Level) -> DataFrame:
    shared = keys_df.sparkSession.sparkContext.broadcast(level)

    def run(batches):
        for batch in batches:
            a, b = (batch[c].to_numpy().view(np.uint64) for c in ("a", "b"))
            yield batch[shared.value.takes(a, b)]

    return keys_df.mapInPandas(run, "a long, b long")


def cascade(universe: DataFrame, listing: DataFrame, first_rate: float | None = None, later_rate: float = 0.5) -> list[Level]:
    """Levels for the listed keys against all other keys of the universe (both: columns a and b, distinct)."""
    listing = settle(listing)
    n = listing.count()
    if not n:
        return []
    # only keys that the first level takes are ever compared with the listed ones
    rate = first_rate or min(0.5, max(1e-4, n / max(1, universe.count()) / math.sqrt(2)))
    levels = [_level(listing, n, rate, 0)]
    inside, outside = listing, _where_taken(universe, levels[0]).join(listing, ["a", "b"], "left_anti")
    for i in range(1, MAX_LEVELS):
        wrong = settle(outside)
        left = wrong.count()
        if not left:
            return levels
        levels.append(_level(wrong, left, later_rate, i))
        inside, outside = wrong, _where_taken(inside, levels[-1])
    raise ValueError("the cascade has not ended")


def _cascades(universe: DataFrame, rules: DataFrame, verdicts: list[str], first_rate: float | None) -> Iterator[dict[str, list[Level]]]:
    """The cascades of each shard, one shard at a time; from the first again, should a later one turn out too large."""
    shards, done = 1, 0
    while done < shards:
        own = F.pmod(F.shiftrightunsigned("b", 7), F.lit(shards)) == done
        try:
            found = {v: cascade(universe.where(own), rules.where(F.col("verdict") == v).where(own).select("a", "b").distinct(), first_rate) for v in verdicts}
        except TooLarge:
            shards, done = shards * 2, 0
            continue
        yield {"cascades": found, "shards": shards, "shard": done}
        done += 1


def judge(df: DataFrame, rules: tuple[Rule, ...] | DataFrame = RULES, url_col: str = "url", default: str = "allow", first_rate: float | None = None) -> DataFrame:
    """Adds host, path, rule and verdict; rules may be a DataFrame of host, path and verdict."""
    spark: SparkSession = df.sparkSession
    table = rules if isinstance(rules, DataFrame) else spark.createDataFrame([(r.host, r.path, r.verdict) for r in rules], "host string, path string, verdict string")
    labels = F.size(F.split("host", r"\.")).alias("labels")
    table = settle(table.select("path", "verdict", labels, *_hashed(F.concat("host", "path"))))
    lengths = sorted(r[0] for r in table.select(F.char_length("path")).distinct().collect())
    verdicts = sorted(r[0] for r in table.select("verdict").distinct().collect())
    rows = df.select(packed(df).alias("row"), host(column(url_col)).alias("host"), path(column(url_col)).alias("path"))
    most = table.agg(F.coalesce(F.max("labels"), F.lit(1))).first()[0]
    rows = rows.withColumn("keys", keys("host", "path", lengths, most))
    universe = settle(rows.select(F.explode("keys").alias("k")).select(*_hashed(F.col("k"))).distinct())
    rows = rows.select("row", "host", "path", "keys", F.transform("keys", lambda k: F.xxhash64(k)).alias("a"), F.transform("keys", lambda k: F.xxhash64(F.lit(1), k)).alias("b"), F.lit(-1).alias("won"))
    for step in _cascades(universe, table, verdicts, first_rate):
        # a shard's broadcast is done with before the next one's is sent
        rows = settle(rows) if step["shard"] else rows.withColumn("won", F.lit(-1))
        rows = rows.withColumn("won", _first(spark, verdicts, step)("a", "b", "won"))
    names = F.array(*[F.lit(v) for v in verdicts]) if verdicts else F.array(F.lit(default))
    rule = F.when(F.col("won") >= 0, F.get("keys", (F.col("won") / max(1, len(verdicts))).cast("int")))
    verdict = F.when(F.col("won") >= 0, F.get(names, (F.col("won") % max(1, len(verdicts))).cast("int"))).otherwise(F.lit(default))
    new = {"host": F.col("host"), "path": F.col("path"), "rule": rule, "verdict": verdict}
    return rows.select(*unpacked(rows), *[c.alias(free(n, df)) for n, c in new.items()])


def _first(spark: SparkSession, verdicts: list[str], step: dict):
    """A UDF of a row's key hashes and the best found so far: (place of the longest listed key) * verdicts + verdict, or -1."""
    shared = spark.sparkContext.broadcast(step)

    def run(batches):
        for a, b, won in batches:
            s = shared.value
            sizes = np.array([len(x) for x in a], np.int64)
            starts = np.concatenate([[0], np.cumsum(sizes)])
            fa, fb = (np.concatenate([*map(np.asarray, c), np.zeros(0, np.int64)]).astype(np.int64).view(np.uint64) for c in (a, b))
            code = np.full(len(fa), np.iinfo(np.int64).max)
            own = np.nonzero((fb >> np.uint64(7)) % np.uint64(s["shards"]) == s["shard"])[0]
            place = np.arange(len(fa)) - np.repeat(starts[:-1], sizes)
            for k in reversed(range(len(verdicts))):
                hit = own[listed(s["cascades"][verdicts[k]], fa[own], fb[own])]
                code[hit] = place[hit] * len(verdicts) + k
            best = won.to_numpy().astype(np.int64).copy()
            best[best < 0] = np.iinfo(np.int64).max
            full = sizes > 0
            if full.any():
                best[full] = np.minimum(best[full], np.minimum.reduceat(code, starts[:-1][full]))
            best[best == np.iinfo(np.int64).max] = -1
            yield pd.Series(best)

    run.__annotations__ = {"batches": Iterator[tuple[pd.Series, pd.Series, pd.Series]], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, T.LongType())
