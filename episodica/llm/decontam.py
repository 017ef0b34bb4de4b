"""Benchmark decontamination by winnowing, with Spark expressions only.

Words are hashed to 64 bits; K consecutive word hashes make a k-gram hash, and
of every W consecutive k-grams the least is kept, so that any shared run of
K + W - 1 = 13 words leaves a fingerprint that both sides keep. The documents'
fingerprints are matched with the benchmark's. In the documents that share one,
each hit is then extended: every 13-word window around a k-gram that is a
fingerprint of the benchmark is compared with the benchmark's windows as a whole
string, so hashes only select what is compared.

An item with fewer than 13 words is one window of its own length n; for each
such n that the benchmark has (12 at most), the documents' n-grams join too.

Benchmark sides, and the keys of documents with a hit, are broadcast while their
counted bytes, words and ids included, are below ``BROADCAST_BYTES``; beyond that
the joins shuffle. Documents are
matched by (doc_id, hash of the text), so repeated rows and repeated or null ids
are judged row by row. A null text has no words, and a document without words is
never contaminated. Texts of any length are read whole, in time in proportion to
it. Null items, and items without words, have no windows; equal windows of
several items count for each. An empty table gives no rows, an empty benchmark
no hits. Columns other than doc_id and text, whatever their names, are left out
of the result, and kept by `clean`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settle

WINDOW = 13
K = 5
W = WINDOW - K + 1
BROADCAST_BYTES = 32 << 20
SHARE = 20
_KEY_BYTES = "coalesce(octet_length(cast(doc_id as string)), 0) + 24"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """The lower-cased words of a text; an empty array for null."""
    parts = F.split(F.translate(text, _UPPER, _LOWER), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    return F.coalesce(F.filter(parts, lambda w: w != ""), F.array().cast("array<string>"))


def _grams(hashes: str, k: int) -> Column:
    """Hashes of the runs of k word hashes, in order of position."""
    over = ", ".join(f"get({hashes}, i + {j})" for j in range(k))
    return F.expr(f"if(size({hashes}) >= {k}, transform(sequence(0, size({hashes}) - {k}), i -> xxhash64({k}, {over})), cast(array() as array<bigint>))")


def fingerprints(df: DataFrame, keys: list[str], lengths: list[int]) -> DataFrame:
    """keys and fp: one row for each distinct fingerprint of a row's column ``words``."""
    d = df.select(*keys, F.transform("words", lambda w: F.xxhash64(w)).alias("h"))
    d = d.select(*keys, "h", _grams("h", K).alias("g"))
    d = d.select(*keys, "h", "g", F.expr("transform(g, (x, i) -> least(x, get(g, i + 1)))").alias("m"))
    d = d.select(*keys, "h", "g", F.expr("transform(m, (x, i) -> least(x, get(m, i + 2)))").alias("m"))
    d = d.select(*keys, "h", "g", F.expr("transform(m, (x, i) -> least(x, get(m, i + 4)))").alias("m"))
    whole = f"if(size(g) >= {W}, transform(slice(m, 1, size(g) - {W - 1}), (x, i) -> least(x, get(g, i + {W - 1}))), cast(array() as array<bigint>))"
    d = d.select(*keys, "h", F.array_distinct(F.expr(whole)).alias("f"))
    parts = [F.col("f")] + [F.array_distinct(_grams("h", n)) for n in lengths]
    # explode() would have Catalyst test the array's size first, with every step above written out again inside the next
    return d.select(*keys, F.explode_outer(F.concat(*parts) if lengths else parts[0]).alias("fp")).where("fp is not null")


def _item_windows(items: DataFrame) -> DataFrame:
    """Every window of every item: item_id, len, win."""
    return items.select("item_id", F.expr(f"least(size(words), {WINDOW})").alias("len"), "words").select(
        "item_id", "len", F.explode_outer(F.expr("transform(sequence(0, size(words) - len), i -> array_join(slice(words, i + 1, len), ' '))")).alias("win")
    )


def _small(df: DataFrame, bytes_of: str, limit: int) -> DataFrame:
    """A hint to broadcast where the rows' bytes, counted, are below the limit."""
    size = df.agg(F.coalesce(F.sum(F.expr(bytes_of)), F.lit(0))).first()[0]
    return F.broadcast(df) if size <= limit else df


def decontaminate(docs: DataFrame, benchmark: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """doc_id, th (hash of the text), n_words, n_hit, items (ids as sorted strings) and contaminated, a row for each document."""
    items = benchmark.select("item_id", words(F.col("text")).alias("words")).where("size(words) > 0").distinct()
    lengths = sorted(r[0] for r in items.select(F.size("words").alias("n")).where(f"n < {WINDOW}").distinct().collect())
    marks = settle(fingerprints(items, ["item_id"], lengths).select("fp").distinct())
    windows = settle(_item_windows(items).groupBy("len", "win").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("ids")))
    near = _small(marks, "16", broadcast_bytes)

    keyed = docs.select("doc_id", F.xxhash64("text").alias("th"), "text")
    own = keyed.select("doc_id", "th", words(F.col("text")).alias("words"))
    # the few documents that share a fingerprint are sent to the texts; whole texts move only where they are many
    hits = _small(settle(fingerprints(own, ["doc_id", "th"], lengths).join(near, "fp", "left_semi").select("doc_id", "th").distinct()), _KEY_BYTES, broadcast_bytes)

    same = F.expr("a.doc_id <=> b.doc_id and a.th <=> b.th")
    # equal rows are looked at once; texts are written, which take less room than their arrays of words
    found = settle(keyed.alias("a").join(hits.alias("b"), same, "left_semi").groupBy("doc_id", "th").agg(F.first("text").alias("text")))
    hashed = found.select("doc_id", "th", F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("h"))
    grams = hashed.select("doc_id", "th", *[_grams("h", n).alias(f"g{n}") for n in {K, *lengths}])
    each = [F.expr(f"transform(g{n}, (x, i) -> struct({short} as short, {n} as n, i as i, x as fp))") for n, short in [(K, "false"), *((n, "true") for n in lengths)]]
    spots = grams.select("doc_id", "th", F.explode_outer(F.concat(*each) if lengths else each[0]).alias("x")).select("doc_id", "th", "x.*").where("fp is not null").join(near, "fp", "left_semi")
    starts = F.when(F.col("short"), F.array("i")).otherwise(F.expr(f"sequence(greatest(i - {W - 1}, 0), i)"))
    starts = spots.select("doc_id", "th", F.explode(starts).alias("s"), F.when(F.col("short"), F.col("n")).otherwise(WINDOW).alias("len"))
    starts = starts.groupBy("doc_id", "th").agg(F.collect_set(F.struct("s", "len")).alias("spots"))
    d = found.alias("a").join(starts.alias("b"), same).select("a.doc_id", "a.th", words(F.col("a.text")).alias("words"), "b.spots")
    cut = F.expr("transform(filter(spots, x -> x.s + x.len <= size(words)), x -> struct(x.s as s, x.len as len, array_join(slice(words, x.s + 1, x.len), ' ') as win))")
    d = d.select("doc_id", "th", F.explode_outer(cut).alias("w")).select("doc_id", "th", "w.*").where("win is not null")
    matched = d.join(_small(windows, "octet_length(win) + 24 + aggregate(ids, 0L, (n, x) -> n + octet_length(x) + 8)", broadcast_bytes), ["len", "win"])
    covered = F.expr("size(array_distinct(flatten(transform(spans, x -> sequence(x.s, x.s + x.len - 1)))))")
    per = matched.groupBy("doc_id", "th").agg(F.collect_set(F.struct("s", "len")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("ids")))).alias("items"))
    per = per.select("doc_id", "th", covered.cast("long").alias("n_hit"), "items")

    counted = keyed.select("doc_id", "th", F.size(words(F.col("text"))).cast("long").alias("n_words"))
    return (
        counted.alias("a")
        .join(per.alias("b"), same, "left")
        .select("a.doc_id", "a.th", "a.n_words", F.coalesce("b.n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("b.items", F.array().cast("array<string>")).alias("items"))
        .withColumn("contaminated", (F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words")))
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that aren't contaminated, with all their columns."""
    bad = _small(settle(decontaminate(docs, benchmark).where("contaminated").select("doc_id", "th").distinct()), _KEY_BYTES, BROADCAST_BYTES)
    return docs.alias("a").join(bad.alias("b"), (F.col("a.doc_id").eqNullSafe(F.col("b.doc_id"))) & (F.xxhash64("a.text") == F.col("b.th")), "left_anti").select("a.*")
