"""Toxicity: FTRL-proximal logistic regression over hashed n-grams and skip-grams.

A text's features are the distinct hashes of its words, of neighbouring words
and of words two and three places apart, in ``2 ** BITS`` slots. Training goes
through the labelled rows one by one, each coordinate with a rate of its own,
and L1 keeps most weights at nought, so the weights sent to executors are few;
their number is at most 2 ** BITS and is checked against ``MAX_WEIGHTS``.

The model is fitted on at most ``max_rows`` labelled rows, those with the least
md5 of doc_id, none of them held out (crc32(doc_id as text) mod 5 = 0). Equal
rows count once, and the bound holds for rows, not for labels. Executors make the
features and drop the rare ones; only the rest, packed, and never texts come to
the driver, where the one pass after the other runs that FTRL is. Labels, language, source and doc_id are no inputs of
a score.

Null text counts as empty; an empty text has the score of the bias alone. Texts
of any length are read whole. A null doc_id is never held out and never labelled.
Without any labelled row every score is the prior 0.05. Conflicting or repeated
labels of one doc_id count as toxic if one says so. Repeated rows are each
scored, an empty table gives no rows. Columns of the input are kept; where one
has the name of the new column, that gets an underscore behind its name.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column, free, packed, series_udf, settle, unpacked

BITS = 20
MAX_ROWS = 12288
MAX_WEIGHTS = 1 << 18
EPOCHS = 4
ALPHA, BETA, L1, L2 = 2.0, 1.0, 4.0, 0.0
#: A feature counts in training from so many of the sample's texts on.
MIN_TEXTS = 4
SLICE_CHARS = 4 << 20
PRIOR = 0.05
_SKIPS = (1, 2, 3)
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def hashed(texts: list[str | None], wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all texts, one after another and distinct within a text, and where each text's begin.

    wanted: a flag for each slot; others are left out before the rest is sorted.
    """
    flat = pc.utf8_lower(pa.array([t or "" for t in texts], pa.large_string()))
    flat = pc.utf8_trim_whitespace(pc.replace_substring_regex(flat, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))
    lists = pc.split_pattern(flat, " ")
    offsets = np.asarray(lists.offsets)
    coded = lists.flatten().dictionary_encode() if len(lists) else pa.array([], pa.large_string()).dictionary_encode()
    vocabulary = coded.dictionary.to_pylist()
    own = np.fromiter((xxhash.xxh64_intdigest(w) for w in vocabulary), np.uint64, len(vocabulary))
    ids, doc = np.asarray(coded.indices), np.repeat(np.arange(len(texts)), np.diff(offsets))
    real = np.array([bool(w) for w in vocabulary], bool)[ids] if len(ids) else np.zeros(0, bool)
    h, doc = own[ids[real]] if len(ids) else np.zeros(0, np.uint64), doc[real]
    parts, docs = [h * _MIX[0]], [doc]
    for k in _SKIPS:
        same = doc[:-k] == doc[k:]
        parts.append((h[:-k][same] * _MIX[k] + h[k:][same] * _MIX[0]) * _MIX[k])
        docs.append(doc[:-k][same])
    slots = np.concatenate(parts) >> np.uint64(64 - BITS)
    at = np.concatenate(docs)
    if wanted is not None:
        kept = wanted[slots]
        slots, at = slots[kept], at[kept]
    both = np.unique(at.astype(np.uint64) << np.uint64(BITS) | slots)
    doc, slots = (both >> np.uint64(BITS)).astype(np.int64), (both & np.uint64((1 << BITS) - 1)).astype(np.int64)
    return slots, np.searchsorted(doc, np.arange(len(texts) + 1))


@dataclass(frozen=True)
class Model:
    slots: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, texts: list[str | None]) -> np.ndarray:
        if not len(texts):
            return np.zeros(0)
        dense = np.zeros(1 << BITS, np.float32)
        dense[self.slots] = self.weights
        out, at, size = [], 0, 0
        for i, t in enumerate(texts):
            size += len(t or "")
            if size >= SLICE_CHARS or i == len(texts) - 1:
                slots, starts = hashed(texts[at : i + 1], dense != 0)
                sums = np.concatenate([[0.0], np.cumsum(dense[slots], dtype=np.float64)])
                out.append(sums[starts[1:]] - sums[starts[:-1]])
                at, size = i + 1, 0
        return 1 / (1 + np.exp(-np.clip(np.concatenate(out) + self.bias, -30, 30)))


def ftrl(feats: list[np.ndarray], labels: list[int], epochs: int = EPOCHS) -> Model:
    """Fits the weights to the feature numbers of each row."""
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)
    seen = np.zeros(1 << BITS, np.int32)
    for f in feats:
        seen[f] += 1
    for k, f in enumerate(feats):
        feats[k] = np.append(f[seen[f] >= MIN_TEXTS], np.int32(1 << BITS))

    def weights(i: np.ndarray) -> np.ndarray:
        zi = z[i]
        bar = np.where(i == 1 << BITS, 0.0, L1)
        return np.where(np.abs(zi) <= bar, 0.0, -(zi - np.sign(zi) * bar) / ((BETA + np.sqrt(n[i])) / ALPHA + L2))

    for _ in range(epochs):
        for i, y in zip(feats, labels):
            w = weights(i)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - y
            step = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA
            z[i] += g - step * w
            n[i] += g * g
    w = weights(np.arange((1 << BITS) + 1))
    kept = np.nonzero(w[:-1])[0]
    if len(kept) > MAX_WEIGHTS:
        raise ValueError(f"{len(kept)} weights are more than {MAX_WEIGHTS}; raise L1")
    return Model(kept.astype(np.int32), w[kept].astype(np.float32), float(w[-1]))


PIECE = 1 << 13
#: The sample is dealt over so many tasks, of which the driver takes one after the other.
TASKS = 24


def _chunks(texts: list[str], wanted: np.ndarray | None = None):
    for at in range(0, len(texts), 128):
        slots, starts = hashed(texts[at : at + 128], wanted)
        yield slots, starts


def _counts(batches):
    """slot and the number of its texts, for each slot of a partition."""
    seen = np.zeros(1 << BITS, np.int64)
    for batch in batches:
        for slots, _ in _chunks(batch["text"].tolist()):
            seen += np.bincount(slots, minlength=1 << BITS)
    at = np.nonzero(seen)[0]
    yield pd.DataFrame({"slot": at, "n": seen[at]})


def _pack(piece: pd.DataFrame) -> pd.DataFrame:
    k = int(piece["slot"].iloc[0]) // PIECE
    flags = np.zeros(PIECE, bool)
    flags[piece["slot"].to_numpy() - k * PIECE] = True
    return pd.DataFrame({"k": [k], "flags": [np.packbits(flags).tobytes()]})


def _frequent(texts: DataFrame) -> np.ndarray:
    """A flag for each slot that MIN_TEXTS of the texts have; it comes to the driver as bits."""
    counts = texts.select("text").mapInPandas(_counts, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_TEXTS)
    out = np.zeros(1 << BITS, bool)
    for k, flags in counts.groupBy((F.col("slot") / PIECE).cast("long").alias("k")).applyInPandas(_pack, "k long, flags binary").collect():
        out[k * PIECE : (k + 1) * PIECE] = np.unpackbits(np.frombuffer(flags, np.uint8)).astype(bool)
    return out


def _features(texts: DataFrame, wanted: np.ndarray) -> DataFrame:
    """h, th, toxic and the text's wanted feature numbers, packed."""
    shared = texts.sparkSession.sparkContext.broadcast(wanted)

    def run(batches):
        for batch in batches:
            packs = []
            for slots, starts in _chunks(batch["text"].tolist(), shared.value):
                packs += [zlib.compress(np.diff(slots[a:b], prepend=0).astype(np.int32).tobytes(), 1) for a, b in zip(starts[:-1], starts[1:])]
            yield batch[["h", "th", "toxic"]].assign(slots=packs)

    return texts.select("h", "th", "toxic", "text").mapInPandas(run, "h string, th long, toxic int, slots binary")


def _unpacked(slots: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(slots), np.int32), dtype=np.int32)


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """Fits on the bounded sample of labelled rows that aren't held out."""
    marks = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    sample = marks.where(~held_out(F.col("doc_id"))).withColumn("h", F.md5(F.col("doc_id").cast("string"))).orderBy("h", "doc_id").limit(max_rows)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    known = rows.join(F.broadcast(sample), "doc_id").select("doc_id", "h", "toxic", F.xxhash64("text").alias("th")).distinct().orderBy("h", "doc_id", "th").limit(max_rows)
    one = rows.join(F.broadcast(known.withColumnRenamed("th", "known")), "doc_id").where(F.xxhash64("text") == F.col("known"))
    one = one.groupBy("doc_id", "h", "toxic", F.col("known").alias("th")).agg(F.first("text").alias("text"))
    one = settle(one.repartition(TASKS, "h"))
    got = list(_features(one, _frequent(one)).toLocalIterator(prefetchPartitions=True))
    if not got:
        return Model(np.zeros(0, np.int32), np.zeros(0, np.float32), float(np.log(PRIOR / (1 - PRIOR))))
    got.sort(key=lambda r: (r["h"], r["th"]))
    labels, packs = [int(r["toxic"] > 0) for r in got], [bytes(r["slots"]) for r in got]
    del got
    return ftrl([_unpacked(p) for p in packs], labels)


def score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """Adds the column ``out``: the probability that a text is toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    udf = series_udf(lambda batch: pd.DataFrame({"score": shared.value.score(batch.tolist())}), T.StructType([T.StructField("score", T.DoubleType())]))
    return docs.withColumn(free(out, docs), udf(column(text_col))["score"])


def reject(docs: DataFrame, labels: DataFrame, bar: float = 0.5, max_rows: int = MAX_ROWS) -> DataFrame:
    """The documents whose score stays under the bar, with their columns."""
    rows = score(docs.select(packed(docs).alias("row"), "text"), train(docs, labels, max_rows)).where(F.col("score") < bar)
    return rows.select(*unpacked(rows))
