"""Quality rules, line by line first.

Each line with a word is judged, and fails for one of these:

* punctuation: it has no sentence stop at all;
* navigation: three or more bars, arrows or bullets between short items;
* boilerplate: the corpus repeats it. Lines of up to ``BOILER_CHARS`` characters
  are counted over all documents by the different neighbours they stand between,
  so that copies of a document count once. A line is boilerplate from
  ``BOILER_PLACES`` and ``BOILER_SHARE`` of all lines on, unless most of its
  occurrences repeat neighbours too, as in near copies. That is at most
  1 / BOILER_SHARE lines, which are sent to every task as hashes;
* symbols: over a tenth of its characters are ``#*$%&|<>``;
* shouting: five words or more, none of them with a lower-case letter but some
  with capitals;
* repetition: an earlier line of the text is equal to it.

Failing lines are removed; a document that loses more than ``MAX_LOSS`` of its
word characters is rejected. The base rules (under 50 words; over half of the
words in repeated 3-word windows) reject too.

Null text has no words and fails the base; empty texts and an empty table are no
special case. Whole texts are judged, however long, row by row; repeated rows are
each judged. Columns of the input are kept; where one has the name of the new
column, that gets an underscore behind its name.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column, free, packed, series_udf, settle, unpacked

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_LOSS = 0.5
MAX_SYMBOLS = 0.1
BOILER_CHARS = 200
BOILER_PLACES = 10
BOILER_SHARE = 1e-4
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SYMBOLS = "#*$%&|<>"
_BARS = "|»›→•·"
_BAR = re.compile(r"\s[|»›→•·]\s")
_STOP = re.compile(r"[.!?…。！？।؟]")
_BLANK = " \t\n\v\f\r"
_OUT = T.StructType([T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")] + [T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType()), T.StructField("cleaned", T.StringType())])


def repeat_words(words: list[str]) -> int:
    """Words inside 3-word windows that the text has twice or more, the first included."""
    if len(words) < 4:
        return 0
    codes: dict[str, int] = {}
    ids = np.fromiter((codes.setdefault(w, len(codes)) for w in words), np.int64, len(words))
    n = len(codes)
    pairs = np.unique(ids[:-1] * n + ids[1:], return_inverse=True)[1]
    _, inverse, count = np.unique(pairs[:-1] * n + ids[2:], return_inverse=True, return_counts=True)
    at = np.nonzero(count[inverse] >= 2)[0]
    hit = np.zeros(len(words), bool)
    for k in range(3):
        hit[at + k] = True
    return int(hit.sum())


def line_fails(line: str, words: int, chars: int, symbols: int, repeated: bool, boiler: frozenset[int]) -> bool:
    if repeated or symbols > MAX_SYMBOLS * chars or not _STOP.search(line):
        return True
    if any(c in line for c in _BARS) and len(_BAR.findall(line)) >= 3:
        return True
    if words >= 5 and line.isupper():
        return True
    return bool(boiler) and len(line) <= BOILER_CHARS and _line_hash(line) in boiler


def _line_hash(line: str) -> int:
    """Spark's xxhash64 of a string."""
    v = xxhash.xxh64_intdigest(line.encode(), 42)
    return v - (1 << 64) if v >> 63 else v


def _count_symbols(text: str) -> int:
    return sum(map(text.count, _SYMBOLS))


def judge(text: str | None, boiler: frozenset[int] = frozenset()) -> tuple:
    text = text or ""
    words: list[str] = []
    seen: set[str] = set()
    dup, lost, chars, symbols, kept = 0, 0, 0, 0, []
    for line in text.split("\n"):
        own = _WORD.findall(line)
        if not own:
            kept.append(line)
            continue
        size, marks = sum(map(len, own)), _count_symbols(line)
        words += own
        chars += size
        symbols += marks
        repeated = line in seen
        dup += repeated
        seen.add(line)
        if line_fails(line, len(own), size, marks, repeated, boiler):
            lost += size
        else:
            kept.append(line)
    repeats = repeat_words(words)
    base_failed = len(words) < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * len(words)
    return len(words), chars, symbols, dup, repeats, base_failed, not (base_failed or lost > MAX_LOSS * chars), "\n".join(kept)


def boilerplate(docs: DataFrame, text_col: str = "text", places: int = BOILER_PLACES, share: float = BOILER_SHARE) -> DataFrame:
    """h: the hashes of the lines that the corpus repeats between different neighbours."""
    lines = F.filter(F.split(column(text_col), "\n"), lambda x: F.translate(x, _BLANK, "") != "")
    cut = docs.select(lines.alias("lines"))
    total = cut.agg(F.coalesce(F.sum(F.greatest(F.size("lines"), F.lit(0))), F.lit(0))).first()[0]
    near = F.transform("lines", lambda x, i: F.struct(x.alias("x"), F.xxhash64(x).alias("h"), F.xxhash64(F.get("lines", i - 1), F.get("lines", i + 1)).alias("c")))
    each = cut.select(F.explode(near).alias("l")).where(F.char_length("l.x") <= BOILER_CHARS).groupBy("l.h", "l.c").agg(F.count("*").alias("n"))
    by = each.groupBy("h").agg(F.count("*").alias("places"), F.sum("n").alias("n"))
    return by.where((F.col("places") >= max(places, share * total)) & (2 * F.col("places") >= F.col("n"))).select("h")


def assess(df: DataFrame, text_col: str = "text", out: str = "quality", with_cleaned: bool = True, boiler: DataFrame | None = None) -> DataFrame:
    """Adds the struct ``out``: the counts, base_failed, kept and the text without its failing lines.

    boiler: the hashes h of boilerplate lines, at most 1 / BOILER_SHARE; counted over df where not given.
    """
    known = settle(boilerplate(df, text_col) if boiler is None else boiler)
    shared = df.sparkSession.sparkContext.broadcast(frozenset(r[0] for r in known.collect()))

    def run(batch: pd.Series) -> pd.DataFrame:
        rows = [judge(t, shared.value) for t in batch]
        return pd.DataFrame([r if with_cleaned else (*r[:-1], None) for r in rows], columns=[f.name for f in _OUT])

    return df.withColumn(free(out, df), series_udf(run, _OUT)(column(text_col)))


def clean(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The kept documents, their failing lines removed, with their columns."""
    got = assess(df.select(packed(df).alias("row"), column(text_col).alias("t")), "t").where("quality.kept")
    return got.select(*[F.col("quality.cleaned").alias(f.name) if f.name == text_col else c for c, f in zip(unpacked(got), got.schema["row"].dataType.fields)])
