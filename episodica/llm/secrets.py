"""Secret scanning with Spark expressions only.

Base spans come from strict patterns: assigned passwords and keys, access key
ids, and long hex runs. Beyond them, tokens of eight characters or more that hold
a digit, or a capital behind a small letter, are judged by two first-order
character Markov models, one of random strings and one of ordinary identifiers,
words, numbers and dates: a token whose mean log-likelihood ratio a transition
exceeds the bar of its length is a span of kind ``random``. Short tokens give
less evidence, so their bars are higher.

Both models are trained on labelled samples of ``TRAIN`` strings each, random
strings in usual encodings and ordinary ones in usual styles; half of each sample
counts the transitions, the other half sets the bars: halfway between the highest
ordinary token and the lowest twentieth of the random ones, and never below the
former. A transition's probability mixes its own counts with those of its
character classes, so that letters which no sample joins are merely rare.
Counting is a DataFrame aggregation over at most 128 x 128 transitions, so the
model's size is bounded, and it does not depend on the corpus.

Offsets are code points, ends exclusive. Null text counts as empty and has no
spans; texts and tokens of any length are read whole. Spans of one start are
ordered by kind. Every row is judged by itself, repeated rows each, and an empty
table gives no rows. Columns of the input are kept; where one has the name of
the new column, that gets an underscore behind its name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column, ends, free, packed, unpacked

KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*+[:=]\x20*+["']?[A-Za-z0-9+/_.=-]+"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
_SIGN = "[A-Za-z0-9+/_=-]"
TOKEN = rf"(?<!{_SIGN})(?=[A-Za-z+/_=-]*+[0-9]|{_SIGN}*?[a-z][A-Z]){_SIGN}{{8,}}+"
TRAIN = 8000
#: The share of a transition's own counts in its probability; the rest comes from its character classes.
OWN = 0.7
#: From these lengths on a token has the next bar.
LENGTHS = (8, 12, 16, 20, 32)
#: Common parts of identifiers.
PARTS = (
    "account address array async auth base batch bool buffer build byte cache call char check child class client code config connect context count create data date debug "
    "default delete device domain double edge email enable error event export factory field file filter first float format frame from function get global graph group handle "
    "hash header height helper http image import index init input int item iterator java json key label language last layer length level line link list load local lock log "
    "long main manager map match max memory message method min model module name network next node null number object offset old open option order output packet page parent"
).split()
#: Syllables of words in several languages.
SYLLABLES = ("b br c ch d dr f g gr h k l m n p pr qu r s sch sh st t th tr v w".split(), "a e i o u ai au ea ei eu ie io ou".split(), ["", *"l m n nd ng nt r rs s st t ch".split()])


def _spans(df: DataFrame, text: str, pattern: str, out: str) -> DataFrame:
    """Adds ``out``: array of struct(s, e, t) of the pattern's leftmost matches that don't overlap."""
    found = df.withColumn("__m", F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    gaps = found.withColumn("__g", F.when(F.size("__m") > 0, F.split(text, pattern, -1)).otherwise(F.array().cast("array<string>")))
    lengths = gaps.withColumn("__l", F.expr("zip_with(slice(__g, 1, size(__m)), __m, (g, m) -> cast(char_length(g) + char_length(m) as bigint))"))
    summed = lengths.withColumn("__e", F.expr(ends("__l")))
    spans = summed.withColumn(out, F.expr("zip_with(__e, __m, (e, m) -> struct(e - char_length(m) as s, e as e, m as t))"))
    return spans.drop("__m", "__g", "__l", "__e")


def _samples(spark: SparkSession) -> DataFrame:
    """s, random (1 or 0), fit (which half): labelled strings, the same each time."""

    def pick(values: list[str], k: int, seed: str) -> str:
        return f"element_at(array({','.join(repr(v) for v in values)}), 1 + cast(conv(substr(sha2('{seed}' || s, 256), {4 * k + 1}, 4), 16, 10) as int) % {len(values)})"

    def numbered(kind: str) -> DataFrame:
        d = spark.range(TRAIN).select("id", F.concat(F.lit(kind), F.col("id").cast("string")).alias("s"))
        return d.withColumn("h", F.sha2("s", 256)).withColumn("n", F.expr("8 + cast(conv(substr(sha2('n' || s, 256), 1, 4), 16, 10) as int) % 33"))

    coded = "replace(base64(unhex(h)), '\n', '')"
    random = numbered("random").select(
        F.expr(f"""case id % 6 when 0 then substr(h, 1, n) when 1 then substr({coded}, 1, n) when 2 then translate(substr({coded}, 1, n), '+/=', 'xYz')
          when 3 then upper(substr(conv(substr(h, 1, 15), 16, 36) || conv(substr(h, 17, 15), 16, 36) || conv(substr(h, 33, 15), 16, 36), 1, n))
          when 4 then lower(substr(conv(substr(h, 1, 15), 16, 36) || conv(substr(h, 17, 15), 16, 36) || conv(substr(h, 33, 15), 16, 36), 1, n))
          else translate(substr({coded}, 1, n), '+/=', '-_9') end""").alias("s"),
        F.lit(1).alias("random"), "id",
    )
    word = lambda k, seed: " || ".join(pick(v, 3 * k + j, seed) for j, v in enumerate(SYLLABLES))
    spoken = [f"concat({word(0, x)}, {word(1, x)}, if(id % 3 = 0, '', {word(2, x)}))" for x in ("v", "w")]
    plain = numbered("plain").withColumn("d", F.expr("substr(translate(h, 'abcdef', '012345'), 1, 40)"))
    plain = plain.withColumn("w", F.expr(f"slice(array({', '.join(pick(PARTS, k, 'p') for k in range(6))}), 1, 2 + cast(id % 5 as int))")).withColumn("v", F.expr(f"array({', '.join(spoken)})"))
    plain = plain.select(
        F.expr("""case id % 18 when 0 then array_join(w, '_') when 1 then array_join(transform(w, x -> initcap(x)), '') when 2 then array_join(w, '-') || substr(d, 1, 1)
          when 3 then upper(array_join(w, '_')) || substr(d, 1, 2) when 4 then array_join(w, '/') || '/' || substr(d, 1, 3) when 5 then array_join(w, '') || substr(d, 1, 2)
          when 6 then w[0] || array_join(transform(slice(w, 2, 9), x -> initcap(x)), '') when 7 then substr(d, 1, n) when 8 then '20' || substr(d, 1, 2) || '-' || substr(d, 3, 2) || '-' || substr(d, 5, 2)
          when 9 then v[0] || substr(d, 1, 2) when 10 then initcap(v[0]) || initcap(v[1]) when 11 then upper(v[0]) || '-' || substr(d, 1, 4) when 12 then array_join(v, '-') || substr(d, 1, 1)
          when 13 then w[0] || '=' || substr(d, 1, 6) when 14 then v[0] || '/' || v[1] || '/' || substr(d, 1, 4) when 15 then substr(d, 1, 4) || '-' || substr(d, 5, 4) || '-' || substr(d, 9, 4)
          when 16 then v[0] || v[1] || substr(d, 1, 1) else v[0] || initcap(v[1]) end""").alias("s"),
        F.lit(0).alias("random"), "id",
    )
    return random.unionByName(plain).withColumn("fit", F.expr("(id div 36) % 2 = 0"))


def _steps(s: str) -> str:
    return f"transform(sequence(1, char_length({s}) - 1), i -> ascii(substr({s}, i, 1)) * 128 + ascii(substr({s}, i + 1, 1)))"


def ratio(token: str, model: str) -> str:
    """SQL of the mean log-likelihood ratio a transition of a token."""
    return f"aggregate({_steps(token)}, cast(0 as double), (acc, k) -> acc + element_at({model}, k + 1)) / (char_length({token}) - 1)"


def length_class(token: str) -> str:
    """SQL of the number of a token's bar, from 0."""
    return " + ".join(f"if(char_length({token}) >= {n}, 1, 0)" for n in LENGTHS[1:])


def train(spark: SparkSession) -> tuple[str, list[float]]:
    """The ratios of all 16384 transitions, as SQL text of a constant array, and the bar of each length."""
    samples = _samples(spark)
    counted = samples.where("fit").select("random", F.explode_outer(F.expr(_steps("s"))).alias("k")).groupBy("k").agg(F.sum("random").alias("r"), F.sum(1 - F.col("random")).alias("p"))
    kind = lambda c: f"case when {c} between 97 and 122 then 0 when {c} between 65 and 90 then 1 when {c} between 48 and 57 then 2 else 3 end"
    pairs = spark.range(128 * 128).select(F.col("id").alias("k"), F.expr("id div 128").alias("a"), F.expr("id % 128").alias("b"))
    signs = "array(43, 45, 47, 61, 95)"
    known = lambda c: f"({kind(c)} < 3 or array_contains({signs}, cast({c} as int)))"
    pairs = pairs.where(f"{known('a')} and {known('b')}").withColumn("ka", F.expr(kind("a"))).withColumn("kb", F.expr(kind("b")))
    full = pairs.join(counted, "k", "left").na.fill(0, ["r", "p"])
    by_a = full.groupBy("a").agg(F.sum("r").alias("ra"), F.sum("p").alias("pa"))
    by_kinds = full.groupBy("ka", "kb").agg(F.sum("r").alias("rk"), F.sum("p").alias("pk"))
    by_kind = by_kinds.groupBy("ka").agg(F.sum("rk").alias("rs"), F.sum("pk").alias("ps"))

    def chance(n: str, of_a: str, of_kinds: str, of_kind: str) -> Column:
        shared = (F.col(of_kinds) + 1) / (F.col(of_kind) + 4) / F.expr("element_at(array(26, 26, 10, 5), kb + 1)")
        return F.when(F.col(of_a) > 0, OWN * F.col(n) / F.col(of_a) + (1 - OWN) * shared).otherwise(shared)

    value = F.log(chance("r", "ra", "rk", "rs")) - F.log(chance("p", "pa", "pk", "ps"))
    rows = full.join(by_a, "a").join(by_kinds, ["ka", "kb"]).join(by_kind, "ka").select("k", value.alias("v"))
    known_ratios = {r["k"]: r["v"] for r in rows.collect()}
    model = "cast(split('" + ",".join(f"{known_ratios.get(k, 0.0):.4f}".rstrip("0").rstrip(".") for k in range(128 * 128)) + "', ',') as array<double>)"
    held = samples.where("not fit").where(F.regexp_extract("s", f"^{TOKEN}$", 0) != "").select("random", F.expr(ratio("s", model)).alias("v"), F.expr(length_class("s")).alias("c"))
    found = held.groupBy("c").agg(F.max(F.when(F.col("random") == 0, F.col("v"))).alias("low"), F.percentile(F.when(F.col("random") == 1, F.col("v")), F.lit(0.05)).alias("high"))
    bars = {r["c"]: max(r["low"], (r["low"] + r["high"]) / 2) for r in found.collect()}
    return model, [bars[c] for c in range(len(LENGTHS))]


def scan(df: DataFrame, text_col: str = "text", out: str = "secrets") -> DataFrame:
    """Adds ``out``: array of struct(s, k, e, t): start, number of the kind, end and string, by start, then kind."""
    model, bars = train(df.sparkSession)
    d = df.select(packed(df).alias("row"), F.coalesce(column(text_col), F.lit("")).alias("t"))
    for kind, pattern in (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX), ("random", TOKEN)):
        d = _spans(d, "t", pattern, kind)
    value = r'^[A-Za-z_]+["\']?\x20*[:=]\x20*["\']?'
    d = d.withColumn("assign", F.filter("assign", lambda x: F.char_length(F.regexp_replace(x["t"], value, "")) >= 8))
    d = d.withColumn("base", F.expr("concat(" + ", ".join(f"transform({k}, x -> struct(x.s as s, {i} as k, x.e as e, x.t as t))" for i, k in enumerate(KINDS[:3])) + ")"))
    d = d.withColumn("random", F.filter("random", lambda x: ~F.exists("base", lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"]))))
    bar = f"element_at(array({', '.join(f'{b!r}D' for b in bars)}), 1 + {length_class('x.t')})"
    d = d.withColumn("added", F.expr(f"filter(random, x -> {ratio('x.t', model)} > {bar})"))
    d = d.withColumn("found", F.expr("array_sort(concat(base, transform(added, x -> struct(x.s as s, 3 as k, x.e as e, x.t as t))))"))
    return d.select(*unpacked(d), F.col("found").alias(free(out, df)))


def said(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")
