"""The registered queries of the text operators, with their production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import sha_hex, table


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import pii

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    got = pii.detect(docs, with_redacted=False)
    return got.select("doc_id", *[F.col(f"pii.n_{k}").alias(f"n_{k}") for k in pii.KINDS], sha_hex(F.col("pii.base_spans")).alias("base_sha256"), F.col("pii.spans").alias("spans"))


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import chat

    added = spark.sql(r"select -7L as conv_id, t as turn, if(t = 0, 'user', 'assistant') as role, '</s>[INST] ok [/INST]' as text from (select explode(array(0L, 1L)) as t)")
    talks = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    done = chat.format_conversations(talks)
    back = done.select("conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("formatted"), F.col("loss")).alias("loss"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), sha_hex(said).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), sha_hex(F.col("loss")).alias("loss_sha256"), F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def op3_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import decontam

    got = decontam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return got.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), sha_hex(F.array_join("items", ",")).alias("items_sha256"), "contaminated")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import mixing

    return mixing.interleave(table(spark, sf_dir, "documents").select("doc_id", "source"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import secrets

    got = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    got = got.withColumn("base", F.filter("secrets", lambda x: x["k"] < 3))
    of_kind = lambda i: lambda x: x["k"] == i
    counts = [F.size(F.filter("base", of_kind(i))).cast("long").alias(f"n_{k}") for i, k in enumerate(secrets.KINDS[:3])]
    return got.select("doc_id", *counts, sha_hex(secrets.said(F.col("base"))).alias("base_sha256"), secrets.said(F.col("secrets")).alias("spans"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import toxicity

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    got = toxicity.score(docs, model)
    return got.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import urlfilter

    return urlfilter.judge(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import quality

    got = quality.assess(table(spark, sf_dir, "documents").select("doc_id", "text"), with_cleaned=False)
    return got.select("doc_id", *[f"quality.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")])


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import html

    got = html.main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return got.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import ngram_join

    return ngram_join.join(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import repeats

    got = repeats.strip(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return got.select("doc_id", "n_words", "n_removed", sha_hex(F.col("kept")).alias("kept_sha256"))


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import lexical

    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import manifest

    docs = table(spark, sf_dir, "documents")
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    fields = [lowered if f == "text" else F.col(f) for f in manifest.FIELDS]
    got = manifest.prove(docs, carry={"tampered": F.when(hit, manifest.leaf(fields))})
    folded = manifest.fold(F.coalesce("tampered", "leaf"), F.col("lefts"), F.col("rights"))
    got = got.select("doc_id", "leaf", "subroot", "root", manifest.proof_digest(F.col("lefts"), F.col("rights")).alias("proof_sha256"), folded.alias("folded_root"))
    return got.withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES = {"op1_pii": op1_pii, "op2_chat": op2_chat, "op3_decontam": op3_decontam, "op4_mixing": op4_mixing, "op5_secrets": op5_secrets, "op6_ngram_join": op6_ngram_join, "op7_html": op7_html, "op8_toxicity": op8_toxicity, "op9_urls": op9_urls, "op10_quality": op10_quality, "op11_repeats": op11_repeats, "op12_lexical": op12_lexical, "op13_manifest": op13_manifest}

_OP2 = r"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), coded as (
  select *, lag(role) over w as before, lead(role) over w as behind,
    length(replace(replace(replace(replace(replace(replace(text, '\', '\\'), '<|', '<\|'), '</s>', '<\/s>'), '<s>', '<\s>'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]')) as n,
    length(replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '<', '%3C')) as n_role
  from rows window w as (partition by conv_id order by turn, role, text)
)
select conv_id, count(*)::bigint as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  sum(n + case when before is distinct from role then n_role + 9 else 8 end + case when behind is distinct from role then 7 else 0 end)::bigint as formatted_chars
from coded group by conv_id
"""

_OP3 = r"""
with d as (select doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') as w from documents),
b as (select item_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') as w from benchmark),
bw as (select item_id, least(len(w), 13) as n, unnest(list_transform(range(1, len(w) - least(len(w), 13) + 2), lambda i: array_to_string(w[i:i + least(len(w), 13) - 1], ' '))) as win from b where len(w) > 0),
lens as (select distinct n from bw),
dw as (select doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') as win from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as s from d, lens where len(w) >= n)),
hit as (select doc_id, item_id, s, bw.n as n from dw join bw on dw.win = bw.win and dw.n = bw.n),
pos as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(s, s + n)) as p from (select distinct doc_id, s, n from hit)) group by doc_id),
ids as (select doc_id, string_agg(id, ',' order by id) as ids, count(*) as n_items from (select distinct doc_id, item_id::varchar as id from hit) group by doc_id)
select d.doc_id, coalesce(len(w), 0)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= coalesce(len(w), 0) as contaminated
from d left join pos using (doc_id) left join ids using (doc_id)
"""

_OP4 = r"""
with recursive rows as (select doc_id, source, coalesce('=' || source, 'null') as key, md5(coalesce(doc_id::varchar, '')) as h from documents),
w as (select distinct key, ('0x' || substr(md5(key), 1, 2))::int % 9 + 1 as weight from rows),
g as (select list_reduce(list(weight), lambda a, b: gcd(a, b)) as g from w),
shares as (select key, (weight // g)::bigint as q from w, g),
s as (select list(q order by key) as q, list(key order by key) as keys, sum(q)::bigint as period from shares),
edf(t, done, i, job) as (
  select -1::bigint, list_transform(q, lambda x: 0::bigint), 0::bigint, 0::bigint from s
  union all
  select t + 1, list_transform(done, lambda d, k: case when k = p then d + 1 else d end), p, done[p]
  from (select t, done, list_min(list_transform(q, lambda x, k: case when (done[k] * period) // x <= t + 1 then ((done[k] * period + period + x - 1) // x) * 1000000 + k else null end)) % 1000000 as p
        from edf, s where t + 1 < period)
),
plan as (select keys[i] as key, job, t as first from edf, s where t >= 0),
numbered as (select rows.*, row_number() over (partition by key order by h) - 1 as pos from rows)
select doc_id, source, (pos // 32)::bigint as block, (pos % 32)::int as place, (((pos // 32) // q) * (select period from s) + first)::bigint as slot
from numbered join shares using (key) join plan on plan.key = numbered.key and plan.job = (pos // 32) % q
"""

_OP9 = r"""
with u as (select page_id, url, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) end as rest from pages),
p as (select page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host, coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') as path from u),
r(h, q, v) as (values ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
m as (select p.*, h || q as rule, v, row_number() over (partition by page_id order by length(h || q) desc) as k from p left join r on (host = h or ends_with(host, '.' || h)) and starts_with(path, q))
select page_id, host, path, rule, coalesce(v, 'allow') as verdict from m where k = 1
"""

_OP11 = r"""
with d as (select doc_id, row_number() over (order by doc_id nulls first) as o, coalesce(list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda w: w <> ''), []) as w from documents),
win as (select o, unnest(range(1, len(w) - 18)) as s, unnest(list_transform(range(1, len(w) - 18), lambda i: array_to_string(w[i:i + 19], ' '))) as win from d where len(w) >= 20),
again as (select o, s from win qualify row_number() over (partition by win order by o, s) > 1),
gone as (select distinct o, unnest(range(s, s + 20)) as p from again),
left_ as (select o, p, word from (select o, unnest(range(1, len(w) + 1)) as p, unnest(w) as word from d) anti join gone using (o, p)),
kept as (select o, string_agg(word, ' ' order by p) as kept, count(*) as n from left_ group by o)
select doc_id, len(w)::bigint as n_words, (len(w) - coalesce(n, 0))::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256 from d left join kept using (o)
"""

_OP12 = r"""
with d as (select doc_id, row_number() over () as rid, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda w: w <> '') as t from documents),
g as (select count(*)::bigint as nd, sum(len(t))::bigint as l from d where len(t) > 0),
q as (select distinct item_id, term from (select item_id, unnest(list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda w: w <> '')) as term from benchmark)),
p as (select rid, doc_id, n, term, count(*)::bigint as tf from (select rid, doc_id, len(t)::bigint as n, unnest(t) as term from d) where term in (select term from q) group by all),
w as (select term, floor(1000 * ln((2 * nd + 2) / (2 * count(*) + 1)))::bigint as w from p, g group by term, nd),
s as (select item_id, rid, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nd) // l))))::bigint as score from q join p using (term) join w using (term), g group by all)
select item_id, (row_number() over (partition by item_id order by score desc, doc_id, rid))::int as rank, doc_id, score from s where score > 0
qualify row_number() over (partition by item_id order by score desc, doc_id, rid) <= 10
"""

_FIELD = "coalesce(strlen({0}::varchar)::varchar || ':' || {0}::varchar, '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(f) for f in ("doc_id", "source", "lang", "n_chars", "{text}")) + ")"

_OP13 = f"""
with recursive crc as (
  select doc_id, xor(list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(string_split(doc_id::varchar, ''), lambda c: [ascii(c)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda c, x: case when x >= 0 then xor(c, x) when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end), 4294967295) as crc from (select distinct doc_id from documents where doc_id is not null)
), leaf as (
  select d.doc_id, lang, coalesce('=' || lang, '') as g, {_LEAF.format(text="text")} as h,
    case when crc % 3 = 0 then {_LEAF.format(text="translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} end as t
  from documents d left join crc using (doc_id)
), placed as (
  select *, row_number() over (partition by g order by doc_id nulls first, h) - 1 as i, count(*) over (partition by g) as n from leaf
), nodes(g, level, i, h, n) as (
  select g, 0, i, h, n from placed
  union all select g, level + 1, i // 8, sha256(string_agg(h, '' order by i)), (max(n) + 7) // 8 from nodes where n > 1 group by g, level, i // 8
), subroots as (select g, h, level as height, row_number() over (order by g) - 1 as i, count(*) over () as n from nodes where n = 1
), tops(level, i, h, n) as (
  select 0, i, h, n from subroots
  union all select level + 1, i // 8, sha256(string_agg(h, '' order by i)), (max(n) + 7) // 8 from tops where n > 1 group by level, i // 8
), own as (
  select p.g, p.i, p.h, p.t, s.h as subroot, s.height, s.i as place, (select h from tops where n = 1) as root from placed p join subroots s using (g)
), sides as (
  select own.g, own.i, v.level, string_agg(v.h, '' order by v.i) filter (v.i < own.i // (8 ** v.level)::bigint) as l, string_agg(v.h, '' order by v.i) filter (v.i > own.i // (8 ** v.level)::bigint) as r
  from own join nodes v on v.g = own.g and v.level < own.height and v.i // 8 = own.i // (8 ** (v.level + 1))::bigint group by all
  union all
  select own.g, own.i, own.height + v.level, string_agg(v.h, '' order by v.i) filter (v.i < own.place // (8 ** v.level)::bigint), string_agg(v.h, '' order by v.i) filter (v.i > own.place // (8 ** v.level)::bigint)
  from own join tops v on v.n > 1 and v.i // 8 = own.place // (8 ** (v.level + 1))::bigint group by all
), proofs as (
  select g, i, list(struct_pack(l := coalesce(l, ''), r := coalesce(r, '')) order by level) as p from sides group by g, i
), climb(g, i, level, h, p) as (
  select own.g, own.i, 0, coalesce(t, h), coalesce(p, []) from own left join proofs using (g, i)
  union all select g, i, level + 1, sha256(p[level + 1].l || h || p[level + 1].r), p from climb where level < len(p)
), folded as (select g, i, h as folded_root, p from climb where level = len(p))
select doc_id, own.h as leaf, subroot, root, sha256(array_to_string(list_transform(p, lambda x: x.l || x.r), '')) as proof_sha256, folded_root, folded_root = root as verified
from own join folded using (g, i) join placed using (g, i)
"""

ORACLE_SQL: dict[str, str] = {"op11_repeats": _OP11, "op12_lexical": _OP12, "op13_manifest": _OP13, "op2_chat": _OP2, "op3_decontam": _OP3, "op4_mixing": _OP4, "op9_urls": _OP9}
