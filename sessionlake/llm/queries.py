"""Registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlake.llm import (
    decontaminate,
    filter_audit,
    fingerprint,
    jaccard_join,
    katz,
    langid,
    licenses,
    merkle,
    mixing,
    secrets,
    substring_dedup,
    suffix_dedup,
    warc,
)
from sessionlake.llm.common import crc_mod


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edit_report(_table(spark, sf_dir, "documents"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = crc_mod(F.col("doc_id"), 3) == 1
    model = langid.train(docs.where(~held_out))
    return langid.predict(docs.select("doc_id", "text", held_out.alias("held_out")), model).drop("text")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join_components(_table(spark, sf_dir, "documents"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_table(spark, sf_dir, "documents"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_units(_table(spark, sf_dir, "documents"), min_words=1)


def op7_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = crc_mod(F.col("doc_id"), 7) == 2
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", (~held_out).alias("train"))
    return katz.score(docs).withColumn("held_out", held_out)


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("detections")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return mixing.mix(docs, PRODUCTION_WEIGHTS).drop("text")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(_table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(_table(spark, sf_dir, "documents"))


#: Target weights of the mixing query; names not listed weigh 1.
PRODUCTION_WEIGHTS = {"domain": {"domain0": 3, "domain1": 2}, "lang": {"en": 2, "es": 3}}

QUERIES = {
    "op1_fingerprint": op1_fingerprint,
    "op2_language": op2_language,
    "op3_decontaminate": op3_decontaminate,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_secrets": op5_secrets,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_katz": op7_katz,
    "op8_licenses": op8_licenses,
    "op9_mixing": op9_mixing,
    "op10_warc": op10_warc,
    "op11_filter_audit": op11_filter_audit,
    "op12_suffix_dedup": op12_suffix_dedup,
    "op13_merkle_manifest": op13_merkle_manifest,
}

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_TOKEN = r"[^\x20\x09-\x0D]+"

_DECONTAMINATE = rf"""
with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '{_WORD}') w from documents),
i as (select cast(item_id as varchar) id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '{_WORD}') w from benchmark),
sizes as (select distinct least(len(w), 10) n from i where len(w) > 0),
item_windows as (
  select distinct id, n, array_to_string(w[p : p + n - 1], ' ') win
  from (select id, w, least(len(w), 10) n, unnest(range(1, len(w) - least(len(w), 10) + 2)) p from i where len(w) > 0)),
doc_windows as (
  select doc_id, p, n, array_to_string(w[p : p + n - 1], ' ') win
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) p from d, sizes where len(w) >= n)),
hits as (select doc_id, p, n, id from doc_windows join item_windows using (n, win)),
covered as (select doc_id, count(*) n_hit from
  (select distinct doc_id, q from (select doc_id, unnest(range(p, p + n)) q from hits)) group by doc_id),
found as (select doc_id, count(*) n_items, string_agg(id, ',' order by id) ids
  from (select distinct doc_id, id from hits) group by doc_id)
select d.doc_id, cast(len(w) as bigint) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items,
  sha256(coalesce(ids, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from d left join covered using (doc_id) left join found using (doc_id)
"""

_JACCARD = rf"""
with recursive d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '{_TOKEN}') w from documents),
s as (select distinct doc_id, array_to_string(w[p : p + 2], ' ') g
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) p from d where len(w) > 0)),
n as (select doc_id, count(*) n from s group by doc_id),
pairs as (select a.doc_id a, b.doc_id b, count(*) c from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
links as (select a, b from pairs join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 90 * (x.n + y.n - c)),
edges as (select a, b from links union all select b, a from links),
reach(node, here) as (select doc_id, doc_id from d union select node, b from reach join edges on a = here)
select d.doc_id, coalesce(n.n, 0) n_shingles, r.c component_id
from d left join n using (doc_id) join (select node, min(here) c from reach group by node) r on r.node = d.doc_id
"""

_MIXING = rf"""
with w as (select * from (values ('domain', 'domain0', 3), ('domain', 'domain1', 2), ('lang', 'en', 2), ('lang', 'es', 3)) t(lvl, name, w)),
rows as (select doc_id, lang, source,
    case when regexp_matches(coalesce(source, ''), '[0-9]$') then 'domain' || (cast(source[-1] as int) % 3) else 'other' end as domain,
    cast(len(regexp_extract_all(coalesce(text, ''), '{_TOKEN}')) as bigint) n_tokens from documents),
leaf as (select domain, coalesce(lang, '') lang, coalesce(source, '') source, sum(n_tokens)::bigint tokens from rows group by all),
b as (select (sum(tokens) * 1 // 2)::bigint budget from leaf),
l1 as (select domain, sum(tokens) * 2 cap, coalesce(any_value(w.w), 1) weight, any_value(budget) budget
  from leaf cross join b left join w on lvl = 'domain' and name = domain group by domain),
s1 as (select *, coalesce(sum(cap) over (order by cap / weight, cap, weight, domain rows between unbounded preceding and 1 preceding), 0) spent,
  sum(weight) over (order by cap / weight, cap, weight, domain rows between current row and unbounded following) ws from l1),
f1 as (select *, cap * ws <= weight * (budget - spent) ful from s1),
c1 as (select *, min(case when not ful then spent end) over () cs, max(case when not ful then ws end) over () cw from f1),
t1 as (select domain, case when ful then cap else least(cap, weight * (budget - cs) // cw) end take from c1),
l2 as (select domain, lang, sum(tokens) * 2 cap, coalesce(any_value(w.w), 1) weight, any_value(take) budget
  from leaf join t1 using (domain) left join w on lvl = 'lang' and name = lang group by domain, lang),
s2 as (select *, coalesce(sum(cap) over (partition by domain order by cap / weight, cap, weight, lang rows between unbounded preceding and 1 preceding), 0) spent,
  sum(weight) over (partition by domain order by cap / weight, cap, weight, lang rows between current row and unbounded following) ws from l2),
f2 as (select *, cap * ws <= weight * (budget - spent) ful from s2),
c2 as (select *, min(case when not ful then spent end) over (partition by domain) cs, max(case when not ful then ws end) over (partition by domain) cw from f2),
t2 as (select domain, lang, case when ful then cap else least(cap, weight * (budget - cs) // cw) end take from c2),
l3 as (select domain, lang, source, sum(tokens) * 2 cap, 1 weight, any_value(take) budget
  from leaf join t2 using (domain, lang) group by domain, lang, source),
s3 as (select *, coalesce(sum(cap) over (partition by domain, lang order by cap, source rows between unbounded preceding and 1 preceding), 0) spent,
  sum(weight) over (partition by domain, lang order by cap, source rows between current row and unbounded following) ws from l3),
f3 as (select *, cap * ws <= weight * (budget - spent) ful from s3),
c3 as (select *, min(case when not ful then spent end) over (partition by domain, lang) cs,
  max(case when not ful then ws end) over (partition by domain, lang) cw from f3),
t3 as (select domain, lang, source, case when ful then cap else least(cap, weight * (budget - cs) // cw) end take from c3),
plan as (select domain, lang, source, case when tokens > 0 then take // tokens else 1 end as ful, case when tokens > 0 then take % tokens else 0 end as rest
  from leaf join t3 using (domain, lang, source)),
ordered as (select r.*, p.ful, p.rest,
    sum(n_tokens) over (partition by p.domain, p.lang, p.source
      order by md5('mix-1:' || cast(p.ful + 1 as bigint) || ':' || r.doc_id), n_tokens rows unbounded preceding) cum
  from rows r join plan p on p.domain = r.domain and p.lang = coalesce(r.lang, '') and p.source = coalesce(r.source, ''))
select doc_id, lang, source, domain, n_tokens, cast(ful + case when cum <= rest and rest > 0 then 1 else 0 end as bigint) copies
from ordered where ful + case when cum <= rest and rest > 0 then 1 else 0 end > 0
"""

_B32 = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"
_LETTERS = " || ".join(
    f"substr({_B32}, cast((('0x' || substr(h, {5 * i + 1}, 5))::bigint >> {s}) & 31 as int) + 1, 1)"
    for i in range(8) for s in (15, 10, 5, 0)
)
_WARC = f"""
with p as (select page_id, coalesce(html, '') html, sha1(coalesce(html, '')) h from pages),
d as (select page_id, cast(octet_length(encode(html)) as bigint) payload_bytes, {_LETTERS} payload_digest from p),
o as (select payload_digest, max(page_id) original from d group by 1)
select page_id, payload_bytes, payload_digest,
  case when page_id = original then 'response' else 'revisit' end record_type,
  case when page_id <> original then original end refers_to
from d join o using (payload_digest)
"""

_AUDIT = rf"""
with t as (select doc_id, coalesce(text, '') x, coalesce(lang, '') part from documents),
w as (select *, regexp_extract_all(x, '{_TOKEN}') w, min(doc_id) over (partition by x) least_id from t),
l as (select doc_id, max((quality = 1)::int) good, max((toxic = 1)::int) toxic from labels group by doc_id),
m as (select part, coalesce(good, 0) good, coalesce(toxic, 0) toxic,
    (len(w) < 100)::int + 2 * (100 * len(list_distinct(w)) < 80 * len(w))::int
    + 4 * (100 * len(regexp_replace(x, '[^A-Z]+', '', 'g')) > 10 * len(x))::int
    + 8 * regexp_matches(x, '[#$%&*|]')::int + 16 * coalesce(doc_id > least_id, false)::int mask
  from w left join l using (doc_id)),
c as (select part, mask, count(*) n, sum(good) good, sum(toxic) toxic from m group by 1, 2),
f as (select * from (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) t(letter, bit)),
o as (select a.letter || b.letter || c.letter || d.letter || e.letter filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] bits
  from f a, f b, f c, f d, f e where a.bit | b.bit | c.bit | d.bit | e.bit = 31),
s as (select filter_order, step, bits[step] own, coalesce(list_sum(bits[1 : step - 1]), 0)::int before
  from o, (select unnest(range(1, 6))::int step)),
r as (select part, filter_order, step, any_value(own) own,
    sum(case when mask & (own | before) = 0 then n else 0 end) kept,
    sum(case when mask & own > 0 and mask & before = 0 then n else 0 end) removed,
    sum(case when mask & own > 0 and mask & before > 0 then n else 0 end) redundant,
    sum(case when mask = own then n else 0 end) unique_fails,
    sum(case when mask & own > 0 and mask & before = 0 then good else 0 end) good_lost,
    sum(case when mask & own > 0 and mask & before = 0 then toxic else 0 end) toxic_lost
  from c, s group by 1, 2, 3)
select part, filter_order, step, kept::bigint kept, removed::bigint removed, redundant::bigint redundant, unique_fails::bigint unique_fails,
  good_lost::bigint good_lost, toxic_lost::bigint toxic_lost, (sum(removed) over (partition by part, own))::bigint shapley from r
"""

#: Every string of 400 bytes by its digest; offsets count bytes, two hexadecimal digits each.
_SUFFIX = """
with d as (select row_number() over () r, doc_id, hex(encode(coalesce(text, ''))) h from documents),
pieces as (select r, 400 * k low, least(400, len(h) // 2 - 399 - 400 * k) n, substr(h, 800 * k + 1, 1600) h
  from (select r, h, unnest(range(0, (len(h) // 2 - 400) // 400 + 1)) k from d where len(h) >= 800)),
w as (select r, low + k p, md5(substr(h, 2 * k + 1, 800)) m from (select *, unnest(range(0, n)) k from pieces)),
hit as (select r, p, lag(p) over (partition by r order by p) before
  from w semi join (select m from w group by m having count(*) > 1) using (m)),
runs as (select r, min(p) low, max(p) + 400 high
  from (select *, sum((before is null or p > before + 400)::int) over (partition by r order by p) k from hit) group by r, k),
cut as (select r, h, low, high, coalesce(lag(high) over (partition by r order by low), 0) before, row_number() over (partition by r order by low desc) back
  from runs join d using (r)),
kept as (select r, count(*) n_spans, sum(high - low)::bigint n_removed,
    string_agg(substr(h, 2 * before + 1, 2 * (low - before)) || case when back = 1 then substr(h, 2 * high + 1) else '' end, '' order by low) h
  from cut group by r)
select doc_id, (len(d.h) // 2)::bigint n_bytes, coalesce(n_removed, 0) n_removed, coalesce(n_spans, 0) n_spans, sha256(unhex(coalesce(kept.h, d.h))) kept_sha256
from d left join kept using (r)
"""


def _merkle_levels(name: str, leaves: str, count: int) -> str:
    """SQL of the levels of all trees above a leaf table (tree, idx, digest); a tree of one node has no more."""
    out = [f"{name}0 as (select tree, idx, digest, count(*) over (partition by tree) n from {leaves})"]
    out += [f"""{name}{k} as (select tree, idx, sha256(string_agg(digest, '' order by spot)) digest, any_value(n + 7) // 8 n
  from (select tree, idx // 8 idx, idx spot, digest, n from {name}{k - 1} where n > 1) group by tree, idx)""" for k in range(1, count + 1)]
    return ",\n".join(out)


def _merkle_fold(name: str, start: str, levels: str, count: int, kept: str) -> str:
    """SQL of folding: rows of ``start`` (tree, idx, digest, proof, kept...) climb all levels."""
    out = [f"{name}0 as (select * from {start})"]
    for k in range(1, count + 1):
        out.append(f"""{name}{k} as (select tree, any_value(idx) // 8 idx, row,
    case when any_value(n) = 1 then any_value(digest) else sha256(string_agg(case when spot = idx then digest else own end, '' order by spot)) end digest,
    any_value(proof) || coalesce(string_agg(case when spot <> idx and n > 1 then own end, '' order by spot), '') proof, {kept}
  from (select f.*, s.idx spot, s.digest own, s.n from {name}{k - 1} f join {levels}{k - 1} s on s.tree = f.tree and s.idx // 8 = f.idx // 8)
  group by tree, row
  union all select tree, idx, row, digest, proof, {kept.replace("any_value", "")} from {name}{k - 1} f
  where not exists (select 1 from {levels}{k - 1} s where s.tree = f.tree))""")
    return ",\n".join(out)


def _merkle_leaf(text: str) -> str:
    part = lambda c: f"coalesce(strlen({c})::varchar || ':' || {c}, '-')"
    return "sha256(" + " || ".join(part(c) for c in ("doc_id::varchar", "source", "lang", "n_chars::varchar", text)) + ")"


#: Levels of eight children each: as many as 8 ** 8 rows of a language need.
_DEPTH = 8
#: Unsigned crc32 in SQL, bit by bit over the decimal digits.
_CRC = """list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(coalesce(doc_id::varchar, ''), ''), lambda c: ascii(c)::bigint)),
    lambda r, c: list_reduce(list_prepend(xor(r, c), [0::bigint, 0, 0, 0, 0, 0, 0, 0]),
      lambda x, i: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end))"""
_MERKLE = f"""
with d as (select doc_id, coalesce('=' || lang, '-') tree, {_merkle_leaf('text')} leaf,
    case when xor({_CRC}, 4294967295) % 3 = 0 then {_merkle_leaf(f"translate(text, {_AZ})")} end changed from documents),
leaves as (select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 idx, row_number() over () as row,
    leaf digest from d),
{_merkle_levels("up", "leaves", _DEPTH)},
subroots as ({" union all ".join(f"select tree, digest from up{k} where n = 1" for k in range(_DEPTH + 1))}),
tops as (select '' tree, tree lang_tree, digest, row_number() over (order by tree) - 1 idx from subroots),
{_merkle_levels("top", "tops", _DEPTH)},
roots as ({" union all ".join(f"select digest root from top{k} where n = 1" for k in range(_DEPTH + 1))}),
start as (select tree, idx, row, coalesce(changed, leaf) digest, '' proof, doc_id, leaf from leaves),
{_merkle_fold("low", "start", "up", _DEPTH, "any_value(doc_id) doc_id, any_value(leaf) leaf")},
middle as (select '' tree, t.idx, row, f.digest, proof, doc_id, leaf, t.digest subroot from low{_DEPTH} f join tops t on t.lang_tree = f.tree),
{_merkle_fold("high", "middle", "top", _DEPTH, "any_value(doc_id) doc_id, any_value(leaf) leaf, any_value(subroot) subroot")}
select doc_id, leaf, subroot, root, sha256(proof) proof_sha256, digest folded_root, digest = root verified from high{_DEPTH}, roots
"""

#: Queries whose whole result SQL expresses.  The others depend on trained models
#: (2, 5, 7), on xxHash fingerprints (1), on byte digests (6) or on hundreds of
#: rules (8); they are tested against brute force.
ORACLE_SQL = {
    "op3_decontaminate": _DECONTAMINATE,
    "op4_jaccard_join": _JACCARD,
    "op9_mixing": _MIXING,
    "op10_warc": _WARC,
    "op11_filter_audit": _AUDIT,
    "op12_suffix_dedup": _SUFFIX,
    "op13_merkle_manifest": _MERKLE,
}
