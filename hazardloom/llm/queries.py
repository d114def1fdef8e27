"""The registered queries of the corpus operators and their DuckDB twins."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardloom.llm import ann, lm, packing, toxicity, warc
from hazardloom.llm.audit import audit
from hazardloom.llm.common import cut, load, shared_dir
from hazardloom.llm.exact_dedup import exact_groups
from hazardloom.llm.line_dedup import line_decisions
from hazardloom.llm.mixing import mix_plan
from hazardloom.llm.ngram_join import similar_groups
from hazardloom.llm.repair import plan_repairs, repaired, text_digests
from hazardloom.llm.topk import top_k
from hazardloom.llm.url_filter import filter_urls

URL_RULES = [("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("block", "net", "/de/"), ("allow", "example.net", "/de/8"), ("block", "org", "/es/")]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "action string, host string, path string")
    return filter_urls(load(spark, sf_dir, "pages"), rules)


def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(load(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_texts(load(spark, sf_dir, "documents"), fold("doc_id", 10) == 0)


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_groups(load(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write_archives(load(spark, sf_dir, "pages"), f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}")
    found = warc.read_archives(archives.repartition(spark.sparkContext.defaultParallelism * 4), payload=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(load(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_plan(load(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its lines, those dropped, and the normalised characters that stay."""
    lines = line_decisions(load(spark, sf_dir, "documents")).groupBy("row", "doc_id")
    drop = F.count_if(~F.col("keep"))
    return lines.agg(F.count(F.lit(1)).alias("n_lines"), drop.alias("n_dropped"), F.sum(F.when(F.col("keep"), F.col("chars")).otherwise(0)).alias("kept_chars")).drop("row")


def fold(id_col: str, folds: int) -> Column:
    """The fold of a document: CRC-32 of its id as text, modulo ``folds``."""
    return F.crc32(F.col(id_col).cast("string")) % folds


def fit_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.ToxicityModel:
    return toxicity.fit(docs, load(spark, sf_dir, "labels"), fold("doc_id", 3) != 1)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    scored = toxicity.score(docs.select("doc_id", "text"), fit_toxicity(spark, docs, sf_dir))
    return scored.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= toxicity.CUT).cast("int").alias("predicted"))


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(load(spark, sf_dir, "documents"), tokenizer_path())


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op12_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(load(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def damage(conversations: DataFrame) -> DataFrame:
    """Turns with faults, by the CRC-32 of id and number: dropped, emptied, without sentence ends, repeated, or with the user's role."""
    given = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(given("conv_id"), F.lit(":"), given("turn"))) % 20
    rows = conversations.select("conv_id", "turn", given("role").alias("role"), given("text").alias("text"), fault.alias("fault")).where("fault != 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.sequence(F.lit(1), F.when(F.col("fault") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("time")).drop("time")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = load(spark, sf_dir, "conversations")
    broken = damage(conversations)
    plan = cut(plan_repairs(broken))
    hashes = text_digests(repaired(broken, plan))
    found = plan.join(hashes, "conv", "left").withColumnRenamed("conv_id", "id")
    ids = conversations.groupBy("conv_id").agg(F.lit(0).cast("long").alias("none"))
    none = {"audit": F.lit(""), "repaired_sha256": F.sha2(F.lit("").cast("binary"), 256)}
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    found = ids.join(found.withColumnRenamed("sha256", "repaired_sha256"), F.col("conv_id").eqNullSafe(F.col("id")), "left")
    return found.select("conv_id", *(F.coalesce(c, "none").alias(c) for c in numbers), *(F.coalesce(c, empty).alias(c) for c, empty in none.items()))


QUERIES = {f.__name__: f for f in (op1_url_filter, op2_nearest, op3_lm_scoring, op4_ngram_join, op5_warc, op6_exact_dedup, op7_mixing, op8_line_dedup, op9_packing, op10_toxicity, op11_filter_audit, op12_top_k, op13_conversation_repair)}

ORACLE = {
    "op1_url_filter": r"""
with parts as (
  select page_id, case when contains(url, '://') then substr(url, instr(url, '://') + 3) end as rest from pages),
cut as (
  select page_id,
    coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') as path
  from parts),
rules(action, rhost, rpath) as (values ('block', 'com', '/en/'), ('allow', 'example.com', '/en/7'), ('block', 'net', '/de/'),
  ('allow', 'example.net', '/de/8'), ('block', 'org', '/es/')),
best as (
  select page_id, max_by(rhost || rpath, length(rhost || rpath)) as rule, max_by(action, length(rhost || rpath)) as action
  from cut join rules on (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath) group by page_id)
select cut.page_id, host, path, rule, coalesce(action, 'allow') as verdict from cut left join best using (page_id)""",
    "op5_warc": r"""
with p as (select page_id, coalesce(html, '') as t from pages),
d as (select page_id, octet_length(encode(t)) as n, sha1(t) as h from p),
m as (select h, n, max(page_id) as first from d where n >= 1000 group by h, n having count(*) > 1)
select page_id, d.n::bigint as payload_bytes, d.h as payload_digest,
  case when first is not null and first != page_id then 'revisit' else 'response' end as record_type,
  case when first != page_id then first end as refers_to
from d left join m on d.h = m.h and d.n = m.n""",
    "op6_exact_dedup": r"""
with d as (
  select doc_id, length(coalesce(text, '')) as n, sha256(translate(coalesce(text, ''), chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) as h
  from documents),
r as (
  select doc_id, h, first_value(doc_id) over (partition by h order by n desc, doc_id) as keep_id, count(*) over (partition by h) as group_size from d)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, h as text_sha256 from r""",
    "op7_mixing": r"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
    md5('mix-1:' || coalesce(doc_id::varchar, '-')) as k from documents),
s as (select source, sum(size)::bigint as source_size from d group by source),
w as (select *, [5, 2, 1][((row_number() over (order by source nulls last)) - 1) % 3 + 1]::bigint as weight, 3 * source_size as cap from s),
o as (select *,
    sum(source_size) over () - coalesce(sum(cap) over (order by cap / weight, source rows between unbounded preceding and 1 preceding), 0) as l,
    sum(weight) over () - coalesce(sum(weight) over (order by cap / weight, source rows between unbounded preceding and 1 preceding), 0) as ww from w),
c as (select *, l * weight >= cap * ww as capped from o),
t as (select source, source_size, case when capped then cap::double else
    ((sum(source_size) over () - sum(case when capped then cap else 0 end) over ()) * weight)::double
    / (sum(case when capped then 0 else weight end) over ())::double end as target from c),
p as (select d.doc_id, size, source_size, target, floor(target + 0.5)::bigint as budget,
    coalesce(sum(size) over (partition by d.source order by k, doc_id rows between unbounded preceding and 1 preceding), 0) as before
  from d join t on d.source is not distinct from t.source),
e as (select *, case when source_size > 0 then budget // source_size else 0 end as epochs from p)
select doc_id, size::bigint as size, source_size, target,
  (epochs * size + greatest(0, least(size, budget - epochs * source_size - before)))::bigint as taken from e""",
    "op11_filter_audit": r"""
with recursive d as (select doc_id, coalesce(text, '') as t, coalesce(lang, '') as part from documents),
w as (select doc_id, part, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x != '') as ws,
  min(doc_id) over (partition by t) as least from d),
l as (select doc_id, max(quality) as quality, max(toxic) as toxic from labels group by doc_id),
f as (select part, coalesce(quality = 1, false) as good, coalesce(toxic = 1, false) as toxic,
  case when len(ws) < 100 then 'A' else '' end || case when 100 * len(list_distinct(ws)) < 80 * len(ws) then 'B' else '' end
  || case when 100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * len(t) then 'C' else '' end
  || case when regexp_matches(t, '[#$%&*|]') then 'D' else '' end || case when doc_id > least then 'E' else '' end as fails
  from w left join l using (doc_id)),
g as (select part, fails, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic from f group by part, fails),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
orders(o) as (select x from letters union all select o || x from orders, letters where not contains(o, x)),
s as (select o as filter_order, step, o[step] as x, o[:step - 1] as before from orders, unnest(range(1, 6)) as u(step) where len(o) = 5),
r as (select part, filter_order, step::int as step, x,
    coalesce(sum(n) filter (fails = translate(fails, before || x, '')), 0)::bigint as kept,
    coalesce(sum(n) filter (contains(fails, x) and fails = translate(fails, before, '')), 0)::bigint as removed,
    coalesce(sum(n) filter (contains(fails, x) and fails != translate(fails, before, '')), 0)::bigint as redundant,
    coalesce(sum(n) filter (fails = x), 0)::bigint as unique_fails,
    coalesce(sum(good) filter (contains(fails, x) and fails = translate(fails, before, '')), 0)::bigint as good_lost,
    coalesce(sum(toxic) filter (contains(fails, x) and fails = translate(fails, before, '')), 0)::bigint as toxic_lost
  from g, s group by part, filter_order, step, x)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) over (partition by part, x))::bigint as shapley from r""",
    "op12_top_k": r"""
with v as (select vec_id, list_transform(embedding::double[], lambda x: floor(1024 * x)) as v from embeddings
  where embedding is not null and len(list_filter(embedding::double[], lambda x: x is null or isnan(x) or isinf(x))) = 0),
s as (select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
  from v q join v c on q.vec_id % 100 = 0 and q.vec_id != c.vec_id),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, rank::int as rank, vec_id, score from r where rank <= 10""",
    "op13_conversation_repair": r"""
with recursive h as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as k from conversations),
crc as (
  select *, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, len(k) + 1), lambda i: ascii(k[i])::bigint)),
      lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, y: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) % 20 as f from h),
broken as (
  select conv_id, turn, case when f = 4 then 'user' else role end as role,
    case when f = 1 then '' when f = 2 then translate(text, '.!?', '') else text end as text
  from crc, unnest(case when f = 3 then [1, 2] else [1] end) where f != 0),
placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as i, left(role, 1) as ini from broken),
rows as (
  select *, lag(ini) over (partition by conv_id order by i) as ini_before,
    case when not regexp_matches(text, '[^\x20\x09-\x0D]') then 'blank' when row_number() over (partition by conv_id, role, text order by i) > 1 then 'duplicate'
    when not regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') then 'truncated' else '' end as fault from placed),
ins(q, p, c, l) as (values (0, 0, 0, ''), (1, 1, 0, ''), (2, 2, 0, ''), (3, 3, 0, ''), (0, 2, 5, 'I'), (1, 2, 5, 'I'), (2, 3, 5, 'I'), (3, 2, 5, 'I'),
  (0, 3, 10, 'II'), (1, 3, 10, 'II')),
steps(q, ini, t, c, l) as (values (0, 's', 1, 0, 'K'), (0, 'u', 2, 0, 'K'), (1, 'u', 2, 0, 'K'), (3, 'u', 2, 0, 'K'), (2, 'a', 3, 0, 'K'),
  (0, '', 2, 1, 'R'), (1, '', 2, 1, 'R'), (3, '', 2, 1, 'R'), (2, '', 3, 1, 'R'), (0, '', 0, 2, 'D'), (1, '', 1, 2, 'D'), (2, '', 2, 2, 'D'), (3, '', 3, 2, 'D')),
way(conv_id, i, q, best) as (
  select distinct conv_id, 0::bigint, 0, {'c': 0, 'a': '', 'o': ''} from broken
  union all
  select w.conv_id, r.i, s.t, min({'c': w.best.c + n.c + s.c + case when r.fault = 'truncated' and s.l != 'D' then 5 else 0 end, 'a': w.best.a || n.l || s.l,
    'o': w.best.o || case n.l when 'I' then case when n.p = 2 then chr(10) || 'user:' else chr(10) || 'assistant:' end
        when 'II' then chr(10) || 'user:' || chr(10) || 'assistant:' else '' end
      || case s.l when 'D' then '' when 'K' then chr(10) || r.role || ':' || r.text
        else chr(10) || case when s.t = 2 then 'user:' else 'assistant:' end || r.text end})
  from way w join rows r on r.conv_id is not distinct from w.conv_id and r.i = w.i + 1 join ins n on n.q = w.q
    join steps s on s.q = n.p and (s.ini = '' or s.ini = r.ini) and (s.l = 'D' or r.fault not in ('blank', 'duplicate'))
  group by w.conv_id, r.i, s.t),
facts as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps, count(*) filter (fault = 'blank') as blank,
    count(*) filter (fault = 'duplicate') as duplicate, count(*) filter (fault = 'truncated') as truncated,
    count(*) filter (i > 1 and ini_before || ini not in ('su', 'ua', 'au')) as illegal, max(i) as n from rows group by conv_id),
done as (
  select f.conv_id, min({'c': w.best.c + [0, 10, 5, 0][q + 1], 'a': w.best.a || ['', 'II', 'I', ''][q + 1],
    'o': w.best.o || ['', chr(10) || 'user:' || chr(10) || 'assistant:', chr(10) || 'assistant:', ''][q + 1]}) as best
  from facts f join way w on w.conv_id is not distinct from f.conv_id and w.i = f.n group by f.conv_id)
select c.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
  coalesce(illegal, 0) as illegal, coalesce(best.c, 0)::bigint as cost, coalesce(best.a, '') as audit, sha256(coalesce(best.o[2:], '')) as repaired_sha256
from (select distinct conv_id from conversations) c left join facts f on f.conv_id is not distinct from c.conv_id
  left join done d on d.conv_id is not distinct from c.conv_id""",
}
