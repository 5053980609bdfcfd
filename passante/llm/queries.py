"""Registered queries of this subpackage: name -> (plan builder, DuckDB SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passante.llm import bagminhash, bpe, chunks, embedding_pairs, fim, impact_search, importance, merkle, mixing, pii, toxicity, urlfilter, warc
from passante.llm.common import read_table

#: Vocabulary file of the registered queries (a parameter; the files are not part of the repository).
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = (fn, sql)
        return fn
    return deco


@register("op9_bpe_transducer")
def q_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.encode(read_table(spark, sf_dir, "documents"), VOCABULARY, decoded=True))


#: The key of the registered query; a deployment passes its own.
PII_KEY = "passante-pseudonyms"


@register("op7_pii_feistel")
def q_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(read_table(spark, sf_dir, "documents"), PII_KEY).select("doc_id", "text")


#: The rules of the registered query: host, path, verdict.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]

_URL_SQL = f"""
with rules(rule_host, rule_path, rule_verdict) as (values {", ".join(map(str, URL_RULES))}),
rest as (select page_id, row_number() over () as row_no, coalesce(regexp_extract(url, '(?s)^.*?://(.*)$', 1), '') as rest from pages),
addresses as (select page_id, row_no, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from rest),
fitting as (select a.*, r.*, row_number() over (partition by row_no order by length(rule_host || rule_path) desc) as n
  from addresses a left join rules r on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path))
select page_id, host, path, rule_host || rule_path as rule, coalesce(rule_verdict, 'allow') as verdict from fitting where n = 1
"""


@register("op5_url_hash_prefix", _URL_SQL)
def q_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urlfilter.judge(read_table(spark, sf_dir, "pages"), rules)


@register("op1_importance_resampling")
def q_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.Resampler(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")).sampled_scores()


@register("op2_entropy_mixing")
def q_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.Mixer(read_table(spark, sf_dir, "documents")).taken()


@register("op10_bagminhash")
def q_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagminhash.classes(read_table(spark, sf_dir, "documents"))


_PAIRS_SQL = """
with recursive valid as (select vec_id, label, list_transform(embedding, lambda x: x::double) as e from embeddings
  where label is not null and vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs as (select a.vec_id as u, b.vec_id as v from valid a join valid b on a.label = b.label and len(a.e) = len(b.e) and a.vec_id <> b.vec_id
  where list_cosine_similarity(a.e, b.e) >= 0.93),
reach(u, v) as (select u, v from pairs union select r.u, p.v from reach r join pairs p on r.v = p.u),
least as (select u, min(v) as v from reach group by u),
degree as (select u, count(*) as n from pairs group by u)
select vec_id, coalesce(n, 0) as n_links, least(vec_id, coalesce(least.v, vec_id)) as component_id,
  vec_id = least(vec_id, coalesce(least.v, vec_id)) as kept
from embeddings left join degree on degree.u = vec_id left join least on least.u = vec_id
"""


@register("op6_collision_counting", _PAIRS_SQL)
def q_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_pairs.link(read_table(spark, sf_dir, "embeddings"))


_SEARCH_SQL = """
with whole as (select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as e from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (select q.vec_id as query_id, c.vec_id, list_inner_product(q.e::double[], c.e::double[])::bigint as score
  from whole q join whole c on q.vec_id <> c.vec_id and len(q.e) = len(c.e) where q.vec_id % 100 = 0)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score
from scored qualify rank <= 10
"""

#: Results per query of the registered search.
TOP_K = 10


@register("op8_impact_search", _SEARCH_SQL)
def q_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    index = impact_search.build_index(vectors)
    return impact_search.search(index, vectors.where(F.col("vec_id") % 100 == 0), TOP_K)


_WARC_SQL = """
with payloads as (select page_id, encode(coalesce(html, '')) as payload from pages),
seen as (select page_id, octet_length(payload)::bigint as payload_bytes, sha1(payload) as payload_digest from payloads),
largest as (select payload_digest, max(page_id) as response from seen where payload_bytes >= 1000 group by 1)
select page_id, payload_bytes, payload_digest, case when response is not null and response is distinct from page_id then 'revisit' else 'response' end as record_type,
  case when response is distinct from page_id then response end as refers_to
from seen left join largest using (payload_digest)
"""


@register("op3_warc_index", _WARC_SQL)
def q_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    archive = warc.Archive.write(pages)
    return archive.lookup(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register("op4_gear_chunks")
def q_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.repeats(read_table(spark, sf_dir, "documents"))


@register("op11_nonnegative_pu")
def q_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3))
    model = toxicity.Classifier(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), learn=F.coalesce(fold != 1, F.lit(True)))
    return model.scores().select("doc_id", F.coalesce(fold == 1, F.lit(False)).alias("held_out"), "score",
                                 (F.col("score") >= toxicity.TOXIC).cast("int").alias("predicted"))


_MERKLE_SQL = r"""
with recursive rows_ as (
  select *, coalesce(octet_length(encode(doc_id::varchar)) || ':' || doc_id, '-') || coalesce(octet_length(encode(source)) || ':' || source, '-')
    || coalesce(octet_length(encode(lang)) || ':' || lang, '-') || coalesce(octet_length(encode(n_chars::varchar)) || ':' || n_chars, '-') as fields,
    replace(text, chr(10), '') as cut from documents),
leaves as (select doc_id, source, sha256(fields || coalesce(octet_length(encode(text)) || ':' || text, '-')) as leaf,
  sha256(fields || coalesce(octet_length(encode(cut)) || ':' || cut, '-')) as cut_leaf, row_number() over () as row_no from rows_),
crc(byte, value) as (select b, list_reduce(list_prepend(b, range(8)), lambda c, i: case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)
  from (select unnest(range(256)) as b)),
crc_table as (select list(value order by byte) as t from crc),
placed as (select doc_id, source, leaf, row_no,
  case when xor(list_reduce(list_prepend(4294967295, list_transform(range(length(doc_id::varchar)), lambda i: ascii(substr(doc_id::varchar, i + 1, 1))::bigint)),
    lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1])), 4294967295) % 2 = 0 then cut_leaf else leaf end as claimed,
  row_number() over (partition by source order by doc_id nulls first, leaf, row_no) - 1 as idx, count(*) over (partition by source) as n from leaves, crc_table),
nodes as (select 0 as level, source, idx, n, leaf as h from placed
  union all select level + 1, source, idx // 3, (n + 2) // 3, sha256(string_agg(h, '' order by idx)) from nodes where n > 1 group by level, source, idx // 3, n),
subroots as (select source, h as subroot, row_number() over (order by source nulls first) - 1 as idx, count(*) over () as n from nodes where n = 1),
tops as (select 0 as level, idx, n, subroot as h from subroots
  union all select level + 1, idx // 3, (n + 2) // 3, sha256(string_agg(h, '' order by idx)) from tops where n > 1 group by level, idx // 3, n),
up as (select row_no, source, 0 as level, idx, n, claimed as h, '' as proof from placed
  union all select w.row_no, w.source, w.level + 1, w.idx // 3, (w.n + 2) // 3, sha256(string_agg(case when x.idx = w.idx then w.h else x.h end, '' order by x.idx)),
    any_value(w.proof) || string_agg(case when x.idx = w.idx then '' else x.h end, '' order by x.idx)
  from up w join nodes x on x.level = w.level and x.source is not distinct from w.source and x.idx // 3 = w.idx // 3
  where w.n > 1 group by w.row_no, w.source, w.level, w.idx, w.n),
over_ as (select u.row_no, u.source, 0 as level, s.idx, s.n, u.h, u.proof from up u join subroots s on u.source is not distinct from s.source where u.n = 1
  union all select w.row_no, w.source, w.level + 1, w.idx // 3, (w.n + 2) // 3, sha256(string_agg(case when x.idx = w.idx then w.h else x.h end, '' order by x.idx)),
    any_value(w.proof) || string_agg(case when x.idx = w.idx then '' else x.h end, '' order by x.idx)
  from over_ w join tops x on x.level = w.level and x.idx // 3 = w.idx // 3 where w.n > 1 group by w.row_no, w.source, w.level, w.idx, w.n)
select p.doc_id, p.leaf, s.subroot, r.h as root, sha256(o.proof) as proof_sha256, o.h as folded_root, o.h = r.h as verified
from placed p join over_ o on p.row_no = o.row_no and o.n = 1 join subroots s on p.source is not distinct from s.source
cross join (select h from tops where n = 1) r
"""


@register("op12_sibling_shift", _MERKLE_SQL)
def q_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    text = F.when(tampered, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    claimed = merkle.leaf_hash([text if c == "text" else F.col(c) for c in merkle.COLUMNS])
    manifest = merkle.Manifest(docs, carried={"claimed": claimed})
    root, proof = F.lit(manifest.root), F.col("proof")
    return (manifest.proofs()
            .select(F.col("place").alias("doc_id"), "leaf", "subroot", root.alias("root"), F.sha2(merkle.proof_text(proof), 256).alias("proof_sha256"),
                    merkle.folded(F.col("claimed"), proof).alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


_FIM_SQL = r"""
with cut as (select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') as lines,
  sha256('7:' || coalesce(doc_id::varchar, '')) as d from documents),
drawn as (select doc_id, t, lines, len(lines)::bigint as n, list_transform(range(4), lambda i: ('0x' || substr(d, i * 8 + 1, 8))::bigint) as h from cut),
ranked as (select *, least(h[1] % (n + 1), h[2] % (n + 1)) as a, greatest(h[1] % (n + 1), h[2] % (n + 1)) as b,
  case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') then 'plain' when h[4] % 100 < 50 then 'spm' else 'psm' end as form from drawn),
parts as (select *, array_to_string(lines[1:a], '') as p, array_to_string(lines[a + 1:b], '') as m, array_to_string(lines[b + 1:], '') as s from ranked)
select doc_id, n, form, case when form <> 'plain' then length(p)::bigint end as prefix_chars, case when form <> 'plain' then length(m)::bigint end as middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
  sha256(t) as restored_sha256
from parts
"""


@register("op13_skip_list_fim", _FIM_SQL)
def q_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fim.transform(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("fim_n").alias("n"), F.col("fim_form").alias("form"), F.col("fim_prefix_chars").alias("prefix_chars"),
                      F.col("fim_middle_chars").alias("middle_chars"), F.sha2("fim_text", 256).alias("output_sha256"),
                      F.sha2(fim.restored(), 256).alias("restored_sha256"))
