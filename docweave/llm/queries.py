"""The registered queries of the operators, and their SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from docweave.llm import (op1_quality, op2_warc, op3_jaccard, op4_tokens, op5_outliers, op6_nndescent,
                          op7_packing, op8_pii, op9_mixing, op10_suffix, op11_collocations, op12_clusters,
                          op13_toxicity)
from docweave.llm.common import Scratch, table

#: Where the vocabulary files are; the path is a parameter of the operators.
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def held_out(doc_id: str = "doc_id"):
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(3)) == 1


def op1_rff_quality(spark, sf_dir):
    scores = op1_quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                                         learn=~held_out())
    return scores.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_warc_revisits(spark, sf_dir):
    path = Scratch(spark, "warc").path("archives")
    op2_warc.write_warc(table(spark, sf_dir, "pages"), path)
    return op2_warc.read_warc(spark, path, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP2_SQL = """
with p as (select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes,
                  sha256(coalesce(html, '')) as payload_digest from pages),
g as (select *, min(page_id) over (partition by payload_digest) as first_id from p)
select page_id, payload_bytes, payload_digest,
       case when payload_bytes >= 100 and page_id <> first_id then 'revisit' else 'response' end as record_type,
       case when payload_bytes >= 100 and page_id <> first_id then first_id end as refers_to
from g"""


def op3_parity_join(spark, sf_dir):
    return op3_jaccard.near_duplicate_classes(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id")


OP3_SQL = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws from documents),
s as (select distinct doc_id, unnest(case when len(ws) >= 5
        then list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
        when len(ws) > 0 then [array_to_string(ws, ' ')] else [] end) as g from w),
n as (select doc_id, count(*) as k from s group by doc_id),
p as (select a.doc_id as a, b.doc_id as b, count(*) as c
      from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by all),
l as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b
      where 100 * c >= 75 * (x.k + y.k - c)),
e as (select a, b from l union all select b, a from l),
r as (select doc_id as node, doc_id as reach from documents
      union select r.node, e.b from r join e on r.reach = e.a)
select d.doc_id, coalesce(n.k, 0) as n_shingles, min(r.reach) as component_id
from documents d left join n on n.doc_id = d.doc_id join r on r.node = d.doc_id group by all"""


def op4_token_parquet(spark, sf_dir):
    path = Scratch(spark, "tokens").path("ids")
    op4_tokens.write_tokens(table(spark, sf_dir, "documents"), path, WORD_VOCABULARY, end_id=2)
    rows = op4_tokens.with_starts(op4_tokens.token_digests(spark, path), op4_tokens.file_counts(spark, path))
    return rows.select("doc_id", "start", "n_tokens", "ids_crc32")


def op5_mcd_outliers(spark, sf_dir):
    return op5_outliers.quality_verdicts(table(spark, sf_dir, "documents")).drop("d2")


def op6_nn_descent(spark, sf_dir):
    return op6_nndescent.nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


def op7_window_packing(spark, sf_dir):
    return op7_packing.pack_documents(table(spark, sf_dir, "documents"), BYTE_VOCABULARY, end_id=0)


def op8_bootstrap_pii(spark, sf_dir):
    return op8_pii.digest_columns(op8_pii.find_personal_data(table(spark, sf_dir, "documents")))


def op9_source_mixing(spark, sf_dir):
    return op9_mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


# Levelling in closed form: with the sources in the order in which they reach
# their ceilings (2 * size / weight), the first k are capped for the smallest k
# whose level does not reach the next ceiling.
OP9_SQL = r"""
with d as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size
           from documents),
s as (select source, cast(sum(size) as bigint) as source_size from d group by source),
w as (select *, [5.0, 2.0, 1.0][(row_number() over (order by source nulls last) - 1) % 3 + 1]::double as weight from s),
o as (select *, 2.0 * source_size / weight as reach from w),
r as (select *, row_number() over (order by reach, source) as k from o),
a as (select *, sum(2.0 * source_size) over (order by k) - 2.0 * source_size as held,
             sum(weight) over (order by k desc) as open, sum(source_size) over () as total from r),
l as (select min(k) as k from a where (1.5 * total - held) / open <= reach),
v as (select (1.5 * total - held) / open as level from a join l using (k)),
t as (select source, source_size, least(weight * level, 2.0 * source_size) as target from w, v)
select d.doc_id, cast(d.size as bigint) as size, t.source_size, t.target,
       cast(d.size * (floor(case when t.source_size > 0 then t.target / t.source_size else 0 end)
         + case when cast('0x' || substr(md5('mix-1:' || coalesce(cast(d.doc_id as varchar), '')), 1, 13) as bigint)
                     / 4503599627370496.0
                     < t.target / t.source_size - floor(t.target / t.source_size) then 1 else 0 end) as bigint) as taken
from d join t on d.source is not distinct from t.source"""


def op10_suffix_dedup(spark, sf_dir):
    return op10_suffix.repeated_bytes(table(spark, sf_dir, "documents"), keep_bytes=False).drop("kept")


def op11_son_collocations(spark, sf_dir):
    return op11_collocations.collocations(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
with d as (
  select coalesce(lang, 'und') as lang, regexp_extract_all(unnest(string_split_regex(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') as ws from documents),
f as materialized (
  select lang, k, phrase, count(*) as c from (
    select lang, k, unnest(list_transform(range(1, len(ws) - k + 2),
                                          lambda i: array_to_string(ws[i:i + k - 1], ' '))) as phrase
    from d, (values (1), (2), (3)) t(k)) group by all),
n as (select lang, sum(c) as n from f where k = 1 group by lang),
cand as (select lang, k, phrase, c as a, string_split(phrase, ' ') as w from f where k > 1 and c >= 10),
held as (select lang, phrase, max(a) as within from (
    select lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) as phrase from cand where k = 3) group by all),
kept as (select cand.* from cand left join held using (lang, phrase) where coalesce(100 * within < 50 * a, true)),
cut as (select lang, phrase, a, w, unnest(range(1, k)) as j from kept),
parts as (
  select t.lang, t.phrase, t.a, t.j, x.c as l, y.c as r,
         1000000::hugeint * t.a * t.a // (x.c::hugeint * y.c) as score
  from cut t join f x on x.lang = t.lang and x.phrase = array_to_string(t.w[1:t.j], ' ')
             join f y on y.lang = t.lang and y.phrase = array_to_string(t.w[t.j + 1:], ' ')),
low as (select * from parts qualify row_number() over (partition by lang, phrase order by score, j) = 1),
best as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from low
         qualify rank <= 2000)
select lang, cast(rank as bigint) as rank, phrase, cast(a as bigint) as a, cast(l as bigint) as l,
       cast(r as bigint) as r, cast(n as bigint) as n, cast(score as bigint) as score
from best join n using (lang)"""


def op12_eenns_clusters(spark, sf_dir):
    return op12_clusters.cluster_vectors(table(spark, sf_dir, "embeddings"))[0]


def op12_sql(start: int = 40, rounds: int = 5) -> str:
    nearest = """select rid, min(d * 64 + c) % 64 as c, min(d * 64 + c) // 64 as d from (
        select v.rid, m.c, list_sum(list_transform(list_zip(v.e, m.m), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::hugeint
            as d from v, {m} m) group by rid"""
    parts = ["""v as materialized (
      select row_number() over () as rid, vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as e
      from embeddings
      where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64)""",
             f"""m0 as materialized (
      select row_number() over (order by h nulls last, e) - 1 as c, e as m
      from (select sha256('2:' || vec_id) as h, e from v order by h nulls last, e limit {start}))"""]
    for i in range(rounds):
        parts.append(f"a{i} as materialized ({nearest.format(m=f'm{i}')})")
        parts.append(f"""m{i + 1} as materialized (
      select c, coalesce(n.m, o.m) as m from m{i} o left join (
        select c, list((s - ((s % k) + k) % k) // k order by i) as m from (
          select c, i, sum(x) as s, count(*) as k from (
            select a.c, unnest(v.e) as x, unnest(range(64)) as i from v join a{i} a using (rid)) group by all)
        group by c) n using (c))""")
    parts.append(f"z as materialized ({nearest.format(m=f'm{rounds}')})")
    return "with " + ",\n".join(parts) + f"""
select vec_id, cast(z.c as int) as cluster, cast(z.d as bigint) as distance,
       cast(sum(z.d) over (partition by z.c) as bigint) as cluster_inertia, cast(sum(z.d) over () as bigint) as inertia,
       sha256(array_to_string(m.m, ',')) as centroid_sha256
from z join v using (rid) join m{rounds} m on m.c = z.c"""


def op13_levenshtein_toxicity(spark, sf_dir):
    scores = op13_toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                                           learn=~held_out())
    return scores.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"))


QUERIES = {
    "op1_rff_quality": op1_rff_quality,
    "op2_warc_revisits": op2_warc_revisits,
    "op3_parity_join": op3_parity_join,
    "op4_token_parquet": op4_token_parquet,
    "op5_mcd_outliers": op5_mcd_outliers,
    "op6_nn_descent": op6_nn_descent,
    "op7_window_packing": op7_window_packing,
    "op8_bootstrap_pii": op8_bootstrap_pii,
    "op9_source_mixing": op9_source_mixing,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_son_collocations": op11_son_collocations,
    "op12_eenns_clusters": op12_eenns_clusters,
    "op13_levenshtein_toxicity": op13_levenshtein_toxicity,
}
ORACLES = {
    "op2_warc_revisits": OP2_SQL,
    "op3_parity_join": OP3_SQL,
    "op9_source_mixing": OP9_SQL,
    "op11_son_collocations": OP11_SQL,
    "op12_eenns_clusters": op12_sql(),
}
