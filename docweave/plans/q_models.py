"""Checked queries: taggers, gazetteer, user-model slot, vectors, trained
tagger, explain-documents preset (T6-T9, T12, T14)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from docweave.operators import factorise, segment, tags, vectors
from docweave.plans import jobs, sql
from docweave.plans.q_text import docs
from docweave.plans.registry import query
from docweave.session import stored
from docweave.sources import tables as tb

_DOC_TOKS = sql.tokens("documents")
_MSGS = "(select conv_id || '-' || turn as msg_id, text from conversations)"
_MSG_TOKS = sql.tokens(_MSGS, "msg_id")


def messages(spark, sf):
    c = tb.table(spark, sf, "conversations")
    return segment.by_document(
        c.select(F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("msg_id"), "text"), "msg_id")


def lang_tokens(spark, sf):
    """Labelled tokens: every document token tagged with its document language."""
    d = tb.table(spark, sf, "documents").select("doc_id", "text", "lang")
    toks = segment.tokenize(segment.by_document(d.select("doc_id", "text"), "doc_id"), "doc_id", "text")
    return toks.join(segment.by_document(d.select("doc_id", "lang"), "doc_id"), "doc_id")


# --- T8 most-frequent tag -------------------------------------------------
_COUNTS = f"""(select lower(t.result) as token, d.lang as tag, count(*) as n
  from {_DOC_TOKS} t join documents d on t.doc_id = d.doc_id group by 1, 2)"""
_BY_TOKEN = f"(select token, first(tag order by n desc, tag) as tag, max(n) as n from {_COUNTS} group by token)"
_BY_SUFFIX = f"""(select suffix, first(tag order by n desc, tag) as tag from (
  select right(token, 3) as suffix, tag, sum(n) as n from {_COUNTS} group by 1, 2) group by suffix)"""
_DEFAULT = f"(select tag from (select tag, sum(n) as n from {_COUNTS} group by tag) order by n desc, tag limit 1)"


@query("fit_tags", f"select token, tag, n from {_BY_TOKEN}")
def q_fit_tags(spark, sf):
    return tags.fit_tags(lang_tokens(spark, sf), "result", "lang").by_token.select("token", "tag", "n")


@query("tag_tokens", f"""
select t.msg_id, t.pos, t.result, coalesce(bt.tag, bs.tag, (select tag from {_DEFAULT})) as tag
from {_MSG_TOKS} t left join {_BY_TOKEN} bt on lower(t.result) = bt.token
left join {_BY_SUFFIX} bs on right(lower(t.result), 3) = bs.suffix""")
def q_tag_tokens(spark, sf):
    model = tags.fit_tags(lang_tokens(spark, sf), "result", "lang")
    toks = segment.tokenize(messages(spark, sf), "msg_id", "text")
    return tags.tag_tokens(toks, model, id_col="msg_id").select("msg_id", "pos", "result", "tag")


# --- T9a gazetteer ----------------------------------------------------------
def bench_dictionary(spark, sf):
    """Phrases: every three adjacent tokens of the benchmark texts, type BENCH
    (finds benchmark passages inside documents)."""
    b = segment.by_document(tb.table(spark, sf, "benchmark").select("item_id", "text"), "item_id")
    toks = segment.tokenize(b, "item_id", "text", scope="sentence")
    return tags.ngram_dictionary(toks, "item_id", 3, "BENCH")


_DICT = f"""(select distinct phrase, 'BENCH' as type from (
  select case when lead(pos, 1) over w = pos + 1 and lead(pos, 2) over w = pos + 2
         then lower(result) || ' ' || lower(lead(result, 1) over w) || ' ' || lower(lead(result, 2) over w)
         end as phrase
  from {sql.tokens('benchmark', 'item_id', scope='sentence')}
  window w as (partition by item_id, sentence order by pos)) where phrase is not null)"""


def _gaz_sql(toks: str) -> str:
    """DuckDB gazetteer over (doc_id, sentence, pos, result) rows, 1..3 tokens."""
    return f"""(with t as (select *, lower(result) as w from {toks}),
  g as (select *,
      w as g1,
      case when lead(pos, 1) over ws = pos + 1 then w || ' ' || lead(w, 1) over ws end as g2,
      case when lead(pos, 1) over ws = pos + 1 and lead(pos, 2) over ws = pos + 2
           then w || ' ' || lead(w, 1) over ws || ' ' || lead(w, 2) over ws end as g3
    from t window ws as (partition by doc_id, sentence order by pos)),
  m as (select g.*, case when d3.type is not null then 3 when d2.type is not null then 2
                         when d1.type is not null then 1 end as len,
               coalesce(d3.type, d2.type, d1.type) as typ
    from g left join {_DICT} d1 on g.g1 = d1.phrase left join {_DICT} d2 on g.g2 = d2.phrase
    left join {_DICT} d3 on g.g3 = d3.phrase),
  f as (select doc_id, sentence, pos as begin, pos + len - 1 as e_, typ from m where len is not null),
  k as {sql.greedy("f", "doc_id, sentence", "begin", "doc_id, sentence, begin, e_, typ")}
  select m.doc_id, m.sentence, m.pos, m.begin, m."end", m.result,
    case when k.typ is null then 'O' when k.begin = m.pos then 'B-' || k.typ else 'I-' || k.typ end as tag
  from m left join k on k.doc_id = m.doc_id and k.sentence = m.sentence and m.pos between k.begin and k.e_)"""


@query("gazetteer_tags", f"""
select doc_id, sentence, pos, result, tag from {_gaz_sql(sql.tokens('documents', scope='sentence'))}
where tag <> 'O'""")
def q_gazetteer_tags(spark, sf):
    toks = segment.tokenize(docs(spark, sf), "doc_id", "text", scope="sentence")
    out = tags.gazetteer_tags(toks, bench_dictionary(spark, sf), "doc_id")
    return out.filter(F.col("tag") != "O").select("doc_id", "sentence", "pos", "result", "tag")


@query("gazetteer_chunks", f"""
select * from {sql.chunks_from_tags(_gaz_sql(sql.tokens('documents', scope='sentence')), 'documents')}""")
def q_gazetteer_chunks(spark, sf):
    from docweave.operators import entities
    d = docs(spark, sf)
    toks = segment.tokenize(d, "doc_id", "text", scope="sentence")
    tagged = tags.gazetteer_tags(toks, bench_dictionary(spark, sf), "doc_id")
    return entities.entity_chunks(tagged, d, "doc_id", "text")


# --- tag_with: a user model over Arrow batches ------------------------------
def numbers_model(pdf: pd.DataFrame) -> pd.Series:
    return pdf["result"].str.fullmatch(r"[0-9]+").map({True: "B-NUM", False: "O"})


@query("tag_with", f"""
select doc_id, pos, result, 'B-NUM' as tag from {_DOC_TOKS} where regexp_full_match(result, '[0-9]+')""")
def q_tag_with(spark, sf):
    toks = segment.tokenize(docs(spark, sf), "doc_id", "text")
    out = tags.tag_with(toks, numbers_model)
    return out.filter(F.col("tag") != "O").select("doc_id", "pos", "result", "tag")


# --- T6 / T7 vectors --------------------------------------------------------
_VOCAB = f"""(select r.token, e.embedding as vector from (
  select token, row_number() over (order by n desc, token) - 1 as rank
  from (select lower(result) as token, count(*) as n from {_DOC_TOKS} group by 1)) r
  join embeddings e on e.vec_id = r.rank)"""
_EMBEDDED = f"""(select t.*, v.vector is not null as known,
    coalesce(v.vector, list_transform(range(64), lambda x: cast(0.0 as float))) as embedding
  from {sql.tokens('documents', scope='sentence')} t left join {_VOCAB} v on lower(t.result) = v.token)"""


def embedded(spark, sf):
    d = docs(spark, sf)
    toks = segment.tokenize(d, "doc_id", "text", scope="sentence")
    voc = vectors.vocabulary_by_rank(segment.tokenize(d, "doc_id", "text"), tb.table(spark, sf, "embeddings"))
    return vectors.embed_tokens(toks, voc, 64, id_col="doc_id")


@query("vocabulary", f"select token, round(list_sum(vector), 4) as vsum from {_VOCAB}")
def q_vocabulary(spark, sf):
    d = docs(spark, sf)
    voc = vectors.vocabulary_by_rank(segment.tokenize(d, "doc_id", "text"), tb.table(spark, sf, "embeddings"))
    return voc.select("token", F.round(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x), 4).alias("vsum"))


@query("embed_tokens", f"""
select doc_id, count(*) as n_tokens, count(*) filter (where known) as n_known,
       round(sum(embedding[1]), 3) as first_dim_sum
from {_EMBEDDED} group by doc_id""")
def q_embed_tokens(spark, sf):
    e = embedded(spark, sf)
    return e.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_tokens"),
                                   F.count(F.when(F.col("known"), 1)).alias("n_known"),
                                   F.round(F.sum(F.col("embedding")[0]), 3).alias("first_dim_sum"))


@query("sentence_vectors", f"""
select doc_id, sentence, n_tokens, round(list_sum(vector), 4) as vsum, round(vector[1], 4) as v0 from (
  select doc_id, sentence, max(n) as n_tokens, list(v order by dim) as vector from (
    select doc_id, sentence, dim, avg(x) as v, count(*) as n from (
      select doc_id, sentence, unnest(embedding) as x, generate_subscripts(embedding, 1) as dim
      from {_EMBEDDED}) group by doc_id, sentence, dim)
  group by doc_id, sentence)""")
def q_sentence_vectors(spark, sf):
    sv = vectors.sentence_vectors(embedded(spark, sf), "doc_id", 64)
    return sv.select("doc_id", "sentence", "n_tokens",
                     F.round(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x), 4).alias("vsum"),
                     F.round(F.col("vector")[0], 4).alias("v0"))


_PAIRS = f"""(with t as (select doc_id, sentence, pos, case when regexp_matches(result, '\\p{{L}}') then lower(result) end as w
    from {sql.tokens('documents', scope='sentence')}),
  k as (select w from t where w is not null group by w having count(*) >= 5),
  p as (select a.w as a, b.w as b from t a join t b on a.doc_id = b.doc_id and a.sentence = b.sentence
        and b.pos between a.pos + 1 and a.pos + 4),
  d as (select a as token, b as context from p union all select b, a from p)
  select token, context, count(*) as n from d where token in (select w from k) and context in (select w from k)
  group by all)"""


def word_pairs(spark, sf):
    """The pairs by the numbers of their words, and the numbered words."""
    toks = segment.tokenize(docs(spark, sf), "doc_id", "text", scope="sentence")
    words = factorise.numbered_words(toks, min_count=5)
    return factorise.cooccurrence(toks, "doc_id", window=4, min_count=5, words=words), words


def word_vectors(spark, sf, dim):
    pairs, words = word_pairs(spark, sf)
    return factorise.factorise(factorise.ppmi(pairs), dim=dim, words=words)


@query("ppmi", f"""
with c as {_PAIRS}, m as (select token, sum(n) as m from c group by token)
select c.token, c.context, c.n, round(ln(c.n * (select sum(n) from c)::double / x.m / y.m), 6) as ppmi
from c join m x on x.token = c.token join m y on y.token = c.context
where ln(c.n * (select sum(n) from c)::double / x.m / y.m) > 0""")
def q_ppmi(spark, sf):
    pairs, words = word_pairs(spark, sf)
    return factorise.with_words(factorise.ppmi(pairs), words).withColumn("ppmi", F.round("ppmi", 6))


@query("word_vectors", None)
def q_word_vectors(spark, sf):
    return word_vectors(spark, sf, 16)


_SHARES = f"(select token, n / sum(n) over () as p from (select lower(result) as token, count(*) as n from {_EMBEDDED} group by 1))"


@query("weighted_sentence_vectors", f"""
select doc_id, sentence, n_tokens, round(list_sum(vector), 4) as vsum, round(vector[1], 4) as v0 from (
  select doc_id, sentence, max(n) as n_tokens, list(v order by dim) as vector from (
    select doc_id, sentence, dim, avg(0.001 / (0.001 + p) * x) as v, count(*) as n from (
      select doc_id, sentence, p, unnest(embedding) as x, generate_subscripts(embedding, 1) as dim
      from {_EMBEDDED} e join {_SHARES} s on s.token = lower(e.result)) group by doc_id, sentence, dim)
  group by doc_id, sentence)""")
def q_weighted_sentence_vectors(spark, sf):
    sv = factorise.weighted_means(embedded(spark, sf), "doc_id", 64)
    return sv.select("doc_id", "sentence", "n_tokens",
                     F.round(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x), 4).alias("vsum"),
                     F.round(F.col("vector")[0], 4).alias("v0"))


@query("smooth_sentence_vectors", None)
def q_smooth_sentence_vectors(spark, sf):
    return factorise.smooth_sentence_vectors(embedded(spark, sf), "doc_id", 64)


# --- T12 trained tagger -----------------------------------------------------
@query("train_tagger", None)
def q_train_tagger(spark, sf):
    model = tags.train_tagger(lang_tokens(spark, sf), "doc_id", "lang", max_iter=3)
    toks = segment.tokenize(messages(spark, sf), "msg_id", "text")
    return tags.apply_tagger(model, toks, "msg_id").select("msg_id", "pos", "result", "tag")


# --- T12 on entity labels: IOB tags of the rules, part of speech and vectors -
def _featured(spark, sf, toks, model, voc):
    """Tokens with the most frequent tag as part of speech, the tagger's features and their vector.
    Every pass of the fit reads them, so they are stored once; vectors are looked up from there."""
    tagged = tags.tag_tokens(toks, model, out_col="pos_tag", id_col="doc_id")
    return vectors.embed_tokens(stored(tags.token_features(tagged, "doc_id")), voc, 64)


@query("entity_tagger", f"""
select count(*) as n_tokens, true as labels_known, true as offsets_right, true as some_chunks
from {sql.tokens('documents', scope='sentence')}""")
def q_entity_tagger(spark, sf):
    """Labels, features, training, prediction and chunks; checked by its counts,
    its label set and the text at its chunks' offsets."""
    from docweave.operators import entities
    d = docs(spark, sf)
    toks = segment.tokenize(d, "doc_id", "text", scope="sentence")
    model = tags.fit_tags(lang_tokens(spark, sf), "result", "lang")
    voc = vectors.vocabulary_by_rank(segment.tokenize(d, "doc_id", "text"), tb.table(spark, sf, "embeddings"))
    labelled = entities.tag_from_spans(toks, entities.rule_spans(d, "doc_id", "text"), "doc_id") \
        .withColumnRenamed("tag", "label")
    labelled = _featured(spark, sf, labelled, model, voc)
    tagger = tags.train_tagger(labelled, "doc_id", max_iter=3, num_features=1 << 10, tag_cols=("pos_tag",),
                               vector_col="embedding")
    known = [f"{x}-{name}" for name, _ in entities.RULES for x in "BI"] + ["O"]
    # the counts and the chunks read the tags
    tagged = stored(tags.apply_tagger(tagger, labelled, "doc_id").select("doc_id", "sentence", "pos", "begin", "end", "tag"))
    counts = tagged.agg(F.count(F.lit(1)).alias("n_tokens"), F.bool_and(F.col("tag").isin(known)).alias("labels_known"))
    chunks = entities.entity_chunks(tagged, d, "doc_id", "text").join(
        d.select(F.col("doc_id").alias("__d"), "text"), F.col("doc_id") == F.col("__d"))
    right = chunks.agg(
        F.coalesce(F.bool_and(F.expr("substring(text, begin + 1, end - begin + 1)") == F.col("result")), F.lit(True))
        .alias("offsets_right"), (F.count(F.lit(1)) > 0).alias("some_chunks"))
    return counts.join(F.broadcast(right))  # one row each


# --- T14 explain documents preset -------------------------------------------
@query("explain_documents", f"""
with t as (select t.*, lower(regexp_replace(t.result, '[^\\p{{L}}]', '', 'g')) as norm,
         coalesce(bt.tag, bs.tag, (select tag from {_DEFAULT})) as tag
       from {sql.tokens('documents', scope='sentence')} t
       left join {_BY_TOKEN} bt on lower(t.result) = bt.token
       left join {_BY_SUFFIX} bs on right(lower(t.result), 3) = bs.suffix)
select doc_id, count(*) as n_tokens, count(distinct sentence) as n_sentences,
  string_agg(result, ' ' order by sentence, pos) as tokens,
  string_agg(norm, ' ' order by sentence, pos) filter (where norm <> '') as normalized,
  string_agg(tag, ' ' order by sentence, pos) as pos
from t group by doc_id""")
def q_explain_documents(spark, sf):
    model = tags.fit_tags(lang_tokens(spark, sf), "result", "lang")
    return jobs.explain_documents(docs(spark, sf), "doc_id", "text", model)
