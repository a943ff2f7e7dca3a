"""Checked queries: segmentation, normalisation, annotation folding."""

from __future__ import annotations

from pyspark.sql import functions as F

from docweave.functions import annotations as ann
from docweave.operators import reshape, segment
from docweave.plans import sql
from docweave.plans.registry import query
from docweave.sources import tables as tb


def docs(spark, sf):
    return segment.by_document(tb.table(spark, sf, "documents").select("doc_id", "text"), "doc_id")


@query("split_sentences", f"select * from {sql.sentences('documents')}")
def q_split_sentences(spark, sf):
    return segment.split_sentences(docs(spark, sf), "doc_id", "text")


@query("tokenize", f"select * from {sql.tokens('documents')}")
def q_tokenize(spark, sf):
    return segment.tokenize(docs(spark, sf), "doc_id", "text")


@query("tokenize_by_sentence", f"select * from {sql.tokens('documents', scope='sentence')}")
def q_tokenize_by_sentence(spark, sf):
    return segment.tokenize(docs(spark, sf), "doc_id", "text", scope="sentence")


@query("tokenize_context", f"""
select * from {sql.tokens('documents', scope='sentence', context_chars=segment.CONTEXT_CHARS)}""")
def q_tokenize_context(spark, sf):
    return segment.tokenize(docs(spark, sf), "doc_id", "text", scope="sentence",
                            context_chars=segment.CONTEXT_CHARS)


@query("normalize_tokens", f"""
select doc_id, pos, lower(regexp_replace(result, '[^\\p{{L}}]', '', 'g')) as normalized
from {sql.tokens('documents')} where regexp_replace(result, '[^\\p{{L}}]', '', 'g') <> ''""")
def q_normalize_tokens(spark, sf):
    toks = segment.tokenize(docs(spark, sf), "doc_id", "text")
    return segment.normalize(toks, lowercase=True).select("doc_id", "pos", "normalized")


@query("assemble_documents", """
select doc_id, 'document' as annotatorType, 0 as begin, cast(length(text) - 1 as integer) as "end",
       text as result, '0' as sentence from documents""")
def q_assemble_documents(spark, sf):
    df = segment.assemble(tb.table(spark, sf, "documents"), "text")
    a = F.col("document").getItem(0)
    return df.select("doc_id", a["annotatorType"].alias("annotatorType"), a["begin"].alias("begin"),
                     a["end"].alias("end"), a["result"].alias("result"),
                     a["metadata"].getItem("sentence").alias("sentence"))


def _token_annotations(spark, sf):
    toks = segment.tokenize(docs(spark, sf), "doc_id", "text", scope="sentence")
    return ann.to_annotations(toks, "doc_id", "token", "token")


@query("annotation_results", f"""
select doc_id, count(*) as n, string_agg(result, ' ' order by begin) as tokens
from {sql.tokens('documents', scope='sentence')} group by doc_id""")
def q_annotation_results(spark, sf):
    df = ann.annotation_results(_token_annotations(spark, sf), "token", "tokens")
    return df.select("doc_id", F.size("tokens").cast("bigint").alias("n"),
                     F.array_join("tokens", " ").alias("tokens"))


@query("finish_array", f"""
select doc_id, string_agg(result || '#sentence->' || sentence, ' ' order by begin) as finished
from {sql.tokens('documents', scope='sentence')} group by doc_id""")
def q_finish_array(spark, sf):
    df = segment.finish(_token_annotations(spark, sf), ["token"], with_metadata=True)
    return df.select("doc_id", F.array_join("finished_token", " ").alias("finished"))


@query("finish_string", f"""
select doc_id, string_agg(result, '@' order by begin) as finished
from {sql.tokens('documents', scope='sentence')} group by doc_id""")
def q_finish_string(spark, sf):
    df = segment.finish(_token_annotations(spark, sf), ["token"], as_array=False)
    return df.select("doc_id", F.col("finished_token").alias("finished"))


@query("regroup_text", f"""
select doc_id, string_agg(result, ' ' order by pos) as text from {sql.tokens('documents')} group by doc_id""")
def q_regroup_text(spark, sf):
    toks = segment.tokenize(docs(spark, sf), "doc_id", "text")
    return reshape.regroup(toks, "doc_id", "result", " ", "pos", "text")


@query("normalize_keep_case", f"""
select doc_id, pos, regexp_replace(result, '[^A-Za-z]', '', 'g') as normalized
from {sql.tokens('documents')} where regexp_replace(result, '[^A-Za-z]', '', 'g') <> ''""")
def q_normalize_keep_case(spark, sf):
    toks = segment.tokenize(docs(spark, sf), "doc_id", "text")
    return segment.normalize(toks, pattern="[^A-Za-z]").select("doc_id", "pos", "normalized")
