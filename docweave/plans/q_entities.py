"""Checked queries: rule entities, IOB tags, chunks, entity table, pivot, re-join
(T9b, T10, C3, A2, J2, F2, F6-F8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from docweave.functions import annotations as ann
from docweave.operators import entities, reshape, segment
from docweave.plans import sql
from docweave.plans.q_text import docs
from docweave.plans.registry import query
from docweave.sources import tables as tb

TYPES = sorted(name for name, _ in entities.RULES)
_SPANS = sql.rule_spans("documents")
_SENTS = sql.sentences("documents")
_TABLE = sql.entity_table(sql.spans_with_sentences(_SPANS, _SENTS))


def spans(spark, sf):
    return entities.rule_spans(docs(spark, sf), "doc_id", "text")


def table(spark, sf):
    d = docs(spark, sf)
    s = entities.assign_sentences(entities.rule_spans(d, "doc_id", "text"),
                                  segment.split_sentences(d, "doc_id", "text"), "doc_id")
    return reshape.entity_table(s, "doc_id")


@query("rule_spans", f"select * from {_SPANS}")
def q_rule_spans(spark, sf):
    return spans(spark, sf)


@query("rule_tags", f"""
select doc_id, pos, begin, tag from {sql.tags_from_spans(sql.tokens('documents'), _SPANS)}""")
def q_rule_tags(spark, sf):
    d = docs(spark, sf)
    tagged = entities.tag_from_spans(segment.tokenize(d, "doc_id", "text"),
                                     entities.rule_spans(d, "doc_id", "text"), "doc_id")
    return tagged.select("doc_id", "pos", "begin", "tag")


@query("entity_chunks", f"""
select * from {sql.chunks_from_tags(
    sql.tags_from_spans(sql.tokens('documents', scope='sentence'), _SPANS), 'documents')}""")
def q_entity_chunks(spark, sf):
    d = docs(spark, sf)
    tagged = entities.tag_from_spans(segment.tokenize(d, "doc_id", "text", scope="sentence"),
                                     entities.rule_spans(d, "doc_id", "text"), "doc_id")
    return entities.entity_chunks(tagged, d, "doc_id", "text")


@query("entity_table", f"select * from {_TABLE}")
def q_entity_table(spark, sf):
    return table(spark, sf)


@query("entity_pivot", f"select * from {sql.entity_pivot(_TABLE, TYPES)}")
def q_entity_pivot(spark, sf):
    return reshape.pivot_entities(table(spark, sf), TYPES)


@query("entity_rejoin", f"""
select c.id, c.title, p.* exclude (docId)
from {sql.CONTENT} c left join {sql.entity_pivot(_TABLE, TYPES)} p on c.id = p.docId""")
def q_entity_rejoin(spark, sf):
    piv = reshape.pivot_entities(table(spark, sf), TYPES)
    return reshape.attach_entities(tb.content(spark, sf).select("id", "title"), piv)


def _chunk_annotations(spark, sf):
    d = docs(spark, sf)
    s = entities.assign_sentences(entities.rule_spans(d, "doc_id", "text"),
                                  segment.split_sentences(d, "doc_id", "text"), "doc_id")
    return ann.to_annotations(s, "doc_id", "ner_chunk", "chunk",
                              metadata={"entity": F.col("entity"), "sentence": F.col("sentence")})


@query("entity_labels", f"""
select doc_id, string_agg(result || '-' || entity, ' | ' order by begin) as labels
from {sql.spans_with_sentences(_SPANS, _SENTS)} group by doc_id""")
def q_entity_labels(spark, sf):
    df = ann.entity_labels(_chunk_annotations(spark, sf), "ner_chunk", "labels")
    return df.select("doc_id", F.array_join("labels", " | ").alias("labels"))


@query("chunk_star", f"""
select doc_id, 'chunk' as annotatorType, begin, "end", result, entity, cast(sentence as varchar) as sentence
from {sql.spans_with_sentences(_SPANS, _SENTS)}""")
def q_chunk_star(spark, sf):
    rows = reshape.explode_annotations(_chunk_annotations(spark, sf), "ner_chunk", "doc_id")
    return rows.select("doc_id", "annotatorType", "begin", "end", "result",
                       ann.metadata_value("metadata", "entity").alias("entity"),
                       ann.metadata_value("metadata", "sentence").alias("sentence"))


@query("metadata_keys", f"""
select doc_id, begin, 'entity,sentence' as keys, cast(null as varchar) as score
from {sql.spans_with_sentences(_SPANS, _SENTS)}""")
def q_metadata_keys(spark, sf):
    rows = reshape.explode_annotations(_chunk_annotations(spark, sf), "ner_chunk", "doc_id")
    rows = ann.metadata_keys(rows, "metadata", "k")
    return rows.select("doc_id", "begin", F.array_join("k", ",").alias("keys"),
                       ann.metadata_value("metadata", "score").alias("score"))


@query("entity_chunks_relative", f"""
with t as (select * from {sql.tags_from_spans(sql.tokens('documents', scope='sentence'), _SPANS)}),
  s as (select doc_id, sentence, min(begin) as sbeg from t group by doc_id, sentence),
  c as (select * from {sql.chunks_from_tags(
      sql.tags_from_spans(sql.tokens('documents', scope='sentence'), _SPANS), 'documents')})
select c.doc_id, cast(c.begin - s.sbeg as integer) as begin, cast(c."end" - s.sbeg as integer) as "end",
       c.result, c.entity, c.sentence
from c join s on c.doc_id = s.doc_id and c.sentence = s.sentence""")
def q_entity_chunks_relative(spark, sf):
    d = docs(spark, sf)
    tagged = entities.tag_from_spans(segment.tokenize(d, "doc_id", "text", scope="sentence"),
                                     entities.rule_spans(d, "doc_id", "text"), "doc_id")
    return entities.entity_chunks(tagged, d, "doc_id", "text", preserve_position=False)


@query("entity_table_nested", f"select * from {_TABLE}")
def q_entity_table_nested(spark, sf):
    return reshape.entity_table_from_annotations(_chunk_annotations(spark, sf), "ner_chunk", "doc_id")
