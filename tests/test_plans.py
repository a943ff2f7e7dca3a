"""Plan shape: one shuffle of the documents, no single-partition windows."""

import re

from docweave.operators import segment
from docweave.plans import jobs
from docweave.sources import tables as tb
from tests.conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_tokenize_shuffles_documents_once(spark):
    d = segment.by_document(tb.table(spark, SF_SMALL, "documents").select("doc_id", "text"), "doc_id")
    p = _plan(segment.tokenize(d, "doc_id", "text", scope="sentence"))
    assert len(re.findall(r"Exchange hashpartitioning", p)) == 1
    assert "SinglePartition" not in p


def test_enrich_has_no_single_partition_window(spark):
    out = jobs.enrich_batch(tb.content(spark, SF_SMALL), tb.source(spark, SF_SMALL), batch=None)
    p = _plan(out)
    assert "SinglePartition" not in p
    # the text is hash-partitioned by id; every other exchange is narrow
    assert "PushedFilters" in p


def test_scan_prunes_columns(spark):
    df = tb.content(spark, SF_SMALL).select("id", "structure_size")
    p = _plan(df)
    assert re.search(r"ReadSchema: struct<doc_id:bigint,n_chars:bigint>", p)


def test_bucketed_documents_need_no_shuffle(spark):
    import uuid
    name = f"docs_b{uuid.uuid4().hex[:8]}"
    docs = tb.table(spark, SF_SMALL, "documents").select("doc_id", "text")
    tb.save_bucketed(docs, name, "doc_id", 4)
    try:
        stored = spark.table(name)
        toks = segment.tokenize(segment.by_document(stored, "doc_id", keep_layout=True), "doc_id", "text",
                                scope="sentence")
        assert "Exchange" not in _plan(toks)
        plain = segment.tokenize(segment.by_document(docs, "doc_id"), "doc_id", "text", scope="sentence")
        assert toks.exceptAll(plain).count() == 0 and plain.exceptAll(toks).count() == 0
        out = jobs.enrich_body(stored, "doc_id", "text", keep_layout=True)
        plan = _plan(out)
        assert "REPARTITION" not in plan
        assert out.count() == docs.count()
    finally:
        spark.sql(f"drop table if exists {name}")


def test_entities_stay_in_the_jvm_and_the_documents_partitioning(spark):
    from docweave.operators import entities, tags
    d = segment.by_document(tb.table(spark, SF_SMALL, "documents").select("doc_id", "text"), "doc_id")
    toks = segment.tokenize(d, "doc_id", "text", scope="sentence")
    spans = entities.rule_spans(d, "doc_id", "text")
    p = _plan(entities.tag_from_spans(toks, spans, "doc_id"))
    # one exchange of the documents per branch of the union, and no Python
    assert "InArrow" not in p and "InPandas" not in p
    assert len(re.findall(r"Exchange hashpartitioning", p)) <= 2
    words = spark.createDataFrame([("the of", "X"), ("and", "Y")], "phrase string, type string").checkpoint()
    p = _plan(tags.gazetteer_tags(toks, words, "doc_id"))
    assert "InArrow" not in p and "InPandas" not in p
    table = jobs.entity_job(tb.content(spark, SF_SMALL))["table"]
    assert "InArrow" not in _plan(table)
