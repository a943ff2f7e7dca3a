"""Job-level behaviour: Pi, two sinks from one annotation, stored resources."""

import os
import tempfile

from pyspark.sql import functions as F

from docweave.operators import segment, stats, tags
from docweave.plans import jobs
from docweave.sources import files
from docweave.sources import tables as tb
from tests.conftest import SF_SMALL


def test_estimate_pi_range_and_value(spark):
    assert spark.range(1, 200000, 1, 2).count() == 199999
    pi = stats.estimate_pi(spark, slices=2).first()["pi"]
    assert abs(pi - 3.1416) < 0.02


def test_save_both_writes_two_views(spark):
    out = tempfile.mkdtemp(prefix="dw-both-")
    content = tb.content(spark, SF_SMALL).filter(F.col("structure_size") < 2000)
    annotated = jobs.enrich_batch(content, tb.source(spark, SF_SMALL), None, None, batch=None)
    idx = jobs.Sink("json", path=os.path.join(out, "index"))
    tab = jobs.Sink("parquet", path=os.path.join(out, "table"))
    jobs.save_both(annotated, lambda a: a.drop("body_text"),
                   lambda a: a.select("id", F.explode("entities").alias("entity")), idx, tab)
    assert spark.read.json(os.path.join(out, "index")).count() == content.count()
    entities = annotated.agg(F.sum(F.size("entities"))).first()[0]
    assert entities > 0 and spark.read.parquet(os.path.join(out, "table")).count() == entities


def test_resources_round_trip(spark):
    d = segment.by_document(tb.table(spark, SF_SMALL, "documents").select("doc_id", "text", "lang"), "doc_id")
    toks = segment.tokenize(d.select("doc_id", "text"), "doc_id", "text").join(d.select("doc_id", "lang"), "doc_id")
    model = tags.fit_tags(toks, "result", "lang")
    p = os.path.join(tempfile.mkdtemp(prefix="dw-res-"), "tags")
    files.save_resource(model.by_token, p)
    back = files.load_resource(spark, p)
    assert back.count() == model.by_token.count()
    lr = tags.train_tagger(toks.limit(3000), "doc_id", "lang", max_iter=2, num_features=1 << 10)
    mp = os.path.join(tempfile.mkdtemp(prefix="dw-res-"), "tagger.model")
    lr.write().overwrite().save(mp)
    again = files.load_resource(spark, mp)
    assert "tag" in tags.apply_tagger(again, toks.limit(10), "doc_id").columns


def test_entity_job_keeps_documents_without_entities(spark):
    content = tb.content(spark, SF_SMALL)
    out = jobs.entity_job(content, 1000, 10000)
    n_docs = content.filter((F.col("structure_size") > 1000) & (F.col("structure_size") < 10000)).count()
    assert out["rows"].count() == n_docs
    assert out["pivot"].count() <= n_docs
    assert set(out["table"].columns) == {"docId", "entity", "entity_type", "sentence_num", "start_pos", "id"}


def test_fits_on_empty_input(spark):
    import pytest
    empty = spark.createDataFrame([], "doc_id long, sentence int, pos int, result string, lang string")
    model = tags.fit_tags(empty, "result", "lang")
    assert model.default == "O" and model.by_token.count() == 0
    toks = spark.createDataFrame([(1, 0, 0, "Hello")], "doc_id long, sentence int, pos int, result string")
    assert tags.tag_tokens(toks, model).first()["tag"] == "O"
    with pytest.raises(ValueError):
        tags.train_tagger(empty, "doc_id", "lang")
