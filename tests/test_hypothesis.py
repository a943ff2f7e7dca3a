"""Property: offsets are exact for arbitrary multilingual text."""

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from docweave.operators import entities, segment

ALPHABET = "abcXYZéßÆøñ0123456789 .,!?()\"'-@\n\t"
texts = st.lists(st.text(alphabet=ALPHABET, min_size=0, max_size=80), min_size=1, max_size=25)


def _bad_offsets(df, docs):
    j = df.join(docs, "doc_id")
    return j.filter(F.col("text").substr(F.col("begin") + 1, F.col("end") - F.col("begin") + 1)
                    != F.col("result")).count()


@settings(max_examples=8, deadline=None)
@given(texts)
def test_offsets_exact_on_random_text(spark, batch):
    docs = spark.createDataFrame(list(enumerate(batch)), "doc_id long, text string")
    assert _bad_offsets(segment.split_sentences(docs, "doc_id", "text"), docs) == 0
    assert _bad_offsets(segment.tokenize(docs, "doc_id", "text"), docs) == 0
    ctx = segment.tokenize(docs, "doc_id", "text", scope="sentence", context_chars=segment.CONTEXT_CHARS)
    assert _bad_offsets(ctx, docs) == 0
    assert _bad_offsets(entities.rule_spans(docs, "doc_id", "text"), docs) == 0
    # every non-space character is covered by exactly one token
    toks = segment.tokenize(docs, "doc_id", "text").groupBy("doc_id").agg(
        F.sum(F.length("result")).alias("n"))
    want = docs.select("doc_id", F.length(F.regexp_replace("text", r"\s", "")).alias("m"))
    assert want.join(toks, "doc_id", "left").filter(F.coalesce("n", F.lit(0)) != F.col("m")).count() == 0
