"""Lookups too large to broadcast, sums of vectors, and readers that shuffle no line."""
from __future__ import annotations

import os
import random
import tempfile
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from docweave.functions import joins
from docweave.operators import context_tags, entities, factorise, keywords, segment, sequence, tags, vectors
from docweave.plans import jobs, q_models
from docweave.sources import files


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_heavy_lookup_rows_are_joined_in_place(spark, monkeypatch):
    monkeypatch.setattr(joins, "_fits", lambda df, rows, size: (False, 3))
    big = segment.by_document(spark.createDataFrame(
        [(d, k) for d in range(40) for k in ("a", "a", "b", "c", "d", "z", None)], "doc long, k string"), "doc")
    # a key that comes twice, and ties at the cut
    look = spark.createDataFrame([("a", 9, "x"), ("a", 9, "y"), ("b", 5, "p"), ("c", 5, "q"), ("d", 1, "r")],
                                 "key string, n int, v string")
    for how in ("left", "inner"):
        got = joins.lookup_join(big, look, "k", "key", how, salt_by=["doc"], weight=F.col("n"), part="doc")
        want = big.join(look, big["k"] == look["key"], how)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
        # folding by document needs no shuffle beyond the ones the join made
        assert plan(got.groupBy("doc").count()).count("Exchange") == plan(got).count("Exchange")


def test_null_places_of_sentence_vectors(spark):
    rows = [(1, 0, 0, [1.0, 2.0]), (1, 0, 1, [3.0, None]), (1, 1, 0, [5.0, 7.0]), (2, 0, 0, [1.0]),
            (2, 1, 0, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame(rows, "doc_id long, sentence int, pos int, embedding array<float>")
    got = {(r["doc_id"], r["sentence"]): (r["n_tokens"], r["vector"])
           for r in vectors.sentence_vectors(df, "doc_id", 2).collect()}
    assert got == {(1, 0): (2, [2.0, None]), (1, 1): (1, [5.0, 7.0]), (2, 0): (1, [1.0, None]),
                   (2, 1): (1, [1.0, 2.0, None])}
    assert "collect_list" not in plan(vectors.sentence_vectors(df, "doc_id", 2))


def test_conll_lines_are_not_shuffled(spark):
    d = tempfile.mkdtemp(prefix="dw-conll-")
    with open(os.path.join(d, "a.txt"), "w") as f:
        f.write("-DOCSTART- -X- -X- O\n\n" + "w P B O\n" * 50 + "\nv P B O\n")
    rows = files.read_conll(spark, d)
    assert [len(x) for x in (rows.filter("token = 'w'").select("tok_idx").distinct().collect(),
                             rows.filter("token = 'v' and tok_idx = 0").collect())] == [50, 1]
    big_side = plan(rows).split("BroadcastExchange")[0]
    assert "hashpartitioning" not in big_side and "Window" not in big_side


def test_batches_are_read_in_slices(monkeypatch):
    sizes = []
    rows = pa.array([[{"a": i}] for i in range(1000)])
    real = pa.ListArray.to_pylist

    class Column:
        def __len__(self):
            return len(rows)

        def slice(self, at, n):
            sizes.append(n)
            return rows.slice(at, n)

    assert list(sequence.in_slices(Column())) == real(rows) and max(sizes) <= 256


TOKENS = "doc_id long, sentence int, pos int, begin int, end int, result string"


def _tokens(spark, texts):
    rows = [(d, 0, i, 10 * i, 10 * i + 4, x) for d, text in enumerate(texts) for i, x in enumerate(text.split())]
    return segment.by_document(spark.createDataFrame(rows, TOKENS), "doc_id")


def test_pairs_are_counted_as_numbers(spark, monkeypatch):
    toks = _tokens(spark, ["a b , c a rare d", "b a c . b , , , a", "d d D a b c"])
    words = factorise.numbered_words(toks, min_count=2)
    assert {r["token"] for r in words.collect()} == {"a", "b", "c", "d"}
    small = factorise.cooccurrence(toks, "doc_id", 4, 2)
    for cap in (None, 2):  # all words broadcast, then only the two commonest
        if cap:
            monkeypatch.setattr(joins, "_fits", lambda df, rows, size: (False, cap))
        pairs = factorise.cooccurrence(toks, "doc_id", 4, 2, words=words)
        assert dict(pairs.dtypes) == {"token": "bigint", "context": "bigint", "n": "bigint"}
        got = {(r["token"], r["context"]): r["n"] for r in factorise.with_words(pairs, words).collect()}
        assert got == {(r["token"], r["context"]): r["n"] for r in small.collect()}
        # commas and rare words keep their places: 2 + 3 + 1 times a and b are at most four apart
        assert got[("a", "b")] == got[("b", "a")] == 6 and got[("d", "d")] == 6
    # the vectors too are the same by number and by name
    by_name = factorise.factorise(factorise.ppmi(small), dim=2, oversample=1)
    by_number = factorise.factorise(factorise.ppmi(pairs), dim=2, oversample=1, words=words)
    a, b = ({r["token"]: r["vector"] for r in x.collect()} for x in (by_name, by_number))
    assert a.keys() == b.keys()
    for x in a:
        assert all(abs(abs(p) - abs(q)) < 1e-4 for p, q in zip(a[x], b[x]))


def test_only_rare_lookup_rows_are_repeated(spark, monkeypatch):
    monkeypatch.setattr(joins, "_fits", lambda df, rows, size: (False, 2))
    big = spark.createDataFrame([(i, k) for i in range(30) for k in "aab"], "id long, k string")
    look = spark.createDataFrame([("a", 9), ("b", 1), ("n", None)], "key string, n int")
    moved = []
    real = joins._salted
    monkeypatch.setattr(joins, "_salted", lambda b, lookup, *x: moved.append(lookup) or real(b, lookup, *x))
    assert joins.lookup_join(big, look, "k", "key", "inner", salt_by=["id"], weight=F.col("n")).count() == 90
    assert {r["key"] for r in moved[0].collect()} == {"b", "n"}


def test_relative_chunks_tag_the_tokens_once(spark):
    toks = spark.createDataFrame([
        (1, 0, 0, 2, 3, "x", "O"), (1, 0, 1, 5, 6, "y", "B-A"), (1, 0, 2, 8, 9, "z", "I-A"),
        (1, 1, 0, 12, 13, "v", "B-A"), (2, 0, 0, 1, 1, "w", "B-B"), (3, 0, 0, 0, 1, "o", "O")], TOKENS + ", tag string")
    docs = segment.by_document(spark.createDataFrame([(i, "0123456789abcdefgh") for i in (1, 2, 3)], "doc_id long, text string"), "doc_id")
    out = entities.entity_chunks(segment.by_document(toks, "doc_id"), docs, "doc_id", "text", preserve_position=False)
    assert sorted((r["doc_id"], r["begin"], r["end"], r["result"]) for r in out.collect()) == [
        (1, 0, 1, "cd"), (1, 3, 7, "56789"), (2, 0, 0, "1")]
    assert plan(out).split("Initial Plan")[0].count("Scan ExistingRDD") == 2  # tokens and documents, once each


def test_keywords_sort_tokens_once_before_the_terms(spark):
    out = keywords.keywords(_tokens(spark, ["A b c d a b"]), "doc_id", 1, 3, None, None)
    # by sentence, by term, and back by sentence
    assert plan(out.select("doc_id", "keyword")).split("Initial Plan")[0].count("Sort [") == 3


def _plain_buckets(words, extra, buckets):
    low, forms = [w.lower() for w in words], [sequence.shape(w) for w in words]
    at = lambda xs, i, other: xs[i] if 0 <= i < len(xs) else other
    return [[zlib.crc32(f.encode()) % buckets for f in (
        f"w={low[i]}", f"s={low[i][-3:]}", f"h={forms[i]}", f"p={at(low, i - 1, '<s>')}", f"n={at(low, i + 1, '</s>')}",
        f"ph={at(forms, i - 1, '<s>')}|{forms[i]}", f"hn={forms[i]}|{at(forms, i + 1, '<s>')}", "b",
        *(f"{k}={values[i]}" for k, values in enumerate(extra)))] for i in range(len(words))]


def test_sentences_are_tagged_as_flat_rows(spark):
    rng = random.Random(5)
    sents = [[rng.choice(["Aa", "b", "ÉÉ", "7x", ".", "ab12", "B"]) for _ in range(rng.choice([1, 2, 3, 9, 40]))] for _ in range(30)]
    extra = [[rng.choice(["p", "q", None]) for _ in x] for x in sents]
    starts = np.cumsum([0] + [len(x) for x in sents])[:-1]
    flat = sequence.feature_buckets(pa.array(sum(sents, [])), starts, [pa.array(sum(extra, []), pa.string())], 1 << 10)
    assert flat.tolist() == sum((_plain_buckets(x, [e], 1 << 10) for x, e in zip(sents, extra)), [])
    r = np.random.default_rng(1)
    scores, t = r.integers(-2, 3, (len(flat), 4)).astype(float), r.integers(-2, 3, (5, 4)).astype(float)
    want = [sequence.viterbi(scores[a:a + len(x)], t) for a, x in zip(starts, sents)]  # with many ties
    assert sequence.viterbi_all(scores, starts, t).tolist() == np.concatenate(want).tolist()
    # sentences longer than a batch, and batches that end inside sentences
    model = sequence.ChainModel(("A", "B", "C"), r.integers(-2, 3, (1 << 10, 3)).astype(float), np.zeros((0, 3)),
                                r.integers(-2, 3, (4, 3)).astype(float))
    rows = [(d % 7, d, i, 0, 0, w) for d, x in enumerate(sents) for i, w in enumerate(x)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, TOKENS)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for n in ("4", before):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", n)
            out = sequence.tag_chain(df, model, "doc_id")
            assert "collect_list" not in plan(out)
            got = {(x["sentence"], x["pos"]): x["tag"] for x in out.collect()}
            for d, x in enumerate(sents):
                e = model.emission[np.array(_plain_buckets(x, [], 1 << 10))].sum(axis=1)
                path = sequence.viterbi(e, model.transition)
                assert [got[d, i] for i in range(len(x))] == [model.labels[j] for j in path]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_context_tags_read_flat_rows_and_null_tags(spark):
    rows = [(d, 0, i, 0, 0, w, t) for d, s in enumerate([
        [("a", "X"), ("b", None)], [("a", "X"), ("b", None)], [("c", "Y"), ("b", "Z")], [("q\"ü", "Y")]]) for i, (w, t) in enumerate(s)]
    df = spark.createDataFrame(rows, TOKENS + ", lang string")
    model = context_tags.fit_context_tags(df, "doc_id", "result", "lang")
    out = context_tags.tag_in_context(df, model, "doc_id")
    assert "struct(pos" not in plan(out)  # no array of a sentence's tokens
    got = {(r["doc_id"], r["pos"]): r["tag"] for r in out.collect()}
    # behind X the tag of "b" is null, so is its suffix's: the tag behind X, or the commonest
    after = model.by_previous.get("X", model.default)
    assert got == {(0, 0): "X", (0, 1): after, (1, 0): "X", (1, 1): after, (2, 0): "Y", (2, 1): got[2, 1], (3, 0): "Y"}


def test_the_tagger_learns_from_whole_chosen_sentences(spark):
    df = spark.createDataFrame([(d, s, i, 0, 0, "w") for d in range(40) for s in range(5) for i in range(3)], TOKENS)
    assert sequence.training_sentences(df, "doc_id", 200).count() == 600
    some = sequence.training_sentences(df, "doc_id", 60)
    sizes = [r["count"] for r in some.groupBy("doc_id", "sentence").count().collect()]
    assert 20 < len(sizes) < 120 and set(sizes) == {3}


def test_tagged_tokens_and_features_are_made_once(spark):
    toks = _tokens(spark, ["A b", "b c d"])
    labelled = toks.withColumn("lang", F.lit("en"))
    p = jobs.BodyParams(pos_model=context_tags.fit_context_tags(labelled, "doc_id", "result", "lang"))
    kept = jobs.featured_tokens(toks, "doc_id", p, keep=True)
    assert "InArrow" not in plan(kept) and "Scan parquet" in plan(kept)
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, jobs.featured_tokens(toks, "doc_id", p).collect()))
    model = tags.fit_tags(labelled, "result", "lang")
    voc = spark.createDataFrame([("b", [1.0] * 64)], "token string, vector array<float>")
    made = tags.token_features(q_models._featured(spark, None, toks, model, voc), "doc_id")
    assert "Window" not in plan(made) and made.count() == 5 and tags.FEATURES <= set(made.columns)
