"""Properties over the small driver tables."""

from pyspark.sql import functions as F

from docweave.operators import entities, keywords, segment, select
from docweave.plans import jobs
from docweave.sources import tables as tb
from tests.conftest import SF_SMALL


def _docs(spark):
    return segment.by_document(tb.table(spark, SF_SMALL, "documents").select("doc_id", "text"), "doc_id")


def _offsets_hold(df, docs, id_col="doc_id"):
    j = df.join(docs, id_col)
    bad = j.filter(F.col("text").substr(F.col("begin") + 1, F.col("end") - F.col("begin") + 1) != F.col("result"))
    return bad.count()


def test_token_offsets_and_lossless(spark):
    d = _docs(spark)
    toks = segment.tokenize(d, "doc_id", "text")
    assert _offsets_hold(toks, d) == 0
    # the whitespace-led token pieces re-join to the text without its trailing whitespace
    pieces = d.select("doc_id", F.posexplode(F.regexp_extract_all("text", F.lit(segment.token_pattern()), 0)))
    again = pieces.groupBy("doc_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(
        F.struct("pos", "col"))), lambda s: s["col"]), "").alias("t"))
    bad = again.join(d, "doc_id").filter(F.col("t") != F.regexp_replace("text", r"\s+$", ""))
    assert bad.count() == 0


def test_sentence_and_context_offsets(spark):
    d = _docs(spark)
    assert _offsets_hold(segment.split_sentences(d, "doc_id", "text"), d) == 0
    ctx = segment.tokenize(d, "doc_id", "text", scope="sentence", context_chars=segment.CONTEXT_CHARS)
    assert _offsets_hold(ctx, d) == 0


def test_sentence_split_rules(spark):
    df = spark.createDataFrame([(1, "Mr. Kevin paid 3.5 dollars.  It was 10.0.0.1!\nNew line")], "doc_id long, text string")
    got = [r["result"] for r in segment.split_sentences(df, "doc_id", "text").orderBy("sentence").collect()]
    assert got == ["Mr. Kevin paid 3.5 dollars.", "It was 10.0.0.1!", "New line"]


def test_context_tokens(spark):
    df = spark.createDataFrame([(1, '(Hello, "world") 3.5 U.S.')], "doc_id long, text string")
    toks = segment.tokenize(df, "doc_id", "text", context_chars=segment.CONTEXT_CHARS)
    got = [r["result"] for r in toks.orderBy("pos").collect()]
    assert got == ["(", "Hello", ",", '"world"', ")", "3.5", "U.S", "."]


def test_spans_do_not_overlap_and_offsets(spark):
    d = _docs(spark)
    spans = entities.rule_spans(d, "doc_id", "text")
    assert _offsets_hold(spans, d) == 0
    from pyspark.sql import Window
    w = Window.partitionBy("doc_id").orderBy("begin")
    assert spans.withColumn("prev_end", F.lag("end").over(w)).filter(
        F.col("prev_end") >= F.col("begin")).count() == 0


def test_keyword_bounds(spark):
    d = _docs(spark)
    toks = segment.tokenize(d, "doc_id", "text", scope="sentence", context_chars=segment.CONTEXT_CHARS)
    kw = keywords.keywords(toks, "doc_id", 1, 3, 4, 0.6)
    per_doc = kw.groupBy("doc_id").count().agg(F.max("count")).first()[0]
    assert per_doc <= 4
    assert kw.filter((F.col("score") >= 0.6) | (F.col("score") <= 0)).count() == 0
    stop = set(keywords.STOPWORDS)
    for r in kw.select("keyword").distinct().collect():
        words = r["keyword"].split(" ")
        assert 1 <= len(words) <= 3 and not ({words[0], words[-1]} & stop)


def test_incremental_copy_after_ledger_is_empty(spark):
    content, source = tb.content(spark, SF_SMALL), tb.source(spark, SF_SMALL)
    ledger = tb.ledger(spark, SF_SMALL)
    first = jobs.incremental_copy(content, source, ledger, batch=None)
    n = first.count()
    assert n > 0
    done = ledger.unionByName(first.select("id"))
    assert jobs.incremental_copy(content, source, done, batch=None).count() == 0


def test_latest_nulls_first_and_tiebreak(spark):
    import datetime as dt
    rows = [(1, dt.date(2020, 1, 1)), (2, None), (3, dt.date(2021, 1, 1)), (4, dt.date(2021, 1, 1))]
    df = spark.createDataFrame(rows, "id long, last_updated date")
    got = [r["id"] for r in select.latest(df, "last_updated", 3, "id").collect()]
    assert got == [2, 3, 4]


def test_size_filter_strict(spark):
    df = spark.createDataFrame([(1, 100), (2, 101), (3, 999), (4, 1000), (5, None)], "id long, s int")
    assert sorted(r["id"] for r in select.filter_size(df, "s", 100, 1000).collect()) == [2, 3]


def test_entity_id_never_loses_type(spark):
    from docweave.functions.annotations import entity_id
    df = spark.createDataFrame([(7, None, 3), (7, "IP", 3)], "d long, t string, b int")
    assert [r[0] for r in df.select(entity_id("d", "t", "b")).collect()] == ["7-UNK-3", "7-IP-3"]


def test_global_rank_is_dense_and_ordered(spark):
    from docweave.functions.ranking import global_rank
    df = spark.range(0, 1000).select((F.col("id") * 7919 % 1000).alias("v"))
    r = global_rank(df, [F.col("v")], "rank", partitions=7).orderBy("rank").collect()
    assert [x["rank"] for x in r] == list(range(1000))
    assert [x["v"] for x in r] == sorted(x["v"] for x in r)


def test_salted_lookup_join_equals_plain_join(spark):
    from docweave.functions.joins import lookup_join
    big = spark.createDataFrame([(i, "the" if i % 3 else f"w{i % 7}") for i in range(300)], "id long, tok string")
    lk = spark.createDataFrame([("the", "DET"), ("w1", "N"), ("w2", "V")], "k string, tag string")
    salted = lookup_join(big, lk, "tok", "k", "left", salt_by=["id"], salts=4, max_broadcast_rows=1)
    plain = big.join(lk, big["tok"] == lk["k"], "left")
    key = lambda r: (r["id"], r["tag"])
    assert sorted(map(key, salted.collect()), key=repr) == sorted(map(key, plain.collect()), key=repr)
    assert salted.count() == 300


def test_null_empty_and_stopword_only_texts(spark):
    from docweave.operators import stats
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "the and of."), (4, "   \n\n  ")],
                                 "doc_id long, text string")
    assert segment.split_sentences(docs, "doc_id", "text").count() == 1
    assert segment.tokenize(docs, "doc_id", "text").count() == 4
    toks = segment.tokenize(docs, "doc_id", "text", scope="sentence", context_chars=segment.CONTEXT_CHARS)
    assert keywords.keywords(toks, "doc_id").count() == 0
    assert entities.rule_spans(docs, "doc_id", "text").count() == 0
    empty = spark.range(0).withColumnRenamed("id", "k")
    assert stats.pi_from_keys(empty, "k").first()["pi"] is None


def test_keyword_window_general_path_matches_fast_path(spark):
    d = _docs(spark)
    toks = segment.tokenize(d, "doc_id", "text", scope="sentence", context_chars=segment.CONTEXT_CHARS)
    fast = keywords.keywords(toks, "doc_id", 1, 3, 10, 0.6)
    general = keywords.keywords(toks, "doc_id", 1, 3, 10, 0.6, _general_window=True)
    key = lambda r: (r["doc_id"], r["keyword"], round(r["score"], 9))
    assert sorted(map(key, fast.collect())) == sorted(map(key, general.collect()))
    wide = keywords.keywords(toks, "doc_id", 1, 3, 10, None, window=3)
    assert wide.count() > 0 and wide.filter(F.col("score") <= 0).count() == 0


def test_blanks_are_trimmed_without_a_search(spark):
    texts = [" \t\x0b\f a  b.  \r\n  c ", "d \u0085", "\n \t ", "", "f\x1c \x1c\n\n", "\u2003g \u2003"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sents = segment.split_sentences(docs, "doc_id", "text")
    tokens = segment.tokenize_sentences(sents, "doc_id")
    assert r", ^\s+, " not in tokens._jdf.queryExecution().optimizedPlan().toString()  # no search per token
    got = [(r["doc_id"], r["begin"], r["end"], r["result"]) for r in sents.orderBy("doc_id", "sentence").collect()]
    # the pattern's end of a text may lie before a last line end, as in the second
    assert got == [(0, 5, 9, "a  b."), (0, 16, 16, "c"), (1, 0, 1, "d\u0085"), (4, 0, 3, "f\x1c \x1c"), (5, 0, 3, "\u2003g \u2003")]
    found = [(r["doc_id"], r["begin"], r["result"]) for r in tokens.orderBy("doc_id", "begin").collect()]
    assert found[:4] == [(0, 5, "a"), (0, 8, "b"), (0, 9, "."), (0, 16, "c")]
