"""Matches are taken from the left unless they overlap one taken before."""

import time

from docweave.functions.ranking import global_rank
from docweave.operators import entities, keywords, segment, tags


def tokens(spark, words, sentence=0):
    rows, at = [], 0
    for i, w in enumerate(words):
        rows.append((1, sentence, i, at, at + len(w) - 1, w))
        at += len(w) + 1
    return spark.createDataFrame(rows, "id long, sentence int, pos int, begin int, end int, result string")


def test_every_third_trigram_is_kept(spark):
    words = list("abcdefghi")
    phrases = [(" ".join(words[i:i + 3]), "X") for i in range(7)]
    out = tags.gazetteer_tags(tokens(spark, words), spark.createDataFrame(phrases, "phrase string, type string"), "id")
    assert [r["tag"] for r in out.orderBy("pos").collect()] == ["B-X", "I-X", "I-X"] * 3


def test_a_phrase_with_two_types_has_one(spark):
    d = spark.createDataFrame([("a", "Q"), ("a", "B")], "phrase string, type string")
    out = tags.gazetteer_tags(tokens(spark, ["a", "z"]), d, "id").orderBy("pos").collect()
    assert [(r["result"], r["tag"]) for r in out] == [("a", "B-B"), ("z", "O")]


def test_spans_after_a_dropped_one(spark):
    text = "0123456789"
    docs = spark.createDataFrame([(1, text)], "id long, text string")
    rules = (("A", "0123"), ("B", "234567"), ("C", "6789"))
    out = entities.rule_spans(docs, "id", "text", rules).orderBy("begin").collect()
    assert [(r["begin"], r["end"]) for r in out] == [(0, 3), (6, 9)]


def test_borders_and_octets(spark):
    digest = "0123456789abcdef" * 4
    rows = [(1, f"x {digest} y"), (2, "at 999.1.2.3 or 10.1.2.3."), (3, "14111111111111111 4111 1111 1111 1111"),
            (4, "k " + digest[:40])]
    docs = spark.createDataFrame(rows, "id long, text string")
    got = {(r["id"], r["entity"], r["result"]) for r in entities.rule_spans(docs, "id", "text").collect()}
    assert got == {(2, "IP", "10.1.2.3"), (3, "CARD", "4111 1111 1111 1111"), (4, "KEY", digest[:40])}


def test_mail_rule_is_linear(spark):
    text = "x" * 1_000_000 + " a@b.com1x@c.org"
    docs = spark.createDataFrame([(1, text)], "id long, text string").checkpoint()
    entities.rule_spans(docs.limit(0), "id", "text").collect()
    t0 = time.time()
    got = [r["result"] for r in entities.rule_spans(docs, "id", "text").orderBy("begin").collect()]
    assert got == ["a@b.com", "1x@c.org"] and time.time() - t0 < 20  # the quadratic rule takes hours


def test_sentences_of_text_with_the_mark(spark):
    text = "ab\x01cd. ef\x02\x01. \x01Mr. Gh."
    docs = spark.createDataFrame([(1, text)], "id long, text string")
    rows = segment.split_sentences(docs, "id", "text").orderBy("sentence").collect()
    assert [r["result"] for r in rows] == ["ab\x01cd.", "ef\x02\x01.", "\x01Mr. Gh."]
    assert all(text[r["begin"]:r["end"] + 1] == r["result"] for r in rows)


def test_rank_without_exchange_reuse(spark):
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        df = spark.range(200_000).selectExpr("hash(id) as h", "id")
        out = global_rank(df, ["h", "id"])
        assert out.select("rank").distinct().count() == 200_000
        assert out.agg({"rank": "max"}).first()[0] == 199_999
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_keywords_may_hold_a_stopword(spark):
    words = "the bank of england met".split()
    found = {r["keyword"] for r in keywords.keywords(tokens(spark, words), "id", k=None, threshold=None).collect()}
    assert "bank of england" in found
    assert not any(k.split()[0] in ("the", "of") or k.split()[-1] in ("the", "of") for k in found)
