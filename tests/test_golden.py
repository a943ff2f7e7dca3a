"""Golden outputs: the pivot-with-default table, array zip rows, chunk merging."""

import pandas as pd

from docweave.operators import entities, reshape


def test_pivot_default_fills_missing_pairs(spark):
    rows = [("north", "spring", "sown"), ("north", "autumn", "cut"), ("south", "spring", "sown")]
    df = spark.createDataFrame(rows, "field string, season string, state string")
    out = reshape.pivot_default(df, "field", "season", "state", "fallow", ["autumn", "spring", "winter"])
    got = sorted(tuple(r) for r in out.collect())
    assert got == [("north", "cut", "sown", "fallow"), ("south", "fallow", "sown", "fallow")]


def test_pivot_default_numeric_fills_after_pivot(spark):
    df = spark.createDataFrame([(1, "a", 5), (2, "b", 7)], "k int, t string, v int")
    out = reshape.pivot_default(df, "k", "t", "v", -1, ["a", "b"])
    assert sorted(tuple(r) for r in out.collect()) == [(1, 5, -1), (2, -1, 7)]


def test_zip_rows_pads_and_drops(spark):
    rows = [(7, [4, 8], [40, 80]), (8, [5], [50, 51]), (9, [], []), (10, None, [1])]
    df = spark.createDataFrame(rows, "k int, p array<int>, q array<int>")
    got = sorted(tuple(r) for r in reshape.zip_rows(df, ["k"], ["p", "q"]).collect())
    assert got == [(7, 0, 4, 40), (7, 1, 8, 80), (8, 0, 5, 50), (8, 1, None, 51)]


def test_flat_map_pairs_and_fails_on_short(spark):
    from pyspark.sql import types as T
    df = spark.createDataFrame([(1, [6, 4], [16, 14])], "k long, a array<long>, b array<long>")
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("i", T.LongType()),
                           T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
    out = reshape.flat_map(df, lambda p: reshape.pairwise(p, "k", "a", "b"), schema)
    assert sorted(tuple(r) for r in out.collect()) == [(1, 0, 6, 16), (1, 1, 4, 14)]
    with_short = pd.DataFrame({"k": [1], "a": [[1, 2]], "b": [[1]]})
    try:
        reshape.pairwise(with_short, "k", "a", "b")
        raise AssertionError("expected IndexError")
    except IndexError:
        pass


def test_chunks_from_iob(spark):
    text = "John Smith lives in New York and works at Acme Corp ."
    words = text.split(" ")
    tags = ["B-PER", "I-PER", "O", "O", "B-LOC", "I-LOC", "O", "O", "O", "B-ORG", "I-ORG", "O"]
    begins, b = [], 0
    for w in words:
        begins.append(b)
        b += len(w) + 1
    rows = [(1, 0, i, begins[i], begins[i] + len(w) - 1, w, t) for i, (w, t) in enumerate(zip(words, tags))]
    tagged = spark.createDataFrame(rows, "id long, sentence int, pos int, begin int, end int, result string, tag string")
    docs = spark.createDataFrame([(1, text)], "id long, text string")
    out = entities.entity_chunks(tagged, docs, "id", "text")
    got = sorted((r["result"], r["entity"], r["begin"]) for r in out.collect())
    assert got == [("Acme Corp", "ORG", 42), ("John Smith", "PER", 0), ("New York", "LOC", 20)]


def test_chunks_split_on_type_change_and_b(spark):
    rows = [(1, 0, 0, 0, 0, "a", "B-X"), (1, 0, 1, 2, 2, "b", "I-Y"), (1, 0, 2, 4, 4, "c", "B-Y"),
            (1, 1, 0, 6, 6, "d", "I-Y")]
    tagged = spark.createDataFrame(rows, "id long, sentence int, pos int, begin int, end int, result string, tag string")
    docs = spark.createDataFrame([(1, "a b c d")], "id long, text string")
    out = entities.entity_chunks(tagged, docs, "id", "text")
    assert sorted((r["result"], r["entity"]) for r in out.collect()) == [
        ("a", "X"), ("b", "Y"), ("c", "Y"), ("d", "Y")]


def test_chunks_relative_to_sentence(spark):
    rows = [(1, 0, 0, 0, 2, "Abc", "O"), (1, 1, 0, 4, 6, "Def", "B-X"), (1, 1, 1, 8, 10, "Ghi", "I-X")]
    tagged = spark.createDataFrame(rows, "id long, sentence int, pos int, begin int, end int, result string, tag string")
    docs = spark.createDataFrame([(1, "Abc Def Ghi")], "id long, text string")
    out = entities.entity_chunks(tagged, docs, "id", "text", preserve_position=False).collect()
    assert [(r["result"], r["begin"], r["end"], r["sentence"]) for r in out] == [("Def Ghi", 0, 6, 1)]
