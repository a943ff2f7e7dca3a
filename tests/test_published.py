"""Ledger filter, epochs of two outputs, the committed sink, distinct keywords, index rows."""

import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from docweave.operators import keywords, select
from docweave.plans import jobs
from docweave.sources import epochs


# --- ledger -----------------------------------------------------------------------
@pytest.mark.parametrize("blocks", [1, 64])
def test_ledger_equals_anti_join(spark, blocks):
    rng = random.Random(7)
    done = [(i,) for i in rng.sample(range(40_000), 9_000)] + [(None,), (5,), (5,)]
    rows = [(i, f"t{i}") for i in range(0, 40_000, 3)] + [(None, "n"), (3, "again")]
    ledger = spark.createDataFrame(done, "id long")
    df = spark.createDataFrame(rows, "id long, text string")
    got = select.unindexed_by_ledger(df, ledger, blocks=blocks).collect()
    known = {r[0] for r in done if r[0] is not None}
    assert sorted(map(str, got)) == sorted(str(r) for r in df.collect() if r["id"] not in known)


def test_filter_rules_out_most_new_ids(spark):
    ledger = spark.range(0, 20_000).select((F.col("id") * 2).alias("id"))
    bloom = select.ledger_filter(ledger, blocks=16)
    assert bloom.count() <= 16 and bloom.filter(F.size("words") != 512).count() == 0
    done = select.perhaps_done(ledger, bloom, blocks=16).filter("perhaps_done").count()
    new = spark.range(0, 20_000).select((F.col("id") * 2 + 1).alias("id"))
    wrong = select.perhaps_done(new, bloom, blocks=16).filter("perhaps_done").count()
    assert done == 20_000 and 0 < wrong < 2_000  # full blocks: some wrong positives, all caught by the join
    got = select.unindexed_by_ledger(ledger.union(new), ledger, blocks=16)
    assert got.count() == 20_000 and got.filter("id % 2 = 0").count() == 0


def test_wide_rows_are_not_shuffled(spark):
    df = spark.createDataFrame([(i, "x") for i in range(100)], "id long, text string")
    out = select.unindexed_by_ledger(df, spark.range(50), blocks=4)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan
    assert select.unindexed_by_ledger(df, spark.range(0), blocks=4).count() == 100
    assert select.unindexed_by_ledger(df.limit(0), spark.range(9), blocks=4).count() == 0


# --- two outputs, one epoch ---------------------------------------------------------
def test_readers_see_both_outputs_or_neither(spark):
    base = tempfile.mkdtemp(prefix="dw-epochs-") + "/out"
    assert epochs.current(spark, base) is None
    with pytest.raises(FileNotFoundError):
        epochs.read_published(spark, base, "index")
    first = epochs.publish(spark, base, {"index": spark.range(3), "table": spark.range(4)})
    broken = spark.range(5).select(F.raise_error(F.lit("no")).alias("id"))
    with pytest.raises(Exception):  # the second output fails after the first is written
        epochs.publish(spark, base, {"index": spark.range(50), "table": broken})
    assert epochs.current(spark, base)["epoch"] == first
    assert [epochs.read_published(spark, base, n).count() for n in ("index", "table")] == [3, 4]
    epochs.publish(spark, base, {"index": spark.range(6), "table": spark.range(7)})
    assert [epochs.read_published(spark, base, n).count() for n in ("index", "table")] == [6, 7]
    assert sum(n.startswith("_current-") for n in os.listdir(base)) == 1


def test_publish_both_annotates_once(spark):
    base = tempfile.mkdtemp(prefix="dw-both-") + "/out"
    docs = spark.createDataFrame([(1, "Write to a.b@c.org. Thanks.", 30)], "id long, body_text string, structure_size int")
    annotated = jobs.enrich_body(docs, "id", "body_text")
    jobs.publish_both(annotated, lambda a: jobs.index_row(a), lambda a: a.select("id", F.explode("entities").alias("e")), base)
    assert epochs.read_published(spark, base, "index").columns == ["id", "structure_size", "sentences", "entities", "keywords"]
    assert [r["e"] for r in epochs.read_published(spark, base, "table").collect()] == ["a.b@c.org"]


def test_index_row_refuses_structs(spark):
    with pytest.raises(ValueError):
        jobs.index_row(spark.createDataFrame([(1, ("a",))], "id long, s struct<x:string>"))


# --- committed sink -------------------------------------------------------------------
def test_sink_batches_commits_and_appends(spark):
    epochs.register(spark)
    path = tempfile.mkdtemp(prefix="dw-sink-") + "/s"
    df = spark.range(0, 2500, 1, 2).select("id", F.concat(F.lit("é \n"), "id").alias("text"), F.lit(None).cast("string").alias("z"))
    write = lambda d, mode: d.write.format("docweave_batched").option("path", path).option("batch", 1000).mode(mode).save()
    read = lambda: spark.read.format("docweave_batched").schema(df.schema).option("path", path).load()
    write(df, "overwrite")
    assert sorted(map(tuple, read().collect())) == sorted(map(tuple, df.collect()))
    assert len(epochs.manifest(path)) == 4  # two tasks of 1,250 rows
    write(df.limit(3), "append")
    assert read().count() == 2503
    write(df.limit(2), "overwrite")
    assert read().count() == 2


def test_failed_write_publishes_nothing(spark):
    epochs.register(spark)
    folder = tempfile.mkdtemp(prefix="dw-sink-")
    path, marker = f"{folder}/s", f"{folder}/marker"
    save = lambda d: d.write.format("docweave_batched").option("path", path).option("batch", 10) \
        .option("fail_once", marker).mode("overwrite").save()
    with pytest.raises(Exception):  # local mode does not repeat a task
        save(spark.range(0, 100, 1, 1))
    assert epochs.manifest(path) == []
    save(spark.range(0, 100, 1, 1))  # the marker is there now: the rows of the failed attempt stay out
    got = spark.read.format("docweave_batched").schema("id long").option("path", path).load()
    assert got.count() == 100 and got.distinct().count() == 100


# --- distinct keywords ------------------------------------------------------------------
def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_distinct_keywords_equal_brute_force(spark):
    rng = random.Random(5)
    stems = ["data stream", "data streams", "stream data", "query plan", "query plans", "plan", "plans", "index"]
    rows = [(d, w, len(w.split()), round(rng.random() / 2, 3)) for d in range(8)
            for w in rng.sample(stems, rng.randrange(1, len(stems)))]
    df = spark.createDataFrame(rows, "id long, keyword string, n int, score double")
    for k, similarity in ((3, 0.8), (None, 0.9), (10, 0.6)):
        expected = []
        for d in range(8):
            taken = []
            for r in sorted((r for r in rows if r[0] == d), key=lambda r: (r[3], r[1])):
                if (k is None or len(taken) < k) and all(
                        1 - levenshtein(r[1], t[1]) / max(len(r[1]), len(t[1])) <= similarity for t in taken):
                    taken.append(r)
            expected += taken
        got = keywords.distinct_keywords(df, "id", k, similarity).select("id", "keyword", "n", "score").collect()
        assert sorted(map(tuple, got)) == sorted(expected)
