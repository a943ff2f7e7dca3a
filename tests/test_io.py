"""Sinks and sources: save modes, index writer, batched sink, CoNLL, JDBC options, stream."""

import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from docweave.sources import files, jdbc
from docweave.sources import tables as tb
from tests.conftest import SF_SMALL


def test_save_modes(spark):
    d = tempfile.mkdtemp(prefix="dw-modes-")
    p = os.path.join(d, "t")
    df = spark.range(5)
    files.write_index(df, "parquet", mode="append", path=p)
    files.write_index(df, "parquet", mode="append", path=p)
    assert spark.read.parquet(p).count() == 10
    files.write_index(df, "parquet", mode="ignore", path=p)
    assert spark.read.parquet(p).count() == 10
    with pytest.raises(Exception):
        files.write_index(df, "parquet", mode="error", path=p)
    files.write_index(df, "parquet", mode="overwrite", path=p)
    assert spark.read.parquet(p).count() == 5


def test_index_writer_refuses_structs(spark):
    df = spark.createDataFrame([(1, [("a", 1)])], "id long, ann array<struct<r:string,b:int>>")
    with pytest.raises(ValueError):
        files.write_index(df, "json", path=tempfile.mkdtemp() + "/x")
    ok = spark.createDataFrame([(1, ["a", "b"])], "id long, keywords array<string>")
    p = tempfile.mkdtemp() + "/ok"
    files.write_index(ok, "json", path=p)
    assert spark.read.json(p).first()["keywords"] == ["a", "b"]


def test_write_batched_groups_rows(spark):
    df = spark.range(0, 2500, 1, 2)
    out = tempfile.mkdtemp(prefix="dw-batches-")

    def sink(rows):
        with open(os.path.join(out, f"{os.getpid()}-{id(rows)}-{rows[0]['id']}"), "w") as fh:
            fh.write(str(len(rows)))
    files.write_batched(df, sink, batch=1000)
    sizes = sorted(int(open(os.path.join(out, f)).read()) for f in os.listdir(out))
    assert sum(sizes) == 2500 and max(sizes) <= 1000
    plan = files.batch_plan(df, 1000)
    assert plan.agg(F.sum("rows")).first()[0] == 2500
    assert plan.agg(F.max("rows")).first()[0] <= 1000


@pytest.mark.parametrize("eol", ["\n", "\r\n"])
def test_conll_reader_line_ends_and_docstart(spark, eol):
    d = tempfile.mkdtemp(prefix="dw-conll-")
    lines = ["-DOCSTART- -X- -X- O", "", "EU NNP B-NP B-ORG", "rejects VBZ B-VP O", "",
             "Peter NNP B-NP B-PER", "-DOCSTART- -X- -X- O", "Blackburn NNP I-NP I-PER", "", "", "x Y Z O"]
    with open(os.path.join(d, "train.txt"), "w", newline="") as f:
        f.write(eol.join(lines) + eol)
    rows = files.read_conll(spark, d).collect()
    got = {}
    for r in rows:
        got.setdefault(r["sent_id"], {})[r["tok_idx"]] = (r["token"], r["pos"], r["chunk"], r["label"])
    assert sorted([s[i] for i in sorted(s)] for s in got.values()) == [
        [("Blackburn", "NNP", "I-NP", "I-PER")],
        [("EU", "NNP", "B-NP", "B-ORG"), ("rejects", "VBZ", "B-VP", "O")],
        [("Peter", "NNP", "B-NP", "B-PER")], [("x", "Y", "Z", "O")]]


@pytest.mark.parametrize("eol", ["\n", "\r\n"])
def test_conll_reader_reads_split_files(spark, eol):
    d = tempfile.mkdtemp(prefix="dw-conll-")
    rng, want = random.Random(3), []
    for name in ("a.txt", "b.txt"):
        lines, sent = ["-DOCSTART- -X- -X- O", ""], 2
        for s in range(40):
            for i in range(rng.randint(1, 9)):
                lines.append(f"w{s}x{i}é P B-NP O")
                want.append((name, sent, i, f"w{s}x{i}é"))
            ends = rng.choice([[""], ["", ""], ["-DOCSTART- -X- -X- O", ""], [" "]])
            lines += ends
            sent += len(ends)
        with open(os.path.join(d, name), "w", newline="", encoding="utf-8") as f:
            f.write(eol.join(lines) + eol)
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.coalescePartitions.enabled")
    before = {k: spark.conf.get(k) for k in names}
    spark.conf.set(names[1], "false")
    try:
        for size in (97, 1000):  # blocks that end inside lines, sentences and line ends
            spark.conf.set(names[0], str(size))
            rows = files.read_conll(spark, d)
            assert spark.read.text(d).rdd.getNumPartitions() > 2
            assert rows.filter(F.col("sent_id").contains("a.txt")).select(
                F.spark_partition_id()).distinct().count() > 1  # a file is no single task's work
            got = [(os.path.basename(file), int(sent), r["tok_idx"], r["token"])
                   for r in rows.collect() for file, sent in [r["sent_id"].rsplit("#", 1)]]
            assert sorted(got) == sorted(want)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_jdbc_options():
    part = jdbc.Partitioning("id", 0, 37000, 5)
    o = jdbc.jdbc_options("jdbc:x://h/db", sql="select 1", props={"user": "u"}, partition=part)
    assert o["dbtable"] == "(select 1) as q" and o["numPartitions"] == "5" and o["user"] == "u"
    assert jdbc.jdbc_options("jdbc:x://h/db", sql="select 1", as_query=True)["query"] == "select 1"
    with pytest.raises(ValueError):
        jdbc.jdbc_options("jdbc:x://h/db", sql="select 1", as_query=True, partition=part)
    sql = jdbc.derived_content_sql(1000, 100000, 30)
    assert "left join source" in sql and "limit 30" in sql and "nulls first, c.id" in sql


def test_stream_enriches_each_file_once(spark):
    from docweave.streaming.incremental import enrich_stream
    src = tempfile.mkdtemp(prefix="dw-stream-src-")
    out = tempfile.mkdtemp(prefix="dw-stream-out-")
    content = tb.content(spark, SF_SMALL).filter(F.col("structure_size") < 3000)
    content.repartition(3).write.mode("overwrite").parquet(src + "/a")
    q = enrich_stream(spark, src + "/a", content.schema, out, min_size=None, max_size=None,
                      files_per_batch=1, checkpoint=tempfile.mkdtemp(prefix="dw-ckpt-"))
    q.awaitTermination(300)
    got = spark.read.parquet(out)
    assert got.count() == content.count()
    assert got.select("id").distinct().count() == content.count()
    assert "keywords" in got.columns and "sentences" in got.columns


def test_command_line_job(spark):
    from docweave.__main__ import main
    out = os.path.join(tempfile.mkdtemp(prefix="dw-cli-"), "idx")
    main(["enrich", "--tables", SF_SMALL, "--out", out, "--batch", "5"])
    rows = spark.read.json(out)
    assert rows.count() == 5 and {"sentences", "entities", "keywords", "source"} <= set(rows.columns)
