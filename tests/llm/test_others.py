"""Quality scores, archives, neighbours and the pipeline."""

import gzip
import hashlib
import io

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from docweave.llm import op1_quality, op2_warc, op6_nndescent, queries
from docweave.llm.common import Scratch
from tests.conftest import SF_SMALL
from tests.llm.test_documents import AWKWARD, check_windows, frame


# --- quality scores -----------------------------------------------------------
def test_isotonic_pools_what_falls():
    out = op1_quality.isotonic(np.array([0, 2, 1, 4.0]), np.array([2, 2, 2, 4.0]))
    assert out.tolist() == [0, 0.75, 0.75, 1.0]


def test_scores_of_held_out_documents(spark):
    out = queries.op1_rff_quality(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = out.filter("held_out").join(labels, "doc_id").collect()
    assert sum((r["score"] >= 0.5) == bool(r["quality"]) for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)


def test_scores_do_not_depend_on_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    turned = labels.withColumn("quality", F.when(queries.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (op1_quality.score_documents(docs, x, learn=~queries.held_out()).orderBy("doc_id").collect()
            for x in (labels, turned))
    assert a == b


def test_scores_of_awkward_and_empty_tables(spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 0), (6, None), (None, 1)], "doc_id long, quality int")
    assert op1_quality.score_documents(frame(spark), labels).count() == len(AWKWARD)
    none = op1_quality.score_documents(frame(spark), labels.limit(0)).collect()
    assert all(abs(r["score"] - 0.5) < 0.01 for r in none)
    assert op1_quality.score_documents(frame(spark, []), labels).count() == 0


# --- archives -----------------------------------------------------------------
PAGES = "page_id long, url string, html string, salt int, body string"


def test_archives_round_trip(spark):
    page = "<p>é\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc</p>" * 3
    rows = [(5, "http://x/5 ?a=ü", page), (3, "http://x/3", page), (9, None, page), (1, "http://x/1", "short"),
            (2, "http://x/2", "short"), (4, "u\r\nv", None), (6, "", ""), (None, "http://x/n", page), (3, "http://x/3", page),
            (7, "http://x/7", "z" * 100), (8, "http://x/8", "z" * 100), (10, "h", "z" * 99), (11, "h", "z" * 99)]
    df = spark.createDataFrame([(*r, 1, "clash") for r in rows], PAGES)
    path = Scratch(spark, "w").path("warc")
    op2_warc.write_warc(df, path)
    got = op2_warc.read_warc(spark, path).collect()
    assert len(got) == len(rows)
    want = {}
    for i, url, html in rows:
        data = (html or "").encode()
        same = [j for j, _, h in rows if h == html and j is not None]
        revisit = len(data) >= 100 and len([h for *_, h in rows if h == html]) > 1 and i != min(same)
        want.setdefault((i, url), (len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response",
                                   min(same) if revisit else None, None if revisit else data))
    for r in got:
        payload = None if r["payload"] is None else bytes(r["payload"])
        assert want[r["page_id"], r["url"]] == (r["payload_bytes"], r["payload_digest"], r["record_type"],
                                                r["refers_to"], payload)


def test_archives_are_checked_when_read():
    record = b"WARC/1.1\r\nContent-Length: 3\r\nX: y\r\n\r\nabc\r\n\r\n"
    stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(gzip.compress(record * 2))))
    assert [b for _, b in op2_warc.parse_warc(stream)] == [b"abc", b"abc"]
    with pytest.raises(ValueError):
        list(op2_warc.parse_warc(io.BytesIO(b"no record\r\n")))


def test_archives_of_an_empty_table(spark):
    path = Scratch(spark, "w").path("none")
    op2_warc.write_warc(spark.createDataFrame([], PAGES), path)
    assert op2_warc.read_warc(spark, path).count() == 0


# --- neighbours ---------------------------------------------------------------
def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, v int")


def brute_neighbours(rows, q, top=10):
    x = {i: np.array(v, float) for i, v, *_ in rows}
    found = sorted((float(np.sqrt(((x[q] - v) ** 2).sum())), i) for i, v in x.items() if i != q)
    return found[:top]


def test_neighbours_equal_brute_force_mostly(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 16))
    data = (centres[rng.integers(0, 12, 1500)] + 0.4 * rng.normal(size=(1500, 16))).astype(np.float32)
    data[300:700] = data[300]  # one very common vector
    rows = [(i, v.tolist(), 0, 0) for i, v in enumerate(data)]
    out = op6_nndescent.nearest_neighbours(vectors(spark, rows), F.col("id") % 50 == 0)
    got = {}
    for r in out.orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
    hits = 0
    for q in range(0, 1500, 50):
        want = brute_neighbours(rows, q)
        assert len(got[q]) == 10 and got[q] == sorted(got[q])
        hits += sum(s <= want[-1][0] + 1e-9 for s, _ in got[q])
    assert hits >= 0.95 * 10 * 30
    assert [i for _, i in got[350]] == list(range(300, 310))


def test_neighbours_beyond_small_tight_groups(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(250, 32)) * 100  # groups of 8: the tenth neighbour is in another group
    tight = centres[np.arange(2000) % 250] + 0.01 * rng.normal(size=(2000, 32))
    ties = rng.integers(0, 2, size=(2000, 24))  # many equal distances: the smaller ids count
    for data in (tight.astype(np.float32), ties.astype(np.float32)):
        rows = [(i, v.tolist(), 0, 0) for i, v in enumerate(data) if v.any()]
        out = op6_nndescent.nearest_neighbours(vectors(spark, rows), F.col("id") % 100 == 0)
        got = {}
        for r in out.orderBy("query_id", "rank").collect():
            got.setdefault(r["query_id"], []).append(r["vec_id"])
        for q in got:
            assert got[q] == [i for _, i in brute_neighbours(rows, q)]
        assert len(got) == 20


def test_neighbours_of_few_and_unusable_vectors(spark):
    rows = [(0, [1.0, 0.0], 1, 1), (1, [0.0, 1.0], 1, 1), (2, [1.0, 0.0], 1, 1), (2, [1.0, 0.0], 1, 1),
            (3, None, 1, 1), (4, [0.0, 0.0], 1, 1), (5, [float("nan"), 1.0], 1, 1), (6, [float("inf"), 1.0], 1, 1),
            (7, [None, 1.0], 1, 1), (8, [], 1, 1), (9, [1.0, 2.0, 3.0], 1, 1), (None, [1.0, 1.0], 1, 1)]
    out = op6_nndescent.nearest_neighbours(vectors(spark, rows), F.lit(True)).orderBy("query_id", "rank").collect()
    root = 2 ** 0.5
    assert [(r["query_id"], r["rank"], r["vec_id"], round(r["score"], 6)) for r in out] == [
        (0, 1, 2, 0.0), (0, 2, 1, round(root, 6)), (1, 1, 0, round(root, 6)), (1, 2, 2, round(root, 6)),
        (2, 1, 0, 0.0), (2, 2, 1, round(root, 6))]
    assert op6_nndescent.nearest_neighbours(vectors(spark, []), F.lit(True)).count() == 0
    assert op6_nndescent.nearest_neighbours(vectors(spark, rows[:1]), F.lit(True)).count() == 0


# --- the pipeline -------------------------------------------------------------
def test_stages_keep_the_columns_and_their_decisions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    scratch = Scratch(spark, "p")
    at, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        at = scratch.save(stage(spark, at, SF_SMALL), name)
        seen[name] = at
    for name in list(seen)[:-1]:
        assert seen[name].columns == docs.columns, name
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    kept = seen["quality_rules"].join(labels, "doc_id")
    assert kept.filter("quality = 0").count() == 0
    good = docs.join(labels.filter("quality = 1"), "doc_id").count()
    assert kept.count() >= 0.93 * good
    assert seen["near_duplicates"].count() == seen["near_duplicates"].select("doc_id").distinct().count()
    assert seen["personal_data"].filter(F.col("text").rlike(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")).count() == 0
    texts = [r["text"] for r in seen["mixing"].collect()]
    assert check_windows(seen["packing"].collect(), texts) < 1.05


def test_pipeline_of_an_empty_table(spark):
    at = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    scratch = Scratch(spark, "p")
    for name, stage in corpus_pipeline.STAGES:
        at = scratch.save(stage(spark, at, SF_SMALL), name)
    assert at.count() == 0


def test_queries_are_registered():
    import __spark_entry__ as E
    names = E.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 11)}
    assert "pipeline" in names and set(E.oracle_sql()) <= set(names)


def test_few_neighbours_take_few_tasks(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.normal(size=8)], 0, 0) for i in range(300)]
    files, save = {}, op6_nndescent.Scratch.save

    def counted(self, df, name):
        out = save(self, df, name)
        files[name] = len(out.inputFiles())
        return out
    monkeypatch.setattr(op6_nndescent.Scratch, "save", counted)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = op6_nndescent.nearest_neighbours(vectors(spark, rows), F.col("id") % 50 == 0).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert {n for name, n in files.items() if name.startswith(("graph", "seen"))} == {1}  # no task of a few rows
    x = np.array([v for _, v, *_ in rows])
    x = x.astype(np.float32).astype(float)
    for q in range(0, 300, 50):
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        want = [i for i in np.lexsort((np.arange(300), d)) if i != q][:10]
        assert [r["vec_id"] for r in sorted(out, key=lambda r: r["rank"]) if r["query_id"] == q] == want
