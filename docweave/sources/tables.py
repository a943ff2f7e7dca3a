"""Test tables and the mapping from them to the enrichment job's tables.

The job reads a ``content`` table (id, title, uri, body_text, structure_size,
source_id, last_updated, index_date) and a ``source(id, label)`` lookup.  The
driver's ``documents`` table has the text but no timestamps, so the missing
columns are *derived* here with plain column expressions (the same formulas are
used by the DuckDB oracle):

* ``last_updated``: ``date '2020-01-01' + (doc_id * 7919) % 1500`` days, a
  deterministic scatter standing in for an edit time;
* ``index_date``: set for documents found in ``labels`` (those count as
  already indexed), NULL otherwise;
* ``source(id, label)``: the distinct ``documents.source`` values except
  ``src19``, so the left join keeps unmatched rows.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def last_updated(doc_id: str = "doc_id"):
    return F.date_add(F.lit("2020-01-01").cast("date"),
                      ((F.col(doc_id) * 7919) % 1500).cast("int"))


def content(spark: SparkSession, sf_dir: str, with_index_date: bool = False) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = docs.select(
        F.col("doc_id").alias("id"),
        F.split(F.col("text"), "\n").getItem(0).alias("title"),
        F.concat(F.lit("doc:"), F.col("source"), F.lit("/"), F.col("doc_id").cast("string")).alias("uri"),
        F.col("text").alias("body_text"),
        F.col("n_chars").alias("structure_size"),  # native type: size predicates reach the scan
        F.substring(F.col("source"), 4, 10).cast("int").alias("source_id"),
        last_updated("doc_id").alias("last_updated"),
    )
    if with_index_date:
        done = ledger(spark, sf_dir).withColumnRenamed("id", "__done")
        out = (out.join(done, out["id"] == done["__done"], "left")
               .withColumn("index_date",
                           F.when(F.col("__done").isNotNull(), F.date_add(F.col("last_updated"), 1)))
               .drop("__done"))
    return out


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids already indexed (the labelled documents)."""
    return table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"))


def source(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return (docs.select("source").distinct()
            .filter(F.col("source") != "src19")
            .select(F.substring("source", 4, 10).cast("int").alias("id"),
                    F.col("source").alias("label")))


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` with the text of their ``<title>`` element."""
    pages = table(spark, sf_dir, "pages")
    return pages.select(
        F.col("page_id").alias("id"),
        F.regexp_extract("html", r"<title>([^<]*)</title>", 1).alias("title"))


def save_bucketed(df: DataFrame, table_name: str, id_col: str, buckets: int, mode: str = "overwrite") -> None:
    """Store a document table bucketed (and sorted) by its id in the session
    catalog.  Reading it back with ``spark.table`` gives a scan that is
    already hash-partitioned by the id, so the per-document operators run
    with ``keep_layout=True`` and shuffle nothing."""
    (df.write.mode(mode).bucketBy(buckets, id_col).sortBy(id_col).format("parquet")
     .saveAsTable(table_name))
