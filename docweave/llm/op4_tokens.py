"""Token ids as Parquet list columns, in document order, for selective reads.

Documents are range-partitioned by id, encoded once, and written by Spark's
Parquet writer: ids as a dictionary-encoded list column, sorted document ids
delta-encoded, small row groups and pages with page indexes, so a reader can
fetch only the metadata columns, or only the pages of some documents.

Defined cases: a null text is empty and gives the end id alone; a null id
sorts first; rows of one id sort by their text, and may span files; an empty table writes no rows.
Other columns can be kept as metadata (``metadata``), unless they are named
like a column of the format, which is an error.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave.llm.common import chunk_count, text_bytes
from docweave.llm.tokens import encoder

#: UTF-8 bytes of text of one file.
FILE_TEXT_BYTES = 16 << 20
#: Characters of the text that help to cut the ranges, so that one id (or null) can be cut.
KEY_CHARS = 64
ROW_GROUP_BYTES = 4 << 20
PAGE_BYTES = 64 << 10
FORMAT = {"doc_id", "n_tokens", "ids"}


def parquet_options(encoding: str = "dictionary") -> dict[str, str]:
    """Writer options.  ``encoding`` of the ids: dictionary or delta."""
    if encoding not in ("dictionary", "delta"):
        raise ValueError(f"unknown encoding {encoding}")
    return {
        "parquet.writer.version": "v2",
        "parquet.block.size": str(ROW_GROUP_BYTES),
        "parquet.page.size": str(PAGE_BYTES),
        "parquet.page.row.count.limit": "1000",
        "parquet.enable.dictionary": "true",
        "parquet.enable.dictionary#doc_id": "false",
        "parquet.enable.dictionary#n_tokens": "false",
        "parquet.enable.dictionary#ids.list.element": str(encoding == "dictionary").lower(),
        "compression": "zstd",
    }


def encode_documents(docs: DataFrame, tokenizer: str, end_id: int, text_col: str = "text",
                     id_col: str = "doc_id", metadata: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_tokens, ids and the metadata columns, sorted by document id."""
    if clash := FORMAT & set(metadata):
        raise ValueError(f"metadata columns {sorted(clash)} belong to the format")
    n = chunk_count(text_bytes(docs, text_col), FILE_TEXT_BYTES)
    rows = (docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("__text"), *metadata)
            .repartitionByRange(n, "doc_id", F.left("__text", F.lit(KEY_CHARS))).sortWithinPartitions("doc_id", "__text"))
    end = int(end_id).to_bytes(4, "little")
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
                           *[rows.schema[c] for c in metadata]])

    def encode(batches):
        enc = encoder(tokenizer)
        for batch in batches:
            ids = [enc.encode(t.as_py()) + end for t in batch["__text"]]
            counts = np.array([len(b) // 4 for b in ids], np.int64)
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            values = pa.array(np.frombuffer(b"".join(ids), "<i4"))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(counts), pa.ListArray.from_arrays(pa.array(offsets), values),
                 *[batch[c] for c in metadata]], ["doc_id", "n_tokens", "ids", *metadata])

    return rows.mapInArrow(encode, schema)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, encoding: str = "dictionary",
                 **columns) -> None:
    frame = encode_documents(docs, tokenizer, end_id, **columns)
    frame.write.options(**parquet_options(encoding)).mode("overwrite").parquet(path)


def read_tokens(spark: SparkSession, path: str, columns: tuple[str, ...] = ("doc_id", "n_tokens", "ids")) -> DataFrame:
    """The chosen columns; other columns' pages are not read."""
    return spark.read.parquet(path).select(*columns)


#: Number of a file among those Spark writes: task, then file of the task.  Names alone
#: don't sort (``part-100000`` before ``part-99999``).
FILE_NUMBER = r"part-(\d+).*?-c(\d+)"


def file_order(name: str = "part") -> list[Column]:
    """Columns that sort the written files as their documents lie in them."""
    return [F.regexp_extract(name, FILE_NUMBER, i).cast("long").alias(f"__file{i}") for i in (1, 2)]


def with_starts(rows: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """Adds ``start``, the ids of all documents before it, to (part, row, n_tokens, ...).
    A file is one range of documents, so the running sums stay inside files and
    only one total per file is summed across them (of ``counts``: part and n_tokens,
    where they can be had for less than the rows)."""
    totals = (rows if counts is None else counts).groupBy("part").agg(F.sum("n_tokens").alias("total"))
    earlier = Window.orderBy(*file_order()).rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(F.col("part").alias("__part"), F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("before"))
    inside = F.sum("n_tokens").over(
        Window.partitionBy("part").orderBy("row").rowsBetween(Window.unboundedPreceding, -1))
    return (rows.withColumn("inside", F.coalesce(inside, F.lit(0))).join(before, F.col("part") == F.col("__part"))
            .withColumn("start", F.col("before") + F.col("inside")).drop("__part", "before", "inside"))


def _located(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select(
        "*", F.col("_metadata.file_name").alias("part"), F.col("_metadata.row_index").alias("row"))


def file_counts(spark: SparkSession, path: str) -> DataFrame:
    """part and n_tokens of every document, from the metadata columns alone."""
    return _located(spark, path).select("part", "n_tokens")


def token_offsets(spark: SparkSession, path: str) -> DataFrame:
    """part, row, doc_id, n_tokens and ``start`` from the metadata columns alone.
    ``part`` and ``row`` name the row in its file."""
    return with_starts(_located(spark, path).select("part", "row", "doc_id", "n_tokens"))


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """part, row, doc_id, and the CRC-32 and number (n_tokens) of each document's ids as
    they stand in the files, in one read."""
    rows = _located(spark, path).select("part", "row", "doc_id", "ids")

    def digest(batches):
        for batch in batches:
            ids = batch.column(3)
            bounds = ids.offsets.to_numpy()
            raw = memoryview(np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False), "<u4")).cast("B")
            crcs = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(bounds, bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(crcs, pa.int64()), pa.array(np.diff(bounds).astype(np.int64))],
                ["part", "row", "doc_id", "ids_crc32", "n_tokens"])

    return rows.mapInArrow(digest, "part string, row long, doc_id long, ids_crc32 long, n_tokens long")
