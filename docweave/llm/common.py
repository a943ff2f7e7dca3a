"""Helpers shared by the operators: scratch tables, the word rule, table access."""

from __future__ import annotations

import contextlib
import os
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave.session import checkpoint_dir

#: Words are maximal runs of anything but space, tab, LF, VT, FF and CR.  On
#: UTF-8 bytes that is ``bytes.split()`` without arguments.
WORD_RE = r"[^\x20\x09-\x0D]+"

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


@contextlib.contextmanager
def freed_shuffles(spark: SparkSession):
    """Shuffle files of the statements inside are removed when each ends."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


class Scratch:
    """Intermediate tables in one fresh folder below ``spark.checkpoint.dir``.

    ``save`` writes a frame as Parquet and rereads it, which cuts the lineage
    with files every executor can see; ``drop`` removes one that is no longer
    read, so that the folder holds the live ones only.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        with freed_shuffles(self.spark):
            df.write.option("compression", "zstd").mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.path(name))
            fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
            fs.delete(path, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(docs: DataFrame, text_col: str) -> int:
    """Total UTF-8 bytes of a text column (one number)."""
    return docs.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))).first()[0]


def chunk_count(total_bytes: int, per_chunk: int) -> int:
    return max(1, -(-total_bytes // per_chunk))


def from_text(df: DataFrame, text_col: str, keep: tuple[str, ...], added: str, fn) -> DataFrame:
    """The columns ``keep`` unchanged, and those of the DDL string ``added``,
    which ``fn`` returns as Arrow arrays for a list of texts (None if null)."""
    schema = T.StructType([df.schema[c] for c in keep] + list(T._parse_datatype_string(added)))
    names = schema.names

    def run(batches):
        for batch in batches:
            texts = batch.column(len(keep)).to_pylist()
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], *fn(texts)], names)

    return df.select(*keep, F.col(text_col).alias("__text")).mapInArrow(run, schema)
