"""Several outputs published as one (G6), and a batched sink with commit (K4).

``publish`` writes each output into a folder of its own epoch and then, with one
rename, the small file that names the epoch: readers see all outputs of a run or none.

``BatchedSink`` is a Python data source: every task sends its rows in batches to files
of its own below a staging folder, and only the driver's commit, which
knows the files of the task attempts that count, publishes them; a failed or
repeated attempt leaves no rows.
"""

from __future__ import annotations

import itertools
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

CURRENT = "_current"


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def publish(spark: SparkSession, base: str, outputs: dict[str, DataFrame], fmt: str = "parquet",
            epoch: str | None = None) -> str:
    """Write the outputs as one epoch below ``base`` and make it the current one."""
    epoch = epoch or uuid.uuid4().hex
    for name, df in outputs.items():
        df.write.format(fmt).mode("overwrite").save(f"{base}/{epoch}/{name}")
    note = spark.createDataFrame([(json.dumps({"epoch": epoch, "format": fmt, "outputs": sorted(outputs)}),)], "value string")
    note.coalesce(1).write.mode("overwrite").text(f"{base}/{epoch}/_note")
    # the folder with the note is renamed into place: one operation of the file system
    fs, source = _hadoop(spark, f"{base}/{epoch}/_note")
    target = _hadoop(spark, f"{base}/{CURRENT}-{epoch}")[1]
    if not fs.rename(source, target):
        raise OSError(f"could not publish {target}")
    for status in fs.listStatus(_hadoop(spark, base)[1]):
        name = status.getPath().getName()
        if name.startswith(f"{CURRENT}-") and name != f"{CURRENT}-{epoch}":
            fs.delete(status.getPath(), True)
    return epoch


def current(spark: SparkSession, base: str) -> dict | None:
    """The published epoch (the newest, should two be named at once), or None."""
    fs, path = _hadoop(spark, base)
    if not fs.exists(path):
        return None
    notes = [(s.getModificationTime(), s.getPath().getName()) for s in fs.listStatus(path)
             if s.getPath().getName().startswith(f"{CURRENT}-")]
    return json.loads(spark.read.text(f"{base}/{max(notes)[1]}").first()[0]) if notes else None


def read_published(spark: SparkSession, base: str, name: str) -> DataFrame:
    """One output of the current epoch."""
    now = current(spark, base)
    if now is None or name not in now["outputs"]:
        raise FileNotFoundError(f"no published output {name!r} in {base}")
    return spark.read.format(now["format"]).load(f"{base}/{now['epoch']}/{name}")


@dataclass
class SentFiles(WriterCommitMessage):
    files: list[str]
    rows: int
    batches: int


@dataclass
class OneFile(InputPartition):
    path: str


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


class BatchedWriter(DataSourceWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path, self.batch = options["path"], int(options.get("batch", 1000))
        self.fail_once = options.get("fail_once")  # tests: a marker file; its first finder fails
        self.overwrite = overwrite
        self.job = uuid.uuid4().hex

    def write(self, iterator: Iterator) -> SentFiles:
        fs, root = _open(self.path)
        fs.create_dir(f"{root}/_staged-{self.job}")
        files, rows = [], 0
        attempt = uuid.uuid4().hex
        while chunk := list(itertools.islice(iterator, self.batch)):
            name = f"_staged-{self.job}/{attempt}-{len(files):06d}.json"
            with fs.open_output_stream(f"{root}/{name}") as out:
                out.write("".join(json.dumps(r.asDict(recursive=True), default=str) + "\n" for r in chunk).encode())
            files.append(name)
            rows += len(chunk)
            if self.fail_once and fs.get_file_info(self.fail_once).type == pafs.FileType.NotFound:
                with fs.open_output_stream(self.fail_once) as out:
                    out.write(b"failed")
                raise OSError("asked to fail")
        return SentFiles(files, rows, len(files))

    def commit(self, messages: list) -> None:
        fs, root = _open(self.path)
        fs.create_dir(root)
        before = [] if self.overwrite else manifest(self.path)
        sent = before + [{"file": f} for m in messages if m for f in m.files]
        with fs.open_output_stream(f"{root}/_manifest-{self.job}") as out:
            out.write(json.dumps(sent).encode())
        fs.move(f"{root}/_manifest-{self.job}", f"{root}/_manifest")

    def abort(self, messages: list) -> None:
        fs, root = _open(self.path)
        if fs.get_file_info(f"{root}/_staged-{self.job}").type == pafs.FileType.Directory:
            fs.delete_dir(f"{root}/_staged-{self.job}")


def manifest(path: str) -> list[dict]:
    fs, root = _open(path)
    if fs.get_file_info(f"{root}/_manifest").type == pafs.FileType.NotFound:
        return []
    with fs.open_input_stream(f"{root}/_manifest") as f:
        return json.loads(f.read())


class BatchedReader(DataSourceReader):
    def __init__(self, path: str, columns: list[str]):
        self.path, self.columns = path, columns

    def partitions(self) -> list[OneFile]:
        return [OneFile(m["file"]) for m in manifest(self.path)]

    def read(self, partition: OneFile) -> Iterator[tuple]:
        if partition is None:
            return
        fs, root = _open(self.path)
        with fs.open_input_stream(f"{root}/{partition.path}") as f:
            for line in f.read().decode().splitlines():
                row = json.loads(line)
                yield tuple(row.get(c) for c in self.columns)


class BatchedSink(DataSource):
    """``df.write.format("docweave_batched").option("path", ...).option("batch", 1000)``;
    reading needs a schema of strings, numbers and booleans."""

    @classmethod
    def name(cls) -> str:
        return "docweave_batched"

    def writer(self, schema, overwrite: bool) -> BatchedWriter:
        return BatchedWriter(dict(self.options), overwrite)

    def reader(self, schema) -> BatchedReader:
        return BatchedReader(self.options["path"], schema.names)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(BatchedSink)
