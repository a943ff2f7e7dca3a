"""WARC archives with revisit records instead of repeated payloads.

Only headers (digest, length, id, url) are grouped: the first page of each
digest is found from per-salt minima, so one payload may belong to any share
of the pages.  The archives are text files written by Spark's own committer
(one record per row, the record separator as line separator, gzip), read back
by Content-Length, never by looking for separators.

Defined cases: a null payload is empty; payloads under ``min_bytes`` are
always ``response``; a page without an id is never the original, and revisits
the smallest id when there is one; repeated rows with the original's id and
payload are all ``response``; other columns of the input are ignored; an empty
table gives archives without records.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import urllib.parse

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SALTS = 64
#: Payloads from this size on are worth a revisit record.
MIN_BYTES = 100
#: Rows of one archive file at most, which bounds the file a reader holds.
RECORDS_PER_FILE = 10_000
DATE = "2020-01-01T00:00:00Z"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD = ("page_id long, url string, record_type string, refers_to long, payload_bytes long, "
          "payload_digest string, payload binary")


def resolve_revisits(headers: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """(digest, salt, original_id, original_url) for digests of several pages.

    ``headers``: page_id, url, payload_bytes, payload_digest, salt.
    """
    parts = (headers.filter((F.col("payload_bytes") >= min_bytes))
             .groupBy("payload_digest", "salt")
             .agg(F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))).alias("first"),
                  F.count(F.lit(1)).alias("n")))
    firsts = (parts.groupBy("payload_digest").agg(F.min("first").alias("original"), F.sum("n").alias("n"))
              .filter((F.col("n") > 1) & F.col("original").isNotNull()).drop("n"))
    return (parts.select("payload_digest", "salt").join(firsts, "payload_digest")
            .select("payload_digest", "salt", F.col("original.page_id").alias("original_id"),
                    F.col("original.url").alias("original_url")))


def with_headers(pages: DataFrame) -> DataFrame:
    body = F.coalesce(F.col("html"), F.lit(""))
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url"), body.alias("body"),
        F.octet_length(body).cast("long").alias("payload_bytes"),
        F.sha2(body.cast("binary"), 256).alias("payload_digest"),
        F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).alias("salt"))


def _urn(page_id: Column, url: Column) -> Column:
    h = F.md5(F.concat_ws("|", F.coalesce(page_id.cast("string"), F.lit("")), F.coalesce(url, F.lit(""))))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(h, "^(.{8})(.{4})(.{4})(.{4})(.{12})$",
                                                          "$1-$2-$3-$4-$5"), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    return F.when(value.isNotNull(), F.concat(F.lit(name + ": "), value.cast("string"), F.lit("\r\n"))) \
        .otherwise(F.lit(""))


def warc_records(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """One column ``value``: the text of each page's record, without its end."""
    rows = with_headers(pages)
    originals = resolve_revisits(rows.drop("body"), min_bytes)
    rows = rows.join(originals, ["payload_digest", "salt"], "left")
    uri = F.url_encode(F.col("url"))
    revisit = (F.col("original_id").isNotNull() & (F.col("payload_bytes") >= min_bytes)
               & ~F.col("page_id").eqNullSafe(F.col("original_id")))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit(END))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("body")))
    only = lambda c: F.when(revisit, c)
    return rows.select(F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _urn(F.col("page_id"), F.col("url"))),
        _line("WARC-Date", F.lit(DATE)),
        _line("WARC-Target-URI", uri),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        _line("WARC-Profile", only(F.lit(PROFILE))),
        _line("WARC-Refers-To", only(_urn(F.col("original_id"), F.col("original_url")))),
        _line("WARC-Refers-To-Target-URI", only(F.url_encode("original_url"))),
        _line("X-Refers-To-Page", only(F.col("original_id"))),
        _line("X-Page", F.col("page_id")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        _line("Content-Length", F.octet_length(block)),
        F.lit("\r\n"), block).alias("value"))


def write_warc(pages: DataFrame, path: str, min_bytes: int = MIN_BYTES) -> None:
    (warc_records(pages, min_bytes).write.option("lineSep", END).option("compression", "gzip")
     .option("maxRecordsPerFile", RECORDS_PER_FILE).mode("overwrite").text(path))


def parse_warc(stream):
    """(headers, block) of each record of a binary stream."""
    while True:
        line = stream.readline()
        if not line:
            return
        if line == b"\r\n":
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record starts with {line[:40]!r}")
        headers = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().rstrip("\r\n").partition(": ")
            headers[name] = value
        yield headers, stream.read(int(headers["Content-Length"]))


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of the archives below ``path``.  Digest and size of a
    response come from the payload as read; those of a revisit from its
    headers, as it holds no payload.  ``payloads=False`` leaves them null."""

    def records(batches):
        for batch in batches:
            for content in batch["content"]:
                rows = []
                for h, block in parse_warc(io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content)))):
                    head, _, payload = block.partition(b"\r\n\r\n")
                    size = int(head.rpartition(b"Content-Length: ")[2].split(b"\r\n")[0])
                    stated = h["WARC-Payload-Digest"].removeprefix("sha256:")
                    whole = h["WARC-Type"] == "response"
                    if whole and (hashlib.sha256(payload).hexdigest() != stated or len(payload) != size):
                        raise ValueError(f"record {h['WARC-Record-ID']} does not match its digest")
                    url = h.get("WARC-Target-URI")
                    rows.append((h.get("X-Page"), None if url is None else urllib.parse.unquote_plus(url),
                                 h["WARC-Type"], h.get("X-Refers-To-Page"), size, stated,
                                 payload if whole and payloads else None))
                    if len(rows) >= 500:
                        yield _frame(rows)
                        rows = []
                if rows:
                    yield _frame(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInPandas(records, RECORD)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["page_id", "url", "record_type", "refers_to", "payload_bytes",
                                      "payload_digest", "payload"])
    for c in ("page_id", "refers_to"):
        out[c] = pd.array([None if v is None else int(v) for v in out[c]], "Int64")
    return out
