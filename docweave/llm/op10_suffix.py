"""Removal of long repeated byte strings by window hashes, blockwise over a difference cover.

No suffix order and no ranks are built: windows of ``LENGTH`` bytes are compared by
64-bit hashes, and the cover only says which of them need one.

A string of ``LENGTH`` bytes that starts at two places covers, at one common
offset below the period, a sampled position in both (the cover has every
difference modulo the period).  So:

1. Windows at sampled positions (9 %), of the depth that fits behind any offset, are
   hashed and bucketed; each bucket is sorted by one task, which tells those
   without an equal apart.
2. Only positions with a tied sample within reach can tie over ``LENGTH``
   bytes.  Their windows are hashed block by block: a round makes those of one
   share of the buckets alone, sorts each bucket in one task, and returns one
   bit per window.  The number of rounds follows from the ties, so that the
   keys in flight stay below ``SHARE`` of the text.
3. Bits become removed bytes, document by document.

The result needs only ties, not the alphabet's order; unequal windows tie with
probability about n**2 / 2**65.  A chunk sends each key
once, however often it occurs there, so no bucket grows with the copies of a
string beyond one entry per chunk, and gets its bits back in the order sent.

Defined cases: a null text has no bytes; matches never cross documents but may
lie in one; repeated rows are copies of each other; a null id is a document
like any other; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm.common import Scratch, chunk_count, shuffle_partitions, text_bytes
from docweave.llm.shingles import BASE, INVERSE, U, mix, powers

LENGTH = 200
#: A perfect difference set, every residue but 0 is one difference.
PERIOD = 133
COVER = np.array([1, 8, 9, 11, 25, 37, 69, 88, 94, 99, 103, 121])
DEPTH = LENGTH - PERIOD + 1
CHUNK_BYTES = 4 << 20
RUN = 1 << 20
KEYS_PER_BUCKET = 1 << 20
#: Bytes of keys of one round, as a share of the bytes of text.
SHARE = 0.6

_CODES = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)


class Chunk:
    """The documents of a chunk, in an order that does not depend on the shuffle."""

    def __init__(self, rows: pa.Table):
        ids = rows["doc_id"].to_pylist()
        texts = [t or b"" for t in rows["body"].to_pylist()]
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, texts[i]))
        self.ids = [ids[i] for i in order]
        texts = [texts[i] for i in order]
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])[:-1]

    def keys(self, positions: np.ndarray, length: int) -> np.ndarray:
        """Hash of the ``length`` bytes from each position (ascending)."""
        out = np.empty(len(positions), U)
        edges = np.arange(0, len(self.data) + RUN, RUN)
        cuts = np.searchsorted(positions, edges)
        for a, i, j in zip(edges, cuts, cuts[1:]):
            if i < j:
                part = self.data[a:a + RUN + length]
                sums = np.zeros(len(part) + 1, U)
                np.cumsum(_CODES[part] * powers(BASE, len(part)), out=sums[1:])
                at = positions[i:j] - a
                out[i:j] = mix((sums[at + length] - sums[at]) * powers(INVERSE, len(part))[at])
        return out

    def samples(self) -> tuple[np.ndarray, np.ndarray]:
        """Sampled positions with ``DEPTH`` bytes after them, and their documents."""
        most = int(self.sizes.max(initial=0))
        pattern = (np.arange(-(-most // PERIOD))[:, None] * PERIOD + COVER).ravel()
        counts = np.searchsorted(pattern, np.maximum(self.sizes - DEPTH + 1, 0))
        owner = np.repeat(np.arange(len(self.sizes)), counts)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        return self.starts[owner] + pattern[inside], owner

    def candidates(self, positions: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Starts of whole windows that have one of these positions in reach."""
        edges = np.zeros(len(self.data) + 1, np.int32)
        np.add.at(edges, np.maximum(positions - PERIOD + 1, self.starts[owner]), 1)
        np.add.at(edges, positions + 1, -1)
        near = np.cumsum(edges[:-1]) > 0
        whole = np.zeros(len(self.data) + 1, np.int32)
        long = self.sizes >= LENGTH
        np.add.at(whole, self.starts[long], 1)
        np.add.at(whole, (self.starts + self.sizes - LENGTH + 1)[long], -1)
        return np.flatnonzero(near & (np.cumsum(whole[:-1]) > 0))


class Sent:
    """Distinct keys of a chunk, ascending, cut into buckets of the key space."""

    def __init__(self, keys: np.ndarray, buckets: int):
        self.keys, self.back, counts = np.unique(keys, return_inverse=True, return_counts=True)
        self.repeated = counts > 1
        width = -(-(1 << 64) // buckets)
        self.cuts = np.searchsorted(self.keys, np.array([min(b * width, (1 << 64) - 1) for b in range(buckets)], U))
        self.cuts = np.append(self.cuts, len(self.keys))

    def blocks(self, chunk: int, which) -> pa.Table:
        used = [b for b in which if self.cuts[b] < self.cuts[b + 1]]
        return pa.table({"chunk": pa.array([chunk] * len(used), pa.int32()), "bucket": pa.array(used, pa.int32()),
                         "keys": pa.array([self.keys[self.cuts[b]:self.cuts[b + 1]].tobytes() for b in used],
                                          pa.binary())})

    def tied(self, blocks: pa.Table) -> np.ndarray:
        """Per original key: does it occur twice, here or in another chunk?"""
        tied = self.repeated.copy()
        for b, bits in zip(blocks["bucket"].to_pylist(), blocks["bits"].to_pylist()):
            a, z = self.cuts[b], self.cuts[b + 1]
            tied[a:z] |= np.unpackbits(np.frombuffer(bits, np.uint8), count=z - a).astype(bool)
        return tied[self.back]


def _sort_bucket(rows: pa.Table) -> pa.Table:
    """One bucket: a bit for each key that two chunks sent."""
    arrays = [np.frombuffer(k, U) for k in rows["keys"].to_pylist()]
    keys = np.concatenate(arrays)
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = ordered[1:] == ordered[:-1]
    tied = np.empty(len(keys), bool)
    tied[order] = same[:-1] | same[1:]
    cuts = np.cumsum([0] + [len(a) for a in arrays])
    return pa.table({"chunk": rows["chunk"], "bucket": rows["bucket"],
                     "bits": pa.array([np.packbits(tied[a:b]).tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
                     "n_tied": pa.array([int(tied[a:b].sum()) for a, b in zip(cuts, cuts[1:])], pa.int64())})


KEYS = "chunk int, bucket int, keys binary"
BITS = "chunk int, bucket int, bits binary, n_tied long"


def repeated_bytes(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                   share: float = SHARE, keep_bytes: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the kept bytes
    (null without ``keep_bytes``)."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "suffixes")
    total = text_bytes(docs, text_col)
    parts = shuffle_partitions(spark)
    n = max(chunk_count(total, CHUNK_BYTES), parts)
    body = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), body.alias("body"))
    # rows without an id spread by their text
    texts = texts.withColumn("chunk", F.pmod(F.xxhash64("doc_id", F.when(F.col("doc_id").isNull(), F.col("body"))),
                                             F.lit(n)).cast("int"))
    by_chunk = lambda df: df.groupBy("chunk")

    sampled = max(chunk_count(total * len(COVER) // PERIOD, KEYS_PER_BUCKET), parts)

    def send_samples(rows: pa.Table) -> pa.Table:
        chunk = Chunk(rows)
        positions, _ = chunk.samples()
        return Sent(chunk.keys(positions, DEPTH), sampled).blocks(rows["chunk"][0].as_py(), range(sampled))

    sent = by_chunk(texts).applyInArrow(send_samples, KEYS)
    ranked = scratch.save(sent.groupBy("bucket").applyInArrow(_sort_bucket, BITS), "samples")

    # A run of tied samples has PERIOD / len(COVER) suffixes for each; rounds
    # of buckets keep their keys below the share.  Repeats inside a chunk are
    # not counted here, nor sent more than once.
    tied = ranked.agg(F.coalesce(F.sum("n_tied"), F.lit(0))).first()[0]
    suffixes = tied * PERIOD // len(COVER)
    rounds = max(1, -(-8 * suffixes // max(1, int(share * total))))
    buckets = rounds * max(chunk_count(suffixes // rounds, KEYS_PER_BUCKET), parts)

    def suffixes_of(rows: pa.Table, blocks: pa.Table) -> tuple[Chunk, np.ndarray, Sent]:
        chunk = Chunk(rows)
        positions, owner = chunk.samples()
        ties = Sent(chunk.keys(positions, DEPTH), sampled).tied(blocks)
        found = chunk.candidates(positions[ties], owner[ties])
        return chunk, found, Sent(chunk.keys(found, LENGTH), buckets)

    def send_round(r: int):
        def send(rows: pa.Table, blocks: pa.Table) -> pa.Table:
            if not rows.num_rows:
                return pa.table({"chunk": pa.array([], pa.int32()), "bucket": pa.array([], pa.int32()),
                                 "keys": pa.array([], pa.binary())})
            _, _, sent = suffixes_of(rows, blocks)
            return sent.blocks(rows["chunk"][0].as_py(), range(r, buckets, rounds))

        return send

    results = None
    for r in range(rounds):
        sent = by_chunk(texts).cogroup(by_chunk(ranked)).applyInArrow(send_round(r), KEYS)
        part = scratch.save(sent.groupBy("bucket").applyInArrow(_sort_bucket, BITS), f"round{r}")
        results = part if results is None else results.unionByName(part)

    def cut(rows: pa.Table, blocks: pa.Table) -> pa.Table:
        schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                            ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])
        if not rows.num_rows:
            return schema.empty_table()
        first = blocks.filter(pc.equal(blocks["phase"], 1))
        chunk, found, sent = suffixes_of(rows, first)
        found = found[sent.tied(blocks.filter(pc.equal(blocks["phase"], 2)))]
        edges = np.zeros(len(chunk.data) + 1, np.int32)
        edges[found] += 1  # distinct positions
        edges[found + LENGTH] -= 1
        gone = np.cumsum(edges[:-1]) > 0
        out = []
        for doc, a, size in zip(chunk.ids, chunk.starts.tolist(), chunk.sizes.tolist()):
            g = gone[a:a + size]
            kept = chunk.data[a:a + size][~g].tobytes()
            spans = int(g[0]) + int((g[1:] & ~g[:-1]).sum()) if size else 0
            out.append((doc, size, size - len(kept), spans, hashlib.sha256(kept).hexdigest(),
                        kept if keep_bytes else None))
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    marks = ranked.withColumn("phase", F.lit(1)).unionByName(results.withColumn("phase", F.lit(2)))
    return by_chunk(texts).cogroup(by_chunk(marks)).applyInArrow(
        cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
