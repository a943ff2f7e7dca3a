"""N-gram Jaccard links by parity sketches.

A document's set of shingle hashes is folded by XOR.  Two folds are used.

* Segments: the hash space of a size band is cut into as many segments as the
  band's least size, and a segment's parity sketch is the XOR of the hashes in
  it.  Segments that differ cannot outnumber the symmetric difference D, and a
  link needs D <= (|A| + |B|) / 7.  So among any D + 1 non-empty segments of a
  document one agrees in both (pigeonhole); each document offers the D + 1
  rarest, in an order all documents share, and those that no other document
  has need no offer at all.
* A dense sketch of ``SKETCH_BITS`` parity bits, whose Hamming distance is at
  most D, drops most false candidates before their sets are compared.

Sizes fall into bands by powers of two; a document offers segments in its own
band and, if it may link to smaller documents, in the next lower one.

Equal sets are one class, whose smallest id stands for it.  Classes that share
a segment are compared with one of them first; classes already connected need
no comparison, and only pairs of different components are compared further.
So a group of n near copies costs about n comparisons, no link between
components is missed, and no bucket is expanded into all its pairs.

Frequencies are counted in packed blocks: a chunk of documents adds up its own
keys, sends each bucket of the key space one sorted array of them with their
counts, and gets one class per key back.  So a key that very many documents
share is sent once by each chunk.

Defined cases: a null text, and one without words, has no shingles and links
with nothing; under five words the whole sequence is one shingle; repeated
rows of an id are one document if their texts agree, else the id stands for
each of them; a null id is left out; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm.common import Scratch, chunk_count, from_text, shuffle_partitions, text_bytes
from docweave.llm.components import connected_components
from docweave.llm.shingles import U, mix, shingle_sets

#: Similarity as a fraction: 100 * intersection >= 75 * union.
CHUNK_BYTES = 4 << 20
KEYS_PER_BUCKET = 1 << 20
#: Bands below this exponent use every shingle as its own segment.
SINGLE = 7
SKETCH_BITS = 1024
#: Rounds that compare each bucket with one of its documents.
STAR_ROUNDS = 2


def band_of(n: int) -> int:
    return n.bit_length() - 1


def bands(n: int) -> list[tuple[int, int]]:
    """(band, segments to offer) of a set of n shingles."""
    if n < 3:
        return []  # only an equal set is similar enough
    j = band_of(n)
    out = [(j, (n + 4 * n // 3) // 7 + 1)]
    if -(-3 * n // 4) < 1 << j:  # partners in the next lower band have at most 2**j - 1
        out.append((j - 1, (n + (1 << j) - 1) // 7 + 1))
    return out


def segment_keys(hashes: np.ndarray, band: int) -> np.ndarray:
    """Keys of the non-empty segments of sorted hashes: XOR of each segment."""
    if band < SINGLE:
        keys = hashes
    else:
        part = hashes >> U(64 - band)
        starts = np.concatenate([[0], np.flatnonzero(part[1:] != part[:-1]) + 1])
        keys = np.bitwise_xor.reduceat(mix(hashes), starts)
    return mix(keys ^ U(band + 1))


def parity_sketch(hashes: np.ndarray) -> np.ndarray:
    """The parity bits as 64-bit words."""
    bits = np.bincount((hashes & U(SKETCH_BITS - 1)).astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(bits.astype(bool)).view(np.int64)


def may_link(a: str = "_a", b: str = "_b"):
    """Sizes and the sketches' Hamming distance leave a link possible."""
    n_a, n_b, x, y = (F.col(c + s) for c in ("n", "sketch") for s in (a, b))
    far = sum((F.bit_count(x[i].bitwiseXOR(y[i])) for i in range(SKETCH_BITS // 64)), F.lit(0))
    return (4 * F.least(n_a, n_b) >= 3 * F.greatest(n_a, n_b)) & (7 * far <= n_a + n_b)


def fingerprints(docs: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """doc_id, n_shingles and two hashes of the whole set."""
    def run(texts):
        sets = shingle_sets([(t or "").encode() for t in texts])
        with np.errstate(over="ignore"):
            f1 = [int(np.bitwise_xor.reduce(mix(s)).view(np.int64)) if len(s) else 0 for s in sets]
            f2 = [int(np.add.reduce(mix(s ^ U(0x5851F42D4C957F2D))).view(np.int64)) if len(s) else 0 for s in sets]
        return [pa.array([len(s) for s in sets], pa.int64()), pa.array(f1, pa.int64()), pa.array(f2, pa.int64())]

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("__body"))
    return from_text(rows, "__body", ("doc_id",), "n_shingles long, f1 long, f2 long", run)


def _chunk(n: int):
    return F.pmod(F.xxhash64("doc_id"), F.lit(n)).cast("int").alias("chunk")


def _chosen_sets(docs: pa.Table, chosen: pa.Table) -> tuple[list[int], list[np.ndarray]]:
    """Ids and sets of the chunk's class representatives, by id."""
    wanted = set(chosen["doc_id"].to_pylist())
    rows = {}
    for d, t in zip(docs["doc_id"].to_pylist(), docs["text"].to_pylist()):
        if d in wanted:
            rows[d] = min(rows.get(d, t), t)
    ids = sorted(rows)
    return ids, shingle_sets([rows[d].encode() for d in ids])


def _all_keys(sets: list[np.ndarray]):
    """Every segment key of a chunk, ascending, with its document and slot (own
    or lower band): the same order whenever it is computed."""
    keys, owner, slot = [], [], []
    for d, s in enumerate(sets):
        for i, (band, _) in enumerate(bands(len(s))):
            k = segment_keys(s, band)
            keys.append(k)
            owner.append(np.full(len(k), d, np.int32))
            slot.append(np.full(len(k), i, np.int8))
    if not keys:
        return np.zeros(0, U), np.zeros(0, np.int32), np.zeros(0, np.int8)
    keys, owner, slot = np.concatenate(keys), np.concatenate(owner), np.concatenate(slot)
    order = np.lexsort((slot, owner, keys))
    return keys[order], owner[order], slot[order]


def _bucket_cuts(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket of the key space starts in ascending keys."""
    width = -(-(1 << 64) // buckets)
    starts = np.array([min(b * width, (1 << 64) - 1) for b in range(buckets)], U)
    return np.append(np.searchsorted(keys, starts), len(keys))


def frequency_classes(docs: DataFrame, chosen: DataFrame, buckets: int) -> DataFrame:
    """(chunk, bucket, classes): one byte per key of the chunk in that bucket,
    0 for a key of a single document, else the bit length of their number."""
    def send(doc_rows: pa.Table, chosen_rows: pa.Table) -> pa.Table:
        schema = pa.schema([("chunk", pa.int32()), ("bucket", pa.int32()), ("keys", pa.binary()),
                            ("counts", pa.binary())])
        if not doc_rows.num_rows or not chosen_rows.num_rows:
            return schema.empty_table()
        _, sets = _chosen_sets(doc_rows, chosen_rows)
        keys, counts = np.unique(_all_keys(sets)[0], return_counts=True)
        counts = counts.astype(np.uint32)
        cuts = _bucket_cuts(keys, buckets)
        used = [b for b in range(buckets) if cuts[b] < cuts[b + 1]]
        return pa.table([pa.array([chosen_rows["chunk"][0].as_py()] * len(used), pa.int32()),
                         pa.array(used, pa.int32()),
                         pa.array([keys[cuts[b]:cuts[b + 1]].tobytes() for b in used], pa.binary()),
                         pa.array([counts[cuts[b]:cuts[b + 1]].tobytes() for b in used], pa.binary())], schema=schema)

    def count(rows: pa.Table) -> pa.Table:
        arrays = [np.frombuffer(k, U) for k in rows["keys"].to_pylist()]
        keys = np.concatenate(arrays)
        counts = np.frombuffer(b"".join(rows["counts"].to_pylist()), np.uint32).astype(np.int64)
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
        starts = np.concatenate([[0], np.flatnonzero(ordered[1:] != ordered[:-1]) + 1])
        times = np.add.reduceat(counts[order], starts)
        klass = np.where(times == 1, 0, np.floor(np.log2(times)) + 1).astype(np.uint8)
        flags = np.empty(len(keys), np.uint8)
        flags[order] = np.repeat(klass, np.diff(np.append(starts, len(ordered))))
        cuts = np.cumsum([0] + [len(a) for a in arrays])
        return pa.table({"chunk": rows["chunk"], "bucket": rows["bucket"],
                         "classes": pa.array([flags[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())})

    sent = docs.groupBy("chunk").cogroup(chosen.groupBy("chunk")).applyInArrow(
        send, "chunk int, bucket int, keys binary, counts binary")
    return sent.groupBy("bucket").applyInArrow(count, "chunk int, bucket int, classes binary")


def offers(docs: DataFrame, chosen: DataFrame, classes: DataFrame) -> DataFrame:
    """doc_id, n, keys, sketch and set of every document that offers a segment
    another document has: the rarest segments, as many as pigeonhole needs."""
    def choose(doc_rows: pa.Table, other: pa.Table) -> pa.Table:
        schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("keys", pa.list_(pa.int64())),
                            ("sketch", pa.list_(pa.int64())), ("hashes", pa.binary())])
        chosen_rows = other.filter(pa.compute.is_valid(other["doc_id"]))
        blocks = other.filter(pa.compute.is_valid(other["bucket"])).sort_by("bucket")
        if not doc_rows.num_rows or not blocks.num_rows:
            return schema.empty_table()
        ids, sets = _chosen_sets(doc_rows, chosen_rows)
        keys, owner, slot = _all_keys(sets)
        distinct, back = np.unique(keys, return_inverse=True)
        klass = np.frombuffer(b"".join(blocks["classes"].to_pylist()), np.uint8)
        if len(klass) != len(distinct):
            raise ValueError("a chunk's keys and their classes do not match")
        klass = klass[back]
        order = np.lexsort((keys, klass, slot, owner))  # by document and band, rarest first
        keys, owner, slot, klass = keys[order], owner[order], slot[order], klass[order]
        group = owner.astype(np.int64) * 2 + slot
        first = np.concatenate([[0], np.flatnonzero(group[1:] != group[:-1]) + 1])
        rank = np.arange(len(keys)) - np.repeat(first, np.diff(np.append(first, len(keys))))
        need = np.zeros(2 * len(sets), np.int64)
        for d, s in enumerate(sets):
            for i, (_, k) in enumerate(bands(len(s))):
                need[2 * d + i] = k
        picked = (rank < need[group]) & (klass > 0)
        keys, owner = keys[picked].view(np.int64), owner[picked]
        cuts = np.searchsorted(owner, np.arange(len(sets) + 1))
        kept = [d for d in range(len(sets)) if cuts[d] < cuts[d + 1]]
        return pa.table([
            pa.array([ids[d] for d in kept], pa.int64()), pa.array([len(sets[d]) for d in kept], pa.int64()),
            pa.array([keys[cuts[d]:cuts[d + 1]] for d in kept], pa.list_(pa.int64())),
            pa.array([parity_sketch(sets[d]) for d in kept], pa.list_(pa.int64())),
            pa.array([sets[d].tobytes() for d in kept], pa.binary())], schema=schema)

    other = chosen.select("chunk", "doc_id", F.lit(None).cast("int").alias("bucket"),
                          F.lit(None).cast("binary").alias("classes")).unionByName(
        classes.select("chunk", F.lit(None).cast("long").alias("doc_id"), "bucket", "classes"))
    return docs.groupBy("chunk").cogroup(other.groupBy("chunk")).applyInArrow(
        choose, "doc_id long, n long, keys array<long>, sketch array<long>, hashes binary")


def similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""
    narrow = sets.select("doc_id", "n", "sketch")
    side = lambda s, x: s.select(*[F.col(c).alias(x if c == "doc_id" else f"{c}_{x}") for c in s.columns])
    close = pairs.join(side(narrow, "a"), "a").join(side(narrow, "b"), "b").filter(may_link()).select("a", "b")

    def by_set(batches):
        for batch in batches:
            good = []
            for x, y in zip(batch.column("hashes_a").to_pylist(), batch.column("hashes_b").to_pylist()):
                x, y = np.frombuffer(x, U), np.frombuffer(y, U)
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= 75 * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    wide = sets.select("doc_id", "hashes")
    return close.join(side(wide, "b"), "b").join(side(wide, "a"), "a") \
        .select("a", "b", "hashes_a", "hashes_b").mapInArrow(by_set, "a long, b long")


def _untested(pairs: DataFrame, tested: DataFrame | None) -> DataFrame:
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti")


def link_classes(sets: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) of every representative that links to another one."""
    members = scratch.save(sets.select(F.explode("keys").alias("key"), F.col("doc_id").alias("doc")), "members")
    labels = tested = links = None
    for k in range(STAR_ROUNDS + 1):
        rows = members
        if labels is None:
            rows = rows.withColumn("root", F.col("doc"))
        else:
            rows = rows.join(labels.withColumnRenamed("node", "doc"), "doc", "left") \
                .withColumn("root", F.coalesce("root", "doc"))
        rows = scratch.save(rows, f"rooted{k}")
        # buckets that still hold several components
        open_keys = rows.groupBy("key").agg(
            F.min("root").alias("low"), F.max("root").alias("high"),
            F.min_by(F.struct("doc", "root"), F.xxhash64("doc", F.lit(k))).alias("anchor")).filter("low <> high")
        if k < STAR_ROUNDS:
            pairs = rows.join(open_keys.select("key", "anchor"), "key").filter("root <> anchor.root") \
                .select(F.col("doc").alias("a"), F.col("anchor.doc").alias("b"))
        else:
            # what is left are pairs of different components; size and sketch
            # decide inside the join which of them are ever emitted
            narrow = sets.select(F.col("doc_id").alias("doc"), "n", "sketch")
            left = rows.join(open_keys.select("key"), "key").join(narrow, "doc")
            side = lambda x: left.select("key", *[F.col(c).alias(c + x) for c in ("doc", "root", "n", "sketch")])
            pairs = side("_a").join(side("_b"), "key").filter("doc_a < doc_b and root_a <> root_b") \
                .filter(may_link()).select(F.col("doc_a").alias("a"), F.col("doc_b").alias("b"))
        new = scratch.save(_untested(pairs, tested), f"pairs{k}")
        scratch.drop(f"rooted{k}")
        if new.isEmpty():
            if k >= STAR_ROUNDS:
                break
            continue
        found = scratch.save(similar(new, sets), f"found{k}")
        tested = new if tested is None else tested.unionByName(new)
        links = found if links is None else links.unionByName(found)
        labels = connected_components(links, scratch, f"components{k}")
    return labels


def near_duplicate_classes(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, n_shingles, class_id (smallest id with the same set) and
    component_id (smallest id reachable by links) of every document."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "jaccard")
    rows = docs.filter(F.col(id_col).isNotNull())
    prints = scratch.save(fingerprints(rows, text_col, id_col), "fingerprints")
    classes = (prints.filter("n_shingles > 0").groupBy("n_shingles", "f1", "f2").agg(F.min("doc_id").alias("class_id")))
    classes = scratch.save(classes, "classes")

    n = max(chunk_count(text_bytes(rows, text_col), CHUNK_BYTES), shuffle_partitions(spark))
    total = classes.agg(F.coalesce(F.sum("n_shingles"), F.lit(0))).first()[0]
    buckets = min(max(chunk_count(total, KEYS_PER_BUCKET), shuffle_partitions(spark)), 1 << 20)
    chosen = classes.filter("n_shingles > 2").select(F.col("class_id").alias("doc_id")).distinct()
    chosen = scratch.save(chosen.select("doc_id", _chunk(n)), "chosen")
    texts = rows.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    texts = texts.select("doc_id", "text", _chunk(n))
    counted = scratch.save(frequency_classes(texts, chosen, buckets), "classes-of-keys")
    sets = scratch.save(offers(texts, chosen, counted), "sets")
    scratch.drop("classes-of-keys", "chosen")
    labels = link_classes(sets, scratch)

    out = prints.join(classes, ["n_shingles", "f1", "f2"], "left") \
        .select("doc_id", "n_shingles", F.coalesce("class_id", "doc_id").alias("class_id"))
    if labels is None:
        return out.withColumn("component_id", F.col("class_id"))
    roots = labels.select(F.col("node").alias("class_id"), F.col("root").alias("component_id"))
    return out.join(roots, "class_id", "left").withColumn("component_id", F.coalesce("component_id", "class_id"))


def drop_near_duplicates(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The documents whose id is the smallest of their component."""
    classes = near_duplicate_classes(docs, text_col, id_col)
    gone = classes.filter("component_id <> doc_id").select(F.col("doc_id").alias("__gone"))
    return docs.join(gone, F.col(id_col) == F.col("__gone"), "left_anti")
