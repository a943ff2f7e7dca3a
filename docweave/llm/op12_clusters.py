"""Centroid clustering with equal-average equal-variance nearest-centroid search.

Vectors become integer vectors, so that every distance and every mean is exact.
Centroids are sorted by the sum of their components; a vector scans outward from
its own sum.  With ``s`` the component sums and ``V`` the norms of the deviations
from the component mean,

    d2(x, c) >= (s_x - s_c)**2 / dims + (V_x - V_c)**2,

so the first term ends the scan on a side (it only grows outward) and both terms
reject a single centroid.  Bounds are floating point and carry a margin on the
safe side; what they leave is compared by exact integer distances, ties to the
smaller number.  A round is one pass: each task adds up its vectors by cluster
and sends one row per cluster, so a cluster with a third of all vectors costs
no more than another.  The driver sees ``start`` rows a round.

Defined cases: vectors that are null, of another length, or hold a null or
non-finite component take no part; integers beyond ``BOUND`` count as it, so
that a distance fits a long; fewer vectors than centroids make every vector a
centroid; a null id is last among the starting centroids; repeated rows count
each; equal ids are ordered by their vectors; an empty table gives no rows; an
inertia beyond a long is null.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave.llm.common import Scratch, freed_shuffles

DIMS, SCALE, START, ROUNDS = 64, 256, 40, 5
BOUND = 1 << 27


def integer_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """``vec_id`` and ``v`` (array<int>) of the vectors that take part."""
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("__x"))
    x = F.col("__x")
    usable = x.isNotNull() & (F.size(x) == dims) & ~F.exists(
        x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == F.lit(float("inf"))))
    limit = F.lit(float(BOUND) / scale)
    return rows.filter(usable).select("vec_id", F.transform(
        x, lambda e: F.floor(F.lit(float(scale)) * F.least(F.greatest(e, -limit), limit)).cast("int")).alias("v"))


def nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid and the exact squared distance of each row of ``x`` (int64)."""
    n, dims = x.shape
    k = len(centres)
    order = np.argsort(centres.sum(axis=1), kind="stable")
    sorted_c = centres[order]

    def moments(a):
        s = a.sum(axis=1).astype(float)
        dev = a - s[:, None] / dims
        return s, np.sqrt((dev * dev).sum(axis=1)), np.sqrt((a.astype(float) ** 2).sum(axis=1))

    sx, vx, nx = moments(x)
    sc, vc, nc = moments(sorted_c)
    right = np.searchsorted(sc, sx)
    left = right - 1
    best = np.full(n, np.iinfo(np.int64).max)
    label = np.full(n, k)
    open_rows = np.arange(n)
    while len(open_rows):
        lo, hi = left[open_rows], right[open_rows]
        down = np.where(lo >= 0, sx[open_rows] - sc[np.maximum(lo, 0)], np.inf)
        up = np.where(hi < k, sc[np.minimum(hi, k - 1)] - sx[open_rows], np.inf)
        gap = np.minimum(down, up)
        limit = best[open_rows] * (1 + 1e-9) + 1
        # mean inequality: what lies further out on either side is further away
        near = np.isfinite(gap) & (gap * gap / dims <= limit)
        open_rows, gap, limit, below = open_rows[near], gap[near], limit[near], (down <= up)[near]
        at = np.where(below, lo[near], hi[near])
        left[open_rows] -= below
        right[open_rows] += ~below
        # deviation inequality for this centroid
        spread = np.abs(vx[open_rows] - vc[at]) - 1e-9 * (nx[open_rows] + nc[at]) - 1e-6
        test = gap * gap / dims + np.maximum(spread, 0) ** 2 <= limit
        rows, at = open_rows[test], at[test]
        diff = x[rows] - sorted_c[at]
        dist, number = (diff * diff).sum(axis=1), order[at]
        better = (dist < best[rows]) | ((dist == best[rows]) & (number < label[rows]))
        best[rows[better]] = dist[better]
        label[rows[better]] = number[better]
    return label, best


def starting_centroids(vecs: DataFrame, start: int = START, key: Column | None = None) -> np.ndarray:
    """The ``start`` vectors with the smallest key, in its order (a bounded top-k)."""
    key = key if key is not None else F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")), 256)
    rows = vecs.select(key.alias("__h"), "v").orderBy(F.col("__h").asc_nulls_last(), "v").limit(start).collect()
    return np.array([r["v"] for r in rows], np.int64).reshape(len(rows), len(rows[0]["v"]) if rows else 0)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def next_centroids(vecs: DataFrame, centres: np.ndarray) -> np.ndarray:
    """Floors of the exact means of each centroid's vectors; an empty one stays."""
    k, dims = centres.shape

    def partial(batches):
        counts, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            if len(batch):
                x = _matrix(batch.column(0), dims)
                label, _ = nearest(x, centres)
                counts += np.bincount(label, minlength=k)
                np.add.at(sums, label, x)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(counts[used], pa.int64()),
             pa.array(list(sums[used]), pa.list_(pa.int64()))], ["cluster", "n", "s"])

    total = [F.sum(F.col("s")[i].cast("decimal(20,0)")).alias(f"s{i}") for i in range(dims)]
    with freed_shuffles(vecs.sparkSession):
        rows = (vecs.select("v").mapInArrow(partial, "cluster int, n long, s array<long>")
                .groupBy("cluster").agg(F.sum("n").alias("n"), *total).collect())
    out = centres.copy()
    for r in rows:
        out[r["cluster"]] = [int(r[f"s{i}"]) // r["n"] for i in range(dims)]
    return out


def assign(vecs: DataFrame, centres: np.ndarray) -> DataFrame:
    """``vec_id``, ``cluster`` and ``distance`` of every vector."""
    dims = centres.shape[1] if centres.size else 0
    schema = T.StructType([vecs.schema["vec_id"]]).add("cluster", T.IntegerType()).add("distance", T.LongType())

    def run(batches):
        for batch in batches:
            if len(batch):
                label, best = nearest(_matrix(batch.column(1), dims), centres)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(label, pa.int32()), pa.array(best, pa.int64())], schema.names)

    return vecs.select("vec_id", "v").mapInArrow(run, schema)


def centroid_sha256(centre: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(c)) for c in centre).encode()).hexdigest()


def cluster_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = DIMS,
                    scale: int = SCALE, start: int = START, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """Rows (vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) and the final centroids."""
    scratch = Scratch(vectors.sparkSession, "clusters")
    vecs = scratch.save(integer_vectors(vectors, id_col, vector_col, dims, scale), "vectors")
    centres = starting_centroids(vecs, start)
    for _ in range(rounds if len(centres) else 0):
        centres = next_centroids(vecs, centres)
    placed = scratch.save(assign(vecs, centres), "placed")
    scratch.drop("vectors")
    # one row per centroid, at most ``start``
    sums = placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("s")).collect()
    total = sum(int(r["s"]) for r in sums)
    longs = lambda n: n if n < 1 << 63 else None
    about = vectors.sparkSession.createDataFrame(
        [(r["cluster"], longs(int(r["s"])), longs(total), centroid_sha256(centres[r["cluster"]])) for r in sums],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"), centres
