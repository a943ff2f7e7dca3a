"""Approximate nearest neighbours: an NN-descent graph built by Spark joins,
searched greedily.

Equal vectors are one node (its smallest id), so very many copies of a vector
are one vertex.  The graph starts from blocks of nodes that are adjacent along
random directions.  Each round joins every node's neighbours and reverse
neighbours with their vectors, compares them with each other around that node
(skipping pairs compared before), and keeps the nearest ``K`` of each.  It ends
when a round changes few edges.

A query walks the graph, both ways along its edges, from its own vertex: all
unvisited neighbours of the best ``BEAM`` vertices are measured, until the best
have all been expanded.

An exact check follows, as a graph may hold regions a walk never enters (groups
of near-equal vectors fill their own lists): the query vertices (a fixed share
of the rows) meet all nodes in cells of bounded size, and whatever lies within
the distance a query's walk has reached is added.  A cell measures its pairs by
matrix products and returns at most ``top + 1`` of a query.

Defined cases: vectors that are null, zero, or hold null or non-finite numbers
take no part, nor do those of another length than the commonest; repeated ids
with equal vectors are one row, with unequal ones the first by vector; other
columns are ignored; an empty table gives no rows; with fewer candidates than
``top``, all of them are returned.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docweave.llm.common import Scratch, chunk_count, shuffle_partitions

K = 20
#: Reverse neighbours of a node that take part in a round, nearest first.
REVERSE = 20
DIRECTIONS, BLOCK = 4, 128
ROUNDS, SETTLED = 6, 0.01
BEAM, STEPS = 48, 12
SEED = 31
#: Numbers that the nodes of one cell of the exact check hold; rows measured at once.
CELL, STRIP = 1 << 20, 256
#: A task gets at least the edges of so many nodes, or what is seen of so many queries.
NODES, QUERIES = 1024, 16


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v) of the vectors that take part, one row per id."""
    v = F.col("v")
    fit = (v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
           & F.exists(v, lambda x: x != 0))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<float>").alias("v")) \
        .filter(F.col("id").isNotNull()).filter(F.coalesce(fit, F.lit(False)))
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    most = sizes.orderBy(F.desc("n"), F.desc("d")).limit(1).first()
    return rows.filter(F.size("v") == (most["d"] if most else 0)).groupBy("id").agg(F.min("v").alias("v"))


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 1)


def _nearest(ids: np.ndarray, x: np.ndarray, k: int):
    """Edges to the k nearest of a block's rows."""
    x = x.astype(np.float64)
    sq = (x * x).sum(axis=1)
    d = np.maximum(sq[:, None] + sq[None, :] - 2 * x @ x.T, 0)
    np.fill_diagonal(d, np.inf)
    k = min(k, len(ids) - 1)
    near = np.argpartition(d, k - 1, axis=1)[:, :k] if k > 0 else np.zeros((len(ids), 0), int)
    rows = np.repeat(np.arange(len(ids)), near.shape[1])
    return ids[rows], ids[near.ravel()], d[rows, near.ravel()]


EDGE = "a long, b long, d double"


def _edges(a, b, d) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(d, pa.float64())],
                                      ["a", "b", "d"])


def _closest(edges: DataFrame, k: int, parts: int) -> DataFrame:
    """The k nearest distinct b of each a; ``old`` edges stay old.  One shuffle."""
    best = edges.repartition(parts, "a").groupBy("a", "b").agg(F.min("d").alias("d"), F.min("new").alias("new"))
    rank = F.row_number().over(Window.partitionBy("a").orderBy("d", "b"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k)


def first_graph(nodes: DataFrame, dim: int, lines: int, parts: int) -> DataFrame:
    """Edges inside blocks of nodes that are adjacent along random directions."""
    out = None
    for i in range(DIRECTIONS):
        direction = np.random.default_rng(SEED + i).normal(size=dim)

        def project(batches, direction=direction):
            for batch in batches:
                p = _matrix(batch.column("v")).astype(np.float64) @ direction if batch.num_rows else np.zeros(0)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p)], ["id", "v", "p"])

        def blocks(batches):
            ids, vs = np.zeros(0, np.int64), np.zeros((0, dim), np.float32)
            for batch in batches:
                if batch.num_rows:
                    ids = np.concatenate([ids, batch.column("id").to_numpy()])
                    vs = np.concatenate([vs, _matrix(batch.column("v"))])
                while len(ids) >= 2 * BLOCK:
                    yield _edges(*_nearest(ids[:BLOCK], vs[:BLOCK], K))
                    ids, vs = ids[BLOCK // 2:], vs[BLOCK // 2:]  # blocks overlap by half
            if len(ids) > 1:
                yield _edges(*_nearest(ids, vs, K))

        lined = nodes.mapInArrow(project, "id long, v array<float>, p double") \
            .repartitionByRange(lines, "p").sortWithinPartitions("p")
        edges = lined.select("id", "v").mapInArrow(blocks, EDGE)
        out = edges if out is None else out.unionByName(edges)
    return _closest(out.withColumn("new", F.lit(True)), K, parts)


def _compare_around(batches):
    """Around each node: distances between its members, for those that would
    become a neighbour of the other, one of them new to the node."""
    for batch in batches:
        members = batch.column("members")
        if not len(members):
            continue
        flat = members.flatten()
        ids, worst, new, x = (flat.field(i) for i in range(4))
        ids, worst, new = ids.to_numpy(), worst.to_numpy(), new.to_numpy(zero_copy_only=False).astype(bool)
        x = _matrix(x).astype(np.float64)
        bounds = members.offsets.to_numpy() - members.offsets[0].as_py()
        found = []
        for i, j in zip(bounds, bounds[1:]):
            y, w, f = x[i:j], worst[i:j], new[i:j]
            sq = (y * y).sum(axis=1)
            d = np.maximum(sq[:, None] + sq[None, :] - 2 * y @ y.T, 0)
            r, c = np.nonzero((d < w[:, None]) & (f[:, None] | f[None, :]) & (ids[i:j, None] != ids[None, i:j]))
            if len(r):
                found.append((ids[i + r], ids[i + c], d[r, c]))
        if found:
            yield _edges(*(np.concatenate(z) for z in zip(*found)))


def build_graph(nodes: DataFrame, scratch: Scratch, dim: int) -> DataFrame:
    """a, b, d (squared distance): the K nearest found of every node."""
    parts = shuffle_partitions(nodes.sparkSession)
    n = nodes.count()
    tasks = chunk_count(n, NODES)
    # blocks end at range partitions, so few nodes are one range
    lines = max(1, min(parts, n // (8 * BLOCK)))
    graph = scratch.save(first_graph(nodes, dim, lines, parts).coalesce(tasks), "graph0")
    for r in range(ROUNDS):
        # members around a node: its neighbours and the nearest that list it; dealt by
        # node once, so neither the ranks nor the distinct members shuffle again
        back = graph.select(F.col("b").alias("a"), F.col("a").alias("b"), "d", "new", F.lit(True).alias("back"))
        both = graph.select("a", "b", "d", "new", F.lit(False).alias("back")).unionByName(back).repartition(parts, "a")
        rank = F.row_number().over(Window.partitionBy("a", "back").orderBy("d", "b"))
        around = both.withColumn("rank", rank).filter(~F.col("back") | (F.col("rank") <= REVERSE)) \
            .groupBy("a", "b").agg(F.max("new").alias("new"))
        # a full list ends with its K-th edge
        worst = graph.filter(F.col("rank") == K).select(F.col("a").alias("full"), F.col("d").alias("w"))
        info = nodes.join(worst, F.col("id") == F.col("full"), "left").select(
            F.col("id").alias("b"), "v", F.coalesce("w", F.lit(float("inf"))).alias("worst"))
        members = around.join(info, "b").groupBy("a").agg(
            F.collect_list(F.struct("b", "worst", "new", "v")).alias("members"))
        found = members.select("members").coalesce(tasks).mapInArrow(_compare_around, EDGE).withColumn("new", F.lit(True))
        old = graph.select("a", "b", "d", F.lit(False).alias("new"))
        graph = scratch.save(_closest(old.unionByName(found), K, parts).coalesce(tasks), f"graph{r + 1}")
        scratch.drop(f"graph{r}")
        if graph.filter("new").count() <= SETTLED * K * n:
            break
    return graph.select("a", "b", "d")


def _distance(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") - y.cast("double")),
                              F.lit(0.0), lambda s, x: s + x * x))


def search(graph: DataFrame, nodes: DataFrame, queries: DataFrame, scratch: Scratch) -> DataFrame:
    """(q, node, score) of every vertex measured for each query vertex."""
    edges = graph.select("a", "b").unionByName(graph.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    edges = scratch.save(edges, "edges")
    vectors = nodes.select(F.col("id").alias("node"), "v")
    asked = queries.select(F.col("id").alias("q"), F.col("v").alias("qv"))
    # every vertex seen holds its rank, so a step deals the rows by query once: what is new
    # among them has no score yet
    parts, tasks = shuffle_partitions(nodes.sparkSession), chunk_count(queries.count(), QUERIES)
    by_score = Window.partitionBy("q").orderBy("score", "node")
    seen = queries.select(F.col("id").alias("q"), F.col("id").alias("node"), F.lit(0.0).alias("score"),
                          F.lit(False).alias("done"), F.lit(1).alias("rank"))
    for step in range(STEPS):
        front = seen.filter((F.col("rank") <= BEAM) & ~F.col("done"))
        if step and front.isEmpty():
            break
        reached = front.select("q", F.col("node").alias("a")).join(edges, "a").select(
            "q", F.col("b").alias("node"), F.lit(None).cast("double").alias("score"), F.lit(False).alias("done"))
        kept = seen.select("q", "node", "score", (F.col("done") | (F.col("rank") <= BEAM)).alias("done"))
        met = kept.unionByName(reached).repartition(parts, "q").groupBy("q", "node").agg(
            F.max("score").alias("score"), F.max("done").alias("done"))
        measured = met.join(vectors, "node").join(asked, "q").select("q", "node", F.coalesce(
            "score", _distance(F.col("qv"), F.col("v"))).alias("score"), "done")
        ranked = measured.withColumn("rank", F.row_number().over(by_score))
        seen = scratch.save(ranked.coalesce(tasks), f"seen{step}")
        if step:
            scratch.drop(f"seen{step - 1}")
    return seen.select("q", "node", "score")


def missed(found: DataFrame, nodes: DataFrame, queries: DataFrame, n: int, dim: int, top: int) -> DataFrame:
    """(q, node, score) of the nodes within the ``top + 1`` nearest vertices that each
    query's walk has ``found``; of a cell the nearest ``top + 1`` (ties: smaller id)."""
    rows = max(STRIP, CELL // max(dim, 1))
    node_cells = max(shuffle_partitions(nodes.sparkSession), -(-n // rows))
    query_cells = max(1, -(-queries.count() // rows))
    each = lambda cells: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(cells - 1).cast("long")))
    by_score = Window.partitionBy("q").orderBy("score", "node")
    reach = found.withColumn("r", F.row_number().over(by_score)).filter(F.col("r") == top + 1) \
        .select(F.col("q").alias("id"), F.col("score").alias("reach"))
    asked = queries.join(reach, "id", "left").select(
        F.pmod(F.xxhash64("id"), F.lit(query_cells)).alias("qc"), F.col("id").alias("q"), F.col("v").alias("qv"),
        F.coalesce("reach", F.lit(float("inf"))).alias("reach"),
        each(node_cells).alias("nc"))
    met = nodes.select(
        F.pmod(F.xxhash64("id"), F.lit(node_cells)).alias("nc"), "id", "v",
        each(query_cells).alias("qc"))

    def measure(ask: pd.DataFrame, cell: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"q": np.zeros(0, np.int64), "node": np.zeros(0, np.int64), "score": np.zeros(0)})]
        if len(ask) and len(cell):
            ids, x = cell["id"].to_numpy(), np.stack(cell["v"].to_numpy()).astype(np.float64)
            qs, y = ask["q"].to_numpy(), np.stack(ask["qv"].to_numpy()).astype(np.float64)
            reach = ask["reach"].to_numpy() ** 2
            mid = x.mean(axis=0)
            u, z = x - mid, y - mid
            sq, sz = (u * u).sum(axis=1), (z * z).sum(axis=1)
            for i in range(0, len(qs), STRIP):
                part = slice(i, i + STRIP)
                size = sz[part, None] + sq[None, :]
                # the slack covers the rounding of the products
                r, c = np.nonzero(size - 2 * z[part] @ u.T <= reach[part, None] * (1 + 1e-9) + 1e-9 * size)
                d = np.zeros(len(r))
                for j in range(x.shape[1]):  # as the walk measures: one component after the other
                    step = y[i + r, j] - x[c, j]
                    d += step * step
                d = np.sqrt(d)
                order = np.lexsort((ids[c], d, r))
                r, c, d = r[order], c[order], d[order]
                rank = np.arange(len(r)) - np.searchsorted(r, r)
                few = rank <= top
                out.append(pd.DataFrame({"q": qs[i + r[few]], "node": ids[c[few]], "score": d[few]}))
        return pd.concat(out, ignore_index=True)

    return asked.groupBy("nc", "qc").cogroup(met.groupBy("nc", "qc")).applyInPandas(
        measure, "q long, node long, score double")


def nearest_neighbours(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding",
                       top: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score.  ``is_query`` is over the column ``id``."""
    scratch = Scratch(vectors.sparkSession, "neighbours")
    rows = usable(vectors, id_col, vector_col)
    rows = scratch.save(rows, "rows")
    nodes = scratch.save(rows.groupBy("v").agg(F.min("id").alias("id")).select("id", "v"), "nodes")
    members = scratch.save(rows.join(nodes.withColumnRenamed("id", "node"), "v").select("node", "id"), "members")
    first = nodes.first()
    if first is None:
        return rows.select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"),
                           F.lit(0.0).alias("score"))
    graph = build_graph(nodes, scratch, len(first["v"]))
    queries = members.filter(is_query).select(F.col("id").alias("query_id"), F.col("node").alias("q"))
    starts = queries.select(F.col("q").alias("id")).distinct().join(nodes, "id")
    found = search(graph, nodes, starts, scratch)
    more = missed(found, nodes, starts, nodes.count(), len(first["v"]), top)
    found = found.unionByName(scratch.save(more, "missed")).groupBy("q", "node").agg(F.min("score").alias("score"))
    by_score = Window.partitionBy("q").orderBy("score", "node")
    found = found.withColumn("r", F.row_number().over(by_score)).filter(F.col("r") <= top + 1).drop("r")
    # of a vertex at most top + 1 ids can matter
    few = members.withColumn("r", F.row_number().over(Window.partitionBy("node").orderBy("id"))) \
        .filter(F.col("r") <= top + 1).drop("r")
    answers = found.join(few, "node").select("q", "id", "score")
    by_id = Window.partitionBy("q").orderBy("score", "id")
    answers = answers.withColumn("r", F.row_number().over(by_id)).filter(F.col("r") <= top + 1).drop("r")
    out = queries.join(answers, "q").filter("id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "id"))
    return out.withColumn("rank", rank).filter(F.col("rank") <= top).select(
        "query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")
