"""Reshaping: pivots, regrouping, explode / zip / flat-map, entity table (A1-A3,
F3-F5, F11, C3, J2)."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.functions.annotations import entity_id


def pivot_default(df: DataFrame, key: str, pivot_col: str, value: str, default,
                  values: Sequence | None = None, order: str | None = None) -> DataFrame:
    """Group by ``key``, one column per ``pivot_col`` value holding a ``value``.

    A cell takes the value of the row with the smallest ``order`` (or the
    smallest value when no order is given): a deterministic ``first``.  The
    default is applied *after* the pivot, so missing cells get it whatever the
    value type.  Pass ``values`` to fix the output schema and skip the extra
    job that finds the distinct pivot values.  Both aggregation steps combine
    map-side, so a hot key is pre-aggregated before the shuffle.
    """
    pick = F.min_by(F.col(value), F.col(order)) if order else F.min(F.col(value))
    g = df.groupBy(key)
    wide = (g.pivot(pivot_col, list(values)) if values is not None else g.pivot(pivot_col)).agg(pick)
    cells = [c for c in wide.columns if c != key]
    return wide.select(key, *[F.coalesce(F.col(f"`{c}`"), F.lit(default)).alias(c) for c in cells])


def pivot_entities(chunks: DataFrame, values: Sequence[str] | None = None, key: str = "docId",
                   type_col: str = "entity_type", entity_col: str = "entity", sep: str = ", ") -> DataFrame:
    """One column per entity type: the sorted entities (duplicates kept) joined
    by ``sep``; a type absent from a document gives ''."""
    g = chunks.groupBy(key)
    g = g.pivot(type_col, list(values)) if values is not None else g.pivot(type_col)
    return g.agg(F.array_join(F.sort_array(F.collect_list(entity_col)), sep))


def attach_entities(content: DataFrame, pivoted: DataFrame, id_col: str = "id",
                    key: str = "docId") -> DataFrame:
    """Left join the pivoted entity columns back to the main rows; documents
    without entities keep NULL cells."""
    return content.join(pivoted.withColumnRenamed(key, "__k"),
                        F.col(id_col) == F.col("__k"), "left").drop("__k")


def regroup(df: DataFrame, id_col: str, col: str, sep: str = " ", order: str = "pos",
            out_col: str | None = None) -> DataFrame:
    """One string per id: the ``col`` values in ``order`` joined by ``sep``."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(col).alias("v"))))
    return df.groupBy(id_col).agg(
        F.concat_ws(sep, F.transform(parts, lambda s: s["v"])).alias(out_col or col))


def explode_annotations(df: DataFrame, col: str, id_col: str, keep_empty: bool = False) -> DataFrame:
    """One row per annotation with its struct fields as columns.  Empty or NULL
    arrays drop the row unless ``keep_empty``."""
    gen = F.explode_outer(col) if keep_empty else F.explode(col)
    return df.select(F.col(id_col), gen.alias("__e")).select(id_col, "__e.*")


def zip_rows(df: DataFrame, keep: Sequence[str], cols: Sequence[str], pos_col: str | None = "i") -> DataFrame:
    """Explode parallel arrays together: row i holds element i of each array;
    the shorter arrays are padded with NULL; a NULL array drops the row."""
    z = F.arrays_zip(*[F.col(c) for c in cols])
    if pos_col:
        out = df.select(*keep, F.posexplode(z).alias(pos_col, "__z"))
    else:
        out = df.select(*keep, F.explode(z).alias("__z"))
    return out.select(*keep, *([pos_col] if pos_col else []),
                      *[F.col("__z").getField(c).alias(c) for c in cols])


def flat_map(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema) -> DataFrame:
    """Row -> many rows with a Python function over Arrow batches.

    ``fn`` receives a pandas frame (one Arrow batch of a partition) and
    returns the output rows for it.  Prefer ``zip_rows`` / ``explode`` when a
    built-in expresses the mapping.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield fn(pdf)
    return df.mapInPandas(run, schema)


def pairwise(pdf: pd.DataFrame, key: str, a: str, b: str) -> pd.DataFrame:
    """(key, i, a[i], b[i]) for i below the length of ``a``; raises when ``b``
    is shorter, as the row-iterating original did."""
    rows = pdf[pdf[a].notna()]
    n = rows[a].map(len).to_numpy(int)
    short = rows[b].map(lambda y: 0 if y is None else len(y)).to_numpy(int) < n
    if short.any():
        raise IndexError(f"{b} shorter than {a} for {key}={rows[key][short].iloc[0]}")
    rows, n = rows[n > 0], n[n > 0]
    if not len(rows):
        return pd.DataFrame({key: [], "i": [], a: [], b: []})
    return pd.DataFrame({
        key: np.repeat(rows[key].to_numpy(), n), "i": np.concatenate([np.arange(k) for k in n]),
        a: np.concatenate(rows[a].to_list()), b: np.concatenate([y[:k] for y, k in zip(rows[b], n)])})


def entity_table(chunks: DataFrame, id_col: str = "id") -> DataFrame:
    """Chunks (id, begin, end, result, entity, sentence) -> the flat entity
    table (docId, entity, entity_type, sentence_num, start_pos, id)."""
    return chunks.select(
        F.col(id_col).cast("bigint").alias("docId"),
        F.col("result").cast("string").alias("entity"),
        F.col("entity").cast("string").alias("entity_type"),
        F.col("sentence").cast("int").alias("sentence_num"),
        F.col("begin").cast("int").alias("start_pos"),
        entity_id(F.col(id_col), F.col("entity"), F.col("begin")).alias("id"),
    )


def entity_table_from_annotations(df: DataFrame, col: str, id_col: str) -> DataFrame:
    """The entity table from a nested chunk-annotation column: explode the
    chunks (documents without chunks drop), read ``metadata['entity']`` and
    ``metadata['sentence']`` (``try_cast``: a malformed value becomes NULL
    under ANSI instead of failing), take ``start_pos`` from ``begin`` (chunks
    carry no ``start`` key), and build ``docId-type-begin`` ids."""
    e = df.select(F.col(id_col), F.explode(col).alias("__c"))
    meta = F.col("__c.metadata")
    return e.select(
        F.col(id_col).cast("bigint").alias("docId"),
        F.col("__c.result").cast("string").alias("entity"),
        meta.getItem("entity").alias("entity_type"),
        F.expr("try_cast(__c.metadata['sentence'] as int)").alias("sentence_num"),
        F.col("__c.begin").cast("int").alias("start_pos"),
        entity_id(F.col(id_col), meta.getItem("entity"), F.col("__c.begin")).alias("id"))
