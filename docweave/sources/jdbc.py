"""Relational sources and sinks over JDBC.

The reference pushes join / filter / order / limit into the database as a
derived table.  Credentials are only ever taken as arguments (``props``) and
are never logged.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Partitioning:
    """Parallel read: ``numPartitions`` range strides of ``column`` between
    ``lower`` and ``upper``.  The bounds only set the strides; rows outside
    them are still read (by the first / last partition, NULLs by the first)."""
    column: str
    lower: int
    upper: int
    num_partitions: int


def jdbc_options(url: str, sql: str | None = None, table: str | None = None, props: dict | None = None,
                 partition: Partitioning | None = None, as_query: bool = False,
                 fetch_size: int | None = None) -> dict:
    """Options for ``spark.read.format("jdbc")``.

    ``sql`` is sent as a derived table ``(<sql>) as q`` so the database runs
    it; ``as_query`` uses the ``query`` option instead (single partition only:
    Spark rejects ``query`` together with a partition column).
    """
    if (sql is None) == (table is None):
        raise ValueError("give exactly one of sql or table")
    opts = {"url": url, **(props or {})}
    if sql is not None and as_query:
        if partition is not None:
            raise ValueError("the query option cannot be combined with a partitioned read")
        opts["query"] = sql
    else:
        opts["dbtable"] = f"({sql}) as q" if sql is not None else table
    if partition is not None:
        opts.update(partitionColumn=partition.column, lowerBound=str(partition.lower),
                    upperBound=str(partition.upper), numPartitions=str(partition.num_partitions))
    if fetch_size:
        opts["fetchsize"] = str(fetch_size)
    return opts


def read_jdbc(spark: SparkSession, url: str, sql: str | None = None, props: dict | None = None,
              partition: Partitioning | None = None, table: str | None = None,
              as_query: bool = False, fetch_size: int | None = 10000) -> DataFrame:
    return spark.read.format("jdbc").options(
        **jdbc_options(url, sql, table, props, partition, as_query, fetch_size)).load()


def bounds_partitioning(spark: SparkSession, url: str, table: str, column: str, num_partitions: int,
                        props: dict | None = None) -> Partitioning:
    """Partitioning whose strides span the column's real min/max (one small
    aggregate query pushed to the database) instead of a hard-coded bound."""
    row = read_jdbc(spark, url, f"select min({column}) as lo, max({column}) as hi from {table}",
                    props, fetch_size=None).first()
    lo, hi = (row["lo"] or 0), (row["hi"] or 0)
    return Partitioning(column, int(lo), int(hi) + 1, num_partitions)


def write_jdbc(df: DataFrame, url: str, table: str, props: dict | None = None, mode: str = "overwrite",
               batch_size: int = 1000, num_partitions: int | None = None, truncate: bool = False) -> None:
    """Write a table; ``batchsize`` rows per insert round trip.  ``overwrite``
    drops and re-creates the table unless ``truncate``.  ``num_partitions``
    caps concurrent connections (coalesce, no shuffle)."""
    out = df.coalesce(num_partitions) if num_partitions else df
    (out.write.format("jdbc").options(url=url, dbtable=table, batchsize=str(batch_size),
                                      truncate=str(truncate).lower(), **(props or {}))
     .mode(mode).save())


def derived_content_sql(min_size: int, max_size: int, batch: int | None, size_col: str = "structure_size") -> str:
    """The enrichment batch as SQL for a relational source: content left join
    source, strict size window, newest first with the id as tie-break."""
    limit = f" limit {int(batch)}" if batch is not None else ""
    return (f"select c.*, src.label as source from content c left join source src on c.source_id = src.id "
            f"where {size_col} > {int(min_size)} and {size_col} < {int(max_size)} "
            f"order by last_updated desc nulls first, c.id{limit}")


def id_bounds(df: DataFrame, column: str = "id") -> tuple[int, int]:
    """min/max of a column (one aggregate) for partitioned reads of a copy."""
    r = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi")).first()
    return int(r["lo"] or 0), int(r["hi"] or 0)
