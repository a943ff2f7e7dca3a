"""Parallel map-reduce, digests and partition layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DIGESTS = {"SHA-256": lambda c: F.sha2(c, 256), "SHA-1": F.sha1, "MD5": F.md5}


def estimate_pi(spark: SparkSession, slices: int = 2, seed: int = 42) -> DataFrame:
    """Monte-Carlo Pi: n = min(100000 * slices, 2^31 - 1) samples over ids
    1 .. n-1 in ``slices`` partitions; pi = 4 * hits / (n - 1)."""
    n = min(100000 * slices, 2**31 - 1)
    pts = spark.range(1, n, 1, slices).select(
        (F.rand(seed) * 2 - 1).alias("x"), (F.rand(seed + 1) * 2 - 1).alias("y"))
    return pts.agg((F.lit(4.0) * F.sum(F.when(F.col("x") ** 2 + F.col("y") ** 2 <= 1, 1).otherwise(0))
                    / F.lit(n - 1)).alias("pi"))


# A prime, and its shares by the plastic number and its square.
# Their multiples modulo the prime fill the square evenly, ever more finely.
PRIME, STEP_X, STEP_Y = 2147483647, 1621087444, 1223722706


def pi_from_keys(df: DataFrame, key: str) -> DataFrame:
    """Pi from the rows of a table: each integer key picks a point of the unit
    square (distinct points for keys that differ modulo ``PRIME``, so more rows
    give a better value); pi = 4 * share of points inside the quarter circle.
    One partial + final aggregate, no shuffle of rows."""
    k = F.col(key).cast("long") % PRIME
    x = ((k * STEP_X) % PRIME + 0.5) / PRIME
    y = ((k * STEP_Y) % PRIME + 0.5) / PRIME
    inside = F.when(x * x + y * y <= 1.0, 1).otherwise(0)
    # try_divide: an empty table gives NULL instead of a division error (ANSI)
    return df.agg(F.count(F.lit(1)).alias("samples"),
                  F.try_divide(F.lit(4.0) * F.sum(inside), F.count(F.lit(1))).alias("pi"))


def with_checksum(df: DataFrame, col: str | Column, algorithm: str = "SHA-256",
                  out_col: str = "checksum") -> DataFrame:
    """Lower-case hex digest of a string or binary column."""
    try:
        fn = DIGESTS[algorithm.upper()]
    except KeyError:
        raise ValueError(f"algorithm must be one of {sorted(DIGESTS)}") from None
    c = F.col(col) if isinstance(col, str) else col
    return df.withColumn(out_col, fn(c))


def spread(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """Repartition into ``n`` partitions (hashed on ``keys`` when given)."""
    return df.repartition(n, *keys) if keys else df.repartition(n)


def partition_sizes(df: DataFrame) -> DataFrame:
    """(partition, rows): rows per partition, computed by an aggregate on
    ``spark_partition_id`` instead of an RDD pass on the driver."""
    return (df.select(F.spark_partition_id().alias("partition"))
            .groupBy("partition").agg(F.count(F.lit(1)).alias("rows")))
