"""Join helpers that decide broadcast vs shuffle from a checked size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A lookup side is broadcast only when it has at most this many rows (a stored
# one is read no further than one row beyond) ...
DEFAULT_BROADCAST_ROWS = 200_000
# ... and at most this many bytes, measured on its rows as JSON text.
DEFAULT_BROADCAST_BYTES = 64 << 20


def is_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
             max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """One job over the lookup (all of it when it is computed): rows and bytes."""
    return _fits(df, max_rows, max_bytes)[0]


def _fits(df: DataFrame, max_rows: int, max_bytes: int) -> tuple[bool, int]:
    """Whether the lookup is small, and how many of its rows are if it is not."""
    size = F.octet_length(F.to_json(F.struct(*[F.col(c) for c in df.columns])))
    n, total = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return n <= max_rows and total <= max_bytes, min(max_rows, max_bytes * n // max(total, 1))


def lookup_join(big: DataFrame, lookup: DataFrame, big_key: str, lookup_key: str, how: str = "left",
                salt_by: list[str] | None = None, salts: int = 16,
                max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS, weight: Column | None = None,
                part: str | None = None) -> DataFrame:
    """Join a (possibly very skewed) row table to a lookup table on one key.

    Small lookup (bounded count): broadcast hash join, no shuffle.  Otherwise
    the join is salted: each big-side row gets ``pmod(xxhash64(salt_by), salts)``
    (deterministic, so a recomputed task sees the same salt) and the lookup
    rows are repeated once per salt, so a hot key (a frequent token) is split
    over ``salts`` tasks instead of landing in one.  The price is ``salts``
    copies of the lookup in the shuffle, small next to the row side (tokens);
    AQE's skew-join splitting stays on as a second, runtime safeguard.

    With ``weight`` (how often a lookup row's key occurs, roughly) the heaviest rows that a broadcast may hold are joined in place, so
    only rows of rarer keys move.  ``part`` names the column ``by_document``
    dealt the big side by: the moved rows return to its partitions, and what
    follows by that column needs no shuffle.
    """
    small, rows = _fits(lookup, max_broadcast_rows, DEFAULT_BROADCAST_BYTES)
    if small:
        return big.join(F.broadcast(lookup), big[big_key] == lookup[lookup_key], how)
    if weight is not None and rows:
        weighed = lookup.select(weight.alias("__weight"))
        cut = weighed.orderBy(F.desc("__weight")).limit(rows).agg(F.min("__weight")).first()[0]
        # rows of one key weigh the same, so the cut parts no key
        hot = lookup.filter(weight > cut)
        here = big.join(F.broadcast(hot), big[big_key] == hot[lookup_key], "inner")
        keys = hot.select(F.col(lookup_key).alias("__hot"))
        cold = big.join(F.broadcast(keys), big[big_key] == keys["__hot"], "left_anti")
        rest = lookup.filter(~F.coalesce(weight > cut, F.lit(False)))
        moved = _salted(cold, rest, big_key, lookup_key, how, salt_by or big.columns, salts)
        if part is not None:
            moved = moved.repartition(_dealt(big), part)
        return here.unionByName(moved)
    return _salted(big, lookup, big_key, lookup_key, how, salt_by or big.columns, salts)


def _dealt(df: DataFrame) -> int:
    """To how many partitions ``by_document`` dealt the rows: the uppermost explicit
    repartition of the plan, or the session's count if there is none."""
    nodes = [df._jdf.queryExecution().analyzed()]
    while nodes:
        node = nodes.pop(0)
        if node.nodeName() == "RepartitionByExpression" and node.optNumPartitions().isDefined():
            return int(node.optNumPartitions().get())
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _salted(big: DataFrame, lookup: DataFrame, big_key: str, lookup_key: str, how: str, cols: list[str],
            salts: int) -> DataFrame:
    b = big.withColumn("__salt_b", F.pmod(F.xxhash64(*[F.col(c) for c in cols]), F.lit(salts)))
    lk = lookup.withColumn("__salt_l", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    cond = (b[big_key] == lk[lookup_key]) & (b["__salt_b"] == lk["__salt_l"])
    return b.join(lk, cond, how).drop("__salt_b", "__salt_l")
