"""Mixing sources to target weights by repeating documents.

Sizes are summed per source, shares of the whole are levelled against each
source's ceiling, and every document is taken floor(rate) times plus once more
when a hash of its id falls below the fraction.  Only one row per source is
ever gathered, in a table, and only sums over it reach the driver.

Defined cases: a null text has size 0; null is a source of its own, ranked
last; a source without words has target 0 and rate 0; a null id hashes like an
empty one, repeated ids fall alike; an empty table gives no rows.  Columns of
the input are kept; those with a name added here are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docweave.llm.common import WORD_RE, Scratch

#: Weights of the sources in order, repeating; share of all words; ceiling.
WEIGHTS, SHARE, CEILING = (5, 2, 1), 1.5, 2.0
SEED = "mix-1"
#: A table of sources up to this many rows is broadcast; a larger one is shuffled.
BROADCAST_SOURCES = 50_000


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_RE)), F.lit(0)).cast("long")


def uniform(doc_id: Column, seed: str) -> Column:
    """A number in [0, 1) from the first 52 bits of a digest of seed and id."""
    h = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def repetition_rates(sized: DataFrame, scratch: Scratch, weights=WEIGHTS, share=SHARE,
                     ceiling=CEILING) -> DataFrame:
    """source, source_size, target, rate: one row per source."""
    by = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    table = scratch.save(by.withColumn("weight", weight).withColumn("most", ceiling * F.col("source_size")), "sources")
    total = table.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level = 0.0
    # Each pass fixes the sources whose share is above their ceiling at that
    # ceiling and spreads the rest; the level only rises, so it ends.
    fixed = None
    while True:
        capped = F.col("weight") * F.lit(level) > F.col("most")
        s = table.agg(F.sum(F.when(capped, F.col("most")).otherwise(0.0)).alias("held"),
                      F.sum(F.when(capped, 0.0).otherwise(F.col("weight"))).alias("open"),
                      F.sum(capped.cast("int")).alias("n")).first()
        if s["n"] == fixed or not s["open"]:
            break
        fixed, level = s["n"], (share * total - s["held"]) / s["open"]
    target = F.least(F.col("weight") * F.lit(level), F.col("most"))
    return table.select("source", "source_size", target.alias("target"),
                        F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0).alias("rate"))


def mix(docs: DataFrame, text_col: str = "text", source_col: str = "source", id_col: str = "doc_id",
        seed: str = SEED, **rule) -> DataFrame:
    """Every document with size, source_size, target, rate and copies."""
    scratch = Scratch(docs.sparkSession, "mixing")
    added = ("size", "source_size", "target", "rate", "copies")
    docs = docs.drop(*[c for c in added if c in docs.columns])
    sized = docs.select(F.col(source_col).alias("source"), words(F.col(text_col)).alias("size"))
    rates = repetition_rates(sized, scratch, **rule)
    small = rates.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    side = rates.withColumnRenamed("source", "__source")
    side = F.broadcast(side) if small else side.hint("shuffle_hash")
    out = docs.withColumn("size", words(F.col(text_col))).join(
        side, F.col(source_col).eqNullSafe(F.col("__source")), "left").drop("__source")
    whole = F.floor("rate")
    extra = (uniform(F.col(id_col), seed) < F.col("rate") - whole).cast("long")
    return out.withColumn("copies", F.when(F.col("size") > 0, whole + extra).otherwise(F.lit(0).cast("long")))


def emit(mixed: DataFrame) -> DataFrame:
    """The mix itself: each document as many times as it is taken."""
    copies = F.sequence(F.lit(1).cast("long"), F.col("copies"))
    return (mixed.filter(F.col("copies") > 0).withColumn("__copy", F.explode(copies))
            .drop("size", "source_size", "target", "rate", "copies", "__copy"))
