"""Projection, predicates, the lookup join and newest-N batches (P*, J1, L1, L2)."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.functions.joins import DEFAULT_BROADCAST_ROWS, lookup_join
from docweave.session import checkpoint_dir


def with_source(content: DataFrame, source: DataFrame, key: str = "source_id",
                source_key: str = "id", label: str = "label", out: str = "source",
                max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS, id_col: str = "id") -> DataFrame:
    """``select c.*, src.label as source from content c left join source src``.

    Unmatched content rows stay with a NULL label.  The lookup side is
    broadcast only after a bounded row count proves it small; otherwise the
    join is salted, since one source may hold a large share of the content.
    """
    src = source.select(F.col(source_key).alias("__src_id"), F.col(label).alias(out))
    salt_by = [id_col] if id_col in content.columns else None
    return lookup_join(content, src, key, "__src_id", "left", salt_by=salt_by,
                       max_broadcast_rows=max_broadcast_rows).drop("__src_id")


def filter_size(df: DataFrame, col: str, lo: int | None, hi: int | None) -> DataFrame:
    """Both bounds strict: ``col > lo and col < hi``; NULL sizes drop."""
    cond = F.col(col).isNotNull()
    if lo is not None:
        cond = cond & (F.col(col) > F.lit(lo))
    if hi is not None:
        cond = cond & (F.col(col) < F.lit(hi))
    return df.filter(cond)


def filter_unindexed(df: DataFrame, col: str = "index_date") -> DataFrame:
    """Rows still to index: the index date is NULL."""
    return df.filter(F.col(col).isNull())


#: Size of the ledger filter: ``FILTER_BLOCKS`` blocks of 32,768 bits (16 MB) whatever
#: the ledger, and bits set per id, all in the block its hash names.
FILTER_BLOCKS, BLOCK_BITS, BITS_PER_ID = 4096, 1 << 15, 6


def _block(id_col: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(id_col), F.lit(blocks))


def _bits(id_col: str) -> list[Column]:
    return [F.pmod(F.xxhash64(id_col, F.lit(i)), F.lit(BLOCK_BITS)) for i in range(1, BITS_PER_ID + 1)]


def ledger_filter(ledger: DataFrame, ledger_id: str = "id", blocks: int = FILTER_BLOCKS) -> DataFrame:
    """Blocked Bloom filter of the done ids: (block, words array<bigint>), at most ``blocks``
    rows of 4 kB.  Bits are set by an aggregate that combines map-side."""
    done = ledger.filter(F.col(ledger_id).isNotNull())
    bits = done.select(_block(ledger_id, blocks).alias("block"), F.explode(F.array(*_bits(ledger_id))).alias("bit"))
    masks = bits.groupBy("block", F.expr("bit div 64").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("mask"))
    by_word = F.map_from_entries(F.collect_list(F.struct("word", "mask")))
    all_words = F.sequence(F.lit(0).cast("long"), F.lit(BLOCK_BITS // 64 - 1).cast("long"))
    return masks.groupBy("block").agg(by_word.alias("__m")).select("block", F.transform(
        all_words, lambda w: F.coalesce(F.try_element_at("__m", w), F.lit(0).cast("long"))).alias("words"))


def perhaps_done(df: DataFrame, bloom: DataFrame, id_col: str = "id", blocks: int = FILTER_BLOCKS,
                 out_col: str = "perhaps_done") -> DataFrame:
    """Flag the rows whose id the filter does not rule out (one broadcast join, no shuffle)."""
    side = bloom.select(F.col("block").alias("__fb"), F.col("words").alias("__fw"))
    rows = df.withColumn("__b", _block(id_col, blocks)).join(F.broadcast(side), F.col("__b") == F.col("__fb"), "left")
    hit = F.col(id_col).isNotNull() & F.col("__fw").isNotNull()
    for bit in _bits(id_col):
        word = F.get("__fw", F.floor(bit / 64).cast("int"))
        hit = hit & (F.getbit(word, (bit % 64).cast("int")) == 1)
    return rows.withColumn(out_col, F.coalesce(hit, F.lit(False))).drop("__b", "__fb", "__fw")


def unindexed_by_ledger(df: DataFrame, ledger: DataFrame, id_col: str = "id",
                        ledger_id: str = "id", blocks: int = FILTER_BLOCKS) -> DataFrame:
    """Immutable-source form of the same predicate: rows whose id is not in the ledger.

    The wide rows are never shuffled.  A Bloom filter of the ledger rules most new
    ids out at the scan; the ids it leaves (done ones, and a few wrong positives) meet
    the ledger in an exact anti join of the ids alone, and the wrong positives, few,
    come back through a lookup of checked size.
    """
    checkpoint_dir(df.sparkSession)
    bloom = ledger_filter(ledger, ledger_id, blocks).checkpoint(eager=True)
    done = ledger.select(F.col(ledger_id).alias("__done"))
    doubt = perhaps_done(df.select(id_col), bloom, id_col, blocks).filter("perhaps_done").select(id_col).distinct()
    wrong = doubt.join(done, F.col(id_col) == F.col("__done"), "left_anti").select(F.col(id_col).alias("__wrong"))
    wrong = wrong.checkpoint(eager=True)
    rows = lookup_join(perhaps_done(df, bloom, id_col, blocks, "__perhaps"), wrong, id_col, "__wrong", "left",
                       salt_by=[id_col])
    return rows.filter(~F.col("__perhaps") | F.col("__wrong").isNotNull()).select(*df.columns)


def latest(df: DataFrame, ts: str, n: int | None, tiebreak: str | None = "id") -> DataFrame:
    """Newest-N batch: ``order by ts desc nulls first, tiebreak limit n``.

    NULL timestamps sort first on descending order, as the relational source
    did; the tie-break makes the batch deterministic.  Planned as
    TakeOrderedAndProject (per-partition top-n, then a merge of n rows per
    partition), so the full table is never sorted.
    """
    if n is None:
        return df  # the whole table: no order needed, and no global sort paid
    order = [F.col(ts).desc_nulls_first()]
    if tiebreak:
        order.append(F.col(tiebreak).asc())
    return df.orderBy(*order).limit(n)


def any_batch(df: DataFrame, n: int) -> DataFrame:
    """Unordered limit: whichever n rows arrive first."""
    return df.limit(n)


def project_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols)


def lines_containing(df: DataFrame, needle: str, col: str = "value") -> DataFrame:
    return df.filter(F.col(col).contains(needle))


def stamp(df: DataFrame, ts: _dt.datetime | str | Column, out: str = "timestamp") -> DataFrame:
    """Constant run-stamp column (one value for the whole job)."""
    value = ts if isinstance(ts, Column) else F.lit(ts)
    if isinstance(ts, str):
        value = F.to_timestamp(F.lit(ts))
    return df.withColumn(out, value)


def newest_rows(df: DataFrame, ts: str, n: int | None, key: str = "id",
                heavy: tuple[str, ...] = ("body_text",)) -> DataFrame:
    """The newest-N batch with its wide columns, without reading them for
    every row.

    ``latest`` on a frame with the text makes the scan read the text column
    of the whole table to keep n rows.  Here the (key, time) pairs are chosen on
    a narrow scan (no ``heavy`` columns) and joined back to the wide rows; the
    planner broadcasts them when they are few and shuffles them otherwise.
    Nothing is collected.  Returns the same rows as ``latest`` when keys do not
    repeat (a key that does is returned with all its rows of that time),
    unordered.
    """
    if n is None:
        return df
    light = df.drop(*[c for c in heavy if c in df.columns])
    top = latest(light, ts, n, key).select(F.col(key).alias("__key"), F.col(ts).alias("__ts"))
    return df.join(top, F.col(key).eqNullSafe(F.col("__key")) & F.col(ts).eqNullSafe(F.col("__ts")), "left_semi")
