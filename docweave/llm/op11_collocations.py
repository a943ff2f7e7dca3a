"""Phrase collocations by partitioned mining (SON) and exact global counts.

Documents fall into ``shards`` of even size by a hash of their text.  A shard is mined
completely at the support lowered in proportion to its share of the language's
words: a phrase that reaches ``support`` over all shards reaches ``support *
share`` in one of them.  Mining goes by levels: words, then pairs of locally
frequent words, then triples of two locally frequent pairs.  The union of what
the shards find is then counted over all documents, without regard to shards.

A shard is a key of the counting jobs, not a task: its counts are hash aggregates that
combine map-side, whatever its size.  Pairs and triples are mined as 64-bit hashes,
as a candidate too many does no harm; tasks learn which are frequent from a bitmap of
fixed size (``BITS``).  The last count is by the phrases themselves and decides.
Words, pairs and triples of a slice of text are numbers, so counting is a sort of
integers.

Defined cases: null text is empty, a null language is ``und`` and one with a
language of that name; a text without words adds nothing; repeated rows count
each; ties in a rank are impossible, as phrases differ; a long text is cut at
piece ends into slices, so memory is bounded by ``SLICE`` and the longest piece;
empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docweave.functions.joins import lookup_join
from docweave.llm.common import Scratch

SUPPORT, LIMIT = 10, 2000
#: Shards of the corpus (16 at most): with two even shares the local support is 5 for a
#: support of 10; with more it soon falls to 1, where every phrase is frequent.
SHARDS = 2
#: Size of the bitmaps of frequent phrases, 16 MB each.
BITS = 27
#: Low bits of a phrase's key: 4 for its shard, 8 for the local support it needs there (a
#: higher one counts as 255: more candidates, none less).
MAX_SHARDS, MAX_NEED, TAG_BITS = 16, 255, (1 << 12) - 1
#: Bytes of text turned into numbers at a time.
SLICE = 2 << 20
#: Bytes of text of all groups of a task that wait for their slice to fill, and rows a batch.
HELD, BATCH_ROWS = 8 << 20, 1000
#: Groups whose first ``LIMIT`` are taken before those of a language are ranked.
SALTS = 64

_SEPARATORS = b".,;:!?\n\v\f\r"
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_FOLD = bytes.maketrans(_SEPARATORS + b"\t" + _UPPER, b"\n" * len(_SEPARATORS) + b" " + _UPPER.lower())
_MIX = np.uint64(0x9E3779B97F4A7C15)


def slices(texts: Iterable[tuple[tuple, str | None]], size: int = SLICE, held: int = HELD) -> Iterator[tuple[tuple, bytes]]:
    """(group, folded texts of the group) of (group, text) pairs, in slices of about ``size``
    bytes cut at piece ends (LF); at most ``held`` bytes of all groups wait."""
    waiting: dict[tuple, list[bytes]] = {}
    sizes: dict[tuple, int] = {}

    def take(group):
        del sizes[group]
        return group, b"".join(waiting.pop(group))

    for group, text in texts:
        if not text:
            continue
        data = text.encode().translate(_FOLD) + b"\n"
        at = 0
        while len(data) - at > size:
            cut = data.rfind(b"\n", at, at + size) + 1 or data.index(b"\n", at + size) + 1
            yield group, data[at:cut]
            at = cut
        waiting.setdefault(group, []).append(data[at:])
        sizes[group] = sizes.get(group, 0) + len(data) - at
        if sizes[group] >= size:
            yield take(group)
        elif sum(sizes.values()) > held:
            yield take(max(sizes, key=sizes.get))
    for group in list(sizes):
        yield take(group)


def numbered(data: bytes) -> tuple[np.ndarray, pa.Array]:
    """Word numbers in order, -1 at piece ends, and the words by number."""
    parts = pc.split_pattern(pa.array([data.replace(b"\n", b" \n ")], pa.binary()), pattern=" ") \
        .flatten().dictionary_encode()
    ids, words = parts.indices.to_numpy(), parts.dictionary
    ids = ids[ids != pc.index(words, pa.scalar(b"", pa.binary())).as_py()]  # a copy
    ids[ids == pc.index(words, pa.scalar(b"\n", pa.binary())).as_py()] = -1
    return ids, words


def word_hashes(words: pa.Array) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words.to_pylist()), np.uint64, len(words))


def phrase_hashes(lang: str, *places: np.ndarray) -> np.ndarray:
    """Hash of each phrase of a language (one array of word hashes per place), low bits 0."""
    out = np.full(len(places[0]), xxhash.xxh64_intdigest(lang.encode()), np.uint64)
    for h in places:
        out = (out ^ h) * _MIX
        out ^= out >> np.uint64(29)
    return out * _MIX & ~np.uint64(TAG_BITS)


def tag(shard: int, need: int) -> np.uint64:
    return np.uint64(min(need, MAX_NEED) << 4 | shard)


def bit_of(keys: np.ndarray) -> np.ndarray:
    keys = keys.astype(np.uint64)
    return ((keys ^ (keys >> np.uint64(31))) * _MIX >> np.uint64(64 - BITS)).astype(np.int64)


def marked(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = bit_of(keys)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def bitmap(keys: DataFrame):
    """Broadcast bitmap of the column ``key`` (bigint)."""

    def run(batches):
        for batch in batches:
            at = np.unique(bit_of(batch.column(0).to_numpy().view(np.uint64)))
            yield pa.RecordBatch.from_arrays([pa.array(at >> 15), pa.array(at & 32767)], ["block", "bit"])

    blocks = (keys.select("key").mapInArrow(run, "block long, bit long")
              .groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits")).collect())
    out = np.zeros(1 << (BITS - 3), np.uint8)
    for r in blocks:  # at most 2 ** (BITS - 15) rows of 4 kB
        out[r["block"] * 4096:(r["block"] + 1) * 4096] = np.frombuffer(r["bits"], np.uint8)
    return keys.sparkSession.sparkContext.broadcast(out)


def word_keys(words: DataFrame) -> DataFrame:
    """Keys of the words (shard, need, lang, phrase)."""

    def run(batches):
        for batch in batches:
            groups: dict[tuple, list[int]] = {}
            for i, group in enumerate(zip(*(batch.column(j).to_pylist() for j in range(3)))):
                groups.setdefault(group, []).append(i)
            phrases = batch.column(3).cast(pa.binary())
            for (shard, need, lang), rows in groups.items():
                h = phrase_hashes(lang, word_hashes(phrases.take(pa.array(rows)))) | tag(shard, need)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], ["key"])

    return words.select("shard", "need", "lang", "phrase").mapInArrow(run, "key long")


def _phrases(words: pa.Array, *places: np.ndarray) -> pa.Array:
    parts = [words.take(pa.array(p)) for p in places]
    joined = pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.binary())) if len(parts) > 1 else parts[0]
    return joined.cast(pa.string())


def _codes(ids: np.ndarray, n_words: int, usable: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Places of pairs of adjacent (usable) words, and their numbers."""
    a, b = ids[:-1], ids[1:]
    good = (a >= 0) & (b >= 0)
    if usable is not None:
        good &= usable[a] & usable[b]
    at = np.flatnonzero(good)
    return at, a[at].astype(np.int64) * n_words + b[at]


def _pair_table(ids: np.ndarray, n_words: int):
    """All pairs of adjacent words: (first, second, count) and each place's pair (-1: none)."""
    at, codes = _codes(ids, n_words, None)
    codes, place, counts = np.unique(codes, return_inverse=True, return_counts=True)
    pair = np.full(len(ids), -1, np.int32)
    pair[at] = place
    return codes // n_words, codes % n_words, counts, pair


def _triples(ids: np.ndarray, n_words: int, pair: np.ndarray, usable: np.ndarray):
    """Triples of two adjacent usable pairs: (pair, third, count)."""
    good = (pair >= 0) & usable[pair]
    at = np.flatnonzero(good[:-1] & good[1:])
    codes, counts = np.unique(pair[at].astype(np.int64) * n_words + ids[at + 2], return_counts=True)
    return codes // n_words, codes % n_words, counts


def mine_words(data: bytes, lang: str, mark: np.uint64, bits) -> Iterator[tuple[pa.Array, np.ndarray]]:
    ids, words = numbered(data)
    counts = np.bincount(ids[ids >= 0], minlength=len(words))
    used = np.flatnonzero(counts)
    yield _phrases(words, used), counts[used]


def mine_pairs(data: bytes, lang: str, mark: np.uint64, bits: np.ndarray) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Keys of the pairs of frequent words."""
    ids, words = numbered(data)
    if len(ids) > 1:
        h = word_hashes(words)
        codes = _codes(ids, len(words), marked(bits, phrase_hashes(lang, h) | mark))[1]
        codes, counts = np.unique(codes, return_counts=True)
        keys = phrase_hashes(lang, h[codes // len(words)], h[codes % len(words)]) | mark
        yield pa.array(keys.view(np.int64)), counts


def mine_triples(data: bytes, lang: str, mark: np.uint64, bits: np.ndarray) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Keys of the triples of frequent pairs."""
    ids, words = numbered(data)
    if len(ids) > 2:
        h = word_hashes(words)
        first, second, _, pair = _pair_table(ids, len(words))
        if len(first):
            frequent = marked(bits, phrase_hashes(lang, h[first], h[second]) | mark)
            p, third, counts = _triples(ids, len(words), pair, frequent)
            keys = phrase_hashes(lang, h[first[p]], h[second[p]], h[third]) | mark
            yield pa.array(keys.view(np.int64)), counts


def count_candidates(data: bytes, lang: str, mark: np.uint64, bits: np.ndarray) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Candidate pairs, and candidate triples (whose pairs are candidates)."""
    ids, words = numbered(data)
    if len(ids) < 2:
        return
    h = word_hashes(words)
    first, second, counts, pair = _pair_table(ids, len(words))
    if not len(first):
        return
    wanted = marked(bits, phrase_hashes(lang, h[first], h[second]))
    yield _phrases(words, first[wanted], second[wanted]), counts[wanted]
    if len(ids) > 2:
        p, third, counts = _triples(ids, len(words), pair, wanted)
        wanted = marked(bits, phrase_hashes(lang, h[first[p]], h[second[p]], h[third]))
        p, third = p[wanted], third[wanted]
        yield _phrases(words, first[p], second[p], third), counts[wanted]


def found(texts: DataFrame, group: tuple[str, ...], keep: tuple[str, ...], mine: Callable, out: str,
          bits=None) -> DataFrame:
    """What ``mine`` finds (``out``, a DDL column) in the slices of each group of ``group`` (lang, and
    perhaps shard and need), its count c there, and the group's columns ``keep``."""
    types = [f"{c} {texts.schema[c].dataType.simpleString()}" for c in keep]
    schema = ", ".join([*types, out, "c long"])
    names = [*keep, out.split()[0], "c"]

    kinds = [pa.int32() if c == "shard" else pa.string() for c in keep]  # shard and lang

    def run(batches):
        texts_of = ((key, body) for batch in batches for *key, body in zip(*(c.to_pylist() for c in batch.columns)))
        for key, data in slices((tuple(key), body) for key, body in texts_of):
            named = dict(zip(group, key))
            mark = tag(named.get("shard", 0), named.get("need", 0))
            for values, counts in mine(data, named["lang"], mark, bits.value if bits is not None else None):
                yield pa.RecordBatch.from_arrays(
                    [*(pa.repeat(pa.scalar(named[c], kind), len(values)) for c, kind in zip(keep, kinds)),
                     values, pa.array(counts, pa.int64())], names)

    return texts.select(*group, "__body").mapInArrow(run, schema)


@contextlib.contextmanager
def short_batches(spark, rows: int = BATCH_ROWS, key: str = "spark.sql.execution.arrow.maxRecordsPerBatch"):
    """Arrow batches of few rows for the statements inside: texts are collected to slices anyway."""
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def frequent_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", support: int = SUPPORT,
                     shards: int = SHARDS, scratch: Scratch | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All phrases of two or three words with at least ``support`` occurrences in a
    language (lang, phrase, c), the words with as many, and the words of each language (lang, n)."""
    if not 0 < shards <= MAX_SHARDS:
        raise ValueError(f"shards must be 1 to {MAX_SHARDS}")
    scratch = scratch or Scratch(docs.sparkSession, "phrases")
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                        F.pmod(F.xxhash64(F.col(lang_col).cast("string"), text_col), F.lit(shards)).cast("int").alias("shard"),
                        F.col(text_col).alias("__body"))

    words = scratch.save(found(texts, ("shard", "lang"), ("shard", "lang"), mine_words, "phrase string")
                         .groupBy("shard", "lang", "phrase").agg(F.sum("c").alias("c")), "words")
    sizes = scratch.save(words.groupBy("shard", "lang").agg(F.sum("c").alias("m")), "sizes")
    totals = scratch.save(sizes.groupBy("lang").agg(F.sum("m").alias("n")), "totals")
    group = lambda: F.concat(F.col("shard").cast("string"), F.lit(":"), F.col("lang"))
    # ceil(support * share), in integers
    need = scratch.save(sizes.join(totals, "lang").select(
        group().alias("__group"), F.expr(f"({support} * m + n - 1) div n").alias("need")), "need")

    def with_need(rows: DataFrame, salt_by: list[str]) -> DataFrame:
        return lookup_join(rows.withColumn("__g", group()), need, "__g", "__group", "inner", salt_by=salt_by) \
            .drop("__g", "__group")

    def frequent_keys(mine: Callable, bits, name: str) -> DataFrame:
        rows = found(with_need(texts, ["__body"]), ("lang", "shard", "need"), (), mine, "key long", bits)
        frequent = rows.groupBy("key").agg(F.sum("c").alias("c")).filter(f"c >= shiftright(key, 4) & {MAX_NEED}")
        return scratch.save(frequent.select("key"), name)

    seen = bitmap(word_keys(with_need(words, ["phrase"]).filter("c >= need")))
    pairs = frequent_keys(mine_pairs, seen, "pairs")
    seen.unpersist()
    seen = bitmap(pairs)
    triples = frequent_keys(mine_triples, seen, "triples")
    seen.unpersist()
    seen = bitmap(pairs.union(triples).select(F.col("key").bitwiseAND(F.lit(~TAG_BITS).cast("long")).alias("key")))
    scratch.drop("pairs", "triples", "sizes", "need")
    exact = (found(texts, ("lang",), ("lang",), count_candidates, "phrase string", seen)
             .groupBy("lang", "phrase").agg(F.sum("c").alias("c")).filter(F.col("c") >= support))
    phrases = scratch.save(exact, "phrases")
    frequent_words = scratch.save(words.groupBy("lang", "phrase").agg(F.sum("c").alias("c"))
                                  .filter(F.col("c") >= support), "frequent_words")
    scratch.drop("words")
    return phrases, frequent_words, totals


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", support: int = SUPPORT,
                 limit: int = LIMIT, shards: int = SHARDS) -> DataFrame:
    """The first ``limit`` collocations of each language: lang, rank, phrase, a, l, r, n, score."""
    scratch = Scratch(docs.sparkSession, "collocations")
    with short_batches(docs.sparkSession):
        phrases, words, totals = frequent_phrases(docs, text_col, lang_col, support, shards, scratch)
    w = F.split("phrase", " ")
    key = lambda phrase: F.concat(F.col("lang"), F.lit("\t"), phrase)
    known = phrases.unionByName(words).select(key(F.col("phrase")).alias("__key"), F.col("c").alias("__f"))
    known = scratch.save(known, "known")

    longer = (phrases.filter(F.size(w) == 3)
              .select("lang", F.explode(F.array(F.concat_ws(" ", w[0], w[1]), F.concat_ws(" ", w[1], w[2])))
                      .alias("phrase"), "c")
              .groupBy("lang", "phrase").agg(F.max("c").alias("within")))
    kept = (phrases.join(longer, ["lang", "phrase"], "left")
            .filter(F.col("within").isNull() | (F.col("within") * 100 < F.col("c") * 50))
            .select("lang", "phrase", F.col("c").alias("a")))

    cut = lambda k, left, right: F.struct(F.lit(k).alias("k"), left.alias("left"), right.alias("right"))
    two = F.array(cut(1, w[0], w[1]))
    three = F.array(cut(1, w[0], F.concat_ws(" ", w[1], w[2])), cut(2, F.concat_ws(" ", w[0], w[1]), w[2]))
    cuts = (kept.withColumn("cut", F.explode(F.when(F.size(w) == 2, two).otherwise(three)))
            .select("lang", "phrase", "a", "cut.k", key(F.col("cut.left")).alias("__left"),
                    key(F.col("cut.right")).alias("__right")))
    for side in ("left", "right"):
        cuts = lookup_join(cuts, known, f"__{side}", "__key", "inner", salt_by=["lang", "phrase"]) \
            .withColumnRenamed("__f", side[0]).drop("__key")
    big = lambda c: f"cast({c} as decimal(16,0))"
    score = F.expr(f"(cast(1000000 as decimal(7,0)) * {big('a')} * {big('a')}) div ({big('l')} * {big('r')})")
    scored = (cuts.withColumn("score", score).groupBy("lang", "phrase", "a")
              .agg(F.min(F.struct("score", "k", "l", "r")).alias("m"))
              .select("lang", "phrase", "a", "m.l", "m.r", "m.score"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = scored.withColumn("__salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    first = (salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "__salt").orderBy(*order)))
             .filter(F.col("rank") <= limit))
    # at most SALTS * limit rows a language meet here
    best = (first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
            .filter(F.col("rank") <= limit))
    best = lookup_join(best, totals.withColumnRenamed("lang", "__lang"), "lang", "__lang", "inner")
    return best.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
