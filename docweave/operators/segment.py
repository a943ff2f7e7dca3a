"""Text segmentation: document assembler, sentences, tokens, normaliser, finisher
(T1-T5).

Design: text is cut into *contiguous* pieces with one regex pass and
exploded with their position; a piece's character offset is the running sum
of the lengths before it::

    end = base + sum(length(piece)) over (partition by doc, sentence order by pos) - 1

Sentences are the pieces between break marks (lossless, then trimmed).
Tokens are matches of ``\\s*(?:token)``: each piece carries the whitespace
in front of its token, so the pieces are contiguous, no whitespace rows are
exploded, and ``pos`` (the explode position) is the token index.

The windows are partitioned by document.  Callers that chain several of
these operators should first ``by_document`` the input: the documents (one
row each) are then hash-partitioned once, and every later window, group-by or
co-partitioned join keyed on the document id re-uses that partitioning
instead of shuffling the much larger token rows.  A document is a single
input row, so the largest window partition is bounded by the largest
document.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave.schema import ANNOTATION
from docweave.session import checkpoint_dir

# The rule set for sentences and tokens (ours, not a library's).
SENTENCE_BREAK = r"([.!?]+\s+|\n+)"
ABBREVIATIONS = ("Mr", "Mrs", "Dr", "St")
CONTEXT_CHARS = "(),.?!"
MARK = "\u0001"
# What ``\s`` matches.
BLANKS = " \t\n\x0b\f\r"
# Where ``$`` matches in front of the last character.
LINE_ENDS = ("\u0085", "\u2028", "\u2029")
# Text that holds the mark itself is written with these while it is cut; they
# are neither letters nor blanks, as the characters they stand for.
ESCAPES = (("\u0002", "\u00022"), (MARK, "\u00021"))


#: Stored bytes of documents for one task: their tokens (some 65 times as much) are then
#: sorted in memory.
PARTITION_BYTES = 1 << 20
#: Partitions that size alone asks for at most.
MAX_PARTITIONS = 10_000


def document_partitions(df: DataFrame) -> int:
    """How many partitions ``by_document`` deals ``df`` to: ``spark.sql.shuffle.partitions``, or
    more where the files it reads hold more than ``PARTITION_BYTES`` for each of them."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    leaves = [leaves.apply(i) for i in range(leaves.size())]
    size = sum(int(str(x.stats().sizeInBytes())) for x in leaves
               if x.nodeName().startswith("LogicalRelation") or "Relation" in x.nodeName() and "V2" in x.nodeName())
    return max(n, min(size // PARTITION_BYTES, MAX_PARTITIONS))


def by_document(df: DataFrame, id_col: str, partitions: int | None = None,
                keep_layout: bool = False) -> DataFrame:
    """Hash-partition documents by id once, before they fan out into tokens.

    The partition count is explicit (default ``document_partitions``)
    because the shuffled bytes (one row per document) say little about the
    work after it: every document expands into hundreds of token rows, and an
    adaptive coalesce sized on the document bytes would starve that work of
    parallelism.  It grows with the input, so that a task's tokens do not.

    With ``keep_layout`` the frame is returned as it is: use it when the
    documents come from a table bucketed by the id (``tables.save_bucketed``),
    whose scan is already hash-partitioned, so no shuffle happens at all.
    """
    if keep_layout:
        return df
    if partitions is None:
        partitions = document_partitions(df)
    return df.repartition(partitions, id_col)


def assemble(df: DataFrame, text_col: str, out_col: str = "document") -> DataFrame:
    """One annotation spanning the whole text; NULL text gives an empty array."""
    text = F.col(text_col)
    ann = F.struct(
        F.lit("document").alias("annotatorType"),
        F.lit(0).alias("begin"),
        (F.length(text) - 1).cast("int").alias("end"),
        text.alias("result"),
        F.create_map(F.lit("sentence"), F.lit("0")).alias("metadata"),
        F.array().cast(T.ArrayType(T.FloatType())).alias("embeddings"),
    )
    return df.withColumn(out_col, F.when(text.isNull(), F.array().cast(T.ArrayType(ANNOTATION)))
                         .otherwise(F.array(ann)))


def _offsets(pieces: DataFrame, part: Sequence[str], base: Column | None = None) -> DataFrame:
    """Add ``begin`` (0-based) to exploded lossless pieces ordered by ``pos``."""
    w = Window.partitionBy(*part).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    begin = F.sum(F.length("piece")).over(w) - F.length("piece")
    if base is not None:
        begin = begin + base
    return pieces.withColumn("begin", begin.cast("int"))


# Words with inner periods, and the period behind them if there is one.
DOTTED_WORD = r"\p{L}+(?:\.\p{L}+)*\.?"
#: Score from which a word counts as an abbreviation.
ABBREVIATION_SCORE = 0.3


def abbreviation_scores(df: DataFrame, text_col: str) -> DataFrame:
    """(word, n, n_dot, score) of every lower-cased word that a period follows somewhere.

    The score is the log-likelihood ratio of "a period follows this word almost always
    (0.99)" against "as often as any word", less for long words and for each
    occurrence without a period, more for inner periods.  Counting is one hash
    aggregate over the texts; the corpus totals are one row.
    """
    checkpoint_dir(df.sparkSession)
    hit = df.select(F.explode(F.regexp_extract_all(F.col(text_col), F.lit(DOTTED_WORD), 0)).alias("__h"))
    counts = (hit.groupBy(F.lower(F.rtrim("__h", F.lit("."))).alias("word"))
              .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("__h").endswith(".").cast("long")).alias("n_dot")))
    counts = counts.checkpoint(eager=True)
    n, dots = counts.agg(F.sum("n"), F.sum("n_dot")).first()
    share = min(max((dots or 0) / (n or 1), 1e-12), 1 - 1e-12)
    bare = F.length(F.replace("word", F.lit("."), F.lit("")))
    without = F.col("n") - F.col("n_dot")
    ratio = 2 * (F.col("n_dot") * F.lit(math.log(0.99) - math.log(share))
                 + without * F.lit(math.log(0.01) - math.log(1 - share)))
    score = (ratio * F.exp(-bare) * (F.length("word") - bare + 1) * F.exp(-without * F.log(bare.cast("double"))))
    return counts.filter("n_dot > 0").select("word", "n", "n_dot", score.alias("score"))


def learn_abbreviations(df: DataFrame, text_col: str, threshold: float = ABBREVIATION_SCORE,
                        max_words: int = 1000) -> list[str]:
    """The abbreviations of a corpus for ``split_sentences(..., ignore_case=True)``: at most
    ``max_words`` (the highest scores), as they become one pattern."""
    best = (abbreviation_scores(df, text_col).filter(F.col("score") >= threshold)
            .orderBy(F.desc("score"), "word").limit(max_words))
    return sorted(r["word"] for r in best.collect())


def split_sentences(df: DataFrame, id_col: str, text_col: str,
                    abbreviations: Sequence[str] = ABBREVIATIONS, ignore_case: bool = False) -> DataFrame:
    """Sentences with offsets: (id, sentence, begin, end, result).

    A break follows a run of ``.!?`` plus whitespace, or a run of newlines,
    except after an abbreviation (a fixed list, or ``learn_abbreviations``).  Leading/trailing whitespace is trimmed from
    each sentence (offsets follow), blank pieces are dropped and sentences are
    numbered from 0 in text order.
    """
    marked = F.col(text_col)
    for char, code in ESCAPES:
        marked = F.replace(marked, F.lit(char), F.lit(code))
    marked = F.regexp_replace(marked, SENTENCE_BREAK, "$1" + MARK)
    if abbreviations:
        abbr = "|".join(a.replace(".", r"\.") for a in abbreviations)
        case = "(?iu)" if ignore_case else ""
        # twice: of neighbouring abbreviations the first takes the blank before the second
        for _ in range(2):
            marked = F.regexp_replace(marked, rf"{case}(^|[^\p{{L}}])({abbr})\.(\s+){MARK}", "$1$2.$3")
    pieces = df.select(F.col(id_col), F.posexplode(F.split(marked, MARK)).alias("pos", "piece"))
    piece = F.col("piece")
    for char, code in reversed(ESCAPES):
        piece = F.replace(piece, F.lit(code), F.lit(char))
    pieces = pieces.withColumn("piece", piece)
    pieces = _offsets(pieces, [id_col])
    blanks = F.lit(BLANKS)
    lead = F.length("piece") - F.length(F.ltrim(F.col("piece"), blanks))
    # as the pattern ^\s+|\s+$ would, without a search at every blank
    result = F.when(F.right("piece", F.lit(1)).isin(*LINE_ENDS), F.regexp_replace("piece", r"^\s+|\s+$", "")) \
        .otherwise(F.trim(F.col("piece"), blanks))
    w = Window.partitionBy(id_col).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    out = (pieces
           .withColumn("result", result)
           .withColumn("begin", (F.col("begin") + lead).cast("int"))
           .withColumn("sentence", (F.sum(F.when(F.col("result") != "", 1).otherwise(0)).over(w) - 1).cast("int"))
           .filter(F.col("result") != ""))
    return out.select(id_col, "sentence", "begin",
                      (F.col("begin") + F.length("result") - 1).cast("int").alias("end"), "result")


def tokenize(df: DataFrame, id_col: str, text_col: str, scope: str = "document",
             context_chars: str | None = None) -> DataFrame:
    """Tokens with offsets: (id, sentence, pos, begin, end, result).

    ``scope="document"`` tokenises the whole text (sentence is 0 for every
    token, as a document-scoped tokenizer reports).  ``scope="sentence"``
    first splits sentences and tokenises each, so no token crosses a sentence
    and ``pos`` restarts per sentence.  ``context_chars`` switches to
    whitespace tokens whose leading/trailing context characters are split off
    into their own tokens.
    """
    if scope == "document":
        src = df.select(F.col(id_col), F.lit(0).alias("sentence"), F.lit(0).alias("begin"),
                        F.col(text_col).alias("result"))
    elif scope == "sentence":
        src = split_sentences(df, id_col, text_col)
    else:
        raise ValueError(f"scope must be 'document' or 'sentence', not {scope!r}")
    return tokenize_sentences(src, id_col, context_chars)


def token_pattern(context_chars: str | None = None) -> str:
    """One token per match, with the whitespace before it: ``\\s*(?:token)``.

    Matches are contiguous (only whitespace lies between tokens and it is
    taken by the next match), so a token's end offset is the running sum of
    match lengths; no whitespace rows are exploded."""
    if context_chars:
        cls = "".join("\\" + c for c in context_chars)
        tok = rf"[^\s{cls}](?:\S*[^\s{cls}])?|[{cls}]"
    else:
        tok = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]"
    return rf"\s*(?:{tok})"


def tokenize_sentences(sentences: DataFrame, id_col: str, context_chars: str | None = None) -> DataFrame:
    """Tokens of already split sentences (id, sentence, begin, result).

    ``pos`` is the explode position itself, so the output stays ordered by
    (id, sentence, pos) for any later window on the same keys."""
    src = sentences.select(id_col, "sentence", F.col("begin").alias("base"), F.col("result").alias("__text"))
    pieces = src.select(id_col, "sentence", "base",
                        F.posexplode(F.regexp_extract_all("__text", F.lit(token_pattern(context_chars)), 0))
                        .alias("pos", "piece"))
    w = Window.partitionBy(id_col, "sentence").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    token = F.ltrim(F.col("piece"), F.lit(BLANKS))
    out = pieces.select(id_col, "sentence", "pos", "base", token.alias("result"),
                        F.sum(F.length("piece")).over(w).alias("__upto"))
    begin = (F.col("base") + F.col("__upto") - F.length("result")).cast("int")
    return out.select(id_col, F.col("sentence").cast("int").alias("sentence"), F.col("pos").cast("int").alias("pos"),
                      begin.alias("begin"), (begin + F.length("result") - 1).cast("int").alias("end"), "result")


def normalize(tokens: DataFrame, pattern: str = r"[^\p{L}]", lowercase: bool = False,
              col: str = "result", out_col: str = "normalized") -> DataFrame:
    """Strip characters matching ``pattern``; optionally lower-case; drop empties."""
    value = F.regexp_replace(F.col(col), pattern, "")
    if lowercase:
        value = F.lower(value)
    return tokens.withColumn(out_col, value).filter(F.col(out_col) != "")


def finish(df: DataFrame, cols: Sequence[str], as_array: bool = True, value_sep: str = "#",
           annotation_sep: str = "@", with_metadata: bool = False, clean: bool = True) -> DataFrame:
    """Annotation arrays -> plain values in ``finished_<col>``.

    Each element is its ``result``; with metadata, ``result`` then the
    metadata as ``key->value`` in key order, joined by ``value_sep``.  As a
    string, elements are joined by ``annotation_sep``.  ``clean`` drops the
    annotation inputs.
    """
    out = df
    for c in cols:
        if with_metadata:
            elem = F.transform(F.col(c), lambda a: F.concat_ws(
                value_sep, a["result"],
                F.array_join(F.transform(F.array_sort(F.map_entries(a["metadata"])),
                                         lambda e: F.concat(e["key"], F.lit("->"), e["value"])), value_sep)))
        else:
            elem = F.transform(F.col(c), lambda a: a["result"])
        out = out.withColumn(f"finished_{c}", elem if as_array else F.array_join(elem, annotation_sep))
    return out.drop(*cols) if clean else out
