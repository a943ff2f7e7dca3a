"""Unsupervised keyword extraction in the manner of YAKE.

Follows Campos et al., "YAKE! Keyword extraction from single documents using
multiple local features", Information Sciences 509 (2020).  Per document d
and lower-cased word term t (a token with a letter):

    case   = max(TF_cap, TF_acro) / (1 + ln TF)
    pos    = ln(ln(3 + median sentence index of t))
    freq   = TF / (mean TF + stddev_pop TF)      over d's non-stopword terms
    rel    = 1 + (DL + DR) * TF / max TF         DL/DR = distinct left/right
                                                 neighbours / co-occurrences
    spread = SF / number of sentences of d
    S(t)   = rel * pos / (case + freq / rel + spread / rel)

Candidates are 1..max_n adjacent word tokens of one sentence (no punctuation
between them) that neither start nor end with a stopword, scored ``prod S / (TF(kw) * (1 + sum S))``;
lower is better.  Scores ``< threshold`` are kept and the best ``k`` per
document returned (ties by keyword).

Every window is partitioned by document (or document + term / sentence), so
after the documents are hash-partitioned once nothing here shuffles: the term
statistics are window aggregates over (doc, term), not a group-by joined back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Stopwords (common function words of the corpus languages).
STOPWORDS = tuple("""
a an and are as at be been but by for from had has have he her his i if in into is it its
me my no not of on or our she so than that the their them then there these they this to
was we were what when which who will with would you your
au aux avec ce ces dans de des du elle en est et il ils je la le les leur lui mais me ne
nous on ou par pas pour qu que qui sa se ses son sur ta te toi ton tu un une vous
als am an auch auf aus bei das dem den der des die doch du ein eine einem einen einer
er es für hat ich ihr im in ist mit nicht noch oder sie sind und von war wie wir zu
al con del el ella ellos es esta este la las lo los mas mi no para pero por que se sin
su sus un una y yo
""".split())


def keywords(tokens: DataFrame, id_col: str, min_n: int = 1, max_n: int = 3, k: int | None = 10,
             threshold: float | None = 0.6, stopwords=STOPWORDS, window: int = 1,
             _general_window: bool = False) -> DataFrame:
    """Keywords (id, keyword, score, n) from tokens (id, sentence, pos, result).

    ``window`` is the co-occurrence window: the up-to-``window`` adjacent
    words on each side (no punctuation in between) count as context for DL/DR.
    """
    stop = sorted(set(stopwords))
    # Word tokens only; token positions still count punctuation, so two words
    # are neighbours exactly when their positions differ by one.
    # The document's window asks for the order of the sentence window, which then needs no sort.
    whole = (Window.partitionBy(id_col).orderBy("sentence", "pos")
             .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    w = (tokens.select(id_col, "sentence", "pos", "result", (F.max("sentence").over(whole) + 1).alias("n_sent"))
         .filter(F.col("result").rlike(r"\p{L}"))
         .withColumn("term", F.lower("result")))
    ws = Window.partitionBy(id_col, "sentence").orderBy("pos")
    prev_pos, next_pos = F.lag("pos").over(ws), F.lead("pos").over(ws)
    if window > 1 or _general_window:
        # arrays of the adjacent context words on each side
        lefts = F.filter(F.array(*[
            F.when(F.lag("pos", j).over(ws) == F.col("pos") - j, F.lag("term", j).over(ws))
            for j in range(1, window + 1)]), lambda x: x.isNotNull())
        rights = F.filter(F.array(*[
            F.when(F.lead("pos", j).over(ws) == F.col("pos") + j, F.lead("term", j).over(ws))
            for j in range(1, window + 1)]), lambda x: x.isNotNull())
        ctx = [lefts.alias("__lefts"), rights.alias("__rights")]
    else:
        ctx = [F.when(prev_pos == F.col("pos") - 1, F.lag("term").over(ws)).alias("__left"),
               F.when(next_pos == F.col("pos") + 1, F.lead("term").over(ws)).alias("__right")]
    w = w.select(
        "*", *ctx,
        F.col("term").isin(stop).alias("__stop"),  # a hash-set lookup (InSet)
        # case flags here, so the token text is not carried through the term sort
        (F.col("result").rlike(r"^\p{Lu}") & prev_pos.isNotNull()).cast("int").alias("__cap"),
        ((F.length("result") > 1) & F.col("result").rlike(r"^\p{Lu}+$")).cast("int").alias("__acro"))
    w = w.drop("result")
    # Term statistics: one window per (doc, term) ordered by occurrence.  The
    # sentence frequency counts sentence changes, the median sentence index is
    # read at the middle row positions; the doc window below re-uses the sort.
    wt = Window.partitionBy(id_col, "term").orderBy("sentence", "pos")
    full = wt.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    w = w.select(
        "*",
        F.count(F.lit(1)).over(full).alias("tf"),
        F.sum("__cap").over(full).alias("tf_cap"),
        F.sum("__acro").over(full).alias("tf_acro"),
        *_context_counts(window > 1 or _general_window, full),
        (F.row_number().over(wt) - 1).alias("__rn"),
        F.coalesce((F.lag("sentence").over(wt) != F.col("sentence")).cast("int"), F.lit(1)).alias("__new_sent"))
    lo, hi = F.floor((F.col("tf") - 1) / 2), F.ceil((F.col("tf") - 1) / 2)
    mid = F.when((F.col("__rn") == lo) | (F.col("__rn") == hi), F.col("sentence").cast("double"))
    w = w.select("*", F.sum("__new_sent").over(full).alias("sf"),
                 (F.sum(mid).over(full) / F.when(lo == hi, 1).otherwise(2)).alias("med"))
    w = w.withColumn("__rep", F.col("__rn") == 0)
    wd = Window.partitionBy(id_col)
    rep_tf = F.when(F.col("__rep") & ~F.col("__stop"), F.col("tf"))
    w = w.select("*", F.avg(rep_tf).over(wd).alias("tf_mean"),
                 F.stddev_pop(rep_tf).over(wd).alias("tf_std"),
                 F.max(rep_tf).over(wd).alias("tf_max"))
    dl = F.when(F.col("dl_c") > 0, F.col("dl_n") / F.col("dl_c")).otherwise(F.lit(0.0))
    dr = F.when(F.col("dr_c") > 0, F.col("dr_n") / F.col("dr_c")).otherwise(F.lit(0.0))
    tf_max = F.coalesce(F.col("tf_max"), F.col("tf"))
    rel = 1 + (dl + dr) * F.col("tf") / tf_max
    case = F.greatest("tf_cap", "tf_acro") / (1 + F.log("tf"))
    posf = F.log(F.log(3 + F.col("med")))
    freq = F.col("tf") / (F.coalesce(F.col("tf_mean"), F.col("tf")) + F.coalesce(F.col("tf_std"), F.lit(0.0)))
    spread = F.col("sf") / F.col("n_sent")
    w = w.withColumn("__rel", rel)
    w = w.withColumn("s", F.col("__rel") * posf / (case + freq / F.col("__rel") + spread / F.col("__rel")))
    ws2 = Window.partitionBy(id_col, "sentence").orderBy("pos")
    leads = []
    for j in range(1, max_n):
        leads += [F.lead("term", j).over(ws2).alias(f"__t{j}"), F.lead("s", j).over(ws2).alias(f"__s{j}"),
                  F.lead("pos", j).over(ws2).alias(f"__p{j}"), F.lead("__stop", j).over(ws2).alias(f"__x{j}")]
    g = w.select(id_col, "sentence", "pos", "term", "s", "__stop", *leads)
    cands = []
    for n in range(min_n, max_n + 1):
        ok = ~F.col("__stop")
        for j in range(1, n):
            ok = ok & (F.col(f"__p{j}") == F.col("pos") + j)
        if n > 1:
            ok = ok & ~F.col(f"__x{n - 1}")
        terms = [F.col("term")] + [F.col(f"__t{j}") for j in range(1, n)]
        scores = [F.col("s")] + [F.col(f"__s{j}") for j in range(1, n)]
        prod, tot = scores[0], scores[0]
        for s in scores[1:]:
            prod, tot = prod * s, tot + s
        cands.append(F.when(ok, F.struct(F.concat_ws(" ", *terms).alias("keyword"), F.lit(n).alias("n"),
                                         prod.alias("prod"), tot.alias("tot"))))
    c = g.select(id_col, F.explode(F.filter(F.array(*cands), lambda x: x.isNotNull())).alias("c"))
    kw = (c.groupBy(id_col, F.col("c.keyword").alias("keyword"))
          .agg(F.count(F.lit(1)).alias("tf_kw"), F.min("c.n").alias("n"),
               F.min("c.prod").alias("prod"), F.min("c.tot").alias("tot")))
    kw = kw.select(id_col, "keyword", F.col("n").cast("int").alias("n"),
                   (F.col("prod") / (F.col("tf_kw") * (1 + F.col("tot")))).alias("score"))
    if threshold is not None:
        kw = kw.filter(F.col("score") < threshold)
    if k is not None:
        kw = top_k(kw, id_col, [rank_key("score"), F.col("keyword")], k)
    return kw


def _context_counts(arrays: bool, full) -> list:
    """dl_n/dl_c/dr_n/dr_c: distinct context terms and co-occurrences."""
    if not arrays:
        return [F.size(F.collect_set("__left").over(full)).alias("dl_n"),
                F.count("__left").over(full).alias("dl_c"),
                F.size(F.collect_set("__right").over(full)).alias("dr_n"),
                F.count("__right").over(full).alias("dr_c")]
    return [F.size(F.array_distinct(F.flatten(F.collect_list("__lefts").over(full)))).alias("dl_n"),
            F.sum(F.size("__lefts")).over(full).alias("dl_c"),
            F.size(F.array_distinct(F.flatten(F.collect_list("__rights").over(full)))).alias("dr_n"),
            F.sum(F.size("__rights")).over(full).alias("dr_c")]


def rank_key(score) -> "F.Column":
    """Ordering key for scores: equal to 6 significant digits counts as a tie
    (then the keyword decides), so engines that differ in the last bits of a
    float rank alike."""
    return F.round(F.log(F.col(score) if isinstance(score, str) else score), 6)


def distinct_keywords(kw: DataFrame, id_col: str, k: int | None = 10, similarity: float = 0.9) -> DataFrame:
    """The last step of the published method: of nearly equal keywords of a document only
    the best stays.  Keywords are taken best first, each unless its similarity
    ``1 - edit distance / longer length`` to one taken before is above
    ``similarity``, until ``k`` are taken.

    One group-by per document; the fold over its sorted keywords carries what it has
    taken, and stops comparing once that is ``k``.
    """
    item = F.struct(rank_key("score").alias("r"), F.col("keyword"), F.col("n"), F.col("score"))
    packed = kw.groupBy(id_col).agg(F.sort_array(F.collect_list(item)).alias("__k"))
    kind = packed.schema["__k"].dataType
    near = lambda a, b: (1 - F.levenshtein(a["keyword"], b["keyword"])
                         / F.greatest(F.length(a["keyword"]), F.length(b["keyword"]))) > F.lit(similarity)
    full = (lambda taken: F.size(taken) >= k) if k is not None else (lambda taken: F.lit(False))
    taken = F.aggregate("__k", F.array().cast(kind), lambda acc, x: F.when(
        full(acc) | F.exists(acc, lambda a: near(a, x)), acc).otherwise(F.concat(acc, F.array(x))))
    return packed.select(id_col, F.explode(taken).alias("__t")).select(id_col, "__t.keyword", "__t.n", "__t.score")


def top_k(df: DataFrame, part: str, order: list, k: int) -> DataFrame:
    """Best ``k`` rows per ``part`` by ascending ``order`` (row_number <= k)."""
    w = Window.partitionBy(part).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= k).drop("__rn")


def best_keywords(df: DataFrame, n: int = 5, score: str = "score", keyword: str = "keyword") -> DataFrame:
    """Corpus-wide lowest ``n`` scores; the score is compared as a number even
    when it arrives as a metadata string."""
    return df.orderBy(rank_key(F.col(score).cast("double")), F.col(keyword)).limit(n)


def keyword_annotations(kw: DataFrame, id_col: str, out_col: str = "keywords") -> DataFrame:
    """Keywords folded into one annotation-like array per document (best
    first), the score kept as ``metadata.score`` text."""
    elem = F.struct(F.col("score").alias("s"), F.col("keyword").alias("k"))
    packed = kw.groupBy(id_col).agg(F.sort_array(F.collect_list(elem)).alias("__a"))
    return packed.select(id_col, F.transform("__a", lambda a: F.struct(
        F.lit("keyword").alias("annotatorType"), a["k"].alias("result"),
        F.create_map(F.lit("score"), a["s"].cast("string")).alias("metadata"))).alias(out_col))


def keyword_pairs(df: DataFrame, col: str, id_col: str) -> DataFrame:
    """(id, result, metadata, score) rows from a keyword annotation column via
    ``explode(arrays_zip(col.result, col.metadata))``; score cast to double."""
    res = df.select(id_col, F.col(f"{col}.result").alias("result"), F.col(f"{col}.metadata").alias("metadata"))
    z = res.select(id_col, F.explode(F.arrays_zip("result", "metadata")).alias("p"))
    return z.select(id_col, F.col("p.result").alias("result"), F.col("p.metadata").alias("metadata"),
                    F.col("p.metadata").getItem("score").cast("double").alias("score"))
