"""Entity recognition by rules, IOB tagging and the chunk converter.

Offsets of regex hits: ``split`` on the pattern gives the gaps between hits
and ``regexp_extract_all`` the hits themselves (both scan left to right, non
overlapping), so hit i starts at ``sum(len(gap_j) + len(hit_j), j <= i) -
len(hit_i)``: a running sum over a per-document window.

Nothing here pairs rows: placing hits in sentences and tagging tokens from
spans are *sweeps* — spans and tokens are merged in offset order inside a
document and a window carries the last open span forward.  Every window is
partitioned by document, so they run inside the documents' one hash
partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The entity rules, in priority order (earlier wins a tie).
RULES = (
    ("EMAIL", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"),
    ("IP", r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}"),
    ("CARD", r"[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}"),
    ("KEY", r"[0-9a-f]{40}"),
    ("NAME", r"\p{Lu}\p{Ll}+ \p{Lu}\p{Ll}+"),
)
# Rules whose hits must not touch another letter or digit.
BORDERED = ("IP", "CARD", "KEY")
# The same language, scanned in linear time: a local part is tried once, at the
# start of its run (or where the last hit ended), and never given back.
LINEAR = {"EMAIL": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"}


def keep_first(rows: DataFrame, part: Sequence[str], order: Sequence[Column], begin: str, end: str) -> DataFrame:
    """The matches that do not overlap an earlier *kept* one, taken in ``order``
    (ascending columns that begin with ``begin``) inside ``part``.

    Matches are first cut into runs that overlap nothing outside themselves (one
    running maximum); a run is then folded as a sorted array that carries the end
    of the last kept match.  Runs are short where matches seldom overlap, and
    their group-by re-uses the partitioning of the window before it.
    """
    before = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    run = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    opens = F.coalesce(F.col(begin) > F.max(end).over(before), F.lit(True))
    runs = rows.withColumn("__opens", opens.cast("int")).withColumn("__run", F.sum("__opens").over(run))
    values = [c for c in rows.columns if c not in part]
    item = F.struct(*[o.alias(f"__o{i}") for i, o in enumerate(order)], *values)
    folded = runs.groupBy(*part, "__run").agg(F.sort_array(F.collect_list(item)).alias("__m"))
    first = F.get("__m", F.lit(0))
    start = F.struct(first[end].alias("last"), F.array(first).alias("kept"))
    kept = F.aggregate(
        F.slice("__m", 2, F.greatest(F.size("__m") - 1, F.lit(0))), start,
        lambda acc, x: F.when(x[begin] > acc["last"], F.struct(
            x[end].alias("last"), F.concat(acc["kept"], F.array(x)).alias("kept"))).otherwise(acc))["kept"]
    one = F.when(F.size("__m") == 1, F.col("__m")).otherwise(kept)
    return folded.select(*part, F.explode(one).alias("__k")).select(
        *[F.col(c) if c in part else F.col(f"__k.{c}") for c in rows.columns])


def rule_spans(docs: DataFrame, id_col: str, text_col: str,
               rules: Sequence[tuple[str, str]] = RULES, resolve: bool = True) -> DataFrame:
    """Regex hits as spans (id, begin, end, result, entity, priority).

    Hits of the ``BORDERED`` rules count only when no letter or digit touches
    them; an IP's parts are at most 255.  With ``resolve``, hits are taken from
    the left (ties: longer first, then rule priority), each unless it overlaps
    one taken before.
    """
    java = {name: LINEAR.get(name, pattern) for name, pattern in rules}
    hits = docs.select(F.col(id_col), F.col(text_col), *[
        F.regexp_extract_all(F.col(text_col), F.lit(java[name]), 0).alias(f"__h{prio}")
        for prio, (name, _) in enumerate(rules)])
    # The gaps (a second regex pass) are only computed for rules that hit.
    per_rule = F.array(*[
        F.struct(F.lit(name).alias("entity"), F.lit(prio).alias("priority"),
                 F.when(F.size(f"__h{prio}") > 0, F.split(F.col(text_col), java[name])).alias("gaps"),
                 F.col(f"__h{prio}").alias("hits"))
        for prio, (name, _) in enumerate(rules)])
    r = hits.select(F.col(id_col), F.explode(per_rule).alias("r")).select(id_col, "r.*")
    r = r.filter(F.size("hits") > 0)
    # each hit with the gap before it and the character on either side
    parts = F.transform("hits", lambda h, i: F.struct(
        F.get("gaps", i).alias("g"), h.alias("h"),
        F.right(F.concat(F.coalesce(F.get("hits", i - 1), F.lit("")), F.get("gaps", i)), F.lit(1)).alias("before"),
        F.left(F.concat(F.get("gaps", i + 1), F.coalesce(F.get("hits", i + 1), F.lit(""))), F.lit(1)).alias("after")))
    z = r.select(id_col, "entity", "priority", F.posexplode(parts).alias("i", "z"))
    w = (Window.partitionBy(id_col, "entity").orderBy("i")
         .rowsBetween(Window.unboundedPreceding, 0))
    hit = F.col("z.h")
    spans = z.select(
        id_col, "entity", "priority", "z.before", "z.after",
        (F.sum(F.length("z.g") + F.length(hit)).over(w) - F.length(hit)).cast("int").alias("begin"),
        hit.alias("result"))
    touched = F.col("before").rlike("[0-9A-Za-z]") | F.col("after").rlike("[0-9A-Za-z]")
    octets = F.transform(F.split("result", r"\."), lambda x: x.cast("int"))
    ok = (~F.col("entity").isin(*BORDERED) | ~touched) & (
        (F.col("entity") != "IP") | F.forall(octets, lambda x: x <= 255))
    spans = spans.filter(ok).withColumn("end", (F.col("begin") + F.length("result") - 1).cast("int"))
    spans = spans.select(id_col, "begin", "end", "result", "entity", "priority")
    if resolve:
        spans = keep_first(spans, [id_col], [F.col("begin"), -F.col("end"), F.col("priority")], "begin", "end")
    return spans


def assign_sentences(spans: DataFrame, sentences: DataFrame, id_col: str) -> DataFrame:
    """Add ``sentence``: the number of the last sentence starting at or before
    each span (a sweep over sentence starts and span starts)."""
    marks = sentences.select(id_col, "begin", F.lit(0).alias("__kind"), "sentence")
    rows = spans.withColumn("__kind", F.lit(1)).withColumn("sentence", F.lit(None).cast("int"))
    cols = spans.columns
    both = rows.unionByName(marks, allowMissingColumns=True)
    w = (Window.partitionBy(id_col).orderBy("begin", "__kind")
         .rowsBetween(Window.unboundedPreceding, 0))
    both = both.withColumn("sentence", F.coalesce(F.last("sentence", ignorenulls=True).over(w), F.lit(0)))
    return both.filter(F.col("__kind") == 1).select(*cols, "sentence")


def tag_from_spans(tokens: DataFrame, spans: DataFrame, id_col: str) -> DataFrame:
    """IOB tag per token from character spans: ``B-X`` for the token where a
    span of type X starts, ``I-X`` for tokens starting inside it, else ``O``."""
    cols = tokens.columns
    sp = spans.select(id_col, "begin", F.col("end").alias("__span_end"), F.col("entity").alias("__type"),
                      F.lit(0).alias("__kind"))
    tk = tokens.withColumn("__kind", F.lit(1))
    both = tk.unionByName(sp, allowMissingColumns=True)
    w = (Window.partitionBy(id_col).orderBy("begin", "__kind")
         .rowsBetween(Window.unboundedPreceding, 0))
    both = both.select(
        "*",
        F.last(F.when(F.col("__kind") == 0, F.col("begin")), ignorenulls=True).over(w).alias("__sb"),
        F.last("__span_end", ignorenulls=True).over(w).alias("__se"),
        F.last("__type", ignorenulls=True).over(w).alias("__st"))
    inside = F.col("__se").isNotNull() & (F.col("begin") <= F.col("__se"))
    tag = (F.when(inside & (F.col("begin") == F.col("__sb")), F.concat(F.lit("B-"), "__st"))
           .when(inside, F.concat(F.lit("I-"), "__st"))
           .otherwise(F.lit("O")))
    return both.filter(F.col("__kind") == 1).select(*cols, tag.alias("tag"))


def entity_chunks(tagged: DataFrame, docs: DataFrame, id_col: str, text_col: str,
                  tag_col: str = "tag", preserve_position: bool = True) -> DataFrame:
    """Merge consecutive tokens of one entity into chunks
    (id, begin, end, result, entity, sentence).

    A new chunk starts at a ``B-`` tag, after an ``O``, when the type changes
    or when the sentence changes (gaps-and-islands with a running sum).  The
    chunk text is the exact span of the document text.  With
    ``preserve_position=False`` begin/end are relative to the first token of
    the chunk's sentence instead of the document.
    """
    # Token order inside a document: by begin offset (the same order as
    # (sentence, pos)); a tagger sweep that sorted by begin leaves the rows in
    # this order, so the window needs no sort of its own.
    w = Window.partitionBy(id_col).orderBy("begin")
    typ = F.when(F.col(tag_col) == "O", F.lit(None)).otherwise(F.substring(F.col(tag_col), 3, 1 << 20))
    t = tagged.select(id_col, "sentence", "pos", "begin", "end", F.col(tag_col).alias("__tag"),
                      typ.alias("__type"))
    prev_type = F.lag("__type").over(w)
    prev_sent = F.lag("sentence").over(w)
    new = (F.col("__type").isNull() | F.col("__tag").startswith("B-") | prev_type.isNull()
           | (prev_type != F.col("__type")) | (prev_sent != F.col("sentence")))
    t = t.withColumn("__new", F.when(new, 1).otherwise(0))
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    t = t.select("*", F.sum("__new").over(run).alias("__island"),
                 F.last(F.when(F.col("__new") == 1, F.col("begin")), ignorenulls=True).over(run).alias("__start"))
    # Each island is read off its last row: no group-by (and no sort) needed.
    last = F.coalesce(F.lead("__island").over(w) != F.col("__island"), F.lit(True))
    t = t.withColumn("__last", F.col("__type").isNotNull() & last)
    if not preserve_position:
        # A sentence's smallest begin is where a run of its tokens starts: only these rows
        # and the chunks stay, so the tokens are tagged once and none is shuffled.
        t = t.withColumn("__first", F.coalesce(prev_sent != F.col("sentence"), F.lit(True)))
        t = t.filter((F.col("__last") | F.col("__first")) & F.col("sentence").isNotNull())
        t = t.withColumn("__sbeg", F.min("begin").over(Window.partitionBy(id_col, "sentence")))
    chunks = t.filter("__last").select(id_col, F.col("__start").alias("begin"), "end", F.col("__type").alias("entity"),
                                       "sentence", *([] if preserve_position else ["__sbeg"]))
    text = docs.select(F.col(id_col).alias("__doc"), F.col(text_col).alias("__text"))
    out = chunks.join(text, F.col(id_col) == F.col("__doc"))
    result = F.col("__text").substr(F.col("begin") + 1, F.col("end") - F.col("begin") + 1)
    if preserve_position:
        return out.select(id_col, "begin", "end", result.alias("result"), "entity", "sentence")
    return out.select(id_col, (F.col("begin") - F.col("__sbeg")).alias("begin"),
                      (F.col("end") - F.col("__sbeg")).alias("end"), result.alias("result"), "entity", "sentence")
