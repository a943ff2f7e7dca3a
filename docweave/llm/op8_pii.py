"""Personal data: fixed-format spans plus bootstrapped contextual extraction.

Every text is scanned once for the base formats and for identifier-like tokens
with the words around them.  Base spans are the seeds: the contexts they stand
in are candidate patterns, and identifier-like tokens seen in the same
contexts are candidate instances.  Confidence moves back and forth over the
pattern-instance graph by Spark joins and sums; tokens that trusted patterns
vouch for become spans of kind ``id``.

Patterns are lexical: the word before, with digits folded, together with the
word after or the word before that.  A pattern counts only with
``MIN_SEEDS`` different seed values and when most identifier-like tokens it
meets are personal data.

Defined cases: a null or empty text has no spans; repeated rows and ids are
scanned one by one; values are compared as written, so ties cannot occur; an
empty table gives no rows.
"""

from __future__ import annotations

import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm.common import Scratch, from_text

KINDS = ("email", "ip", "card", "phone")
#: Different seed values and confidence a pattern needs, and an instance's.
MIN_SEEDS, PATTERN_CONFIDENCE, INSTANCE_CONFIDENCE = 5, 0.8, 0.9
ROUNDS = 3
#: Patterns up to this many are broadcast to the final scan; more are shuffled.
BROADCAST_PATTERNS = 50_000

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a match can only start where a run of digits starts
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+(?<=[0-9])")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Tokens worth asking about: six characters or more, those with a digit.
IDENTIFIER = re.compile(r"[A-Za-z0-9][A-Za-z0-9@._:/+=#-]{4,}[A-Za-z0-9]")
DIGIT = re.compile("[0-9]").search

TAG = {"email": "<EMAIL>", "ip": "<IP>", "card": "<CARD>", "phone": "<PHONE>", "id": "<ID>"}


def emails(text: str):
    """Leftmost matches, found at their @: the local part is the run before it
    that no earlier match has taken."""
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        after = at + 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            yield start, m.end()
            end = after = m.end()
        else:
            end = after  # an @ ends every run before it
        at = text.find("@", after)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, rank of the kind, end), sorted."""
    out = [(a, 0, b) for a, b in emails(text)]
    for m in IP.finditer(text):
        # int() refuses very long numbers, leading zeros included
        parts = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text):
        if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def _fold(word: str) -> str:
    return re.sub("[0-9]+", "0", word.lower()).strip(".,;:!?\"'()")


def _contexts(text: str, start: int, end: int) -> list[str]:
    before = WORD.findall(text[max(0, start - 80):start])
    after = WORD.findall(text[end:end + 40])
    left = _fold(before[-1]) if before else "^"
    left2 = _fold(before[-2]) if len(before) > 1 else "^"
    right = _fold(after[0]) if after else "$"
    return [f"{left2} {left} _", f"{left} _ {right}"]


def scan(text: str):
    """Base spans, and (start, end, seed?, contexts) of identifier-like tokens."""
    spans = base_spans(text)
    if not spans and not DIGIT(text):
        return spans, []
    found = [(a, b, True, _contexts(text, a, b)) for a, _, b in spans]
    taken = sorted((a, b) for a, _, b in spans)
    i = 0
    for m in IDENTIFIER.finditer(text):
        if not DIGIT(m.group()):
            continue
        while i < len(taken) and taken[i][1] <= m.start():
            i += 1
        if i < len(taken) and taken[i][0] < m.end():
            continue
        found.append((m.start(), m.end(), False, _contexts(text, m.start(), m.end())))
    return spans, found


SPANS = pa.list_(pa.struct([("start", pa.int32()), ("rank", pa.int32()), ("stop", pa.int32())]))
TOKENS = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("seed", pa.bool_()),
                             ("value", pa.string()), ("contexts", pa.list_(pa.string()))]))
SCAN = ("spans array<struct<start:int,rank:int,stop:int>>, "
        "tokens array<struct<start:int,stop:int,seed:boolean,value:string,contexts:array<string>>>")


def scan_documents(docs: DataFrame, text_col: str, keep: tuple[str, ...]) -> DataFrame:
    def run(texts):
        spans, tokens = [], []
        for t in texts:
            s, found = scan(t or "")
            spans.append([{"start": a, "rank": k, "stop": b} for a, k, b in s])
            tokens.append([{"start": a, "stop": b, "seed": seed, "value": t[a:b], "contexts": c}
                           for a, b, seed, c in found])
        return [pa.array(spans, SPANS), pa.array(tokens, TOKENS)]

    return from_text(docs, text_col, keep, SCAN, run)


def score_patterns(tokens: DataFrame, scratch: Scratch, rounds: int = ROUNDS) -> DataFrame:
    """Trusted patterns: pattern, confidence.

    ``tokens``: value, seed, contexts.  Edges join a value with a context; a
    value's belief is 1 for seeds, else the noisy-or of its trusted patterns; a
    pattern's confidence is the mean belief of the values it meets.
    """
    edges = scratch.save(
        tokens.select("value", "seed", F.explode("contexts").alias("pattern"))
        .groupBy("pattern", "value").agg(F.max("seed").alias("seed")), "edges")
    seeded = (edges.groupBy("pattern").agg(F.sum(F.col("seed").cast("int")).alias("seeds"))
              .filter(F.col("seeds") >= MIN_SEEDS))
    # only patterns with enough seeds can ever be trusted
    edges = scratch.save(edges.join(seeded.select("pattern"), "pattern"), "graph")
    beliefs = edges.groupBy("value").agg(F.max("seed").cast("double").alias("belief"))
    patterns = None
    for i in range(rounds):
        patterns = scratch.save(
            edges.join(beliefs, "value").groupBy("pattern").agg(F.avg("belief").alias("confidence"))
            .filter(F.col("confidence") >= PATTERN_CONFIDENCE), f"patterns{i}")
        vouched = edges.join(patterns, "pattern", "left").groupBy("value").agg(
            F.max("seed").alias("seed"),
            F.sum(F.log(1.0 - F.least(F.coalesce("confidence", F.lit(0.0)), F.lit(0.999)))).alias("doubt"))
        beliefs = scratch.save(vouched.select(
            "value", F.when(F.col("seed"), 1.0).otherwise(1 - F.exp("doubt")).alias("belief")), f"beliefs{i}")
    return patterns


def find_personal_data(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep columns and ``spans``, an array of (start, rank, stop) in which rank
    0 to 3 are the base kinds and 4 an identifier the patterns found."""
    scratch = Scratch(docs.sparkSession, "pii")
    rows = scratch.save(scan_documents(docs, text_col, keep)
                        .withColumn("__row", F.monotonically_increasing_id()), "scan")
    tokens = rows.select(F.explode("tokens").alias("t")).select("t.value", "t.seed", "t.contexts")
    patterns = score_patterns(tokens, scratch)
    asked = rows.select("__row", F.explode("tokens").alias("t")).filter(~F.col("t.seed")) \
        .select("__row", "t.start", "t.stop", F.explode("t.contexts").alias("pattern"))
    small = patterns.limit(BROADCAST_PATTERNS + 1).count() <= BROADCAST_PATTERNS
    doubt = F.sum(F.log(1.0 - F.least("confidence", F.lit(0.999))))
    found = (asked.join(F.broadcast(patterns) if small else patterns, "pattern")
             .groupBy("__row", "start", "stop").agg((1 - F.exp(doubt)).alias("belief"))
             .filter(F.col("belief") >= INSTANCE_CONFIDENCE)
             .groupBy("__row").agg(F.collect_list(F.struct(
                 "start", F.lit(len(KINDS)).alias("rank"), "stop")).alias("more")))
    none = F.array().cast("array<struct<start:int,rank:int,stop:int>>")
    return rows.drop("tokens").join(found, "__row", "left").select(
        *keep, F.array_sort(F.concat("spans", F.coalesce("more", none))).alias("spans"))


def spans_text(spans):
    """kind:start:end of an array of spans, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in (*KINDS, "id")])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["rank"] + 1), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents with every span replaced by its kind's mark.  Of spans
    that overlap, the earlier keeps its mark and the rest of the later goes."""
    spans = find_personal_data(docs.select(F.struct(*docs.columns).alias("__doc"), F.col(text_col).alias("__text")),
                               "__text", ("__doc",))
    out_schema = docs.schema
    marks = [TAG[k] for k in (*KINDS, "id")]

    @F.pandas_udf("string")
    def replace(texts: pd.Series, found: pd.Series) -> pd.Series:
        out = []
        for text, items in zip(texts, found):
            if items is None or not len(items):
                out.append(text)
                continue
            parts, end = [], 0
            for s in items:
                if s["start"] >= end:
                    parts += [text[end:s["start"]], marks[s["rank"]]]
                end = max(end, s["stop"])
            out.append("".join(parts) + text[end:])
        return pd.Series(out)

    done = spans.withColumn("__new", replace(F.col(f"__doc.{text_col}"), "spans"))
    return done.select(*[F.col("__new").alias(c) if c == text_col else F.col(f"__doc.{c}")
                         for c in out_schema.names])


def digest_columns(found: DataFrame) -> DataFrame:
    """The contract's columns from ``find_personal_data``'s rows."""
    base = F.filter("spans", lambda s: s["rank"] < len(KINDS))

    def of_kind(k: int):  # a second parameter of the lambda, even with a default, would be the element's index
        return F.size(F.filter("spans", lambda s: s["rank"] == k)).cast("long")

    counts = [of_kind(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(spans_text(base), 256).alias("base_sha256"),
                        spans_text(F.col("spans")).alias("spans"))
