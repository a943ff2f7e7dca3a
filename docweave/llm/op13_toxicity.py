"""Toxicity: a learned lexicon, misspellings by Levenshtein automata, context windows.

Lexicon: words and word beginnings (stems) whose documents are toxic far more
often than others, by counts over the labelled documents.  Words of a text are run
through the automaton of the lexicon's trie (``levenshtein``): a word within
the allowed edits of a term is a misspelling of it, unless the labelled clean
documents use it as a word of their own.  Every find is weighed by its window of
words: inside quotation marks or beside a reporting word it is likely quoted, beside
an address it is likelier abuse.  Sums of the weighed finds are the features of
a logistic regression with coefficients of at least 0.

A labelled document's own counts are taken out of the lexicon's when its features
are made for the fit, so the fit sees terms as a new document would; of near
copies (one of ``SKETCH`` minima of their word-window hashes shared) only the smallest
id is learned from.  ``LEARN_ROWS`` bounds the labelled documents that are learned
from (by hash of the id), ``MAX_TERMS`` and ``MAX_ORDINARY`` the tables that reach
the driver.  Scores come from the text alone.

Defined cases: a null or empty text has no finds and gets the score of such texts;
a document without an id is scored and never learned from; repeated labels of a
document count as their mean; without labels of a kind every score is the share of
the other, or 0.5; whole texts of any length are read; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Matrices
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.llm.common import Scratch, from_text
from docweave.llm.levenshtein import TrieAutomaton

#: Labelled documents that are learned from, at most (about).
LEARN_ROWS = 50_000
#: Terms of the lexicon, and ordinary words near one of them.
MAX_TERMS, MAX_ORDINARY = 20_000, 100_000
#: A term: toxic documents, log odds against other documents, likelihood ratio (and at least
#: twice the logarithm of the number of words tried, so that chance makes few terms).
MIN_DOCS, MIN_ODDS, MIN_G2 = 3, 1.5, 12.0
STEMS = (4, 5, 6)
SKETCH, SHINGLE = 4, 5
#: Words on either side that are a find's context, and what it makes of a find.
WINDOW = 6
QUOTED, REPORTED, ADDRESSED, EDIT = 0.4, 0.6, 1.25, 0.5
RIDGE = 0.003
#: Distinct words remembered in a task (they only decide how often one is looked up again).
KNOWN_WORDS = 200_000

# Quotation marks, words that report speech, words that address somebody.
MARKS = "\"'“”„«»‘’‚‹›"
REPORTING = frozenset("""said says wrote writes called calls quoted quote quoting word term insult
dit écrit appelle appelé mot terme insulte sagte sagt schrieb nannte nennt wort begriff beleidigung
dijo dice escribió llamó llama palabra término insulto""".split())
ADDRESS = frozenset("you your you're u ur tu toi vous ton votre du dich dein euch ihr tú usted ustedes eres".split())

_EDGES = MARKS + ".,;:!?()[]{}<>|*#&%$+-=/\\_~`"
FEATURES = ("exact", "misspelt", "stems", "largest", "kinds", "density")


def plain(word: str) -> str:
    return word.strip(_EDGES)


def sketch(words: list[str]) -> list[int]:
    """Minima of ``SKETCH`` hashes of the five-word windows (of all words, if fewer)."""
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = max(1, len(h) - SHINGLE + 1)
    windows = np.zeros(n, np.uint64)
    for i in range(min(SHINGLE, len(h))):
        windows = (windows ^ h[i:n + i]) * np.uint64(0x9E3779B97F4A7C15)
        windows ^= windows >> np.uint64(31)
    out = []
    for m in (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)[:SKETCH]:
        mixed = (windows ^ (windows >> np.uint64(29))) * np.uint64(m)
        out.append(int((mixed ^ (mixed >> np.uint64(32))).min() >> np.uint64(1)))
    return out


def learnable(docs: DataFrame, known: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id, y and body of the labelled documents that are learned from."""
    labelled = docs.join(F.broadcast(known), F.col("doc_id") == F.col("__id")).drop("__id")

    def run(texts):
        return [pa.array([sketch((t or "").lower().split()) if t and t.strip() else [] for t in texts],
                         pa.list_(pa.int64()))]

    sketches = scratch.save(from_text(labelled, "__body", ("doc_id",), "s array<long>", run), "sketches")
    slots = sketches.select("doc_id", F.posexplode("s").alias("slot", "value"))
    firsts = slots.groupBy("slot", "value").agg(F.min("doc_id").alias("first"))
    copies = (slots.join(firsts, ["slot", "value"]).filter("doc_id <> first").select("doc_id").distinct())
    keep = scratch.save(known.join(copies, known["__id"] == copies["doc_id"], "left_anti"), "learned")
    return docs.join(F.broadcast(keep), F.col("doc_id") == F.col("__id")).select("doc_id", "y", "__body")


def term_counts(learned: DataFrame) -> DataFrame:
    """key, a and b: toxic and other documents with a word, or with a word of that beginning (``stem*``)."""

    def run(batches):
        counts: dict[str, list[float]] = {}

        def emit():
            return pd.DataFrame({"key": list(counts), "a": [v[0] for v in counts.values()],
                                 "b": [v[1] for v in counts.values()]})

        for batch in batches:
            for y, text in zip(batch["y"], batch["__body"]):
                words = {plain(w) for w in (text or "").lower().split()} - {""}
                for key in words | {w[:k] + "*" for w in words for k in STEMS if len(w) >= k}:
                    v = counts.setdefault(key, [0.0, 0.0])
                    v[0] += y
                    v[1] += 1 - y
                if len(counts) > KNOWN_WORDS:
                    yield emit()
                    counts.clear()
        yield emit()

    return (learned.select("y", "__body").mapInPandas(run, "key string, a double, b double")
            .groupBy("key").agg(F.sum("a").alias("a"), F.sum("b").alias("b")))


def evidence(a: float, b: float, toxic: float, other: float, min_g2: float = MIN_G2) -> float:
    """Log odds of a term, 0 if its counts do not make it one."""
    if a < MIN_DOCS:
        return 0.0
    odds = math.log((a + 0.5) / (toxic + 1)) - math.log((b + 0.5) / (other + 1))
    p = toxic / (toxic + other)
    g2 = 2 * (a * math.log(a / ((a + b) * p)) + (b * math.log(b / ((a + b) * (1 - p))) if b else 0))
    return odds if odds >= MIN_ODDS and g2 >= min_g2 else 0.0


def _evidence_sql(b: str, toxic: float, other: float) -> tuple[Column, Column]:
    """Log odds and likelihood ratio of the columns ``a`` and ``b``."""
    p = toxic / (toxic + other)
    odds = f"ln((a + 0.5) / {toxic + 1}) - ln(({b} + 0.5) / {other + 1})"
    g2 = f"2 * (a * ln(a / ((a + {b}) * {p})) + if({b} > 0, {b} * ln({b} / ((a + {b}) * {1 - p})), 0))"
    return F.expr(odds), F.expr(g2)


class Lexicon:
    """Terms with their counts, and the words that are not misspellings of them."""

    def __init__(self, terms: dict[str, tuple[float, float]], ordinary: dict[str, float], toxic: float, other: float,
                 min_g2: float = MIN_G2):
        self.keys = sorted(terms)
        self.counts = [terms[k] for k in self.keys]
        self.number = {k: i for i, k in enumerate(self.keys)}
        self.ordinary, self.toxic, self.other, self.min_g2 = ordinary, toxic, other, min_g2

    def automaton(self) -> TrieAutomaton:
        return TrieAutomaton(k for k in self.keys if not k.endswith("*"))

    def weight(self, term: int, y: float | None = None) -> float:
        """Weight of a term; with ``y``, as if a document of that label had not been counted."""
        a, b = self.counts[term]
        if y is not None:
            a, b = a - y, b - (1 - y)
        return evidence(a, max(b, 0.0), self.toxic, self.other, self.min_g2)


def fit_lexicon(learned: DataFrame, scratch: Scratch, toxic: float, other: float) -> Lexicon:
    counts = scratch.save(term_counts(learned), "counts")
    # with one clean document less, as the lexicon is also asked without one
    odds, g2 = _evidence_sql("greatest(b - 1, 0)", toxic, other)
    tried = counts.filter(F.col("a") >= MIN_DOCS)
    min_g2 = max(MIN_G2, 2 * math.log(max(tried.count(), 1)))
    terms = (tried.withColumn("g2", g2).withColumn("odds", odds)
             .filter((F.col("odds") >= MIN_ODDS) & (F.col("g2") >= min_g2))
             .orderBy(F.desc("g2"), "key").limit(MAX_TERMS).collect())
    lexicon = Lexicon({r["key"]: (r["a"], r["b"]) for r in terms}, {}, toxic, other, min_g2)

    def near(batches):
        automaton = lexicon.automaton()
        for batch in batches:
            hit = [not k.endswith("*") and k not in lexicon.number and automaton.nearest(k) is not None
                   for k in batch["key"]]
            yield batch[hit]

    ordinary = (counts.filter("b >= 1").select("key", "b").mapInPandas(near, "key string, b double")
                .orderBy(F.desc("b"), "key").limit(MAX_ORDINARY).collect())
    lexicon.ordinary = {r["key"]: r["b"] for r in ordinary}
    scratch.drop("counts")
    return lexicon


def context(words: list[str], i: int) -> float:
    """What the window around word ``i`` makes of a find there."""
    lo, hi = max(0, i - WINDOW), min(len(words), i + WINDOW + 1)
    opened = closed = False
    for j in range(i, lo - 1, -1):
        if j < i and words[j][-1] in MARKS:
            break
        if words[j][0] in MARKS:
            opened = True
            break
    for j in range(i, hi):
        if j > i and words[j][0] in MARKS:
            break
        if words[j].rstrip(".,;:!?")[-1:] in MARKS and words[j].rstrip(".,;:!?"):
            closed = True
            break
    around = {plain(w) for w in words[lo:i]} | {plain(w) for w in words[i + 1:hi]}
    factor = QUOTED if opened and closed else 1.0
    if around & REPORTING:
        factor *= REPORTED
    elif around & ADDRESS:
        factor *= ADDRESSED
    return factor


class Finder:
    """Finds of a text: (term, edits, whether an ordinary word once, factor, occurrences)."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon, self.automaton = lexicon, lexicon.automaton()
        self.known: dict[str, tuple[tuple[int, int, float], ...]] = {}

    def look_up(self, word: str) -> tuple[tuple[int, int, float], ...]:
        lex, out, w = self.lexicon, [], plain(word)
        if w in lex.number:
            out.append((lex.number[w], 0, 0.0))
        else:
            clean = lex.ordinary.get(w, 0.0)
            # seen in two clean documents: a word of its own, whoever's counts are taken out
            found = self.automaton.nearest(w) if w and clean < 2 else None
            if found:
                out.append((lex.number[found[0]], found[1], clean))
        for k in STEMS:
            if len(w) >= k and w[:k] + "*" in lex.number:
                out.append((lex.number[w[:k] + "*"], 0, -1.0))
        return tuple(out)

    def __call__(self, text: str | None) -> tuple[int, list[dict]]:
        words = (text or "").lower().split()
        known, hits = self.known, []
        for i, w in enumerate(words):
            found = known.get(w)
            if found is None:
                if len(known) >= KNOWN_WORDS:
                    known.clear()
                found = known[w] = self.look_up(w)
            if found:
                hits.append((i, found))
        sums: dict[tuple, int] = {}
        for i, found in hits:
            factor = context(words, i)
            for f in found:
                key = (*f, factor)
                sums[key] = sums.get(key, 0) + 1
        return len(words), [{"t": t, "e": e, "clean": c, "f": f, "n": n} for (t, e, c, f), n in sorted(sums.items())]


def find_terms(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """doc_id, n_words and the finds of every document."""
    finds = pa.list_(pa.struct([("t", pa.int32()), ("e", pa.int32()), ("clean", pa.float64()), ("f", pa.float64()),
                                ("n", pa.int64())]))
    state: list[Finder] = []

    def run(texts):
        if not state:
            state.append(Finder(lexicon))
        out = [state[0](t) for t in texts]
        return [pa.array([n for n, _ in out], pa.int64()), pa.array([f for _, f in out], finds)]

    return from_text(docs, "__body", ("doc_id",),
                     "n_words long, finds array<struct<t:int,e:int,clean:double,f:double,n:long>>", run)


def feature_row(lexicon: Lexicon, n_words: int, finds, y: float | None = None) -> list[float]:
    exact = misspelt = stems = largest = 0.0
    kinds: dict[int, float] = {}
    for t, e, clean, f, n in ((x["t"], x["e"], x["clean"], x["f"], x["n"]) for x in finds):
        if e and clean - (1 - y if y is not None else 0) >= 1:
            continue  # an ordinary word near a term
        w = lexicon.weight(t, None if e else y) * f * EDIT ** e
        if not w:
            continue
        if clean < 0:
            stems += w * n
        elif e:
            misspelt += w * n
        else:
            exact += w * n
            largest = max(largest, w)
            kinds[t] = max(kinds.get(t, 0.0), w)
    return [math.log1p(exact), math.log1p(misspelt), math.log1p(stems), largest, math.log1p(sum(kinds.values())),
            math.log1p(100 * (exact + misspelt + stems) / (n_words + 20))]


def score_documents(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                    label_col: str = "toxic", learn: Column | None = None, learn_rows: int = LEARN_ROWS) -> DataFrame:
    """doc_id and score of every document.  ``labels``: id_col and label_col;
    ``learn`` says which label rows may be learned from."""
    scratch = Scratch(docs.sparkSession, "toxicity")
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("__body"))
    known = labels.filter(learn) if learn is not None else labels
    known = (known.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).cast("long").alias("__id")).agg(F.avg(label_col).cast("double").alias("y")))
    total = known.count()
    if total > learn_rows:
        known = known.filter(F.pmod(F.xxhash64("__id"), F.lit(1_000_000)) < int(1_000_000 * learn_rows / total))
    known = scratch.save(known, "labels")
    learned = learnable(docs, known, scratch)
    sums = docs.sparkSession.read.parquet(scratch.path("learned")).agg(F.sum("y"), F.count(F.lit(1))).first()
    toxic, n = float(sums[0] or 0.0), float(sums[1])
    if not 0 < toxic < n:
        return docs.select("doc_id", F.lit(toxic / n if n else 0.5).alias("score"))
    lexicon = fit_lexicon(learned, scratch, toxic, n - toxic)
    found = scratch.save(find_terms(docs, lexicon), "finds")

    def train_rows(batches):
        for b in batches:
            x = [feature_row(lexicon, n, f, y) for n, f, y in zip(b["n_words"], b["finds"], b["y"])]
            yield pd.DataFrame({"x": x, "y": (b["y"] > 0.5).astype(float)})

    keep = docs.sparkSession.read.parquet(scratch.path("learned"))
    rows = found.join(F.broadcast(keep), F.col("doc_id") == F.col("__id")).select("n_words", "finds", "y")
    train = scratch.save(rows.mapInPandas(train_rows, "x array<double>, y double"), "train")
    k = len(FEATURES)
    kinds = train.agg(F.min("y"), F.max("y")).first()
    if kinds[0] == kinds[1]:
        return docs.select("doc_id", F.lit(toxic / n).alias("score"))
    model = LogisticRegression(featuresCol="v", labelCol="y", regParam=RIDGE, maxIter=100,
                               lowerBoundsOnCoefficients=Matrices.dense(1, k, [0.0] * k)) \
        .fit(train.select(array_to_vector("x").alias("v"), "y"))
    beta, constant = model.coefficients.toArray(), float(model.intercept)

    def score(batches):
        for b in batches:
            x = np.array([feature_row(lexicon, n, f) for n, f in zip(b["n_words"], b["finds"])]).reshape(len(b), k)
            yield pd.DataFrame({"doc_id": b["doc_id"], "score": 1 / (1 + np.exp(-(x @ beta + constant)))})

    return found.mapInPandas(score, "doc_id long, score double")
