"""Quality rules with a robust multivariate outlier test per language and source.

A minimum-covariance-determinant estimate of each (language, source) group is
found by concentration steps: from medians and deviations, the rows within the
group's ``H`` quantile of squared Mahalanobis distance give the next mean and
covariance.  Each step is one aggregation of sums with map-side combining over
all documents; only one row per group is ever joined back.

Defined cases: a null text has no words and fails the base rules; null
language or source is a group of its own; sources with fewer than ``MIN_ROWS``
rows of a language are one group of that language, and such languages one
group; every estimate leans on its language and on the whole table by
``PRIOR_ROWS`` pseudo-rows; repeated rows count as often as they occur; an
empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave.llm import textstats
from docweave.llm.common import Scratch, from_text

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Share of a group's rows that the estimate rests on, and number of steps.
H, STEPS = 0.75, 3
MIN_ROWS, PRIOR_ROWS = 200, 20.0
#: Upper tail probability of a chi-squared distance at which a row is rejected.
TAIL = 1e-5
# The statistics in use and their least standard deviations: differences under
# these say nothing about quality, whatever a group's spread.  A square root of
# a share of n words or lines varies by 1 / (2 sqrt(n)) besides, so a document's
# own n widens its group's covariance (repeated words come by whole lines).
USED = ("symbols", "word_length", "adjacent", "repeats", "upper", "digits", "dup_lines", "long_words")
FLOOR = np.array([0.10, 0.08, 0.04, 0.05, 0.05, 0.05, 0.05, 0.05])
BY_WORDS = np.isin(USED, ("digits", "long_words")).astype(float)
BY_LINES = np.isin(USED, ("repeats", "dup_lines")).astype(float)
INDEX = [textstats.FEATURES.index(c) for c in USED]
P = len(USED)
#: Estimates of up to this many groups are broadcast; more are shuffled.
BROADCAST_GROUPS = 20_000
KEYS = ["__lang", "__source"]


def chi2_cdf(x: float, k: int) -> float:
    """Lower regularised gamma function, by its series."""
    a, t = k / 2, x / 2
    if t <= 0:
        return 0.0
    term = total = 1 / a
    i = 0
    while term > total * 1e-17:
        i += 1
        term *= t / (a + i)
        total += term
    return min(1.0, total * math.exp(a * math.log(t) - t - math.lgamma(a)))


def chi2_upper(tail: float, k: int) -> float:
    """x with P(X > x) = tail, by bisection on the continued upper tail."""
    lo, hi = 0.0, 10.0 * k + 400.0

    def upper(x):
        # Lentz's continued fraction for the upper regularised gamma function
        a, t = k / 2, x / 2
        if t < a + 1:
            return 1 - chi2_cdf(x, k)
        b = t + 1 - a
        c, d = 1e300, 1 / b
        h = d
        for i in range(1, 500):
            an = -i * (i - a)
            b += 2
            d = 1 / (an * d + b)
            c = b + an / c
            h *= d * c
            if abs(d * c - 1) < 1e-14:
                break
        return h * math.exp(a * math.log(t) - t - math.lgamma(a))

    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if upper(mid) > tail else (lo, mid)
    return hi


#: The covariance of the inner rows of a normal group is this much too small.
CONSISTENCY = H / chi2_cdf(chi2_upper(1 - H, P), P + 2)


def sampling_variances(s: textstats.TextStats) -> np.ndarray:
    return 0.25 * (BY_WORDS / (s.n_words + textstats.PRIOR_WORDS) + BY_LINES / (s.n_lines + textstats.PRIOR_LINES))


def document_statistics(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """keep columns, base counts, base_failed, the feature vector x and its sampling variances."""
    def run(texts):
        found = [textstats.text_stats(t) for t in texts]
        return [*(pa.array([getattr(s, c) for s in found], pa.int64()) for c in BASE),
                pa.array([s.base_failed for s in found], pa.bool_()),
                pa.array([textstats.features(s) for s in found], pa.list_(pa.float64())),
                pa.array([sampling_variances(s) for s in found], pa.list_(pa.float64()))]

    added = ", ".join([*(f"{c} long" for c in BASE), "base_failed boolean", "x array<double>",
                       "sampling array<double>"])
    return from_text(docs, text_col, keep, added, run)


def _with_estimates(rows: DataFrame, estimates: DataFrame, how: str = "inner") -> DataFrame:
    small = estimates.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS
    return rows.join(F.broadcast(estimates) if small else estimates, KEYS, how)


def _pooled(rows: DataFrame) -> DataFrame:
    """Own key -> key of the group it is estimated in."""
    counts = rows.filter(~F.col("base_failed")).groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"))
    langs = counts.groupBy(F.col("__lang").alias("__l")).agg(F.sum("n").alias("n_lang"))
    own, lang = F.col("n") >= MIN_ROWS, F.col("n_lang") >= MIN_ROWS
    return counts.join(langs, F.col("__lang") == F.col("__l")).select(
        *KEYS, F.when(own | lang, F.col("__lang")).otherwise("*").alias("__in_lang"),
        F.when(own, F.col("__source")).otherwise("*").alias("__in_source"))


def _distances(rows: DataFrame) -> DataFrame:
    """Replaces the columns mu and cov by the squared distance d2."""
    kept = [f for f in rows.schema if f.name not in ("mu", "cov")]
    schema = T.StructType([*kept, T.StructField("d2", T.DoubleType())])

    def vectors(batch, name, width):
        return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)

    def run(batches):
        for batch in batches:
            d = vectors(batch, "x", len(textstats.FEATURES))[:, INDEX] - vectors(batch, "mu", P)
            m = vectors(batch, "cov", P * P).reshape(-1, P, P).copy()
            m[:, range(P), range(P)] += FLOOR ** 2 + vectors(batch, "sampling", P)
            d2 = np.einsum("ni,ni->n", d, np.linalg.solve(m, d[..., None])[..., 0])
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), pa.array(d2)], schema.names)

    return rows.mapInArrow(run, schema)


def _start(rows: DataFrame) -> DataFrame:
    """Medians and median absolute deviations of each group as first estimates."""
    xs = [F.col("x")[i] for i in INDEX]
    med = rows.groupBy(*KEYS).agg(F.array(*[F.percentile_approx(x, 0.5, 1000) for x in xs]).alias("mu"))
    dev = _with_estimates(rows, med).groupBy(*KEYS).agg(F.first("mu").alias("mu"), F.array(*[
        F.percentile_approx(F.abs(x - F.col("mu")[j]), 0.5, 1000) for j, x in enumerate(xs)]).alias("mad"))

    def run(batches):
        for batch in batches:
            out = batch[[*KEYS, "mu"]].copy()
            out["cov"] = [np.diag((1.4826 * np.asarray(m)) ** 2).ravel() for m in batch["mad"]]
            yield out

    return dev.mapInPandas(run, "__lang string, __source string, mu array<double>, cov array<double>")


def _sums(rows: DataFrame) -> DataFrame:
    xs = [F.col("x")[i] for i in INDEX]
    return rows.groupBy(*KEYS).agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.array(*[F.sum(x) for x in xs]).alias("s"),
        F.array(*[F.sum(xs[i] * xs[j]) for i in range(P) for j in range(i, P)]).alias("ss"))


def _add(n: int, name: str):
    return F.array(*[F.sum(F.col(name)[i]) for i in range(n)]).alias(name)


def _estimate(sums: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Mean and covariance of each group from its sums and its priors'."""
    sums = scratch.save(sums, name)
    pairs = P * (P + 1) // 2
    by_lang = sums.groupBy("__lang").agg(F.sum("n").alias("n"), _add(P, "s"), _add(pairs, "ss"))
    total = sums.agg(F.sum("n").alias("n"), _add(P, "s"), _add(pairs, "ss")).first()
    if total["n"] is None:
        total = {"n": 1.0, "s": [0.0] * P, "ss": [0.0] * pairs}
    whole = np.array([total["n"], *total["s"], *total["ss"]], float)
    lang = by_lang.select(F.col("__lang").alias("__l"), F.array("n", *[F.col("s")[i] for i in range(P)], *[
        F.col("ss")[i] for i in range(pairs)]).alias("prior"))
    joined = sums.join(lang, F.col("__lang").eqNullSafe(F.col("__l"))).drop("__l")
    upper = np.triu_indices(P)

    def moments(n, s, ss):
        full = np.zeros((P, P))
        full[upper] = ss
        full = full + np.triu(full, 1).T
        mu = s / n
        return mu, full / n - np.outer(mu, mu)

    def run(batches):
        for batch in batches:
            mus, covs = [], []
            for n, s, ss, prior in zip(batch["n"], batch["s"], batch["ss"], batch["prior"]):
                own, prior = np.array([n, *s, *ss], float), np.asarray(prior, float)
                prior = prior + whole * (PRIOR_ROWS / whole[0])
                own = own + prior * (PRIOR_ROWS / prior[0])
                mu, cov = moments(own[0], own[1:P + 1], own[P + 1:])
                mus.append(mu)
                covs.append((cov * CONSISTENCY).ravel())
            out = batch[KEYS].copy()
            out["mu"], out["cov"] = mus, covs
            yield out

    return scratch.save(joined.mapInPandas(
        run, "__lang string, __source string, mu array<double>, cov array<double>"), f"{name}-estimate")


def quality_verdicts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                     keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep columns, base counts, base_failed, squared distance d2 and kept."""
    scratch = Scratch(docs.sparkSession, "outliers")
    # a null is a group of its own: joins compare keys in which it is spelled out
    spelled = lambda c: F.concat(F.when(F.col(c).isNull(), "-").otherwise("+"), F.coalesce(F.col(c), F.lit("")))
    keyed = docs.withColumns({"__lang": spelled(lang_col), "__source": spelled(source_col)})
    rows = scratch.save(document_statistics(keyed, text_col, (*KEYS, *keep)), "statistics")
    rows = _with_estimates(rows, scratch.save(_pooled(rows), "pooled"), "left").withColumns(
        {k: F.coalesce(F.col(p), F.lit("*")) for k, p in zip(KEYS, ("__in_lang", "__in_source"))}
    ).drop("__in_lang", "__in_source")
    good = rows.filter(~F.col("base_failed")).select(*KEYS, "x", "sampling")
    estimates = scratch.save(_start(good), "start")
    for step in range(STEPS):
        near = scratch.save(_distances(_with_estimates(good, estimates)), f"near{step}")
        limits = scratch.save(near.groupBy(*KEYS).agg(F.percentile_approx("d2", H, 10_000).alias("limit")),
                              f"limits{step}")
        inner = _with_estimates(near, limits).filter(F.col("d2") <= F.col("limit"))
        estimates = _estimate(_sums(inner), scratch, f"sums{step}")
        scratch.drop(f"near{step}", f"limits{step}")
    cutoff = chi2_upper(TAIL, P)
    judged = _with_estimates(rows, estimates, "left")
    zero, eye = F.array(*[F.lit(0.0)] * P), F.array(*[F.lit(float(i == j)) for i in range(P) for j in range(P)])
    judged = judged.withColumns({"mu": F.coalesce("mu", zero), "cov": F.coalesce("cov", eye)})
    return _distances(judged).select(
        *keep, *BASE, "base_failed", "d2", (~F.col("base_failed") & (F.col("d2") <= cutoff)).alias("kept"))


def keep_good(docs: DataFrame, **columns) -> DataFrame:
    """The documents that pass, with the columns they came with."""
    inner = {"__text": columns.get("text_col", "text"), "__l": columns.get("lang_col", "lang"),
             "__s": columns.get("source_col", "source")}
    packed = docs.select(F.struct(*docs.columns).alias("__row"), *[F.col(c).alias(a) for a, c in inner.items()])
    verdicts = quality_verdicts(packed, "__text", "__l", "__s", keep=("__row",))
    return verdicts.filter("kept").select("__row.*")
