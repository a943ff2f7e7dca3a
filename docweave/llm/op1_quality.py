"""Quality scores: random Fourier features, ridge by partition-summed normal
equations, isotonic calibration.

The features approximate a Gaussian kernel over transformed statistics of the
whole text, standardised over all documents.  Each partition adds up its part
of Z'Z and Z'y; the sums (``COMPONENTS`` + 1 rows) are solved on the driver.
Raw scores of labelled rows that took no part in the fit are counted into a
fixed grid of bins, and pooled to an increasing curve.

Defined cases: a null or empty text has the statistics of no words and gets a
score; a document without an id is scored and never learned from; repeated
labels of a document count as their mean; without any label of a kind every
score is the share of the other, or 0.5; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.llm import textstats
from docweave.llm.common import Scratch, from_text

COMPONENTS = 192
#: Width of the kernel in standardised units; ridge weight per labelled row.
WIDTH, RIDGE = 3.0, 1e-4
SEED = 20240229
#: Standardised statistics beyond this many deviations are cut to it.
REACH = 6.0
#: Share of the labelled rows kept for calibration, and its grid.
HOLD, BINS, LOW, HIGH = 0.25, 1000, -0.5, 1.5
SLOPE = 1e-3

P = len(textstats.FEATURES)


def frequencies(width: float = WIDTH, components: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    return rng.normal(0, 1 / width, (P, components)), rng.uniform(0, 2 * np.pi, components)


def fourier(x: np.ndarray, mean: np.ndarray, sd: np.ndarray, w: np.ndarray, b: np.ndarray) -> np.ndarray:
    z = np.clip((x - mean) / sd, -REACH, REACH)
    return np.hstack([np.sqrt(2 / len(b)) * np.cos(z @ w + b), np.ones((len(x), 1))])


def document_features(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    def run(texts):
        return [pa.array([textstats.features(textstats.text_stats(t)) for t in texts], pa.list_(pa.float64()))]

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("__body"))
    return from_text(rows, "__body", ("doc_id",), "x array<double>", run)


def normal_equations(rows: DataFrame, transform) -> tuple[np.ndarray, np.ndarray, float]:
    """Z'Z, Z'y and the number of rows of (x, y), summed by partition."""
    d = COMPONENTS + 1

    def partial(batches):
        total = np.zeros((d, d + 2))
        for batch in batches:
            if len(batch):
                z, y = transform(np.stack(batch["x"])), batch["y"].to_numpy(float)
                total[:, :d] += z.T @ z
                total[:, d] += z.T @ y
                total[0, d + 1] += len(y)
        yield pd.DataFrame({"i": np.arange(d), "v": list(total)})

    def add(frame):
        return pd.DataFrame({"i": frame["i"].iloc[:1], "v": [np.sum(np.stack(frame["v"]), axis=0)]})

    sums = rows.select("x", "y").mapInPandas(partial, "i int, v array<double>") \
        .groupBy("i").applyInPandas(add, "i int, v array<double>").collect()
    out = np.zeros((d, d + 2))
    for r in sums:
        out[r["i"]] = r["v"]
    return out[:, :d], out[:, d], float(out[0, d + 1])


def isotonic(positives: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Increasing rates of adjacent bins, pooled where they would fall."""
    blocks: list[list[float]] = []  # positives, rows, bins
    for p, c in zip(positives, counts):
        blocks.append([float(p), float(c), 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            p2, c2, n2 = blocks.pop()
            blocks[-1][0] += p2
            blocks[-1][1] += c2
            blocks[-1][2] += n2
    return np.concatenate([np.full(int(n), p / c) for p, c, n in blocks]) if blocks else np.zeros(0)


def score_documents(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                    label_col: str = "quality", learn: Column | None = None) -> DataFrame:
    """doc_id and score of every document.  ``labels``: id_col and label_col;
    ``learn`` says which label rows may be learned from."""
    scratch = Scratch(docs.sparkSession, "quality")
    rows = scratch.save(document_features(docs, text_col, id_col), "features")
    xs = [F.col("x")[i] for i in range(P)]
    m = rows.agg(*[F.avg(x).alias(f"m{i}") for i, x in enumerate(xs)],
                 *[F.stddev_pop(x).alias(f"s{i}") for i, x in enumerate(xs)]).first()
    mean = np.array([m[f"m{i}"] or 0.0 for i in range(P)])
    sd = np.array([m[f"s{i}"] or 0.0 for i in range(P)])
    sd = np.where(sd > 1e-9, sd, 1.0)
    w, b = frequencies()
    transform = lambda x: fourier(x, mean, sd, w, b)

    known = labels.filter(learn) if learn is not None else labels
    known = (known.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).cast("long").alias("__id")).agg(F.avg(label_col).alias("y")))
    train = scratch.save(rows.join(known, F.col("doc_id") == F.col("__id")).select("doc_id", "x", "y"), "train")
    hold = F.pmod(F.xxhash64("doc_id"), F.lit(1000)) < int(1000 * HOLD)
    zz, zy, n = normal_equations(train.filter(~hold), transform)
    # the constant is the last component and is not shrunk
    shrink = RIDGE * max(n, 1.0) * np.diag([*[1.0] * COMPONENTS, 1e-6])
    beta = np.linalg.solve(zz + shrink, zy) if n else np.zeros(COMPONENTS + 1)

    def raw_bins(batches):
        for batch in batches:
            if len(batch):
                raw = transform(np.stack(batch["x"])) @ beta
                at = np.clip((raw - LOW) / (HIGH - LOW) * BINS, 0, BINS - 1).astype(int)
                yield pd.DataFrame({"bin": at, "y": batch["y"].to_numpy(float)})

    binned = (train.filter(hold).select("x", "y").mapInPandas(raw_bins, "bin int, y double")
              .groupBy("bin").agg(F.sum("y").alias("p"), F.count(F.lit(1)).alias("c")).orderBy("bin").collect())
    if binned:
        at = LOW + (np.array([r["bin"] for r in binned]) + 0.5) * (HIGH - LOW) / BINS
        curve = isotonic(np.array([r["p"] for r in binned]), np.array([r["c"] for r in binned], float))
    else:
        at, curve = np.array([0.0, 1.0]), np.array([0.0, 1.0]) if n else np.array([0.5, 0.5])

    def score(batches):
        for batch in batches:
            if len(batch):
                raw = transform(np.stack(batch["x"])) @ beta
                line = np.clip((raw - LOW) / (HIGH - LOW), 0, 1)  # keeps the order inside pooled blocks
                out = (1 - SLOPE) * np.interp(raw, at, curve) + SLOPE * line
                yield pd.DataFrame({"doc_id": batch["doc_id"], "score": np.clip(out, 0.0, 1.0)})

    return rows.mapInPandas(score, "doc_id long, score double")
