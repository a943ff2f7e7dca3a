"""Collocations, centroid clustering and toxicity."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from docweave.llm import op11_collocations as op11
from docweave.llm import op12_clusters as op12
from docweave.llm import op13_toxicity as op13
from docweave.llm import queries
from docweave.llm.levenshtein import TrieAutomaton, edits_allowed

DOCS = "doc_id long, text string, lang string, shard string, phrase string, c long"


# --- collocations ---------------------------------------------------------------
def brute_collocations(rows, support, limit):
    count, total = collections.defaultdict(collections.Counter), collections.Counter()
    for text, lang in rows:
        lang = lang if lang is not None else "und"
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in (1, 2, 3):
                count[lang].update(" ".join(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in count.items():
        cand = {p: a for p, a in f.items() if a >= support and " " in p}
        held = collections.Counter()
        for p, a in cand.items():
            w = p.split(" ")
            if len(w) == 3:
                for q in (" ".join(w[:2]), " ".join(w[1:])):
                    held[q] = max(held[q], a)
        scored = []
        for p, a in cand.items():
            if 100 * held[p] >= 50 * a:
                continue
            w = p.split(" ")
            cuts = [(f[" ".join(w[:k])], f[" ".join(w[k:])]) for k in range(1, len(w))]
            s, k = min((1000000 * a * a // (x * y), i) for i, (x, y) in enumerate(cuts))
            scored.append((-s, -a, p.encode(), p, a, *cuts[k]))
        for rank, (s, _, _, p, a, x, y) in enumerate(sorted(scored)[:limit], 1):
            out.append((lang, rank, p, a, x, y, total[lang], -s))
    return sorted(out)


def random_texts(n, seed=5):
    rng = random.Random(seed)
    words = ["the", "The", "of", "café", "ab", " ", "x\x00y", "größe", "a-b"]
    seps = [" ", "  ", "\t", ". ", "\n", ",", "\x0b", " ! "]
    for i in range(n):
        body = "".join(rng.choice(words) + rng.choices(seps, [12, 1, 1, 1, 1, 1, 1, 1])[0]
                       for _ in range(rng.randrange(0, 60)))
        yield (i, body, rng.choice(["en", "en", "en", "und", None]), "s", "p", 1)


def test_collocations_equal_brute_force(spark):
    rows = [*random_texts(120), (1, None, "en", "s", "p", 1), (1, "", "fr", "s", "p", 1), (None, "of ab " * 30, "de", "", "", 0),
            (None, "of ab " * 30, "de", "", "", 0)]
    df = spark.createDataFrame(rows, DOCS)
    for support, limit, shards in ((10, 2000, 4), (3, 7, 2)):
        got = sorted(map(tuple, op11.collocations(df, support=support, limit=limit, shards=shards).collect()))
        assert got == brute_collocations([(r[1], r[2]) for r in rows], support, limit)


def test_collocations_of_long_texts_and_empty_tables(spark):
    long = "one two three. " * 60_000 + "tail " * 20
    df = spark.createDataFrame([(1, long, "en", "", "", 0)], DOCS)
    got = sorted(map(tuple, op11.collocations(df).collect()))
    assert got == brute_collocations([(long, "en")], 10, 2000)
    assert op11.collocations(df.limit(0)).count() == 0
    assert op11.collocations(spark.createDataFrame([(1, None, None, "", "", 0)], DOCS)).count() == 0


def test_slices_cut_at_piece_ends():
    texts = ["A b.c", None, "d e f;" * 50, "", "g" * 90 + ".h"]
    data = [d for g, d in op11.slices((("g",), t) for t in texts) if g == ("g",)]
    assert len(data) == 1
    data = [d for _, d in op11.slices([(("g",), t) for t in texts], 40)]
    mixed = list(op11.slices([(i % 3, t) for i, t in enumerate(texts * 9)], 400, 500))
    assert sum(len(d) for _, d in mixed) == 9 * sum(len(t.encode()) + 1 for t in texts if t)
    whole = b"".join(t.encode().translate(op11._FOLD) + b"\n" for t in texts if t)
    assert sorted(b"".join(data).split(b"\n")) == sorted(whole.split(b"\n"))
    assert all(d.endswith(b"\n") for d in data)


def test_exact_score_beyond_64_bits(spark):
    a = 5_000_000_000
    row = spark.range(1).selectExpr(
        f"(cast(1000000 as decimal(7,0)) * cast({a}L as decimal(16,0)) * cast({a}L as decimal(16,0))) div "
        f"(cast({a + 1}L as decimal(16,0)) * cast({a + 3}L as decimal(16,0))) as s").first()
    assert row["s"] == 1000000 * a * a // ((a + 1) * (a + 3))


# --- centroid clustering ----------------------------------------------------------
def brute_clusters(rows, start, rounds, dims):
    kept = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    key = lambda i: hashlib.sha256(f"2:{i}".encode()).hexdigest()
    order = sorted(kept, key=lambda r: (r[0] is None, key(r[0]), r[1]))
    centres = [v for _, v in order[:start]]

    def place():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centres)) for _, v in kept]

    for _ in range(rounds):
        at = place()
        for j in range(len(centres)):
            mine = [v for (_, v), (_, k) in zip(kept, at) if k == j]
            if mine:
                centres[j] = [sum(col) // len(mine) for col in zip(*mine)]
    at = place()
    inertia = collections.Counter()
    for d, j in at:
        inertia[j] += d
    return sorted(((i, j, d, inertia[j], sum(inertia.values()),
                    hashlib.sha256(",".join(map(str, centres[j])).encode()).hexdigest())
                   for (i, _), (d, j) in zip(kept, at)), key=str)


@pytest.mark.parametrize("scale", [1.0, 0.01, 300.0])
def test_clusters_equal_brute_force(spark, scale):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(np.float32(x)) for x in rng.normal(rng.integers(-2, 3), 1, 4) * scale]) for i in range(150)]
    rows += [(7, rows[3][1]), (7, rows[3][1]), (None, rows[5][1]), (200, None), (201, [1.0, 2.0]),
             (202, [1.0, None, 0.0, 0.0]), (203, [float("nan")] * 4), (204, [float("inf"), 0.0, 0.0, 0.0]),
             (205, [0.0] * 4), (206, [0.0] * 4)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows],
                               "vec_id long, embedding array<float>, cluster int, v string")
    got, centres = op12.cluster_vectors(df, dims=4, start=11, rounds=3)
    assert sorted(map(tuple, got.collect()), key=str) == brute_clusters(rows, 11, 3, 4)
    assert centres.shape == (11, 4)


def test_scan_meets_every_tie():
    rng = np.random.default_rng(1)
    x = rng.integers(-3, 4, (400, 3))
    c = rng.integers(-3, 4, (30, 3))  # equal centroids and equal sums occur
    label, best = op12.nearest(x, c)
    d = ((x[:, None] - c[None]) ** 2).sum(axis=2)
    assert (best == d.min(axis=1)).all() and (label == d.argmin(axis=1)).all()


def test_large_components_stay_exact(spark):
    x = np.array([[op12.BOUND, -op12.BOUND], [op12.BOUND - 1, -op12.BOUND]])
    label, best = op12.nearest(x, np.array([[-op12.BOUND, op12.BOUND], [op12.BOUND - 1, -op12.BOUND]]))
    assert label.tolist() == [1, 1] and best.tolist() == [1, 0]


def test_clusters_of_few_and_no_vectors(spark):
    df = spark.createDataFrame([(1, [0.5, 1.0]), (2, [1e30, -1e30])], "vec_id long, embedding array<double>")
    got = op12.cluster_vectors(df, dims=2)[0].orderBy("vec_id").collect()
    assert [r["distance"] for r in got] == [0, 0]
    assert op12.cluster_vectors(df.limit(0), dims=2)[0].count() == 0


# --- toxicity -------------------------------------------------------------------
def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_equals_edit_distance():
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abc") for _ in range(rng.randrange(1, 12)))
    terms = {word() for _ in range(40)}
    automaton = TrieAutomaton(terms)
    for w in {word() for _ in range(600)} | terms:
        near = [(d, t) for t in terms if (d := edit_distance(w, t)) <= edits_allowed(t)]
        expected = min(near, default=None)
        assert automaton.nearest(w) == ((expected[1], expected[0]) if expected else None)


def test_windows_tell_quotation_from_abuse():
    at = lambda s: op13.context(s.split(), s.split().index("idiot"))
    plain, quoted = at("so then idiot went home"), at('he read "what an idiot indeed" aloud')
    assert plain == 1.0 and quoted == op13.QUOTED
    assert at("he said an idiot went") == op13.REPORTED
    assert at("yes you idiot go") == op13.ADDRESSED
    assert at('"before" an idiot "after"') == 1.0
    assert op13.context(['he', 'wrote', '"idiot",', 'then'], 2) == op13.QUOTED * op13.REPORTED


def toxic_table(spark):
    rng = random.Random(9)
    vocabulary = ["".join(rng.choice("aeioulmnrst") for _ in range(rng.randrange(2, 8))) for _ in range(400)]
    bad = ["wretch", "scoundrel", "nitwit"]
    rows, labels = [], []
    for i in range(400):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(5, 60))]
        toxic = i % 5 == 0
        for _ in range(3 if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((i, " ".join(words), 1, "z"))
        labels.append((i, int(toxic)))
    tail = " ".join(vocabulary[:30])
    rows += [(1000, f"{tail} scoundrell {tail}", 1, "z"), (1001, tail, 1, "z"), (1002, None, 1, "z"), (1003, "", 1, "z"),
             (None, f"nitwit wretch {tail}", 1, "z"), (1004, "wretch " * 50_000, 1, "z"), (1005, "wretch", 1, "z"),
             (1005, "wretch", 1, "z"), (1006, f'{tail} said "nitwit" {tail}', 1, "z"), (1007, f"{tail} nitwit {tail}", 1, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, y int, finds string")
    return docs, spark.createDataFrame(labels + [(3, None), (None, 1), (0, 1)], "doc_id long, toxic int")


def test_toxic_documents_misspellings_and_quotations(spark):
    docs, labels = toxic_table(spark)
    got = op13.score_documents(docs, labels).collect()
    score = {r["doc_id"]: r["score"] for r in got}
    assert len(got) == docs.count()
    assert all(score[i] > 0.7 for i in range(0, 400, 5)) and all(score[i] < 0.5 for i in range(1, 400) if i % 5)
    assert score[None] > 0.7 and score[1004] > 0.7 and score[1005] > 0.7
    assert score[1001] == pytest.approx(score[1002]) and score[1002] == score[1003] < 0.2
    assert score[1000] > 5 * score[1001]
    assert score[1006] < score[1007]


def test_scores_do_not_depend_on_held_out_toxic_labels(spark):
    docs, labels = toxic_table(spark)
    turned = labels.withColumn("toxic", F.when(queries.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = ({r["doc_id"]: round(r["score"], 9) for r in op13.score_documents(docs, x, learn=~queries.held_out()).collect()}
            for x in (labels, turned))
    assert a == b


def test_toxicity_without_labels_or_documents(spark):
    docs, labels = toxic_table(spark)
    assert {r["score"] for r in op13.score_documents(docs, labels.limit(0)).collect()} == {0.5}
    assert {r["score"] for r in op13.score_documents(docs, labels.filter("toxic = 0")).collect()} == {0.0}
    assert op13.score_documents(docs.limit(0), labels).count() == 0


def test_held_out_accuracy_on_the_given_tables(spark):
    out = queries.op13_levenshtein_toxicity(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = out.filter("held_out").join(labels, "doc_id").collect()
    clean = [r for r in rows if not r["toxic"]]
    assert sum(r["predicted"] for r in clean) <= 0.03 * len(clean)
    assert sum(r["predicted"] == r["toxic"] for r in rows) >= 0.93 * len(rows)
