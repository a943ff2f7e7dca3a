"""Operators on documents against brute force, on small and awkward tables."""

import collections
import hashlib
import random
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from docweave.llm import (op3_jaccard, op4_tokens, op5_outliers, op7_packing, op8_pii, op9_mixing, op10_suffix,
                           textstats, tokens)
from docweave.llm.common import Scratch
from docweave.llm.tokens import Encoder

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, extra int, chunk int, n long"
#: Nulls, empty and blank texts, repeated rows, other blanks than spaces, columns that clash with inner names.
AWKWARD = [
    (1, None, None, None, 1, 1, 1), (2, "", "en", "a", 2, 2, 2), (3, " \t\n", "en", None, 3, 3, 3),
    (4, "One two three.\n\nÜber  naïve x İΣ <|endoftext|> 's", "de", "a", 4, 4, 4),
    (4, "One two three.\n\nÜber  naïve x İΣ <|endoftext|> 's", "de", "a", 4, 4, 4),
    (None, "no id, but text", "en", "b", 5, 5, 5), (6, "word " * 3000, "en", "b", 6, 6, 6),
    (7, "\x1ca\x85b c\r\nd", "en", "b", 7, 7, 7),
]


def frame(spark, rows=AWKWARD):
    return spark.createDataFrame(rows, SCHEMA)


# --- shingle joins ------------------------------------------------------------
def shingles(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def components(rows):
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                ra, rb = find(a), find(b)
                root[max(ra, rb)] = min(ra, rb)
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(2000)]
    rows = []
    for _ in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 5, 7, 8, 9, 20, 60, 127, 131, 133, 300]))]
        for _ in range(rng.randint(1, 6)):
            words = list(base)
            for _ in range(rng.randint(0, max(1, len(words) // 40))):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                words += [rng.choice(vocabulary) for _ in range(rng.randint(0, len(words) // 4))]
            rows.append((len(rows), "\n".join(words).upper() if rng.random() < 0.3 else " ".join(words)))
    rows += [(len(rows), None), (len(rows) + 1, "a b"), (len(rows) + 2, "A  B"), (len(rows) + 3, " ")]
    out = op3_jaccard.near_duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out.collect()} == components(rows)


def test_segments_that_differ_are_no_more_than_the_difference():
    rng = np.random.default_rng(1)
    for n in (130, 200, 255, 400):
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
        b = np.unique(np.concatenate([a[n // 10:], rng.integers(0, 1 << 63, 7, dtype=np.uint64)]))
        d = len(np.setxor1d(a, b))
        band = op3_jaccard.band_of(len(a))
        x, y = (set(op3_jaccard.segment_keys(s, band).tolist()) for s in (a, b))
        assert len(x - y) <= d and len(y - x) <= d
        far = sum(int(v).bit_count() for v in np.bitwise_xor(
            op3_jaccard.parity_sketch(a), op3_jaccard.parity_sketch(b)).view(np.uint64))
        assert far <= d


def test_near_duplicates_of_awkward_and_empty_tables(spark):
    out = op3_jaccard.near_duplicate_classes(frame(spark))
    assert sorted((r["doc_id"], r["component_id"]) for r in out.collect()) == [
        (1, 1), (2, 2), (3, 3), (4, 4), (4, 4), (6, 6), (7, 7)]
    kept = op3_jaccard.drop_near_duplicates(frame(spark))
    assert kept.columns == frame(spark).columns and kept.count() == len(AWKWARD)
    assert op3_jaccard.near_duplicate_classes(frame(spark, [])).count() == 0


# --- tokens -------------------------------------------------------------------
@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_equals_the_library(name):
    e = Encoder(public_tokenizers.path(name))
    rng = random.Random(2)
    parts = ["a", "Bc", "é", "é", " ", "  ", "\n", "\r\n", "\t", "'s", "'T", "1", "23", " ", "İ", "Σ", "中文",
             "<|endoftext|>", "!!", ".", ",", "\x1c", "\x85", "​", "K", "Å", "ﬁ", "　"]
    texts = [t or "" for _, t, *_ in AWKWARD] + [
        "".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(3000)]
    want = e.tok.encode_batch(texts, add_special_tokens=False)
    for text, w in zip(texts, want):
        assert np.frombuffer(e.encode(text), "<u4").tolist() == w.ids, text


@pytest.mark.parametrize("name, ends", [("word_bpe_49k.json", [49406, 49407]), ("byte_bpe_50k.json", [50256])])
def test_added_tokens_equal_a_plain_call(name, ends):
    e, plain = Encoder(public_tokenizers.path(name)), Tokenizer.from_file(public_tokenizers.path(name))
    texts = ["<|startoftext|>", "a <|endoftext|> b", "a<|startoftext|>b\n<|endoftext|>", "x <|EndOfText|> y <| z |>",
             "É <|endoftext|><|startoftext|>\n\nb  c", "<|endoftext|", *(t for _, t, *_ in AWKWARD if t)]
    got = [np.frombuffer(e.encode(t), "<u4").tolist() for t in texts]
    assert got == [w.ids for w in plain.encode_batch(texts, add_special_tokens=False)]
    assert {i for ids in got for i in ids}.issuperset(ends)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_texts_larger_than_the_chunk_table(name, monkeypatch):
    monkeypatch.setattr(tokens, "CHUNK_ENTRIES", 3)
    e = Encoder(public_tokenizers.path(name))
    texts = ["a b", "a b 7f3a c d Éa. e,\nf a b", "x", "a x y", "x p q r a", "a b c d e f a b c d e f"]
    for text in texts:
        assert np.frombuffer(e.encode(text), "<u4").tolist() == e.tok.encode(text, add_special_tokens=False).ids
        assert len(e.bare) <= 3 and len(e.spaced) <= 3


def test_token_files_round_trip(spark):
    path = Scratch(spark, "t").path("ids")
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    op4_tokens.write_tokens(frame(spark), path, vocabulary, 2, metadata=("lang", "extra"))
    e = Encoder(vocabulary)
    rows = sorted(AWKWARD, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want, start = [], 0
    for r in rows:
        ids = np.frombuffer(e.encode(r[1] or ""), "<u4").tolist() + [2]
        want.append((r[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = op4_tokens.token_offsets(spark, path).drop("n_tokens", "doc_id").join(
        op4_tokens.token_digests(spark, path), ["part", "row"])
    key = lambda r: (r[1],)
    assert sorted([(r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in got.collect()], key=key) == want
    assert op4_tokens.read_tokens(spark, path, ("lang", "n_tokens")).count() == len(AWKWARD)
    with pytest.raises(ValueError):
        op4_tokens.encode_documents(frame(spark).withColumnRenamed("extra", "ids"), vocabulary, 2, metadata=("ids",))
    empty = Scratch(spark, "t").path("none")
    op4_tokens.write_tokens(frame(spark, []), empty, vocabulary, 2)
    assert op4_tokens.token_offsets(spark, empty).count() == 0


def test_starts_follow_the_numbers_of_files(spark):
    names = ["part-00007-u-c000.zstd.parquet", "part-99999-u-c000.zstd.parquet", "part-99999-u-c001.zstd.parquet",
             "part-100000-u-c000.zstd.parquet", "part-100001-u-c000.zstd.parquet"]
    df = spark.createDataFrame([(n, r, 10 ** i) for i, n in enumerate(names) for r in (0, 1)],
                               "part string, row long, n_tokens long")
    got = {(r["part"], r["row"]): r["start"] for r in op4_tokens.with_starts(df).collect()}
    at = 0
    for i, n in enumerate(names):
        for r in (0, 1):
            assert got[n, r] == at
            at += 10 ** i


def check_windows(rows, docs, size=1024):
    e = Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    ids = [np.frombuffer(e.encode(t or ""), "<u4").tolist() + [0] for t in docs]
    assert sum(r["length"] for r in rows) == sum(map(len, ids))
    windows = collections.defaultdict(list)
    for r in rows:
        windows[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in windows.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert 0 < at <= size
    return len(windows) * size / max(1, sum(map(len, ids)))


def test_windows_hold_every_id_once(spark):
    rng = random.Random(3)
    docs = [(i, " ".join(rng.choice(["alpha", "beta", "gamma", "naïve"]) for _ in range(rng.randint(0, 700))))
            for i in range(300)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    rows = op7_packing.pack_documents(df, public_tokenizers.path("byte_bpe_50k.json"), 0, windows=8).collect()
    assert check_windows(rows, [t for _, t in docs]) < 1.03
    e = Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: e.encode(t) + b"\0\0\0\0" for i, t in docs}
    covered = collections.Counter()
    for r in rows:
        part = ids[r["doc_id"]][4 * r["start"]:4 * (r["start"] + r["length"])]
        assert zlib.crc32(part) == r["ids_crc32"] and r["doc_tokens"] == len(ids[r["doc_id"]]) // 4
        covered.update((r["doc_id"], k) for k in range(r["start"], r["start"] + r["length"]))
    assert set(covered.values()) == {1}


def test_windows_of_awkward_and_empty_tables(spark):
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    rows = op7_packing.pack_documents(frame(spark), vocabulary, 0).collect()
    check_windows(rows, [r[1] for r in AWKWARD])
    assert op7_packing.pack_documents(frame(spark, []), vocabulary, 0).count() == 0


# --- quality rules ------------------------------------------------------------
def brute_stats(text):
    t = text or ""
    w = WORD.findall(t)
    n = len(w)
    seen = collections.Counter(tuple(w[i:i + 5]) for i in range(n - 4))
    covered = {k for i in range(n - 4) if seen[tuple(w[i:i + 5])] > 1 for k in range(i, i + 5)}
    lines, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    return n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered)


def test_base_counts_equal_brute_force():
    rng = random.Random(4)
    parts = ["a", "b", "é", " ", " ", "\n", "\t", "#", "|", "a b c d e ", " ", "x y\n"]
    texts = [r[1] for r in AWKWARD] + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    for t in texts:
        s = textstats.text_stats(t)
        assert (s.n_words, s.word_chars, s.n_symbols, s.n_dup_lines, s.n_repeat_words) == brute_stats(t), t


def test_outliers_go_and_clean_documents_stay(spark):
    rng = random.Random(6)
    words = [rng.choice("bcdfg") + rng.choice("aeiou") + "n" * rng.randint(0, 4) for _ in range(900)]

    def clean():
        return "\n".join(" ".join(rng.choice(words) for _ in range(rng.randint(8, 14))).capitalize() + "."
                         for _ in range(rng.randint(3, 12)))

    rows = [(i, clean(), "en", f"s{i % 2}") for i in range(500)]
    junk = [(1000 + i, " ".join(w + rng.choice(["###", "$$$", "%%%"]) for w in clean().split()), "en", "s0")
            for i in range(40)]
    out = op5_outliers.quality_verdicts(spark.createDataFrame(rows + junk, "doc_id long, text string, lang string, source string"))
    got = {r["doc_id"]: r["kept"] for r in out.collect()}
    assert not any(got[i] for i, *_ in junk) and sum(got[i] for i, *_ in rows) >= 498


def test_one_statistic_alone_rejects(spark):
    """Number dumps, repeated short lines and encoded words, each odd in one way only."""
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.choice((2, 3, 4, 5, 6, 7, 9))))
             for _ in range(900)]

    def line(n):
        return " ".join(rng.choice(words) for _ in range(n))

    def clean():
        lines = [line(rng.randint(8, 14)).capitalize() + "." for _ in range(rng.randint(2, 40))]
        if rng.random() < 0.3:
            lines.append(f"In {rng.randint(1900, 2020)} it was {rng.randint(2, 99)}.")
        return "\n".join(lines)

    rows = [(i, clean(), "en", "s") for i in range(600)]
    junk = [(1000 + n, " ".join(str(rng.randint(10000, 99999)) for _ in range(n)), "en", "s") for n in (30, 60, 100, 900)]
    junk += [(2000 + n, "\n".join(f"Home\n{line(4).capitalize()}" for _ in range(n)), "en", "s") for n in (30, 100, 400)]
    junk += [(4000 + n, " ".join(w if rng.random() < 0.7 else "".join(rng.choices(words, k=6))[:24]
                                 for w in line(n).split()), "en", "s") for n in (100, 900)]
    out = op5_outliers.quality_verdicts(spark.createDataFrame(rows + junk, "doc_id long, text string, lang string, source string"))
    got = {r["doc_id"]: r for r in out.collect()}
    assert not any(got[i]["base_failed"] for i, *_ in junk)  # it is the distance that decides
    assert [i for i, *_ in junk if got[i]["kept"]] == []
    assert sum(got[i]["kept"] for i, *_ in rows) >= 598


def test_outliers_of_awkward_and_empty_tables(spark):
    assert op5_outliers.quality_verdicts(frame(spark)).count() == len(AWKWARD)
    kept = op5_outliers.keep_good(frame(spark))
    assert kept.schema == frame(spark).schema and kept.count() == 0
    assert op5_outliers.keep_good(frame(spark, [])).count() == 0


def test_chi_squared_quantiles():
    assert abs(op5_outliers.chi2_upper(0.05, 8) - 15.5073) < 1e-3
    assert abs(op5_outliers.chi2_cdf(7.3441, 8) - 0.5) < 1e-4


# --- personal data ------------------------------------------------------------
MAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
ADDRESS = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute_spans(t):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    out = [(m.start(), 0, m.end()) for m in MAIL.finditer(t)]
    out += [(m.start(), 1, m.end()) for m in ADDRESS.finditer(t) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(t) if 14 <= len(digits(m)) <= 19 and op8_pii.luhn(digits(m))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(t) if 10 <= len(digits(m)) <= 15]
    return sorted(out)


def test_base_spans_equal_the_patterns():
    rng = random.Random(7)
    parts = ["a", "@", "@", "b.c", ".", "1", "22", "255", "300", "+1", "-", " ", "(", "é", "٣", "4111111111111111", "0000"]
    for _ in range(40000):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 22)))
        assert op8_pii.base_spans(t) == brute_spans(t), t


def test_personal_data_is_counted_by_kind(spark):
    texts = ["a@b.co c@d.ef 1.2.3.4 +1 234 567 8901", "4111 1111 1111 1111 9.9.9.9 8.8.8.8", "0" * 5000 + ".1.1.1", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in op8_pii.digest_columns(op8_pii.find_personal_data(df)).collect()}
    for i, t in enumerate(texts[:2]):
        want = brute_spans(t)
        assert [got[i][f"n_{k}"] for k in op8_pii.KINDS] == [sum(r == k for _, r, _ in want) for k in range(4)]
        text = ",".join(f"{op8_pii.KINDS[r]}:{a}:{b}" for a, r, b in want)
        assert got[i]["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert got[2]["n_ip"] == 1 and got[2]["spans"] == "ip:0:5006"
    assert [got[3][f"n_{k}"] for k in op8_pii.KINDS] == [0, 0, 0, 0]


def test_scan_of_very_long_words_is_linear():
    t0 = time.time()
    for unit in ("a", "1", "a.", "1.", "a@", "-", "+1", "a-"):
        op8_pii.scan(unit * (400_000 // len(unit)) + " 7")
    assert time.time() - t0 < 20


def test_contexts_of_seeds_find_other_identifiers(spark):
    rows = [(i, f"text about things. member contact address user{i}@mail.org today and more") for i in range(20)]
    rows += [(100 + i, f"some words, member contact address QX-77{i}-Z9 today and more") for i in range(3)]
    rows += [(200 + i, f"the release was number 20{i}x45b7 in this series") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in op8_pii.digest_columns(op8_pii.find_personal_data(df)).collect()}
    assert all(got[100 + i].startswith("id:") for i in range(3))
    assert not any(got[200 + i] for i in range(20)) and all(got[i].startswith("email:") for i in range(20))
    clean = {r["doc_id"]: r["text"] for r in op8_pii.redact(df).collect()}
    assert clean[100] == "some words, member contact address <ID> today and more" and clean[200] == rows[23][1]
    assert clean[0] == "text about things. member contact address <EMAIL> today and more"


def test_personal_data_of_awkward_and_empty_tables(spark):
    found = op8_pii.digest_columns(op8_pii.find_personal_data(frame(spark)))
    assert found.count() == len(AWKWARD)
    none = hashlib.sha256(b"").hexdigest()
    assert {r["base_sha256"] for r in found.collect()} == {none}
    assert op8_pii.redact(frame(spark)).exceptAll(frame(spark)).count() == 0
    assert op8_pii.redact(frame(spark, [])).count() == 0


# --- mixing -------------------------------------------------------------------
def levelled(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, target, held = 1.5 * sum(sizes.values()), {}, set()
    while True:
        rest = total - sum(2 * sizes[s] for s in held)
        open_ = [s for s in names if s not in held]
        target = {s: 2.0 * sizes[s] if s in held else rest * weight[s] / sum(weight[o] for o in open_) for s in names}
        over = {s for s in open_ if target[s] > 2 * sizes[s]}
        if not over:
            return target
        held |= over


def test_targets_equal_brute_force_and_the_mix_meets_them(spark):
    rng = random.Random(8)
    names = ["b", "a", "é", "Z", None, "c10", "c2"]
    rows = [(i, " ".join(["w"] * rng.randint(0, 40)), "en", rng.choice(names[:1] * 6 + names), 0, 0, 0) for i in range(3000)]
    df = frame(spark, rows)
    mixed = op9_mixing.mix(df).collect()
    sizes = collections.Counter()
    for r in rows:
        sizes[r[3]] += len(r[1].split())
    want = levelled(sizes)
    taken = collections.Counter()
    for r in mixed:
        assert abs(r["target"] - want[r["source"]]) < 1e-6 and r["source_size"] == sizes[r["source"]]
        assert r["copies"] <= 2
        taken[r["source"]] += r["copies"] * r["size"]
    assert all(abs(taken[s] - want[s]) < 0.1 * want[s] + 100 for s in want)
    out = op9_mixing.emit(op9_mixing.mix(df))
    assert out.columns == df.columns and out.count() == sum(r["copies"] for r in mixed)


def test_mix_of_awkward_and_empty_tables(spark):
    assert op9_mixing.mix(frame(spark)).count() == len(AWKWARD)
    assert op9_mixing.mix(frame(spark, [])).count() == 0
    none = [(1, None, "en", "a", 0, 0, 0), (2, "", "en", None, 0, 0, 0)]
    assert {r["target"] for r in op9_mixing.mix(frame(spark, none)).collect()} == {0.0}


# --- repeated bytes -----------------------------------------------------------
def brute_cut(rows):
    bodies = [(i, (t or "").encode()) for i, t in rows]
    seen = collections.Counter(b[p:p + 200] for _, b in bodies for p in range(len(b) - 199))
    out = []
    for i, b in bodies:
        gone = [False] * len(b)
        for p in range(len(b) - 199):
            if seen[b[p:p + 200]] > 1:
                gone[p:p + 200] = [True] * 200
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return collections.Counter(out)


def test_cover_has_every_difference():
    c = op10_suffix.COVER
    assert {(a - b) % op10_suffix.PERIOD for a in c for b in c} == set(range(op10_suffix.PERIOD))


@pytest.mark.parametrize("share", [op10_suffix.SHARE, 0.05])
def test_repeated_bytes_equal_brute_force(spark, share):
    rng = random.Random(9)
    text = lambda n: "".join(rng.choice("abcdefgh é\n") for _ in range(n))
    passages = [text(n) for n in (150, 199, 200, 201, 260, 399, 500, 1000)]
    rows = [(i, "".join(rng.choice(passages) if rng.random() < 0.3 else text(rng.randint(0, 300))
                        for _ in range(rng.randint(0, 5)))) for i in range(60)]
    rows += [(200, None), (201, ""), (None, rows[0][1]), (None, "x" * 450), (203, "ab" * 300), (3, rows[3][1]),
             (204, "é" * 100), (205, "é" * 99 + "a"), (206, "é" * 100)]
    out = op10_suffix.repeated_bytes(spark.createDataFrame(rows, "doc_id long, text string"), share=share)
    got = collections.Counter(tuple(r)[:5] for r in out.collect())
    assert got == brute_cut(rows)


def test_repeated_bytes_of_awkward_and_empty_tables(spark):
    out = op10_suffix.repeated_bytes(frame(spark)).collect()
    assert collections.Counter(tuple(r)[:5] for r in out) == brute_cut([r[:2] for r in AWKWARD])
    assert all(hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] for r in out)
    assert op10_suffix.repeated_bytes(frame(spark, [])).count() == 0
