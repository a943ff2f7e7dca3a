"""Statistics of one whole text, on its UTF-8 bytes (a null text has none)."""

from __future__ import annotations

import string
from dataclasses import dataclass

import numpy as np

SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\v\f\r"
WINDOW = 5
# Odd multipliers that mix the word hashes of a window.
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5,
                 0x85EBCA77C2B2AE63], np.uint64)


def count(data: bytes, chars: bytes) -> int:
    return len(data) - len(data.translate(None, chars))


def repeated_words(hashes: np.ndarray) -> int:
    """Words covered by five-word windows that occur twice or more."""
    n = len(hashes) - WINDOW + 1
    if n < 2:
        return 0
    keys = np.zeros(n, np.uint64)
    for i, m in enumerate(_MIX):
        keys += hashes[i:n + i] * m
        keys ^= keys >> np.uint64(29)
    order = np.sort(keys)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    at = np.flatnonzero(np.isin(keys, twice))
    edges = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + WINDOW, -1)
    return int((np.cumsum(edges)[:-1] > 0).sum())


@dataclass(slots=True)
class TextStats:
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    n_distinct: int
    n_adjacent: int
    n_upper: int
    n_digits: int
    n_punct: int
    n_lines: int
    n_long: int

    @property
    def base_failed(self) -> bool:
        return self.n_words < 10 or 100 * self.n_repeat_words > 20 * self.n_words


def text_stats(text: str | None) -> TextStats:
    if not text:
        return TextStats(0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0)
    data = text.encode()
    words = data.split()
    n = len(words)
    sizes = np.fromiter(map(len, words), np.int64, n)
    hashes = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    lines = [line for line in data.split(b"\n") if line.strip(BLANKS)]
    blanks = len(data) - int(sizes.sum())
    return TextStats(
        n, len(text) - blanks, count(data, SYMBOLS), len(lines) - len(set(lines)), repeated_words(hashes),
        len(np.unique(hashes)), int((hashes[1:] == hashes[:-1]).sum()),
        count(data, string.ascii_uppercase.encode()), count(data, string.digits.encode()),
        count(data, b".,;:!?"), len(lines), int((sizes > 20).sum()))


#: Pseudo-words and lines that pull the ratios of short texts to these usual values.
PRIOR_WORDS, PRIOR_LINES = 20.0, 4.0
FEATURES = ("symbols", "word_length", "adjacent", "repeats", "upper", "digits", "dup_lines", "distinct",
            "punct", "long_words")


def features(s: TextStats) -> list[float]:
    """Transformed statistics: smoothed ratios on a log or square-root scale."""
    n = s.n_words + PRIOR_WORDS
    chars = s.word_chars + 5 * PRIOR_WORDS
    return [
        float(np.log1p(20.0 * s.n_symbols / n)),
        float(np.log(chars / n)),
        (s.n_adjacent / n) ** 0.5,
        (s.n_repeat_words / n) ** 0.5,
        ((s.n_upper + 0.02 * 5 * PRIOR_WORDS) / chars) ** 0.5,
        (s.n_digits / chars) ** 0.5,
        (s.n_dup_lines / (s.n_lines + PRIOR_LINES)) ** 0.5,
        # distinct words against what a text of this length usually has
        float(np.log((s.n_distinct + PRIOR_WORDS) / n) + 0.09 * np.log1p(s.n_words)),
        (s.n_punct / n) ** 0.5,
        (s.n_long / n) ** 0.5,
    ]
