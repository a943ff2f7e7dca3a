"""Distinct word-shingle hashes of many texts at once, in numpy.

Words are hashed by differences of a prefix sum of byte codes times powers of
an odd number (modulo 2**64), five word hashes are mixed into a shingle hash.
Equal word sequences have equal hashes in every process; 64 bits keep unequal
ones apart up to an expected n**2 / 2**65 pairs.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

WORDS = 5
#: Texts are hashed in runs of about this many bytes.
RUN_BYTES = 2 << 20
U = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True


@lru_cache(maxsize=1)
def _codes() -> np.ndarray:
    """Random code of each byte, A-Z as a-z."""
    codes = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
    codes[65:91] = codes[97:123]
    return codes


_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, RUN_BYTES)
        have = np.full(size, base, U)
        have[0] = 1
        have = np.multiply.accumulate(have)
        _powers[base] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer: every input bit reaches every output bit."""
    h = h ^ (h >> U(30))
    h = h * U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U(27))
    h = h * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def _word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of concatenated texts, and the index of its text."""
    n = len(data)
    solid = ~BLANK[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    cuts = bounds[(bounds > 0) & (bounds < n)]
    first[cuts] = solid[cuts]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    last[cuts - 1] = solid[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    sums = np.zeros(n + 1, U)
    np.cumsum(_codes()[data] * powers(BASE, n), out=sums[1:])
    words = (sums[ends] - sums[starts]) * powers(INVERSE, n)[starts] if n else np.zeros(0, U)
    return mix(words), np.searchsorted(bounds, starts, "right") - 1


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text: of all five-word windows, or
    of the whole word sequence when it is shorter; none without words."""
    out: list[np.ndarray] = []
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) <= RUN_BYTES):
            size += len(texts[j])
            j += 1
        out += _run(texts[i:j])
        i = j
    return out


def _run(texts: list[bytes]) -> list[np.ndarray]:
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    words, owner = _word_hashes(np.frombuffer(b"".join(texts), np.uint8), bounds)
    counts = np.bincount(owner, minlength=len(texts))
    ends = np.cumsum(counts)
    n = len(words) - WORDS + 1
    if n > 0:
        keys = np.zeros(n, U)
        for k in range(WORDS):
            keys = mix(keys * U(31) + words[k:n + k])
    out = []
    for end, c in zip(ends.tolist(), counts.tolist()):
        if c >= WORDS:
            out.append(np.unique(keys[end - c:end - WORDS + 1]))
        elif c:
            h = np.array([c], U)
            for w in words[end - c:end]:
                h = mix(h * U(37) + w)
            out.append(h)
        else:
            out.append(np.zeros(0, U))
    return out
