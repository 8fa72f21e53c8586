"""Word shingle sets of texts, hashed in numpy, and their minwise sketches.

Words are the runs of bytes between ASCII blanks of the text with A-Z in lower
case; a shingle is five words in a row, or the whole sequence of a shorter
text.  Shingles are 64-bit hashes, so two different shingles of a pair of
documents are confused with a chance of about 1e-13.
"""

from __future__ import annotations

import numpy as np

WORDS = 5
_MASK = (1 << 64) - 1
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_random = np.random.default_rng(20_240_601)
_BYTE = _random.integers(1, _MASK, 256, dtype=np.uint64, endpoint=True)
_BASE = 0x9E37_79B9_7F4A_7C15
_PLACE = _random.integers(1, _MASK, WORDS, dtype=np.uint64, endpoint=True) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58_476D_1CE4_E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D0_49BB_1331_11EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, np.uint64(_BASE), dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def word_hashes(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of texts joined in ``data``, and the number of words of each text.

    ``ends`` are the texts' ends; words never go across them.
    """
    inside = ~_SPACE[data]
    starts_text = np.zeros(len(data) + 1, dtype=bool)
    starts_text[np.concatenate([[0], ends])] = True
    before = np.concatenate([[False], inside[:-1]]) & ~starts_text[:-1]
    start = np.flatnonzero(inside & ~before)
    of_text = np.searchsorted(ends, start, side="right")
    counts = np.bincount(of_text, minlength=len(ends))
    if not len(start):
        return np.zeros(0, dtype=np.uint64), counts
    low = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    word = np.cumsum(inside & ~before) - 1
    at = np.flatnonzero(inside)
    word = word[at]
    place = at - start[word]
    value = _BYTE[low[at]] * _powers(int(place.max()) + 1)[place]
    first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    return mix(np.add.reduceat(value, first)), counts


def shingle_sets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts' sorted distinct shingles one after the other, and the size of each set."""
    ends = np.cumsum([len(t) for t in texts])
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    words, counts = word_hashes(data, ends)
    windows = np.where(counts >= WORDS, counts - WORDS + 1, (counts > 0).astype(counts.dtype))
    text = np.repeat(np.arange(len(texts)), windows)
    if not len(text):
        return np.zeros(0, dtype=np.uint64), np.zeros(len(texts), dtype=np.int64)
    first_word = np.concatenate([[0], np.cumsum(counts)[:-1]])
    at = first_word[text] + np.arange(len(text)) - np.repeat(np.cumsum(windows) - windows, windows)
    short = counts[text] < WORDS
    value = np.zeros(len(text), dtype=np.uint64)
    padded = np.concatenate([words, np.zeros(WORDS, dtype=np.uint64)])
    for k in range(WORDS):
        value += np.where(~short | (counts[text] > k), padded[at + k], np.uint64(0)) * _PLACE[k]
    value = mix(value + np.where(short, counts[text].astype(np.uint64), np.uint64(WORDS)))
    order = np.argsort(value, kind="stable")
    order = order[np.argsort(text[order], kind="stable")]
    value, text = value[order], text[order]
    new = np.concatenate([[True], (value[1:] != value[:-1]) | (text[1:] != text[:-1])])
    return value[new], np.bincount(text[new], minlength=len(texts))


def sketches(values: np.ndarray, sizes: np.ndarray, seeds: np.ndarray, roots: int) -> tuple[np.ndarray, np.ndarray]:
    """One row per set: 16 bits of the minwise hash for each seed, and all 64 for the first ``roots`` seeds (empty sets: 0)."""
    out = np.zeros((len(sizes), len(seeds)), dtype=np.uint16)
    keys = np.zeros((len(sizes), roots), dtype=np.int64)
    full = np.flatnonzero(sizes)
    if len(full):
        first = (np.cumsum(sizes) - sizes)[full]
        for j, seed in enumerate(seeds):
            scrambled = (values ^ seed) * np.uint64(0xD6E8_FEB8_6659_FD93)
            scrambled ^= scrambled >> np.uint64(32)
            scrambled *= np.uint64(0xCA5A_8263_9512_1157)
            least = mix(np.minimum.reduceat(scrambled, first) + np.uint64(j))
            out[full, j] = (least >> np.uint64(48)).astype(np.uint16)
            if j < roots:
                keys[full, j] = least.view(np.int64)
    return out, keys


def set_keys(values: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit digests of each set."""
    out = []
    for salt in (0x1234_5678_9ABC_DEF1, 0x0FED_CBA9_8765_4321):
        total = np.zeros(len(sizes), dtype=np.uint64)
        full = np.flatnonzero(sizes)
        if len(full):
            total[full] = np.add.reduceat(mix(values ^ np.uint64(salt)), (np.cumsum(sizes) - sizes)[full])
        out.append(total.view(np.int64))
    return out[0], out[1]


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted distinct arrays."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    return int((b[np.minimum(at, len(b) - 1)] == a).sum())
