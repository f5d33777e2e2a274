"""Word shingles of whole texts as sets of 64-bit hashes, vectorised over a text's bytes."""

from __future__ import annotations

import numpy as np

WORDS = 5

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (a public finaliser's shifts and multipliers)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: A random 64-bit value for each byte, capital letters A-Z like small ones.
_BYTE = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_BYTE[65:91] = _BYTE[97:123]


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, as long as the longest text so far."""

    up = np.ones(1, dtype=np.uint64)
    down = np.ones(1, dtype=np.uint64)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            n = max(n, 2 * len(cls.up), 1 << 16)
            cls.up, cls.down = (np.full(n, base, dtype=np.uint64) for base in (_BASE, pow(_BASE, -1, 1 << 64)))
            for powers in (cls.up, cls.down):
                powers[0] = 1
                np.cumprod(powers, out=powers)
        return cls.up, cls.down


def word_spans(between: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops of the runs of bytes that are not between words."""
    edge = np.diff(np.concatenate([[True], between, [True]]).astype(np.int8))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def word_hashes(text: str) -> np.ndarray:
    """A hash for each word [^\\x20\\x09-\\x0D]+ of the text, A-Z lower-cased, in order."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    if not len(raw):
        return np.empty(0, dtype=np.uint64)
    start, stop = word_spans(_SPACE[raw])
    up, down = _Powers.get(len(raw) + 1)
    total = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[raw] * up[: len(raw)], out=total[1:])
    return _mix((total[stop] - total[start]) * down[start] + (stop - start).astype(np.uint64))


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the runs of so many words; of a shorter text, one hash of its whole word sequence."""
    h = word_hashes(text or "")
    k = min(words, len(h))
    if not k:
        return h
    out = np.full(len(h) - k + 1, np.uint64(k * 0x632BE59BD9B4E019 & _MASK))
    for j in range(k):
        out = (out ^ h[j : len(h) - k + 1 + j]) * np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(32)
    return np.unique(_mix(out))
