"""Hashed features of whole texts, vectorised over their bytes: words, their prefixes, and character n-grams."""

from __future__ import annotations

import numpy as np

from sitewise.llm.shingles import _mix, _Powers, word_spans

_RAW = _mix(np.arange(301, 557, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
_LOW = _RAW.copy()
_LOW[65:91] = _LOW[97:123]

#: Letters and digits; every byte of a character beyond ASCII counts as a letter's.
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def text_bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)


class _Hashes:
    """Hashes of any slices of a byte string, from running sums."""

    def __init__(self, raw: np.ndarray, values: np.ndarray):
        up, self.down = _Powers.get(len(raw) + 1)
        self.total = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum(values[raw] * up[: len(raw)], out=self.total[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return _mix((self.total[stop] - self.total[start]) * self.down[start] + (stop - start).astype(np.uint64))


def letter_words(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return word_spans(~_LETTER[raw])


def word_features(raw: np.ndarray, prefixes: tuple[int, ...] = (4, 5, 6)) -> np.ndarray:
    """Distinct 64-bit features: lower-cased words of letters and digits, and their prefixes of so many bytes where the word is longer."""
    if not len(raw):
        return np.empty(0, dtype=np.uint64)
    start, stop = letter_words(raw)
    hashes = _Hashes(raw, _LOW)
    found = [hashes.of(start, stop)]
    for n in prefixes:
        at = start[stop - start > n]
        found.append(hashes.of(at, at + n) ^ np.uint64(0x5851F42D4C957F2D))
    return np.unique(np.concatenate(found))


def subword_buckets(raw: np.ndarray, bits: int, grams: tuple[int, ...] = (1, 2, 3, 4)) -> np.ndarray:
    """Buckets, repeats included: words as they are, pairs of words, whether a word was among the few before it, and character n-grams.

    How a word relates to the words before it is a feature of its own, since hashed pairs alone can't say that words repeat.
    """
    if not len(raw):
        return np.empty(0, dtype=np.int64)
    start, stop = word_spans(_SPACE[raw])
    hashes = _Hashes(raw, _RAW)
    words = hashes.of(start, stop)
    found = [words, words[1:] * np.uint64(31) + words[:-1]]
    if len(words) > 4:
        again = sum((words[4:] == words[4 - k : -k]).astype(np.uint64) << np.uint64(k) for k in (1, 2, 3, 4))
        found.append(_mix(again + np.uint64(0xABCDEF)))
    for n in grams:
        if len(raw) >= n:
            at = np.arange(len(raw) - n + 1)
            found.append(hashes.of(at, at + n) ^ np.uint64(n))
    return (np.concatenate(found) >> np.uint64(64 - bits)).astype(np.int64)
