"""Words of whole texts as numbers: ASCII white space separates, everything else is a word."""

from __future__ import annotations

import numpy as np
import xxhash

_MIX = np.uint64(0x9E3779B97F4A7C15)
_ODD = np.uint64(0xBF58476D1CE4E5B9)


def mix(values: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers, one to one."""
    x = values ^ (values >> np.uint64(30))
    x = x * _ODD
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """Words of a list of texts: a number per word, and where each text's words end."""

    def __init__(self, texts: list[bytes | None]):
        number: dict[bytes, int] = {}
        flat: list[int] = []
        counts = []
        for text in texts:
            words = text.split() if text else ()
            counts.append(len(words))
            flat += [number.setdefault(w, len(number)) for w in words]
        self.vocabulary = list(number)
        self.numbers = np.asarray(flat, dtype=np.int64)
        self.counts = np.asarray(counts, dtype=np.int64)
        self.ends = np.cumsum(self.counts)
        self.starts = self.ends - self.counts

    def hashes(self) -> np.ndarray:
        """A 64-bit hash per word, the same in every task."""
        own = np.asarray([xxhash.xxh3_64_intdigest(w) for w in self.vocabulary], dtype=np.uint64)
        return own[self.numbers] if len(own) else np.zeros(0, np.uint64)


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash for every `width` numbers in a row; element i covers i to i+width-1."""
    size = len(hashes) - width + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(size, dtype=np.uint64)
    for j in range(width):
        total = mix(total + _MIX) ^ hashes[j : j + size]
    return mix(total)


def owner(ends: np.ndarray, length: int) -> np.ndarray:
    """For each of `length` places, the item it belongs to, given where items end."""
    marks = np.zeros(length + 1, dtype=np.int64)
    np.add.at(marks, ends[ends <= length], 1)
    return np.cumsum(marks)[:length]
