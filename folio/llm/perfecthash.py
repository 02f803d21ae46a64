"""Minimal perfect hashes: each of n keys gets a number of its own below n, by a few bits a key and without the keys.

Level by level the keys that are left fall on twice as many bits; keys alone on their bit are settled there, the others go on to the next
level. The number of a key is the count of set bits before its own. (Limasset, Rizk, Chikhi and Peterlongo, 2017.)
"""

from __future__ import annotations

import hashlib

import numpy as np

from folio.llm.textbytes import U, mix

BITS_OF_KEY = 2
#: Keys left are halved and more from level to level; equal hashes, which would never part, have ended long before.
MOST_LEVELS = 200


def hashes(keys: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """128 bits of a key for its place, and 32 further ones that tell it from keys that are not in the index."""
    raw = b"".join(hashlib.blake2b(k.encode(), digest_size=20).digest() for k in keys)
    rows = np.frombuffer(raw, np.uint8).reshape(-1, 20)
    return *(np.ascontiguousarray(rows[:, a : a + 8]).view("<u8").ravel() for a in (0, 8)), np.ascontiguousarray(rows[:, 16:]).view("<u4").ravel()


def _bit(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(a + b * U(2 * level + 1)) % U(size)).astype(np.int64)


class PerfectHash:
    """sizes: bits of each level, a multiple of 64; words: all levels' bits; before: set bits before each word."""

    def __init__(self, sizes: list[int], words: np.ndarray) -> None:
        self.sizes, self.words = sizes, words
        counts = np.bitwise_count(words).astype(np.int64)
        self.before = np.cumsum(counts) - counts
        self.n = int(counts.sum())

    @classmethod
    def over(cls, a: np.ndarray, b: np.ndarray) -> PerfectHash:
        sizes, words = [], []
        while len(a):
            if len(sizes) == MOST_LEVELS:
                raise ValueError("keys with equal hashes")
            size = -(-len(a) * BITS_OF_KEY // 64) * 64
            at = _bit(a, b, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            words.append(np.packbits(alone, bitorder="little").view("<u8"))
            sizes.append(size)
            left = ~alone[at]
            a, b = a[left], b[left]
        return cls(sizes, np.concatenate(words) if words else np.zeros(0, np.uint64))

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Numbers of keys; -1 for some that were not there when it was built, any number for the others."""
        out, left, first = np.full(len(a), -1, np.int64), np.arange(len(a)), 0
        for level, size in enumerate(self.sizes):
            at = _bit(a[left], b[left], level, size)
            word, bit = first + at // 64, (at % 64).astype(np.uint64)
            found = (self.words[word] >> bit) & U(1) == 1
            w, s = word[found], bit[found]
            out[left[found]] = self.before[w] + np.bitwise_count(self.words[w] & ((U(1) << s) - U(1))).astype(np.int64)
            left, first = left[~found], first + size // 64
        return out
