"""Fixed 64-bit hashes of words and of runs of words, the same in every process."""

from __future__ import annotations

import hashlib

import numpy as np

from tidemark.llm.common import Memo, per_process

_MULTIPLIERS = np.random.default_rng(20).integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def hash64(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def word_hashes(words: list[bytes]) -> np.ndarray:
    memo = per_process("word_hashes", lambda: Memo(hash64))
    return np.fromiter(map(memo.__getitem__, words), np.int64, len(words)).view(np.uint64)


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of every run of ``width`` words (at most 64), in order."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, width, np.uint64)
    for j in range(width):
        out += hashes[j : j + n] * _MULTIPLIERS[j]
    out ^= out >> np.uint64(31)
    out *= np.uint64(0x9E3779B97F4A7C15)
    return out ^ (out >> np.uint64(29))
