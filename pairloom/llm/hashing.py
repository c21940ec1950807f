"""Word and shingle hashes as numpy arrays, for use inside tasks."""

import ctypes
import functools
import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash

MASK = (1 << 64) - 1
# Odd 64-bit multipliers of a well-known mixing function (splitmix64).
MIX_A, MIX_B, STEP = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit permutation whose output bits all depend on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(MIX_A)
    x ^= x >> np.uint64(27)
    x *= np.uint64(MIX_B)
    x ^= x >> np.uint64(31)
    return x


_OTHERS = re.compile(r"[\W_]+")


def bare(token: str) -> str:
    """Lower-case letters and digits of a token."""
    low = token.lower()
    if not low.isascii():
        low = unicodedata.normalize("NFC", low)
    return low if low.isalnum() else _OTHERS.sub("", low)


class WordHashes(dict):
    """Hash of a token's letters and digits; 0 if it has none. Frequent tokens are looked up.

    The table stops growing at ``most`` tokens; others are then hashed each time.
    """

    def __init__(self, most: int = 400_000):
        self.most = most

    def __missing__(self, token: str) -> int:
        word = bare(token)
        value = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass")) or 1 if word else 0
        if len(self) < self.most:
            self[token] = value
        return value

    def of(self, text: str) -> np.ndarray:
        """Hashes of the words of a text, split at white space."""
        tokens = text.split()
        hashes = np.fromiter(map(self.__getitem__, tokens), np.uint64, len(tokens))
        return hashes[hashes != 0]


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total += hashes[k : k + n] * np.uint64((STEP * (2 * k + 1)) & MASK)
        total = (total << np.uint64(7)) | (total >> np.uint64(57))
    return mix(total)


def tidy(function: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``function`` over batches, that gives freed memory back to the system behind the last one.

    Spark reuses Python workers; what they keep for themselves is missing beside later stages that need none.
    """

    @functools.wraps(function)
    def run(batches: Iterator) -> Iterator:
        yield from function(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)

    return run
