"""Word shingles of texts as sorted arrays of 64-bit hashes, for use inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F

SHINGLE = 5
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64)
_EMPTY = np.zeros(0, np.uint64)
_KNOWN_WORDS = 500_000


class WordHashes(dict):
    """64-bit hash of a word, kept for words that were met; forgets all when it is full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _KNOWN_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def words_of(text: str | None) -> list[bytes]:
    """Words with A-Z in lower case. ``bytes`` methods know only ASCII letters and the six blanks."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def shingle_set(text: str | None, hashes: WordHashes, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes; a shorter text is one shingle; without words the set is empty.

    A shingle's hash is a sum of its word hashes times odd constants, so that shingles which differ
    in one word never collide before the final mixing, which is one to one.
    """
    words = words_of(text)
    n = len(words)
    if not n:
        return _EMPTY
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
    if n < size:
        total = (h * _MIX[:n]).sum(dtype=np.uint64, keepdims=True) + np.uint64(n)
    else:
        total = h[: n - size + 1] * _MIX[0]
        for k in range(1, size):
            total += h[k : n - size + 1 + k] * _MIX[k]
    total ^= total >> np.uint64(32)
    total *= _MIX[3]
    total ^= total >> np.uint64(29)
    return np.unique(total)


BIT_WORDS = 8
#: Columns of parity bits: 512 bins, dealt into words of 64.
BITS = [f"bits{k}" for k in range(BIT_WORDS)]
_DEAL = np.uint64(0xA0761D6478BD642F)


def parity_bits(shingles: np.ndarray) -> np.ndarray:
    """For each of 512 bins, whether it holds an odd number of the values of a set.

    Two sets differ in at least as many values as their bits differ, so bits can rule a link out, never miss one.
    """
    odd = np.bincount(((shingles * _DEAL) >> np.uint64(55)).astype(np.int64), minlength=64 * BIT_WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view("<i8")


def bits_allow(a: str, b: str, percent: int) -> Column:
    """Whether structs ``a`` and ``b`` with a size ``n`` and parity bits may be of sets that share ``percent`` of their union."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    differ = sum(F.bit_count(F.col(f"{a}.{w}").bitwiseXOR(F.col(f"{b}.{w}"))) for w in BITS)
    # |A - B| + |B - A| <= (100 - percent) / (100 + percent) * (n + m)
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & ((100 + percent) * differ <= (100 - percent) * (n + m))
