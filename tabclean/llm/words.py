"""Words and word shingles of whole texts, as 64-bit hashes."""

from __future__ import annotations

import numpy as np
from xxhash import xxh3_64_intdigest

#: The pattern of a word, for SQL; `bytes.split` cuts at the same six bytes.
WORD = r"[^\x20\x09-\x0D]+"


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every input bit over all 64 bits; a bijection."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def odd_constants(n: int, seed: int = 1) -> np.ndarray:
    """`n` odd multipliers without any linear relation, so that sums of products don't coincide."""
    return mixed(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 20)) | np.uint64(1)


def words(text: bytes | None) -> list[bytes]:
    """Words with A-Z in lower case; `bytes.lower` leaves all other letters as they are."""
    return text.lower().split() if text else []


def word_hashes(found: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxh3_64_intdigest, found), np.uint64, len(found))


def shingle_set(text: bytes | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of `size` words; of the whole sequence if there are fewer words."""
    hashes = word_hashes(words(text))
    if not len(hashes):
        return hashes
    width = min(size, len(hashes))
    at, last = odd_constants(width, 1000 + width), len(hashes) - width + 1
    total = hashes[:last] * at[0]
    for i in range(1, width):
        total += hashes[i : last + i] * at[i]
    return np.unique(mixed(total))
