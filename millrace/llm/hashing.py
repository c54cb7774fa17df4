"""Vectorised word and window hashes. Everything is 64-bit and depends on content only."""

from functools import cache

import numpy as np
import xxhash

#: Longer texts are cut at white space into pieces of about so many bytes while they are hashed, to bound memory.
PIECE = 4 << 20
_SPACE = b" \t\n\r\x0b\x0c"


def pieces(data: bytes):
    """Consecutive parts of the text, cut only at ASCII white space."""
    start = 0
    while len(data) - start > PIECE:
        end = start + PIECE
        while end < len(data) and data[end] not in _SPACE:
            end += 1
        yield data[start:end]
        start = end
    yield data[start:]


def word_hashes(data: bytes) -> np.ndarray:
    """Hashes of the words [^\\x20\\x09-\\x0D]+ of UTF-8 text; bytes.split() splits at exactly these six characters."""
    parts = []
    for piece in pieces(data):
        words = piece.split()
        parts.append(np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)))
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads all bits (xor-shift and multiply)."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


@cache
def _factors(width: int) -> np.ndarray:
    return np.random.default_rng(width).integers(1, 2**63, width, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def window_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of width consecutive word hashes, in order; empty where there are fewer words."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    odd = _factors(width)
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total += h[k : n + k] * odd[k]
    return mixed(total)
