"""Hashed character n-grams and words of many texts at once, as numpy arrays of bucket numbers."""

import re

import numpy as np

#: Characters that are worked on at once. Longer texts are cut at white space into pieces; each is read on into the next one, so that
#: what spans a cut counts once and whole. Memory grows with the longest run without white space.
LIMIT = 1 << 20
#: Longest n-gram.
TAIL = 8
_SPACE, _NEXT_WORD = re.compile("[\x00-\x20]"), re.compile("[\x00-\x20]*[^\x00-\x20]+")
_B = 0x9E3779B97F4A7C15
_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS["up"]) < n:
        for name, base in (("up", _B), ("down", pow(_B, -1, 1 << 64))):
            p = np.full(max(n, 1 << 16), base, np.uint64)
            p[0] = 1
            _POWERS[name] = np.cumprod(p, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


def blocks(texts):
    """(code points, starts, ends, owns, row numbers) of pieces of the texts; a line feed stands after each piece. What starts at owns or
    later belongs to the next piece of the text."""
    codes, owns, rows, total = [], [], [], 0
    for row, text in enumerate(texts):
        i, size = 0, len(text or "")
        while i < size:
            cut = _SPACE.search(text, i + LIMIT) if size - i > LIMIT else None
            own = stop = cut.start() if cut else size
            if cut:
                word = _NEXT_WORD.match(text, own)
                stop = max(word.end() if word else size, min(size, own + TAIL))
            codes.append(np.frombuffer((text[i:stop] + "\n").encode("utf-32-le", "surrogatepass"), np.uint32))
            owns.append(own - i)
            rows.append(row)
            total += len(codes[-1])
            i = own
            if total > LIMIT:
                yield _block(codes, owns, rows)
                codes, owns, rows, total = [], [], [], 0
    if rows:
        yield _block(codes, owns, rows)


def _block(codes, owns, rows):
    ends = np.cumsum([len(c) for c in codes])
    starts = np.r_[0, ends[:-1]]
    return np.concatenate(codes).astype(np.uint64), starts, ends, starts + np.array(owns), np.array(rows)


def gram_counts(starts, ends, owns, n: int) -> np.ndarray:
    """n-grams that start in each piece's own part."""
    return np.maximum(np.minimum(ends - n, owns) - starts, 0)


def gram_buckets(codes, starts, ends, owns, n: int, bits: int) -> np.ndarray:
    """Bucket of the n-gram that starts at each place; 2 ** bits where it would reach the line feed after its piece, or belongs to the next."""
    size = len(codes)
    g = np.zeros(size, np.uint64)
    for k in range(min(n, size)):
        g[: size - k] += codes[k:] * np.uint64(pow(_B, 2 * k + n, 1 << 64))
    out = ((g ^ (g >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - bits)).astype(np.int32)
    for k in range(n):
        out[np.maximum(ends - 1 - k, starts)] = 1 << bits
    for i in np.flatnonzero(owns < ends - 1):
        out[owns[i] : ends[i]] = 1 << bits
    return out


def word_buckets(codes, ends, owns, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(start place, bucket) of each run of characters above U+0020; bucket 0 is for no word but stands, once more, for each word
    that repeats the word before it."""
    up, down = _powers(len(codes) + 1)
    ink = np.r_[False, codes > 32, False]
    start, end = np.flatnonzero(ink[1:] & ~ink[:-1]), np.flatnonzero(~ink[1:] & ink[:-1])
    total = np.r_[np.zeros(1, np.uint64), np.cumsum((codes + np.uint64(1)) * up[: len(codes)], dtype=np.uint64)]
    h = (total[end] - total[start]) * down[start]
    bucket = np.maximum((h ^ (h >> np.uint64(32))) * np.uint64(0xA0761D6478BD642F) >> np.uint64(64 - bits), np.uint64(1)).astype(np.int32)
    piece = np.searchsorted(ends, start, "right")
    own = start < owns[piece]
    again = start[1:][(h[1:] == h[:-1]) & (piece[1:] == piece[:-1]) & own[:-1]]
    return np.r_[start[own], again], np.r_[bucket[own], np.zeros(len(again), np.int32)]


def sums(texts: list, tables: list[np.ndarray], grams: tuple[int, ...], word_tables: list[np.ndarray] | None, bits: int):
    """(sum of table values over the features of each text, number of features), one column per table. A table has 2 ** bits
    values and a last zero."""
    total, count = np.zeros((len(texts), len(tables))), np.zeros(len(texts))
    for codes, starts, ends, owns, rows in blocks(texts):
        for n in grams:
            at = gram_buckets(codes, starts, ends, owns, n, bits)
            for i, t in enumerate(tables):
                np.add.at(total[:, i], rows, np.add.reduceat(t[at], starts, dtype=np.float64))
            np.add.at(count, rows, gram_counts(starts, ends, owns, n))
        if word_tables:
            start, at = word_buckets(codes, ends, owns, bits)
            row = rows[np.searchsorted(ends, start, "right")]
            np.add.at(count, row, 1)
            for i, t in enumerate(word_tables):
                total[:, i] += np.bincount(row, t[at], len(texts))
    return total, count
