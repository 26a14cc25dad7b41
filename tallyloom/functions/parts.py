"""Keys of the parts of texts, by which texts that contain one another meet."""

from collections.abc import Iterator

import numpy as np

#: Parts are counted in so many buckets by length; texts are taken about so many characters at a time.
BUCKET_BITS, CHUNK_CHARS = 18, 1_000_000

_MIX, _NEXT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def lengths(size: int) -> tuple[int, ...]:
    return size, 2 * size, 4 * size


def chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    start = chars = 0
    for k, t in enumerate(texts):
        chars += len(t)
        if chars >= CHUNK_CHARS or k + 1 == len(texts):
            yield start, k + 1
            start, chars = k + 1, 0


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(29))


def keys(texts: list[str], size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each of the lengths: the keys of all parts of that many characters, and the number of the text of each, in order."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    long = np.array([len(t) for t in texts], np.int64)
    owner = np.repeat(np.arange(len(texts)), long)
    left = np.repeat(np.cumsum(long), long) - np.arange(len(points))  # characters from here to the end of the text
    h, n = np.zeros(max(len(points) - size + 1, 0), np.uint64), size
    for k in range(size):
        h = h * _NEXT + points[k : k + len(h)] + np.uint64(1)
    for length in lengths(size):
        if length > n:
            width = max(len(h) - n, 0)
            h, n = _mixed(h[:width]) * _NEXT + h[n : n + width], length
        fits = left[: len(h)] >= length
        yield _mixed(h[fits] + np.uint64(length)), owner[: len(h)][fits]


def buckets(found: np.ndarray) -> np.ndarray:
    return (found >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def rarest(texts: list[str], size: int, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The key of one of each text's longest parts that fits into it, the one in the bucket with the least count, and the text's number. counts: by length and bucket. Texts with a part in a bucket without any are out."""
    best, there, fit = np.zeros(len(texts), np.uint64), np.ones(len(texts), bool), np.zeros(len(texts), bool)
    for (found, owner), count in zip(keys(texts, size), counts, strict=True):
        if not len(found):
            continue
        often = count[buckets(found)]
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        least = np.minimum.reduceat(often, starts)
        own, first = np.unique(owner[often == np.repeat(least, np.diff(np.r_[starts, len(owner)]))], return_index=True)
        best[own] = found[often == np.repeat(least, np.diff(np.r_[starts, len(owner)]))][first]
        there[own] &= least > 0
        fit[own] = True
    at = np.flatnonzero(there & fit)
    return best[at], at
