"""Vectorised 64-bit hashes of words, shingles and byte strings; all arithmetic is modulo 2**64."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

_FACTOR = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(_FACTOR, -1, 1 << 64)


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective scramble of 64-bit numbers (multiply and shift)."""
    x = x + np.uint64((salt * 0xD1B54A32D192ED03 + 0x632BE59BD9B4E019) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_CODES = mixed(np.arange(256, dtype=np.uint64), 1)


@lru_cache(maxsize=2)
def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(n: int, base: int = _FACTOR) -> np.ndarray:
    size = 1 << 21
    while size < n:
        size *= 2
    return _powers(size, base)[:n]


def prefix_hashes(codes: np.ndarray) -> np.ndarray:
    """h such that (h[j] - h[i]) * inverse**i is a hash of codes[i:j] that does not hang on i."""
    out = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * powers(len(codes)), out=out[1:])
    return out


def range_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    back = powers(len(prefix), INVERSE)
    return mixed((prefix[ends] - prefix[starts]) * back[starts])


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word (A-Z in lower case, parted by ASCII white space), and each text's word count."""
    space = _SPACE[raw]
    start = ~space
    start[1:] &= space[:-1]
    inner = offsets[:-1][offsets[:-1] < len(raw)]
    start[inner] = ~space[inner]
    starts = np.flatnonzero(start)
    # A word ends before the next white space or at its text's end.
    breaks = np.append(np.flatnonzero(space), len(raw))
    text = np.searchsorted(offsets, starts, side="right") - 1
    ends = np.minimum(breaks[np.searchsorted(breaks, starts)], offsets[text + 1])
    prefix = prefix_hashes(BYTE_CODES[_LOWER[raw]])
    return range_hashes(prefix, starts, ends), np.bincount(text, minlength=len(offsets) - 1)


def shingle_hashes(words: np.ndarray, counts: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every run of `size` words; a text of fewer words is one run."""
    text = np.repeat(np.arange(len(counts)), counts)
    first = np.cumsum(counts) - counts
    coded = [mixed(words, k + 2) for k in range(size)]
    n = len(words)
    runs = np.zeros(n, np.uint64)
    for k in range(size):
        runs[: max(n - k, 0)] += coded[k][k:]
    whole = np.arange(n) - first[text] + size <= counts[text]
    short = np.flatnonzero((counts > 0) & (counts < size))
    short_runs = np.zeros(len(short), np.uint64)
    for k in range(size - 1):
        has = counts[short] > k
        short_runs[has] += coded[k][first[short[has]] + k]
    short_runs += np.uint64(0x5851F42D4C957F2D) * counts[short].astype(np.uint64)
    return (
        mixed(np.concatenate([runs[whole], short_runs]), 9),
        np.concatenate([text[whole], short]),
    )


def bucket_bits(width: int) -> int:
    """Hash ranges are named by so many high bits: at least 256 ranges, and one for each shuffle partition."""
    return max(8, (width - 1).bit_length())


def packed(hashes: np.ndarray) -> bytes:
    """Seven low bytes of each; the bucket implies the eighth."""
    return np.ascontiguousarray(hashes.view(np.uint8).reshape(-1, 8)[:, :7]).tobytes()


def unpacked(data: bytes, bucket: int, bits: int) -> np.ndarray:
    low = np.frombuffer(data, np.uint8).reshape(-1, 7)
    out = np.empty((len(low), 8), np.uint8)
    out[:, :7], out[:, 7] = low, bucket >> (bits - 8)
    return out.view(np.uint64).ravel()


def stretches(ordered: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Each value of an ordered array with its first place and the place after its last."""
    if len(ordered):
        values, at = np.unique(ordered, return_index=True)
        yield from zip(values.tolist(), at.tolist(), [*at[1:].tolist(), len(ordered)], strict=True)
