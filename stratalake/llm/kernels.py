"""Vectorised text helpers (numpy over Arrow buffers) used inside Spark tasks.

Every helper takes the bytes of a slice of whole texts and the offsets of its documents, and works
on all of them at once; nothing here loops over characters in Python.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Bytes of text handled at a time; a longer single document is a slice of its own.
SLICE_BYTES = 1 << 20
SPACES = b" \t\n\x0b\x0c\r"
IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BASE = U64(0x9E3779B97F4A7C15)
_BASE_INV = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads 64-bit values evenly (splitmix64)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


BYTE_CODE = mix(np.arange(1, 257, dtype=U64) * U64(0xD1342543DE82EF95))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash base and of its inverse, kept between calls."""
    if len(_powers.get("up", ())) < n:
        for name, base in (("up", _BASE), ("down", _BASE_INV)):
            table = np.full(n, base, U64)
            table[0] = 1
            _powers[name] = np.multiply.accumulate(table)
    return _powers["up"][:n], _powers["down"][:n]


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of whole texts, about `limit` bytes at a time; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"") if texts.null_count else texts.cast(pa.large_binary())
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64, count=n + 1, offset=8 * texts.offset) if n else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8) if n else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield at, end, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def spans(keep: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of `keep`, cut at the documents' bounds."""
    n = len(keep)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.concatenate(([False], keep))
    after = np.concatenate((keep, [False]))
    starts = np.flatnonzero(after & (~before | edge))
    ends = np.flatnonzero(before & (~after | edge))
    return starts, ends


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, from differences of a rolling polynomial."""
    up, down = _power(len(data) + 1)
    total = np.zeros(len(data) + 1, U64)
    np.cumsum(BYTE_CODE[data] * up[:-1], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(U64))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the index of the first word of each document (with a closing total)."""
    starts, ends = spans(~IS_SPACE[data], offsets)
    return starts, ends, np.searchsorted(starts, offsets).astype(np.int64)


def owner(first: np.ndarray) -> np.ndarray:
    """The document of each item, where `first` has the first item of each document and a closing total."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def windows(codes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word windows and the index of each document's first one (with a closing total)."""
    n = len(codes)
    count = np.maximum(np.diff(first) - (k - 1), 0)
    total = np.zeros(max(n - k + 1, 0), U64)
    for j in range(k):
        total += codes[j : j + len(total)] * U64(2 * j * 0x51ED270B + 0x2545F4914F6CDD1D & (1 << 64) - 1)
    own = owner(first)
    inside = own[: len(total)] == own[k - 1 :] if n >= k else np.zeros(0, bool)
    return mix(total[inside]), np.concatenate(([0], np.cumsum(count)))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> list[np.ndarray]:
    """Each document's distinct k-word shingles of lower-cased (A-Z) words, as sorted hashes.

    With fewer than k words the whole sequence is the one shingle; without words there is none.
    """
    starts, ends, first = words(data, offsets)
    codes = span_hashes(LOWER[data], starts, ends)
    hashes, at = windows(codes, first, k)
    out = []
    for d in range(len(offsets) - 1):
        own = hashes[at[d] : at[d + 1]]
        n = first[d + 1] - first[d]
        if 0 < n < k:
            short = codes[first[d] : first[d + 1]]
            own = mix(np.array([np.sum(short * mix(np.arange(1, n + 1, dtype=U64) + U64(n << 8)))], U64))
        own = np.sort(own)
        out.append(own[np.concatenate(([True], own[1:] != own[:-1]))] if len(own) > 1 else own)
    return out
