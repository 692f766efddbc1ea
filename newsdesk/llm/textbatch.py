"""Words, lines and rolling fingerprints of a whole Arrow batch of texts at once, in numpy.

A batch is one byte buffer with document offsets. A word is a run of bytes that are not ASCII white
space (space, tab, \\n, \\v, \\f, \\r); a NULL text is an empty one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
BASE = U64(0x9E3779B97F4A7C15)
BASE_INVERSE = U64(pow(int(BASE), -1, 1 << 64))
BYTE_VALUE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
PIECE = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit over the whole word."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _powers(base: U64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWER = {"up": _powers(BASE, PIECE + 1), "down": _powers(BASE_INVERSE, PIECE + 1)}


def power(which: str, n: int) -> np.ndarray:
    """At least n + 1 powers of the base ("up") or of its inverse ("down")."""
    if len(_POWER[which]) <= n:
        _POWER[which] = _powers(BASE if which == "up" else BASE_INVERSE, 2 * n + 1)
    return _POWER[which]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Polynomial prefix sums: the hash of data[a:b] is (p[b] - p[a]) * BASE ** -a."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUE[data] * power("up", len(data))[: len(data)], out=out[1:])
    return out


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mix((sums[ends] - sums[starts]) * power("down", len(sums))[starts] + (ends - starts).astype(np.uint64))


@dataclass
class Words:
    """Words of consecutive documents; word i of the batch is bytes starts[i]:ends[i]."""

    data: np.ndarray  # the bytes
    offsets: np.ndarray  # document d is data[offsets[d]:offsets[d + 1]]
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # words of document d are first[d]:first[d + 1]
    hashes: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)


def buffers(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and document offsets of an Arrow array of strings or binaries; a NULL is empty."""
    kind = pa.large_binary()
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).cast(kind) if pa.types.is_string(texts.type) else texts.cast(kind)
    if texts.null_count:
        texts = texts.fill_null(b"")
    _, ends, data = texts.buffers()
    offsets = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and len(offsets) else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0] if len(offsets) else np.zeros(1, np.int64)
    return (LOWER[raw] if lower else raw), offsets


def words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    gap = SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True  # a word ends with its document
    start = ~gap
    start[1:] &= gap[:-1] | edge[1:-1]
    end = ~gap
    if len(data):
        end[:-1] &= gap[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    first = np.searchsorted(starts, offsets)
    return Words(data, offsets, starts, ends, first, span_hashes(prefix_sums(data), starts, ends))


def pieces(texts: pa.Array, lower: bool = False):
    """(first row, Words) over slices of a batch of about PIECE bytes; a longer text is one slice."""
    data, offsets = buffers(texts, lower)
    row = 0
    while row < len(offsets) - 1:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + PIECE, "right")) - 1)
        yield row, words_of(data[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row])
        row = stop


def chained(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive words (length len - n + 1)."""
    m = max(0, len(hashes) - n + 1)
    out = np.zeros(m, np.uint64)
    for i in range(n):
        out = mix(out + hashes[i : i + m])
    return out
