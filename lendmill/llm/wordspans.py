"""Words of many texts at once, as spans of bytes over Arrow buffers.

Texts stay the UTF-8 bytes that Arrow delivers; no Python string is made. The
separators are ASCII, so they never match inside a longer character.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from lendmill.llm.shipping import by_value

by_value(__name__)

_GAP = np.zeros(256, dtype=bool)
_GAP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: Bytes of text worked on at once; a longer text makes a slice of its own.
SLICE_BYTES = 1 << 20

#: Words longer than this are hashed one by one.
LONG_WORD = 64


@dataclass
class Words:
    """Words of a run of texts: ``starts``/``ends`` in ``data``; text i has words first[i]:first[i+1]."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and their offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):  # no chunk at all
        column = pa.array([], pa.large_string())
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``size`` bytes."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def spans(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Words of texts that lie end to end; no word reaches over a text's end."""
    offsets = offsets - offsets[0]
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(data, none, none, np.zeros(len(offsets), np.int64))
    gap = _GAP[data]
    before = np.empty_like(gap)
    before[0], before[1:] = True, gap[:-1]
    begins = offsets[:-1]
    before[begins[begins < len(data)]] = True
    after = np.empty_like(gap)
    after[-1], after[:-1] = True, gap[1:]
    stops = offsets[1:]
    after[stops[stops > 0] - 1] = True
    starts = np.flatnonzero(before & ~gap)
    ends = np.flatnonzero(after & ~gap) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


def mixed(x: np.ndarray) -> np.ndarray:
    """A fixed shuffle of 64 bits (the finalizer known as splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Rabin-Karp sums modulo 2**64: any run's hash from two running sums.

    A run's sum is divided by the power of its first place, which an odd base
    allows, so equal runs have equal hashes wherever they start.
    """

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            up = np.full(n, self.base, np.uint64)
            down = np.full(n, self.inverse, np.uint64)
            up[0] = down[0] = 1
            self.up, self.down = np.cumprod(up), np.cumprod(down)

    def runs(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        self._powers(len(values) + 1)
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.up[: len(values)], out=sums[1:])
        return (sums[ends] - sums[starts]) * self.down[starts]


_BYTES = Rolling(0x9E3779B97F4A7C15), Rolling(0xD1342543DE82EF95)


def word_hashes(w: Words) -> np.ndarray:
    """A 64-bit hash per word, the same wherever the word stands.

    Long texts are worked on in runs of words of about ``SLICE_BYTES``.
    """
    out = np.zeros(len(w.starts), np.uint64)
    length = w.ends - w.starts
    i = 0
    while i < len(out):
        j = max(i + 1, int(np.searchsorted(w.ends, w.starts[i] + SLICE_BYTES, "right")))
        begin = w.starts[i]
        if length[i] <= max(SLICE_BYTES, LONG_WORD):  # a longer one comes below
            values = w.data[begin : w.ends[j - 1]].astype(np.uint64) + np.uint64(1)
            one, two = (r.runs(values, w.starts[i:j] - begin, w.ends[i:j] - begin) for r in _BYTES)
            out[i:j] = mixed(mixed(one + length[i:j].astype(np.uint64)) ^ two)
        i = j
    for i in np.flatnonzero(length > LONG_WORD):
        out[i] = xxhash.xxh3_64_intdigest(w.data[w.starts[i] : w.ends[i]].tobytes())
    return out


def joined(w: Words, keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Kept words of each text joined by one space.

    Returns bytes, offsets per text, and where each kept word starts and ends.
    """
    chosen = np.arange(len(w.starts)) if keep is None else np.flatnonzero(keep)
    first = np.searchsorted(chosen, w.first)
    starts, ends = w.starts[chosen], w.ends[chosen]
    space = np.ones(len(chosen), np.int64)
    lasts = first[1:][first[1:] > first[:-1]] - 1
    space[lasts] = 0
    length = ends - starts
    out_end = np.cumsum(length + space)
    out_start = out_end - length - space
    total = int(out_end[-1]) if len(out_end) else 0
    source = np.arange(total) + np.repeat(starts - out_start, length + space)
    padded = np.append(w.data, np.uint8(0x20))
    out = padded[source]
    out[(out_end - 1)[space > 0]] = 0x20
    at = np.append(out_end - length - space, total)[first]
    return out, at, out_start, out_start + length


def as_strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Arrow strings over bytes and offsets."""
    if len(data) < 2**31 - 1:
        return pa.StringArray.from_buffers(
            len(offsets) - 1, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))
        )
    return pa.LargeStringArray.from_buffers(
        len(offsets) - 1, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))
    )
