"""Words and word hashes of many texts at once, by array arithmetic over their bytes.

A record batch is cut into slices of whole texts, about ``SLICE_BYTES`` each (a longer text
is a slice of its own), so memory follows the slice and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_MASK = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [2**64 - 1], dtype=np.uint64)
_A, _B, _C = (np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15))
_30, _27, _31, _23 = (np.uint64(x) for x in (30, 27, 31, 23))


def byte_class(chars: bytes) -> np.ndarray:
    """Truth per byte value."""
    table = np.zeros(256, dtype=bool)
    table[list(chars)] = True
    return table


WHITE = byte_class(b" \t\n\v\f\r")
#: ASCII that is neither a lower-case letter nor a digit.
NOT_ALNUM = byte_class(bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the 64 bits of the result; one to one."""
    x = x ^ (x >> _30)
    x *= _A
    x ^= x >> _27
    x *= _B
    x ^= x >> _31
    return x


def chain(acc: np.ndarray, nxt: np.ndarray) -> np.ndarray:
    """Ordered combination of hashes."""
    acc = (acc ^ nxt) * _C
    acc ^= acc >> _23
    return acc


@dataclass
class Slice:
    """Texts ``lo`` to ``hi`` of a batch: their bytes and where each begins."""

    lo: int
    hi: int
    data: np.ndarray
    offsets: np.ndarray

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if pa.types.is_null(texts.type):
        texts = texts.cast(pa.string())
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    if len(texts) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)
    at = at[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    data, offsets = text_buffer(texts)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n, lo + 20_000)
        yield Slice(lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        lo = hi


@dataclass
class Words:
    """Words of a slice: byte bounds, the first word of each text, and the text of each word."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def find_words(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray) -> Words:
    """Longest runs of bytes outside ``separator``, never across two texts."""
    inside = ~separator[data]
    size = len(data)
    before = np.zeros(size, dtype=bool)
    before[1:] = inside[:-1]
    after = np.zeros(size, dtype=bool)
    after[:-1] = inside[1:]
    edges = offsets[1:-1]
    before[edges[edges < size]] = False
    after[edges[edges > 0] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    return Words(start, end, np.searchsorted(start, offsets))


def _blocks(part: np.ndarray, number) -> np.ndarray:
    return mix(part ^ (np.asarray(number + 1, dtype=np.uint64) * _A))


def hash_words(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of every word: the sum of its hashed eight-byte blocks, mixed once more."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    left = end - start
    out = left.astype(np.uint64) * _C
    live, at = np.arange(len(start)), start
    for number in range(4):
        if not len(live):
            break
        out[live] += _blocks(eights[at] & _MASK[np.minimum(left, 8)], np.int64(number))
        more = left > 8
        live, at, left = live[more], at[more] + 8, left[more] - 8
    if len(live):  # the rest of long words, all blocks at once
        blocks = (left + 7) >> 3
        first = np.cumsum(blocks) - blocks
        number = np.arange(int(blocks.sum())) - np.repeat(first, blocks)
        part = eights[np.repeat(at, blocks) + 8 * number]
        part &= _MASK[np.minimum(np.repeat(left, blocks) - 8 * number, 8)]
        out[live] += np.add.reduceat(_blocks(part, number + 4), first)
    return mix(out)


def hash_bytes(items: list[bytes]) -> np.ndarray:
    """The same hash for separate byte strings."""
    ends = np.cumsum([len(x) for x in items], dtype=np.int64)
    data = np.frombuffer(b"".join(items), dtype=np.uint8)
    return hash_words(data, np.concatenate([[0], ends[:-1]]).astype(np.int64), ends)


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` words, at its first word; runs across texts are included."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    acc = np.full(n, np.uint64(width))
    for j in range(width):
        acc = chain(acc, hashes[j : j + n])
    return mix(acc)


def within(owner: np.ndarray, width: int) -> np.ndarray:
    """Whether the run of ``width`` words from each word stays in one text."""
    n = len(owner) - width + 1
    return owner[:n] == owner[width - 1 :] if n > 0 else np.zeros(0, bool)


def covered(starts: np.ndarray, width: int, size: int) -> np.ndarray:
    """Truth per word: inside a run of ``width`` words from one of ``starts``."""
    step = np.zeros(size + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, np.minimum(starts + width, size), -1)
    return np.cumsum(step[:-1]) > 0
