"""Many 64-bit keys in one row: a packed exchange between texts and key ranges.

A task that would emit one row per key emits, for each range of the key space, one row with all
its distinct keys of that range, sorted and byte-transposed (the high bytes of sorted keys hardly
differ, so they compress well). Keys are well mixed hashes, so ranges are even, and a common key
costs one entry per task however often it occurs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import SparkSession


def pack(values: np.ndarray) -> bytes:
    """Bytes of an array, plane by plane."""
    width = values.dtype.itemsize
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, width).T.tobytes()


def unpack(raw: bytes, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(raw, np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


def range_bits(spark: SparkSession, times: int = 4) -> int:
    """Bits of the key that name a range: ``times`` ranges or more per shuffle partition.

    The number of shuffle partitions is what follows the size of the data.
    """
    n = times * int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(1, (n - 1).bit_length())


def ranges(keys: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """(range, its part of the sorted keys) for ranges that have keys."""
    edges = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    cut = np.append(np.searchsorted(keys, edges), len(keys))
    for part in np.flatnonzero(np.diff(cut)):
        yield int(part), slice(int(cut[part]), int(cut[part + 1]))


def summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted keys and the sum of their values."""
    if not len(keys):
        return keys, values
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(values, first)
