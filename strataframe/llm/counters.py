"""Counters of fixed size over all rows, which tell the keys that too many rows may share."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .shingles import mix

#: There are 2**BITS counters, in blocks of 2**BLOCK_BITS.
BITS, BLOCK_BITS = 20, 16
#: A key is taken for long if its counter is above a part of all rows (one in so many), besides the least number.
PART = 1000


def counter_of(keys: np.ndarray) -> np.ndarray:
    return (mix(keys.view(np.uint64)) >> np.uint64(64 - BITS)).astype(np.int64)


def _packed(k: int, part: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"block": pa.array([k], pa.int32()), "counts": pa.array([zlib.compress(part.astype(np.uint64).tobytes(), 1)], pa.binary())})


def _unpacked(counts: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(counts), np.uint64)


def counters(lists: DataFrame) -> np.ndarray:
    """For each counter the number of keys that fall to it. lists: one column, arrays of longs."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << BITS, np.int64)
        for batch in batches:
            table += np.bincount(counter_of(batch.column(0).flatten().to_numpy(zero_copy_only=False)), minlength=1 << BITS)
        for k, part in enumerate(table.reshape(-1, 1 << BLOCK_BITS)):
            if part.any():
                yield _packed(k, part)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums[k] = sums.get(k, np.uint64(0)) + _unpacked(counts)
        for k, part in sums.items():
            yield _packed(k, part)

    blocks = lists.mapInArrow(fill, "block int, counts binary").repartition(1 << (BITS - BLOCK_BITS), "block").mapInArrow(add, "block int, counts binary")
    total = np.zeros((1 << (BITS - BLOCK_BITS), 1 << BLOCK_BITS), np.uint64)
    for row in blocks.toLocalIterator():  # 2**(BITS - BLOCK_BITS) rows
        total[row["block"]] += _unpacked(row["counts"])
    return total.reshape(-1)


def long_keys(lists: DataFrame, least: int) -> np.ndarray:
    """For each counter whether its keys may have more than ``least`` rows and more than one in ``PART`` of all."""
    table = counters(lists)
    return table > max(least, int(table.sum()) // PART)
