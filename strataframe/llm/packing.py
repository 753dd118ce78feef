"""Packing documents into sequences of at most ``capacity`` tokens with little padding.

A document's ids are cut at multiples of the capacity; each full cut is a sequence of its own. The remainders are
gathered in blocks and put into windows by multiway Karmarkar-Karp differencing: each piece starts as a partial
partition with one filled part; the two partial partitions of largest spread are merged over and over, the fullest part
of one with the emptiest of the other. The window count rises whenever a window would exceed the capacity. So that the
differences can vanish, some pieces of each block are first cut into short ones, and one piece is cut where the block is
full; its rest opens the next block. What a partition has left at its end becomes sequences whose lengths are powers of
two and need no padding.

Cases: a null or empty text has only the end id. Documents of any length are cut, never shortened. Repeated rows are
packed as often as they come, in the order in which they come. Extra columns are left out of the result, whatever their
names. A null document id stays null. An empty table gives an empty table. Memory is bounded by one block of remainders.
Each input partition is packed alone, without a shuffle; sequence ids hold the partition in their upper bits and are unique.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import tidy
from .tokens import chunks, kept, library_encoder

CAPACITY = 2048
#: Distinct units of text that a worker remembers the ids of.
UNITS = 1_000_000
#: Windows in a full block.
WINDOWS = 128
#: Lengths of the short pieces; about one of each for every window.
SHORT = (64, 32, 16, 8, 4, 2, 1)


def differencing(lengths: list[int], k: int) -> list[list[int]]:
    """Multiway Karmarkar-Karp: positions of ``lengths`` in ``k`` parts with near-equal sums."""
    n = len(lengths)
    if not n:
        return [[] for _ in range(k)]
    if k == 1:
        return [list(range(n))]
    after = np.full(n, -1, np.int64)
    # a partial partition: sums in falling order, less the smallest; first and last item of each part's chain
    heap, counter = [], 0
    for i, x in enumerate(lengths):
        heap.append((-x, counter, i))
        counter += 1
    heapq.heapify(heap)

    def opened(p):
        if not isinstance(p, int):
            return p
        s, first, last = np.zeros(k, np.int64), np.full(k, -1, np.int64), np.full(k, -1, np.int64)
        s[0], first[0], last[0] = lengths[p], p, p
        return s, first, last

    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        if isinstance(b, int):  # one item goes to the emptiest part
            s, first, last = opened(a)
            s[k - 1] += lengths[b]
            if last[k - 1] >= 0:
                after[last[k - 1]] = b
            else:
                first[k - 1] = b
            last[k - 1] = b
        else:
            s, first, last = opened(a)
            t, other, end = (x[::-1] for x in b)
            s = s + t
            both = (last >= 0) & (other >= 0)
            after[last[both]] = other[both]
            first = np.where(first >= 0, first, other)
            last = np.where(other >= 0, end, last)
        order = np.argsort(-s, kind="stable")
        s = s[order]
        s = s - s[-1]
        heapq.heappush(heap, (-int(s[0]), counter, (s, first[order], last[order])))
        counter += 1
    _, first, _ = opened(heap[0][2])
    parts = []
    for i in first.tolist():
        part = []
        while i >= 0:
            part.append(i)
            i = int(after[i])
        parts.append(part)
    return parts


def windows(lengths: list[int], capacity: int, least: int) -> list[list[int]]:
    """Parts none of whose sums exceeds ``capacity``: ``least`` of them or as few more as differencing needs."""
    k = max(least, -(-sum(lengths) // capacity), 1)
    while True:
        parts = differencing(lengths, k)
        if all(sum(lengths[i] for i in part) <= capacity for part in parts):
            return [part for part in parts if part]
        k += 1


class Packer:
    """Takes documents one by one and gives pieces (document, start, length, sequence, offset)."""

    def __init__(self, capacity: int = CAPACITY, block: int = WINDOWS, first_sequence: int = 0):
        self.capacity, self.block, self.sequence = capacity, block, first_sequence
        self.pieces: list[tuple[object, int, int]] = []
        self.held = 0

    def add(self, document: object, tokens: int) -> Iterator[tuple[object, int, int, int, int]]:
        start = 0
        while tokens - start >= self.capacity:
            yield document, start, self.capacity, self.sequence, 0
            self.sequence += 1
            start += self.capacity
        if tokens > start:
            self.pieces.append((document, start, tokens - start))
            self.held += tokens - start
            target = self.block * self.capacity - self.block // 2
            if self.held >= target:
                yield from self._pack(self.block, target)

    def _take(self, tokens: int) -> list[tuple[object, int, int]]:
        """Pieces with ``tokens`` in all, the newest first; the last of them is cut."""
        taken, need = [], tokens
        while need:
            document, start, length = self.pieces.pop()
            if length > need:
                self.pieces.append((document, start + need, length - need))
                length = need
            taken.append((document, start, length))
            need -= length
        self.held -= tokens
        return taken

    def _pack(self, k: int, tokens: int) -> Iterator[tuple[object, int, int, int, int]]:
        taken = self._take(tokens)
        taken.sort(key=lambda p: p[2])
        short, budget = [], k * sum(SHORT)
        while budget > 0 and taken:  # cut mid-sized pieces; the largest and the smallest stay whole
            document, start, length = taken.pop(len(taken) // 2)
            budget -= length
            i = 0
            while length:
                x = min(SHORT[i % len(SHORT)], length)
                short.append((document, start, x))
                start, length, i = start + x, length - x, i + 1
        taken += short
        for part in windows([p[2] for p in taken], self.capacity, k):
            offset = 0
            for i in sorted(part, key=lambda i: taken[i][1]):
                document, start, length = taken[i]
                yield document, start, length, self.sequence, offset
                offset += length
            self.sequence += 1

    def close(self) -> Iterator[tuple[object, int, int, int, int]]:
        k = self.held // self.capacity
        if k:
            yield from self._pack(k, k * self.capacity - k // 2)
        while self.held:  # lengths that are powers of two
            offset, size = 0, min(self.capacity, 1 << (self.held.bit_length() - 1))
            for document, start, length in self._take(size):
                yield document, start, length, self.sequence, offset
                offset += length
            self.sequence += 1


def pack(df: DataFrame, tokenizer_path: str, end_id: int = 1, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """Pieces of all documents: id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, ``with_ids``, the ids themselves."""
    kind = df.schema[id_col].dataType
    fields = [T.StructField(id_col, kind)] + [T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
    schema = T.StructType(fields + [T.StructField("ids", T.BinaryType())] * with_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        encoder = kept((tokenizer_path, "dropped"), lambda: library_encoder(tokenizer_path, "dropped", UNITS))
        packer = Packer(capacity, first_sequence=TaskContext.get().partitionId() << 33)
        end = int(end_id).to_bytes(4, "little")
        out: list[tuple] = []

        def give(pieces) -> None:
            for (key, ids), start, length, sequence, offset in pieces:
                part = ids[4 * start : 4 * (start + length)]
                out.append((key, start, length, zlib.crc32(part), len(ids) // 4, sequence, offset, *[part] * with_ids))

        def flushed() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), target, strict=True)], schema=target)
            out.clear()
            return batch

        target = pa.schema([pa.field(id_col, _arrow(kind))] + [pa.field(f.name, pa.int64() if f.name != "ids" else pa.binary()) for f in schema.fields[1:]])
        for rows in chunks(batches, [id_col, text_col], 1):
            for (key, _), ids in zip(rows, encoder.encode([t or "" for _, t in rows]), strict=True):
                give(packer.add((key, ids + end), len(ids) // 4 + 1))
            if len(out) > 20_000 or with_ids and out:
                yield flushed()
        give(packer.close())
        if out:
            yield flushed()

    return df.select(id_col, text_col).mapInArrow(run, schema)


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)
