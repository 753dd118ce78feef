"""Byte-level BPE encoding and decoding.

Two tiers: a minimal perfect hash resolves whole pre-tokens that are in the vocabulary; for the others a heap of
candidate merges runs over the bytes as a linked list, lowest rank first and leftmost among equals.

Cases: a null or empty text has no ids (``ids`` is empty bytes) and decodes to empty bytes. Null ``ids`` decode to
empty bytes; an id outside the vocabulary raises. Texts of any length are encoded whole: a pre-token of n bytes costs
O(n log n). Rows are independent, so ties and repeated rows change nothing; all other columns pass through, and a
column that already has the output's name, in whatever case, is replaced. An empty table gives an empty table.
"""

from __future__ import annotations

import base64
import heapq
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from public_tokenizers import PATTERN
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .tokens import UnitEncoder, kept, spaced_units

_MASK = (1 << 64) - 1


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank from a file of ``base64 rank`` lines."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class PerfectHash:
    """Minimal perfect hash of byte strings by hash and displace.

    Keys fall into buckets; buckets are placed from the largest to the smallest, each with the first displacement that
    sends all its keys to free slots. Buckets of one key take a free slot directly, kept as a negative displacement.
    As many slots as keys, one probe for each lookup.
    """

    def __init__(self, items: dict[bytes, int]):
        n = max(1, len(items))
        self.n, self.buckets = n, n // 2 + 1
        grouped: dict[int, list[tuple[int, bytes]]] = {}
        for key in items:
            h = xxhash.xxh3_64_intdigest(key)
            grouped.setdefault(h % self.buckets, []).append((h, key))
        self.displacement = [0] * self.buckets
        self.keys: list[bytes | None] = [None] * n
        self.values = [-1] * n
        order = sorted(grouped, key=lambda b: (-len(grouped[b]), b))
        free = n - 1
        for b in order:
            members = grouped[b]
            if len(members) == 1:
                while self.keys[free] is not None:
                    free -= 1
                slots, d = [free], -free - 1
            else:
                d = 0
                while True:
                    slots = [self._slot(h, d) for h, _ in members]
                    if len(set(slots)) == len(slots) and all(self.keys[s] is None for s in slots):
                        break
                    d += 1
            self.displacement[b] = d
            for s, (_, key) in zip(slots, members, strict=True):
                self.keys[s], self.values[s] = key, items[key]

    def _slot(self, h: int, d: int) -> int:
        return (((h ^ (d * 0x9E3779B97F4A7C15)) * 0xD6E8FEB86659FD93 & _MASK) >> 20) % self.n

    def get(self, key: bytes) -> int:
        """The key's value, or -1: the slot's own key decides, so no foreign key is taken for a member."""
        h = xxhash.xxh3_64_intdigest(key)
        d = self.displacement[h % self.buckets]
        s = -d - 1 if d < 0 else self._slot(h, d)
        return self.values[s] if self.keys[s] == key else -1


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token by repeatedly merging the neighbouring pair of lowest rank, leftmost first."""
    n = len(piece)
    get = ranks.get
    if n == 1:
        return [ranks[piece]]
    after = list(range(1, n + 1))  # start of the next part, which is the end of this one; 0 once merged into another
    before = list(range(-1, n - 1))
    bits = n.bit_length()
    mask = (1 << bits) - 1
    heap = []  # rank, start and end of a candidate in one integer
    for i in range(n - 1):
        r = get(piece[i : i + 2])
        if r is not None:
            heap.append((r << bits | i) << bits | i + 2)
    heapq.heapify(heap)
    pop, push = heapq.heappop, heapq.heappush
    while heap:
        x = pop(heap)
        i, end = x >> bits & mask, x & mask
        j = after[i]
        if not j or j >= n or after[j] != end:
            continue  # one of the two parts has grown or gone since
        after[j], after[i] = 0, end
        if end < n:
            before[end] = i
            k = after[end]
            r = get(piece[i:k])
            if r is not None:
                push(heap, (r << bits | i) << bits | k)
        p = before[i]
        if p >= 0:
            r = get(piece[p:end])
            if r is not None:
                push(heap, (r << bits | p) << bits | end)
    out, i = [], 0
    while i < n:
        k = after[i]
        out.append(ranks[piece[i:k]])
        i = k
    return out


class Encoder:
    """Encodes texts to ids as little-endian unsigned 32-bit integers in one byte string."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN, table: PerfectHash | None = None):
        self.ranks = ranks
        self.table = table or PerfectHash(ranks)
        self.find = regex.compile(pattern).findall
        self.units = UnitEncoder(spaced_units, lambda texts: [self._cut(t) for t in texts], bound=300_000)

    def _cut(self, text: str) -> bytes:
        ids: list[int] = []
        for token in self.find(text):
            raw = token.encode("utf-8", "surrogatepass")
            rank = self.table.get(raw)
            if rank >= 0:
                ids.append(rank)
            else:
                ids += merge_bytes(raw, self.ranks)
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, texts: list[str]) -> list[bytes]:
        return self.units.encode(texts)


def _with(schema: T.StructType, name: str) -> T.StructType:
    return T.StructType([f for f in schema.fields if f.name.lower() != name.lower()] + [T.StructField(name, T.BinaryType())])


def _replaced(batch: pa.RecordBatch, name: str, column: list, without: str = "") -> pa.RecordBatch:
    keep = [i for i, c in enumerate(batch.schema.names) if c.lower() != name.lower() and c != without]
    return pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), pa.array(column, pa.binary())], names=[*(batch.schema.names[i] for i in keep), name])


def _small(batches: Iterable[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)


def encode(df: DataFrame, ranks_path: str, text_col: str = "text", ids_col: str = "ids", pattern: str = PATTERN, keep_text: bool = True) -> DataFrame:
    """Adds ``ids_col``: the ids of ``text_col`` as little-endian unsigned 32-bit integers in one binary value.

    The vocabulary (a fixed-size file) and its perfect hash are broadcast. ``keep_text`` false leaves the text out.
    """
    ranks = load_ranks(ranks_path)
    shared = df.sparkSession.sparkContext.broadcast((ranks, PerfectHash(ranks)))
    schema = _with(df.schema, ids_col)
    if not keep_text:
        schema = T.StructType([f for f in schema.fields if f.name != text_col])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept((ranks_path, pattern), lambda: Encoder(shared.value[0], pattern, shared.value[1]))
        for batch in _small(batches):
            texts = [t or "" for t in batch.column(batch.schema.get_field_index(text_col)).to_pylist()]
            yield _replaced(batch, ids_col, encoder.encode(texts), "" if keep_text else text_col)

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, ranks_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """Adds ``out_col``: the bytes that the ids in ``ids_col`` stand for."""
    tokens = sorted(load_ranks(ranks_path).items(), key=lambda x: x[1])
    shared = df.sparkSession.sparkContext.broadcast([k for k, _ in tokens] if [v for _, v in tokens] == list(range(len(tokens))) else {v: k for k, v in tokens})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = shared.value.__getitem__
        for batch in _small(batches):
            column = batch.column(batch.schema.get_field_index(ids_col)).to_pylist()
            yield _replaced(batch, out_col, [b"".join(map(get, np.frombuffer(v or b"", "<u4").tolist())) for v in column])

    return df.mapInArrow(run, _with(df.schema, out_col))
