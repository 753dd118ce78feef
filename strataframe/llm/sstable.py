"""Token ids in sorted-string-table shards.

A shard holds documents in ascending order of their identifier: prefix-compressed blocks of entries, a sparse index with
the first key of each block, a Bloom filter over the keys, and a footer of fixed size that says where these are. A
document is found by one Bloom test, a binary search in the index and a walk through one block.

File: magic; blocks; index; Bloom filter; footer. A block is a run of entries and their CRC-32; an entry is three
varints (bytes shared with the key before it, other key bytes, value bytes), the other key bytes and the value. A key is
one byte (0 for a null identifier, 1 otherwise) and the identifier as big-endian unsigned 64-bit integer with the sign
bit turned over, so that keys order as identifiers do, null first. A value is one byte for the width of an id (2 or 4)
and the ids, little-endian.

Cases: null or empty texts have only the end id. Repeated identifiers are entries with the same key, in the order of
a hash of their texts; a lookup gives all. Extra columns are not written. Texts of any length are one entry. An empty table gives
no shard. Shards are written under another name and moved, so a task that runs again replaces what it wrote.
"""

from __future__ import annotations

import os
import struct
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tokens import chunks, kept, library_encoder

MAGIC = b"STRASST1"
BLOCK_BYTES = 1 << 16
BLOOM_BITS_PER_KEY, BLOOM_PROBES = 10, 7
_FOOTER = struct.Struct("<QQQQQQI8s")  # index offset, index bytes, Bloom offset, Bloom bytes, entries, ids, CRC of both, magic


def key_of(identifier: int | None) -> bytes:
    return b"\0" * 9 if identifier is None else b"\1" + struct.pack(">Q", identifier + (1 << 63))


def identifier_of(key: bytes) -> int | None:
    return struct.unpack(">Q", key[1:])[0] - (1 << 63) if key[0] else None


def _varint(x: int) -> bytes:
    out = bytearray()
    while x > 127:
        out.append(x & 127 | 128)
        x >>= 7
    out.append(x)
    return bytes(out)


def _read_varint(data: bytes, at: int) -> tuple[int, int]:
    x = shift = 0
    while True:
        b = data[at]
        at += 1
        x |= (b & 127) << shift
        if b < 128:
            return x, at
        shift += 7


def _probes(key: bytes, bits: int) -> list[int]:
    h = xxhash.xxh3_128_intdigest(key)
    a, b = h & (1 << 64) - 1, h >> 64 | 1
    return [(a + i * b) % bits for i in range(BLOOM_PROBES)]


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), os.path.abspath(uri))


class Writer:
    """Writes one shard; keys must come in ascending order."""

    def __init__(self, uri: str, block_bytes: int = BLOCK_BYTES):
        self.fs, self.path = filesystem(uri)
        self.block_bytes = block_bytes
        self.fs.create_dir(os.path.dirname(self.path), recursive=True)
        self.temporary = f"{self.path}.partial-{os.getpid()}-{id(self):x}"
        self.file = self.fs.open_output_stream(self.temporary)
        self.file.write(MAGIC)
        self.at = len(MAGIC)
        self.block, self.index, self.keys = bytearray(), [], []
        self.first = self.last = b""
        self.first_id = self.ids = self.entries = 0

    def add(self, identifier: int | None, ids: np.ndarray) -> None:
        key = key_of(identifier)
        if key < self.last:
            raise ValueError("keys must ascend")
        if not self.block:
            self.first, self.first_id, shared = key, self.ids, 0
        else:
            shared = len(os.path.commonprefix([key, self.last]))
        wide = len(ids) and int(ids.max()) >= 1 << 16
        value = (b"\4" if wide else b"\2") + ids.astype("<u4" if wide else "<u2").tobytes()
        self.block += _varint(shared) + _varint(len(key) - shared) + _varint(len(value)) + key[shared:] + value
        if key != self.last or not self.entries:
            self.keys.append(key)
        self.last = key
        self.entries += 1
        self.ids += len(ids)
        if len(self.block) >= self.block_bytes:
            self._end_block()

    def _end_block(self) -> None:
        data = bytes(self.block) + struct.pack("<I", zlib.crc32(self.block))
        self.index.append(self.first + struct.pack("<QQQ", self.at, len(data), self.first_id))
        self.file.write(data)
        self.at += len(data)
        self.block.clear()

    def close(self) -> None:
        if self.block:
            self._end_block()
        bits = max(64, BLOOM_BITS_PER_KEY * len(self.keys) + 7 & ~7)
        bloom = bytearray(bits // 8)
        for key in self.keys:
            for p in _probes(key, bits):
                bloom[p >> 3] |= 1 << (p & 7)
        index = b"".join(self.index)
        self.file.write(index + bloom)
        self.file.write(_FOOTER.pack(self.at, len(index), self.at + len(index), len(bloom), self.entries, self.ids, zlib.crc32(index + bloom), MAGIC))
        self.file.close()
        self.fs.move(self.temporary, self.path)

    def abandon(self) -> None:
        self.file.close()
        self.fs.delete_file(self.temporary)


class Reader:
    """One shard: ``get`` by binary search, ``scan`` in order."""

    def __init__(self, uri: str):
        self.fs, self.path = filesystem(uri)
        self.file = self.fs.open_input_file(self.path)
        size = self.file.size()
        if size < len(MAGIC) + _FOOTER.size:
            raise ValueError(f"{uri}: too short")
        at, n, bloom_at, bloom_n, self.entries, self.ids, crc, magic = _FOOTER.unpack(self.file.read_at(_FOOTER.size, size - _FOOTER.size))
        if magic != MAGIC:
            raise ValueError(f"{uri}: not a shard")
        index, self.bloom = self.file.read_at(n, at), self.file.read_at(bloom_n, bloom_at)
        if zlib.crc32(index + self.bloom) != crc:
            raise ValueError(f"{uri}: index or filter damaged")
        rows = [index[i : i + 33] for i in range(0, n, 33)]
        self.firsts = [r[:9] for r in rows]
        self.blocks = [struct.unpack("<QQQ", r[9:]) for r in rows]

    def _block(self, k: int) -> Iterator[tuple[bytes, np.ndarray, int]]:
        at, n, start = self.blocks[k]
        data = self.file.read_at(n, at)
        if zlib.crc32(data[:-4]) != struct.unpack("<I", data[-4:])[0]:
            raise ValueError(f"{self.path}: block {k} damaged")
        i, key = 0, b""
        while i < n - 4:
            shared, i = _read_varint(data, i)
            own, i = _read_varint(data, i)
            size, i = _read_varint(data, i)
            key = key[:shared] + data[i : i + own]
            i += own
            ids = np.frombuffer(data[i + 1 : i + size], "<u4" if data[i] == 4 else "<u2")
            yield key, ids, start
            start += len(ids)
            i += size

    def get(self, identifier: int | None) -> list[tuple[int, np.ndarray]]:
        """(ids before it in the shard, its ids) of each document with this identifier."""
        key = key_of(identifier)
        if any(not self.bloom[p >> 3] >> (p & 7) & 1 for p in _probes(key, 8 * len(self.bloom))):
            return []
        found = []
        for k in range(max(0, bisect_left(self.firsts, key) - 1), len(self.blocks)):
            if self.firsts[k] > key:
                break
            found += [(start, ids) for own, ids, start in self._block(k) if own == key]
        return found

    def scan(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        for k in range(len(self.blocks)):
            for key, ids, start in self._block(k):
                yield identifier_of(key), start, ids

    def close(self) -> None:
        self.file.close()


def write(df: DataFrame, folder: str, tokenizer_path: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", spaces: str = "kept") -> list[tuple[str, int, int, int]]:
    """Encodes and writes all documents; gives (uri, entries, ids, ids of all shards before it) by ascending identifier.

    One entry of the list for each shard, of which there are as many as shuffle partitions.
    """
    ordered = df.select(F.col(id_col).cast("long").alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # the boundaries are sampled keys, which must be small; equal keys with equal texts stay together
    ordered = ordered.withColumn("h", F.xxhash64("text")).repartitionByRange(F.asc_nulls_first("key"), "h").sortWithinPartitions(F.asc_nulls_first("key"), "h").drop("h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept((tokenizer_path, spaces), lambda: library_encoder(tokenizer_path, spaces))
        part = TaskContext.get().partitionId()
        writer = None
        end = np.array([end_id], "<u4")
        try:
            for rows in chunks(batches, ["key", "text"], 1):
                if writer is None:
                    writer = Writer(f"{folder}/shard-{part:06d}.sst")
                for (key, _), ids in zip(rows, encoder.encode([t for _, t in rows]), strict=True):
                    writer.add(key, np.concatenate([np.frombuffer(ids, "<u4"), end]))
        except BaseException:
            if writer:
                writer.abandon()
            raise
        if writer:
            writer.close()
            yield pa.RecordBatch.from_pydict({"part": [part], "uri": [f"{folder}/shard-{part:06d}.sst"], "entries": [writer.entries], "ids": [writer.ids]})

    shards = sorted(ordered.mapInArrow(run, "part long, uri string, entries long, ids long").collect())
    out, before = [], 0
    for _, uri, entries, ids in shards:
        out.append((uri, entries, ids, before))
        before += ids
    return out


def read(spark: SparkSession, shards: list[tuple[str, int, int, int]], with_ids: bool = True) -> DataFrame:
    """Documents of the shards: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and, ``with_ids``, ids."""
    listed = spark.createDataFrame([(uri, before) for uri, _, _, before in shards], "uri string, before long").repartition(max(1, len(shards)))
    target = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())] + [("ids", pa.binary())] * with_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.to_pylist():
                reader = Reader(shard["uri"])
                rows, held = [], 0
                for key, start, ids in reader.scan():
                    raw = ids.astype("<u4").tobytes()
                    rows.append((key, shard["before"] + start, len(ids), zlib.crc32(raw), *[raw] * with_ids))
                    held += len(raw) if with_ids else 64
                    if held > 1 << 22:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), target, strict=True)], schema=target)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), target, strict=True)], schema=target)
                reader.close()

    return listed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids)
