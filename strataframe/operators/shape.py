"""What a frame looks like when nobody says: shape by codec size or by coherence, preview choice, and codec comparisons.

Frames come as rows (archive, raw BINARY) of a few frames each; every candidate shape of every frame is one row, scored
where it lies, so archives are worked on side by side.

Cases: null or empty bytes, odd lengths and frames with a header of their own (TIFF) have no candidates and give no row.
Equal scores: the shape with fewer rows. Empty tables give empty tables.
"""

from __future__ import annotations

import lzma
import time
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataframe.operators import codec
from strataframe.operators.frames import coherence_of, factor_pairs, residual

_SCORED = "archive string, rows int, cols int, score double"


def _candidates(raw: bytes | None, lowest: float, highest: float) -> list[tuple[int, int]]:
    return factor_pairs(len(raw) // 2, lowest, highest) if raw and len(raw) % 2 == 0 and raw[:2] not in (b"II", b"MM") else []


def _code_size(frame: np.ndarray) -> float:
    mask = int(np.bitwise_or.reduce(frame, axis=None))
    shift = (mask & -mask).bit_length() - 1 if mask else 0
    return float(len(codec.encode(frame >> shift)))


def _scored(frames: DataFrame, score: Callable[[np.ndarray], float], lowest: float, highest: float) -> DataFrame:
    out = pa.schema([("archive", pa.string()), ("rows", pa.int32()), ("cols", pa.int32()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for archive, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x = np.frombuffer(raw, "<u2") if raw else None
                rows += [{"archive": archive, "rows": r, "cols": c, "score": score(x.reshape(r, c))} for r, c in _candidates(raw, lowest, highest)]
            yield pa.RecordBatch.from_pylist(rows, schema=out)

    return frames.select("archive", "raw").mapInArrow(run, _SCORED)


def shape_by_codec_size(frames: DataFrame, lowest: float = 0.25, highest: float = 4.0) -> DataFrame:
    """(archive, rows, cols, bytes, margin, n_candidates): the shape of which the frames' codes are smallest; margin: the runner-up's size over it."""
    total = _scored(frames, _code_size, lowest, highest).groupBy("archive", "rows", "cols").agg(F.sum("score").alias("bytes"))
    best = total.groupBy("archive").agg(F.slice(F.sort_array(F.collect_list(F.struct("bytes", "rows", "cols"))), 1, 2).alias("b"), F.count("*").alias("n_candidates"))  # as many as a number has factors
    one, two = F.col("b")[0], F.get("b", F.lit(1))
    return best.select("archive", one["rows"].alias("rows"), one["cols"].alias("cols"), one["bytes"].cast("long").alias("bytes"), F.coalesce(two["bytes"] / one["bytes"], F.lit(float("inf"))).alias("margin"), "n_candidates")


def shape_by_coherence(frames: DataFrame, lowest: float = 0.25, highest: float = 4.0) -> DataFrame:
    """(archive, rows, cols, coherence, runner_up, margin): the shape whose adjacent rows agree best, on the mean over the frames."""
    mean = _scored(frames, coherence_of, lowest, highest).groupBy("archive", "rows", "cols").agg(F.avg("score").alias("coherence"))
    order = F.struct((-F.col("coherence")).alias("less"), "rows", "cols")
    best = mean.groupBy("archive").agg(F.slice(F.sort_array(F.collect_list(order)), 1, 2).alias("b"))
    one, two = F.col("b")[0], F.get("b", F.lit(1))
    return best.select("archive", one["rows"].alias("rows"), one["cols"].alias("cols"), (-one["less"]).alias("coherence"), (-two["less"]).alias("runner_up"), (two["less"] - one["less"]).alias("margin"))


def brightest(frames: DataFrame, keys: list[str], position: str, samples: str = "samples", percent: float = 99.0) -> DataFrame:
    """(keys, ``position``, score): the frame with the highest percentile (linear between ranks), the earliest of equal ones. Empty frames don't count."""
    s = F.sort_array(samples)
    at = (F.size(samples) - 1) * F.lit(percent / 100)
    low = F.floor(at).cast("int")
    value = F.get(s, low) + (F.get(s, F.least(low + 1, F.size(samples) - 1)) - F.get(s, low)) * (at - low)
    scored = frames.where(F.size(samples) > 0).select(*keys, position, value.cast("double").alias("score"))
    best = scored.groupBy(*keys).agg(F.max(F.struct("score", (-F.col(position)).alias("less"))).alias("m"))
    return best.select(*keys, (-F.col("m.less")).alias(position), F.col("m.score").alias("score"))


def _zlib(level: int) -> tuple[Callable, Callable]:
    return lambda b: zlib.compress(b, level), zlib.decompress


def _zstd(level: int) -> tuple[Callable, Callable]:
    return lambda b: zstandard.ZstdCompressor(level).compress(b), lambda b: zstandard.ZstdDecompressor().decompress(b)


#: Name -> (bytes of a frame to code, code to the same bytes).
CODECS: dict[str, tuple[Callable, Callable]] = {
    "zlib-6": _zlib(6),
    "zstd-3": _zstd(3),
    "zstd-19": _zstd(19),
    "lzma-1": (lambda b: lzma.compress(b, preset=1), lzma.decompress),
}


def compare_codecs(frames: DataFrame, names: tuple[str, ...] = ("zlib-6", "zstd-3", "lzma-1", codec.CODEC), planes: bool = False) -> DataFrame:
    """(codec, frames, raw_bytes, code_bytes, ratio, saved_percent, encode_mb_s, decode_mb_s) over frames (rows, cols, raw); each code is decoded and compared.

    planes: the general codecs get low and high bytes apart. Speeds are of one core.
    """
    out = pa.schema([("codec", pa.string()), ("raw", pa.int64()), ("code", pa.int64()), ("enc", pa.float64()), ("dec", pa.float64())])

    def one(name: str, raw: bytes, r: int, c: int) -> dict:
        x = np.frombuffer(raw, "<u2").reshape(r, c)
        if name == codec.CODEC:
            enc, dec = codec.encode, lambda b: codec.decode(b, r, c).astype("<u2").tobytes()
            given = x
        else:
            enc, back = CODECS[name]
            given = codec.byte_planes(x.reshape(-1)) if planes else raw
            dec = (lambda b: codec.from_byte_planes(back(b)).astype("<u2").tobytes()) if planes else back
        t0 = time.perf_counter()
        code = enc(given)
        t1 = time.perf_counter()
        same = dec(code) == raw
        t2 = time.perf_counter()
        if not same:
            raise codec.LosslessCheckFailed(f"{name} doesn't give a frame back")
        return {"codec": name, "raw": len(raw), "code": len(code), "enc": t1 - t0, "dec": t2 - t1}

    def run(batches):
        for b in batches:
            rows = [one(name, raw, r, c) for r, c, raw in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True) if raw for name in names]
            yield pa.RecordBatch.from_pylist(rows, schema=out)

    cells = frames.select("rows", "cols", "raw").mapInArrow(run, "codec string, raw long, code long, enc double, dec double")
    sums = cells.groupBy("codec").agg(F.count("*").alias("frames"), *[F.sum(c).alias(c) for c in ("raw", "code", "enc", "dec")])
    return sums.select("codec", "frames", F.col("raw").alias("raw_bytes"), F.col("code").alias("code_bytes"), (F.col("raw") / F.col("code")).alias("ratio"), (100 - 100 * F.col("code") / F.col("raw")).alias("saved_percent"), (F.col("raw") / 1e6 / F.greatest("enc", F.lit(1e-9))).alias("encode_mb_s"), (F.col("raw") / 1e6 / F.greatest("dec", F.lit(1e-9))).alias("decode_mb_s"))


def transform_sizes(frames: DataFrame, kinds: tuple[str, ...] = ("none", "horizontal", "block", "dc"), level: int = 3) -> DataFrame:
    """(kind, frames, code_bytes): how small zstd makes the byte planes of what each transform leaves of frames (rows, cols, raw)."""
    out = pa.schema([("kind", pa.string()), ("code", pa.int64())])

    def run(batches):
        for b in batches:
            rows = []
            for r, c, raw in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                x = np.frombuffer(raw or b"", "<u2")
                if x.size:
                    rows += [{"kind": k, "code": len(zstandard.ZstdCompressor(level).compress(codec.byte_planes((x.reshape(r, c) if k == "none" else residual(x.reshape(r, c), k)).reshape(-1))))} for k in kinds]
            yield pa.RecordBatch.from_pylist(rows, schema=out)

    return frames.select("rows", "cols", "raw").mapInArrow(run, "kind string, code long").groupBy("kind").agg(F.count("*").alias("frames"), F.sum("code").alias("code_bytes"))


def redundancy(headers: DataFrame, keys: list[str], position: str, header: str = "header") -> DataFrame:
    """(keys, n, bytes, zlib_bytes, mean_differing): how much of headers repeats: their size alone and compressed one after another in
    blocks of 1,000, and how many bytes differ from the header before in a block."""
    block = F.floor(F.col(position) / 1000)
    out = pa.schema([("n", pa.int64()), ("bytes", pa.int64()), ("z", pa.int64()), ("differ", pa.int64()), ("pairs", pa.int64())])
    packed = headers.where(F.col(header).isNotNull()).groupBy(*keys, block.alias("_block")).agg(F.sort_array(F.collect_list(F.struct(F.col(position).alias("at"), F.col(header).alias("h")))).alias("_h"))  # 1,000 at most
    kinds = {k: headers.schema[k].dataType.simpleString() for k in keys}

    def run(batches):
        for b in batches:
            cells = []
            for row in b.column(len(keys)).to_pylist():
                h = [x["h"] for x in row]
                differ = sum(int((np.frombuffer(a, np.uint8)[:n] != np.frombuffer(c, np.uint8)[:n]).sum()) + abs(len(a) - len(c)) for a, c in zip(h, h[1:], strict=False) for n in [min(len(a), len(c))])
                cells.append({"n": len(h), "bytes": sum(map(len, h)), "z": len(zlib.compress(b"".join(h), 9)), "differ": differ, "pairs": len(h) - 1})
            made = pa.RecordBatch.from_pylist(cells, schema=out)
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in range(len(keys))), *made.columns], names=[*keys, *out.names])

    rows = packed.select(*keys, "_h").mapInArrow(run, ", ".join([*(f"`{k}` {t}" for k, t in kinds.items()), "n long, bytes long, z long, differ long, pairs long"]))
    return rows.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), F.sum("z").alias("zlib_bytes"), (F.sum("differ") / F.nullif(F.sum("pairs"), F.lit(0))).alias("mean_differing"))


def pack_channels(x: np.ndarray, level: int = 6) -> bytes:
    """One chunk of a multichannel recording (samples x channels, int16): differences in time modulo 2^16, then zlib."""
    d = np.diff(x.astype(np.int16).view(np.uint16), axis=0, prepend=np.zeros((1, x.shape[1]), np.uint16))
    return zlib.compress(d.T.astype("<u2").tobytes(), level)


def unpack_channels(code: bytes, channels: int) -> np.ndarray:
    d = np.frombuffer(zlib.decompress(code), "<u2").reshape(channels, -1).T
    return np.cumsum(d, axis=0, dtype=np.uint16).view(np.int16)


def compress_chunks(chunks: DataFrame) -> DataFrame:
    """Adds ``code`` to rows (raw, channels) of whole samples of int16; each code is unpacked and compared before it is given out."""
    kept = [c for c in chunks.columns if c != "raw"]
    kinds = ", ".join(f"`{c}` {chunks.schema[c].dataType.simpleString()}" for c in kept)

    def run(batches):
        for b in batches:
            codes = []
            for raw, channels in zip(b.column(b.schema.get_field_index("raw")).to_pylist(), b.column(b.schema.get_field_index("channels")).to_pylist(), strict=True):
                if raw is None or not channels or len(raw) % (2 * channels):
                    raise codec.GeometryUnknown(f"{0 if raw is None else len(raw)} bytes aren't whole samples of {channels} channels")
                x = np.frombuffer(raw, "<i2").reshape(-1, channels)
                code = pack_channels(x)
                if (unpack_channels(code, channels) != x).any():
                    raise codec.LosslessCheckFailed("a chunk doesn't come back")
                codes.append(code)
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in kept), pa.array(codes, pa.binary())], names=[*kept, "code"])

    return chunks.mapInArrow(run, f"{kinds}, code binary")
