"""Frame analytics on sample arrays: bit ranges, statistics, residuals, coherence.

Frames are rows (keys, samples ARRAY<INT>); samples are unsigned 16-bit values kept as INT.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataframe.operators import ordered


def fold(samples: Column, op: str) -> Column:
    start = {"or": 0, "and": 0xFFFF}[op]
    step = (lambda a, x: a.bitwiseOR(x)) if op == "or" else (lambda a, x: a.bitwiseAND(x))
    return F.aggregate(samples, F.lit(start), step)


def trailing_zeros(x: Column) -> Column:
    """Zero low bits; 0 for 0."""
    return F.when(x == 0, F.lit(0)).otherwise(F.bit_count(x.bitwiseAND(-x) - 1)).cast("int")


def bit_length(x: Column) -> Column:
    return F.when(x == 0, F.lit(0)).otherwise(F.length(F.bin(x))).cast("int")


def shift_range(df: DataFrame, keys: list[str], samples: str = "samples") -> DataFrame:
    """Common zero low bits and payload bits of all frames of a group."""
    mask = df.select(*keys, fold(F.col(samples), "or").alias("_or")).groupBy(*keys).agg(F.bit_or("_or").alias("or_mask"))
    shift = trailing_zeros(F.col("or_mask"))
    return mask.select(*keys, "or_mask", shift.alias("shift"), F.greatest(bit_length(F.col("or_mask")) - shift, F.lit(0)).alias("payload_bits"))


def _grouped(batch: pa.RecordBatch, keys: list[str]) -> Iterator[tuple[dict, np.ndarray]]:
    """(keys, frames one after the other) of each group of a batch, of frames of one length."""
    names = list(zip(*(batch.column(k).to_pylist() for k in keys), strict=True)) if keys else [()] * batch.num_rows
    samples = batch.column(len(keys))
    lengths = samples.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    parts: dict[tuple, list[int]] = {}
    for i, key in enumerate(zip(names, lengths.tolist(), strict=True)):
        parts.setdefault(key, []).append(i)
    for (key, length), at in parts.items():
        if length:
            flat = samples.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            yield dict(zip(keys, key, strict=True)), flat.reshape(len(at), length)


def _schema(df: DataFrame, keys: list[str], *fields: T.StructField) -> T.StructType:
    return T.StructType([*(df.schema[k] for k in keys), *fields])


def histogram(df: DataFrame, keys: list[str], samples: str = "samples", of=lambda x: x) -> DataFrame:
    """(keys, v, n): how often each sample value occurs, or each value of ``of`` (a function of arrays). Counted by batch, then added up: a row
    for each value and batch is shuffled, none for a pixel. Null and empty frames count nothing."""
    fields = {"v": pa.int64(), "n": pa.int64()}
    picked = df.select(*keys, F.col(samples).alias("_samples"))
    shape = _schema(picked, keys, T.StructField("v", T.LongType()), T.StructField("n", T.LongType()))
    kinds = [picked.schema[k] for k in keys]

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        out = pa.schema([*to_arrow_schema(T.StructType(kinds)), *fields.items()])
        for batch in batches:
            rows = []
            for key, x in _grouped(batch, keys):
                values, counts = np.unique(of(x), return_counts=True)
                rows += [key | {"v": v, "n": n} for v, n in zip(values.tolist(), counts.tolist(), strict=True)]
            yield pa.RecordBatch.from_pylist(rows, schema=out)

    return picked.mapInArrow(run, shape).groupBy(*keys, "v").agg(F.sum("n").alias("n"))


def entropy(df: DataFrame, keys: list[str], samples: str = "samples") -> DataFrame:
    """Order-0 entropy of the samples in bits."""
    whole = histogram(df, keys, samples).groupBy(*keys).agg(F.sum("n").alias("t"), F.sum(F.col("n") * F.log2("n")).alias("s"))
    return whole.select(*keys, F.round(F.log2("t") - F.col("s") / F.col("t"), 6).alias("bits"))


def pixel_stats(df: DataFrame, keys: list[str], samples: str = "samples") -> DataFrame:
    """(keys, px, n, mean, sd): of each pixel over the frames; sums are made by batch and are whole numbers, so exact."""
    fields = {"n": pa.int64(), "s": pa.list_(pa.int64()), "q": pa.list_(pa.int64())}
    picked = df.select(*keys, F.col(samples).alias("_samples"))
    long = T.ArrayType(T.LongType())
    shape = _schema(picked, keys, T.StructField("n", T.LongType()), T.StructField("s", long), T.StructField("q", long))
    kinds = [picked.schema[k] for k in keys]

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        out = pa.schema([*to_arrow_schema(T.StructType(kinds)), *fields.items()])
        for batch in batches:
            rows = [key | {"n": len(x), "s": x.sum(0).tolist(), "q": (x * x).sum(0).tolist()} for key, x in _grouped(batch, keys)]
            yield pa.RecordBatch.from_pylist(rows, schema=out)

    cells = picked.mapInArrow(run, shape).select(*keys, "n", F.posexplode(F.arrays_zip("s", "q")).alias("px", "c"))
    sums = cells.groupBy(*keys, "px").agg(F.sum("n").alias("n"), F.sum("c.s").alias("s"), F.sum("c.q").alias("q"))
    n, s, q = (F.col(c).cast("double") for c in ("n", "s", "q"))
    return sums.select(*keys, "px", "n", (s / n).alias("mean"), F.sqrt(F.greatest(q / n - (s / n) * (s / n), F.lit(0.0))).alias("sd"))


def factor_pairs(n: int, lowest: float = 0.25, highest: float = 4.0) -> list[tuple[int, int]]:
    """All (rows, cols) of product ``n`` with an aspect in range, in order."""
    found = set()
    for r in range(1, math.isqrt(n) + 1):
        if n % r == 0:
            found |= {(r, n // r), (n // r, r)}
    return sorted(p for p in found if lowest <= p[0] / p[1] <= highest)


def factor_pair_column(n: Column, lowest: float = 0.25, highest: float = 4.0) -> Column:
    """The same as an array of (rows, cols) for a column of products; null or below 1 gives an empty array."""
    top = F.ceil(F.sqrt(n * highest)).cast("int")  # rows / cols <= highest
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(top, F.lit(1))), lambda r: F.struct(r.alias("rows"), F.floor(n / r).cast("int").alias("cols")))
    fits = lambda p: (p["rows"] * p["cols"] == n) & (p["rows"] / p["cols"]).between(lowest, highest)
    return F.when(n >= 1, F.filter(pairs, lambda p: (p["cols"] > 0) & F.coalesce(F.when(p["cols"] > 0, fits(p)), F.lit(False)))).otherwise(F.array().cast("array<struct<rows:int,cols:int>>"))


def pick_evenly(df: DataFrame, group: list[str], position: str, k: int) -> DataFrame:
    """Rows of up to ``k`` evenly spaced places of each group, in order of ``position``; the first and the last are among them."""
    placed = ordered.ranked(df, group, position, "_place")
    whole = df.groupBy(*group).agg(F.count("*").alias("_n"))
    placed = ordered.on_keys(placed, whole, group) if group else placed.join(F.broadcast(whole))
    last = F.col("_n") - 1
    # place p is picked if p = floor(i * last / (k - 1)) for some i; the least i that reaches it is ceil(p * (k - 1) / last)
    i = F.ceil(F.col("_place") * (k - 1) / F.nullif(last, F.lit(0)))
    hit = F.floor(i * last / max(1, k - 1)) == F.col("_place")
    return placed.where((F.col("_n") <= k) | (F.lit(k > 1) & hit) | (F.col("_place") == 0)).drop("_place", "_n")


def even_picks(n: int, k: int) -> list[int]:
    """Up to ``k`` distinct evenly spaced positions of ``n``."""
    if n <= 0 or k <= 0:
        return []
    if k == 1:
        return [0]
    if k >= n:
        return list(range(n))
    return sorted({i * (n - 1) // (k - 1) for i in range(k)})


def coherence_of(frame: np.ndarray) -> float:
    """Mean correlation of adjacent rows of a frame, mean-centred by row; a constant row counts 0."""
    x = frame.astype(np.float64)
    if len(x) < 2:
        return 0.0
    mean = x.mean(1)
    power = np.maximum((x * x).mean(1) - mean * mean, 0.0)
    both = (x[:-1] * x[1:]).mean(1) - mean[:-1] * mean[1:]
    return float((both / (np.sqrt(power[:-1] * power[1:]) + 1e-12)).mean())


def row_coherence(df: DataFrame, keys: list[str], cols: int, samples: str = "samples") -> DataFrame:
    """(keys, coherence) of each frame, one matrix at a time; samples beyond the last whole row are left out."""
    picked = df.select(*keys, F.col(samples).alias("_samples"))
    kinds = [picked.schema[k] for k in keys]

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        out = pa.schema([*to_arrow_schema(T.StructType(kinds)), ("coherence", pa.float64())])
        for batch in batches:
            values = []
            for x in batch.column(len(keys)):
                flat = x.values.to_numpy(zero_copy_only=False) if x.is_valid else np.empty(0)
                values.append(coherence_of(flat[: len(flat) // cols * cols].reshape(-1, cols)) if len(flat) else None)
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(len(keys))), pa.array(values, pa.float64())], schema=out)

    return picked.mapInArrow(run, _schema(picked, keys, T.StructField("coherence", T.DoubleType())))


def residual(frame: np.ndarray, kind: str, other: np.ndarray | None = None) -> np.ndarray:
    """What a transform leaves of a frame, as 16-bit values modulo 2^16.

    horizontal: from the sample to the left. temporal: from ``other``, an earlier frame. mean: from ``other``, a mean image
    (rounded). block: from the mean of 8 x 8 blocks. dc: from the frame's own mean.
    """
    x = frame.astype(np.int64)
    if kind == "horizontal":
        base = np.concatenate([np.zeros_like(x[:, :1]), x[:, :-1]], 1)
    elif kind in ("temporal", "mean"):
        base = np.rint(other).astype(np.int64)
    elif kind == "block":
        r, c = -(-x.shape[0] // 8), -(-x.shape[1] // 8)
        base = np.empty_like(x)
        for i in range(r):
            for j in range(c):
                at = np.s_[8 * i : 8 * i + 8, 8 * j : 8 * j + 8]
                base[at] = int(np.rint(x[at].mean()))
    elif kind == "dc":
        base = np.full_like(x, int(np.rint(x.mean())))
    else:
        raise ValueError(f"no transform {kind!r}")
    return ((x - base) & 0xFFFF).astype(np.uint16)


def offset_to_unsigned(r: np.ndarray) -> np.ndarray:
    """Residuals around 0 (modulo 2^16) moved to around 2^15."""
    return (r.astype(np.int64) + (1 << 15) & 0xFFFF).astype(np.uint16)
