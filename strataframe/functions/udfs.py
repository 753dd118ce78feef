"""Functions for SQL: ``register(spark)`` makes them known to a session. Arrow brings whole batches; null in gives null out."""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf, udtf

from strataframe.operators import codec
from strataframe.operators.frames import coherence_of
from strataframe.operators.frames import factor_pairs as pairs_of
from strataframe.sources import tar

LAYOUT = T.StructType().add("rows", "integer").add("cols", "integer").add("dtype", "string").add("px_start", "integer").add("px_len", "integer")


def _frame(raw: bytes, rows: int, cols: int) -> np.ndarray:
    return np.frombuffer(raw, "<u2").reshape(rows, cols)


@pandas_udf(T.BinaryType())
def encode_frame(raw: pd.Series, rows: pd.Series, cols: pd.Series) -> pd.Series:
    """Code of a frame of little-endian samples; raises if it doesn't give the frame back."""

    def one(b, r, c):
        if b is None or pd.isna(r) or pd.isna(c):
            return None
        code = codec.encode(_frame(b, int(r), int(c)))
        if codec.decode(code, int(r), int(c)).astype("<u2").tobytes() != bytes(b):
            raise codec.LosslessCheckFailed("decoding doesn't give the frame back")
        return code

    return pd.Series([one(*x) for x in zip(raw, rows, cols, strict=True)], dtype=object)


@pandas_udf(T.BinaryType())
def decode_frame(code: pd.Series, rows: pd.Series, cols: pd.Series) -> pd.Series:
    return pd.Series([None if b is None else codec.decode(bytes(b), int(r), int(c)).astype("<u2").tobytes() for b, r, c in zip(code, rows, cols, strict=True)], dtype=object)


@pandas_udf(T.BinaryType())
def byteswap16(raw: pd.Series) -> pd.Series:
    return pd.Series([None if b is None else codec.byteswap16(b) for b in raw], dtype=object)


@pandas_udf(T.BooleanType())
def tar_checksum_ok(header: pd.Series) -> pd.Series:
    return pd.Series([None if h is None else tar.checksum_ok(bytes(h)) for h in header], dtype=object)


@pandas_udf(T.DoubleType())
def frame_coherence(raw: pd.Series, rows: pd.Series, cols: pd.Series) -> pd.Series:
    return pd.Series([None if b is None else coherence_of(_frame(b, int(r), int(c))) for b, r, c in zip(raw, rows, cols, strict=True)], dtype="float64")


@pandas_udf(LAYOUT)
def tiff_layout(raw: pd.Series) -> pd.DataFrame:
    """Layout of a one-page uncompressed 16-bit TIFF; nulls for anything else."""

    def one(b):
        try:
            x = codec.detect(bytes(b)) if b is not None else None
        except (codec.GeometryUnknown, struct.error, IndexError):
            x = None
        return (None,) * 5 if x is None else (x.rows, x.cols, x.dtype, x.px_start, x.px_len)

    return pd.DataFrame([one(b) for b in raw], columns=["rows", "cols", "dtype", "px_start", "px_len"])


@udtf(returnType=T.StructType().add("entry_no", "integer").add("name", "string").add("size", "long").add("mtime", "long").add("data_offset", "long"))
class TarEntries:
    """Entries of a small archive given as bytes."""

    def eval(self, archive: bytes):
        import io

        if archive is not None:
            for k, x in enumerate(tar.walk(io.BytesIO(bytes(archive)))):
                yield k, x.name, x.size, x.mtime, x.data_offset


@udtf(returnType=T.StructType().add("n_rows", "integer").add("n_cols", "integer"))
class FactorPairs:
    """All (rows, cols) of a product with an aspect from 1:4 to 4:1."""

    def eval(self, n: int):
        if n is not None and n > 0:
            yield from pairs_of(n)


def register(spark: SparkSession) -> None:
    for name, f in (("encode_frame", encode_frame), ("decode_frame", decode_frame), ("byteswap16", byteswap16), ("tar_checksum_ok", tar_checksum_ok), ("frame_coherence", frame_coherence), ("tiff_layout", tiff_layout)):
        spark.udf.register(name, f)
    spark.udtf.register("tar_entries", TarEntries)
    spark.udtf.register("factor_pairs", FactorPairs)
