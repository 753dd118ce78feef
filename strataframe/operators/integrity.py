"""Hashes of files and spans, extracted members against a store, and restored archives against their records."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.operators import container
from strataframe.operators.catalog import same_multiset
from strataframe.sources.storage import size_of, store

CHUNK = 16 << 20


def _fold(path: str, start: int = 0, length: int | None = None) -> tuple[int, str]:
    """(bytes read, SHA-256) of a file or a span of it, in chunks; a file that ends early gives fewer bytes."""
    system, at = store(path)
    digest, n = hashlib.sha256(), 0
    with system.open_input_file(at) as file:
        file.seek(start)
        while length is None or n < length:
            piece = file.read(CHUNK if length is None else min(CHUNK, length - n))
            if not piece:
                break
            digest.update(piece)
            n += len(piece)
    return n, digest.hexdigest()


def span_digests(spans: DataFrame) -> DataFrame:
    """Adds bytes, sha256 and error to rows (path, start, length): of a whole file where length is null. A file that can't be read gives its error."""
    rows = spans.select(*spans.columns)
    kinds = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes)
    at = [rows.columns.index(c) for c in ("path", "start", "length")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                one = b.slice(k, 1)
                path, start, length = (one.column(i)[0].as_py() for i in at)
                try:
                    n, digest = _fold(path, start or 0, length)
                    error = None
                except OSError as e:
                    n, digest, error = None, None, f"{type(e).__name__}: {e}"[:200]
                yield pa.RecordBatch.from_arrays([*one.columns, pa.array([n], pa.int64()), pa.array([digest], pa.string()), pa.array([error], pa.string())], names=[*b.schema.names, "bytes", "sha256", "error"])

    return rows.mapInArrow(run, f"{kinds}, bytes long, sha256 string, error string")


def file_digests(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, bytes, sha256, error) of files in any store, one task a file."""
    rows = spark.createDataFrame([(p, None, None) for p in paths], "path string, start long, length long").repartition(max(1, len(paths)))
    return span_digests(rows).drop("start", "length")


def same_files(spark: SparkSession, one: str, other: str) -> bool:
    if size_of(one) != size_of(other):
        return False
    return file_digests(spark, [one, other]).where("sha256 is not null").select("sha256").distinct().count() == 1


def rebuildable_hash() -> tuple[Column, Column]:
    """(hash, bytes) that a rebuild of an ``archives`` row must have: of what was kept, for partial archives, else of the source."""
    return F.when(F.col("partial"), F.col("frames_tar_sha256")).otherwise(F.col("source_tar_sha256")), F.when(F.col("partial"), F.col("frames_tar_bytes")).otherwise(F.col("source_bytes"))


def extraction_scope(n_selected: Column, n_frames: Column) -> Column:
    """What checks an extraction: the whole pixel hash if all frames were taken, in any order, else each frame's checksum alone."""
    return F.when(n_selected == n_frames, F.lit("pixels")).otherwise(F.lit("frames"))


def member_proof(wanted: DataFrame, candidates: DataFrame, quick: bool = False) -> DataFrame:
    """(member, path, verified, method, note): copies elsewhere of members of a tar.

    wanted: member, archive, data_offset, bytes. candidates: member, path, bytes. Sizes are compared first; only where they
    agree both copies are hashed, or with ``quick`` nothing, and then nothing counts as verified.
    """
    pairs = wanted.join(candidates.withColumnsRenamed({"bytes": "there"}), "member").where("bytes = there")
    if quick:
        found = pairs.groupBy("member").agg(F.min("path").alias("path")).withColumn("same", F.lit(False))
    else:
        own = span_digests(pairs.select("member", F.col("archive").alias("path"), F.col("data_offset").alias("start"), F.col("bytes").alias("length")).distinct())
        other = span_digests(pairs.select("path", F.lit(0).cast("long").alias("start"), F.lit(None).cast("long").alias("length")).distinct())
        both = pairs.select("member", "path").join(own.select("member", F.col("sha256").alias("mine")), "member").join(other.select("path", "sha256"), "path")
        same = F.coalesce(F.col("mine") == F.col("sha256"), F.lit(False))
        found = both.groupBy("member").agg(F.min(F.struct((~same).alias("differs"), "path")).alias("m")).select("member", "m.path", (~F.col("m.differs")).alias("same"))
    out = wanted.select("member").join(found, "member", "left")
    note = F.when(F.col("path").isNull(), "no file of its size").when(F.lit(quick), "size alone is no proof").when(~F.col("same"), "contents differ").otherwise("")
    return out.select("member", "path", F.coalesce("same", F.lit(False)).alias("verified"), F.lit("size" if quick else "sha256").alias("method"), note.alias("note"))


def extraction_checks(spark: SparkSession, folder: str, archive: str, extracted: str) -> DataFrame:
    """(check, ok, note) on members extracted below ``extracted``, from the store alone: count, size, pixels, samples, order."""
    meta = container.archives(spark, folder).where(F.col("archive") == archive).first()
    entries = container.part(spark, folder, "entries").where((F.col("archive") == archive) & (F.col("size") > 0)).select("entry_no", "storage_idx", "acq_idx", "name", "size")
    frames = container.frames(spark, folder, container.literal("archive", archive)).select("name", F.sha2("pixels", 256).alias("want"))
    start, length, swap = meta["px_start"], meta["px_len"], meta["dtype"] == ">u2"
    out = pa.schema([("name", pa.string()), ("size", pa.int64()), ("found", pa.int64()), ("got", pa.string())])

    def run(batches):
        for b in batches:
            rows = []
            for name, size in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                path = os.path.join(extracted, *name.split("/"))
                raw = None
                if os.path.exists(path):
                    with open(path, "rb") as file:
                        raw = file.read()
                px = None if raw is None else raw[start : start + length]
                px = container.codec.byteswap16(px) if px is not None and swap and len(px) % 2 == 0 else px
                rows.append({"name": name, "size": size, "found": None if raw is None else len(raw), "got": None if px is None else hashlib.sha256(px).hexdigest()})
            yield pa.RecordBatch.from_pylist(rows, schema=out)

    seen = entries.select("name", "size").mapInArrow(run, "name string, size long, found long, got string").join(frames, "name")
    t = seen.agg(F.count("found").alias("there"), F.count_if(~F.coalesce(F.col("found") == F.col("size"), F.lit(False))).alias("sizes"), F.count_if(~F.coalesce(F.col("got") == F.col("want"), F.lit(False))).alias("pixels")).first()
    moved = same_multiset(seen.select(F.col("got").alias("d")), seen.select(F.col("want").alias("d")), "d").count()
    order = entries.agg(F.count("*").alias("n"), F.count_distinct("acq_idx").alias("d"), F.max("acq_idx").alias("top")).first()
    ordered = not meta["temporal_order_known"] or (order["d"] == order["n"] and order["top"] == order["n"] - 1)
    proof = container.verify(spark, folder, archive).first()
    rows = [
        ("count", t["there"] == meta["n_frames"], f"{t['there']} of {meta['n_frames']} files"),
        ("size", t["sizes"] == 0, f"{t['sizes']} files of another size"),
        ("pixels", proof["ok"] is True, proof["reason"] or "the store rebuilds its hash"),
        ("samples", t["pixels"] == 0, f"{t['pixels']} files with other samples"),
        ("permutation", moved == 0 and ordered, f"{moved} frames on one side only"),
    ]
    return spark.createDataFrame(rows, "check string, ok boolean, note string")


def restore_test(spark: SparkSession, expected: DataFrame, originals: DataFrame, replacements: DataFrame, rebuilt: DataFrame) -> DataFrame:
    """(session, original, replacement, rebuild): whether what came back from offsite is what was recorded; null where nothing came back.

    expected: session, tar_sha256, store_sha256. originals and replacements: session, sha256 of the restored tar and store.
    rebuilt: session, sha256 that the restored store rebuilds.
    """
    rows = expected
    for name, frame in (("o", originals), ("r", replacements), ("b", rebuilt)):
        rows = rows.join(frame.select("session", F.col("sha256").alias(f"_{name}")), "session", "left")
    return rows.select("session", (F.col("_o") == F.col("tar_sha256")).alias("original"), (F.col("_r") == F.col("store_sha256")).alias("replacement"), (F.col("_b") == F.col("tar_sha256")).alias("rebuild"))
