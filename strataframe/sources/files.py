"""Listings and logs: files below a folder, size rollups, name index, census, run logs, manifests, key=value and array headers.

A listing comes from the file reader with its content pruned, so no file is opened.
"""

from __future__ import annotations

import os

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.functions.scalars import canonical_path
from strataframe.sources.storage import shared_folder, store

CENSUS = "server string, path string, bytes long, kind string, member_bytes long, est_frames long, rows int, cols int, shift int, payload_bits int, maxval int, has_svd string, first_member string, error string"
RUN_LOG = "tar string, wfz string, session string, ratio double, source_bytes long, output_bytes long, shift int, n_frames long, shape array<int>, is_tiff boolean, tar_sha256 string, byte_identical boolean, verified_by string, elapsed_s double, ok boolean, shape_assumed array<int>, error string"


EPHYS = "server string, path string, bytes long, band string, subject string, date string, session string, has_cbin string, cbin_bytes long, has_ch string, has_meta string, n_channels int, sample_rate_hz double, implied_seconds double, error string"
_WALKED = "path string, kind string, bytes long, modified_ns long, depth int, error string"


def listing(spark: SparkSession, root: str, pattern: str = "*", max_depth: int | None = None) -> DataFrame:
    """(path, bytes, modified, depth) of the files below ``root`` whose name fits; depth counts folders below it."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    base = len([p for p in root.split("://", 1)[-1].split("/") if p])
    place = F.regexp_replace(F.col("path"), "^[a-z]+:/*", "")
    out = found.select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"), (F.size(F.split(place, "/")) - 1 - base).alias("depth"))
    return out if max_depth is None else out.where(F.col("depth") <= max_depth)


def walk(spark: SparkSession, root: str, max_depth: int = 16, pattern: str | None = None) -> DataFrame:
    """(path, kind, bytes, modified_ns, depth, error) of all below ``root``: files (whose path fits ``pattern``, a regular expression), folders,
    and as kind ``error`` folders that can't be read, with the reason. Links are not followed.

    Level by level: the folders of a level are listed side by side by the executors, so one unreadable folder loses its own
    content alone. Each level is kept in the shared folder; ``max_depth`` bounds their number.
    """
    out = pa.schema([("path", pa.string()), ("kind", pa.string()), ("bytes", pa.int64()), ("modified_ns", pa.int64()), ("depth", pa.int32()), ("error", pa.string())])

    def run(batches):
        for b in batches:
            for path, depth in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                rows = []
                try:
                    system, at = store(path)
                    prefix = path[: len(path) - len(at)] if path.endswith(at) else ""
                    for f in system.get_file_info(fs.FileSelector(at)):
                        link = isinstance(system, fs.LocalFileSystem) and os.path.islink(f.path)
                        if not link and f.type in (fs.FileType.File, fs.FileType.Directory):
                            rows.append({"path": prefix + f.path, "kind": "file" if f.type == fs.FileType.File else "folder", "bytes": f.size, "modified_ns": f.mtime_ns, "depth": depth + 1, "error": None})
                except OSError as e:
                    rows = [{"path": path, "kind": "error", "bytes": None, "modified_ns": None, "depth": depth, "error": f"{type(e).__name__}: {e}"[:300]}]
                yield pa.RecordBatch.from_pylist(rows, schema=out)

    folder = shared_folder(spark, "walk")
    level = spark.createDataFrame([(root.rstrip("/"), 0)], "path string, depth int")
    paths = []
    for k in range(max_depth):
        if level.isEmpty():
            break
        paths.append(f"{folder}/{k}")
        level.repartition(spark.sparkContext.defaultParallelism, "path").mapInArrow(run, _WALKED).write.parquet(paths[-1])
        level = spark.read.schema(_WALKED).parquet(paths[-1]).where("kind = 'folder'").select("path", "depth")
    found = spark.read.schema(_WALKED).parquet(*paths) if paths else spark.createDataFrame([], _WALKED)
    return found if pattern is None else found.where((F.col("kind") != "file") | F.col("path").rlike(pattern))


def folder_sizes(files: DataFrame) -> DataFrame:
    """Total, count, newest and oldest file of each folder."""
    return files.groupBy(F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("folder")).agg(F.sum("bytes").alias("total_bytes"), F.count("*").alias("n_files"), F.max("modified").alias("newest"), F.min("modified").alias("oldest"))


def named(files: DataFrame, name: str) -> DataFrame:
    """Distinct folders of that name on the files' paths; what lies deeper inside them is not looked into."""
    at = F.array_position(F.split("path", "/"), name).cast("int")
    return files.where(at > 0).select(F.array_join(F.slice(F.split("path", "/"), F.lit(1), at), "/").alias("folder")).distinct()


def name_index(files: DataFrame) -> DataFrame:
    """(name, path): rows to join on the last part of a path; one name may have many paths, so they stay rows."""
    return files.select(F.regexp_extract("path", "([^/]*)$", 1).alias("name"), "path", "bytes")


def census(spark: SparkSession, path: str) -> DataFrame:
    """Census rows; empty numbers are 0, an empty shift is -1."""
    rows = spark.read.csv(path, schema=CENSUS, header=True)
    return rows.withColumns({c: F.coalesce(c, F.lit(-1 if c == "shift" else 0)) for c in ("bytes", "member_bytes", "est_frames", "rows", "cols", "shift", "payload_bits", "maxval")} | {"has_svd": F.coalesce(F.col("has_svd").isin("True", "true", "1"), F.lit(False))})


def ephys_census(spark: SparkSession, path: str) -> DataFrame:
    """Census rows of recordings; empty numbers are 0, empty flags false."""
    rows = spark.read.csv(path, schema=EPHYS, header=True)
    numbers = {c: F.coalesce(c, F.lit(0)) for c in ("bytes", "cbin_bytes", "n_channels", "sample_rate_hz", "implied_seconds")}
    return rows.withColumns(numbers | {c: F.coalesce(F.col(c).isin("True", "true", "1"), F.lit(False)) for c in ("has_cbin", "has_ch", "has_meta")})


def size_listing(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, schema="bytes long, path string", sep="\t")


def run_log(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """JSON lines; lines that can't be read are left out, or raise where ``strict``."""
    return spark.read.schema(RUN_LOG).option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(path)


def append_log(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)


def manifest(spark: SparkSession, path: str, record: str) -> DataFrame:
    """(archive, record) of a JSON object keyed by archive."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.explode(F.from_json("value", f"map<string,{record}>")).alias("archive", "record"))


def verified_members(records: DataFrame, archive: str) -> DataFrame:
    """(member, ...) of the evidence for one archive, whatever case or slashes its name is written with: the verified members, or none unless
    all of the archive are verified. records: (archive, record) with all_verified and discardable (an array with member and verified)."""
    own = records.where(canonical_path(F.col("archive")) == canonical_path(F.lit(archive))).where("record.all_verified")
    return own.select(F.explode("record.discardable").alias("d")).where("d.verified").select("d.*")


def manifest_text(rows: DataFrame, key: str) -> DataFrame:
    """One JSON object keyed by ``key``: for reports of a bounded number of archives."""
    rest = F.struct(*[c for c in rows.columns if c != key])
    return rows.agg(F.to_json(F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col(key), rest))))).alias("json"))


def key_values(spark: SparkSession, path: str) -> DataFrame:
    """(path, key, value) of the lines ``key=value``; others are left out."""
    pair = F.split("value", "=", 2)
    return spark.read.text(path).where(F.col("value").contains("=")).select(F.col("_metadata.file_path").alias("path"), F.trim(pair[0]).alias("key"), F.trim(pair[1]).alias("value"))


def recording_meta(spark: SparkSession, path: str) -> DataFrame:
    """(path, n_channels, sample_rate) of description files; what a file doesn't tell, or not as a number, is 0."""
    pairs = key_values(spark, path)
    number = lambda keys, kind: F.coalesce(F.max(F.when(F.col("key").isin(*keys), F.col("value").try_cast(kind))), F.lit(0).cast(kind))
    told = pairs.groupBy("path").agg(number(["nSavedChans"], "int").alias("n_channels"), number(["imSampRate", "niSampRate"], "double").alias("sample_rate"))
    every = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("path"))
    return every.join(told, "path", "left").select("path", F.coalesce("n_channels", F.lit(0)).alias("n_channels"), F.coalesce("sample_rate", F.lit(0.0)).alias("sample_rate"))


def first_shape(spark: SparkSession, folder: str, names: tuple[str, ...] = ("blue/meanImage.npy", "violet/meanImage.npy")):
    """(rows, cols) of the first of the files below ``folder`` that is there and holds a two-dimensional array, or None."""
    for name in names:
        system, at = store(f"{folder}/{name}")
        if system.get_file_info(at).type == fs.FileType.File:
            found = spark.read.format("binaryFile").load(f"{folder}/{name}").select(array_shape(F.col("content")).alias("s")).first()["s"]
            if found is not None:
                return found["rows"], found["cols"]
    return None


def array_shape(content: Column) -> Column:
    """Column of the two-dimensional shape in the header of a .npy file's bytes; null for others."""
    header = F.substring(content, 1, 256).cast("string")
    shape = F.regexp_extract(header, r"'shape': \(([0-9]+), ([0-9]+),?\)", 0)
    number = lambda k: F.regexp_extract(shape, r"\(([0-9]+), ([0-9]+)", k).cast("long")
    return F.when(shape != "", F.struct(number(1).alias("rows"), number(2).alias("cols")))
