"""The log of file events, and the sweep of unfinished files."""

from __future__ import annotations

import contextlib
import csv
import datetime
import io
import os
import platform
import time

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.sources.storage import size_of, store

SCHEMA = "timestamp_utc string, event string, path string, size_bytes long, host string, pid long, note string"
FIELDS = [c.split()[0] for c in SCHEMA.split(", ")]
EVENTS = ("create", "modify", "delete")


def record(folder: str | None, event: str, path: str, size_bytes: int | None = None, note: str = "") -> None:
    """Adds one event as a file of its own, so writers never meet. Never raises: a log that fails ends no work.

    The size is read from the file where none is given, so a deletion is recorded before it is made.
    """
    if folder is None:
        return
    with contextlib.suppress(Exception):
        if size_bytes is None:
            with contextlib.suppress(FileNotFoundError):
                size_bytes = size_of(path)
        now = datetime.datetime.now(datetime.UTC)
        text = io.StringIO()
        writer = csv.writer(text)
        writer.writerow(FIELDS)
        writer.writerow([now.isoformat(timespec="seconds"), event, path, "" if size_bytes is None else size_bytes, platform.node(), os.getpid(), note])
        system, at = store(folder)
        system.create_dir(at, recursive=True)
        with system.open_output_stream(f"{at}/{now:%Y%m%dT%H%M%S%f}-{platform.node()}-{os.getpid()}-{time.monotonic_ns()}.csv") as out:
            out.write(text.getvalue().encode())


def record_write(folder: str | None, path: str, existed: bool, note: str = "") -> None:
    record(folder, "modify" if existed else "create", path, note=note)


def read(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.csv(folder, schema=SCHEMA, header=True)


def write_csv(df: DataFrame, folder: str) -> None:
    """A table as CSV files with a header each, nulls as nothing."""
    df.write.mode("overwrite").option("header", True).option("emptyValue", "").csv(folder)


def sweep_unfinished(spark: SparkSession, folder: str, older_than: float = 86_400, log: str | None = None, delete: bool = True) -> DataFrame:
    """(path, bytes, age_seconds): files ``*.partial`` below ``folder`` not written to for so long; logged and deleted, one listing and a deletion for each."""
    system, at = store(folder)
    prefix = folder[: len(folder) - len(at)] if folder.endswith(at) else ""
    rows, now = [], time.time()
    if system.get_file_info(at).type == fs.FileType.Directory:
        for f in system.get_file_info(fs.FileSelector(at, recursive=True)):
            age = now - (f.mtime_ns or 0) / 1e9
            if f.type == fs.FileType.File and f.path.endswith(".partial") and age >= older_than:
                rows.append((prefix + f.path, f.size, age))
    if delete:
        for path, size, _ in rows:
            record(log, "delete", path, size, "unfinished")
            system.delete_file(store(path)[1])
    return spark.createDataFrame(rows, "path string, bytes long, age_seconds double")


def sweep_unpublished(spark: SparkSession, folder: str, older_than: float = 86_400, delete: bool = True) -> list[str]:
    """Batches of a store that have frames, entries or listings but no row in ``archives``: what writes that ended early left behind."""
    system, at = store(folder)
    known = set()
    if system.get_file_info(f"{at}/archives").type == fs.FileType.Directory:
        known = {r["batch"] for r in spark.read.parquet(f"{folder}/archives").select("batch").distinct().toLocalIterator()}
    found = []
    for part in ("frames", "entries", "shells", "staging"):
        if system.get_file_info(f"{at}/{part}").type != fs.FileType.Directory:
            continue
        for f in system.get_file_info(fs.FileSelector(f"{at}/{part}")):
            batch = f.base_name.removeprefix("batch=")
            if f.type == fs.FileType.Directory and f.base_name.startswith("batch=") and batch not in known and time.time() - (f.mtime_ns or 0) / 1e9 >= older_than:
                found.append(f.path)
    if delete:
        for path in found:
            system.delete_dir(path)
    return found


def rollup(events: DataFrame) -> DataFrame:
    """(event, n, total_bytes): events of files ``.partial`` are counted as transient, without bytes."""
    transient = F.col("path").contains(".partial")
    return events.groupBy(F.when(transient, "transient").otherwise(F.col("event")).alias("event")).agg(F.count("*").alias("n"), F.sum(F.when(~transient, F.col("size_bytes"))).alias("total_bytes"))
