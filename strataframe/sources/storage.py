"""Files in any store that Arrow's file systems reach, and the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyarrow import fs
from pyspark.sql import SparkSession


def store(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path in it of a local path or URI."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def size_of(path: str) -> int:
    system, at = store(path)
    info = system.get_file_info(at)
    if info.type != fs.FileType.File:
        raise FileNotFoundError(path)
    return info.size


def state_of(path: str) -> tuple[int, int]:
    """(size, modification time in ns): what a changed file is told by."""
    system, at = store(path)
    info = system.get_file_info(at)
    return info.size or 0, info.mtime_ns or 0


def drop_folder(path: str) -> None:
    """Deletes a folder of our own with what is in it, if it is there."""
    system, at = store(path)
    if system.get_file_info(at).type == fs.FileType.Directory:
        system.delete_dir(at)


def tars_in(path: str) -> list[str]:
    """A file itself, or the .tar files below a folder, sorted."""
    system, at = store(path)
    info = system.get_file_info(at)
    if info.type == fs.FileType.File:
        return [path]
    found = system.get_file_info(fs.FileSelector(at, recursive=True))
    prefix = path[: len(path) - len(at)] if path.endswith(at) else ""
    return sorted(prefix + f.path for f in found if f.type == fs.FileType.File and f.path.endswith(".tar"))


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir; where the session names none, a temporary one, if all runs on one machine."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="strataframe-")
        spark.conf.set("spark.checkpoint.dir", named)
    return f"{named.rstrip('/')}/strataframe/{name}-{uuid.uuid4().hex}"
