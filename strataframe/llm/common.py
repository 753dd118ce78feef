"""Reading tables, the shared folder and lineage cuts used by every operator of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share: spark.checkpoint.dir.

    Where the session names none, and all runs on one machine (tests), a temporary folder is made and set.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="strataframe-"))
    return context.getCheckpointDir()


def new_folder(spark: SparkSession, name: str) -> str:
    """A URI below the shared folder that no other run uses."""
    return f"{shared_dir(spark).rstrip('/')}/strataframe/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, forget_size: bool = False) -> DataFrame:
    """Computes ``df`` once and goes on from files in the shared folder, so that lost executors cost no recomputation of what lies before.

    Shuffle files of tables that were cut before and that nothing refers to any more are let go first. forget_size: drops
    the size that was estimated for ``df``, and how it is partitioned; each join multiplies estimates, which in loops
    become numbers of millions of digits.
    """
    shared_dir(df.sparkSession)
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()  # Spark removes shuffle files when their plan is collected
    held = df.checkpoint(eager=True)
    return apart(held) if forget_size else held


def apart(df: DataFrame) -> DataFrame:
    """``df`` planned for itself and not computed yet: no filter that follows is put before its expensive columns, which would then be computed for the filter too."""
    session, held = df.sparkSession, df._jdf
    return DataFrame(session._jsparkSession.internalCreateDataFrame(held.queryExecution().toRdd(), held.schema(), False), session)


def tidy() -> None:
    """Gives memory back that earlier tasks of this Python worker have freed; workers go on from stage to stage."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # no such function outside glibc
        ctypes.CDLL(None).malloc_trim(0)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def fresh(df: DataFrame, wanted: str) -> str:
    """``wanted``, or the first ``wanted_2``, ``wanted_3`` ... that clashes with no column of ``df`` (case ignored)."""
    taken = {c.lower() for c in df.columns}
    name, k = wanted, 1
    while name.lower() in taken:
        k += 1
        name = f"{wanted}_{k}"
    return name
