"""Resumable compression of a folder of archives, and windows over the event stream."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.operators import container
from strataframe.sources.storage import state_of, store, tars_in

LOG = "archive string, ok boolean, error string, n_frames long, source_bytes long, output_bytes long, elapsed_s double"


def finished(spark: SparkSession, folder: str) -> DataFrame:
    """(archive, state_size, state_mtime) of what is in the store; empty where there is none yet."""
    system, at = store(f"{folder}/archives")
    if system.get_file_info(at).type.name == "NotFound":
        return spark.createDataFrame([], "archive string, state_size long, state_mtime long")
    return container.archives(spark, folder).select("archive", "state_size", "state_mtime")


def remaining(spark: SparkSession, source: str, folder: str, quiet: float = 3600) -> list[str]:
    """Archives to compress, smallest first: not done at their present size and time, and not written to for ``quiet`` seconds."""
    states = [(p, *state_of(p)) for p in tars_in(source)]
    listed = spark.createDataFrame(states, "archive string, state_size long, state_mtime long")
    todo = listed.join(finished(spark, folder), ["archive", "state_size", "state_mtime"], "left_anti")
    return [r["archive"] for r in todo.where(F.col("state_mtime") <= (time.time() - quiet) * 1e9).orderBy("state_size", "archive").toLocalIterator()]


def run(spark: SparkSession, source: str, folder: str, shape: tuple[int, int] | None = None, quiet: float = 3600, limit: int | None = None) -> DataFrame:
    """Compresses and verifies what remains; an archive that fails becomes a row of the log, and the rest goes on. Run again, it resumes."""
    rows = []
    for path in remaining(spark, source, folder, quiet)[:limit]:
        began = time.time()
        try:
            meta = container.compress(spark, [path], folder, shape=shape, min_age=quiet).first()
            proof = container.verify(spark, folder, path).first()
            rows.append((path, proof["ok"] is not False, proof["reason"], meta["n_frames"], meta["source_bytes"], meta["output_bytes"], time.time() - began))
        except Exception as e:  # the reason is logged
            rows.append((path, False, f"{type(e).__name__}: {e}"[:500], None, None, None, time.time() - began))
    out = spark.createDataFrame(rows, LOG)
    out.write.mode("append").json(f"{folder}/log")
    return out


def supervise(spark: SparkSession, source: str, folder: str, shape: tuple[int, int] | None = None, quiet: float = 3600, limit: int | None = None, rounds: int = 1, pause: float = 60, stop_file: str | None = None) -> list:
    """Runs until nothing remains, ``rounds`` runs are over or ``stop_file`` is there, pausing longer after each run that got nothing done. Returns the last
    log row of each archive."""
    last, wait = {}, pause
    for k in range(rounds):
        if stop_file:
            system, at = store(stop_file)
            if system.get_file_info(at).type.name != "NotFound":
                break
        rows = run(spark, source, folder, shape, quiet, limit).collect()  # a row for each archive worked on
        last |= {r["archive"]: r for r in rows}
        if not rows or k == rounds - 1 or not remaining(spark, source, folder, quiet):
            break
        wait = pause if any(r["ok"] for r in rows) else 2 * wait
        time.sleep(wait)
    return list(last.values())


def event_windows(events: DataFrame, width: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Counts and sums by event type and tumbling window; on a stream, windows end when the watermark passes them."""
    at = F.window("ts", width)
    return events.withWatermark("ts", late).groupBy(at.alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")).select(F.col("w.start").alias("started"), "event_type", "n", "total")
