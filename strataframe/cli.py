"""Command line: python -m strataframe COMMAND ...; exit code 0 where all went well, 1 where a check failed, 2 for refused arguments."""

from __future__ import annotations

import argparse
import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe import sidecar
from strataframe.operators import container, gates, integrity
from strataframe.operators.catalog import latest
from strataframe.reader import ArchiveReader
from strataframe.sources import files
from strataframe.streaming import eventlog, incremental


def _session(threads: int | None) -> SparkSession:
    """The session there is; else one of its own, on ``threads`` cores unless Spark's configuration names a master."""
    found = SparkSession.getActiveSession()
    if found is not None:
        return found
    builder = SparkSession.builder.appName("strataframe").config("spark.ui.showConsoleProgress", "false")
    return (builder.master(f"local[{threads or '*'}]") if "MASTER" not in os.environ else builder).getOrCreate()


def _archive(spark: SparkSession, folder: str, name: str | None) -> str:
    """Full name of the archive: given whole, or as the last part of its path; the only one where none is given."""
    rows = container.archives(spark, folder).select("archive")
    if name:
        rows = rows.where((F.col("archive") == name) | F.col("archive").endswith("/" + name))
    found = [r["archive"] for r in rows.take(2)]
    if len(found) != 1:
        raise KeyError(f"{'no' if not found else 'more than one'} archive {name or ''} in {folder}".replace("  ", " "))
    return found[0]


def _show(rows: DataFrame, say) -> None:
    for r in rows.toLocalIterator():
        say(json.dumps(r.asDict(recursive=True), default=str))


def _shape_of(spark: SparkSession, npy: str) -> tuple[int, int]:
    content = spark.read.format("binaryFile").load(npy).select(files.array_shape(F.col("content")).alias("s")).first()["s"]
    if content is None:
        raise ValueError(f"{npy} has no two-dimensional shape")
    return content["rows"], content["cols"]


def compress(spark, a, say) -> int:
    shape = tuple(a.shape) if a.shape else _shape_of(spark, a.shape_from) if a.shape_from else None
    began = time.time()
    done = container.compress(spark, [a.source], a.store, shape=shape)
    verified = container.verify(spark, a.store, None).join(done.select("archive"), "archive", "left_semi")
    for r in done.toLocalIterator():
        spent = max(time.time() - began, 1e-9)
        say(f"{r['archive']}: {r['n_frames']} frames, {r['source_bytes']} -> {r['output_bytes']} bytes, ratio {r['ratio']:.2f}, {r['source_bytes'] / 1e6 / spent:.1f} MB/s")
        if not a.no_sidecar:
            sidecar.write(spark, a.store, f"{a.store}/sidecars", r["archive"], verified)
    return 0 if verified.where("not coalesce(ok, false)").isEmpty() else 1


def decompress(spark, a, say) -> int:
    rows = container.decompress(spark, a.store, a.target, _archive(spark, a.store, a.archive) if a.archive else None).collect()
    for r in rows:
        say(f"{r['archive']}: {r['bytes']} bytes, {'identical' if r['ok'] else r['reason'] or 'no hash to compare'}")
    return 0 if all(r["ok"] for r in rows) else 1


def extract(spark, a, say) -> int:
    archive = _archive(spark, a.store, a.archive)
    first, stop = a.frames or (0, None)
    if not a.bin:
        rows = container.extract(spark, a.store, archive, a.target, first, stop, a.order, a.overwrite).agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes")).first()
        say(f"{rows['n']} files, {rows['bytes'] or 0} bytes")
        return 0
    if os.path.exists(a.target) and not a.overwrite:
        raise FileExistsError(a.target)
    told = container.extract_binary(spark, a.store, archive, a.target, first, stop, a.order, a.byteorder)
    meta = container.archives(spark, a.store).where(F.col("archive") == archive).first().asDict()
    with open(a.target + ".json", "w") as file:
        file.write(sidecar.binary_description(told, meta))
    say(f"{told['n_frames']} frames, {told['bytes']} bytes")
    return 0


def check(spark, a, say) -> int:
    rows = container.verify(spark, a.store, _archive(spark, a.store, a.archive) if a.archive else None).collect()
    for r in rows:
        say(f"{r['archive']}: {'rebuilds ' + r['sha256'] if r['ok'] else r['reason'] or 'no hash to compare'}")
    return 0 if all(r["ok"] for r in rows) else 1


def verify(spark, a, say) -> int:
    same = integrity.same_files(spark, a.one, a.other)
    say("identical" if same else "different")
    return 0 if same else 1


def info(spark, a, say) -> int:
    rows = container.archives(spark, a.store)
    _show((rows.where(F.col("archive") == _archive(spark, a.store, a.archive)) if a.archive else rows).drop("trailer"), say)
    return 0


def peek(spark, a, say) -> int:
    x = ArchiveReader(spark, a.store, _archive(spark, a.store, a.archive)).frame(a.frame)
    say(f"frame {a.frame}: {x.shape[0]} x {x.shape[1]}, least {x.min()}, most {x.max()}, mean {x.mean():.2f}")
    return 0


def batch(spark, a, say) -> int:
    log = f"{a.store}/events" if a.event_log is None else a.event_log
    eventlog.sweep_unfinished(spark, a.store, a.quiet_seconds, log)
    eventlog.sweep_unpublished(spark, a.store, a.quiet_seconds)
    if a.dry_run:
        for path in incremental.remaining(spark, a.source, a.store, a.quiet_seconds)[: a.limit]:
            say(path)
        return 0
    shape = tuple(a.shape) if a.shape else None
    rows = incremental.supervise(spark, a.source, a.store, shape, a.quiet_seconds, a.limit, a.rounds, a.pause, a.stop_file)
    failed = [r for r in rows if not r["ok"]]
    say(f"{len(rows) - len(failed)} done, {len(failed)} failed")
    for r in failed:
        say(f"{r['archive']}: {r['error']}")
    return 1 if failed else 0


_TABLES = {
    "log": "session string, tar string, store string, ok boolean, source_bytes long, output_bytes long, tar_sha256 string",
    "files": "path string, bytes long, mtime long",
    "receipts": "store string, format_version int, source_tar_sha256 string, byte_identical boolean, byte_identical_verified boolean, error string",
    "offsite": "key string, bytes long, error string",
    "sessions": "session string, tar string, store string, key string",
    "measured": "session string, name string, value string",
    "versions": "key string, action string, version string, uploaded long, bytes long, sha256 string",
    "ledger": "checked_utc string, session string, all_pass boolean, tier string, tar_bytes_now long, tar_mtime long",
}


def _tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The gate's tables: JSON lines in ``folder/NAME``; one that isn't there is empty."""
    from pyarrow import fs

    from strataframe.sources.storage import store

    out = {}
    for name, schema in _TABLES.items():
        system, at = store(f"{folder}/{name}")
        there = system.get_file_info(at).type != fs.FileType.NotFound
        out[name] = spark.read.schema(schema).json(f"{folder}/{name}") if there else spark.createDataFrame([], schema)
    return out


def gate(spark, a, say) -> int:
    """check: all conditions of a session, added to the ledger. sweep: the cheap ones of all. delete: whether it may be deleted (it never is here). offsite: the proofs."""
    t = _tables(spark, a.tables)
    log = latest(t["log"].where("ok"), ["session"], ["source_bytes", "store"])
    sessions = t["sessions"].where(F.col("session") == a.session) if a.action != "sweep" else t["sessions"]
    if a.action == "offsite":
        wanted = sessions.join(t["receipts"].select("store", F.col("source_tar_sha256").alias("sha256")), "store", "left")
        rows = gates.offsite_proof(wanted, t["files"], t["versions"]).collect()
        for r in rows:
            say(json.dumps(r.asDict()))
        return 0 if rows and all(r["gone"] and r["retained"] and r["restores"] for r in rows) else 1
    found = gates.conditions(sessions, log, t["files"], t["receipts"], t["offsite"], None if a.action == "sweep" or a.cheap else t["measured"])
    if a.action == "sweep":
        rows = gates.sweep(found)
        eventlog.write_csv(rows, a.out) if a.out else _show(rows.orderBy("session"), say)
        return 0
    state = sessions.join(t["files"].select(F.col("path").alias("tar"), F.col("bytes").alias("tar_bytes_now"), F.col("mtime").alias("tar_mtime")), "tar").select("session", "tar_bytes_now", "tar_mtime")
    if a.action == "check":
        rows = gates.sweep(found, gates.CHEAP if a.cheap else gates.KEYS).collect()
        for r in found.where(F.col("key").isin(*(gates.CHEAP if a.cheap else gates.KEYS))).collect():
            say(f"{'PASS' if r['ok'] else '----' if r['ok'] is None else 'FAIL'} {r['key']} {r['note']}".rstrip())
        passed = bool(rows) and rows[0]["verdict"] == "PASS"
        line = state.select(F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("checked_utc"), "session", F.lit(passed).alias("all_pass"), F.lit("cheap" if a.cheap else "full").alias("tier"), "tar_bytes_now", "tar_mtime")
        line.coalesce(1).write.mode("append").json(f"{a.tables}/ledger")
        return 0 if passed else 1
    request = spark.createDataFrame([(a.session, a.confirm)], "session string, confirm string")
    r = gates.authorize(request, state, t["ledger"], found, F.current_timestamp(), a.max_age_hours, a.allow_cheap).first()
    say(f"{'may be deleted' if r['allowed'] else 'refused: ' + r['reason']}")
    return 0 if r["allowed"] else 2


def status(spark, a, say) -> int:
    rows = container.archives(spark, a.store).agg(F.count("*").alias("n"), F.sum("source_bytes").alias("source"), F.sum("output_bytes").alias("output"), F.max("written").alias("last")).first()
    left = len(incremental.remaining(spark, a.source, a.store, 0)) if a.source else None
    ratio = (rows["source"] or 0) / max(1, rows["output"] or 0)
    say(f"{rows['n']} archives, {(rows['source'] or 0) / 1e12:.3f} -> {(rows['output'] or 0) / 1e12:.3f} TB, ratio {ratio:.2f}, last written {rows['last']}" + ("" if left is None else f", {left} to do"))
    return 0


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m strataframe")
    p.add_argument("--threads", type=int, help="cores of a session of its own")
    p.add_argument("--quiet", action="store_true")
    sub = p.add_subparsers(dest="command", required=True)

    def command(f, *positional, **options):
        c = sub.add_parser(f.__name__)
        for name in positional:
            c.add_argument(name)
        for name, given in options.items():
            c.add_argument("--" + name.replace("_", "-"), **given)
        c.set_defaults(run=f)
        return c

    name = {"archive": {}}
    shape = {"shape": {"type": int, "nargs": 2, "metavar": ("ROWS", "COLS")}}
    flag = {"action": "store_true"}
    command(compress, "source", "store", **shape, shape_from={}, no_sidecar=flag)
    command(decompress, "store", "target", **name)
    command(extract, "store", "target", **name, bin=flag, frames={"type": int, "nargs": 2}, order={"choices": ("acquisition", "storage"), "default": "acquisition"}, byteorder={"choices": ("little", "source"), "default": "little"}, overwrite=flag)
    command(check, "store", **name)
    command(verify, "one", "other")
    command(info, "store", **name)
    command(peek, "store", **name, frame={"type": int, "default": 0})
    command(batch, "source", "store", **shape, quiet_seconds={"type": float, "default": 3600}, limit={"type": int}, rounds={"type": int, "default": 1}, pause={"type": float, "default": 60}, stop_file={}, event_log={}, dry_run=flag)
    g = command(gate, "tables", session={}, confirm={}, cheap=flag, allow_cheap=flag, max_age_hours={"type": float, "default": 24}, out={})
    g.add_argument("action", choices=("check", "delete", "offsite", "sweep"))
    command(status, "store", source={})
    return p


def main(arguments: list[str] | None = None, say=print) -> int:
    a = parser().parse_args(arguments)
    spark = _session(a.threads)
    try:
        return a.run(spark, a, (lambda *_: None) if a.quiet else say)
    except (KeyError, ValueError, FileExistsError, FileNotFoundError, RuntimeError) as e:
        print(f"{type(e).__name__}: {e}", file=sys.stderr)
        return 2
