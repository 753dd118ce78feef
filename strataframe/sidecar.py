"""Files beside a store's archives: a readme, a receipt, a preview frame; and the description of flat binary files.

All are made from rows of ``archives`` and a few frames, one small file for each archive.
"""

from __future__ import annotations

import json
import struct

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.operators import container
from strataframe.operators.frames import even_picks
from strataframe.sources.storage import store

#: Frames looked at for a preview.
PROBES = 7
_HOW = "how_to_decompress"


def stem(archive: str) -> str:
    return archive.rstrip("/").rsplit("/", 1)[-1]


def readme(meta: dict, folder: str, verified: bool) -> str:
    """Text on one archive: what it was, what it is, how to get it back."""
    name, out = stem(meta["archive"]), meta["output_bytes"] or 1
    whole = "the tar of the kept members" if meta["partial"] else "the original tar"
    proof = f"It was rebuilt after writing, and {whole} came out byte for byte." if verified else f"Each frame was decoded and compared when it was written; {whole} has not been rebuilt since."
    shift = f", {meta['shift']} zero low bits left out" if meta["shift"] else ""
    lines = [
        f"# {name}: losslessly compressed frames", "",
        f"{meta['n_frames']:,} frames of {meta['rows']} x {meta['cols']} ({meta['dtype']}). {proof}", "",
        "| | |", "|-|-|",
        f"| original | {meta['source_bytes']:,} bytes |", f"| compressed | {meta['output_bytes']:,} bytes |",
        f"| ratio | {meta['source_bytes'] / out:.2f}, {100 - 100 * out / max(1, meta['source_bytes']):.1f} % saved |",
        f"| codec | {meta['codec']}, lossless{shift} |", f"| written | {meta['written']} |", f"| SHA-256 | {meta['source_tar_sha256'] or meta['frames_tar_sha256']} |", "",
    ]
    if meta["partial"]:
        lines += [f"{meta['dropped_bytes']:,} bytes of other members were left out; verified copies of them lie elsewhere:", "", *[f"- {m['name']} ({m['size']:,} bytes)" for m in meta["dropped_members"] or ()], ""]
    order = "in order of acquisition" if meta["temporal_order_known"] else "in the order of the tar, as the order of acquisition isn't known"
    lines += ["## Getting it back", "", f"    python -m strataframe decompress {folder} TARGET --archive {name}    # the tar", f"    python -m strataframe extract {folder} TARGET --archive {name}       # its members as files", f"    python -m strataframe extract {folder} FILE --archive {name} --bin   # one flat array, {order}", ""]
    return "\n".join(lines)


def receipt(meta: dict, extra: dict | None = None) -> str:
    """JSON of an archive's metadata without instructions, with ``extra`` (such as byte_identical)."""
    told = {k: v for k, v in meta.items() if k not in (_HOW, "trailer")} | (extra or {})
    return json.dumps(told, indent=2, sort_keys=True, default=str)


def binary_description(told: dict, meta: dict) -> str:
    """JSON beside a flat file, which has no header: the layout and how to open it."""
    rows, cols, name = told["rows"], told["cols"], stem(told["file"])
    big = told["dtype"].startswith(">")
    info = {
        "file": name, "layout": "frames one after the other, each by rows", "n_frames": told["n_frames"], "rows": rows, "cols": cols,
        "dtype": told["dtype"], "bytes_per_sample": 2, "frame_bytes": 2 * rows * cols, "total_bytes": told["bytes"], "frame_order": told["order"], "first_frame": told["first"],
        "temporal_order_known": told["temporal_order_known"], "source_dtype": meta["dtype"], "byteswapped_from_source": told["dtype"] != meta["dtype"], "source_archive": told["source"],
        "numpy": f"np.memmap({name!r}, dtype={told['dtype']!r}, mode='r').reshape(-1, {rows}, {cols})",
        "matlab": f"f = fopen('{name}', 'r', '{'b' if big else 'l'}'); d = permute(reshape(fread(f, Inf, '*uint16'), [{cols} {rows} {told['n_frames']}]), [2 1 3]); fclose(f);",
    }
    return json.dumps(info, indent=2)


def tiff(frame: np.ndarray, text: str = "") -> bytes:
    """A frame as a little-endian, uncompressed, one-page, 16-bit TIFF."""
    px = np.ascontiguousarray(frame, "<u2").tobytes()
    note = text.encode("ascii", "replace") + b"\0"
    at = 8 + len(px)
    at += at % 2
    tags = [(256, 4, 1, frame.shape[1]), (257, 4, 1, frame.shape[0]), (258, 3, 1, 16), (259, 3, 1, 1), (262, 3, 1, 1), (270, 2, max(5, len(note)), 0), (273, 4, 1, 8), (277, 3, 1, 1), (278, 4, 1, frame.shape[0]), (279, 4, 1, len(px))]
    after = at + 2 + 12 * len(tags) + 4
    ifd = struct.pack("<H", len(tags))
    for tag, kind, count, value in tags:
        value = after if tag == 270 else value
        ifd += struct.pack("<HHI", tag, kind, count) + (struct.pack("<HH", value, 0) if kind == 3 else struct.pack("<I", value))
    return b"II" + struct.pack("<HI", 42, at) + px + bytes(at - 8 - len(px)) + ifd + bytes(4) + note.ljust(5, b"\0")


def preview(spark: SparkSession, folder: str, archive: str) -> tuple[int, bytes] | None:
    """(number, TIFF) of a frame worth looking at: of up to ``PROBES`` evenly spaced ones that with the highest 99th percentile, the first of
    equal ones. Where members are TIFF files it is the member itself."""
    meta = container.archives(spark, folder).where(F.col("archive") == archive).first()
    if meta is None or not meta["n_frames"]:
        return None
    by = "acq_idx" if meta["temporal_order_known"] else "storage_idx"
    picks = even_picks(meta["n_frames"], PROBES)
    rows = container.frames(spark, folder, f"{container.literal('archive', archive)} and {by} in ({','.join(map(str, picks))})")
    best = None
    for r in rows.orderBy(by).collect():  # PROBES frames at most
        x = np.frombuffer(bytes(r["pixels"]), "<u2").reshape(r["rows"], r["cols"])
        score = float(np.percentile(x, 99.0))
        if best is None or score > best[0]:
            best = score, r[by], x, r["name"]
    _, number, x, name = best
    if meta["is_tiff"]:
        return number, container.member(spark, folder, archive, f"{by} = {number}")
    return number, tiff(x, f"Frame {number} of {stem(archive)} ({name}). The archive has no shape of its own; {meta['rows']} x {meta['cols']} was given when it was compressed.")


def _put(path: str, body: bytes) -> None:
    system, at = store(path)
    system.create_dir(at.rsplit("/", 1)[0], recursive=True)
    with system.open_output_stream(at) as out:
        out.write(body)


def write(spark: SparkSession, folder: str, target: str, archive: str | None = None, verified: DataFrame | None = None, with_preview: bool = True) -> list[str]:
    """Writes readme, receipt and preview of each archive (or of one) below ``target``; verified: (archive, ok) of a verification. Returns the paths."""
    rows = container.archives(spark, folder)
    rows = rows.where(F.col("archive") == archive) if archive else rows
    rows = rows.join(verified.select("archive", "ok"), "archive", "left") if verified is not None else rows.withColumn("ok", F.lit(None).cast("boolean"))
    done = []
    for r in rows.toLocalIterator():  # a row for each archive
        meta = r.asDict(recursive=True)
        ok = bool(meta.pop("ok"))
        name = f"{target}/{stem(meta['archive'])}"
        extra = {"byte_identical": ok, "byte_identical_verified": ok}
        files = {f"{name}.README.md": readme(meta, folder, ok).encode(), f"{name}.receipt.json": receipt(meta, extra).encode()}
        if with_preview and (found := preview(spark, folder, meta["archive"])):
            files[f"{name}.frame.tif"] = found[1]
        for path, body in files.items():
            _put(path, body)
            done.append(path)
    return done


def refresh(spark: SparkSession, folder: str, target: str, log: DataFrame, dry_run: bool = True) -> DataFrame:
    """(archive, action): what became, or with ``dry_run`` would become, of the readme and receipt of each success of the log (archive, ok).

    What the store lacks is ``missing``. Previews stay as they are.
    """
    done = log.where("ok").groupBy("archive").agg(F.lit(True).alias("ok"))
    here = container.archives(spark, folder).select("archive", F.lit(True).alias("there"))
    planned = done.join(here, "archive", "left").select("archive", F.when(F.col("there"), F.lit("would write" if dry_run else "written")).otherwise("missing").alias("action"))
    if not dry_run:
        for r in planned.where("action = 'written'").toLocalIterator():
            write(spark, folder, target, r["archive"], done, with_preview=False)
    return planned
