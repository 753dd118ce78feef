"""Archives of frames as tables: compressing, reading, verifying, rebuilding and extracting.

A store folder has four Parquet tables. ``frames``: archive, storage_idx, code, length, crc, or_mask, shell_sha.
``entries``: archive, entry_no, storage_idx, acq_idx, header, name, size, mtime. ``shells``: archive, shell_sha, shell.
``archives``: one row of metadata and the trailer. The row of ``archives`` is written last and every reader starts from
it, so frames of an unfinished write are never seen; each write has a ``batch`` of its own, so a repeated one adds no
frames to an earlier one.

Only identifiers, names and codes are shuffled; pixels are decoded where they are used. The digest of a whole archive
is a fold in byte order, one task for an archive.
"""

from __future__ import annotations

import hashlib
import os
import time
import uuid
from collections import Counter
from collections.abc import Iterator
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.functions.scalars import archive_kind, safe_name
from strataframe.operators import codec
from strataframe.operators.catalog import acquisition_order
from strataframe.operators.frames import even_picks
from strataframe.sources import tar
from strataframe.sources.storage import drop_folder, size_of, state_of, store

FORMAT_VERSION = 2
#: Frames that the shift is guessed from; every frame is checked against it.
SHIFT_SAMPLE = 400
#: So many chosen entries become literals of the scan.
LITERALS = 1000
_LAYOUT = ("rows", "cols", "dtype", "px_start", "px_len", "is_tiff")
_META = "archive string, error string, source_bytes long, state_size long, state_mtime long, n_sampled int, shift int, sampled_payload_bits int, maxval int, member_bytes long, first_member string, rows int, cols int, dtype string, px_start int, px_len int, is_tiff boolean, shell binary"


class UnsupportedArchive(ValueError):
    pass


class SourceChanged(RuntimeError):
    pass


class UnverifiedDiscard(RuntimeError):
    """A member is to be dropped without a verified copy elsewhere."""


def _frame_places(file, size: int, mixed: bool) -> tuple[int, str, list[int]] | None:
    """(size, first name, offsets of the data) of the frames: the uniform members, or where ``mixed`` those of the most frequent size."""
    if mixed:
        data = [(x.size, x.data_offset, x.name) for x in tar.walk(file) if x.size]
        if not data:
            return None
        counts = Counter(n for n, _, _ in data)  # of equally frequent sizes the one seen first
        most = counts.most_common(1)[0][0]
        return most, next(name for n, _, name in data if n == most), [at for n, at, _ in data if n == most]
    plan = tar.uniform_prefix(file, size)
    if plan.first is None:
        return None
    first = tar.entry_at(file, plan.first)
    return first.size, first.name, range(plan.first + tar.BLOCK, plan.first + tar.BLOCK + plan.uniform * plan.stride, plan.stride)


def probe(spark: SparkSession, *paths: str, shape: tuple[int, int] | None = None, sample: int = SHIFT_SAMPLE, mixed: bool = False) -> DataFrame:
    """Geometry, shift and payload bits of each archive from up to ``sample`` evenly spaced members; an archive that fails gives its error.

    mixed: frames may lie among other members; all headers are read and the most frequent size is theirs.
    """

    def one(path: str) -> dict:
        system, at = store(path)
        size, mtime = state_of(path)
        row = {"archive": path, "source_bytes": size, "state_size": size, "state_mtime": mtime}
        with system.open_input_file(at) as file:
            found = _frame_places(file, size, mixed)
            if found is None:
                return row | {"error": "EMPTY"}
            width, name, places = found
            row |= {"member_bytes": width, "first_member": name}
            layout, mask, top, picks = None, 0, 0, even_picks(len(places), sample)
            for k in picks:
                file.seek(places[k])
                raw = file.read(width)
                if layout is None:
                    layout = codec.detect(raw, shape)
                    row |= {c: getattr(layout, c) for c in _LAYOUT} | {"shell": codec.split(raw, layout)[1]}
                px = np.frombuffer(codec.split(raw, layout)[0], layout.dtype).astype(np.uint16)
                mask |= int(np.bitwise_or.reduce(px))
                top = max(top, int(px.max()))
        shift = (mask & -mask).bit_length() - 1 if mask else 0
        return row | {"n_sampled": len(picks), "shift": shift, "sampled_payload_bits": max(mask.bit_length() - shift, 0), "maxval": top}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                try:
                    row = one(path)
                except (ValueError, OSError) as e:  # one bad archive doesn't end the census
                    row = {"archive": path, "error": f"{type(e).__name__}: {e}"}
                yield pa.RecordBatch.from_pylist([row], schema=_PROBE)

    return tar.archives_of(spark, *paths).mapInArrow(run, _META)


_ARROW_OF = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}
_PROBE = pa.schema([(c.split()[0], _ARROW_OF[c.split()[1]]) for c in _META.split(", ")])


def uniformity(spark: SparkSession, *paths: str) -> DataFrame:
    """(archive, uniform, n_members, break_at_member, next_names): whether all members with data have one size and lie side by side.

    Some dozens of headers are read: a bisection for the end of the uniform part, then up to eight entries after it. Where
    it breaks, n_members and break_at_member are the members before the break and next_names those found after it.
    """
    out = pa.schema([("archive", pa.string()), ("uniform", pa.bool_()), ("n_members", pa.int64()), ("break_at_member", pa.int64()), ("next_names", pa.list_(pa.string()))])

    def run(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, at = store(path)
                with system.open_input_file(at) as file:
                    plan = tar.uniform_prefix(file, size_of(path))
                    after = [x for x, _ in zip(tar.walk(file, plan.end), range(8), strict=False)] if plan.first is not None else []
                odd = [x.name for x in after if x.size]
                yield pa.RecordBatch.from_pylist([{"archive": path, "uniform": not odd, "n_members": plan.uniform, "break_at_member": plan.uniform if odd else None, "next_names": odd}], schema=out)

    return tar.archives_of(spark, *paths).mapInArrow(run, "archive string, uniform boolean, n_members long, break_at_member long, next_names array<string>")


def _digests(spark: SparkSession, meta: DataFrame) -> DataFrame:
    """(archive, source_sha256, kept_sha256, kept_bytes, pixels_sha256, trailer) of the sources, in one sequential read of each.

    kept: the entries without data and those of the frames' size, and a trailer as tar writers make it.
    """
    out = pa.schema([("archive", pa.string()), ("source_sha256", pa.string()), ("kept_sha256", pa.string()), ("kept_tar_bytes", pa.int64()), ("pixels_sha256", pa.string()), ("trailer", pa.binary())])

    def run(batches):
        for batch in batches:
            for path, start, length, member in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                whole, kept, pixels, end, n = hashlib.sha256(), hashlib.sha256(), hashlib.sha256(), 0, 0
                system, at = store(path)
                total = size_of(path)
                with system.open_input_file(at) as file:
                    for x in tar.walk(file):
                        file.seek(x.data_offset)
                        raw = file.read(x.end - x.data_offset)
                        whole.update(x.header)
                        whole.update(raw)
                        if x.size in (0, member):
                            kept.update(x.header)
                            kept.update(raw)
                            n += tar.BLOCK + len(raw)
                        if x.size == member:
                            pixels.update(raw[start : start + length])
                        end = x.end
                    file.seek(end)
                    trailer = file.read(total - end)
                whole.update(trailer)
                kept.update(tar.synthetic_trailer(n))
                yield pa.RecordBatch.from_pylist([{"archive": path, "source_sha256": whole.hexdigest(), "kept_sha256": kept.hexdigest(), "kept_tar_bytes": n + len(tar.synthetic_trailer(n)), "pixels_sha256": pixels.hexdigest(), "trailer": trailer}], schema=out)

    return meta.select("archive", "px_start", "px_len", "member_bytes").mapInArrow(run, "archive string, source_sha256 string, kept_sha256 string, kept_tar_bytes long, pixels_sha256 string, trailer binary")


def preflight(meta_rows: list, min_age: float) -> None:
    """Refuses archives that can't be read or that were written to less than ``min_age`` seconds ago."""
    for m in meta_rows:
        if m["error"]:
            raise UnsupportedArchive(f"{m['archive']}: {m['error']}")
        if time.time() - m["state_mtime"] / 1e9 < min_age:
            raise SourceChanged(f"{m['archive']} was written to less than {min_age:.0f} s ago")


def check_discard(entries: DataFrame, evidence: DataFrame) -> None:
    """Raises unless each entry of another size than the frames is in ``evidence`` (archive, name, size) as verified."""
    proof = evidence.where("verified").select("archive", "name", "size").distinct()
    open_ = entries.join(proof, ["archive", "name", "size"], "left_anti").select("archive", "name").take(5)
    if open_:
        raise UnverifiedDiscard(f"no verified copy of {[tuple(r) for r in open_]}")


def census(spark: SparkSession, server: str, *paths: str, shape: tuple[int, int] | None = None, sample: int = 3) -> DataFrame:
    """A census row of each archive: kind, size, estimated frames, geometry, shift, payload bits and the greatest sample seen."""
    found = probe(spark, *paths, shape=shape, sample=sample)
    frames = F.floor(F.col("source_bytes") / (512 + F.ceil(F.col("member_bytes") / 512) * 512))
    columns = {c: F.coalesce(c, F.lit(0)) for c in ("member_bytes", "rows", "cols", "maxval")}
    return found.select(
        F.lit(server).alias("server"), F.col("archive").alias("path"), F.col("source_bytes").alias("bytes"), archive_kind(F.col("first_member"), F.col("error")).alias("kind"), columns["member_bytes"].alias("member_bytes"),
        F.coalesce(frames, F.lit(0)).cast("long").alias("est_frames"), columns["rows"].alias("rows"), columns["cols"].alias("cols"), F.coalesce("shift", F.lit(-1)).alias("shift"), F.coalesce("sampled_payload_bits", F.lit(0)).alias("payload_bits"),
        columns["maxval"].alias("maxval"), F.col("first_member"), F.col("error"),
    )


def same_place(source: str, target: str) -> bool:
    """Whether two local paths are one file, by name or by link; a target like that must not be written."""
    return os.path.realpath(source) == os.path.realpath(target) or os.path.exists(source) and os.path.exists(target) and os.path.samefile(source, target)


def _list_once(spark: SparkSession, sources: list[str], target: str, scan: str) -> str:
    """Writes all headers to ``target``; a planned scan that finds members out of place is done again as a walk. Returns how it was done."""
    try:
        tar.read_tars(spark, *sources, scan=scan).drop("body").write.parquet(target)
        return scan
    except Exception as e:
        if scan == "walk" or "MalformedArchive" not in str(e) or "scan=walk" not in str(e):
            raise
        tar.read_tars(spark, *sources, scan="walk").drop("body").write.mode("overwrite").parquet(target)
        return "walk"


def compress(spark: SparkSession, sources: list[str], folder: str, shape: tuple[int, int] | None = None, min_age: float = 0, evidence: DataFrame | None = None, scan: str = "auto") -> DataFrame:
    """Writes tar archives to the store ``folder`` and returns their ``archives`` rows.

    Every frame is decoded again and compared before it is written; any difference ends the job before the ``archives``
    rows are. Members of other sizes are refused, or dropped if ``evidence`` has a verified copy of each of them.
    """
    batch = uuid.uuid4().hex
    partial = evidence is not None
    meta = probe(spark, *sources, shape=shape, mixed=partial).collect()  # a row for each archive
    preflight(meta, min_age)
    known = spark.createDataFrame(meta, _META).repartition(max(1, len(meta)))
    staging = f"{folder}/staging/batch={batch}"
    scan = _list_once(spark, sources, staging, "walk" if partial else scan)
    bodies = tar.read_tars(spark, *sources, bodies=True, scan=scan)
    listed = spark.read.parquet(staging).join(F.broadcast(known.select("archive", "member_bytes")), "archive")
    other = listed.where("size > 0 and size <> member_bytes")
    if partial:
        check_discard(other, evidence)
    else:
        odd = other.select("archive", "size").distinct().take(4)
        if odd:
            raise UnsupportedArchive(f"members of other sizes: {[tuple(r) for r in odd]}")
    info = {m["archive"]: (codec.Layout(*(m[c] for c in _LAYOUT)), m["shift"], m["member_bytes"], hashlib.sha256(m["shell"]).hexdigest()) for m in meta}
    shared = spark.sparkContext.broadcast(info)  # a few numbers for each archive of this call
    out = pa.schema([("archive", pa.string()), ("entry_no", pa.int64()), ("code", pa.binary()), ("length", pa.int64()), ("crc", pa.int64()), ("or_mask", pa.int32()), ("shell_sha", pa.string()), ("shell", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for archive, no, size, pad_ok, raw in zip(*(b.column(b.schema.get_field_index(c)) for c in ("archive", "entry_no", "size", "pad_ok", "body")), strict=True):
                layout, shift, member, first = shared.value[archive.as_py()]
                if size.as_py() != member:
                    continue
                if not pad_ok.as_py():
                    raise UnsupportedArchive(f"{archive}: padding of entry {no} isn't zero")
                code, shell, crc, mask = codec.proven(raw.as_py(), layout, shift)
                sha = hashlib.sha256(shell).hexdigest()
                rows.append({"archive": archive.as_py(), "entry_no": no.as_py(), "code": code, "length": len(code), "crc": crc, "or_mask": mask, "shell_sha": sha, "shell": None if sha == first else shell})
            yield pa.RecordBatch.from_pylist(rows, schema=out)

    staged = f"{folder}/frames/batch={batch}"
    bodies.where("size > 0").select("archive", "entry_no", "size", "pad_ok", "body").mapInArrow(run, "archive string, entry_no long, code binary, length long, crc long, or_mask int, shell_sha string, shell binary").write.parquet(staged)
    frames = spark.read.parquet(staged)
    entries = listed.where("size = 0 or size = member_bytes") if partial else listed
    data = entries.where("size > 0")
    if partial:  # what is left is numbered anew
        from pyspark.sql import Window

        data = data.withColumn("storage_idx", F.row_number().over(Window.partitionBy("archive").orderBy("entry_no")).cast("long") - 1)
    data = acquisition_order(data, ["archive"], "name", "storage_idx").withColumn("acq_idx", F.col("acq_idx").cast("long"))
    columns = ["archive", "entry_no", "storage_idx", "acq_idx", "header", "name", "size", "mtime"]
    rest = entries.where("size = 0").withColumn("storage_idx", F.lit(None).cast("long")).withColumn("acq_idx", F.lit(None).cast("long"))
    data.select(*columns).unionByName(rest.select(*columns)).repartitionByRange("archive", "entry_no").sortWithinPartitions("archive", "entry_no").write.parquet(f"{folder}/entries/batch={batch}")
    first = known.select("archive", F.sha2("shell", 256).alias("shell_sha"), "shell")
    first.unionByName(frames.where("shell is not null").select("archive", "shell_sha", "shell").dropDuplicates(["archive", "shell_sha"])).write.parquet(f"{folder}/shells/batch={batch}")
    stats = frames.groupBy("archive").agg(F.count("*").alias("n_frames"), F.bit_or("or_mask").alias("observed_or_mask"), F.sum("length").alias("output_bytes"), F.count_distinct("shell_sha").alias("n_distinct_shells"))
    order = spark.read.parquet(f"{folder}/entries/batch={batch}").groupBy("archive").agg(F.count("*").alias("n_tar_entries"), (F.count_if(F.expr("acq_idx is null and size > 0")) == 0).alias("temporal_order_known"), F.sum(512 + F.ceil(F.col("size") / 512) * 512).alias("kept_bytes"))
    dropped = other.groupBy("archive").agg(F.sort_array(F.collect_list(F.struct("name", "size"))).alias("dropped_members"), F.sum("size").alias("dropped_bytes"))
    bits = F.length(F.when(F.col("observed_or_mask") == 0, F.lit("")).otherwise(F.bin("observed_or_mask")))
    rows = known.join(_digests(spark, known), "archive").join(stats, "archive").join(order, "archive").join(dropped, "archive", "left").select(
        "archive", F.lit(FORMAT_VERSION).alias("format_version"), F.lit(codec.CODEC).alias("codec"), "source_bytes", "n_frames", "n_tar_entries", *_LAYOUT, "shift",
        F.greatest(bits - F.col("shift"), F.lit(0)).alias("payload_bits"), "sampled_payload_bits", "observed_or_mask", "n_distinct_shells",
        "pixels_sha256", F.lit(partial).alias("partial"), F.when(F.lit(partial), F.col("kept_sha256")).alias("frames_tar_sha256"), F.when(F.lit(partial), F.col("kept_tar_bytes")).alias("frames_tar_bytes"), F.when(F.lit(not partial), F.col("source_sha256")).alias("source_tar_sha256"),
        F.when(F.lit(not partial), F.col("trailer")).alias("trailer"), "kept_bytes", F.coalesce("dropped_bytes", F.lit(0)).cast("long").alias("dropped_bytes"), "dropped_members",
        "temporal_order_known", "output_bytes", F.round(F.col("source_bytes") / F.greatest("output_bytes", F.lit(1)), 6).alias("ratio"), "state_size", "state_mtime", F.current_timestamp().alias("written"),
    ).collect()
    for m in meta:
        if state_of(m["archive"]) != (m["state_size"], m["state_mtime"]):
            raise SourceChanged(f"{m['archive']} changed while it was read")
    published = spark.createDataFrame(rows, _ARCHIVES)
    published.coalesce(1).write.parquet(f"{folder}/archives/batch={batch}")
    drop_folder(staging)
    return spark.read.parquet(f"{folder}/archives/batch={batch}").withColumn("batch", F.lit(batch))


_ARCHIVES = "archive string, format_version int, codec string, source_bytes long, n_frames long, n_tar_entries long, rows int, cols int, dtype string, px_start int, px_len int, is_tiff boolean, shift int, payload_bits int, sampled_payload_bits int, observed_or_mask int, n_distinct_shells long, pixels_sha256 string, partial boolean, frames_tar_sha256 string, frames_tar_bytes long, source_tar_sha256 string, trailer binary, kept_bytes long, dropped_bytes long, dropped_members array<struct<name:string,size:long>>, temporal_order_known boolean, output_bytes long, ratio double, state_size long, state_mtime long, written timestamp"


def archives(spark: SparkSession, folder: str) -> DataFrame:
    """Metadata of the finished archives: of repeated writes the last."""
    found = spark.read.schema(_ARCHIVES + ", batch string").parquet(f"{folder}/archives")
    newer = found.where(F.col("format_version") > FORMAT_VERSION).select("archive").take(1)
    if newer:
        raise UnsupportedArchive(f"{newer[0]['archive']} has a newer format")
    rest = [c for c in found.columns if c != "archive"]
    return found.groupBy("archive").agg(F.max_by(F.struct(*rest), F.struct("written", "batch")).alias("m")).select("archive", "m.*")


def part(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """frames, entries or shells of finished archives, with ``batch``."""
    return spark.read.parquet(f"{folder}/{name}").join(archives(spark, folder).select("archive", "batch"), ["archive", "batch"], "left_semi")


def frames(spark: SparkSession, folder: str, where: str | None = None) -> DataFrame:
    """(archive, storage_idx, acq_idx, name, samples as little-endian bytes): decoded after ``where`` has chosen entries.

    Few entries become literals, by which the files and row groups of ``frames`` are chosen (they lie in order of entries).
    """
    chosen = part(spark, folder, "entries").where("size > 0")
    coded = part(spark, folder, "frames")
    if where:
        chosen = chosen.where(where)
        if few := chosen.select("archive", "batch", "entry_no").take(LITERALS + 1):
            coded = coded.where(F.col("archive").isin(sorted({r["archive"] for r in few})) if len(few) <= LITERALS else F.lit(True))
            if len(few) <= LITERALS:
                numbers = [r["entry_no"] for r in few]
                coded = coded.where(F.col("batch").isin(sorted({r["batch"] for r in few})) & F.col("entry_no").between(min(numbers), max(numbers)) & F.col("entry_no").isin(sorted(set(numbers))))
    coded = coded.join(chosen.select("archive", "batch", "entry_no", "storage_idx", "acq_idx", "name"), ["archive", "batch", "entry_no"])
    rows = coded.join(archives(spark, folder).select("archive", "batch", "shift", *_LAYOUT), ["archive", "batch"])
    out = pa.schema([("archive", pa.string()), ("storage_idx", pa.int64()), ("acq_idx", pa.int64()), ("name", pa.string()), ("rows", pa.int32()), ("cols", pa.int32()), ("pixels", pa.binary())])

    def run(batches):
        for b in batches:
            done = []
            for r in b.to_pylist():
                x = codec.samples(r["code"], r["crc"], codec.Layout(*(r[c] for c in _LAYOUT)), r["shift"])
                done.append({c: r[c] for c in ("archive", "storage_idx", "acq_idx", "name", "rows", "cols")} | {"pixels": x.astype("<u2").tobytes()})
            yield pa.RecordBatch.from_pylist(done, schema=out)

    return rows.select("archive", "storage_idx", "acq_idx", "name", "code", "crc", "shift", *_LAYOUT).mapInArrow(run, "archive string, storage_idx long, acq_idx long, name string, rows int, cols int, pixels binary")


_MEMBER = ["entry_no", "header", "name", "size", "mtime", "code", "crc", "shell", "shift", *_LAYOUT]


def _members(spark: SparkSession, folder: str) -> DataFrame:
    """All kept entries with their codes and shells."""
    coded = part(spark, folder, "frames").select("archive", "batch", "entry_no", "code", "crc", "shell_sha")
    rows = part(spark, folder, "entries").select("archive", "batch", "entry_no", "storage_idx", "acq_idx", "header", "name", "size", "mtime").join(coded, ["archive", "batch", "entry_no"], "left")
    rows = rows.join(part(spark, folder, "shells"), ["archive", "batch", "shell_sha"], "left")
    return rows.select("archive", *(c for c in _MEMBER if c in rows.columns), "batch").join(archives(spark, folder).select("archive", "batch", "shift", *_LAYOUT), ["archive", "batch"])


def _files(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """(archive, batch, ``name``: the files that hold rows of the archive with their first and last entry, in order)."""
    rows = spark.read.parquet(f"{folder}/{name}").select("archive", "batch", "entry_no", F.col("_metadata.file_path").alias("file"))
    rows = rows.join(archives(spark, folder).select("archive", "batch"), ["archive", "batch"], "left_semi")
    each = rows.groupBy("archive", "batch", "file").agg(F.min("entry_no").alias("first"), F.max("entry_no").alias("last"))
    return each.groupBy("archive", "batch").agg(F.sort_array(F.collect_list(F.struct("first", "last", "file"))).alias(name))  # a row for each file


def _in_order(files: list[dict], archive: str, columns: list[str]) -> Iterator[dict]:
    """Rows of an archive by entry number, from files that each hold a range of them."""
    last = -1
    for f in files:
        if f["first"] <= last:
            raise codec.LosslessCheckFailed(f"{archive}: files overlap at entry {f['first']}")
        last = f["last"]
        system, at = store(unquote(f["file"]))
        scan = ds.dataset(at, filesystem=system, format="parquet").scanner(columns=columns, filter=ds.field("archive") == archive, batch_size=256, use_threads=False, batch_readahead=2)
        for batch in scan.to_batches():
            yield from batch.to_pylist()


def _shells(folder: str, archive: str, batch: str) -> dict[str, bytes]:
    system, at = store(f"{folder}/shells/batch={batch}")
    paths = [info.path for info in system.get_file_info(fs.FileSelector(at)) if info.path.endswith(".parquet")]
    rows = ds.dataset(paths, filesystem=system, format="parquet").to_table(columns=["shell_sha", "shell"], filter=ds.field("archive") == archive, use_threads=False)
    return dict(zip(rows.column("shell_sha").to_pylist(), rows.column("shell").to_pylist(), strict=True))


def _body(r: dict) -> tuple[bytes, bytes]:
    """(member, its pixels)."""
    x = codec.Layout(*(r[c] for c in _LAYOUT))
    px = codec.samples(r["code"], r["crc"], x, r["shift"]).astype(x.dtype).tobytes()
    return codec.join(px, r["shell"], x), px


def _rebuild(spark: SparkSession, folder: str, target: str | None, chosen: str | None) -> DataFrame:
    """One task for an archive reads its files in order and folds or writes its bytes; nothing but file names is shuffled."""
    out = pa.schema([("archive", pa.string()), ("n_frames", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string()), ("ok", pa.bool_()), ("reason", pa.string()), ("path", pa.string())])

    def one(m: dict) -> dict:
        whole, pixels, n, k, length, reason = hashlib.sha256(), hashlib.sha256(), 0, 0, 0, None
        path = f"{target}/{m['place']}" if target else None
        sink = None
        if target:
            system, at = store(path)
            system.create_dir(at.rsplit("/", 1)[0], recursive=True)
            sink = system.open_output_stream(at + ".partial")
        shells = _shells(folder, m["archive"], m["batch"])
        coded = _in_order(m["frames"] or [], m["archive"], ["entry_no", "code", "crc", "shell_sha"])
        layout = {c: m[c] for c in ("shift", *_LAYOUT)}
        try:
            for e in _in_order(m["entries"] or [], m["archive"], ["entry_no", "header", "size"]):
                piece = e["header"]
                if e["size"]:
                    f = next(coded, None)
                    if f is None or f["entry_no"] != e["entry_no"]:
                        raise codec.LosslessCheckFailed(f"no frame for entry {e['entry_no']}")
                    raw, px = _body(f | layout | {"shell": shells[f["shell_sha"]]})
                    pixels.update(px)
                    piece += raw + bytes(-len(raw) % tar.BLOCK)
                    n += 1
                whole.update(piece)
                length += len(piece)
                k += 1
                if sink:
                    sink.write(piece)
        except (codec.LosslessCheckFailed, KeyError, zstandard.ZstdError) as e:
            reason = str(e)
        end = tar.synthetic_trailer(length) if m["trailer"] is None else m["trailer"]
        whole.update(end)
        length += len(end)
        if sink:
            sink.write(end)
            sink.close()
        # a whole archive is proven by the digest of its source, a partial one by that of what was kept of it
        digest, size = (m["frames_tar_sha256"], m["frames_tar_bytes"]) if m["partial"] else (m["source_tar_sha256"], m["source_bytes"])
        ok = None if digest is None else whole.hexdigest() == digest
        if reason is None and (n, k) != (m["n_frames"], m["n_tar_entries"]):
            reason = f"{n} frames, {k} entries"
        elif reason is None and m["pixels_sha256"] and pixels.hexdigest() != m["pixels_sha256"]:
            reason = "pixels differ"
        elif reason is None and size is not None and length != size:
            reason = "size differs"
        elif reason is None and ok is False:
            reason = "digest differs"
        ok = False if reason else ok
        if sink:
            if ok is False:
                system.delete_file(at + ".partial")
            else:
                system.move(at + ".partial", at)
        return {"archive": m["archive"], "n_frames": n, "bytes": length, "sha256": whole.hexdigest(), "ok": ok, "reason": reason, "path": path}

    def run(batches):
        for b in batches:
            for m in b.to_pylist():
                yield pa.RecordBatch.from_pylist([one(m)], schema=out)

    meta = archives(spark, folder)
    # the last part of the path names the file, or the whole path where several archives share it
    plain, name = F.regexp_replace(F.regexp_replace("archive", "^[a-z0-9]+:/*", ""), "^/+|/+$", ""), F.regexp_extract("archive", "([^/]+)/*$", 1)
    shared = meta.groupBy(name.alias("name")).agg(F.count("*").alias("sharing"))
    meta = meta.withColumn("name", name).join(shared, "name").withColumn("place", F.when(F.col("sharing") > 1, plain).otherwise(F.col("name")))
    meta = meta.where(F.col("archive") == chosen) if chosen else meta
    rows = meta.select("archive", "batch", "shift", *_LAYOUT, "trailer", "pixels_sha256", "source_tar_sha256", "frames_tar_sha256", "frames_tar_bytes", "n_frames", "n_tar_entries", "source_bytes", "partial", "place")
    for table in ("frames", "entries"):
        rows = rows.join(_files(spark, folder, table), ["archive", "batch"], "left")
    return rows.repartition("archive").mapInArrow(run, "archive string, n_frames long, bytes long, sha256 string, ok boolean, reason string, path string")


def verify(spark: SparkSession, folder: str, archive: str | None = None) -> DataFrame:
    """Rebuilds each archive to its digest without writing: (archive, n_frames, bytes, sha256, ok, reason). Partial archives are compared to the digest of what was kept of them; ok is null only where a store has none."""
    return _rebuild(spark, folder, None, archive).drop("path")


def decompress(spark: SparkSession, folder: str, target: str, archive: str | None = None) -> DataFrame:
    """Writes the archives back as tar files below ``target``; a file whose digest differs is not left there."""
    return _rebuild(spark, folder, target, archive)


def member(spark: SparkSession, folder: str, archive: str, where: str) -> bytes:
    """The one member that ``where`` chooses (of entries), as it was in the tar."""
    chosen = part(spark, folder, "entries").where((F.col("archive") == archive) & F.expr(where)).select("batch", "entry_no").first()
    rows = _members(spark, folder).where((F.col("archive") == archive) & (F.col("batch") == chosen["batch"]) & (F.col("entry_no") == chosen["entry_no"]))
    return _body(rows.first().asDict())[0]


def extract(spark: SparkSession, folder: str, archive: str, target: str, first: int = 0, stop: int | None = None, order: str = "acquisition", overwrite: bool = False) -> DataFrame:
    """Writes members as files below ``target`` (a mounted folder) with name and time; (name, path, bytes). Unsafe names are refused before anything is written."""
    rows = _members(spark, folder).where(F.col("archive") == archive)
    bad = rows.where(~safe_name(F.col("name"))).select("name").take(1)
    if bad:
        raise ValueError(f"unsafe member name {bad[0]['name']!r}")
    rows = rows.join(_window(spark, folder, archive, first, stop, order).select("entry_no"), "entry_no", "left_semi") if first or stop is not None else rows
    out = pa.schema([("name", pa.string()), ("path", pa.string()), ("bytes", pa.int64())])

    def run(batches):
        for b in batches:
            done = []
            for r in b.to_pylist():
                path = os.path.join(target, *r["name"].replace("\\", "/").split("/"))
                if r["header"][156:157] == b"5" or r["name"].endswith("/"):
                    os.makedirs(path, exist_ok=True)
                    continue
                os.makedirs(os.path.dirname(path), exist_ok=True)
                if os.path.exists(path) and not overwrite:
                    raise FileExistsError(path)
                raw = _body(r)[0] if r["size"] else b""
                with open(path + ".partial", "wb") as file:
                    file.write(raw)
                os.replace(path + ".partial", path)
                os.utime(path, (r["mtime"], r["mtime"]))
                done.append({"name": r["name"], "path": path, "bytes": len(raw)})
            yield pa.RecordBatch.from_pylist(done, schema=out)

    return rows.select(*_MEMBER).mapInArrow(run, "name string, path string, bytes long")


def literal(column: str, value: str) -> str:
    """SQL condition that a column has a text."""
    text = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"{column} = '{text}'"


def _window(spark: SparkSession, folder: str, archive: str, first: int, stop: int | None, order: str) -> DataFrame:
    """Entries of a range of frames with their ``slot``; the end is clamped, an empty range is refused."""
    meta = archives(spark, folder).where(F.col("archive") == archive).first()
    if meta is None:
        raise KeyError(archive)
    stop = meta["n_frames"] if stop is None else min(stop, meta["n_frames"])
    if not 0 <= first < stop:
        raise ValueError(f"no frames in {first}:{stop}")
    by = "acq_idx" if order == "acquisition" and meta["temporal_order_known"] else "storage_idx"
    rows = part(spark, folder, "entries").where((F.col("archive") == archive) & F.col(by).between(first, stop - 1))
    return rows.select("archive", "entry_no", "storage_idx", "name", (F.col(by) - first).alias("slot"))


def extract_binary(spark: SparkSession, folder: str, archive: str, target: str, first: int = 0, stop: int | None = None, order: str = "acquisition", byteorder: str = "little") -> dict:
    """Writes frames one after the other to a flat file (on a mounted folder), each task at its frames' positions; returns its description."""
    meta = archives(spark, folder).where(F.col("archive") == archive).first()
    if same_place(archive, target):
        raise ValueError(f"{target} is the source itself")
    slots = _window(spark, folder, archive, first, stop, order)
    by = "acq_idx" if order == "acquisition" and meta["temporal_order_known"] else "storage_idx"
    chosen = frames(spark, folder, f"{literal('archive', archive)} and {by} between {first} and {first + slots.count() - 1}").withColumn("slot", F.col(by) - first)
    width, swap = meta["px_len"], byteorder == "source" and meta["dtype"] == ">u2"
    n = slots.count()
    with open(target + ".partial", "wb") as file:
        file.truncate(n * width)

    def run(batches):
        with open(target + ".partial", "r+b") as file:
            for b in batches:
                for slot, px in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    file.seek(slot * width)
                    file.write(codec.byteswap16(px) if swap else px)
                yield pa.RecordBatch.from_pydict({"n": pa.array([b.num_rows], pa.int64())})

    done = chosen.select("slot", "pixels").mapInArrow(run, "n long").agg(F.sum("n")).first()[0]
    if done != n:
        os.remove(target + ".partial")
        raise codec.LosslessCheckFailed(f"{done} of {n} frames written")
    os.replace(target + ".partial", target)
    return {"file": target, "n_frames": n, "rows": meta["rows"], "cols": meta["cols"], "dtype": meta["dtype"] if byteorder == "source" else "<u2", "order": order, "first": first, "bytes": n * width, "source": archive, "temporal_order_known": meta["temporal_order_known"]}
