"""Archive queries: the frames of each label are a tar archive of their own, written to the shared folder and read back."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from strataframe.operators import codec, container
from strataframe.plans.frame_queries import FRAMES_SQL, frames
from strataframe.sources import tar
from strataframe.sources.storage import shared_folder

QUERIES: dict = {}
ORACLE: dict = {}

#: Members lie in the order of their names, 512 bytes of header and 128 of samples padded to 512.
ENTRIES_SQL = "(select label, vec_id, '1/frame-' || vec_id as name, row_number() over (partition by label order by '1/frame-' || vec_id) - 1 as entry_no from embeddings)"
SHAPE = (8, 8)


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return keep


def _to_bytes(batches):
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array([np.asarray(x, "<u2").tobytes() for x in b.column(3).to_pylist()], pa.binary())], names=["archive", "entry_no", "name", "body"])


def archives_of(spark, d) -> str:
    """Folder of one tar for each label."""
    folder = shared_folder(spark, "tars")
    named = frames(spark, d).select(F.col("label").cast("string").alias("archive"), F.concat(F.lit("1/frame-"), "vec_id").alias("name"), "samples")
    # the writer sorts by entry_no within an archive; names of one width sort as numbers do
    from pyspark.sql import Window

    placed = named.withColumn("entry_no", F.row_number().over(Window.partitionBy("archive").orderBy("name")).cast("long") - 1)
    tar.write_tars(placed.select("archive", "entry_no", "name", "samples").mapInArrow(_to_bytes, "archive string, entry_no long, name string, body binary"), folder).collect()  # a row for each archive
    return folder


def _label(archive):
    return F.regexp_extract(archive, "([0-9-]+)\\.tar$", 1).cast("int")


def stored(spark, d) -> str:
    folder = shared_folder(spark, "store")
    container.compress(spark, [archives_of(spark, d)], folder, shape=SHAPE)
    return folder


@query(f"select label, entry_no, entry_no as storage_idx, name, 128::bigint as size, entry_no * 1024 + 512 as data_offset, '0' as typeflag, true as pad_ok from {ENTRIES_SQL}")
def s2_tar_scan(spark, d):
    rows = tar.read_tars(spark, archives_of(spark, d), bodies=True, range_bytes=64 << 10)
    return rows.select(_label("archive").alias("label"), "entry_no", "storage_idx", "name", "size", "data_offset", "typeflag", "pad_ok")


@query(f"select label, count(*) as n, sum(128)::bigint as bytes from {ENTRIES_SQL} group by 1")
def s1_sequential_scan(spark, d):
    rows = tar.read_tars(spark, archives_of(spark, d), scan="walk")
    return rows.groupBy(_label("archive").alias("label")).agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))


@query("select label, (1024 + (10240 - (n * 1024 + 1024) % 10240) % 10240)::bigint as trailer_bytes from (select label, count(*) n from embeddings group by 1)")
def s6_trailing_bytes(spark, d):
    return tar.trailers(spark, archives_of(spark, d)).select(_label("archive").alias("label"), F.octet_length("trailer").cast("long").alias("trailer_bytes"))


@query(f"select label, 8 as rows, 8 as cols, bit_count((o & -o) - 1)::int as shift, (length(bin(o)) - bit_count((o & -o) - 1))::int as sampled_payload_bits, '1/frame-' || f as first_member from (select label, bit_or(v) o from (select label, unnest(s) v from {FRAMES_SQL}) group by 1) join (select label, min(vec_id::varchar) f from embeddings group by 1) using (label)")
def s27_archive_probe(spark, d):
    found = container.probe(spark, archives_of(spark, d), shape=SHAPE, sample=1 << 30)
    return found.select(_label("archive").alias("label"), "rows", "cols", "shift", "sampled_payload_bits", "first_member")


@query("select label, true as uniform, count(*) as n_members, null::bigint as break_at_member from embeddings group by 1")
def s28_uniformity(spark, d):
    return container.uniformity(spark, archives_of(spark, d)).select(_label("archive").alias("label"), "uniform", "n_members", "break_at_member")


@query("select label, count(*) as n_frames, count(*) as n_tar_entries, 8 as rows, 8 as cols, true as temporal_order_known, false as partial, (ceil((count(*) * 1024 + 1024) / 10240.0) * 10240)::bigint as source_bytes from embeddings group by 1")
def k1_compress(spark, d):
    folder = shared_folder(spark, "store")
    done = container.compress(spark, [archives_of(spark, d)], folder, shape=SHAPE)
    return done.select(_label("archive").alias("label"), "n_frames", "n_tar_entries", "rows", "cols", "temporal_order_known", "partial", "source_bytes")


@query(f"select f.label, row_number() over (partition by f.label order by f.vec_id) - 1 as acq_idx, '1/frame-' || f.vec_id as name, sha256(array_to_string(f.s, ',')) as digest from {FRAMES_SQL} f")
def x7_decoded_frames(spark, d):
    """Frames of the store in acquisition order, decoded."""

    def numbers(batches):
        for b in batches:
            text = [",".join(map(str, np.frombuffer(x, "<u2").tolist())) for x in b.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(text)], names=["archive", "acq_idx", "name", "samples"])

    rows = container.frames(spark, stored(spark, d)).select("archive", "acq_idx", "name", "pixels").mapInArrow(numbers, "archive string, acq_idx long, name string, samples string")
    return rows.select(_label("archive").alias("label"), "acq_idx", "name", F.sha2("samples", 256).alias("digest"))


@query("select label, count(*) as n_frames, (ceil((count(*) * 1024 + 1024) / 10240.0) * 10240)::bigint as bytes, true as ok from embeddings group by 1")
def i4_verify(spark, d):
    return container.verify(spark, stored(spark, d)).select(_label("archive").alias("label"), "n_frames", "bytes", "ok")


@query("select label, true as same, true as ok from embeddings group by 1")
def k4_decompress(spark, d):
    """Rebuilt tars against the digests of the sources, read anew."""
    folder = stored(spark, d)
    done = container.decompress(spark, folder, shared_folder(spark, "rebuilt"))
    told = container.archives(spark, folder).select("archive", "source_tar_sha256")
    return done.join(told, "archive").select(_label("archive").alias("label"), (F.col("sha256") == F.col("source_tar_sha256")).alias("same"), "ok")


def _codec_trip(batches):
    for b in batches:
        out = []
        for key, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            x = np.asarray(s, np.uint16).reshape(SHAPE)
            shifted = codec.unpack12(codec.pack12(x >> 4)).reshape(SHAPE) << 4
            out.append({"vec_id": key, "exact": bool((codec.decode(codec.encode(x), *SHAPE) == x).all()), "packed": bool((shifted == x).all())})
        yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("vec_id", pa.int64()), ("exact", pa.bool_()), ("packed", pa.bool_())]))


@query("select vec_id, true as exact, true as packed from embeddings")
def x6_codec_round_trip(spark, d):
    return frames(spark, d).select("vec_id", "samples").mapInArrow(_codec_trip, "vec_id long, exact boolean, packed boolean")
