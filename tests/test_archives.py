import hashlib
import io
import os
import re
import tarfile

import numpy as np
import pytest

from strataframe.operators import codec, container
from strataframe.reader import ArchiveReader
from strataframe.sources import tar


def stack(n=12, rows=40, cols=48, shift=0, seed=0):
    rng = np.random.default_rng(seed)
    base = 1500 + 900 * np.sin(np.arange(rows)[:, None] / 7) * np.cos(np.arange(cols) / 9)
    return ((base + rng.normal(0, 12, (n, rows, cols))).astype(np.uint16) << shift).astype(np.uint16)


def add(t, name, body, mtime=1_700_000_000, kind=tarfile.REGTYPE):
    info = tarfile.TarInfo(name)
    info.size, info.mtime, info.type = len(body), mtime, kind
    t.addfile(info, io.BytesIO(body))


def raw_tar(path, frames, extra=(), first_folder=False, names=None):
    with tarfile.open(path, "w", format=tarfile.USTAR_FORMAT) as t:
        if first_folder:
            add(t, "1/", b"", kind=tarfile.DIRTYPE)
        for k, f in enumerate(frames):
            add(t, names[k] if names else f"1/frame-{k}", f.astype("<u2").tobytes(), 1_700_000_000 + k)
        for name, body in extra:
            add(t, name, body)
    return str(path)


def tiff(frame, order=">"):
    import struct

    code = ">H" if order == ">" else "<H"
    px = frame.astype(order + "u2").tobytes()
    tags = [(256, 4, frame.shape[1]), (257, 4, frame.shape[0]), (258, 3, 16), (259, 3, 1), (273, 4, 8), (277, 3, 1), (279, 4, len(px))]
    ifd = struct.pack(code, len(tags))
    for tag, kind, value in tags:
        ifd += struct.pack(order + "HHI", tag, kind, 1) + (struct.pack(order + "HH", value, 0) if kind == 3 else struct.pack(order + "I", value))
    return (b"MM" if order == ">" else b"II") + struct.pack(order + "HI", 42, 8 + len(px)) + px + ifd + bytes(4)


def test_fast_scan_equals_walk_and_tarfile(spark, tmp_path):
    path = raw_tar(tmp_path / "a.tar", stack(), [("1/", b"")], first_folder=True)
    fast = tar.read_tars(spark, path, bodies=True, range_bytes=10_000)
    assert fast.rdd.getNumPartitions() > 3
    rows, slow = (x.orderBy("entry_no").collect() for x in (fast, tar.read_tars(spark, path, bodies=True, scan="walk")))
    assert rows == slow
    with tarfile.open(path) as t:
        assert [(r.name.rstrip("/"), r.size, r.data_offset, r.mtime) for r in rows] == [(m.name.rstrip("/"), m.size, m.offset_data, m.mtime) for m in t.getmembers()]


def test_uneven_members_by_walk(spark, tmp_path):
    bodies = [bytes([k]) * n for k, n in enumerate((300, 5000, 700, 20000))]
    with tarfile.open(tmp_path / "u.tar", "w") as t:
        for k, b in enumerate(bodies):
            add(t, f"m{k}", b)
    path = str(tmp_path / "u.tar")
    assert [bytes(r.body) for r in tar.read_tars(spark, path, bodies=True).orderBy("entry_no").collect()] == bodies
    row = container.uniformity(spark, path).first()
    assert (row.uniform, row.n_members, row.break_at_member, row.next_names) == (False, 1, 1, ["m1", "m2", "m3"])


def test_size_fields():
    assert tar.number(bytes([0x80]) + (12_000_000_000).to_bytes(11, "big")) == 12_000_000_000
    assert tar.number(b"\0" * 12) == 0 and tar.number(b"00000000144\0") == 100
    with pytest.raises(tar.MalformedArchive):
        tar.number(b"99999999999\0")
    assert tar.checksum_ok(tar.header("x" * 90 + "/" + "y" * 60, 5))


def test_codec_is_exact_on_any_samples():
    rng = np.random.default_rng(1)
    for shape in ((1, 1), (1, 9), (9, 1), (17, 23)):
        for x in (rng.integers(0, 65536, shape), np.zeros(shape), np.full(shape, 65535)):
            x = x.astype(np.uint16)
            assert (codec.decode(codec.encode(x), *shape) == x).all()
    x = rng.integers(0, 4096, 64).astype(np.uint16)
    assert (codec.unpack12(codec.pack12(x)) == x).all()


@pytest.mark.parametrize("kind", ["raw", "big", "little"])
def test_compress_verify_rebuild_and_read(spark, tmp_path, kind):
    frames = stack(shift=4)
    names = [f"1/frame_{k}{'' if kind == 'raw' else '.tiff'}" for k in range(12)]
    order = sorted(range(12), key=lambda k: names[k])
    path = tmp_path / "s.tar"
    with tarfile.open(path, "w", format=tarfile.USTAR_FORMAT) as t:
        add(t, "1/", b"", kind=tarfile.DIRTYPE)
        for k in order:
            add(t, names[k], frames[k].astype("<u2").tobytes() if kind == "raw" else tiff(frames[k], ">" if kind == "big" else "<"))
        add(t, "2/", b"", kind=tarfile.DIRTYPE)
    folder = str(tmp_path / "store")
    meta = container.compress(spark, [str(path)], folder, shape=(40, 48) if kind == "raw" else None).first()
    assert (meta.n_frames, meta.n_tar_entries, meta["shift"], meta.temporal_order_known, meta.n_distinct_shells) == (12, 14, 4, True, 1)
    assert meta.source_tar_sha256 == hashlib.sha256(path.read_bytes()).hexdigest()
    assert container.verify(spark, folder).first().ok
    done = container.decompress(spark, folder, str(tmp_path / "out")).first()
    assert done.ok and open(done.path, "rb").read() == path.read_bytes()
    r = ArchiveReader(spark, folder, str(path))
    assert len(r) == 12 and (r[10] == frames[10]).all() and (r.frame_by_storage_index(2) == frames[order[2]]).all()
    assert (r[8:2:-3] == frames[8:2:-3]).all() and (r.frames([3, 3, 0]) == frames[[3, 3, 0]]).all()
    assert r.member_name(11) == names[11]
    with pytest.raises(IndexError):
        r.frame(-1)
    container.extract(spark, folder, str(path), str(tmp_path / "x")).collect()
    with tarfile.open(path) as t:
        assert all(open(tmp_path / "x" / m.name, "rb").read() == t.extractfile(m).read() and os.stat(tmp_path / "x" / m.name).st_mtime == m.mtime for m in t.getmembers() if m.isfile())
    told = container.extract_binary(spark, folder, str(path), str(tmp_path / "f.bin"), 3, 99)
    assert told["n_frames"] == 9 and (np.fromfile(tmp_path / "f.bin", "<u2").reshape(-1, 40, 48) == frames[3:]).all()


def damage(spark, folder):
    """Swaps the codes of two frames."""
    whole = spark.read.parquet(f"{folder}/frames").orderBy("entry_no").collect()
    at = f"{folder}/frames/{os.listdir(folder + '/frames')[0]}"
    swapped = [r.asDict() | {"code": whole[1 - k].code, "crc": whole[1 - k].crc} if k < 2 else r.asDict() for k, r in enumerate(whole)]
    schema = spark.read.parquet(at).schema
    spark.createDataFrame([tuple(r[c] for c in schema.names) for r in swapped], schema).write.mode("overwrite").parquet(at)


def test_damage_is_told(spark, tmp_path):
    path = raw_tar(tmp_path / "s.tar", stack(4))
    folder = str(tmp_path / "store")
    container.compress(spark, [path], folder, shape=(40, 48))
    damage(spark, folder)
    row = container.verify(spark, folder).first()
    assert row.ok is False and row.reason == "pixels differ"


def test_refusals_and_partial_archives(spark, tmp_path):
    extra = [("notes.txt", b"hello"), ("big.bin", b"\1" * 4000)]
    path = raw_tar(tmp_path / "p.tar", stack(6), extra)
    with pytest.raises(container.UnsupportedArchive):
        container.compress(spark, [path], str(tmp_path / "a"), shape=(40, 48))
    with pytest.raises(container.UnsupportedArchive, match="GeometryUnknown"):
        container.compress(spark, [path], str(tmp_path / "a"))
    with pytest.raises(container.SourceChanged):
        container.compress(spark, [path], str(tmp_path / "a"), shape=(40, 48), min_age=3600)
    proof = [(path, "notes.txt", 5, True), (path, "big.bin", 4000, False)]
    evidence = lambda rows: spark.createDataFrame(rows, "archive string, name string, size long, verified boolean")
    with pytest.raises(container.UnverifiedDiscard):
        container.compress(spark, [path], str(tmp_path / "a"), shape=(40, 48), evidence=evidence(proof))
    meta = container.compress(spark, [path], str(tmp_path / "a"), shape=(40, 48), evidence=evidence([r[:3] + (True,) for r in proof])).first()
    assert (meta.partial, meta.dropped_bytes, meta.source_tar_sha256, meta.n_frames) == (True, 4005, None, 6)
    row = container.verify(spark, str(tmp_path / "a")).first()
    assert row.ok is True and row.bytes % 10240 == 0 and row.bytes == meta.frames_tar_bytes and row.sha256 == meta.frames_tar_sha256
    done = container.decompress(spark, str(tmp_path / "a"), str(tmp_path / "out")).first()
    assert hashlib.sha256(open(done.path, "rb").read()).hexdigest() == meta.frames_tar_sha256
    with tarfile.open(done.path) as t:
        assert t.getnames() == [f"1/frame-{k}" for k in range(6)]
    damage(spark, str(tmp_path / "a"))
    row = container.verify(spark, str(tmp_path / "a")).first()
    assert row.ok is False and row.reason == "pixels differ"


def test_frames_among_other_members_by_their_modal_size(spark, tmp_path):
    frames = stack(6)
    path = str(tmp_path / "m.tar")
    with tarfile.open(path, "w", format=tarfile.USTAR_FORMAT) as t:
        add(t, "notes.txt", b"hello")
        add(t, "1/", b"", kind=tarfile.DIRTYPE)
        for k, f in enumerate(frames):
            add(t, f"1/frame-{k}", f.astype("<u2").tobytes())
            if k == 2:
                add(t, "middle.bin", b"\2" * 999)
    proof = spark.createDataFrame([(path, "notes.txt", 5, True), (path, "middle.bin", 999, True)], "archive string, name string, size long, verified boolean")
    folder = str(tmp_path / "store")
    meta = container.compress(spark, [path], folder, shape=(40, 48), evidence=proof).first()
    assert (meta.n_frames, meta.n_tar_entries, meta.first_member if "first_member" in meta else None) == (6, 7, None)
    assert container.verify(spark, folder).first().ok and not os.path.exists(f"{folder}/staging/batch={meta.batch}")
    r = ArchiveReader(spark, folder, path)
    assert all((r[k] == frames[k]).all() for k in (0, 3, 5))


def test_a_scan_out_of_step_is_done_as_a_walk(spark, tmp_path):
    frames = stack(9)
    path = str(tmp_path / "gap.tar")
    with tarfile.open(path, "w", format=tarfile.USTAR_FORMAT) as t:
        for k, f in enumerate(frames):
            add(t, f"1/frame-{k}", f.astype("<u2").tobytes())
            if k == 3:  # as long as a member, so that headers lie in step again behind it
                for j in range(9):
                    add(t, f"d{j}/", b"", kind=tarfile.DIRTYPE)
    folder = str(tmp_path / "store")
    meta = container.compress(spark, [path], folder, shape=(40, 48)).first()
    assert (meta.n_frames, meta.n_tar_entries) == (9, 18) and container.verify(spark, folder).first().ok


def test_same_names_of_two_folders_stay_apart(spark, tmp_path):
    paths = []
    for k in range(2):
        (tmp_path / f"in{k}").mkdir()
        paths.append(raw_tar(tmp_path / f"in{k}" / "s.tar", stack(3, seed=k)))
    folder = str(tmp_path / "store")
    container.compress(spark, paths, folder, shape=(40, 48))
    done = container.decompress(spark, folder, str(tmp_path / "out")).collect()
    assert len({r.path for r in done}) == 2 and all(r.ok and open(r.path, "rb").read() == open(r.archive, "rb").read() for r in done)


def test_few_frames_are_read_by_literals(spark, tmp_path):
    path = raw_tar(tmp_path / "s.tar", stack(6))
    folder = str(tmp_path / "store")
    container.compress(spark, [path], folder, shape=(40, 48))
    rows = container.frames(spark, folder, "acq_idx = 2")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"\(entry_no#\d+L = 2\)", plan) and rows.count() == 1


def test_acquisition_order_of_many_members(spark):
    from pyspark.sql import functions as F

    from strataframe.operators import catalog

    named = spark.range(300_000).select(F.lit("a").alias("archive"), F.col("id").alias("storage"), F.concat(F.lit("1/frame-"), 299_999 - F.col("id")).alias("name"))
    rows = catalog.acquisition_order(named, ["archive"], "name", "storage")
    assert rows.where("acq_idx <> 299999 - storage or acq_idx is null").count() == 0


def test_uneven_padding_set_low_bits_and_flipped_bytes_are_refused(spark, tmp_path):
    frames = stack(12, shift=4)
    path = raw_tar(tmp_path / "p.tar", frames)
    raw = bytearray(open(path, "rb").read())
    body = 512 + 40 * 48 * 2
    raw[body + 3] = 1  # in the padding of the first member
    open(tmp_path / "pad.tar", "wb").write(raw)
    with pytest.raises(Exception, match="padding"):
        container.compress(spark, [str(tmp_path / "pad.tar")], str(tmp_path / "a"), shape=(40, 48))
    x = codec.Layout(40, 48, "<u2", 0, 3840, False)
    odd = frames[0].copy()
    odd[3, 3] |= 1
    with pytest.raises(codec.LosslessCheckFailed, match="below the shift"):
        codec.proven(odd.astype("<u2").tobytes(), x, 4)
    code, _, crc, _ = codec.proven(frames[0].astype("<u2").tobytes(), x, 4)
    flipped = bytearray(code)
    flipped[len(code) // 2] ^= 1
    with pytest.raises(codec.LosslessCheckFailed, match="checksum"):
        codec.samples(bytes(flipped), crc, x, 4)


def test_source_byte_order_of_flat_files(spark, tmp_path):
    frames = stack(4)
    with tarfile.open(tmp_path / "b.tar", "w", format=tarfile.USTAR_FORMAT) as t:
        for k, f in enumerate(frames):
            add(t, f"1/frame_{k}.tiff", tiff(f))
    folder = str(tmp_path / "store")
    container.compress(spark, [str(tmp_path / "b.tar")], folder)
    told = container.extract_binary(spark, folder, str(tmp_path / "b.tar"), str(tmp_path / "f.bin"), byteorder="source")
    assert told["dtype"] == ">u2" and (np.fromfile(tmp_path / "f.bin", ">u2").reshape(-1, 40, 48) == frames).all()
