"""The command line, sidecars, the event log and listings, on archives made here."""

import json
import os
import time

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_archives import raw_tar, stack, tiff

from strataframe import cli, sidecar
from strataframe.functions import scalars as S
from strataframe.operators import codec, container, integrity, ordered
from strataframe.operators import shape as H
from strataframe.sources import files
from strataframe.streaming import eventlog, incremental


def call(*arguments):
    said = []
    return cli.main(list(map(str, arguments)), said.append), said


def test_commands_from_compress_to_status(spark, tmp_path):
    frames = stack(6, shift=4)
    path = raw_tar(tmp_path / "s.tar", frames)
    store = str(tmp_path / "store")
    assert call("compress", path, store)[0] == 2  # no shape
    code, said = call("compress", path, store, "--shape", 40, 48)
    assert code == 0 and "6 frames" in said[0]
    side = f"{store}/sidecars/s.tar"
    assert "byte for byte" in open(side + ".README.md").read() and json.load(open(side + ".receipt.json"))["byte_identical_verified"] is True
    preview = open(side + ".frame.tif", "rb").read()
    x = codec.detect(preview)
    picture = np.frombuffer(codec.split(preview, x)[0], x.dtype).reshape(x.rows, x.cols)
    best = max(range(6), key=lambda k: (np.percentile(frames[k], 99), -k))
    assert (picture == frames[best]).all()
    assert call("check", store)[0] == 0
    code, said = call("decompress", store, tmp_path / "out")
    assert code == 0 and open(tmp_path / "out" / "s.tar", "rb").read() == open(path, "rb").read()
    assert call("verify", path, tmp_path / "out" / "s.tar") == (0, ["identical"]) and call("verify", path, side + ".README.md")[0] == 1
    assert call("extract", store, tmp_path / "x", "--archive", "s.tar")[0] == 0
    checks = {r.check: r.ok for r in integrity.extraction_checks(spark, store, path, str(tmp_path / "x")).collect()}
    assert checks == dict.fromkeys(("count", "size", "pixels", "samples", "permutation"), True)
    os.remove(tmp_path / "x" / "1" / "frame-2")
    checks = {r.check: r.ok for r in integrity.extraction_checks(spark, store, path, str(tmp_path / "x")).collect()}
    assert not checks["count"] and not checks["samples"] and checks["pixels"]
    flat = tmp_path / "f.bin"
    assert call("extract", store, flat, "--bin", "--frames", 1, 4)[0] == 0 and call("extract", store, flat, "--bin")[0] == 2
    told = json.load(open(f"{flat}.json"))
    assert (np.memmap(flat, told["dtype"], "r").reshape(-1, told["rows"], told["cols"]) == frames[1:4]).all() and told["total_bytes"] == os.path.getsize(flat)
    assert f"{frames[2].max()}" in call("peek", store, "--frame", 2)[1][0]
    assert json.loads(call("info", store)[1][0])["n_frames"] == 6
    assert call("status", store, "--source", tmp_path)[1][0].startswith("1 archives")
    assert call("peek", store, "--archive", "other")[0] == 2 and call("--quiet", "check", store) == (0, [])
    log = spark.createDataFrame([(path, True), ("gone", True), ("bad", False)], "archive string, ok boolean")
    os.remove(side + ".README.md")
    assert {r.archive: r.action for r in sidecar.refresh(spark, store, f"{store}/sidecars", log).collect()} == {path: "would write", "gone": "missing"}
    assert not os.path.exists(side + ".README.md")
    sidecar.refresh(spark, store, f"{store}/sidecars", log, dry_run=False)
    assert os.path.exists(side + ".README.md")


def test_batch_goes_on_and_ends(spark, tmp_path):
    (tmp_path / "in").mkdir()
    raw_tar(tmp_path / "in" / "a.tar", stack(3))
    (tmp_path / "in" / "bad.tar").write_bytes(b"no tar" * 200)
    store = str(tmp_path / "store")
    assert len(call("batch", tmp_path / "in", store, "--dry-run", "--quiet-seconds", 0)[1]) == 2
    code, said = call("batch", tmp_path / "in", store, "--shape", 40, 48, "--quiet-seconds", 0)
    assert code == 1 and said[0] == "1 done, 1 failed"
    assert incremental.remaining(spark, str(tmp_path / "in"), store, 0) == [str(tmp_path / "in" / "bad.tar")]
    (tmp_path / "stop").write_text("")
    assert incremental.supervise(spark, str(tmp_path / "in"), store, (40, 48), 0, rounds=3, pause=0, stop_file=str(tmp_path / "stop")) == []
    assert len(incremental.supervise(spark, str(tmp_path / "in"), store, (40, 48), 0, rounds=2, pause=0)) == 1


def test_gate_commands(spark, tmp_path):
    rows = {
        "sessions": {"session": "a", "tar": "t", "store": "s", "key": "k"}, "log": {"session": "a", "tar": "t", "store": "s", "ok": True, "source_bytes": 9, "output_bytes": 4, "tar_sha256": "h"},
        "receipts": {"store": "s", "format_version": 2, "source_tar_sha256": "h", "byte_identical": True, "byte_identical_verified": True}, "offsite": {"key": "k", "bytes": 4},
    }
    for name, row in rows.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "x.json").write_text(json.dumps(row))
    (tmp_path / "files").mkdir()
    (tmp_path / "files" / "x.json").write_text("\n".join(json.dumps(x) for x in ({"path": "t", "bytes": 9, "mtime": 1}, {"path": "s", "bytes": 4, "mtime": 1})))
    assert json.loads(call("gate", tmp_path, "sweep")[1][0])["verdict"] == "PASS"
    assert call("gate", tmp_path, "check", "--session", "a")[0] == 1  # the costly ones aren't measured
    assert call("gate", tmp_path, "delete", "--session", "a", "--confirm", "a") == (2, ["refused: no recent check of these bytes"])
    code, said = call("gate", tmp_path, "check", "--session", "a", "--cheap")
    assert code == 0 and len(said) == 6
    assert call("gate", tmp_path, "delete", "--session", "a", "--confirm", "a", "--allow-cheap") == (0, ["may be deleted"])
    assert call("gate", tmp_path, "offsite", "--session", "a")[0] == 1


def test_event_log_and_sweeps(spark, tmp_path):
    log, file = str(tmp_path / "log"), tmp_path / "f"
    file.write_text("12345")
    eventlog.record_write(log, str(file), existed=False, note="a, b")
    eventlog.record(log, "delete", str(tmp_path / "gone"))
    eventlog.record(None, "delete", "x")
    eventlog.record("/proc/none/at/all", "create", "x")  # never raises
    rows = eventlog.read(spark, log).orderBy("event").collect()
    assert [(r.event, r.size_bytes, r.note) for r in rows] == [("create", 5, "a, b"), ("delete", None, None)]
    (tmp_path / "d").mkdir()
    for name in ("old.partial", "new.partial", "kept"):
        (tmp_path / "d" / name).write_text("x")
    os.utime(tmp_path / "d" / "old.partial", (time.time() - 1e6,) * 2)
    assert [r.path for r in eventlog.sweep_unfinished(spark, str(tmp_path / "d"), log=log).collect()] == [str(tmp_path / "d" / "old.partial")]
    assert sorted(os.listdir(tmp_path / "d")) == ["kept", "new.partial"]
    assert {r.event: r.n for r in eventlog.rollup(eventlog.read(spark, log)).collect()} == {"create": 1, "delete": 1, "transient": 1}
    store = str(tmp_path / "store")
    container.compress(spark, [raw_tar(tmp_path / "s.tar", stack(3))], store, shape=(40, 48))
    os.makedirs(f"{store}/frames/batch=orphan")
    assert eventlog.sweep_unpublished(spark, store, 0) == [f"{store}/frames/batch=orphan"] and container.verify(spark, store).first().ok
    eventlog.write_csv(spark.createDataFrame([(1, None), (2, "a,b")], "k int, t string"), str(tmp_path / "csv"))
    assert sorted(spark.read.csv(str(tmp_path / "csv"), header=True, schema="k int, t string").collect()) == [(1, None), (2, "a,b")]


def test_listings_logs_and_manifests(spark, tmp_path):
    for path, body in (("a/x/1.tar", "12"), ("a/x/2.tar", "3456"), ("b/x/y/1.tar", "7"), ("b/n.txt", "k=1\nother\nrate = 30000")):
        (tmp_path / path).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / path).write_text(body)
    found = files.listing(spark, str(tmp_path), "*.tar")
    assert found.count() == 3 and files.listing(spark, str(tmp_path), "*.tar", max_depth=2).count() == 2
    sizes = {r.folder.rsplit("/", 2)[-2:][0] + "/" + r.folder.rsplit("/", 1)[-1]: (r.total_bytes, r.n_files) for r in files.folder_sizes(found).collect()}
    assert sizes == {"a/x": (6, 2), "x/y": (1, 1)}
    assert sorted(r.folder.rsplit("/", 2)[-2] for r in files.named(found, "x").collect()) == ["a", "b"]
    assert {r.name: r.n for r in files.name_index(found).groupBy("name").agg(F.count("*").alias("n")).collect()} == {"1.tar": 2, "2.tar": 1}
    assert {r.key: r.value for r in files.key_values(spark, str(tmp_path / "b" / "n.txt")).collect()} == {"k": "1", "rate": "30000"}
    (tmp_path / "census.csv").write_text("server,path,bytes,kind,member_bytes,est_frames,rows,cols,shift,payload_bits,maxval,has_svd,first_member,error\nS,p,5,frame-N,,,,,,,,True,1/f,\n")
    row = files.census(spark, str(tmp_path / "census.csv")).first()
    assert (row.bytes, row.rows, row["shift"], row.has_svd, row.error) == (5, 0, -1, True, None)
    (tmp_path / "list.tsv").write_text("12\ta b.tar\n")
    assert tuple(files.size_listing(spark, str(tmp_path / "list.tsv")).first()) == (12, "a b.tar")
    log = str(tmp_path / "log")
    files.append_log(spark.createDataFrame([("t1", True)], "tar string, ok boolean"), log)
    files.append_log(spark.createDataFrame([("t2", False)], "tar string, ok boolean"), log)
    with open(f"{log}/bad.json", "w") as out:
        out.write("{broken\n")
    assert sorted(r.tar for r in files.run_log(spark, log).collect()) == ["t1", "t2"]
    with pytest.raises(Exception):
        files.run_log(spark, log, strict=True).collect()
    text = files.manifest_text(spark.createDataFrame([("t1", 5, True), ("t2", 6, False)], "tar string, bytes long, all_verified boolean"), "tar").first()["json"]
    (tmp_path / "m.json").write_text(text)
    back = files.manifest(spark, str(tmp_path / "m.json"), "struct<bytes:long,all_verified:boolean>").collect()
    assert {r.archive: (r.record.bytes, r.record.all_verified) for r in back} == {"t1": (5, True), "t2": (6, False)}
    np.save(tmp_path / "a.npy", np.zeros((3, 7)))
    shape = spark.read.format("binaryFile").load(str(tmp_path / "a.npy")).select(files.array_shape(F.col("content")).alias("s")).first().s
    assert tuple(shape) == (3, 7)


def test_shapes_codecs_and_chunks(spark):
    frames = stack(3, 60, 96)
    raw = spark.createDataFrame([("a", bytearray(f.astype("<u2").tobytes())) for f in frames] + [("t", bytearray(tiff(frames[0]))), ("n", None)], "archive string, raw binary")
    size = H.shape_by_codec_size(raw).collect()
    assert [(r.archive, r.rows, r.cols) for r in size] == [("a", 60, 96)] and size[0].margin > 1
    both = H.shape_by_coherence(raw).collect()
    assert [(r.archive, r.rows, r.cols) for r in both] == [("a", 60, 96)] and both[0].margin > 0
    cells = raw.where("archive = 'a'").select(F.lit(60).alias("rows"), F.lit(96).alias("cols"), "raw")
    ratios = {r.codec: r.ratio for r in H.compare_codecs(cells, planes=True).collect()}
    assert ratios[codec.CODEC] > ratios["zlib-6"] > 1 and len(ratios) == 4
    sizes = {r.kind: r.code_bytes for r in H.transform_sizes(cells).collect()}
    assert sizes["horizontal"] < sizes["none"] and set(sizes) == {"none", "horizontal", "block", "dc"}
    x = np.cumsum(np.random.default_rng(1).integers(-3, 4, (500, 4)), 0).astype("<i2")
    chunks = spark.createDataFrame([(1, 4, bytearray(x.tobytes()))], "chunk long, channels int, raw binary")
    assert (H.unpack_channels(bytes(H.compress_chunks(chunks).first().code), 4) == x).all()
    headers = spark.createDataFrame([("a", k, bytearray(b"h" * 30 + bytes([k]))) for k in range(9)], "archive string, k long, header binary")
    row = H.redundancy(headers, ["archive"], "k").first()
    assert (row.n, row.bytes, row.mean_differing) == (9, 279, 1.0) and row.zlib_bytes < 100


def test_names_and_times(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    kinds = {"frame-7": "frame-N", "a/frame-12": "frame-N", "a/frame-12.tif": "other-tiff", "Basler_1.tiff": "basler-tiff", "x.ome.tif": "ome-tif", "notes.txt": "other"}
    assert {k: one(S.member_kind(F.lit(k))) for k in kinds} == kinds
    assert one(S.archive_kind(F.lit("frame-1"), F.lit("EMPTY"))) == "EMPTY" and one(S.archive_kind(F.lit("frame-1"), F.lit("bad"))) == "ERROR"
    assert one(S.epoch_iso(F.lit(1_700_000_000_123), True)) == "2023-11-14T22:13:20+00:00"
    assert one(S.ago(F.to_timestamp(F.lit("2024-01-01 00:00:00")), F.to_timestamp(F.lit("2024-01-03 00:00:00")))) == "2 days ago"
    assert one(S.last_parts(F.lit("/r/subj/2020-01-01/1/f.tar"))) == "subj/2020-01-01/1" and one(S.provenance()).spark
    assert one(S.share_path(F.lit("Y:\\Subjects\\a"), "//srv/s")) == "//srv/s/Subjects/a" and one(S.object_key(F.lit("Y:\\Subjects\\A\\b"), "subjects")) == "subjects/A/b"


def test_epochs_of_any_year_agree_with_sql(spark):
    import duckdb

    epochs = [0, -1, 86_399, 1_700_000_000, 253_402_300_799, 253_402_300_800, 518_393_913_601, 9_000_000_000_000, -62_135_596_801, -62_200_000_000, -70_000_000_000, -50_000_000_000]
    want = [duckdb.connect().execute(f"select strftime(make_timestamp({s}::bigint * 1000000), '%Y-%m-%dT%H:%M:%S') || '+00:00'").fetchone()[0] for s in epochs]
    rows = spark.createDataFrame([(k, s) for k, s in enumerate([*epochs, None])], "k int, s long")
    got = rows.select("k", S.epoch_iso(F.col("s")).alias("a"), S.epoch_iso(F.col("s") * 1000 + 999, True).alias("b")).orderBy("k").collect()
    assert [r.a for r in got] == [*want, None] and [r.b for r in got] == [*want, None]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:  # the hour that this zone has twice
        assert spark.range(1).select(S.epoch_iso(F.lit(1_699_164_000)).alias("x")).first().x == "2023-11-05T06:00:00+00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_ordered_cells_equal_whole_windows(spark):
    from pyspark.sql import Window

    rows = spark.range(5000).select((F.col("id") % 3).alias("g"), F.when(F.col("id") % 50 != 0, (F.col("id") * 7919) % 1000).alias("p"), F.col("id"))
    got = ordered.ranked(rows, ["g"], "p", "r", ["id"], cells=7)
    want = got.withColumn("w", F.row_number().over(Window.partitionBy("g").orderBy("p", "id")) - 1)
    assert want.where("r <> w").count() == 0 and want.count() == 5000
    assert ordered.ranked(rows.limit(0), ["g"], "p", "r").count() == ordered.spans(rows.limit(0), ["g"], "p", 3).count() == 0


def test_walks_keep_what_cannot_be_read(spark, tmp_path):
    for path in ("a/b/c/1.tar", "a/2.tar", "x.txt"):
        (tmp_path / "w" / path).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "w" / path).write_text("12")
    os.symlink(tmp_path / "w" / "a", tmp_path / "w" / "a" / "loop")
    found = files.walk(spark, str(tmp_path / "w"), 3, "[.]tar$").collect()
    rows = {(os.path.relpath(r.path, tmp_path / "w"), r.kind) for r in found}
    assert rows == {("a", "folder"), ("a/2.tar", "file"), ("a/b", "folder"), ("a/b/c", "folder")}
    missing = files.walk(spark, str(tmp_path / "none")).collect()
    assert [(r.kind, r.error.split(":")[0]) for r in missing] == [("error", "FileNotFoundError")]


def test_recording_files(spark, tmp_path):
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "1.meta").write_text("nSavedChans=385\nimSampRate=30000\nx=1")
    (tmp_path / "m" / "2.meta").write_text("nSavedChans=many")
    got = {r.path.rsplit("/", 1)[-1]: (r.n_channels, r.sample_rate) for r in files.recording_meta(spark, str(tmp_path / "m")).collect()}
    assert got == {"1.meta": (385, 30000.0), "2.meta": (0, 0.0)}
    (tmp_path / "e.csv").write_text("server,path,bytes,band,subject,date,session,has_cbin,cbin_bytes,has_ch,has_meta,n_channels,sample_rate_hz,implied_seconds,error\nS,p,,ap,s,,1,True,,,,,,,\n")
    row = files.ephys_census(spark, str(tmp_path / "e.csv")).first()
    assert (row.bytes, row.has_cbin, row.has_ch, row.sample_rate_hz) == (0, True, False, 0.0)
    records = spark.createDataFrame([("Y:\\A\\b.tar", (True, [("m", True), ("n", False)])), ("c.tar", (False, [("m", True)]))], "archive string, record struct<all_verified:boolean,discardable:array<struct<member:string,verified:boolean>>>")
    assert [r.member for r in files.verified_members(records, "y:/a/B.tar").collect()] == ["m"] and files.verified_members(records, "c.tar").count() == 0
    (tmp_path / "violet").mkdir()
    np.save(tmp_path / "violet" / "meanImage.npy", np.zeros((4, 5)))
    assert files.first_shape(spark, str(tmp_path)) == (4, 5) and files.first_shape(spark, str(tmp_path / "violet")) is None


def test_census_of_archives(spark, tmp_path):
    path = raw_tar(tmp_path / "s.tar", stack(4, shift=4), names=[f"1/frame-{k}" for k in range(4)])
    (tmp_path / "bad.tar").write_bytes(b"x" * 2000)
    rows = {r.path: r for r in container.census(spark, "S", str(tmp_path), shape=(40, 48)).collect()}
    assert (rows[path].kind, rows[path]["shift"], rows[path].rows, rows[path].est_frames >= 4) == ("frame-N", 4, 40, True) and rows[path].maxval % 16 == 0 < rows[path].maxval
    assert rows[str(tmp_path / "bad.tar")].kind == "ERROR"
    os.symlink(path, tmp_path / "link.tar")
    assert container.same_place(path, str(tmp_path / "link.tar")) and not container.same_place(path, str(tmp_path / "bad.tar"))
