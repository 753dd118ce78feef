import numpy as np
from test_archives import raw_tar, stack

from strataframe.sources import files
from strataframe.streaming import incremental


def test_run_resumes_and_logs_failures(spark, tmp_path):
    source, folder = tmp_path / "in", str(tmp_path / "store")
    source.mkdir()
    raw_tar(source / "a.tar", stack(3))
    (source / "b.tar").write_bytes(b"no archive" * 200)
    assert incremental.remaining(spark, str(source), folder) == []  # too young
    log = {r.archive.rsplit("/", 1)[1]: r for r in incremental.run(spark, str(source), folder, (40, 48), quiet=0).collect()}
    assert log["a.tar"].ok and not log["b.tar"].ok and log["b.tar"].error
    assert [p.rsplit("/", 1)[1] for p in incremental.remaining(spark, str(source), folder, 0)] == ["b.tar"]


def test_listing_and_headers(spark, tmp_path):
    (tmp_path / "x" / "y").mkdir(parents=True)
    np.save(tmp_path / "x" / "y" / "m.npy", np.zeros((3, 5)))
    (tmp_path / "x" / "r.meta").write_text("nSavedChans=385\nimSampRate=30000\nnone\n")
    found = {r.path.rsplit("/", 1)[1]: r.depth for r in files.listing(spark, str(tmp_path)).collect()}
    assert found == {"m.npy": 2, "r.meta": 1}
    assert {r.path.rsplit("/", 1)[1] for r in files.listing(spark, str(tmp_path), max_depth=1).collect()} == {"r.meta"}
    assert {r.key: r.value for r in files.key_values(spark, str(tmp_path / "x" / "r.meta")).collect()} == {"nSavedChans": "385", "imSampRate": "30000"}
    blob = spark.read.format("binaryFile").load(str(tmp_path / "x" / "y"))
    assert tuple(blob.select(files.array_shape(blob["content"]).alias("s")).first().s) == (3, 5)


def test_event_windows_on_a_stream(spark, tmp_path):
    rows = spark.sql("select timestamp_seconds(1700000000 + 900 * id) ts, if(id % 2 = 0, 'a', 'b') event_type, double(id) value from range(20)")
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    query = incremental.event_windows(stream).writeStream.format("memory").queryName("windows").outputMode("complete").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    assert query.awaitTermination(60)
    assert sorted(spark.table("windows").collect()) == sorted(incremental.event_windows(rows).collect())
    assert sum(r.n for r in spark.table("windows").collect()) == 20
