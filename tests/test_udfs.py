import numpy as np
from test_archives import raw_tar, stack, tiff

from strataframe.functions import udfs
from strataframe.sources import tar


def test_functions_of_sql(spark, tmp_path):
    udfs.register(spark)
    frames = stack(3)
    rows = [(k, bytearray(f.astype("<u2").tobytes()), bytearray(tiff(f)), 40, 48) for k, f in enumerate(frames)] + [(9, None, None, None, None)]
    spark.createDataFrame(rows, "k int, raw binary, tif binary, r int, c int").createOrReplaceTempView("frames")
    got = spark.sql("select k, raw, decode_frame(encode_frame(raw, r, c), r, c) back, byteswap16(byteswap16(raw)) twice, frame_coherence(raw, r, c) x, tiff_layout(tif) t from frames order by k").collect()
    for r in got[:3]:
        assert r.raw == r.back == r.twice and 0 < r.x <= 1 and (r.t.rows, r.t.cols, r.t.dtype) == (40, 48, ">u2")
    assert got[3].back is None and got[3].x is None and got[3].t.rows is None
    archive = open(raw_tar(tmp_path / "s.tar", frames), "rb").read()
    spark.createDataFrame([(bytearray(archive), bytearray(archive[:512]), bytearray(b"x" * 512))], "a binary, h binary, b binary").createOrReplaceTempView("tars")
    entries = spark.sql("select e.* from tars, lateral tar_entries(a) e order by entry_no").collect()
    assert [(e.name, e.size) for e in entries] == [(f"1/frame-{k}", 3840) for k in range(3)]
    assert (np.frombuffer(archive[entries[1].data_offset :][:3840], "<u2").reshape(40, 48) == frames[1]).all()
    assert tuple(spark.sql("select tar_checksum_ok(h), tar_checksum_ok(b), tar_checksum_ok(null) from tars").first()) == (True, False, None)
    assert spark.sql("select * from factor_pairs(64)").count() == 3 and tar.padded(1) == 512
