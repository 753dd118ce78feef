"""Gate, proof and choice queries: each order stands for a session, and remainders of its key decide what is missing or wrong."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataframe.functions import scalars as S
from strataframe.operators import gates as G
from strataframe.operators import picks as K
from strataframe.operators import shape as H
from strataframe.plans.catalog_queries import CENTS_SQL, cents, placed, read
from strataframe.plans.frame_queries import FRAMES_SQL, PX_SQL, frames

QUERIES: dict = {}
ORACLE: dict = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return keep


_O = f"(select o_orderkey k, {CENTS_SQL} c, o_orderstatus st, md5(o_orderkey::varchar) h from orders)"


def _tables(spark, d):
    k, c = F.col("k"), F.col("c")
    o = read(spark, d, "orders").select(F.col("o_orderkey").alias("k"), cents().alias("c"), "o_orderstatus").withColumn("h", F.md5(F.col("k").cast("string").cast("binary")))
    tar, place = F.concat(F.lit("t"), "k"), F.concat(F.lit("s"), "k")
    log = o.select(k.cast("string").alias("session"), tar.alias("tar"), place.alias("store"), (F.col("o_orderstatus") != "P").alias("ok"), c.alias("source_bytes"), F.floor(c / 2).alias("output_bytes"), F.when(k % 27 == 0, "x").otherwise(F.col("h")).alias("tar_sha256"))
    files = o.where(k % 10 != 1).select(tar.alias("path"), (c + (k % 11 == 0).cast("int")).alias("bytes"), (k % 1000).alias("mtime"))
    files = files.unionByName(o.where(k % 12 != 5).select(place.alias("path"), (F.floor(c / 2) + (k % 13 == 0).cast("int")).alias("bytes"), F.lit(0).cast("long").alias("mtime")))
    footers = o.where(k % 14 != 3).select(place.alias("store"), F.when(k % 9 == 0, 1).otherwise(2).alias("format_version"), (k % 16 == 4).alias("partial"), F.when(k % 25 != 0, F.col("h")).alias("source_tar_sha256"), F.when(k % 31 == 0, "bad").alias("error"))
    receipts = o.where(k % 8 != 6).select(place.alias("store"), F.when(k % 9 == 0, 1).otherwise(2).alias("format_version"), F.when(k % 25 != 0, F.col("h")).alias("source_tar_sha256"), (k % 15 != 2).alias("byte_identical"), (k % 17 != 2).alias("byte_identical_verified"), F.when(k % 33 == 0, "bad").alias("error"))
    offsite = o.where(k % 19 != 1).select(F.concat(F.lit("key/"), "k").alias("key"), (F.floor(c / 2) + (k % 23 == 0).cast("int")).alias("bytes"), F.lit(None).cast("string").alias("error"))
    sessions = o.select(k.cast("string").alias("session"), tar.alias("tar"), place.alias("store"), F.concat(F.lit("key/"), "k").alias("key"))
    return o, log, files, footers, receipts, offsite, sessions


_LADDER = [
    ("st = 'P'", "not recorded as successful"), ("k % 10 = 1", "tar is gone"), ("k % 12 = 5", "no store"), ("k % 13 = 0 and c // 2 <> 0", "store has another size than recorded"),
    ("k % 14 = 3 or k % 31 = 0", "store can''t be read"), ("k % 9 = 0", "format without a source hash"), ("k % 16 = 4", "store holds a part of the archive"), ("k % 25 = 0", "no source hash"),
    ("k % 11 = 0 and c <> 0", "tar has another size than when it was hashed"), ("k % 8 = 6", "no receipt"), ("k % 33 = 0", "receipt can''t be read"), ("k % 15 = 2", "receipt claims no identical rebuild"),
]
_REASON = "case " + " ".join(f"when {c} then '{r}'" for c, r in _LADDER)


@query(f"select k::varchar as session, case when r = 'metadata agree' then 'SAFE' else 'REFUSE' end verdict, r reason from (select k, {_REASON} else 'metadata agree' end r from {_O})")
def g1_deletion_audit(spark, d):
    _, log, files, footers, receipts, _, _ = _tables(spark, d)
    return G.deletion_audit(log, files, footers, receipts).select("session", "verdict", "reason")


@query(f"select k::varchar as session, case when r = 'rebuilt and hashed again' then 'SAFE' else 'REFUSE' end verdict, r reason from (select k, {_REASON} when k % 21 = 1 then 'store doesn''t rebuild its hash' when k % 22 = 7 then 'tar has another hash than recorded' else 'rebuilt and hashed again' end r from {_O})")
def g1_strict_audit(spark, d):
    o, log, files, footers, receipts, _, _ = _tables(spark, d)
    k = F.col("k")
    rebuilt = o.where(k % 42 != 1).select(F.concat(F.lit("s"), "k").alias("store"), F.col("h").alias("sha256"), (k % 21 != 1).alias("ok"))
    rehashed = o.select(F.concat(F.lit("t"), "k").alias("tar"), F.when(k % 22 == 7, "x").otherwise(F.col("h")).alias("sha256"))
    return G.deletion_audit(log, files, footers, receipts, rebuilt, rehashed).select("session", "verdict", "reason")


#: Condition -> SQL of its verdict for a logged session; C6 and C8 to C11 are measured for some.
_CONDITIONS = {
    "C2": "k % 12 <> 5 and k % 13 <> 0", "C3": "k % 8 <> 6 and k % 25 <> 0 and k % 9 <> 0 and k % 27 <> 0", "C4": "k % 10 <> 1 and k % 11 <> 0", "C5": "k % 8 <> 6 and k % 15 <> 2 and k % 17 <> 2",
    "C6": "case when k % 2 = 0 then k % 8 <> 6 and k % 25 <> 0 and k % 21 <> 1 end", "C7": "k % 19 <> 1 and k % 23 <> 0", "C8": "case when k % 2 = 0 then k % 8 <> 6 and k % 25 <> 0 and k % 22 <> 7 end",
    "C9": "case when k % 2 = 0 then k % 26 <> 4 end", "C10": "case when k % 2 = 0 and k % 26 <> 4 then k % 8 <> 6 and k % 25 <> 0 and k % 21 <> 1 end", "C11": "case when k % 4 = 0 then k % 8 <> 6 and k % 25 <> 0 and k % 28 <> 4 end",
}


def _conditions(spark, d):
    o, log, files, _, receipts, offsite, sessions = _tables(spark, d)
    k, h = F.col("k"), F.col("h")
    half = o.where(k % 2 == 0)
    cell = lambda df, name, value: df.select(k.cast("string").alias("session"), F.lit(name).alias("name"), value.cast("string").alias("value"))
    measured = cell(half, "rebuilt", F.when(k % 21 == 1, "x").otherwise(h))
    for rows, name, value in ((half, "tar", F.when(k % 22 == 7, "x").otherwise(h)), (half, "store", F.lit("y")), (half, "offsite_store", F.when(k % 26 == 4, "z").otherwise("y")), (half, "room", F.lit("false")), (o.where(k % 4 == 0), "offsite_tar", h), (o.where(k % 4 == 0), "offsite_tar_bytes", F.col("c") + (k % 28 == 4).cast("int"))):
        measured = measured.unionByName(cell(rows, name, value))
    return G.conditions(sessions, log, files, receipts, offsite, measured)


_C1 = f"select k::varchar as session, 'C1' as key, st <> 'P' ok, false derived from {_O}"
_CELLS = " union all ".join([_C1, *[f"select k::varchar, '{c}', case when st <> 'P' then {sql} end, {'coalesce(st <> ' + chr(39) + 'P' + chr(39) + ' and (' + sql + '), false)' if c == 'C10' else 'false'} from {_O}" for c, sql in _CONDITIONS.items()]])


@query(_CELLS)
def g2_gate_conditions(spark, d):
    return _conditions(spark, d).select("session", "key", "ok", "derived")


@query(f"select session, case when count(*) filter (not coalesce(ok, false)) = 0 then 'PASS' else 'REFUSE' end verdict, count(*) filter (not coalesce(ok, false)) refusals from ({_CELLS}) where key in ('C1', 'C2', 'C3', 'C4', 'C5', 'C7') and session not like '%77' group by 1 union all select k::varchar, 'ERROR', 1 from {_O} where k::varchar like '%77'")
def g3_sweep_report(spark, d):
    found = _conditions(spark, d)
    errors = found.where("session like '%77'").select("session", F.lit("unreadable").alias("error")).distinct()
    return G.sweep(found, errors=errors).select("session", "verdict", "refusals")


_STILL = " and ".join(f"({_CONDITIONS[c]})" for c in ("C2", "C3", "C4", "C5", "C7"))


@query(f"select k::varchar as session, r = 'allowed' allowed, r reason from (select k, case when k % 5 = 0 then 'the name isn''t confirmed' when k % 10 = 1 then 'no tar' when not (k % 3 <> 0 and k % 30 <= 24 and k % 7 <> 6 and k % 6 <> 5) then 'no recent check of these bytes' when not (st <> 'P' and {_STILL}) then 'something changed since the check' else 'allowed' end r from {_O})")
def g4_delete_authorization(spark, d):
    """Checks are k % 30 hours old; some failed, some were cheap, some were of another time stamp."""
    o, _, files, _, _, _, sessions = _tables(spark, d)
    k = F.col("k")
    now = F.to_timestamp(F.lit("2024-03-01 00:00:00"))
    state = sessions.join(files.select(F.col("path").alias("tar"), F.col("bytes").alias("tar_bytes_now"), F.col("mtime").alias("tar_mtime")), "tar").select("session", "tar_bytes_now", "tar_mtime")
    when = F.date_format(F.timestamp_seconds(F.unix_timestamp(now) - (k % 30) * 3600), "yyyy-MM-dd HH:mm:ss")
    ledger = o.select(when.alias("checked_utc"), k.cast("string").alias("session"), (k % 3 != 0).alias("all_pass"), F.when(k % 7 == 6, "cheap").when(k % 2 == 0, "full").alias("tier"), (F.col("c") + (k % 11 == 0).cast("int")).alias("tar_bytes_now"), (k % 1000 + (k % 6 == 5).cast("int")).alias("tar_mtime"))
    requests = o.select(k.cast("string").alias("session"), F.when(k % 5 == 0, "other").otherwise(k.cast("string")).alias("confirm"))
    return G.authorize(requests, state, ledger, _conditions(spark, d), now).select("session", "allowed", "reason")


@query("""select u.user_id::varchar as session, u.user_id % 10 = 1 gone, coalesce(h.hides > 0, false) and v.version is not null retained, coalesce(h.hides > 0, false) and coalesce(v.version % 3 <> 0, false) restores, v.version
from (select distinct user_id from events) u left join (select user_id, arg_max(event_id, event_id) version from events where event_type = 'purchase' group by 1) v on v.user_id = u.user_id left join (select user_id, count(*) hides from events where event_type = 'error' group by 1) h on h.user_id = u.user_id""")
def g5_offsite_proof(spark, d):
    """Purchases are uploads, errors are hide markers; the bytes of every third version are wrong."""
    e = read(spark, d, "events")
    users = e.select("user_id").distinct()
    name = F.col("user_id").cast("string")
    sessions = users.select(name.alias("session"), name.alias("tar"), name.alias("key"), F.lit("good").alias("sha256"))
    files = users.where("user_id % 10 <> 1").select(name.alias("path"))
    versions = e.where("event_type in ('purchase', 'error')").select(name.alias("key"), F.when(F.col("event_type") == "error", "hide").otherwise("upload").alias("action"), F.col("event_id").alias("version"), F.col("event_id").alias("uploaded"), F.when(F.col("event_id") % 3 == 0, "bad").otherwise("good").alias("sha256"))
    return G.offsite_proof(sessions, files, versions)


_STAGES = """(select b.item_id member, 1 stage, 'a' || d.doc_id path, d.doc_id % 2 = 0 same from benchmark b join documents d on d.doc_id % 40 = b.item_id and d.n_chars % 50 = length(b.text) % 50
union all select b.item_id, 2, 'b' || d.doc_id, d.doc_id % 7 = 0 from benchmark b join documents d on d.doc_id % 4 = b.item_id % 4 and d.n_chars % 50 = length(b.text) % 50)"""


@query(f"""select b.item_id member, m.stage::int stage, m.path, coalesce(m.same, false) verified from benchmark b left join (select *, row_number() over (partition by member order by not same, path) r from
(select * from (select *, min(stage) over (partition by member) s0 from {_STAGES}) where stage = s0)) m on m.member = b.item_id and m.r = 1""")
def j7_staged_lookup(spark, d):
    """Documents of the members' length modulo 50: first those of the same number modulo 40, else modulo 4; the hash decides which are proof."""
    wanted = read(spark, d, "benchmark").select(F.col("item_id").alias("member"), (F.length("text") % 50).cast("long").alias("bytes"), F.lit("h").alias("sha256"))
    docs = read(spark, d, "documents").select("doc_id", (F.col("n_chars") % 50).alias("bytes"))
    near = F.broadcast(wanted.select("member"))  # the benchmark's items
    one = docs.join(near, F.col("doc_id") % 40 == F.col("member")).select("member", F.concat(F.lit("a"), "doc_id").alias("path"), "bytes")
    two = docs.join(near, F.col("doc_id") % 4 == F.col("member") % 4).select("member", F.concat(F.lit("b"), "doc_id").alias("path"), "bytes")
    hashes = docs.where("doc_id % 2 = 0").select(F.concat(F.lit("a"), "doc_id").alias("path"), F.lit("h").alias("sha256")).unionByName(docs.where("doc_id % 7 = 0").select(F.concat(F.lit("b"), "doc_id").alias("path"), F.lit("h").alias("sha256")))
    return G.staged_lookup(wanted, [one, two], hashes).select("member", F.col("stage").cast("int").alias("stage"), "path", "verified")


@query("""select a.page_id, coalesce(f.any_raw, false) any_raw, coalesce(f.any_sorted, false) any_sorted, exists (select 1 from pages q where split_part(q.url, '/', 3) = a.h and q.page_id % 3 = 1 and contains(q.url, a.stem)) stem_outside
from (select page_id, split_part(url, '/', 3) h, '/' || page_id % 10 stem from pages where page_id % 3 = 0) a left join (select split_part(url, '/', 3) h, bool_or(page_id % 3 = 1) any_raw, bool_or(page_id % 3 = 2) any_sorted from pages where page_id % 3 > 0 group by 1) f on f.h = a.h""")
def j14_recordings_elsewhere(spark, d):
    p = read(spark, d, "pages").select("page_id", "url", F.split_part("url", F.lit("/"), F.lit(3)).alias("date_folder"))
    k = F.col("page_id") % 3
    inside = p.where(k == 0).select(F.col("page_id").cast("string").alias("path"), "date_folder", F.concat(F.lit("/"), F.col("page_id") % 10).alias("stem"))
    outside = p.where(k > 0).select("date_folder", F.col("url").alias("name"), F.when(k == 1, "raw").otherwise("sorted").alias("kind"))
    return G.recordings_elsewhere(inside, outside).select(F.col("path").cast("long").alias("page_id"), "any_raw", "any_sorted", "stem_outside")


_INTERVALS = "(select o_orderkey k, o_custkey % 97 g, o_orderkey % 5000 a, o_orderkey % 5000 + o_orderkey % 7 b, o_orderkey % 2 = 0 mine from orders)"


@query(f"select x.k from {_INTERVALS} x where x.mine and x.a < x.b and exists (select 1 from {_INTERVALS} y where not y.mine and y.g = x.g and y.a < y.b and x.a < y.b and y.a < x.b)")
def j15_interval_overlap(spark, d):
    k = F.col("o_orderkey")
    rows = read(spark, d, "orders").select(k, (F.col("o_custkey") % 97).alias("archive"), (k % 5000).alias("start"), (k % 5000 + k % 7).alias("stop"))
    hits = G.overlapping(rows.where("o_orderkey % 2 = 0"), rows.where("o_orderkey % 2 = 1")).distinct()
    return rows.where("o_orderkey % 2 = 0").join(hits, ["archive", "start", "stop"], "left_semi").select(F.col("o_orderkey").alias("k"))


@query("select o_orderkey from orders order by md5('7/' || o_orderkey), o_orderkey limit 100")
def t6_seeded_sample(spark, d):
    return K.seeded_sample(read(spark, d, "orders").select("o_orderkey"), "o_orderkey", 100, 7)


@query("with recursive h as (select p_partkey, p_size, row_number() over (order by p_size, p_partkey) i from (select *, row_number() over (partition by p_brand, p_type order by p_size, p_partkey) r from part) where r = 1) select p_partkey from (select *, sum(p_size) over (order by i) s from h) where i <= 10 and s < 200")
def t8_stratified_pick(spark, d):
    p = read(spark, d, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    return K.stratified_pick(p, ["p_brand", "p_type"], "p_partkey", "p_size", 10, 200).select("p_partkey")


@query("select p_partkey from (select *, row_number() over (partition by p_brand, p_type order by p_size, p_partkey) r from part) where r = 1 and (p_brand, p_type) not in (select (p_brand, p_type) from part where p_partkey <= 5) order by p_size, p_partkey limit (select greatest(0, 9 - count(*)) from part where p_partkey <= 5)")
def t9_coverage_pick(spark, d):
    p = read(spark, d, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    return K.coverage_pick(p, p.where("p_partkey <= 5"), ["p_brand", "p_type"], "p_partkey", "p_size", 9).select("p_partkey")


@query(f"select label, arg_max(vec_id, q * 1000000 - vec_id) vec_id from (select label, vec_id, quantile_cont(v, 0.99) q from {PX_SQL} group by 1, 2) group by 1")
def x12_preview_choice(spark, d):
    return H.brightest(frames(spark, d), ["label"], "vec_id").select("label", "vec_id")


def _raw(spark, d):
    """Smooth frames of 48 x 64 samples with a little noise, as bytes without a header."""
    import pyarrow as pa

    def run(batches):
        import numpy as np

        i, j = np.arange(48)[:, None], np.arange(64)
        for b in batches:
            raw = []
            for s in b.column(1).to_pylist():
                noise = np.resize(np.asarray(s) // 16 % 7, (48, 64))
                raw.append((2000 + 9 * i + (i - 20) ** 2 // 3 + 700 * np.sin(j / 6) + noise).astype("<u2").tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(raw, pa.binary())], names=["archive", "raw"])

    return frames(spark, d).select(F.col("label").cast("string").alias("archive"), "samples").mapInArrow(run, "archive string, raw binary")


@query("select distinct label::varchar as archive, 48 as rows, 64 as cols, 4::bigint n_candidates from embeddings")
def x13_shape_by_size(spark, d):
    return H.shape_by_codec_size(_raw(spark, d)).select("archive", "rows", "cols", "n_candidates")


@query("select distinct label::varchar as archive, 48 as rows, 64 as cols from embeddings")
def x15_shape_by_coherence(spark, d):
    return H.shape_by_coherence(_raw(spark, d)).select("archive", "rows", "cols")


@query("select c as codec, n as frames, n * 6144 raw_bytes from (select count(*) n from embeddings), (select unnest(['lzma-1', 'plane-zstd', 'zlib-6', 'zstd-3']) c)")
def x22_codec_comparison(spark, d):
    return H.compare_codecs(_raw(spark, d).select(F.lit(48).alias("rows"), F.lit(64).alias("cols"), "raw")).select("codec", "frames", "raw_bytes")


@query("select k, count(*) n, sum(len)::bigint bytes from (select label k, 8 as len from embeddings) group by 1")
def x23_header_redundancy(spark, d):
    rows = read(spark, d, "embeddings").select(F.col("label").alias("k"), "vec_id", F.lpad(F.col("vec_id").cast("string"), 8, "0").cast("binary").alias("header"))
    return H.redundancy(rows, ["k"], "vec_id").select("k", "n", "bytes")


@query("select o_orderkey, round(o_totalprice / 1e6 / (1 + o_custkey % 9), 12) speed, round(100 - 100.0 * o_custkey / o_totalprice, 6) saved, round(8.0 * o_custkey / o_totalprice, 9) bits, round(o_totalprice / 1e6 / 86.7 / 86400, 12) as days from orders")
def f8_rates(spark, d):
    source, output = F.col("o_totalprice"), F.col("o_custkey")
    return read(spark, d, "orders").select("o_orderkey", F.round(S.megabytes_per_second(source, 1 + output % 9), 12).alias("speed"), F.round(S.percent_saved(source, output), 6).alias("saved"), F.round(S.bits_per_sample(output, source), 9).alias("bits"), F.round(S.days_needed(source, 86.7), 12).alias("days"))


@query("select page_id, 'rec' || page_id stem, (page_id % 3)::int trial, (page_id % 2)::int probe, page_id * 1001 bytes from pages where page_id % 5 <> 0 union all select page_id, null, null, null, null from pages where page_id % 5 = 0")
def f10_recording_member(spark, d):
    k = F.col("page_id")
    name = F.when(k % 5 == 0, F.concat(F.lit("a/notes"), k)).otherwise(F.concat(F.lit("a/rec"), k, F.lit("_t"), k % 3, F.lit(".imec"), k % 2, F.lit(".ap.bin ("), F.format_number(k * 1001, 0), F.lit(" bytes)")))
    return read(spark, d, "pages").select(k, S.recording_member(name).alias("m")).select("page_id", "m.*")


@query("""select o_orderkey, case when p like '_:/%' then '/mnt/share/' || p[4:] else p end shared, 'subjects/' || case when p like '%/Subjects/%' then split_part(p, '/Subjects/', 2) else regexp_replace(p, '^[^/]*/', '') end as key from (select o_orderkey, case when o_orderkey % 9 = 0 then 'Z:/other/x' else 'Y:/Subjects/C' || o_custkey || '/' || case when o_orderkey % 7 = 0 then 'notes' else strftime(o_orderdate, '%Y-%m-%d') end || '/' || o_orderkey % 4 || '/a.tar' end p from orders)""")
def f13_paths(spark, d):
    p = F.replace(F.col("p"), F.lit("/"), F.lit("\\"))
    return placed(spark, d).select("o_orderkey", S.share_path(p, "/mnt/share").alias("shared"), S.object_key(p, "subjects").alias("key"))


@query("select o_orderkey, floor(epoch(timestamp '2001-01-01 12:00:00' - o_orderdate) / 86400)::int as days, round(epoch(timestamp '2001-01-01 12:00:00' - o_orderdate) / 3600, 6) as hours from orders")
def f16_ages(spark, d):
    now, then = F.to_timestamp(F.lit("2001-01-01T12:00:00")), F.col("o_orderdate")
    return read(spark, d, "orders").select("o_orderkey", S.age_days(then, now).alias("days"), F.round(S.age_hours(then, now), 6).alias("hours"))


@query("select event_id, strftime(make_timestamp((event_id * 86399)::bigint * 1000000), '%Y-%m-%dT%H:%M:%S') || '+00:00' as iso, strftime(make_timestamp((event_id * 86399)::bigint * 1000000 // 1000 // 1000000 * 1000000), '%Y-%m-%dT%H:%M:%S') || '+00:00' as milli from events")
def f17_epoch_iso(spark, d):
    t = F.col("event_id") * 86_399
    return read(spark, d, "events").select("event_id", S.epoch_iso(t).alias("iso"), S.epoch_iso(t, True).alias("milli"))


@query("select event_id, coalesce(json_extract_string(props, '$.absent'), json_extract_string(props, '$.k'), 'none') as found, 'none' as missing from events")
def f19_map_get(spark, d):
    m = F.from_json("props", "map<string,string>")
    return read(spark, d, "events").select("event_id", S.map_get(m, "absent", "k", default="none").alias("found"), S.map_get(m, "absent", default="none").alias("missing"))


@query("select page_id, regexp_extract(regexp_replace(url, '/+$', ''), '[^/]*$') last from pages")
def f23_last_component(spark, d):
    return read(spark, d, "pages").select("page_id", S.last_component(F.col("url")).alias("last"))


@query("select page_id from pages where contains(url, '/1')")
def p16_name_contains(spark, d):
    return read(spark, d, "pages").where(S.name_contains(F.col("url"), "/1")).select("page_id")


@query(f"select vec_id, case vec_id % 3 when 0 then false else true end magic from embeddings")
def p12_ustar_magic(spark, d):
    """Headers of the three kinds: older ones have no magic, GNU's end in a space."""
    k = F.col("vec_id") % 3
    magic = F.when(k == 0, F.lit(b"\0\0\0\0\0\0")).when(k == 1, F.lit(b"ustar\0")).otherwise(F.lit(b"ustar "))
    header = F.concat(F.lit(bytes(257)), magic, F.lit(bytes(249)))
    return read(spark, d, "embeddings").select("vec_id", S.ustar(header).alias("magic"))


@query("select page_id item, case when page_id % 4 = 3 then '[redacted]' else 'v' || page_id end v, case page_id % 4 when 0 then 'host' when 1 then 'port' when 2 then 'name' else 'api_Key' end k from pages")
def f15_redaction(spark, d):
    i = F.col("page_id")
    key = F.when(i % 4 == 0, "host").when(i % 4 == 1, "port").when(i % 4 == 2, "name").otherwise("api_Key")
    return read(spark, d, "pages").select(i.alias("item"), S.redacted(key, F.concat(F.lit("v"), i)).alias("v"), key.alias("k"))


@query("select doc_id, n_chars size from documents")
def f1_size_field(spark, d):
    """Sizes written as octal text, or in base 256 with the top bit set, and read back."""
    n = F.col("n_chars")
    octal = F.concat(F.lpad(F.conv(n.cast("string"), 10, 8), 11, "0").cast("binary"), F.lit(b"\0"))
    binary = F.concat(F.lit(b"\x80\0\0\0"), F.unhex(F.lpad(F.hex(n), 16, "0")))
    return read(spark, d, "documents").select("doc_id", S.tar_size(F.when(F.col("doc_id") % 2 == 0, octal).otherwise(binary)).alias("size"))
