"""Gates before an original may be deleted, as decisions over tables. Nothing here deletes anything.

Inputs are tables: ``log`` (session, tar, store, ok, source_bytes, output_bytes, tar_sha256), ``files`` (path, bytes, and
mtime where a decision needs it), ``footers`` (store, format_version, partial, source_tar_sha256, error), ``receipts``
(store, format_version, source_tar_sha256, byte_identical, byte_identical_verified, error), ``offsite`` (key, bytes, error),
``measured`` (session, key, value: results of the costly checks, see ``conditions``).

Cases: what is missing or null never counts as passed. Repeated rows of a log: the last success counts (``catalog.latest``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataframe.operators.catalog import first_match

#: Oldest format that records a hash of the source.
LEAST_FORMAT = 2
CHEAP = ("C1", "C2", "C3", "C4", "C5", "C7")
KEYS = tuple(f"C{k}" for k in range(1, 12))


def _facts(df: DataFrame, key: str, prefix: str) -> DataFrame:
    return df.select(F.col(key).alias(f"_{prefix}"), *[F.col(c).alias(f"{prefix}_{c}") for c in df.columns if c != key], F.lit(True).alias(f"has_{prefix}"))


def deletion_audit(log: DataFrame, files: DataFrame, footers: DataFrame, receipts: DataFrame, rebuilt: DataFrame | None = None, rehashed: DataFrame | None = None) -> DataFrame:
    """(session, tar, store, verdict, reason): SAFE, or REFUSE with the first rung that fails.

    rebuilt (store, sha256, ok) and rehashed (tar, sha256) add the strict rungs.
    """
    sizes = files.select("path", "bytes")
    rows = log.select("session", "tar", "store", F.coalesce("ok", F.lit(False)).alias("ok"), "source_bytes", "output_bytes")
    for frame, key, prefix in ((sizes, "tar", "t"), (sizes, "store", "s")):
        rows = rows.join(_facts(frame, "path", prefix), F.col(key) == F.col(f"_{prefix}"), "left").drop(f"_{prefix}")
    for frame, prefix in ((footers, "f"), (receipts, "r")):
        rows = rows.join(_facts(frame, "store", prefix), F.col("store") == F.col(f"_{prefix}"), "left").drop(f"_{prefix}")
    has = lambda p: F.coalesce(F.col(f"has_{p}"), F.lit(False))
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    differs = lambda now, then: (F.coalesce(F.col(then), F.lit(0)) != 0) & (F.col(now) != F.col(then))
    ladder = [
        (~F.col("ok"), "not recorded as successful"),
        (~has("t"), "tar is gone"),
        (~has("s"), "no store"),
        (differs("s_bytes", "output_bytes"), "store has another size than recorded"),
        (~has("f") | (text("f_error") != ""), "store can't be read"),
        (F.coalesce("f_format_version", F.lit(0)) < LEAST_FORMAT, "format without a source hash"),
        (F.coalesce("f_partial", F.lit(False)), "store holds a part of the archive"),
        (text("f_source_tar_sha256") == "", "no source hash"),
        (differs("t_bytes", "source_bytes"), "tar has another size than when it was hashed"),
        (~has("r"), "no receipt"),
        (text("r_error") != "", "receipt can't be read"),
        (~F.coalesce("r_byte_identical", F.lit(False)), "receipt claims no identical rebuild"),
    ]
    safe = "metadata agree"
    if rebuilt is not None:
        rows = rows.join(_facts(rebuilt.select("store", "sha256", "ok"), "store", "v"), F.col("store") == F.col("_v"), "left").drop("_v")
        ladder.append((~F.coalesce(F.col("v_ok") & (F.col("v_sha256") == F.col("f_source_tar_sha256")), F.lit(False)), "store doesn't rebuild its hash"))
        safe = "rebuilt again"
        if rehashed is not None:
            rows = rows.join(_facts(rehashed.select("tar", "sha256"), "tar", "h"), F.col("tar") == F.col("_h"), "left").drop("_h")
            ladder.append((~F.coalesce(F.col("h_sha256") == F.col("f_source_tar_sha256"), F.lit(False)), "tar has another hash than recorded"))
            safe = "rebuilt and hashed again"
    reason = first_match(ladder, safe)
    return rows.select("session", "tar", "store", F.when(reason == safe, "SAFE").otherwise("REFUSE").alias("verdict"), reason.alias("reason"))


def conditions(sessions: DataFrame, log: DataFrame, files: DataFrame, receipts: DataFrame, offsite: DataFrame, measured: DataFrame | None = None) -> DataFrame:
    """(session, key, ok, note, derived): a row for each condition of each session; ok is null where it wasn't measured.

    sessions: session, tar, store, key (of the store's copy offsite). measured (session, name, value as text) may hold
    ``rebuilt`` and ``tar`` (hashes made today), ``store`` and ``offsite_store`` (hashes of both copies), ``offsite_rebuilt``,
    ``offsite_tar``, ``offsite_tar_bytes`` and ``room`` (false: the offsite copy can't be decoded here, so C10 follows from C6
    and C9). Without a log row only C1 is decided. A log and a receipt of different hashes fail C3.
    """
    rows = sessions.select("session", "tar", "store", F.col("key").alias("offsite_key"))
    rows = rows.join(log.where("ok").select("session", "source_bytes", "output_bytes", F.col("tar_sha256").alias("log_sha256"), F.lit(True).alias("logged")), "session", "left")
    sizes = files.select("path", "bytes")
    for frame, key, own, prefix in ((sizes, "tar", "path", "t"), (sizes, "store", "path", "s"), (receipts, "store", "store", "r"), (offsite, "offsite_key", "key", "o")):
        rows = rows.join(_facts(frame, own, prefix), F.col(key) == F.col(f"_{prefix}"), "left").drop(f"_{prefix}")
    names = ("rebuilt", "tar", "store", "offsite_store", "offsite_rebuilt", "offsite_tar", "offsite_tar_bytes", "room")
    if measured is not None:
        wide = measured.groupBy("session").agg(*[F.max(F.when(F.col("name") == n, F.col("value"))).alias(f"m_{n}") for n in names])
        rows = rows.join(wide, "session", "left")
    else:
        rows = rows.withColumns({f"m_{n}": F.lit(None).cast("string") for n in names})
    told = F.coalesce("logged", F.lit(False))
    expected = F.col("r_source_tar_sha256")
    yes = lambda c: F.coalesce(c, F.lit(False))
    same = lambda c: F.when(F.col(c).isNotNull(), yes(F.col(c) == expected))
    agree = ~yes(F.col("log_sha256") != expected)
    c6, c9 = same("m_rebuilt"), F.when(F.col("m_offsite_store").isNotNull(), yes(F.col("m_offsite_store") == F.col("m_store")))
    follows = F.col("m_offsite_rebuilt").isNull() & yes(F.col("m_room") == "false") & yes(c9)
    size_note = lambda now, then: F.concat(F.coalesce(F.col(now).cast("string"), F.lit("nothing")), F.lit(" now, "), F.col(then).cast("string"), F.lit(" recorded"))
    got = lambda c: F.concat(F.lit("got "), F.col(c))
    cells = {
        "C1": (told, F.lit("no success in the log"), F.lit(False)),
        "C2": (yes(F.col("s_bytes") == F.col("output_bytes")), size_note("s_bytes", "output_bytes"), F.lit(False)),
        "C3": (yes(expected != "") & yes(F.col("r_format_version") >= LEAST_FORMAT) & agree, F.when(~agree, F.lit("log and receipt have different hashes")).otherwise(F.lit("no hash or an old format")), F.lit(False)),
        "C4": (yes(F.col("t_bytes") == F.col("source_bytes")), F.when(F.col("has_t").isNull(), F.lit("tar is gone")).otherwise(size_note("t_bytes", "source_bytes")), F.lit(False)),
        "C5": (yes(F.col("r_byte_identical")) & yes(F.col("r_byte_identical_verified")), F.when(F.col("has_r").isNull(), F.lit("no receipt")).otherwise(F.lit("not proven identical")), F.lit(False)),
        "C6": (c6, got("m_rebuilt"), F.lit(False)),
        "C7": (yes(F.col("o_bytes") == F.col("output_bytes")) & F.col("o_error").isNull(), F.coalesce("o_error", size_note("o_bytes", "output_bytes")), F.lit(False)),
        "C8": (same("m_tar"), got("m_tar"), F.lit(False)),
        "C9": (c9, F.lit("the copies differ"), F.lit(False)),
        "C10": (F.when(follows, yes(c6)).otherwise(same("m_offsite_rebuilt")), F.when(follows, F.lit("follows from C6 and C9")).otherwise(got("m_offsite_rebuilt")), follows),
        "C11": (F.when(F.col("m_offsite_tar").isNotNull(), yes(F.col("m_offsite_tar") == expected) & yes(F.col("m_offsite_tar_bytes").cast("long") == F.col("source_bytes"))), got("m_offsite_tar"), F.lit(False)),
    }
    packed = []
    for k, (ok, note, derived) in cells.items():
        ok = ok if k == "C1" else F.when(told, ok)
        packed.append(F.struct(F.lit(k).alias("key"), ok.alias("ok"), F.when(ok.isNotNull() & (~ok | derived), note).otherwise(F.lit("")).alias("note"), (derived & yes(ok)).alias("derived")))
    return rows.select("session", F.explode(F.array(*packed)).alias("c")).select("session", "c.key", "c.ok", F.coalesce("c.note", F.lit("")).alias("note"), "c.derived")


def sweep(found: DataFrame, keys: tuple[str, ...] = CHEAP, errors: DataFrame | None = None) -> DataFrame:
    """(session, verdict, refusals, notes) over the conditions ``keys``: PASS, REFUSE, or ERROR for sessions of ``errors`` (session, error).

    Notes stand in the order of the keys, joined by "; ".
    """
    bad = ~F.coalesce("ok", F.lit(False))
    note = F.concat(F.col("key"), F.lit(": "), F.when(F.col("note") == "", F.lit("failed")).otherwise(F.col("note")))
    place = F.substring("key", 2, 9).cast("int")
    out = found.where(F.col("key").isin(*keys)).groupBy("session").agg(F.count_if(bad).alias("refusals"), F.sort_array(F.collect_list(F.when(bad, F.struct(place.alias("p"), note.alias("n"))))).alias("bad"))  # as many as there are keys
    out = out.select("session", F.when(F.col("refusals") == 0, "PASS").otherwise("REFUSE").alias("verdict"), "refusals", F.array_join(F.transform("bad", lambda x: x["n"]), "; ").alias("notes"))
    if errors is None:
        return out
    told = errors.select("session", F.lit("ERROR").alias("verdict"), F.lit(1).cast("long").alias("refusals"), F.col("error").alias("notes"))
    return out.join(errors.select("session"), "session", "left_anti").unionByName(told)


def recent_check(ledger: DataFrame, state: DataFrame, now: Column, max_age_hours: float, allow_cheap: bool = False) -> DataFrame:
    """(session, checked_utc, tier): the latest passed check of the same bytes (state: session, tar_bytes_now, tar_mtime) that is young enough.

    Rows without a tier are full checks; cheap ones count only if allowed.
    """
    tier = F.coalesce("tier", F.lit("full"))
    age = (F.unix_timestamp(now) - F.unix_timestamp(F.to_timestamp("checked_utc"))) / 3600
    rows = ledger.where(F.coalesce("all_pass", F.lit(False)) & (age <= max_age_hours) & (F.lit(allow_cheap) | (tier != "cheap")))
    rows = rows.join(state.select("session", "tar_bytes_now", "tar_mtime"), ["session", "tar_bytes_now", "tar_mtime"], "left_semi")
    return rows.groupBy("session").agg(F.max(F.struct(F.to_timestamp("checked_utc").alias("at"), "checked_utc", tier.alias("tier"))).alias("m")).select("session", "m.checked_utc", "m.tier")


def authorize(requests: DataFrame, state: DataFrame, ledger: DataFrame, found: DataFrame, now: Column, max_age_hours: float = 24, allow_cheap: bool = False) -> DataFrame:
    """(session, allowed, reason, tier) for requests (session, confirm): the name repeated, a tar there, a recent check, and the cheap conditions again."""
    checks = recent_check(ledger, state, now, max_age_hours, allow_cheap).withColumn("checked", F.lit(True))
    again = sweep(found).select("session", (F.col("verdict") == "PASS").alias("still"))
    rows = requests.join(state.select("session", F.lit(True).alias("there")), "session", "left").join(checks, "session", "left").join(again, "session", "left")
    no = lambda c: ~F.coalesce(F.col(c), F.lit(False))
    reason = first_match([(~F.coalesce(F.col("confirm") == F.col("session"), F.lit(False)), "the name isn't confirmed"), (no("there"), "no tar"), (no("checked"), "no recent check of these bytes"), (no("still"), "something changed since the check")], "allowed")
    return rows.select("session", (reason == "allowed").alias("allowed"), reason.alias("reason"), F.when(reason == "allowed", F.col("tier")).alias("tier"))


def offsite_proof(sessions: DataFrame, files: DataFrame, versions: DataFrame) -> DataFrame:
    """(session, gone, retained, restores, version): P1 the tar is gone here, P2 it is hidden offsite with an upload kept, P3 the latest upload has the hash.

    sessions: session, tar, key, sha256. versions: key, action (upload or hide), version, uploaded, bytes, sha256 of the restored bytes.
    """
    ups = versions.where("action = 'upload'").groupBy("key").agg(F.max_by(F.struct("version", "sha256"), F.struct("uploaded", "version")).alias("up"))
    hides = versions.where("action = 'hide'").select("key").distinct().withColumn("hidden", F.lit(True))
    here = files.select(F.col("path").alias("tar")).distinct().withColumn("here", F.lit(True))
    rows = sessions.join(ups, "key", "left").join(hides, "key", "left").join(here, "tar", "left")
    retained = F.coalesce("hidden", F.lit(False)) & F.col("up").isNotNull()
    return rows.select("session", F.col("here").isNull().alias("gone"), retained.alias("retained"), (retained & F.coalesce(F.col("up.sha256") == F.col("sha256"), F.lit(False))).alias("restores"), F.col("up.version").alias("version"))


def staged_lookup(wanted: DataFrame, stages: list[DataFrame], hashes: DataFrame | None = None) -> DataFrame:
    """(member, stage, path, verified, method) of each member: of the first stage with a file of its size, the first path.

    wanted: member, bytes, sha256. stages: tables (member, path, bytes) of candidates, the closest first. With ``hashes``
    (path, sha256) only files of the member's hash count as proof; without, size alone decides and proves nothing.
    """
    fits = None
    for k, one in enumerate(stages, 1):
        rows = one.join(wanted.select("member", F.col("bytes").alias("_bytes"), F.col("sha256").alias("_sha256")), "member").where("bytes = _bytes").select("member", F.lit(k).alias("stage"), "path", "_sha256")
        fits = rows if fits is None else fits.unionByName(rows)
    nearest = fits.groupBy("member").agg(F.min("stage").alias("stage"))
    fits = fits.join(nearest, ["member", "stage"])
    if hashes is None:
        best = fits.groupBy("member").agg(F.min(F.struct("stage", "path")).alias("m"))
        best = best.select("member", "m.stage", "m.path", F.lit(False).alias("verified"), F.lit("size").alias("method"))
    else:
        proven = fits.join(hashes.select("path", "sha256").distinct(), "path", "left").withColumn("same", F.coalesce(F.col("sha256") == F.col("_sha256"), F.lit(False)))
        best = proven.groupBy("member").agg(F.min(F.struct((~F.col("same")).alias("differs"), "stage", "path")).alias("m"))
        best = best.select("member", "m.stage", "m.path", (~F.col("m.differs")).alias("verified"), F.lit("sha256").alias("method"))
    return wanted.select("member").join(best, "member", "left").withColumn("verified", F.coalesce("verified", F.lit(False)))


def recordings_elsewhere(inside: DataFrame, outside: DataFrame) -> DataFrame:
    """(path, date_folder, any_raw, any_sorted, stem_outside) for recordings in archives (path, date_folder, stem) and files outside (date_folder, name, kind raw or sorted).

    stem_outside: some raw file of the folder has the stem in its name. Files are first reduced to a folder's distinct names.
    """
    there = outside.groupBy("date_folder").agg(F.bool_or(F.col("kind") == "raw").alias("any_raw"), F.bool_or(F.col("kind") == "sorted").alias("any_sorted"))
    raw = outside.where("kind = 'raw'").select("date_folder", "name").distinct()
    hits = inside.join(raw, "date_folder").where(F.col("name").contains(F.col("stem"))).select("path", "date_folder", "stem").distinct().withColumn("stem_outside", F.lit(True))
    rows = inside.join(there, "date_folder", "left").join(hits, ["path", "date_folder", "stem"], "left")
    return rows.select("path", "date_folder", "stem", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("any_raw", "any_sorted", "stem_outside")])


def overlapping(kept: DataFrame, dropped: DataFrame, group: str = "archive") -> DataFrame:
    """Intervals [start, stop) of ``kept`` that overlap one of ``dropped`` in their group.

    Both are sorted by start together; an interval overlaps one before it if that one's running latest stop is beyond its
    start, and one after it if the earliest following start of the other kind is below its stop. No pairs are made. Empty
    intervals overlap nothing.
    """
    rows = kept.select(group, "start", "stop", F.lit(True).alias("mine")).unionByName(dropped.select(group, "start", "stop", F.lit(False).alias("mine"))).where("start < stop")
    order = Window.partitionBy(group).orderBy("start")  # rows of one start see each other
    latest = F.max(F.when(~F.col("mine"), F.col("stop"))).over(order.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    following = F.min(F.when(~F.col("mine"), F.col("start"))).over(order.rangeBetween(Window.currentRow, Window.unboundedFollowing))
    hit = F.coalesce(latest > F.col("start"), F.lit(False)) | F.coalesce(following < F.col("stop"), F.lit(False))
    return rows.withColumn("hit", hit).where("mine and hit").select(group, "start", "stop")


def backfill(log: DataFrame, receipts: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows to add to the log, refused receipts with reasons): finished stores whose success was never logged.

    receipts: session, tar, store, source_bytes, output_bytes, tar_sha256, byte_identical. Stores already logged, even as a
    failure that a later success follows, are left alone.
    """
    known = log.where("ok").select("store").distinct()
    rows = receipts.join(known, "store", "left_anti").join(files.select(F.col("path").alias("store"), F.col("bytes").alias("now")), "store", "left")
    reason = first_match([(F.col("now").isNull(), "no store"), (F.col("now") != F.col("output_bytes"), "store has another size than the receipt says"), (~F.coalesce("byte_identical", F.lit(False)), "not proven identical"), (F.coalesce("tar_sha256", F.lit("")) == "", "no source hash")], "")
    rows = rows.withColumn("reason", reason)
    good = rows.where("reason = ''").select("session", "tar", "store", F.lit(True).alias("ok"), "source_bytes", "output_bytes", "tar_sha256", F.lit("receipt").alias("recovered_from"))
    return good, rows.where("reason <> ''").select("session", "store", "reason")
