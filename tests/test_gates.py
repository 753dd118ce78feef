"""Gates: what each missing or wrong thing leads to, one at a time."""

import pytest
from pyspark.sql import functions as F

from strataframe.operators import gates, integrity, picks

NOW = "2024-03-01 00:00:00"


def base(**changed):
    """Tables of one session of which all is well, but for what is changed."""
    rows = {
        "log": [("a", "t", "s", True, 100, 40, "h")], "files": [("t", 100, 7), ("s", 40, 8)], "footers": [("s", 2, False, "h", None)],
        "receipts": [("s", 2, "h", True, True, None)], "offsite": [("k", 40, None)], "sessions": [("a", "t", "s", "k")],
    }
    return rows | changed


SCHEMAS = {
    "log": "session string, tar string, store string, ok boolean, source_bytes long, output_bytes long, tar_sha256 string", "files": "path string, bytes long, mtime long",
    "footers": "store string, format_version int, partial boolean, source_tar_sha256 string, error string", "receipts": "store string, format_version int, source_tar_sha256 string, byte_identical boolean, byte_identical_verified boolean, error string",
    "offsite": "key string, bytes long, error string", "sessions": "session string, tar string, store string, key string",
}


def tables(spark, **changed):
    return {name: spark.createDataFrame(rows, SCHEMAS[name]) for name, rows in base(**changed).items()}


def audit(spark, rebuilt=None, rehashed=None, **changed):
    t = tables(spark, **changed)
    extra = [None if rows is None else spark.createDataFrame(rows, schema) for rows, schema in ((rebuilt, "store string, sha256 string, ok boolean"), (rehashed, "tar string, sha256 string"))]
    r = gates.deletion_audit(t["log"], t["files"], t["footers"], t["receipts"], *extra).first()
    return r.verdict, r.reason


def test_the_audit_gives_the_first_reason(spark):
    assert audit(spark) == ("SAFE", "metadata agree")
    wrong = {
        "not recorded": {"log": [("a", "t", "s", None, 100, 40, "h")]}, "tar is gone": {"files": [("s", 40, 8)]}, "no store": {"files": [("t", 100, 7)]},
        "store has another size": {"files": [("t", 100, 7), ("s", 41, 8)]}, "can't be read": {"footers": [("s", 2, False, "h", "bad")]}, "format": {"footers": [("s", None, False, "h", None)]},
        "part of": {"footers": [("s", 2, True, "h", None)]}, "no source hash": {"footers": [("s", 2, False, "", None)]}, "tar has another size": {"files": [("t", 99, 7), ("s", 40, 8)]},
        "no receipt": {"receipts": []}, "receipt can't": {"receipts": [("s", 2, "h", True, True, "x")]}, "no identical": {"receipts": [("s", 2, "h", None, True, None)]},
    }
    for reason, changed in wrong.items():
        verdict, told = audit(spark, **changed)
        assert verdict == "REFUSE" and reason in told
    assert audit(spark, rebuilt=[("s", "h", True)], rehashed=[("t", "h")])[0] == "SAFE"
    assert audit(spark, rebuilt=[("s", "x", True)])[0] == audit(spark, rebuilt=[])[0] == audit(spark, rebuilt=[("s", "h", True)], rehashed=[("t", "x")])[0] == "REFUSE"


def verdicts(spark, measured=(), **changed):
    t = tables(spark, **changed)
    m = spark.createDataFrame(list(measured), "session string, name string, value string")
    found = gates.conditions(t["sessions"], t["log"], t["files"], t["receipts"], t["offsite"], m)
    return {r.key: (r.ok, r.derived, r.note) for r in found.collect()}, found


ALL = [("a", "rebuilt", "h"), ("a", "tar", "h"), ("a", "store", "y"), ("a", "offsite_store", "y"), ("a", "offsite_rebuilt", "h"), ("a", "offsite_tar", "h"), ("a", "offsite_tar_bytes", "100")]


def test_each_condition_fails_alone(spark):
    got, found = verdicts(spark, ALL)
    assert [got[k][0] for k in gates.KEYS] == [True] * 11 and gates.sweep(found, gates.KEYS).first().verdict == "PASS"
    got, found = verdicts(spark)
    assert [k for k in gates.KEYS if got[k][0] is None] == ["C6", "C8", "C9", "C10", "C11"] and gates.sweep(found, gates.KEYS).first().verdict == "REFUSE"
    got, _ = verdicts(spark, ALL, log=[])
    assert got["C1"][0] is False and all(got[k][0] is None for k in gates.KEYS[1:])
    got, _ = verdicts(spark, ALL, log=[("a", "t", "s", True, 100, 40, "other")])
    assert got["C3"] == (False, False, "log and receipt have different hashes")
    for changed, key in (({"files": [("t", 100, 7)]}, "C2"), ({"files": [("s", 40, 8)]}, "C4"), ({"offsite": [("k", 39, None)]}, "C7"), ({"offsite": [("k", 40, "denied")]}, "C7"), ({"receipts": [("s", 2, "h", True, None, None)]}, "C5"), ({"receipts": [("s", 1, "h", True, True, None)]}, "C3")):
        got, _ = verdicts(spark, ALL, **changed)
        assert [k for k in gates.KEYS if got[k][0] is not True] == [key] and got[key][2]
    for name, key in (("rebuilt", "C6"), ("tar", "C8"), ("offsite_store", "C9"), ("offsite_rebuilt", "C10"), ("offsite_tar", "C11"), ("offsite_tar_bytes", "C11")):
        got, _ = verdicts(spark, [(s, n, "1" if n == name else v) for s, n, v in ALL])
        assert [k for k in gates.KEYS if got[k][0] is not True] == [key]


def test_a_condition_can_follow_from_others(spark):
    measured = [x for x in ALL if x[1] != "offsite_rebuilt"] + [("a", "room", "false")]
    got, _ = verdicts(spark, measured)
    assert got["C10"][:2] == (True, True)
    got, _ = verdicts(spark, [(s, n, "z" if n == "offsite_store" else v) for s, n, v in measured])
    assert got["C9"][0] is False and got["C10"][0] is None


def test_sweep_tells_errors_and_notes_in_order(spark):
    _, found = verdicts(spark, files=[])
    row = gates.sweep(found).first()
    assert row.refusals == 2 and row.notes.startswith("C2: ") and "; C4: tar is gone" in row.notes
    errors = spark.createDataFrame([("a", "boom")], "session string, error string")
    assert [tuple(r) for r in gates.sweep(found, errors=errors).collect()] == [("a", "ERROR", 1, "boom")]


@pytest.mark.parametrize(("confirm", "check", "changed", "reason"), [
    ("a", ("2024-02-29 20:00:00", True, "full", 100, 7), {}, "allowed"), ("A", ("2024-02-29 20:00:00", True, "full", 100, 7), {}, "the name isn't confirmed"),
    (None, ("2024-02-29 20:00:00", True, "full", 100, 7), {}, "the name isn't confirmed"), ("a", ("2024-02-27 20:00:00", True, "full", 100, 7), {}, "no recent check of these bytes"),
    ("a", ("2024-02-29 20:00:00", True, "cheap", 100, 7), {}, "no recent check of these bytes"), ("a", ("2024-02-29 20:00:00", False, "full", 100, 7), {}, "no recent check of these bytes"),
    ("a", ("2024-02-29 20:00:00", True, None, 100, 6), {}, "no recent check of these bytes"), ("a", ("2024-02-29 20:00:00", True, None, 100, 7), {}, "allowed"),
    ("a", ("2024-02-29 20:00:00", True, "full", 100, 7), {"receipts": []}, "something changed since the check"),
])
def test_authorization(spark, confirm, check, changed, reason):
    t = tables(spark, **changed)
    found = gates.conditions(t["sessions"], t["log"], t["files"], t["receipts"], t["offsite"])
    state = spark.createDataFrame([("a", 100, 7)], "session string, tar_bytes_now long, tar_mtime long")
    ledger = spark.createDataFrame([("a", *check)], "session string, checked_utc string, all_pass boolean, tier string, tar_bytes_now long, tar_mtime long")
    request = spark.createDataFrame([("a", confirm)], "session string, confirm string")
    row = gates.authorize(request, state, ledger, found, F.to_timestamp(F.lit(NOW))).first()
    assert (row.allowed, row.reason) == (reason == "allowed", reason)
    if check[2] == "cheap":
        assert gates.authorize(request, state, ledger, found, F.to_timestamp(F.lit(NOW)), allow_cheap=True).first().tier == "cheap"


def test_backfill_adds_only_proven_stores(spark):
    log = spark.createDataFrame([("a", "s1", True), ("b", "s2", False)], "session string, store string, ok boolean")
    rows = [("a", "t1", "s1", 9, 4, "h", True), ("b", "t2", "s2", 9, 4, "h", True), ("c", "t3", "s3", 9, 4, "h", False), ("d", "t4", "s4", 9, 4, "h", True), ("e", "t5", "s5", 9, 4, "h", True)]
    receipts = spark.createDataFrame(rows, "session string, tar string, store string, source_bytes long, output_bytes long, tar_sha256 string, byte_identical boolean")
    files = spark.createDataFrame([("s1", 4), ("s2", 4), ("s3", 4), ("s4", 5)], "path string, bytes long")
    good, refused = gates.backfill(log, receipts, files)
    assert [r.session for r in good.collect()] == ["b"]
    assert {r.session: r.reason for r in refused.collect()} == {"c": "not proven identical", "d": "store has another size than the receipt says", "e": "no store"}


def test_member_proof_hashes_only_files_of_the_size(spark, tmp_path):
    tar = tmp_path / "x.tar"
    tar.write_bytes(b"0123456789" * 10)
    (tmp_path / "same").write_bytes(b"0123456789")
    (tmp_path / "other").write_bytes(b"9876543210")
    wanted = spark.createDataFrame([("m", str(tar), 10, 10), ("n", str(tar), 0, 3)], "member string, archive string, data_offset long, bytes long")
    candidates = spark.createDataFrame([("m", str(tmp_path / f), 10) for f in ("other", "same")] + [("n", str(tmp_path / "same"), 10)], "member string, path string, bytes long")
    got = {r.member: r for r in integrity.member_proof(wanted, candidates).collect()}
    assert got["m"].verified and got["m"].path.endswith("same") and not got["n"].verified and got["n"].note == "no file of its size"
    assert not any(r.verified for r in integrity.member_proof(wanted, candidates, quick=True).collect())
    assert not integrity.same_files(spark, str(tmp_path / "same"), str(tmp_path / "other")) and integrity.same_files(spark, str(tmp_path / "same"), str(tmp_path / "same"))
    assert integrity.file_digests(spark, [str(tmp_path / "none")]).first().error.startswith("FileNotFoundError")


def test_restore_test_tells_what_came_back(spark):
    expected = spark.createDataFrame([("a", "h", "s"), ("b", "h", "s")], "session string, tar_sha256 string, store_sha256 string")
    got = lambda *rows: spark.createDataFrame(list(rows), "session string, sha256 string")
    rows = {r.session: tuple(r)[1:] for r in integrity.restore_test(spark, expected, got(("a", "h")), got(("a", "x")), got(("a", "h"), ("b", "h"))).collect()}
    assert rows == {"a": (True, False, True), "b": (None, None, True)}


def test_picks_of_empty_and_small_tables(spark):
    none = spark.createDataFrame([], "k long, s string, n long")
    assert picks.stratified_pick(none, ["s"], "k", "n", 3, 100).count() == picks.seeded_sample(none, "k", 3).count() == picks.smallest(none, "n").count() == 0
    rows = spark.createDataFrame([(1, "a", 5), (2, "a", 1), (3, "b", 7), (4, "c", 90), (5, "b", 2)], "k long, s string, n long")
    assert sorted(r.k for r in picks.stratified_pick(rows, ["s"], "k", "n", 4, 50).collect()) == [1, 2, 3, 5]
    assert [r.k for r in picks.cumulative_stop(rows, "k", "n", 6).orderBy("k").collect()] == [1, 2]
    assert {r.k for r in picks.seeded_sample(rows, "k", 2, 1).collect()} == {r.k for r in picks.seeded_sample(rows.repartition(3), "k", 2, 1).collect()}
