"""Listing, transfer, verification, archive and state on real folders."""

import dataclasses
import hashlib
import os

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tests.conftest import put
from tidemark.operators import ledger as L
from tidemark.operators import archive as archiving
from tidemark.operators.archive import _put_away as archive_file
from tidemark.operators.archive import archive
from tidemark.operators.filters import delta_filter
from tidemark.operators.metrics import run_totals, transfer_time_percentiles
from tidemark.operators.transfer import plan_transfer, transfer, write_files
from tidemark.operators.verify import verify
from tidemark.options import TransferOptions
from tidemark.plans.properties import options_from_properties
from tidemark.plans.run import run_transfer
from tidemark.sources import fs, listing
from tidemark.sources.content import checksum_files, read_content
from tidemark.sources.listing import scan_files, walk_files
from tidemark.sources.manifest import sftp_manifest, store_manifest
from tidemark.sources.watermark import commit_watermark, read_watermark, read_watermark_text
from tidemark.spread import task_count
from tidemark.streaming.files import append_stream, stream_listing, stream_transfer

FROM, TO = 1_000_000_000, 1_000_000_100


def names(df, column="relpath"):
    return sorted(row[column] for row in df.select(column).collect())


def options(folders, **changes):
    given = {
        "pipeline": "p",
        "source_root": str(folders / "in"),
        "target_root": str(folders / "out"),
        "state_root": str(folders / "state"),
        "recursive": True,
        "retries": 0,
        "wait_s": 0,
        "safety_s": 0,
        "user": "u",
        "host": "h",
    }
    return TransferOptions(**{**given, **changes})


@pytest.fixture
def filled(folders):
    source = folders / "in"
    put(source, "a.csv", b"a", FROM)
    put(source, "b.csv", b"bb", TO)
    put(source, "c.txt", b"c", TO + 100)
    put(source, "sub/d.csv", b"dddd", TO)
    put(source, "a b.csv", b"", FROM + 50)
    put(source, "p%20q.csv", b"p", FROM + 50)
    put(source, "ñ.csv", b"n", FROM + 50)
    put(source, "_x.csv", b"x", FROM + 50)
    put(source, ".y.csv", b"y", FROM + 50)
    put(source, "k=1/e.csv", b"e", FROM + 50)
    put(source, "half.csv", b"h", FROM + 0.5)
    put(source, "z.csv.gz", b"not really compressed", FROM - 100_000)
    (source / "empty").mkdir()
    return folders


IN_WINDOW = sorted(["b.csv", "sub/d.csv", "a b.csv", "p%20q.csv", "ñ.csv", "_x.csv", ".y.csv", "k=1/e.csv"])


# --- listing


def test_walk_finds_every_regular_file_once(spark, filled):
    (filled / "in/link").symlink_to(filled / "in")
    files = walk_files(spark, f"file://{filled}/in/")
    everything = sorted(
        str(path.relative_to(filled / "in")) for path in (filled / "in").rglob("*") if path.is_file() and "link" not in path.parts
    )
    assert names(files) == everything
    row = files.where("relpath = 'sub/d.csv'").first()
    assert (row.size, row.mtime_s) == (4, TO)


def test_walk_keeps_the_window_only(spark, filled):
    assert names(walk_files(spark, str(filled / "in"), window=(FROM, TO))) == IN_WINDOW


def test_unfinished_files_are_not_listed(spark, filled):
    put(filled / "in", ".b.csv.77-1.tidemark-part")
    put(filled / "in", "own.tidemark-part")
    found = names(walk_files(spark, str(filled / "in")))
    assert ".b.csv.77-1.tidemark-part" not in found and "own.tidemark-part" in found


def test_names_that_are_no_text(spark, folders):
    put(folders / "in", "good.csv")
    with open(os.fsencode(folders / "in") + b"/bad\xff.csv", "wb") as file:
        file.write(b"x")
    run = run_transfer(spark, options(folders), "r1", 2_000_000_000_000)
    assert {r.relpath: r.check for r in run.ledger.collect()} == {"good.csv": "verified", "bad?.csv": "missing"}
    os.mkdir(os.fsencode(folders / "in") + b"/folder\xff")
    with pytest.raises(Exception, match="not UTF-8"):
        walk_files(spark, str(folders / "in"))


def test_walk_is_not_recursive_on_request(spark, filled):
    assert "sub/d.csv" not in names(walk_files(spark, str(filled / "in"), recursive=False))
    assert names(walk_files(spark, str(filled / "in"), subtree="sub")) == ["sub/d.csv"]
    assert walk_files(spark, str(filled / "in"), subtree="nope").count() == 0


def test_scan_drops_nothing_and_prunes(spark, filled):
    files = scan_files(spark, str(filled / "in"), FROM, TO)
    assert {"a.csv", "c.txt", "z.csv.gz"}.isdisjoint(names(files))
    assert names(delta_filter(files, FROM, TO, on="mtime")) == IN_WINDOW
    assert names(scan_files(spark, str(filled / "in"))) == names(walk_files(spark, str(filled / "in")))


def test_contents_of_empty_and_hidden_files(spark, filled):
    found = {os.path.relpath(r.path, filled / "in"): r for r in read_content(spark, str(filled / "in")).collect()}
    assert sorted(found) == names(walk_files(spark, str(filled / "in")))
    assert (found["a b.csv"].content, found[".y.csv"].content, found["_x.csv"].size) == (b"", b"y", 1)


def test_a_task_that_does_not_see_the_root_fails(folders):
    assert list(listing.entries(str(folders / "in"), str(folders / "in/gone meanwhile"))) == []
    with pytest.raises(FileNotFoundError):
        list(listing.entries(str(folders / "nope"), str(folders / "nope")))
    with pytest.raises(FileNotFoundError):
        list(listing.entries(str(folders / "nope"), str(folders / "nope/sub")))


def test_empty_folder_lists_nothing_and_missing_folder_fails(spark, filled):
    assert walk_files(spark, str(filled / "in/empty")).count() == 0
    assert scan_files(spark, str(filled / "in/empty")).count() == 0
    with pytest.raises(FileNotFoundError):
        walk_files(spark, str(filled / "in/nope"))
    with pytest.raises(FileNotFoundError):
        scan_files(spark, str(filled / "in/nope"))


def test_the_two_manifests_name_files_differently(spark, filled):
    files = walk_files(spark, str(filled / "in"), subtree="sub")
    sftp = sftp_manifest(files, "c", "u", "h", root="/in").first()
    assert (sftp.fullfilename, sftp.filename, sftp.basename) == ("sftp://u@h:22/in/sub/d.csv", "/sub/d.csv", "/in/sub/")
    store = store_manifest(files, "c", "gs://b/in").first()
    assert (store.fullfilename, store.filename, store.basename) == ("/b/in/sub/d.csv", "d.csv", "/b/in/")


# --- transfer


def test_run_moves_the_window_and_only_it(spark, filled):
    run = run_transfer(spark, options(filled, from_delta=FROM), "r1", TO * 1000)
    assert names(run.ledger) == IN_WINDOW
    assert {row.check for row in run.ledger.collect()} == {"verified"}
    for name in IN_WINDOW:
        assert (filled / "out" / name).read_bytes() == (filled / "in" / name).read_bytes()
    assert not list((filled / "out").rglob("*part"))


def test_compressed_names_are_copied_as_they_are(spark, filled):
    run_transfer(spark, options(filled), "r1", TO * 1000)
    assert (filled / "out/z.csv.gz").read_bytes() == b"not really compressed"


def test_regex_and_subtree(spark, filled):
    run = run_transfer(spark, options(filled, regex=r".*\.csv", subtree="sub"), "r1", TO * 1000)
    assert names(run.ledger) == ["sub/d.csv"]


def test_runs_tile_and_repeat_nothing(spark, filled):
    settings = options(filled)
    first = run_transfer(spark, settings, "r1", TO * 1000)
    assert "c.txt" not in names(first.ledger)
    second = run_transfer(spark, settings, "r2", (TO + 100) * 1000)
    assert names(second.ledger) == ["c.txt"] and (second.from_s, second.to_s) == (TO, TO + 100)
    assert names(run_transfer(spark, settings, "r3", (TO + 100) * 1000).ledger) == []


def test_rewritten_file_goes_again(spark, filled):
    settings = options(filled)
    run_transfer(spark, settings, "r1", TO * 1000)
    put(filled / "in", "b.csv", b"new", TO + 400)
    assert "b.csv" in names(run_transfer(spark, settings, "r2", (TO + 500) * 1000).ledger)
    assert (filled / "out/b.csv").read_bytes() == b"new"


def test_preview_does_nothing(spark, filled):
    run = run_transfer(spark, options(filled, preview=True), "r1", TO * 1000)
    assert "b.csv" in names(run.plan) and run.ledger is None
    assert not any((filled / "out").iterdir()) and not (filled / "state").exists()


def test_missing_target_fails_before_any_work(spark, filled):
    with pytest.raises(FileNotFoundError):
        run_transfer(spark, options(filled, target_root=str(filled / "nowhere")), "r1", TO * 1000)


def test_failed_file_is_kept_and_tried_again(spark, filled):
    """The folder in the way makes one copy fail; the run and its watermark go on."""
    (filled / "out/b.csv").mkdir()
    settings = options(filled, retries=1)
    first = run_transfer(spark, settings, "r1", TO * 1000)
    bad = first.ledger.where("relpath = 'b.csv'").first()
    assert (bad.status, bad.check, bad.attempts) == ("failed", "failed", 2) and bad.error
    assert first.committed and first.ledger.where("check = 'verified'").count() == first.ledger.count() - 1
    (filled / "out/b.csv").rmdir()
    second = run_transfer(spark, settings, "r2", TO * 1000)
    assert names(second.ledger) == ["b.csv"] and second.ledger.first().check == "verified"
    assert names(run_transfer(spark, settings, "r3", TO * 1000).ledger) == []
    assert not list((filled / "out").rglob("*part"))


def test_failed_file_rewritten_since_goes_once(spark, filled):
    (filled / "out/b.csv").mkdir()
    run_transfer(spark, options(filled), "r1", TO * 1000)
    (filled / "out/b.csv").rmdir()
    put(filled / "in", "b.csv", b"newer", TO + 10)
    run = run_transfer(spark, options(filled), "r2", (TO + 50) * 1000)
    assert [(r.relpath, r.mtime_s, r.check) for r in run.ledger.collect()] == [("b.csv", TO + 10, "verified")]


def test_failure_of_a_run_that_moves_no_watermark_goes_again_once(spark, filled):
    run_transfer(spark, options(filled), "r1", (TO + 200) * 1000)
    (filled / "out/a.csv").unlink()
    (filled / "out/a.csv").mkdir()
    back = run_transfer(spark, options(filled, from_delta=0), "backfill", TO * 1000)
    assert not back.committed and back.ledger.where("relpath = 'a.csv'").first().check == "failed"
    (filled / "out/a.csv").rmdir()
    again = run_transfer(spark, options(filled), "r2", (TO + 300) * 1000)
    assert [(r.relpath, r.check) for r in again.ledger.collect()] == [("a.csv", "verified")]
    assert names(run_transfer(spark, options(filled), "r3", (TO + 400) * 1000).ledger) == []


def test_resumed_run_keeps_its_window(spark, filled, monkeypatch):
    """It dies with a plan up to TO; what arrives later belongs to the next run, whenever it is resumed."""
    from tidemark.plans import run as plans

    def dies(*rest, **more):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patched:
        patched.setattr(plans, "transfer", dies)
        with pytest.raises(RuntimeError):
            run_transfer(spark, options(filled), "r1", TO * 1000)
    put(filled / "in", "later.csv", b"l", TO + 20)
    first = run_transfer(spark, options(filled), "r1", (TO + 30) * 1000)
    assert first.to_s == TO and "later.csv" not in names(first.ledger)
    assert names(run_transfer(spark, options(filled), "r2", (TO + 30) * 1000).ledger) == ["later.csv"]


def test_vanished_file_is_missing_not_failed(spark, filled):
    plan = plan_transfer(sftp_manifest(walk_files(spark, str(filled / "in"), subtree="sub"), "c", "u", "h"), str(filled / "out"))
    (filled / "in/sub/d.csv").unlink()
    row = transfer(plan, retries=5, wait_s=0).first()
    assert (row.status, row.attempts) == ("missing", 1)


def test_outcome_is_not_computed_twice(spark, filled):
    manifest = sftp_manifest(walk_files(spark, str(filled / "in")), "c", "u", "h")
    done = transfer(plan_transfer(manifest, str(filled / "out")), wait_s=0)
    (filled / "out/b.csv").unlink()
    assert done.count() and not (filled / "out/b.csv").exists()


def test_interrupted_run_is_finished_under_its_name(spark, filled, monkeypatch):
    """The ledger is written, the archive step breaks half-way; the same run completes it."""
    from tidemark.plans import run as plans

    settings = options(filled, archive="rename", archive_root=str(filled / "done"))
    real = plans.archive

    def half(ledger, *rest):
        real(ledger.where("relpath = 'b.csv'"), *rest)
        raise RuntimeError("executor lost")

    monkeypatch.setattr(plans, "archive", half)
    with pytest.raises(RuntimeError):
        run_transfer(spark, settings, "r1", TO * 1000)
    assert (filled / "done/b.csv").exists() and read_watermark(spark, f"{filled}/state/watermarks", "p") is None
    monkeypatch.setattr(plans, "archive", real)
    run = run_transfer(spark, settings, "r1", TO * 1000)
    assert "b.csv" in names(run.ledger) and run.committed
    assert {row.archive_status for row in run.archived.collect()} == {"archived"}
    again = run_transfer(spark, settings, "r1", TO * 1000)
    assert names(again.ledger) == names(run.ledger) and again.to_s == run.to_s


def test_task_count_follows_files_and_bytes(spark):
    def plan(files, size):
        return spark.range(files).select(F.lit(size).cast("bigint").alias("size"))

    cores = spark.sparkContext.defaultParallelism
    assert task_count(plan(0, 0)) == 1
    assert task_count(plan(3, 5)) == 3
    assert task_count(plan(100, 1)) == cores
    assert task_count(plan(100_000, 1)) == 50
    assert task_count(plan(500, 2**30)) == 500


def test_times_survive_the_hour_that_occurs_twice(spark, folders):
    """Both files are from half past two, local time, one hour apart."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    first, second = 1_729_989_000, 1_729_992_600
    put(folders / "in", "a", b"a", first)
    put(folders / "in", "b", b"b", second)
    spark.conf.set("spark.sql.session.timeZone", "Europe/Madrid")
    try:
        run = run_transfer(spark, options(folders), "r1", second * 1000)
        times = run.ledger.select("relpath", "mtime_s", F.unix_seconds("mtime").alias("mtime"))
        assert sorted(map(tuple, times.collect())) == [("a", first, first), ("b", second, second)]
        hashed = checksum_files(walk_files(spark, str(folders / "in")))
        assert sorted(r[0] for r in hashed.select(F.unix_seconds("mtime")).collect()) == [first, second]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_sealing_without_a_key_is_refused(spark, filled):
    manifest = sftp_manifest(walk_files(spark, str(filled / "in")), "c", "u", "h")
    with pytest.raises(ValueError, match="needs a key"):
        transfer(plan_transfer(manifest, str(filled / "out"), "encrypt"))
    assert not any((filled / "out").iterdir())
    with pytest.raises(ValueError, match="action"):
        plan_transfer(manifest, str(filled / "out"), "zip")


# --- encryption


def sealed_pair(spark, folders, **changes):
    (folders / "key").write_bytes(os.urandom(32))
    (folders / "back").mkdir()
    secret = {"encryption": "aes_gcm", "key_uri": str(folders / "key"), "state_root": None, **changes}
    there = options(folders, **secret)
    back = options(folders, source_root=str(folders / "out"), target_root=str(folders / "back"), direction="to_sftp", **secret)
    return there, back


def test_sealed_files_come_back(spark, folders):
    sizes = [0, 1, 1024 * 1024 - 1, 1024 * 1024, 1024 * 1024 + 1, 3 * 1024 * 1024 + 17]
    for size in sizes:
        put(folders / "in", f"f{size}.bin", os.urandom(size))
    there, back = sealed_pair(spark, folders)
    run = run_transfer(spark, there, "r1", TO * 1000)
    assert {(row.check, row.content_type) for row in run.ledger.collect()} == {("verified", "application/pgp-encrypted")}
    put(folders / "out", "plain.bin", b"plain")
    run = run_transfer(spark, back, "r1", 2_000_000_000_000)
    assert {row.check for row in run.ledger.collect()} == {"verified"}
    for size in sizes:
        assert (folders / f"back/f{size}.bin").read_bytes() == (folders / f"in/f{size}.bin").read_bytes()
        assert (folders / f"in/f{size}.bin").read_bytes() not in (folders / f"out/f{size}.bin.pgp").read_bytes() or size < 2
    assert (folders / "back/plain.bin").read_bytes() == b"plain"


def test_damaged_sealed_files_are_not_published(spark, folders):
    body = os.urandom(3 * 1024 * 1024)
    for name in ("flip", "cut", "swap", "short", "splice", "good"):
        put(folders / "in", name, body)
    there, back = sealed_pair(spark, folders, retries=1)
    run_transfer(spark, there, "r1", TO * 1000)
    record = 4 + 1024 * 1024 + 28
    whole = (folders / "out/flip.pgp").read_bytes()
    (folders / "out/flip.pgp").write_bytes(whole[:-1] + bytes([whole[-1] ^ 1]))
    cut = (folders / "out/cut.pgp").read_bytes()
    (folders / "out/cut.pgp").write_bytes(cut[: 20 + 2 * record])
    swap = (folders / "out/swap.pgp").read_bytes()
    (folders / "out/swap.pgp").write_bytes(swap[:20] + swap[20 + record : 20 + 2 * record] + swap[20 : 20 + record] + swap[20 + 2 * record :])
    splice = (folders / "out/splice.pgp").read_bytes()
    (folders / "out/splice.pgp").write_bytes(splice[: 20 + record] + whole[20 + record :])
    short = (folders / "out/short.pgp").read_bytes()
    (folders / "out/short.pgp").write_bytes(short[:-5])
    run = run_transfer(spark, back, "r1", 2_000_000_000_000)
    found = {row.relpath: (row.status, row.attempts) for row in run.ledger.collect()}
    assert found.pop("good.pgp") == ("copied", 1)
    assert set(found.values()) == {("failed", 2)} and len(found) == 5
    assert [path.name for path in (folders / "back").iterdir()] == ["good"]


# --- verification


def md5(text):
    return None if text is None else hashlib.md5(text.encode()).hexdigest()


def test_every_path_is_judged_once(spark):
    source = [("same", "1"), ("differs", "1"), ("gone", "1"), ("twice", "1"), ("twice", "1"), ("torn", "1"), ("torn", "2"),
              ("sealed.pgp", "1"), ("unread", None), ("half", "1"), ("half", None)]
    target = [("same", "1"), ("differs", "2"), ("new", "1"), ("twice", "1"), ("torn", "1"), ("sealed.pgp", None),
              ("unread", None), ("half", "1")]
    sides = [spark.createDataFrame([(p, md5(t)) for p, t in side], "relpath string, md5 string") for side in (source, target)]
    checked = {row.relpath: row for row in verify(*sides).collect()}
    assert {path: row.check for path, row in checked.items()} == {
        "same": "verified", "differs": "mismatch", "gone": "missing", "new": "unexpected", "twice": "verified",
        "torn": "mismatch", "sealed.pgp": "exempt", "unread": "mismatch", "half": "mismatch",
    }
    assert verify(*sides).count() == 9
    assert (checked["differs"].md5_source, checked["differs"].md5_target) == (md5("1"), md5("2"))
    assert checked["gone"].md5_target is None


def test_both_ways_to_verify_agree(spark):
    source = [("same", "1"), ("differs", "1"), ("gone", "1"), ("sealed.pgp", "1"), ("unread", None), ("gone.pgp", None)]
    target = [("same", "1"), ("differs", "2"), ("new", "1"), ("sealed.pgp", None), ("unread", None), ("new.pgp", None)]
    sides = [spark.createDataFrame(side, "relpath string, md5 string") for side in (source, target)]
    grouped, joined = (sorted(map(tuple, verify(*sides, unique=unique).collect())) for unique in (False, True))
    assert grouped == joined and len(grouped) == 8


@settings(max_examples=10, deadline=None)
@given(*[st.lists(st.tuples(st.sampled_from("abcd"), st.sampled_from(["1", "2", None])), max_size=8) for _ in range(2)])
def test_verification_by_brute_force(spark, source, target):
    sides = [spark.createDataFrame([(p, md5(t)) for p, t in side], "relpath string, md5 string") for side in (source, target)]
    found = {row.relpath: row.check for row in verify(*sides).collect()}

    def judge(path):
        left, right = ([t for p, t in side if p == path] for side in (source, target))
        if not right:
            return "missing"
        if not left:
            return "unexpected"
        return "verified" if None not in left + right and len(set(left + right)) == 1 else "mismatch"

    assert found == {path: judge(path) for path in {p for p, _ in source + target}}


def test_checksums_of_files(spark, filled):
    rows = checksum_files(walk_files(spark, str(filled / "in")), buffer_bytes=2).collect()
    assert {r.relpath: r.md5 for r in rows} == {
        r.relpath: hashlib.md5((filled / "in" / r.relpath).read_bytes()).hexdigest() for r in rows
    }


# --- archive


def test_archive_only_after_verification(spark, filled):
    (filled / "out/b.csv").mkdir()
    run = run_transfer(spark, options(filled, archive="rename", archive_root=str(filled / "done")), "r1", TO * 1000)
    status = {row.relpath: row.archive_status for row in run.archived.collect()}
    assert status.pop("b.csv") == "skipped" and set(status.values()) == {"archived"}
    assert (filled / "in/b.csv").exists() and not (filled / "in/sub/d.csv").exists()
    assert (filled / "done/sub/d.csv").read_bytes() == b"dddd"


def test_flat_archive_refuses_equal_names(spark, folders):
    for folder in ("f1", "f2", "f3"):
        put(folders / "in", f"{folder}/same.csv", folder.encode())
    put(folders / "in", "f1/own.csv", b"own")
    run = run_transfer(spark, options(folders, direction="to_sftp"), "r1", TO * 1000)
    done = archive(run.ledger, "rename", str(folders / "done"), flatten=True)
    status = {row.relpath: row.archive_status for row in done.collect()}
    assert status == {"f1/same.csv": "collision", "f2/same.csv": "collision", "f3/same.csv": "collision", "f1/own.csv": "archived"}
    assert [path.name for path in (folders / "done").iterdir()] == ["own.csv"]
    assert (folders / "in/f1/same.csv").exists()


def test_archive_is_safe_to_repeat(spark, filled):
    ledger = run_transfer(spark, options(filled), "r1", TO * 1000).ledger
    put(filled / "in", "b.csv", b"rewritten since", TO + 500)
    for _ in range(2):
        status = {r.relpath: r.archive_status for r in archive(ledger, "rename", str(filled / "done")).collect()}
        assert status.pop("b.csv") == "changed" and set(status.values()) == {"archived"}
    assert (filled / "in/b.csv").read_bytes() == b"rewritten since"


def test_archive_never_overwrites(spark, filled):
    put(filled / "done", "b.csv", b"of an earlier day")
    ledger = run_transfer(spark, options(filled), "r1", TO * 1000).ledger
    status = {r.relpath: r.archive_status for r in archive(ledger, "rename", str(filled / "done")).collect()}
    assert status["b.csv"] == "collision" and (filled / "done/b.csv").read_bytes() == b"of an earlier day"


def test_archive_in_another_file_system(spark, folders, monkeypatch):
    """Part of a copy, left by a lost attempt, is in nobody's way; an original goes only once its copy is whole."""
    path = put(folders / "in", "b.csv", b"bb")
    part = put(folders / "done", ".b.csv.7-1.tidemark-part", b"b")
    one = archive_file("rename")
    monkeypatch.setitem(fs._OPENED, ("file", "other"), fs.pafs.LocalFileSystem())
    monkeypatch.setattr(archiving, "open_fs", lambda uri: (fs._OPENED["file", "other"], uri) if "/done/" in uri else fs.open_fs(uri))
    row = {"relpath": "b.csv", "mtime_s": 1_000_000_050, "path": str(path), "size": 2, "md5_source": "", "action": "encrypt",
           "archive_target": str(folders / "done/b.csv"), "refused": None}
    done = pd.concat(one([pd.DataFrame([row])]))
    assert list(done["archive_status"]) == ["archived"] and not path.exists()
    assert (folders / "done/b.csv").read_bytes() == b"bb" and part.exists()


def test_archive_onto_itself_is_refused(spark, filled):
    ledger = run_transfer(spark, options(filled), "r1", TO * 1000).ledger
    assert {r.archive_status for r in archive(ledger, "rename", str(filled / "in")).collect()} == {"same_path"}
    assert (filled / "in/b.csv").exists()
    with pytest.raises(ValueError):
        archive(ledger, "rename")
    with pytest.raises(ValueError):
        archive(ledger, "shred")


def test_folders_as_uris(spark, filled):
    """A path and its URI are one place."""
    base = f"file://{filled}"
    uris = {"source_root": f"{base}/in/", "target_root": f"{base}/out/", "state_root": f"{base}/state/"}
    plain = run_transfer(spark, options(filled, **uris), "r1", TO * 1000)
    assert (filled / "out/b.csv").exists() and (filled / "state/ledger").exists()
    assert {r.archive_status for r in archive(plain.ledger, "rename", f"{base}/in").collect()} == {"same_path"}
    done = archive(plain.ledger, "rename", f"{base}/done")
    assert {r.archive_status for r in done.collect()} == {"archived"} and (filled / "done/sub/d.csv").exists()
    assert names(run_transfer(spark, options(filled, **uris), "r2", (TO + 100) * 1000).ledger) == ["c.txt"]


def test_remove(spark, filled):
    run = run_transfer(spark, options(filled, archive="remove"), "r1", TO * 1000)
    assert {r.archive_status for r in run.archived.collect()} == {"removed"}
    assert names(walk_files(spark, str(filled / "in"))) == ["c.txt"]


# --- lost executors


def losing(real):
    """Every task's first attempt does its work and is lost before it can report."""

    def make(*settings):
        work = real(*settings)

        def lose_first(batches):
            from pyspark import TaskContext

            for batch in work(batches):
                if TaskContext.get().attemptNumber() == 0:
                    raise RuntimeError("executor lost")
                yield batch

        return lose_first

    return make


@pytest.mark.parametrize("mode", ["rename", "remove"])
def test_lost_tasks_do_no_harm(spark, filled, monkeypatch, mode):
    import importlib

    for module, name in (("transfer", "_copier"), ("archive", "_put_away")):
        module = importlib.import_module(f"tidemark.operators.{module}")
        monkeypatch.setattr(module, name, losing(getattr(module, name)))
    settings = options(filled, archive=mode, archive_root=str(filled / "done"))
    run = run_transfer(spark, settings, "r1", TO * 1000)
    rows = run.ledger.collect()
    assert len(rows) == len({row.relpath for row in rows}) == 11 and {row.check for row in rows} == {"verified"}
    assert {row.archive_status for row in run.archived.collect()} == {"archived" if mode == "rename" else "removed"}
    assert names(walk_files(spark, str(filled / "out"))) == sorted(row.relpath for row in rows)
    assert names(walk_files(spark, str(filled / "in"))) == ["c.txt"]


# --- state


def test_watermark_never_moves_back(spark, folders):
    state = str(folders / "w")
    assert read_watermark(spark, state, "p") is None
    assert commit_watermark(spark, state, "p", 0, 100, "r1")
    assert not commit_watermark(spark, state, "p", 0, 50, "r2")
    assert not commit_watermark(spark, state, "p", 100, 200, "r3", preview=True)
    assert commit_watermark(spark, state, "other", 0, 7, "r1")
    assert commit_watermark(spark, state, "p", 100, 200, "r4")
    row = read_watermark(spark, state, "p")
    assert (row.from_s, row.to_s, row.run_id) == (100, 200, "r4")


@pytest.mark.parametrize(
    "text, legacy, seconds",
    [("1629205254", False, 1629205254), ("1629205254\n", False, 1629205254), ("1629205254\n", True, 0), ("20210715", False, 0),
     ("16292O5254", False, 0), ("4816407641", False, 0), ("", False, 0)],
)
def test_watermark_text(spark, tmp_path, text, legacy, seconds):
    (tmp_path / "delta.txt").write_text(text)
    uri = str(tmp_path / "delta.txt")
    assert read_watermark_text(spark, uri, 1_700_000_000, legacy=legacy) == seconds
    if text and not seconds:
        with pytest.raises(ValueError):
            read_watermark_text(spark, uri, 1_700_000_000, strict=True, legacy=legacy)


def test_missing_watermark_text_means_the_beginning(spark, tmp_path):
    assert read_watermark_text(spark, str(tmp_path / "none")) == 0
    with pytest.raises(AnalysisException):
        read_watermark_text(spark, str(tmp_path / "none"), strict=True)


def test_bad_run_id(spark, filled):
    with pytest.raises(ValueError, match="names hold"):
        run_transfer(spark, options(filled), "a/b", TO * 1000)
    with pytest.raises(ValueError, match="names hold"):
        run_transfer(spark, options(filled, pipeline="a b"), "r1", TO * 1000)


def test_pipelines_share_state_without_meeting(spark, filled):
    (filled / "other").mkdir()
    run_transfer(spark, options(filled, subtree="sub"), "r1", TO * 1000)
    other = run_transfer(spark, options(filled, pipeline="q", target_root=str(filled / "other")), "r1", TO * 1000)
    assert (filled / "other/b.csv").exists() and not (filled / "out/b.csv").exists()
    assert {(r.pipeline, r.run_id) for r in other.metrics.collect()} == {("q", "r1")}
    assert L.read_ledger(spark, f"{filled}/state/ledger").where("pipeline = 'p'").count() == 1


def test_late_file_is_found_by_looking_back(spark, filled):
    run_transfer(spark, options(filled), "r1", TO * 1000)
    put(filled / "in", "late.csv", b"late", FROM - 500)
    assert names(run_transfer(spark, options(filled), "r2", (TO + 50) * 1000).ledger) == []
    found = run_transfer(spark, options(filled, lookback_s=1000), "r3", (TO + 60) * 1000)
    assert names(found.ledger) == ["late.csv"]


def test_latest_version_and_retry(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "relpath string, mtime_s bigint, v string")
    assert sorted(map(tuple, L.latest_version(rows).collect())) == [("a", 2, "y"), ("b", 1, "z")]
    failed = spark.createDataFrame([("a", 2, "old"), ("c", 1, "c")], rows.schema)
    both = L.retry_set(rows, failed)
    assert sorted(map(tuple, both.collect())) == [("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z"), ("c", 1, "c")]


def test_totals_and_percentiles(spark):
    rows = [("x", "f", 10, 1, 0, 100), ("x", "g", 20, 3, 0, 300), ("y", "f", 5, 1, 0, 7)]
    ledger = spark.createDataFrame(rows, "src string, kind string, bytes bigint, attempts int, start_ms bigint, end_ms bigint")
    totals = {(r.src, r.kind, r.level): (r.files, r.bytes, r.retries, r.max_ms) for r in run_totals(ledger, ["src", "kind"]).collect()}
    assert totals[(None, None, 3)] == (3, 35, 2, 300) and totals[("x", None, 1)] == (2, 30, 2, 300) and len(totals) == 6
    at = {r.src: r.ms_at for r in transfer_time_percentiles(ledger, ["src"], [0.5, 1.0]).collect()}
    assert at == {"x": [200.0, 300.0], "y": [7.0, 7.0]}


def test_written_files(spark, folders):
    rows = spark.createDataFrame([("a/b.bin", b"\x00\x01", FROM), ("ñ c", b"", FROM)], "relpath string, content binary, mtime_s bigint")
    done = {r.relpath: (r.bytes, r.md5) for r in write_files(rows, str(folders / "out")).collect()}
    assert done["a/b.bin"] == (2, hashlib.md5(b"\x00\x01").hexdigest())
    assert int((folders / "out/ñ c").stat().st_mtime) == FROM


# --- streams


def test_stream_sees_each_version_once(spark, filled):
    source, table, checkpoint = str(filled / "in"), str(filled / "table"), str(filled / "checkpoint")

    def drain():
        append_stream(stream_listing(spark, source, regex=r".*\.csv"), table, checkpoint).awaitTermination()
        return names(spark.read.parquet(table))

    first = drain()
    assert "sub/d.csv" in first and "c.txt" not in first
    put(filled / "in", "b.csv", b"rewritten", TO + 900)
    put(filled / "in", "new.csv", b"new", TO + 900)
    assert drain() == sorted(first + ["b.csv", "new.csv"])


def test_stream_keeps_originals_that_were_not_copied_and_tries_again(spark, filled):
    def drain():
        manifest = sftp_manifest(stream_listing(spark, str(filled / "in/sub")), "c", "u", "h")
        place = str(filled / "out"), f"{filled}/ledger", f"{filled}/checkpoint"
        stream_transfer(manifest, *place, "s", 0, 0, "rename", str(filled / "done")).awaitTermination()
        return {r.relpath: r.check for r in L.latest_version(L.read_ledger(spark, f"{filled}/ledger"), by="end_ms").collect()}

    put(filled / "in", "sub/bad.csv")
    (filled / "out/bad.csv").mkdir()
    assert drain() == {"bad.csv": "failed", "d.csv": "verified"}
    put(filled / "in", "sub/e.csv")
    assert drain() == {"bad.csv": "failed", "d.csv": "verified", "e.csv": "verified"}
    assert (filled / "in/sub/bad.csv").exists() and not (filled / "in/sub/d.csv").exists()
    (filled / "out/bad.csv").rmdir()
    assert drain()["bad.csv"] == "verified" and (filled / "done/bad.csv").exists()


def test_stream_transfer_accounts_for_every_batch(spark, filled):
    def drain():
        files = stream_listing(spark, str(filled / "in"))
        manifest = sftp_manifest(files, "c", "u", "h")
        stream_transfer(manifest, str(filled / "out"), f"{filled}/ledger", f"{filled}/checkpoint", "s", 0, 0).awaitTermination()
        return L.read_ledger(spark, f"{filled}/ledger")

    ledger = drain()
    assert names(ledger) == names(walk_files(spark, str(filled / "in")))
    assert {r.check for r in ledger.collect()} == {"verified"}
    n = ledger.count()
    put(filled / "in", "_more.csv", b"", TO + 900)
    again = drain()
    assert again.count() == n + 1 and again.select("run_id").distinct().count() == 2
    assert drain().count() == n + 1


def test_options_are_frozen():
    with pytest.raises(dataclasses.FrozenInstanceError):
        TransferOptions("p", "/in", "/out").retries = 5


def test_run_leaves_no_work_behind(spark, filled):
    from tidemark.session import shared_folder

    shared = shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(shared))
    run = run_transfer(spark, options(filled, archive="remove"), "r1", TO * 1000)
    assert set(os.listdir(shared)) == before
    assert run.plan.count() == run.ledger.count() == run.archived.count() == run.metrics.count() / 7


def test_old_state_counts_until_the_first_commit(spark, filled):
    (filled / "delta.txt").write_text(f"{FROM}\n")
    settings = options(filled, legacy_state=str(filled / "delta.txt"))
    assert names(run_transfer(spark, settings, "r1", TO * 1000).ledger) == IN_WINDOW
    second = run_transfer(spark, settings, "r2", (TO + 100) * 1000)
    assert (second.from_s, names(second.ledger)) == (TO, ["c.txt"])


# --- configuration


REMOTE = {"sftpServer": "h", "sftpPort": "2222", "sftpUser": "u", "sftpPath": "/in"}


def test_properties_to_the_store(spark, filled):
    source = {**REMOTE, "referenceName": "ref", "recursive": "yes", "regexFilter": "", "fromDelta": str(FROM)}
    sink = {"path": str(filled / "out"), "numRetries": "", "timeToWait": "0", "archiveOriginals": "yes",
            "archiveOption": "rename", "targetPath": "/done", "encryption": "NONE"}
    given = options_from_properties("p", source, sink, str(filled / "state"), str(filled), arguments={"safety.read.time": "0"})
    run = run_transfer(spark, given, "r1", TO * 1000)
    assert names(run.ledger) == IN_WINDOW and (filled / "done/sub/d.csv").exists()
    row = run.ledger.where("relpath = 'sub/d.csv'").first()
    assert (row.connection_ref, row.fullfilename, row.basename) == ("ref", "sftp://u@h:2222/in/sub/d.csv", "/in/sub/")
    assert (given.retries, given.wait_s) == (0, 0)


def test_properties_to_the_remote_server():
    source = {"gcsPath": "gs://b/in", "recursive": "true", "regexFilter": ".*", "persistDelta": "gs://b/delta"}
    sink = {**REMOTE, "sftpPath": "/out", "archiveOriginals": "yes", "archiveOption": "remove", "targetPath": "gs://b/done",
            "privateKeyPath": "/keys/k"}
    given = options_from_properties("p", source, sink, mount="/mnt/", key_uri="/key", arguments={"exec.preview": "true"})
    assert (given.direction, given.source_root, given.target_root) == ("to_sftp", "gs://b/in", "/mnt/out")
    assert (given.archive, given.archive_root, given.encryption, given.key_uri) == ("remove", None, "aes_gcm", "/key")
    assert (given.safety_s, given.preview, given.legacy_state, given.recursive) == (300, True, "gs://b/delta", True)


def test_bad_properties():
    with pytest.raises(ValueError, match="numRetries"):
        options_from_properties("p", REMOTE, {"path": "/out", "numRetries": "many"})
    with pytest.raises(ValueError, match="macros.*sftpPath"):
        options_from_properties("p", {**REMOTE, "sftpPath": "${folder}"}, {"path": "/out"})


# --- command line


def test_job(spark, filled, capsys):
    from tidemark.plans.job import main

    arguments = [
        "--pipeline", "p", "--source-root", str(filled / "in"), "--target-root", str(filled / "out"), "--recursive",
        "--state-root", str(filled / "state"), "--user", "u", "--host", "h", "--wait-s", "0", "--safety-s", "bad",
        "--run-id", "r1", "--logical-start-ms", str((TO + 300) * 1000),
    ]
    assert main([*arguments, "--preview"])["files"] == {"planned": 11}
    summary = main(arguments)
    assert summary == {"from_s": 0, "to_s": TO, "committed": True, "files": {"verified": 11}}
    assert '"committed": true' in capsys.readouterr().out
