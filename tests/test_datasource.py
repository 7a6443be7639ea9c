"""Folders read, streamed and written through Spark's data source interface."""

import os
import time
from types import SimpleNamespace

import pandas as pd
import pyarrow as pa
import pytest
from pyarrow import fs as pafs
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, IsNotNull, LessThanOrEqual, Not, StringEndsWith, StringStartsWith

from tests.conftest import put
from tidemark.operators import ledger as L
from tidemark.sources import datasource, fs, listing
from tidemark.sources.datasource import FORMAT, FilesReader, FilesWriter, Listing, register, settle, splits
from tidemark.sources.listing import walk_files
from tidemark.sources.manifest import sftp_manifest
from tidemark.sources.staging import Staged
from tidemark.streaming.files import _HoldBack, append_stream, stream_listing, stream_transfer

FROM, TO = 1_000_000_000, 1_000_000_100
CONTENTS = "relpath string, content binary"


@pytest.fixture
def filled(folders):
    for at, name in enumerate(("a.csv", "b/c.csv", "b/_d.csv", "b/.e", "b/deep/er/f.csv", "ñ é/g", "empty/h")):
        put(folders / "in", name, b"" if name.endswith("h") else b"x" * (at + 1), FROM + 10 * at)
    (folders / "in/none").mkdir()
    put(folders / "in", "b/.x.12-3.tidemark-part")
    return folders


def rows(df):
    return sorted(map(tuple, df.select("relpath", "size", "mtime_s", "mtime").collect()))


def load(spark, folder, **options):
    return register(spark).read.format(FORMAT).options(**options).load(str(folder))


# --- reading


@pytest.mark.parametrize("splits", [1, 3, 256])
def test_source_gives_the_rows_of_the_walk(spark, filled, splits):
    wanted = rows(walk_files(spark, str(filled / "in")))
    assert rows(load(spark, filled / "in", splits=splits)) == wanted and len(wanted) == 7
    flat = load(spark, filled / "in", recursive="false", splits=splits)
    assert [r.relpath for r in flat.collect()] == ["a.csv"]


def test_wide_folders_are_shared(spark, folders):
    for i in range(40):
        put(folders / "in", f"wide/{i}/f", b"x")
        put(folders / "in", f"wide/g{i}", b"x")
    listing_ = Listing(str(folders / "in"), True, 8)
    made = splits(listing_)
    assert {s.parts for s in made} == {1, 8} and len(made) <= 2 * 8
    assert rows(load(spark, folders / "in", splits=8)) == rows(walk_files(spark, str(folders / "in")))


CONDITIONS = [
    "relpath like 'b/%'", "relpath = 'b/deep/er/f.csv'", "name like '%.csv' and size > 1", "name in ('g', 'h')",
    "mtime_s > 1000000000 and mtime_s <= 1000000030", "relpath like 'b/d%' and relpath like 'b/deep%'", "relpath like 'b/%' and relpath like 'ñ%'",
    "size >= 3 or name = 'h'", "name <> 'g'", "name is not null and upper(name) = 'H'", "relpath like 'b/_d%'", "size < 4 and name like 'c%'", "relpath like '%deep%'",
]


@pytest.mark.parametrize("condition", CONDITIONS)
def test_conditions(spark, filled, condition):
    walked = walk_files(spark, str(filled / "in")).withColumn("name", F.element_at(F.split("relpath", "/"), -1))
    assert rows(load(spark, filled / "in").where(condition)) == rows(walked.where(condition))


def test_folders_outside_the_prefix_are_not_opened(filled, monkeypatch):
    opened = []
    monkeypatch.setattr(datasource, "entries", lambda root, folder, has=None: opened.append(folder) or listing.entries(root, folder, has))
    reader = FilesReader(Listing(str(filled / "in"), True, 256))
    conditions = [StringStartsWith(("relpath",), "b/de"), GreaterThan(("mtime_s",), FROM), IsNotNull(("name",)), Not(EqualTo(("name",), "x"))]
    assert list(reader.pushFilters(conditions)) == conditions[2:]
    found = [r for part in reader.partitions() for batch in reader.read(part) for r in batch.column("relpath").to_pylist()]
    assert found == ["b/deep/er/f.csv"]
    assert {os.path.relpath(f, filled / "in") for f in opened} == {".", "b", "b/deep", "b/deep/er"}


def test_the_plan_leaves_nothing_to_filter(spark, filled):
    """What the lister judges is no filter above the scan any more."""
    found = load(spark, filled / "in").where("relpath like 'b/%' and mtime_s > 1000000000 and name like '%.csv'")
    plan = found._jdf.queryExecution().executedPlan().toString()
    left = [line for line in plan.splitlines() if "Filter" in line]
    assert not any("StartsWith" in line or ">" in line.replace("->", "") for line in left), plan


def test_what_the_lister_judges():
    take = lambda condition: Listing("/r", True, 9).take(condition)
    assert take(In(("name",), ("a", "b"))) and take(LessThanOrEqual(("size",), 3)) and take(StringEndsWith(("name",), "x"))
    assert not take(EqualTo(("path",), "x")) and not take(EqualTo(("name", "field"), "x")) and not take(EqualTo(("name",), None))


def test_missing_folders_fail(spark, filled):
    with pytest.raises(Exception, match="folder does not exist"):
        load(spark, filled / "gone").collect()
    with pytest.raises(Exception, match="path is required"):
        register(spark).read.format(FORMAT).load().collect()


# --- streams


def drain(spark, folders, **given):
    stream = stream_listing(spark, str(folders / "in"), **given)
    append_stream(stream, str(folders / "table"), str(folders / "checkpoint")).awaitTermination()
    return sorted((r.relpath, r.size) for r in spark.read.parquet(str(folders / "table")).collect())


def test_stream_loses_nothing_and_repeats_nothing(spark, filled):
    """Empty and hidden files, rewritten ones, and ones that arrive with an old time."""
    first = drain(spark, filled)
    assert first == sorted((r[0], r[1]) for r in rows(walk_files(spark, str(filled / "in"))))
    assert drain(spark, filled) == first
    put(filled / "in", "b/c.csv", b"rewritten", FROM + 500)
    put(filled / "in", "b/late", b"late", FROM - 500)
    assert drain(spark, filled) == sorted([*first, ("b/c.csv", 9), ("b/late", 4)])


def test_stream_filters(spark, filled):
    assert drain(spark, filled, subtree="b", regex=r".*\.csv") == [("b/_d.csv", 3), ("b/c.csv", 2), ("b/deep/er/f.csv", 5)]


def test_windows_tile(spark, folders):
    """Without looking back a batch lists its own window, and files of the future wait for theirs."""
    now = int(time.time())
    put(folders / "in", "old", b"1", FROM)
    put(folders / "in", "soon", b"22", now + 6)
    assert drain(spark, folders, lookback_s=0) == [("old", 1)]
    put(folders / "in", "older", b"333", FROM - 1)
    time.sleep(max(0, now + 7 - time.time()))
    assert drain(spark, folders, lookback_s=0) == [("old", 1), ("soon", 2)]


def test_files_wait_until_they_stand(spark, folders):
    """A half-written file goes on once, whole; one that stood goes at the second look; and a short look back forgets nothing."""
    put(folders / "in", "whole", b"all", FROM)
    put(folders / "in", "half", b"ha", FROM)
    given = {"lag_s": 2, "lookback_s": 2_000_000_000}
    assert drain(spark, folders, **given) == []
    put(folders / "in", "half", b"half and half", FROM)
    time.sleep(2.1)
    assert drain(spark, folders, **given) == [("whole", 3)]
    time.sleep(2.1)
    assert drain(spark, folders, **given) == [("half", 13), ("whole", 3)]
    put(folders / "in", "half", b"half and half", FROM + 7)
    assert len(drain(spark, folders, **given)) == 2
    time.sleep(2.1)
    assert drain(spark, folders, **given) == [("half", 13), ("half", 13), ("whole", 3)]


class OneKey:
    """One key's value and timers, and how often the value was asked for."""

    def __init__(self):
        self.value, self.timers, self.calls = None, set(), 0
        self.registerTimer, self.deleteTimer = self.timers.add, self.timers.discard

    def getValueState(self, name, schema):
        return self

    def exists(self):
        self.calls += 1
        return self.value is not None

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls, self.value = self.calls + 1, value

    def clear(self):
        self.value = None


def test_paths_of_a_key_share_its_state():
    """A batch reads and writes a key's state once, however many paths it has, and each path keeps its own times."""
    columns = ["path", "size", "mtime", "mtime_s", "listed_ms"]
    held, store = _HoldBack(columns, 2, 0), OneKey()
    held.init(store)

    def look(now, rows):
        store.calls = 0
        times = SimpleNamespace(getCurrentProcessingTimeInMs=lambda: now)
        frames = [pd.DataFrame(some, columns=columns) for some in (rows[:1_000], rows[1_000:])]
        out = [r for f in held.handleInputRows((1,), iter(frames), times) for r in f.itertuples(index=False, name=None)]
        assert store.calls <= 3
        return out

    def files(now, sizes, seconds=0):
        return [(f"p{i}", size, 1_000_000 * seconds, seconds, now) for i, size in enumerate(sizes)]

    def forget(at):
        store.timers.discard(at)
        list(held.handleExpiredTimer((1,), SimpleNamespace(getCurrentProcessingTimeInMs=lambda: at), SimpleNamespace(getExpiryTimeInMs=lambda: at)))

    first = [1] * 3_000
    assert look(1_000, files(1_000, first)) == []
    assert store.timers == {3_602_000}
    # One grew meanwhile, and one is new: they wait, the others go once.
    second = [2, *first[1:], 7]
    assert look(3_000, files(3_000, second)) == files(3_000, second)[1:3_000]
    assert look(5_000, files(5_000, second)) == [files(5_000, second)[0], files(5_000, second)[-1]]
    before = store.value
    assert look(9_000, files(9_000, second)) == [] and store.value is before and store.timers == {3_602_000}
    # What is as old as the others is forgotten with them; the two that came later have their own time, and are known until then.
    forget(3_602_000)
    assert store.timers == {3_603_000}
    assert look(3_602_500, files(3_602_500, second)) == []
    assert look(3_604_500, files(3_604_500, second)) == files(3_604_500, second)[1:3_000]
    store.timers.clear()
    forget(1 << 50)
    assert store.value is None and not store.timers


def test_held_back_files_are_copied_once_and_whole(spark, folders):
    def copy():
        manifest = sftp_manifest(stream_listing(spark, str(folders / "in"), lag_s=2), "c", "u", "h")
        place = str(folders / "out"), f"{folders}/ledger", f"{folders}/checkpoint"
        stream_transfer(manifest, *place, "s", 0, 0).awaitTermination()
        return sorted((r.relpath, r.bytes, r.check) for r in L.read_ledger(spark, f"{folders}/ledger").collect())

    put(folders / "in", "_growing", b"1", FROM)
    assert copy() == []
    put(folders / "in", "_growing", b"12", FROM)
    time.sleep(2.1)
    assert copy() == [] and not (folders / "out/_growing").exists()
    time.sleep(2.1)
    assert copy() == [("_growing", 2, "verified")] and (folders / "out/_growing").read_bytes() == b"12"
    assert copy() == [("_growing", 2, "verified")]


# --- writing


def contents(spark, n=20):
    return spark.createDataFrame([(f"d{i % 3}/f{i}", b"y" * i) for i in range(n)], CONTENTS).repartition(4)


def test_sink_publishes_all_at_once(spark, folders):
    register(spark)
    out, outcome = folders / "out", folders / "outcome"
    contents(spark).write.format(FORMAT).mode("append").option("outcome", str(outcome)).save(str(out))
    listed = {r.relpath: r.size for r in walk_files(spark, str(out)).collect()}
    assert listed == {f"d{i % 3}/f{i}": i for i in range(20)}
    assert {r.relpath: r.bytes for r in spark.read.parquet(str(outcome)).collect()} == listed
    assert not [f for f in out.rglob("*") if "tidemark" in f.name]


def test_sink_copies_files(spark, filled):
    register(spark)
    files = walk_files(spark, str(filled / "in")).select("relpath", "path", "mtime_s")
    files.write.format(FORMAT).mode("append").save(str(filled / "out"))
    assert rows(walk_files(spark, str(filled / "out"))) == rows(walk_files(spark, str(filled / "in")))


def test_a_failed_job_leaves_nothing(spark, folders):
    """One row of the last task cannot be written: its copies and those of the other tasks are taken back."""
    register(spark)
    put(folders / "out", "kept", b"old")
    put(folders / "out", "d1", b"a file where a folder has to be")
    with pytest.raises(Exception):
        contents(spark).write.format(FORMAT).mode("append").save(str(folders / "out"))
    assert sorted(str(f.relative_to(folders / "out")) for f in (folders / "out").rglob("*") if f.is_file()) == ["d1", "kept"]


@pytest.fixture
def dead(spark, folders, monkeypatch):
    """A job that dies: its tasks have staged their files, and the driver is gone before, or in, its commit."""

    def die(where):
        writer = FilesWriter(str(folders / "out"), None)
        monkeypatch.setattr(datasource.TaskContext, "get", staticmethod(lambda: type("T", (), {"taskAttemptId": lambda self: 7})()))
        batch = pa.RecordBatch.from_pydict({"relpath": ["a", "b/c"], "content": [b"1", b"22"]})
        message = writer.write(iter([batch]))
        assert walk_files(spark, str(folders / "out")).count() == 0
        if where == "in":
            move = datasource.move

            def once(files, source, target):
                if target.endswith("/c"):
                    raise OSError("driver lost")
                move(files, source, target)

            monkeypatch.setattr(datasource, "move", once)
            with pytest.raises(OSError):
                writer.commit([message, None])
            monkeypatch.setattr(datasource, "move", move)

    return die


def test_a_job_that_died_before_its_commit_is_swept(spark, folders, dead):
    dead("before")
    assert settle(str(folders / "out")) == (0, 1)
    assert [f for f in (folders / "out").rglob("*") if f.is_file()] == []


def test_a_commit_that_died_is_finished(spark, folders, dead):
    dead("in")
    assert (folders / "out/a").exists() and not (folders / "out/b/c").exists()
    assert settle(str(folders / "out")) == (1, 0)
    assert sorted(f.name for f in (folders / "out").rglob("*") if f.is_file()) == ["a", "c"]


def test_sink_refuses(spark, folders):
    register(spark)
    with pytest.raises(Exception, match="mode append"):
        contents(spark).write.format(FORMAT).mode("overwrite").save(str(folders / "out"))
    with pytest.raises(Exception, match="relpath and either"):
        contents(spark).drop("content").write.format(FORMAT).mode("append").save(str(folders / "out"))


class Store(pafs.FileSystemHandler):
    """An object store: what a stream holds becomes an object when the stream is closed, or merely let go of."""

    def __init__(self):
        self.objects = {}

    def open_output_stream(self, path, metadata):
        store = self

        class Upload:
            closed = False
            held = b""

            def write(self, data):
                self.held += bytes(data)

            def flush(self):
                pass

            def close(self):
                if not self.closed:
                    self.closed, store.objects[path] = True, self.held

            def __del__(self):
                self.close()

        return pa.PythonFile(Upload(), mode="w")

    def get_file_info(self, paths):
        kind = lambda p: pafs.FileType.File if p in self.objects else pafs.FileType.NotFound
        return [pafs.FileInfo(p, kind(p)) for p in paths]

    def move(self, source, target):
        self.objects[target] = self.objects.pop(source)

    def delete_file(self, path):
        del self.objects[path]

    def get_type_name(self):
        return "store"

    def open_input_stream(self, path):
        return pa.BufferReader(self.objects[path])

    def create_dir(self, path, recursive):
        pass

    def __eq__(self, other):
        return self is other

    def _none(self, *args):
        raise NotImplementedError

    copy_file = delete_dir = delete_dir_contents = delete_root_dir_contents = get_file_info_selector = normalize_path = _none
    open_append_stream = open_input_file = _none


def test_a_store_that_publishes_on_release_shows_no_part_of_a_file(monkeypatch):
    store = Store()
    store.normalize_path = lambda path: path
    monkeypatch.setitem(fs._OPENED, ("mem", "bucket"), pafs.PyFileSystem(store))
    store.objects["bucket/a"] = b"old"
    broken = Staged("mem://bucket/a")
    broken.write(b"half")
    broken.discard()
    del broken
    assert store.objects == {"bucket/a": b"old"}
    lost = Staged("mem://bucket/a")
    lost.write(b"half")
    # The task is gone, and its client closes what it had open.
    lost.stream.close()
    assert store.objects.pop("bucket/a") == b"old" and all(fs.UNFINISHED_NAME.search(os.path.basename(name)) for name in store.objects)
    store.objects.clear()
    whole = Staged("mem://bucket/a")
    whole.write(b"whole")
    whole.publish()
    assert store.objects == {"bucket/a": b"whole"}
