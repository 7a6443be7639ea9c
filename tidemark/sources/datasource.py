"""Folders as a Spark data source: ``spark.read``, ``spark.readStream`` and ``df.write`` with ``format("tidemark")``.

**Reading** lists regular files, empty and hidden ones too, metadata only. Conditions on ``relpath``, ``name``, ``size`` and
``mtime_s`` reach the lister: a prefix decides which folders are opened at all, the others which entries become rows. The
planner splits the tree into folders without holding more than ``splits`` names: a folder with more sub-folders than that is cut
by a hash of the names instead, and each task lists it and keeps its share. Tasks stream what they find.

**Streaming** has windows of time as offsets. By default every batch lists the whole tree, up to the end of its window, for
``streaming.files`` to find what is new by keyed state. ``lookback`` (seconds) lists only files that are not older than that at
the beginning of the window; with 0, windows tile as those of batch runs do. Nothing is kept per path on the driver.

**Writing** takes rows of (relpath, content) or (relpath, path), the latter copied from where they lie, and puts files below
the folder. Tasks stage them in a folder of the job, under names that no listing shows; the driver's commit publishes them; an abort deletes the folder. What
was staged is in one table a task, so the driver gets a name and two numbers from each. A commit that died is finished, and a job
that died before it is swept, by ``settle``. A folder whose files are many is better served by ``operators.transfer``, which
publishes in tasks.

Options: ``path``; reading: ``recursive`` (true), ``splits`` (256), ``prefix`` (of relpath); streaming: ``lookback``, ``lag`` (seconds that a window ends
before now), ``from`` (exclusive, of the first window); writing: ``outcome``, a folder for the tables of what was written.
"""

from __future__ import annotations

import os
import time
import uuid
import zlib
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
    StringContains,
    StringEndsWith,
    StringStartsWith,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from tidemark.fixed import BUFFER_BYTES
from tidemark.sources.fs import UNFINISHED, UNFINISHED_NAME, exists, is_local, make_parent, move, open_fs, require_folder, strip_file_scheme, unfinished
from tidemark.sources.listing import entries
from tidemark.sources.staging import Staged

FORMAT = "tidemark"
SCHEMA = "root string, path string, relpath string, name string, size bigint, mtime_s bigint, mtime timestamp, listed_ms bigint"
_KINDS = [pa.string()] * 4 + [pa.int64()] * 2 + [pa.timestamp("us", "UTC"), pa.int64()]
_ROWS_PER_BATCH = 10_000
_BEGINNING = -(1 << 62)
_JOB = ".tidemark-job-"
_PUBLISHERS = 16
# Tasks that share one wide folder.
_SHARES = 32


def register(spark: SparkSession) -> SparkSession:
    """Make the format known to a session, and let Spark hand conditions to sources written in Python."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(FilesSource)
    return spark


class FilesSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def _root(self) -> str:
        if not self.options.get("path"):
            raise ValueError(f"{FORMAT}: the option path is required")
        return strip_file_scheme(self.options["path"]).rstrip("/") or "/"

    def _listing(self) -> Listing:
        recursive = self.options.get("recursive", "true").lower() == "true"
        listing = Listing(self._root(), recursive, int(self.options.get("splits", "256")))
        if self.options.get("prefix"):
            listing.take(StringStartsWith(("relpath",), self.options["prefix"]))
        return listing

    def reader(self, schema: StructType) -> FilesReader:
        return FilesReader(self._listing())

    def streamReader(self, schema: StructType) -> FilesStream:
        lookback = self.options.get("lookback")
        return FilesStream(
            self._listing(), None if lookback is None else int(lookback), int(self.options.get("lag", "0")),
            int(self.options.get("from", str(_BEGINNING))),
        )

    def writer(self, schema: StructType, overwrite: bool) -> FilesWriter:
        if overwrite:
            raise ValueError(f"{FORMAT}: files are replaced one by one; use mode append")
        names = schema.fieldNames()
        if "relpath" not in names or ("content" in names) == ("path" in names):
            raise ValueError(f"{FORMAT}: rows have relpath and either content or path; have {names}")
        return FilesWriter(self._root(), self.options.get("outcome"))


# --- conditions ------------------------------------------------------------------


@dataclass
class Listing:
    """What to list: where, and which files."""

    root: str
    recursive: bool
    splits: int
    prefix: str = ""
    tests: list[tuple[str, str, object]] = field(default_factory=list)

    def take(self, condition: Filter) -> bool:
        """Whether the lister can judge a condition; if so it will."""
        column = condition.attribute[0] if len(getattr(condition, "attribute", ())) == 1 else None
        value = getattr(condition, "value", None)
        test = _TESTS.get(type(condition))
        if column not in ("relpath", "name", "size", "mtime_s") or test is None or value is None:
            return False
        if column in ("size", "mtime_s") and test in ("starts", "ends", "holds"):
            return False
        if column == "relpath" and test in ("is", "starts") and str(value).startswith(self.prefix):
            # The longest is the narrowest; others are judged row by row.
            self.prefix = str(value)
        self.tests.append((column, test, value))
        return True

    def wants(self, relpath: str, name: str, size: int, mtime_s: int) -> bool:
        row = {"relpath": relpath, "name": name, "size": size, "mtime_s": mtime_s}
        return all(_JUDGE[test](row[column], value) for column, test, value in self.tests)

    def below(self, path: str) -> str:
        return path[len(self.root.rstrip("/")) + 1 :]

    def opens(self, folder: str) -> bool:
        """Whether a folder can hold files with the prefix."""
        at = f"{self.below(folder)}/"
        return at.startswith(self.prefix) or self.prefix.startswith(at)


_TESTS = {
    EqualTo: "is", In: "in", GreaterThan: "above", GreaterThanOrEqual: "from", LessThan: "below", LessThanOrEqual: "to",
    StringStartsWith: "starts", StringEndsWith: "ends", StringContains: "holds",
}
_JUDGE = {
    "is": lambda x, v: x == v, "in": lambda x, v: x in v, "above": lambda x, v: x > v, "from": lambda x, v: x >= v,
    "below": lambda x, v: x < v, "to": lambda x, v: x <= v, "starts": lambda x, v: x.startswith(v),
    "ends": lambda x, v: x.endswith(v), "holds": lambda x, v: v in x,
}


# --- batches -----------------------------------------------------------------------


@dataclass
class Split(InputPartition):
    """A folder's own files (not ``deep``), or all below it; of these a share by names, ``part`` of ``parts``."""

    folder: str
    deep: bool
    part: int = 0
    parts: int = 1

    def has(self, name: str) -> bool:
        return zlib.crc32(name.encode("utf-8", "surrogateescape")) % self.parts == self.part


def _shares(folder: str, deep: bool, wanted: int) -> list[Split]:
    """One folder for several tasks: each reads all its names, and looks at its own share only. A store's client looks at all."""
    parts = min(wanted, _SHARES) if is_local(folder) else 1
    return [Split(folder, deep, part, parts) for part in range(parts)]


def splits(listing: Listing) -> list[Split]:
    """Cut the tree into parts for tasks, level by level, with at most about ``listing.splits`` names at once."""
    require_folder(listing.root)
    if not listing.recursive:
        return _shares(listing.root, False, listing.splits)
    done, level = [], [listing.root]
    while level:
        below = []
        for at, folder in enumerate(level):
            found = []
            for path, _, _, is_dir in entries(listing.root, folder):
                if is_dir and listing.opens(path):
                    found.append(path)
                if len(found) > listing.splits:
                    break
            if len(found) > listing.splits:
                done += _shares(folder, True, listing.splits)
                continue
            done.append(Split(folder, False))
            below += found
            if len(done) + len(below) > listing.splits:
                return done + [Split(f, True) for f in (*below, *level[at + 1 :])]
        level = below
    return done


def _rows(listing: Listing, split: Split) -> Iterator[tuple]:
    waiting, top = [split.folder], True
    while waiting:
        folder = waiting.pop()
        for path, size, mtime_us, is_dir in entries(listing.root, folder, split.has if top and split.parts > 1 else None):
            if is_dir:
                if split.deep and listing.opens(path):
                    waiting.append(path)
                continue
            relpath, name, mtime_s = listing.below(path), path.rsplit("/", 1)[1], mtime_us // 1_000_000
            if listing.wants(relpath, name, size, mtime_s) and not UNFINISHED_NAME.search(name):
                yield listing.root, path, relpath, name, size, mtime_s, mtime_us, time.time_ns() // 1_000_000
        top = False


def _batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    held = []
    for row in rows:
        held.append(row)
        if len(held) == _ROWS_PER_BATCH:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), _KINDS)], names=names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), _KINDS)], names=names)


class FilesReader(DataSourceReader):
    def __init__(self, listing: Listing):
        self.listing = listing

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for condition in filters:
            if not self.listing.take(condition):
                yield condition

    def partitions(self) -> Sequence[InputPartition]:
        return splits(self.listing)

    def read(self, partition: Split) -> Iterator[pa.RecordBatch]:
        return _batches(_rows(self.listing, partition))


# --- streams -----------------------------------------------------------------------


@dataclass
class Window(InputPartition):
    split: Split
    from_s: int
    to_s: int


class FilesStream(DataSourceStreamReader):
    """Offsets are ends of windows, in epoch seconds."""

    def __init__(self, listing: Listing, lookback: int | None, lag: int, from_s: int):
        self.listing, self.lookback, self.lag, self.from_s = listing, lookback, lag, from_s

    def initialOffset(self) -> dict:
        return {"to_s": self.from_s, "tick": 0}

    def latestOffset(self) -> dict:
        # The tick lets a batch look again within the same second.
        return {"to_s": max(self.from_s, int(time.time()) - self.lag), "tick": time.time_ns() // 1_000_000}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        if start == end:
            return []
        from_s = _BEGINNING if self.lookback is None else max(_BEGINNING, start["to_s"] - self.lookback)
        return [Window(split, max(from_s, self.from_s), end["to_s"]) for split in splits(self.listing)]

    def read(self, partition: Window) -> Iterator[pa.RecordBatch]:
        within = lambda row: partition.from_s < row[5] <= partition.to_s
        return _batches(filter(within, _rows(self.listing, partition.split)))


# --- writing -----------------------------------------------------------------------

OUTCOME = pa.schema([("relpath", pa.string()), ("staged", pa.string()), ("target", pa.string()), ("bytes", pa.int64()), ("md5", pa.string())])


@dataclass
class StagedFiles(WriterCommitMessage):
    manifest: str | None
    files: int
    bytes: int


class FilesWriter(DataSourceArrowWriter):
    def __init__(self, root: str, outcome: str | None):
        require_folder(root)
        self.root, self.outcome = root, outcome
        self.job = f"{root.rstrip('/')}/{_JOB}{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> StagedFiles:
        context = TaskContext.get()
        attempt = context.taskAttemptId()
        manifest = f"{self.job}/{_hidden('part', attempt)}"
        where, path = open_fs(manifest)
        table, files, size = None, 0, 0
        for batch in iterator:
            rows = []
            for at in range(len(batch)):
                row = {name: batch.column(name)[at].as_py() for name in ("relpath", "content", "path", "mtime_s") if name in batch.schema.names}
                # What a job stages lies in the job's own folder, so it goes with that whatever became of its tasks.
                staged = _stage(f"{self.root.rstrip('/')}/{row['relpath']}", row, f"{self.job}/{_hidden(str(attempt), files + at)}")
                rows.append((row["relpath"], staged.written_as, staged.path, staged.bytes, staged.md5.hexdigest()))
                size += staged.bytes
            if rows:
                if table is None:
                    make_parent(where, path)
                    table = pq.ParquetWriter(path, OUTCOME, filesystem=where)
                table.write_batch(pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), OUTCOME)], schema=OUTCOME))
                files += len(rows)
        if table is not None:
            table.close()
        return StagedFiles(manifest if files else None, files, size)

    def commit(self, messages: list[StagedFiles | None]) -> None:
        manifests = [m.manifest for m in messages if m is not None and m.manifest]
        if not manifests:
            return
        # From here on the job is done, whoever finishes it.
        where, path = open_fs(f"{self.job}/{_hidden('commit', 0)}")
        part = unfinished(path)
        with where.open_output_stream(part, compression=None) as stream:
            stream.write("\n".join(manifests).encode())
        move(where, part, path)
        _publish(self.root, self.job, manifests, self.outcome)

    def abort(self, messages: list[StagedFiles | None]) -> None:
        _drop(self.job)


def _hidden(name: str, number: int) -> str:
    """A name that no listing shows."""
    return f".{name}.{number}{UNFINISHED}"


def _stage(uri: str, row: dict, written_as: str) -> Staged:
    files, path = open_fs(written_as)
    make_parent(files, path)
    staged = Staged(uri, written_as=written_as)
    try:
        if "content" in row:
            staged.write(row["content"] or b"")
        else:
            source, raw = open_fs(row["path"])
            with source.open_input_stream(raw, compression=None) as stream:
                while data := stream.read(BUFFER_BYTES):
                    staged.write(data)
        staged.close()
        if row.get("mtime_s") is not None and staged.files.type_name == "local":
            os.utime(staged.written_as, (row["mtime_s"], row["mtime_s"]))
    except BaseException:
        staged.discard()
        raise
    return staged


def _read(manifest: str) -> Iterator[dict]:
    where, path = open_fs(manifest)
    with where.open_input_file(path) as file:
        for batch in pq.ParquetFile(file).iter_batches():
            yield from batch.to_pylist()


def _publish(root: str, job: str, manifests: list[str], outcome: str | None) -> None:
    """Give every staged file its name. Files that have it already, from an earlier try, are passed over."""
    where, _ = open_fs(root)

    def publish(row: dict) -> None:
        if where.get_file_info(row["staged"]).type == pafs.FileType.File:
            move(where, row["staged"], row["target"])
        elif where.get_file_info(row["target"]).type != pafs.FileType.File:
            raise FileNotFoundError(f"neither staged nor published: {row['target']}")

    with ThreadPoolExecutor(_PUBLISHERS) as pool:
        for manifest in manifests:
            if exists(manifest):
                for _ in pool.map(publish, _read(manifest)):
                    pass
                if outcome:
                    kept = f"{outcome.rstrip('/')}/{os.path.basename(job)[1:]}-{os.path.basename(manifest)[1:].removesuffix(UNFINISHED)}.parquet"
                    there, path = open_fs(kept)
                    make_parent(there, path)
                    pafs.copy_files(open_fs(manifest)[1], path, source_filesystem=where, destination_filesystem=there)
    _drop(job)


def _drop(job: str) -> None:
    where, path = open_fs(job)
    if where.get_file_info(path).type == pafs.FileType.Directory:
        where.delete_dir(path)


def settle(root: str, outcome: str | None = None) -> tuple[int, int]:
    """Finish the commits that died below a folder, and sweep the jobs that died before theirs: (finished, swept).

    Only for a folder that no job is writing to now.
    """
    where, path = open_fs(root)
    finished = swept = 0
    for info in where.get_file_info(pafs.FileSelector(path)):
        if info.type != pafs.FileType.Directory or not info.base_name.startswith(_JOB):
            continue
        job = f"{root.rstrip('/')}/{info.base_name}"
        commit = f"{job}/{_hidden('commit', 0)}"
        if exists(commit):
            there, raw = open_fs(commit)
            with there.open_input_stream(raw, compression=None) as stream:
                manifests = stream.read().decode().split("\n")
            _publish(root, job, manifests, outcome)
            finished += 1
        else:
            _drop(job)
            swept += 1
    return finished, swept
