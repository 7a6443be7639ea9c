"""Listings of folders as DataFrames: one row per regular file, metadata only.

``walk_files`` lists level by level: each level is a table of folders, spread
over the executors, and writes its entries to the shared folder. Neither the
driver nor one task ever holds the whole listing, and names Spark's own file
scan skips (leading ``_`` or ``.``) are found.

``scan_files`` is the same walk between two times, either of which may be open.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from contextlib import suppress

import pandas as pd
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.functions.paths import relative_path
from tidemark.schemas import LISTING
from tidemark.session import literal_rows, new_folder, qualify
from tidemark.sources.fs import UNFINISHED_PATH, exists, is_local, open_fs, require_folder, strip_file_scheme

_FOLDER = StructType([field for field in LISTING if field.name in ("root", "path")])
_ROWS_PER_BATCH = 10_000
# A task costs as much by itself as some thousand small folders.
_FOLDERS_PER_TASK = 4_000


def _as_roots(spark: SparkSession, roots: str | list[str]) -> list[str]:
    roots = [roots] if isinstance(roots, str) else list(roots)
    return [strip_file_scheme(qualify(spark, root)).rstrip("/") or "/" for root in roots]


def entries(root: str, folder: str, has: Callable[[str], bool] | None = None) -> Iterator[tuple[str, int, int, bool]]:
    """(path, size, mtime_us, is_dir) of the regular files and folders in one folder, or of those whose name it ``has``.

    Links are neither: following them could leave the tree or never end. A folder may go away between its level and
    the next, but a task that does not see the root at all has no say in that, and fails.
    """
    prefix = folder.rstrip("/") + "/"
    if is_local(folder):
        try:
            found = os.scandir(folder)
        except FileNotFoundError:
            require_folder(root)
            return
        with found:
            for entry in found:
                if has and not has(entry.name):
                    continue
                is_dir = entry.is_dir(follow_symlinks=False)
                if is_dir or entry.is_file(follow_symlinks=False):
                    with suppress(FileNotFoundError):
                        stat = entry.stat(follow_symlinks=False)
                        yield prefix + _text(entry.name, is_dir), stat.st_size, stat.st_mtime_ns // 1000, is_dir
        return
    files, path = open_fs(folder)
    found = files.get_file_info(pafs.FileSelector(path, allow_not_found=True))
    if not found:
        require_folder(root)
    for info in found:
        if info.type in (pafs.FileType.File, pafs.FileType.Directory) and (has is None or has(info.base_name)):
            is_dir = info.type == pafs.FileType.Directory
            yield prefix + info.base_name, info.size or 0, (info.mtime_ns or 0) // 1000, is_dir


def _text(name: str, is_dir: bool) -> str:
    """A name that is not UTF-8 cannot be the text of a row.

    Such a file is listed under a readable name, which a transfer reports as
    missing. Such a folder would hide its files, so it fails.
    """
    if name.isascii():
        return name
    readable = name.encode("utf-8", "replace").decode()
    if is_dir and readable != name:
        raise ValueError(f"folder name is not UTF-8: {name!r}")
    return readable


def _lister(window: tuple[int, int] | None):
    def wanted(mtime_us: int, is_dir: bool) -> bool:
        return is_dir or window is None or window[0] < mtime_us // 1_000_000 <= window[1]

    def list_folders(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = []
        for batch in batches:
            for root, folder in zip(batch["root"], batch["path"]):
                for path, size, mtime_us, is_dir in entries(root, folder):
                    if wanted(mtime_us, is_dir):
                        rows.append((root, path, size, mtime_us, is_dir))
                    if len(rows) >= _ROWS_PER_BATCH:
                        yield pd.DataFrame(rows, columns=LISTING.fieldNames())
                        rows = []
        if rows:
            yield pd.DataFrame(rows, columns=LISTING.fieldNames())

    return list_folders


def walk_files(spark: SparkSession, roots: str | list[str], recursive: bool = True, subtree: str = "",
               window: tuple[int, int] | None = None) -> DataFrame:
    """Files below the roots, or below one folder of each.

    A missing root raises; an empty one, or one without that folder, gives no
    rows. With a window (from, to] in seconds the tasks keep its files only, so
    a run over a folder full of old files writes little.
    """
    roots = _as_roots(spark, roots)
    for root in roots:
        require_folder(root)
    starts = [(root, f"{root.rstrip('/')}/{subtree.strip('/')}".rstrip("/") or "/") for root in roots]
    starts = [(root, start) for root, start in starts if exists(start)]
    out = new_folder(spark, "listing")
    level = literal_rows(spark, starts, _FOLDER)
    n_folders, depth = max(1, len(starts)), 0
    while n_folders:
        tasks = max(1, min(n_folders, max(spark.sparkContext.defaultParallelism, n_folders // _FOLDERS_PER_TASK)))
        found_at, seen = f"{out}/depth={depth}", Observation()
        found = level.repartition(tasks).mapInPandas(_lister(window), LISTING)
        # Counted on the way; a task that ran twice only makes the next level's tasks smaller.
        found.observe(seen, F.count_if("is_dir").alias("folders")).write.parquet(found_at)
        if not recursive:
            break
        level = spark.read.schema(LISTING).parquet(found_at).where("is_dir").select("root", "path")
        n_folders, depth = seen.get["folders"], depth + 1
    entries = spark.read.schema(LISTING).option("recursiveFileLookup", "true").parquet(out)
    return _as_files(entries.where(~F.col("is_dir")))


def scan_files(spark: SparkSession, roots: str | list[str], modified_after_s: int | None = None,
               modified_before_s: int | None = None) -> DataFrame:
    """Files between two times, left-exclusive and right-inclusive as in the delta window; empty and hidden ones too.

    Spark's own file source would be shorter, but it passes over both kinds.
    """
    after = modified_after_s if modified_after_s is not None else -(1 << 62)
    before = modified_before_s if modified_before_s is not None else 1 << 62
    return walk_files(spark, roots, window=(after, before))


def place_kinds(places: DataFrame, on: str = "path") -> DataFrame:
    """Add ``kind`` to rows that name places: ``file``, ``folder``, ``other`` or ``missing``, looked up in tasks.

    An object store knows no empty folders: one is missing there.
    """
    kinds = {pafs.FileType.File: "file", pafs.FileType.Directory: "folder", pafs.FileType.NotFound: "missing"}

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for uri in batch[on]:
                files, path = open_fs(uri)
                found.append(kinds.get(files.get_file_info(path).type, "other"))
            yield batch.assign(kind=pd.Series(found, index=batch.index, dtype=object))

    schema = StructType([*places.schema.fields, StructField("kind", StringType())])
    return places.mapInPandas(look, schema)


def _as_files(entries: DataFrame) -> DataFrame:
    mtime = F.timestamp_micros("mtime_us")
    return entries.where(~F.col("path").rlike(UNFINISHED_PATH)).select(
        "root",
        "path",
        relative_path("path", F.col("root")).alias("relpath"),
        "size",
        F.unix_seconds(mtime).alias("mtime_s"),
        mtime.alias("mtime"),
    )
