"""One very large level of names, listed by ranges of names that split where they are full.

An object store keeps the names below a prefix in order and gives them page by page, from a name on and up to another. Each range
is a row; a task lists what its ranges hold, up to a limit for all of them. What is left of a full range is cut into several, which are the
next round's rows. So a task holds a page, and lists a bounded number of names, however many the level has; and all executors
list it together once it has been cut. Where the cuts lie decides how even the ranges are, not what is found.

A folder has no such order. Its names are read and sorted by Spark first, once for all pages: tasks share them out by a hash, and
write them in ranges. A page is then read from the one or two files that hold it, and its sizes and times from the folder itself.
"""

from __future__ import annotations

import heapq
import os
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from contextlib import suppress
from dataclasses import dataclass
from functools import lru_cache
from itertools import accumulate

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidemark.session import literal_rows, materialize, new_folder
from tidemark.sources.fs import is_local, open_fs, strip_file_scheme

# (name, size, mtime in microseconds) of files whose name is above the first and not above the second, if there is one: in
# ascending order, as many as the number at most.
Pager = Callable[[str, str | None, int], list[tuple[str, int, int]]]

PAGE, LIMIT, PARTS = 1_000, 100_000, 16
# Names of a folder that lie in one file of its sorted table, about, and tasks that read a folder together.
_HELD, _SHARES = 20_000, 32
# Most names are made of these; a cut may lie anywhere.
_LOW, _HIGH = 0x20, 0x7F
_RANGE = StructType([StructField("after", StringType()), StructField("until", StringType())])
_FOUND = StructType([StructField("name", StringType()), StructField("size", LongType()), StructField("mtime_us", LongType()), *_RANGE.fields])


def cuts(after: str, until: str | None, parts: int) -> list[str]:
    """Up to ``parts - 1`` names strictly between two, ascending, spread over the first character that can differ."""
    at = 0
    while until is not None and at < len(after) and at < len(until) and after[at] == until[at]:
        at += 1
    for place in range(at, len(after) + 1):
        low = ord(after[place]) if place < len(after) else _LOW - 1
        # Behind the first place where the two differ, nothing bounds a name from above.
        high = ord(until[at]) if until is not None and place == at and at < len(until) else max(_HIGH, low + 2)
        inner = [c for c in range(low + 1, high) if not 0xD800 <= c < 0xE000] if high - low < 5_000 else [low + 1, (low + high) // 2]
        if inner:
            step = max(1, len(inner) // parts)
            return [after[:place] + chr(c) for c in inner[step - 1 :: step][: parts - 1]]
    return []


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=_FOUND.fieldNames()).astype({"size": "Int64", "mtime_us": "Int64"})


def _lister(pager: Pager, page: int, limit: int, parts: int):
    # A pager that knows where names are cuts evenly.
    cut = getattr(pager, "cuts", None)

    def list_ranges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        listed = 0
        for batch in batches:
            for after, until in zip(batch["after"], batch["until"]):
                until = None if pd.isna(until) else until
                found, begun = True, False
                while found and listed < limit:
                    found, begun = pager(after, until, min(page, limit - listed)), True
                    if found:
                        yield _frame([(*row, None, None) for row in found])
                        listed, after = listed + len(found), found[-1][0]
                if found:
                    # Full, and cut; or not begun, as another range filled the task, and whole.
                    inner = [] if not begun else cut(after, until, parts, limit) if cut else cuts(after, until, parts)
                    bounds = [after, *inner, until]
                    yield _frame([(None, None, None, a, b) for a, b in zip(bounds, bounds[1:])])

    return list_ranges


def list_level(spark: SparkSession, pager: Pager, page: int = PAGE, limit: int = LIMIT, parts: int = PARTS) -> DataFrame:
    """(name, size, mtime_us) of all names that the pager knows. The driver sees the number of ranges, and never a name."""
    if isinstance(pager, FolderPager):
        pager = pager.in_order(spark)
    out, depth, n = new_folder(spark, "ranges"), 0, 1
    level = literal_rows(spark, [("", None)], _RANGE)
    while n:
        found_at, seen = f"{out}/round={depth}", Observation()
        found = level.repartition(n).mapInPandas(_lister(pager, page, limit, parts), _FOUND)
        found.observe(seen, F.count_if(F.col("after").isNotNull()).alias("ranges")).write.parquet(found_at)
        n, depth = seen.get["ranges"], depth + 1
        level = spark.read.schema(_FOUND).parquet(found_at).where("after is not null").select("after", "until")
    rows = spark.read.schema(_FOUND).option("recursiveFileLookup", "true").parquet(out)
    return rows.where("name is not null").select("name", "size", "mtime_us")


@dataclass(frozen=True)
class OrderedNames:
    """A pager of one folder by its names in order, which lie in files that hold about ``_HELD`` each."""

    folder: str
    files: tuple[str, ...]
    # The first name of each file, and how many names lie before it; the last number is that of all.
    firsts: tuple[str, ...]
    before: tuple[int, ...]

    def __call__(self, after: str, until: str | None, limit: int) -> list[tuple[str, int, int]]:
        found, at = [], self._rank(after)
        while len(found) < limit and at < self.before[-1]:
            name, at = self._name(at), at + 1
            if until is not None and name > until:
                break
            # A file that is gone by now makes no page end early.
            with suppress(FileNotFoundError):
                stat = os.stat(f"{self.folder}/{name}")
                found.append((name, stat.st_size, stat.st_mtime_ns // 1_000))
        return found

    def cuts(self, after: str, until: str | None, parts: int, limit: int) -> list[str]:
        """Up to ``parts - 1`` names between two, so that a range has less than the limit of a task, or as many as the others."""
        low = self._rank(after)
        high = self.before[-1] if until is None else self._rank(until)
        step = max(1, limit - 1, -(-(high - low) // parts))
        return [self._name(at - 1) for at in range(low + step, high, step)]

    def _rank(self, name: str) -> int:
        """How many names are not above this one."""
        of = bisect_right(self.firsts, name) - 1
        if of < 0:
            return 0
        names = _names(self.files[of])
        return self.before[of] + bisect_right(range(len(names)), name, key=lambda i: names[i].as_py())

    def _name(self, at: int) -> str:
        of = bisect_right(self.before, at) - 1
        return _names(self.files[of])[at - self.before[of]].as_py()


@lru_cache(maxsize=2)
def _names(uri: str) -> pa.ChunkedArray:
    """The names of one file. It is written once, under a name of its own."""
    files, path = open_fs(uri)
    return pq.read_table(path, columns=["name"], filesystem=files)["name"].combine_chunks()


@dataclass(frozen=True)
class FolderPager:
    """The files of one local or mounted folder. By itself it reads all names for every page; ``in_order`` reads them once."""

    folder: str

    def __call__(self, after: str, until: str | None, limit: int) -> list[tuple[str, int, int]]:
        with os.scandir(self.folder) as entries:
            names = heapq.nsmallest(limit, (e.name for e in entries if e.name > after and (until is None or e.name <= until) and e.is_file(follow_symlinks=False)))
        stats = [(name, os.stat(f"{self.folder}/{name}")) for name in names]
        return [(name, s.st_size, s.st_mtime_ns // 1_000) for name, s in stats]

    def in_order(self, spark: SparkSession) -> OrderedNames:
        """The same pages from a sorted table of the names. The driver sees one name of each of its files."""
        shares = min(_SHARES, spark.sparkContext.defaultParallelism)
        names = materialize(spark.range(0, shares, 1, shares).mapInPandas(_share(self.folder, shares), "name string"), "names")
        n = max(1, names.count() // _HELD)
        ordered = new_folder(spark, "ordered")
        names.repartitionByRange(n, "name").sortWithinPartitions("name").write.parquet(ordered)
        parts = spark.read.schema(names.schema).parquet(ordered).groupBy(F.input_file_name().alias("file"))
        found = sorted(parts.agg(F.min("name").alias("first"), F.count("*").alias("n")).collect(), key=lambda r: r["first"])
        files = tuple(f"{ordered}/{r['file'].rsplit('/', 1)[1]}" for r in found)
        return OrderedNames(self.folder, files, tuple(r["first"] for r in found), tuple(accumulate((r["n"] for r in found), initial=0)))


def _share(folder: str, shares: int):
    """Each task reads all names of the folder, and hands on its share of the files'."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for share in (share for batch in batches for share in batch["id"]):
            held = []
            with os.scandir(folder) as entries:
                for entry in entries:
                    if zlib.crc32(os.fsencode(entry.name)) % shares == share and entry.is_file(follow_symlinks=False):
                        held.append(entry.name)
                    if len(held) == _HELD:
                        yield pd.DataFrame({"name": held})
                        held = []
            if held:
                yield pd.DataFrame({"name": held})

    return read


def folder_pager(folder: str) -> Pager:
    """The files of one local or mounted folder."""
    if not is_local(folder):
        raise ValueError(f"a store's own client has to page through {folder}")
    return FolderPager(strip_file_scheme(folder))
