"""Copy large files by ranges of bytes, so that one file keeps many tasks busy.

Every range is a row: a task reads it from the source, writes it at its place in the staged file, and reads it back. Checksums of
ranges combine by algebra: a CRC is linear, so that of a file is the exclusive or of its ranges' own, each multiplied by
the power of x that stands for the bytes behind it. The power is taken in the task, and Spark's ``bit_xor`` does the rest, in any
order and before any shuffle. A file gets its name when all its ranges are there and both sides' checksums agree.

The target has to be a local or mounted folder, where a file can be written from several places at once; an object store's
client cannot. Attempts of one range write the same bytes at the same place. A source that changes meanwhile fails.
"""

from __future__ import annotations

import os
import time
import zlib
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.fixed import BUFFER_BYTES
from tidemark.schemas import OUTCOME, PLAN, RANGE, TRANSFERRED
from tidemark.session import materialize
from tidemark.sources.fs import UNFINISHED, is_local, make_parent, move, open_fs, strip_file_scheme
from tidemark.spread import STREAMS_PER_TASK, flat_schema, flatten_times, restore_times, task_count

RANGE_BYTES = 64 * 1024 * 1024
CRC_MARK = "crc32:"
# Fixed value: the polynomial of CRC-32, lowest power first.
_POLYNOMIAL = 0xEDB88320
_ONE = 1 << 31


def _times(a: int, b: int) -> int:
    """The product of two polynomials modulo that of the checksum; the highest bit is the power 0."""
    out = 0
    while a:
        if a & _ONE:
            out ^= b
        a = (a << 1) & 0xFFFFFFFF
        b = (b >> 1) ^ (_POLYNOMIAL if b & 1 else 0)
    return out


def followed_by(crc: int, n: int) -> int:
    """What a checksum adds to that of a whole when ``n`` bytes follow."""
    return _times(_power(n), crc) if n else crc


@lru_cache(maxsize=64)
def _square(k: int) -> int:
    """The power of x that stands for 2^k bytes."""
    return _times(_square(k - 1), _square(k - 1)) if k else _ONE >> 8


@lru_cache(maxsize=1_024)
def _power(n: int) -> int:
    """The power of x that stands for n bytes."""
    power = _ONE
    for k in range(n.bit_length()):
        if n >> k & 1:
            power = _times(power, _square(k))
    return power


def ranges_of(plan: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """A row for each range: ``start`` and ``length``. An empty file is one empty range."""
    last = F.greatest(F.call_function("div", F.col("size") - 1, F.lit(range_bytes)), F.lit(0))
    start = F.explode(F.transform(F.sequence(F.lit(0).cast("bigint"), last), lambda i: i * range_bytes)).alias("start")
    return plan.select("*", start).withColumn("length", F.greatest(F.lit(0), F.least(F.lit(range_bytes), F.col("size") - F.col("start"))))


def copy_by_ranges(plan: DataFrame, attempt: int = 1, range_bytes: int = RANGE_BYTES, buffer_bytes: int = BUFFER_BYTES,
                   tasks: int | None = None, streams: int = STREAMS_PER_TASK) -> DataFrame:
    """Copy the files of a plan once and tell what became of each, in the columns of a transfer.

    ``md5_source`` and ``md5_target`` hold the combined checksums, marked as such.
    """
    number = time.time_ns()
    split = ranges_of(plan.select(*PLAN.fieldNames()), range_bytes)
    if tasks is None:
        # By bytes and by number, as files: many short ranges are no more work than as many small files.
        tasks = task_count(split.select(F.col("length").alias("size")))
    schema = StructType(PLAN.fields + RANGE.fields)
    # One round of writing: what a range did is a table, and publishing reads that.
    done = materialize(
        restore_times(flatten_times(split.repartition(tasks)).mapInPandas(_writer(number, buffer_bytes, streams), flat_schema(schema)), schema), "ranges"
    )
    files = done.groupBy(*PLAN.fieldNames()).agg(
        F.bit_xor("crc_source").alias("crc_source"), F.bit_xor("crc_target").alias("crc_target"), F.sum("length").alias("copied"),
        F.max("error").alias("error"), F.max("gone").alias("gone"), F.min("start_ms").alias("start_ms"),
    )
    held = StructType(PLAN.fields + [f for f in files.schema.fields if f.name not in PLAN.fieldNames()])
    published = flatten_times(files.select(*held.fieldNames())).mapInPandas(_publisher(number, attempt), flat_schema(TRANSFERRED))
    return restore_times(published, TRANSFERRED)


def _staged(target: str, number: int) -> str:
    """The same name for all ranges of a file in one round, and for none of another."""
    folder, name = os.path.split(strip_file_scheme(target))
    return f"{folder}/.{name}.{number}{UNFINISHED}"


def _now_ms() -> int:
    return time.time_ns() // 1_000_000


def _writer(number: int, buffer_bytes: int, streams: int):
    def unchanged(files, raw: str, size: int, mtime_s: int) -> None:
        info = files.get_file_info(raw)
        if info.size is not None and (info.size != size or (info.mtime_ns or 0) // 1_000_000_000 != mtime_s):
            raise ValueError("the source changed since it was listed")

    def copy(path: str, target: str, size: int, mtime_s: int, start: int, length: int) -> tuple[int, int]:
        if not is_local(target):
            raise ValueError("ranges need a local or mounted target")
        files, raw = open_fs(path)
        staged = _staged(target, number)
        make_parent(open_fs(staged)[0], staged)
        unchanged(files, raw, size, mtime_s)
        sent = stored = 0
        out = os.open(staged, os.O_RDWR | os.O_CREAT, 0o666)
        try:
            with files.open_input_file(raw) as stream:
                at = start
                while at < start + length:
                    data = stream.read_at(min(buffer_bytes, start + length - at), at)
                    if not data:
                        raise OSError("the source ends early")
                    sent = zlib.crc32(data, sent)
                    view = memoryview(data)
                    while view:
                        n = os.pwrite(out, view, at)
                        at, view = at + n, view[n:]
            at = start
            while at < start + length:
                data = os.pread(out, min(buffer_bytes, start + length - at), at)
                if not data:
                    raise OSError("the copy ends early")
                stored, at = zlib.crc32(data, stored), at + len(data)
        finally:
            os.close(out)
        unchanged(files, raw, size, mtime_s)
        behind = size - start - length
        return followed_by(sent, behind), followed_by(stored, behind)

    def one(row) -> tuple:
        begun = _now_ms()
        try:
            crcs = copy(row.path, row.target, int(row.size), int(row.mtime_s), int(row.start), int(row.length))
            return int(row.start), int(row.length), *crcs, None, False, begun
        except Exception as problem:
            gone = isinstance(problem, FileNotFoundError) and not os.path.exists(strip_file_scheme(row.path))
            return int(row.start), 0, 0, 0, f"{type(problem).__name__}: {problem}", gone, begun

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(streams) as pool:
            for batch in batches:
                done = pd.DataFrame(list(pool.map(one, batch.itertuples(index=False))), columns=RANGE.fieldNames(), index=batch.index)
                yield pd.concat([batch[PLAN.fieldNames()], done], axis=1)

    return write


def _publisher(number: int, attempt: int):
    def one(row) -> tuple:
        staged = _staged(row.target, number)
        files, raw = open_fs(staged)
        error = row.error if isinstance(row.error, str) else None
        try:
            if error is None and (row.copied != row.size or row.crc_source != row.crc_target):
                error = f"OSError: the copy differs: {row.copied} of {row.size} bytes"
            if error is None:
                # An earlier attempt of this task may have published it.
                if os.path.exists(raw):
                    move(files, raw, strip_file_scheme(row.target))
                crcs = [f"{CRC_MARK}{int(c):08x}" for c in (row.crc_source, row.crc_target)]
                return "copied", attempt, int(row.copied), *crcs, int(row.start_ms), _now_ms(), None
        except OSError as problem:
            error = f"{type(problem).__name__}: {problem}"
        if os.path.exists(raw):
            files.delete_file(raw)
        return "missing" if row.gone else "failed", attempt, None, None, None, int(row.start_ms), _now_ms(), error

    def publish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            done = pd.DataFrame([one(row) for row in batch.itertuples(index=False)], columns=OUTCOME.fieldNames(), index=batch.index)
            done["bytes"] = done["bytes"].astype("Int64")
            yield pd.concat([batch[PLAN.fieldNames()], done], axis=1)

    return publish
