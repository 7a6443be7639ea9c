"""Copy the files of a plan on the executors, optionally sealing or opening them.

A row of the plan is one file. Tasks carry names, never whole contents: a copy
moves one buffer at a time per file, so a file's size does not matter to memory.
Every file is written under a name of its own attempt and published by a rename,
so a repeated task does no harm. A
failing file is a row with its error, not a failing job.
"""

from __future__ import annotations

import os
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.fixed import BUFFER_BYTES, DEFAULT_RETRIES, DEFAULT_WAIT_S, ENCRYPTED_SUFFIX
from tidemark.functions import crypto
from tidemark.functions import paths as P
from tidemark.operators.split import copy_by_ranges
from tidemark.schemas import MANIFEST, OUTCOME, PIECE, PLAN, TRANSFERRED, require_columns
from tidemark.session import materialize, small_batches
from tidemark.sources.content import digest
from tidemark.sources.fs import open_fs
from tidemark.sources.staging import Staged
from tidemark.spread import STREAMS_PER_TASK, flat_schema, flatten_times, map_files, restore_times, spread

PIECE_BYTES = 1024 * 1024
# Pieces handed on at once.
HELD_BYTES = 4 * PIECE_BYTES
ACTIONS = ("copy", "encrypt", "decrypt")


def plan_transfer(manifest: DataFrame, target_root: str, action: str = "copy",
                  suffix: str = ENCRYPTED_SUFFIX) -> DataFrame:
    """Where every file goes and how. This is also the preview: nothing is moved yet.

    ``encrypt`` seals every file and adds the suffix; ``decrypt`` opens the
    files that carry the suffix, strips it, and copies the others as they are.
    """
    require_columns(manifest, [*MANIFEST.fieldNames(), "path"], "plan_transfer")
    if action not in ACTIONS:
        raise ValueError(f"plan_transfer: action is one of {ACTIONS}, not {action!r}")
    below = F.col("relpath")
    step = F.lit(action)
    if action == "encrypt":
        below = P.add_suffix(below, suffix)
    elif action == "decrypt":
        step = F.when(P.is_encrypted(below, suffix), "decrypt").otherwise("copy")
        below = P.strip_suffix(below, suffix)
    target = F.concat(F.lit(target_root.rstrip("/") + "/"), below)
    columns = {
        "target": target,
        "content_type": P.content_type(F.lit(action == "encrypt")),
        "encrypted": P.is_encrypted(target, suffix),
        "action": step,
    }
    return manifest.select(*[columns.get(f.name, F.col(f.name)).alias(f.name) for f in PLAN])


def transfer(plan: DataFrame, retries: int = DEFAULT_RETRIES, wait_s: int = DEFAULT_WAIT_S, key: Column | None = None,
             parallelism: int | None = None, buffer_bytes: int = BUFFER_BYTES,
             streams: int = STREAMS_PER_TASK, split_bytes: int | None = None) -> DataFrame:
    """Run the plan once and return what happened to every file.

    The outcome is a written table: reading it again copies nothing again.
    ``retries`` more rounds follow with what failed, ``wait_s`` apart. Plain copies of more
    than ``split_bytes`` are made by ranges, several tasks at a time (``operators.split``).
    """
    require_columns(plan, PLAN.fieldNames(), "transfer")
    plan = plan.select(*PLAN.fieldNames())
    plain = F.col("action") == "copy"
    if key is None and not plan.where(~plain).isEmpty():
        raise ValueError("transfer: the plan encrypts or decrypts, which needs a key")
    large = F.lit(False) if split_bytes is None else F.col("size") > split_bytes
    copied = _in_rounds(plan.where(plain & ~large), retries, wait_s, "transferred", lambda rows, attempt: map_files(
        rows, _copier(attempt, buffer_bytes, streams), OUTCOME, parallelism if attempt == 1 else None
    ))
    if split_bytes is not None:
        copied = copied.unionByName(_in_rounds(plan.where(plain & large), retries, wait_s, "split", lambda rows, attempt: copy_by_ranges(
            rows, attempt, buffer_bytes=buffer_bytes, streams=streams
        )))
    if key is None:
        return copied
    with small_batches(plan.sparkSession):
        sealed = _in_rounds(plan.where(~plain), retries, wait_s, "sealed", lambda rows, attempt: _seal_once(rows, key, attempt, parallelism))
    return copied.unionByName(sealed)


def _in_rounds(plan: DataFrame, retries: int, wait_s: int, name: str, once: Callable[[DataFrame, int], DataFrame]) -> DataFrame:
    """Files that fail go again as a smaller plan: the driver waits between rounds, so no task holds a core meanwhile."""
    finished = []
    for attempt in range(1, retries + 2):
        done = materialize(once(plan, attempt), name)
        failed = done.where(F.col("status") == "failed")
        if attempt > retries or failed.isEmpty():
            finished.append(done)
            break
        finished.append(done.where(F.col("status") != "failed"))
        plan = failed.select(*PLAN.fieldNames())
        time.sleep(wait_s)
    return reduce(DataFrame.unionByName, finished)


def _now_ms() -> int:
    return time.time_ns() // 1_000_000


def _discard_quietly(target: Staged | None) -> None:
    try:
        if target is not None:
            target.discard()
    except OSError:
        pass


class _SourceGone(Exception):
    """The file to copy is not there any more; on the target's side nothing is ever gone, only not done."""


def _copy_once(path: str, uri: str, content_type: str, buffer_bytes: int) -> tuple[int, str, str]:
    """(bytes, digest of what was sent, digest of what is stored)."""
    source, raw = open_fs(path)
    target = None
    try:
        opened = source.open_input_stream(raw, compression=None)
    except FileNotFoundError as problem:
        raise _SourceGone(str(problem)) from problem
    try:
        with opened as stream:
            target = Staged(uri, content_type)
            while data := stream.read(buffer_bytes):
                target.write(data)
        target.publish()
    except Exception:
        _discard_quietly(target)
        raise
    return target.bytes, target.md5.hexdigest(), digest(uri, buffer_bytes)


def _copier(attempt: int, buffer_bytes: int, streams: int):
    def copy_file(path: str, uri: str, content_type: str) -> tuple:
        start = _now_ms()
        try:
            size, sent_md5, stored_md5 = _copy_once(path, uri, content_type, buffer_bytes)
            return "copied", attempt, size, sent_md5, stored_md5, start, _now_ms(), None
        except _SourceGone as problem:
            status, error = "missing", str(problem)
        except Exception as problem:
            status, error = "failed", f"{type(problem).__name__}: {problem}"
        return status, attempt, None, None, None, start, _now_ms(), error

    def copy_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(streams) as pool:
            for batch in batches:
                done = list(pool.map(copy_file, batch["path"], batch["target"], batch["content_type"]))
                yield _with_outcome(batch, done)

    return copy_batches


def _with_outcome(batch: pd.DataFrame, done: list[tuple]) -> pd.DataFrame:
    outcome = pd.DataFrame(done, columns=OUTCOME.fieldNames(), index=batch.index)
    # A failed file has no size; keep the column whole numbers.
    outcome["bytes"] = outcome["bytes"].astype("Int64")
    return pd.concat([batch, outcome], axis=1)


# --- sealed files -----------------------------------------------------------
#
# A sealed file is a header, which is the format's mark and a random id of the
# file, and a row of pieces, each a four-byte length and the piece's own AES-GCM
# text. The format and the id, the piece's number and whether it is the last are
# authenticated with it, so pieces cannot be dropped, repeated, swapped or taken
# from another file. Reading, sealing and writing are one narrow stage: pieces
# stay in order and never shuffle.
SEALED_MARK = b"TMS2"
SEALED_ID_BYTES = 16


def _seal_once(plan: DataFrame, key: Column, attempt: int, tasks: int | None) -> DataFrame:
    pieces = flatten_times(spread(plan, tasks)).mapInPandas(
        _read_pieces, flat_schema(StructType(PLAN.fields + PIECE.fields))
    )
    mark = F.lit(SEALED_MARK.decode())
    place = F.concat_ws(":", mark, "file_id", "seq", F.when(F.col("last"), "last").otherwise("more"))
    turned = F.when(F.col("action") == "encrypt", crypto.encrypt("piece", key, place)).otherwise(
        crypto.decrypt("piece", key, place)
    )
    written = pieces.withColumn("piece", turned).mapInPandas(_piece_writer(attempt), flat_schema(TRANSFERRED))
    return restore_times(written, TRANSFERRED)


def _raw_pieces(stream) -> Iterator[bytes]:
    while piece := stream.read(PIECE_BYTES):
        yield piece


def _sealed_pieces(stream) -> Iterator[bytes]:
    while head := stream.read(4):
        size = int.from_bytes(head, "big")
        if len(head) < 4 or size > PIECE_BYTES + crypto.GCM_OVERHEAD:
            raise ValueError("not a sealed file")
        piece = stream.read(size)
        if len(piece) < size:
            raise ValueError("sealed file ends early")
        yield piece


def _file_id(stream) -> str:
    header = stream.read(len(SEALED_MARK) + SEALED_ID_BYTES)
    if len(header) < len(SEALED_MARK) + SEALED_ID_BYTES or not header.startswith(SEALED_MARK):
        raise ValueError("not a sealed file")
    return header[len(SEALED_MARK) :].hex()


def _numbered(path: str, action: str) -> Iterator[tuple[str, int, bool, bytes]]:
    """Pieces with the id of their file, their number and whether they are the last; an empty file is one empty piece."""
    files, raw = open_fs(path)
    try:
        opened = files.open_input_stream(raw, compression=None)
    except FileNotFoundError as problem:
        raise _SourceGone(str(problem)) from problem
    with opened as stream:
        sealing = action == "encrypt"
        file_id = os.urandom(SEALED_ID_BYTES).hex() if sealing else _file_id(stream)
        pieces = _raw_pieces(stream) if sealing else _sealed_pieces(stream)
        seq, held = 0, next(pieces, b"")
        for piece in pieces:
            yield file_id, seq, False, held
            seq, held = seq + 1, piece
        yield file_id, seq, True, held


def _read_pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = PLAN.fieldNames() + PIECE.fieldNames()
    rows, held_bytes = [], 0
    for batch in batches:
        for row in batch.itertuples(index=False):
            start = _now_ms()
            try:
                for file_id, seq, last, piece in _numbered(row.path, row.action):
                    rows.append((*row, file_id, seq, last, piece, None, start))
                    held_bytes += len(piece)
                    if held_bytes >= HELD_BYTES or len(rows) >= 1_000:
                        yield pd.DataFrame(rows, columns=columns)
                        rows, held_bytes = [], 0
            except Exception as problem:
                rows.append((*row, None, -1, True, None, f"{type(problem).__name__}: {problem}", start))
    if rows:
        yield pd.DataFrame(rows, columns=columns)


def _piece_writer(attempt: int):
    def write_pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        target, error = None, None
        for batch in batches:
            done, rows = [], []
            for position, row in enumerate(batch.itertuples(index=False)):
                try:
                    if error is None:
                        if pd.notna(row.read_error):
                            raise OSError(row.read_error)
                        if row.piece is None:
                            raise ValueError("piece does not fit its tag")
                        if target is None:
                            target = Staged(row.target, row.content_type)
                            if row.action == "encrypt":
                                target.write(SEALED_MARK + bytes.fromhex(row.file_id))
                        if row.action == "encrypt":
                            target.write(len(row.piece).to_bytes(4, "big"))
                        target.write(row.piece)
                        if row.last:
                            target.publish()
                except Exception as problem:
                    error = f"{type(problem).__name__}: {problem}"
                    _discard_quietly(target)
                if row.last:
                    done.append(_sealed_outcome(row, target, error, attempt))
                    rows.append(position)
                    target, error = None, None
            if rows:
                yield _with_outcome(batch.iloc[rows][PLAN.fieldNames()].reset_index(drop=True), done)

    return write_pieces


def _sealed_outcome(row, target: Staged | None, error: str | None, attempt: int) -> tuple:
    if error is None:
        try:
            stored = digest(row.target)
            return "copied", attempt, target.bytes, target.md5.hexdigest(), stored, row.start_ms, _now_ms(), None
        except OSError as problem:
            error = f"{type(problem).__name__}: {problem}"
    # What the reader said comes first, whatever else an error's text holds.
    status = "missing" if error.startswith(f"OSError: {_SourceGone.__name__}: ") else "failed"
    return status, attempt, None, None, None, row.start_ms, _now_ms(), error


# --- contents as rows ---------------------------------------------------------


def write_files(contents: DataFrame, root: str) -> DataFrame:
    """Write rows of (relpath, content) as files below ``root``; returns relpath, bytes, md5.

    ``mtime_s``, when present, becomes the file's time where the target allows it.
    """
    require_columns(contents, ["relpath", "content"], "write_files")
    stamped = "mtime_s" in contents.columns

    def write_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            times = batch["mtime_s"] if stamped else [None] * len(batch)
            for relpath, content, mtime_s in zip(batch["relpath"], batch["content"], times):
                target = Staged(f"{root.rstrip('/')}/{relpath}")
                target.write(content)
                target.publish()
                if mtime_s is not None and target.files.type_name == "local":
                    os.utime(target.path, (int(mtime_s), int(mtime_s)))
                rows.append((relpath, target.bytes, target.md5.hexdigest()))
            yield pd.DataFrame(rows, columns=["relpath", "bytes", "md5"])

    written = contents.mapInPandas(write_batches, "relpath string, bytes bigint, md5 string")
    with small_batches(contents.sparkSession):
        return materialize(written, "written")


def discard(df: DataFrame) -> None:
    """Run a plan for its side effects only."""
    df.write.format("noop").mode("overwrite").save()
