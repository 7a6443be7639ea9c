"""The same listing and transfer as a file stream.

Each batch lists the folder again, by the walk of the batch run: empty files, hidden names and files that were rewritten or
arrive with an old time are all seen. What is new is told by state on each file, by hash of its path in the state store on the
executors; the stream's checkpoint has it, and the driver knows a window's two ends only.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timezone

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues
from pyspark.sql.types import StructType

from tidemark.fixed import DEFAULT_RETRIES, DEFAULT_WAIT_S
from tidemark.operators.archive import archive
from tidemark.operators.filters import name_filter, regular_files, subtree_filter
from tidemark.operators.ledger import Run, read_pending, read_run, retry_set, unsent, write_ledger, write_pending
from tidemark.operators.transfer import plan_transfer, transfer
from tidemark.schemas import LEDGER, PENDING
from tidemark.session import ROCKS_DB, materialize, work_folder
from tidemark.sources.datasource import FORMAT, register
from tidemark.sources.fs import exists, make_folder, require_folder
from tidemark.spread import flat_schema, flatten_times, restore_times

_STORE = "spark.sql.streaming.stateStore.providerClass"
# A file that is no longer listed is forgotten so much later, in case a batch takes long.
_MARGIN_S = 3_600
# Keys that the paths of a stream are dealt to. A stream's checkpoint has its state by these: they do not change.
_BUCKETS = 1_024


def stream_listing(spark: SparkSession, root: str, regex: str | None = None, subtree: str = "", recursive: bool = True,
                   lag_s: int = 0, lookback_s: int | None = None) -> DataFrame:
    """New files as a stream of listing rows; contents stay unread, and originals where they are.

    A file goes on once for each size and time it is found with. With ``lag_s`` it goes on when both have stood that
    long between two looks, so one that is still being written waits, and goes once, whole. ``lookback_s`` bounds what a batch
    lists, and the state: files whose time is older than that when the batch begins are not looked for. With both 0 the
    windows tile as those of batch runs, without any state, and a file that arrives with an old time is missed.
    """
    require_folder(root)
    reader = register(spark).readStream.format(FORMAT).option("path", root).option("recursive", str(recursive or bool(subtree)))
    if lookback_s is not None:
        reader = reader.option("lookback", str(lookback_s))
    if subtree:
        reader = reader.option("prefix", f"{subtree.strip('/')}/")
    files = name_filter(subtree_filter(regular_files(reader.load()), subtree, recursive), regex)
    if not lag_s and lookback_s is None:
        # Without waiting or forgetting, a version seen is a version sent: the engine's own state knows that.
        found = files.dropDuplicates(["path", "size", "mtime"])
    elif not lag_s and lookback_s == 0:
        found = files
    else:
        found = hold_back(files, lag_s, lookback_s)
    return found.drop("name", "listed_ms")


class _HoldBack(StatefulProcessor):
    """Of each path of a bucket: the size and time it was last found with, since when, whether that version went on, and when to forget it.

    A bucket's paths are one value, read and written once a batch: what a path costs there is a row, not several calls to the store.
    """

    STATE = "paths binary"
    PATHS = pa.schema([("path", pa.string()), ("size", pa.int64()), ("mtime", pa.int64()), ("since_ms", pa.int64()), ("sent", pa.bool_()), ("forget_ms", pa.int64())])

    def __init__(self, columns: list[str], lag_s: int, lookback_s: int | None):
        self.columns, self.lag_ms = columns, 1000 * lag_s
        self.kept_s = None if lookback_s is None else lookback_s + lag_s + _MARGIN_S

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", self.STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        known = self._read()
        timer, changed, now_ms = self._timer(known), False, timerValues.getCurrentProcessingTimeInMs()
        for frame in rows:
            going = []
            found = zip(*(frame[name].tolist() for name in ("path", "size", "mtime", "mtime_s", "listed_ms")))
            for at, (path, size, mtime, mtime_s, now) in enumerate(found):
                state = known.get(path)
                since, sent, forget = now, False, -1
                fresh = state is None or state[:2] != (size, mtime)
                if not fresh:
                    since, sent, forget = state[2:]
                elif self.kept_s is not None:
                    # When the file's time is out of every window to come.
                    forget = max(1000 * (mtime_s + self.kept_s), now_ms + 1000 * _MARGIN_S)
                goes = not sent and now - since >= self.lag_ms
                if goes or fresh:
                    known[path], changed = (size, mtime, since, sent or goes, forget), True
                if goes:
                    going.append(at)
            if going:
                yield frame.iloc[going][self.columns]
        if changed:
            self._write(known)
            self._set_timer(timer, self._timer(known))

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentProcessingTimeInMs())
        known = {path: state for path, state in self._read().items() if not 0 <= state[4] <= now}
        if known:
            self._write(known)
            self._set_timer(-1, self._timer(known))
        else:
            self.seen.clear()
        return iter(())

    def _read(self) -> dict[str, tuple]:
        if not self.seen.exists():
            return {}
        path, *states = (column.to_pylist() for column in pa.ipc.open_stream(self.seen.get()[0]).read_all().columns)
        return dict(zip(path, zip(*states)))

    def _write(self, known: dict[str, tuple]) -> None:
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, self.PATHS) as stream:
            stream.write_batch(pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((list(known), *zip(*known.values())), self.PATHS)], schema=self.PATHS))
        self.seen.update((out.getvalue().to_pybytes(),))

    def _timer(self, known: dict[str, tuple]) -> int:
        """When the next path is to be forgotten; the bucket has a timer for that one only."""
        return -1 if self.kept_s is None else min((state[4] for state in known.values() if state[4] >= 0), default=-1)

    def _set_timer(self, before: int, at: int) -> None:
        if at != before:
            if before >= 0:
                self.handle.deleteTimer(before)
            if at >= 0:
                self.handle.registerTimer(at)


def hold_back(files: DataFrame, lag_s: int, lookback_s: int | None = None) -> DataFrame:
    """Of files that are listed again and again (with ``path``, ``size``, ``mtime_s``, ``mtime``, ``listed_ms``) those that have stood for the lag, once."""
    flat = flat_schema(files.schema)
    processor = _HoldBack(files.columns, lag_s, lookback_s)
    bucket = F.pmod(F.xxhash64("path"), F.lit(_BUCKETS))
    settled = (
        flatten_times(files).withColumn("_bucket", bucket).groupBy("_bucket")
        .transformWithStateInPandas(processor, StructType(flat.fields), "Append", "ProcessingTime")
    )
    return restore_times(settled, files.schema)


@contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    """A stream keeps the store it was started with, so the session gets its own setting back."""
    before = spark.conf.get(_STORE)
    spark.conf.set(_STORE, ROCKS_DB)
    try:
        yield
    finally:
        spark.conf.set(_STORE, before)


def append_stream(stream: DataFrame, table_uri: str, checkpoint_uri: str) -> StreamingQuery:
    """Everything new since the last call, appended once to a parquet table."""
    with _state_on_disk(stream.sparkSession):
        return (
            stream.writeStream.format("parquet")
            .option("checkpointLocation", checkpoint_uri)
            .option("path", table_uri)
            .trigger(availableNow=True)
            .start()
        )


def stream_transfer(manifest_stream: DataFrame, target_root: str, ledger_uri: str, checkpoint_uri: str,
                    pipeline: str, retries: int = DEFAULT_RETRIES, wait_s: int = DEFAULT_WAIT_S,
                    archive_mode: str | None = None, archive_root: str | None = None) -> StreamingQuery:
    """Copy every micro-batch and account for it; a batch run again is not copied again.

    Files that failed are pending, in a table beside the ledger: they go again when this is called again, and with
    every batch. Originals are put away (``archive_mode``: ``rename`` or ``remove``) by what the ledger says of them.
    """
    require_folder(target_root)
    pending = f"{ledger_uri.rstrip('/')}-pending"

    def dated(rows: DataFrame, run_id: str) -> Run | None:
        # By the newest file, so that a repeated batch finds its partition again.
        newest = rows.agg(F.max("mtime_s")).first()[0]
        return None if newest is None else Run(pipeline, datetime.fromtimestamp(newest, timezone.utc).date(), run_id)

    def send(rows: DataFrame, run: Run) -> None:
        write_ledger(transfer(plan_transfer(rows, target_root), retries, wait_s), ledger_uri, run)

    def settle(spark: SparkSession, run: Run) -> None:
        ledger = read_run(spark, ledger_uri, LEDGER, run)
        if archive_mode:
            archive(ledger, archive_mode, archive_root)
        write_pending(unsent(ledger), pending, pipeline)

    def copy_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        sent_before = f"{checkpoint_uri.rstrip('/')}/transferred/{batch_id}"
        with work_folder(spark):
            rows = materialize(batch.select(*PENDING.fieldNames()), "batch")
            run = dated(rows, f"batch-{batch_id}")
            if run is not None:
                # Originals may have been put away since.
                if not exists(sent_before):
                    before = read_pending(spark, pending, pipeline)
                    send(rows if before is None else retry_set(rows, before, ["relpath"]), run)
                    make_folder(sent_before)
                settle(spark, run)

    spark = manifest_stream.sparkSession
    waiting = read_pending(spark, pending, pipeline)
    again = None if waiting is None else dated(waiting, f"retry-{time.time_ns() // 1_000_000}")
    if again is not None:
        with work_folder(spark):
            send(waiting, again)
            settle(spark, again)
    with _state_on_disk(spark):
        return (
            manifest_stream.writeStream.foreachBatch(copy_batch)
            .option("checkpointLocation", checkpoint_uri)
            .trigger(availableNow=True)
            .start()
        )
