"""One run of a pipeline, from listing to watermark.

The order makes every step repeatable: plan, copy, ledger, archive, metrics,
watermark. Each step's result is a table of the run. A run that dies in between
is run again with the same ``run_id``: steps whose table is complete are read,
not repeated, and originals already put away are recognised.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import crypto
from tidemark.functions.times import window_bounds
from tidemark.operators.archive import archive
from tidemark.operators.filters import delta_filter, name_filter, regular_files, subtree_filter
from tidemark.operators.ledger import (
    Run,
    exclude_transferred,
    read_pending,
    read_run,
    retry_set,
    sent,
    unsent,
    write_ledger,
    write_pending,
    write_run,
)
from tidemark.operators.metrics import metrics_long
from tidemark.operators.transfer import plan_transfer, transfer
from tidemark.options import TransferOptions
from tidemark.schemas import ARCHIVED, LEDGER, METRICS, PENDING, PLAN, TRANSFERRED, WINDOW
from tidemark.session import literal_rows, new_folder, read_table, work_folder
from tidemark.sources.fs import exists, require_folder
from tidemark.sources.listing import walk_files
from tidemark.sources.manifest import sftp_manifest, store_manifest
from tidemark.sources.watermark import commit_watermark, read_watermark, read_watermark_text


@dataclass(frozen=True)
class RunResult:
    from_s: int
    to_s: int
    plan: DataFrame
    ledger: DataFrame | None = None
    archived: DataFrame | None = None
    metrics: DataFrame | None = None
    committed: bool = False


def list_manifest(spark: SparkSession, options: TransferOptions, from_s: int, to_s: int) -> DataFrame:
    """The files of the source folder in the window, with the names the target needs."""
    files = walk_files(spark, options.source_root, options.recursive, options.subtree, (from_s, to_s))
    files = delta_filter(regular_files(files), from_s, to_s)
    files = name_filter(subtree_filter(files, options.subtree, options.recursive), options.regex)
    if options.direction == "to_store":
        return sftp_manifest(
            files, options.connection_ref, options.user, options.host, options.port, options.remote_root
        )
    return store_manifest(files, options.connection_ref, options.source_root)


def run_transfer(spark: SparkSession, options: TransferOptions, run_id: str, logical_start_ms: int) -> RunResult:
    """Move what is new since the last run, and account for it.

    A file that fails is pending and is tried again by the next run, whether the
    watermark moved or not. A run that is resumed keeps the window it began
    with. ``lookback_s`` looks again at files that arrived with an old time, and
    sends those the ledger does not know.
    """
    options.validate(spark)
    options = options.qualified(spark)
    require_folder(options.target_root)
    state = options.state_root.rstrip("/") if options.state_root else None
    last = read_watermark(spark, f"{state}/watermarks", options.pipeline) if state else None
    persisted = last.to_s if last else None
    if last is None and options.legacy_state:
        persisted = read_watermark_text(spark, options.legacy_state)
    from_s, to_s = window_bounds(logical_start_ms, options.safety_s, options.from_delta, persisted)
    if last and last.run_id == run_id:
        from_s, to_s = last.from_s, last.to_s
    run = Run(options.pipeline, _date(to_s), run_id)
    if options.preview:
        return RunResult(from_s, to_s, _plan(spark, options, state, last, run, from_s, to_s))

    tables = state or new_folder(spark, f"run-{run_id}")
    plans, ledgers, archives, measured = (f"{tables}/{name}" for name in ("plans", "ledger", "archived", "metrics"))
    from_s, to_s = _begun(spark, f"{tables}/windows", run, from_s, to_s)
    run = Run(options.pipeline, _date(to_s), run_id)
    with work_folder(spark):
        # New files may arrive while we work: what was listed once is the plan.
        if not _complete(plans, run):
            write_run(_plan(spark, options, state, last, run, from_s, to_s), plans, run)
        plan = spark.read.schema(PLAN).parquet(run.partition_of(plans))
        if not _complete(ledgers, run):
            if plan.isEmpty():
                done = literal_rows(spark, [], TRANSFERRED)
            else:
                key = crypto.key_from_uri(spark, options.key_uri) if options.encryption != "none" else None
                done = transfer(
                    plan, options.retries, options.wait_s, key, options.parallelism, options.buffer_bytes,
                    split_bytes=options.split_bytes,
                )
            write_ledger(done, ledgers, run)
        ledger = read_run(spark, ledgers, LEDGER, run)
        if options.archive and not _complete(archives, run):
            done = archive(ledger, options.archive, options.archive_root, options.flatten, options.parallelism)
            write_run(done, archives, run)
        if not _complete(measured, run):
            if state:
                # The plan held all that was pending, so what failed of it is all that is pending now.
                write_pending(unsent(ledger), f"{state}/pending", run.pipeline)
            write_run(metrics_long(ledger, logical_start_ms).select("file", "metric", "value"), measured, run)
    committed = bool(state) and commit_watermark(
        spark, f"{state}/watermarks", options.pipeline, from_s, to_s, run_id
    )
    archived = read_run(spark, archives, ARCHIVED, run) if options.archive else None
    return RunResult(from_s, to_s, plan, ledger, archived, read_run(spark, measured, METRICS, run), committed)


def _begun(spark: SparkSession, uri: str, run: Run, from_s: int, to_s: int) -> tuple[int, int]:
    """The window this run began with, if it began before; else the one given, from now on."""
    at = f"{uri}/pipeline={run.pipeline}/run_id={run.id}"
    if exists(f"{at}/_SUCCESS"):
        window = spark.read.schema(WINDOW).parquet(at).first()
        return window.from_s, window.to_s
    literal_rows(spark, [(from_s, to_s)], WINDOW).coalesce(1).write.mode("overwrite").parquet(at)
    return from_s, to_s


def _plan(spark: SparkSession, options: TransferOptions, state: str | None, last: Row | None, run: Run,
          from_s: int, to_s: int) -> DataFrame:
    listed_from = max(0, from_s - options.lookback_s) if options.lookback_s else from_s
    manifest = list_manifest(spark, options, listed_from, to_s)
    if state:
        if options.lookback_s:
            # Files this recent can only have been sent by a run since then.
            own = read_table(spark, f"{state}/ledger/pipeline={run.pipeline}", LEDGER, base=f"{state}/ledger")
            recent = own.where((F.col("run_date") >= F.lit(_date(listed_from))) & (F.col("run_id") != run.id))
            manifest = exclude_transferred(manifest, delta_filter(sent(recent), listed_from, to_s))
        before = read_pending(spark, f"{state}/pending", run.pipeline)
        if before is None and last and last.run_id != run.id:
            # State from before there was such a table: the last run has all failures.
            before = unsent(
                read_run(spark, f"{state}/ledger", LEDGER, Run(run.pipeline, _date(last.to_s), last.run_id))
            ).select(*PENDING.fieldNames())
        if before is not None and not before.isEmpty():
            # The path alone tells files apart here: a file rewritten since it failed goes once.
            manifest = retry_set(manifest, before, ["relpath"])
    return plan_transfer(manifest, options.target_root, options.action, options.suffix)


def _complete(table: str, run: Run) -> bool:
    """Spark leaves this marker when, and only when, the whole table is written."""
    return exists(f"{run.partition_of(table)}/_SUCCESS")


def _date(seconds: int) -> date:
    return datetime.fromtimestamp(seconds, timezone.utc).date()
