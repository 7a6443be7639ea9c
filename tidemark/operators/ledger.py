"""The ledger: what every run did with every file, and what that means for the next run."""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import date

from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.paths import is_encrypted
from tidemark.operators.verify import check_status
from tidemark.schemas import LEDGER, OUTCOME, PENDING, require_columns
from tidemark.session import read_table
from tidemark.sources.fs import exists, open_fs

VERSION = ["relpath", "mtime_s"]


@dataclass(frozen=True)
class Run:
    """One run of a pipeline. Its name is also that of its partition in every table."""

    pipeline: str
    date: date
    id: str

    def __post_init__(self) -> None:
        for name in (self.pipeline, self.id):
            if not re.fullmatch(r"[A-Za-z0-9._\-]+", name):
                raise ValueError(f"a run's names hold letters, digits, '.', '_' and '-' only: {name!r}")

    def partition_of(self, uri: str) -> str:
        return f"{uri.rstrip('/')}/pipeline={self.pipeline}/run_date={self.date.isoformat()}/run_id={self.id}"


def write_run(rows: DataFrame, uri: str, run: Run) -> None:
    """Write a run's rows as its own partition; writing a run again replaces it."""
    rows.write.mode("overwrite").parquet(run.partition_of(uri))


def read_run(spark: SparkSession, uri: str, schema: StructType, run: Run) -> DataFrame:
    """One run's partition, without listing the others."""
    return read_table(spark, run.partition_of(uri), schema, base=uri)


def write_ledger(transferred: DataFrame, uri: str, run: Run) -> DataFrame:
    """Account for a run: every file's outcome and the check of its copy."""
    check = F.when(
        F.col("status") == "copied",
        check_status(F.col("md5_source"), F.col("md5_target"), is_encrypted("target")),
    ).otherwise(F.col("status"))
    write_run(transferred.select("*", check.alias("check")), uri, run)
    return read_run(transferred.sparkSession, uri, LEDGER, run)


def read_ledger(spark: SparkSession, uri: str) -> DataFrame:
    return read_table(spark, uri, LEDGER)


def sent(ledger: DataFrame) -> DataFrame:
    return ledger.where(F.col("check").isin("verified", "exempt"))


def unsent(ledger: DataFrame) -> DataFrame:
    """Files to try again. A file that is gone stays in the ledger but is not retried."""
    return ledger.where(F.col("check").isin("failed", "mismatch"))


def _versions(uri: str) -> list[int]:
    """The whole versions of a pipeline's pending files, oldest first."""
    files, path = open_fs(uri)
    found = files.get_file_info(pafs.FileSelector(path, allow_not_found=True))
    numbers = [int(i.base_name.partition("=")[2]) for i in found if re.fullmatch(r"version=[0-9]+", i.base_name)]
    return sorted(n for n in numbers if exists(f"{uri}/version={n}/_SUCCESS"))


def read_pending(spark: SparkSession, uri: str, pipeline: str) -> DataFrame | None:
    """The files a pipeline still owes, whichever run left them; None before anything was written."""
    at = f"{uri.rstrip('/')}/pipeline={pipeline}"
    versions = _versions(at)
    return spark.read.schema(PENDING).parquet(f"{at}/version={versions[-1]}") if versions else None


def write_pending(rows: DataFrame, uri: str, pipeline: str) -> None:
    """Replace what a pipeline owes. The version before stays, for those who read it just now."""
    at = f"{uri.rstrip('/')}/pipeline={pipeline}"
    versions = _versions(at)
    new = versions[-1] + 1 if versions else 1
    rows.select(*PENDING.fieldNames()).write.mode("overwrite").parquet(f"{at}/version={new}")
    for old in versions[:-1]:
        files, path = open_fs(f"{at}/version={old}")
        files.delete_dir(path)


def latest_version(rows: DataFrame, key: str = "relpath", by: str = "mtime_s") -> DataFrame:
    """The newest row of each path.

    An aggregate, not a window: it keeps one row per path and task before the
    shuffle, however often one path was rewritten.
    """
    require_columns(rows, [key, by], "latest_version")
    others = [name for name in rows.columns if name not in (key, by)]
    newest = F.max(F.struct(by, *others)).alias("newest")
    return rows.groupBy(key).agg(newest).select(
        *[F.col(name) if name == key else F.col(f"newest.{name}") for name in rows.columns]
    )


def exclude_transferred(manifest: DataFrame, done: DataFrame, version: list[str] | None = None) -> DataFrame:
    """Manifest rows whose version the ledger does not hold as sent.

    ``distinct`` combines before the shuffle and shares its partitioning with
    the join, so repeats in the ledger add no shuffle and no hot task.
    """
    version = version or VERSION
    return manifest.join(done.select(*version).distinct(), version, "left_anti")


def retry_set(manifest: DataFrame, failed: DataFrame, version: list[str] | None = None) -> DataFrame:
    """The new window and what failed before, one row per version; the new listing wins."""
    version = version or VERSION
    require_columns(failed, manifest.columns, "retry_set")
    both = manifest.withColumn("fresh", F.lit(1)).unionByName(
        failed.select(*manifest.columns).withColumn("fresh", F.lit(0))
    )
    others = [name for name in manifest.columns if name not in version]
    return both.groupBy(*version).agg(F.max(F.struct("fresh", *others)).alias("kept")).select(
        *[F.col(name) if name in version else F.col(f"kept.{name}") for name in manifest.columns]
    )


def lineage(ledger: DataFrame) -> DataFrame:
    """One row per written file: where it came from, where it went, which fields described it."""
    fields = [field.name for field in LEDGER if field.name not in OUTCOME.fieldNames()]
    named = F.array(*[F.lit(name) for name in fields if name in ledger.columns])
    return sent(ledger).select(
        F.col("fullfilename").alias("source"), "target", named.alias("columns"), "run_id"
    )
