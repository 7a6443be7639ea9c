"""Watermark state: how far a pipeline has read, as an append-only table."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.times import watermark_status, whole_number
from tidemark.schemas import WATERMARKS
from tidemark.session import literal_rows, read_table


def latest_watermarks(watermarks: DataFrame) -> DataFrame:
    """The last committed row of each pipeline.

    ``max_by`` combines before the shuffle, so a pipeline with most of the rows
    costs one row per task.
    """
    newest = F.max_by(F.struct("from_s", "to_s", "run_id"), F.struct("committed_at", "to_s"))
    return (
        watermarks.groupBy("pipeline")
        .agg(newest.alias("newest"), F.max("committed_at").alias("committed_at"))
        .select("pipeline", "newest.*", "committed_at")
    )


def read_watermark(spark: SparkSession, uri: str, pipeline: str) -> Row | None:
    """The last commit of one pipeline, or None before its first run; only its own partition is listed."""
    state = read_table(spark, f"{uri.rstrip('/')}/pipeline={pipeline}", WATERMARKS, base=uri)
    return latest_watermarks(state).first()


def commit_watermark(spark: SparkSession, uri: str, pipeline: str, from_s: int, to_s: int, run_id: str,
                     preview: bool = False) -> bool:
    """Append the end of a finished run. A preview does not commit, and time never moves back."""
    if preview:
        return False
    last = read_watermark(spark, uri, pipeline)
    if last is not None and last.to_s > to_s:
        return False
    if last is not None and last.run_id == run_id:
        return True
    row = (from_s, to_s, run_id, datetime.now(timezone.utc), pipeline)
    commit = literal_rows(spark, [row], WATERMARKS).coalesce(1)
    commit.write.mode("append").partitionBy("pipeline").parquet(uri)
    return True


def _state_texts(spark: SparkSession, uri: str, now_s: int | None, legacy: bool) -> DataFrame:
    text = F.col("value") if legacy else F.regexp_replace("value", r"\A\s+|\s+\z", "")
    return spark.read.text(uri, wholetext=True).select(
        F.col("_metadata.file_name").alias("file_name"), watermark_status("value", now_s, legacy).alias("status"),
        whole_number(text).alias("seconds"), F.length("value").alias("length"),
    )


def read_watermark_texts(spark: SparkSession, folder: str, now_s: int | None = None, legacy: bool = False) -> DataFrame:
    """(file_name, status, from_s) of all state files in a folder: where each pipeline of an older set-up begins.

    Anything unreadable means the beginning. Empty files have no row, as they have no text.
    """
    start = F.when((F.col("status") == "ok") & (F.col("length") > 0), F.col("seconds")).otherwise(0)
    return _state_texts(spark, folder, now_s, legacy).select("file_name", "status", start.alias("from_s"))


def read_watermark_text(spark: SparkSession, uri: str, now_s: int | None = None, strict: bool = False,
                        legacy: bool = False) -> int:
    """State kept as ten digits in a text file, to start from an older set-up.

    Anything unreadable means the beginning, unless ``strict``.
    """
    try:
        found = _state_texts(spark, uri, now_s, legacy).first()
    except AnalysisException as error:
        if strict or error.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0
    if found is None or found.length == 0:
        return 0
    if found.status == "ok":
        return found.seconds
    if strict:
        raise ValueError(f"watermark text in {uri} is {found.status}")
    return 0
