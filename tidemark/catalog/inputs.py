"""The given tables seen as file manifests, ledgers and watermarks, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.times import window_bounds
from tidemark.operators.filters import delta_filter

# A window inside the days the events cover: noon of the first day to the end of the second.
FROM_S = 1_704_110_400
LOGICAL_START_MS = 1_704_240_300_000
_, TO_S = window_bounds(LOGICAL_START_MS, from_delta=FROM_S)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables. Their times carry no zone and mean UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def instant(naive: str) -> Column:
    return F.col(naive).cast("timestamp")


def document_files(spark: SparkSession, sf_dir: str, window: tuple[int, int] | None = None) -> DataFrame:
    """Every document as a file ``/in/source/lang/id.txt``, written when the event of its id happened.

    Digest and size are taken before the join, so no text is shuffled. A window
    is applied to the events' own time, where it reaches their scan.
    """
    documents = table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        "lang",
        F.concat("source", F.lit("/"), "lang", F.lit("/"), "doc_id", F.lit(".txt")).alias("relpath"),
        F.octet_length("text").cast("bigint").alias("size"),
        F.md5("text").alias("md5"),
    )
    events = table(spark, sf_dir, "events")
    if window:
        events = delta_filter(events, *window, on="ts")
    events = events.select(
        F.col("event_id").alias("doc_id"),
        instant("ts").alias("mtime"),
        F.unix_seconds(instant("ts")).alias("mtime_s"),
    )
    return documents.join(events, "doc_id").withColumns(
        {"root": F.lit("/in"), "path": F.concat(F.lit("/in/"), "relpath")}
    )


FILES_SQL = """
files as (
  select d.doc_id, d.source, d.lang,
         d.source || '/' || d.lang || '/' || d.doc_id || '.txt' as relpath,
         '/in/' || d.source || '/' || d.lang || '/' || d.doc_id || '.txt' as path,
         strlen(d.text)::bigint as size, md5(d.text) as md5,
         floor(epoch(e.ts))::bigint as mtime_s, epoch_us(e.ts) // 1000 as mtime_ms
  from documents d join events e on e.event_id = d.doc_id
)"""


def document_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files as if transferred: French ones failed, German ones differ, the rest arrived.

    A file took one millisecond per byte and one attempt per started 10,000 bytes.
    """
    start_ms = F.unix_millis("mtime")
    check = F.when(F.col("lang") == "fr", "failed").when(F.col("lang") == "de", "mismatch").otherwise("verified")
    return document_files(spark, sf_dir).select(
        "doc_id",
        "source",
        "lang",
        "relpath",
        "path",
        "mtime_s",
        F.lit("documents").alias("pipeline"),
        F.concat(F.lit("run-"), "lang").alias("run_id"),
        F.concat(F.lit("sftp://u@h:22"), "path").alias("fullfilename"),
        F.concat(F.lit("/landing/"), "relpath").alias("target"),
        F.col("size").alias("bytes"),
        check.alias("check"),
        (F.call_function("div", F.col("size"), F.lit(10_000)) + 1).cast("int").alias("attempts"),
        start_ms.alias("start_ms"),
        (start_ms + F.col("size")).alias("end_ms"),
    )


LEDGER_SQL = FILES_SQL + """,
ledger as (
  select doc_id, source, lang, relpath, path, mtime_s, 'documents' as pipeline, 'run-' || lang as run_id,
         'sftp://u@h:22' || path as fullfilename, '/landing/' || relpath as target, size as bytes,
         case lang when 'fr' then 'failed' when 'de' then 'mismatch' else 'verified' end as "check",
         size // 10000 + 1 as attempts, mtime_ms as start_ms, mtime_ms + size as end_ms
  from files
)"""


def in_window_sql(column: str) -> str:
    return f"{column} > {FROM_S} and {column} <= {TO_S}"
