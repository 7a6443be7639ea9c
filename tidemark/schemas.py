"""Fixed table schemas. Nothing is inferred; operators check their input columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DateType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _schema(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields])


_STRING, _LONG, _INT, _BOOL = StringType(), LongType(), IntegerType(), BooleanType()

# One row per entry found by a listing, before any filter.
LISTING = _schema(
    ("root", _STRING), ("path", _STRING), ("size", _LONG), ("mtime_us", _LONG), ("is_dir", _BOOL)
)

MANIFEST = _schema(
    ("connection_ref", _STRING),
    ("fullfilename", _STRING),
    ("filename", _STRING),
    ("basename", _STRING),
    ("relpath", _STRING),
    ("size", _LONG),
    ("mtime_s", _LONG),
    ("mtime", TimestampType()),
)

# Files still to be sent: the manifest and where each file lies.
PENDING = StructType(MANIFEST.fields + _schema(("path", _STRING)).fields)

# The manifest plus where each file goes.
PLAN = StructType(
    MANIFEST.fields
    + _schema(
        ("path", _STRING),
        ("target", _STRING),
        ("content_type", _STRING),
        ("encrypted", _BOOL),
        ("action", _STRING),
    ).fields
)

# What a transfer reports per file.
OUTCOME = _schema(
    ("status", _STRING),
    ("attempts", _INT),
    ("bytes", _LONG),
    ("md5_source", _STRING),
    ("md5_target", _STRING),
    ("start_ms", _LONG),
    ("end_ms", _LONG),
    ("error", _STRING),
)

# A piece of a file on its way through encryption.
PIECE = _schema(
    ("file_id", _STRING), ("seq", _INT), ("last", _BOOL), ("piece", BinaryType()), ("read_error", _STRING),
    ("start_ms", _LONG),
)

# What became of a range of a file that is copied by ranges.
RANGE = _schema(
    ("start", _LONG), ("length", _LONG), ("crc_source", _LONG), ("crc_target", _LONG), ("error", _STRING), ("gone", _BOOL),
    ("start_ms", _LONG),
)

TRANSFERRED = StructType(PLAN.fields + OUTCOME.fields)

# Every table of a run is partitioned by these.
RUN = _schema(("pipeline", _STRING), ("run_date", DateType()), ("run_id", _STRING))

LEDGER = StructType(TRANSFERRED.fields + _schema(("check", _STRING)).fields + RUN.fields)

# What became of each original.
PUT_AWAY = _schema(
    ("relpath", _STRING),
    ("mtime_s", _LONG),
    ("archive_target", _STRING),
    ("archive_status", _STRING),
    ("archive_error", _STRING),
)

ARCHIVED = StructType(PUT_AWAY.fields + RUN.fields)

WATERMARKS = _schema(
    ("from_s", _LONG),
    ("to_s", _LONG),
    ("run_id", _STRING),
    ("committed_at", TimestampType()),
    ("pipeline", _STRING),
)

# What a run set out to do; a resumed run does the same.
WINDOW = _schema(("from_s", _LONG), ("to_s", _LONG))

METRICS = StructType(_schema(("file", _STRING), ("metric", _STRING), ("value", _LONG)).fields + RUN.fields)


def require_columns(df: DataFrame, names: Iterable[str], operator: str) -> None:
    """Fail on the driver, with the operator's name, when an input column is absent."""
    absent = [name for name in names if name not in df.columns]
    if absent:
        raise ValueError(f"{operator}: missing columns {absent}; have {df.columns}")
