"""Which listed files belong to a run."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from tidemark.functions.paths import leaf
from tidemark.schemas import LEDGER

def delta_filter(df: DataFrame, from_s: int, to_s: int, on: str = "mtime_s") -> DataFrame:
    """Files with ``from_s < mtime <= to_s`` at second grain.

    On a timestamp the same window is ``from_s + 1 <= ts < to_s + 1``: plain
    comparisons with a literal, so they reach the scan, and a fraction of a
    second belongs to the second it started in.
    """
    kind = df.schema[on].dataType
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return df.where((F.col(on) >= _moment(from_s + 1, kind)) & (F.col(on) < _moment(to_s + 1, kind)))
    return df.where((F.col(on) > from_s) & (F.col(on) <= to_s))


def _moment(seconds: int, kind: TimestampType | TimestampNTZType) -> Column:
    if isinstance(kind, TimestampType):
        return F.timestamp_seconds(F.lit(seconds))
    utc = datetime.fromtimestamp(seconds, timezone.utc).replace(tzinfo=None)
    return F.lit(utc.isoformat(sep=" ")).cast("timestamp_ntz")


def name_filter(df: DataFrame, regex: str | None, on: str = "relpath") -> DataFrame:
    """Files whose whole leaf name matches; no pattern keeps all."""
    if not regex:
        return df
    return df.where(leaf(on).rlike(rf"\A(?:{regex})\z"))


def subtree_filter(df: DataFrame, prefix: str, recursive: bool = False, on: str = "relpath") -> DataFrame:
    """Files below a folder, or directly in it. An empty prefix is the root."""
    path = F.col(on)
    if prefix:
        prefix = prefix if prefix.endswith("/") else prefix + "/"
        df = df.where(path.startswith(prefix))
    if recursive:
        return df
    return df.where(~F.substr(path, F.lit(len(prefix) + 1)).contains("/"))


def regular_files(df: DataFrame, on: str = "relpath") -> DataFrame:
    """Drop folder placeholders, the root's own included."""
    return df.where((F.col(on) != "") & ~F.col(on).endswith("/"))


def without_secrets(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows travel without credentials: what a file's row may hold is named, and every other column stays behind.

    That is the columns of manifests, plans and ledgers, and those named in ``keep``.
    """
    known = {name.lower() for name in (*LEDGER.fieldNames(), "root", *keep)}
    return df.select(*[F.col(f"`{name}`") for name in df.columns if name.lower() in known])
