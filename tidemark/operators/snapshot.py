"""The newest row of each path, kept up to date: a snapshot, and the runs since.

The snapshot is bucketed by path. The runs since are reduced to one row a path, dealt out like the snapshot's buckets
and merged with them, so what has been known for long is not shuffled again. A new snapshot is a new version
in a folder of its own; the one before stays for those who read it just now, and older ones go.
"""

from __future__ import annotations

import hashlib
import re

from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.ledger import latest_version
from tidemark.sources.fs import exists, open_fs, strip_file_scheme

BUCKETS = 200


def _versions(uri: str) -> list[tuple[int, int]]:
    """The whole versions and their numbers of buckets, oldest first."""
    files, path = open_fs(uri)
    found = files.get_file_info(pafs.FileSelector(path, allow_not_found=True))
    names = [re.fullmatch(r"version=([0-9]+)-buckets=([0-9]+)", info.base_name) for info in found]
    numbers = sorted((int(m[1]), int(m[2])) for m in names if m)
    return [(n, buckets) for n, buckets in numbers if exists(f"{uri}/version={n}-buckets={buckets}/_SUCCESS")]


def _table(uri: str) -> str:
    return f"tidemark_{hashlib.md5(uri.encode()).hexdigest()}"


def _opened(spark: SparkSession, uri: str, schema: StructType, key: str, buckets: int) -> DataFrame:
    """A version as a table: only the catalog knows that files are buckets."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    name = _table(uri)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{uri}'")
    return spark.table(name)


def read_snapshot(spark: SparkSession, uri: str, schema: StructType, key: str = "relpath") -> DataFrame | None:
    """The last snapshot, or None before the first."""
    versions = _versions(uri.rstrip("/"))
    if not versions:
        return None
    n, buckets = versions[-1]
    return _opened(spark, f"{uri.rstrip('/')}/version={n}-buckets={buckets}", schema, key, buckets)


def merge_latest(snapshot: DataFrame | None, since: DataFrame, key: str = "relpath", by: str = "mtime_s", buckets: int = BUCKETS) -> DataFrame:
    """The newest row of each path of a snapshot, which has one row a path, and of rows that came since.

    Of equal times the greater row stays, as in ``latest_version``. ``buckets`` is the snapshot's number of them: what came
    since is dealt out in as many.
    """
    newest = latest_version(since, key, by)
    if snapshot is None:
        return newest
    newest = newest.repartition(buckets, key)
    others = [name for name in snapshot.columns if name not in (key, by)]
    packed = F.struct(by, *others).alias("row")
    sides = snapshot.select(key, packed).alias("old").join(newest.select(key, packed).alias("new"), key, "full_outer")
    row = F.greatest("old.row", "new.row")
    return sides.select(F.col(key), row.alias("row")).select(*[F.col(key) if n == key else F.col(f"row.{n}") for n in snapshot.columns])


def with_runs(spark: SparkSession, uri: str, since: DataFrame, key: str = "relpath", by: str = "mtime_s") -> DataFrame:
    """The last snapshot below ``uri`` with the runs since."""
    versions = _versions(uri.rstrip("/"))
    held = read_snapshot(spark, uri, since.schema, key)
    return merge_latest(held, since, key, by, versions[-1][1] if versions else BUCKETS)


def write_snapshot(rows: DataFrame, uri: str, key: str = "relpath", buckets: int = BUCKETS) -> DataFrame:
    """Write the next version of rows with one row a path, and read it back."""
    spark, uri = rows.sparkSession, uri.rstrip("/")
    versions = _versions(uri)
    n = versions[-1][0] + 1 if versions else 1
    at = f"{uri}/version={n}-buckets={buckets}"
    # Dealt out as the buckets are, each task writes one file a bucket and no more.
    dealt = rows.repartition(buckets, key)
    spark.sql(f"DROP TABLE IF EXISTS {_table(at)}")
    dealt.write.bucketBy(buckets, key).sortBy(key).format("parquet").option("path", at).mode("overwrite").saveAsTable(_table(at))
    for old, cut in versions[:-1]:
        gone = f"{uri}/version={old}-buckets={cut}"
        spark.sql(f"DROP TABLE IF EXISTS {_table(gone)}")
        files, path = open_fs(strip_file_scheme(gone))
        files.delete_dir(path)
    return spark.table(_table(at))
