"""Put originals away, or remove them, after their copy was verified."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.paths import archive_path
from tidemark.operators.ledger import sent
from tidemark.operators.split import CRC_MARK
from tidemark.schemas import PUT_AWAY, require_columns
from tidemark.session import materialize
from tidemark.sources.content import digest
from tidemark.sources.fs import exists, make_parent, move, open_fs, strip_file_scheme, unfinished
from tidemark.spread import spread


def archive(ledger: DataFrame, mode: str, target: str | None = None, flatten: bool = False,
            parallelism: int | None = None) -> DataFrame:
    """Move (``rename``) or delete (``remove``) the originals of files that were sent.

    One result row per file: ``archived``, ``removed``, ``collision`` (two
    originals would get the same name, or another file has it; none is moved),
    ``same_path``, ``changed`` (rewritten since it was copied; left in place),
    ``failed`` or ``skipped``. Repeating it is safe.
    """
    require_columns(ledger, ["relpath", "mtime_s", "path", "size", "md5_source", "action", "check"], "archive")
    if mode not in ("rename", "remove"):
        raise ValueError(f"archive mode is rename or remove, not {mode!r}")
    if mode == "rename" and not target:
        raise ValueError("archive by rename needs a target folder")
    moved_to = F.lit(None).cast("string")
    if mode == "rename":
        moved_to = archive_path(strip_file_scheme(target), "relpath", flatten)
    rows = sent(ledger).select(
        "relpath", "mtime_s", "path", "size", "md5_source", "action", moved_to.alias("archive_target")
    )
    rows = rows.withColumn("refused", F.when(F.col("path") == F.col("archive_target"), "same_path"))
    if mode == "rename" and flatten:
        rows = _refuse_collisions(rows)
    # What goes where is settled before it is dealt out.
    rows = materialize(rows, "originals")
    done = spread(rows, parallelism).mapInPandas(_put_away(mode), PUT_AWAY)
    skipped = ledger.where(~F.col("check").isin("verified", "exempt")).select(
        "relpath",
        "mtime_s",
        F.lit(None).cast("string").alias("archive_target"),
        F.lit("skipped").alias("archive_status"),
        F.lit(None).cast("string").alias("archive_error"),
    )
    return materialize(done.unionByName(skipped), "archived")


def _refuse_collisions(rows: DataFrame) -> DataFrame:
    """Mark rows whose target another row has too.

    Targets are counted before their shuffle, so the join's other side has one row for each that is shared; the rows of
    a target shared by very many are split among tasks by the engine, which the join allows.
    """
    shared = rows.groupBy("archive_target").count().where("count > 1").select("archive_target", F.lit("collision").alias("clash"))
    refused = F.coalesce(F.col("refused"), F.col("clash")).alias("refused")
    return rows.join(shared, "archive_target", "left").select(*[n for n in rows.columns if n != "refused"], refused)


def _put_away(mode: str):
    def one(path: str, size: int, mtime_s: int, md5: str | None, target: str | None) -> str:
        files, raw = open_fs(path)
        info = files.get_file_info(raw)
        if info.type == pafs.FileType.NotFound:
            # Only an earlier attempt of this step takes originals away.
            if mode == "remove":
                return "removed"
            if exists(target) and (md5 is None or digest(target) == md5):
                return "archived"
            raise FileNotFoundError(f"neither at its place nor archived: {path}")
        if info.size != size or (info.mtime_ns or 0) // 1_000_000_000 != mtime_s:
            return "changed"
        if mode == "remove":
            files.delete_file(raw)
            return "removed"
        target_files, target_raw = open_fs(target)
        if exists(target) and digest(target) != digest(path):
            return "collision"
        make_parent(target_files, target_raw)
        if target_files is files:
            move(files, raw, target_raw)
        else:
            # Under a name of its own until it is known to be whole: part of a file would be in the way for ever.
            part = unfinished(target)
            part_raw = open_fs(part)[1]
            pafs.copy_files(raw, part_raw, source_filesystem=files, destination_filesystem=target_files)
            if digest(part) != (md5 or digest(path)):
                target_files.delete_file(part_raw)
                raise OSError(f"archive copy differs: {target}")
            move(target_files, part_raw, target_raw)
            files.delete_file(raw)
        return "archived"

    def put_away(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            statuses, errors = [], []
            for row in batch.itertuples(index=False):
                status, error = row.refused, None
                if pd.isna(status):
                    # The digest of a sealed or opened file is that of its copy, not of the original.
                    md5 = row.md5_source if row.action == "copy" and pd.notna(row.md5_source) else None
                    if md5 and md5.startswith(CRC_MARK):
                        md5 = None
                    file = (row.path, row.size, row.mtime_s, md5, row.archive_target)
                    try:
                        try:
                            status = one(*file)
                        except FileNotFoundError:
                            # Another attempt of this task may have taken it away just now.
                            status = one(*file)
                    except Exception as problem:
                        status, error = "failed", f"{type(problem).__name__}: {problem}"
                statuses.append(status)
                errors.append(error)
            yield batch[["relpath", "mtime_s", "archive_target"]].assign(
                archive_status=statuses, archive_error=errors
            )

    return put_away
