"""File bytes as rows, or as digests of bounded pieces, read in tasks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import BinaryType, StringType, StructType

from tidemark.fixed import BUFFER_BYTES
from tidemark.schemas import require_columns
from tidemark.sources.fs import open_fs
from tidemark.sources.listing import walk_files
from tidemark.spread import STREAMS_PER_TASK, map_files

# Contents handed on at once.
_HELD_BYTES = 4 * 1024 * 1024


def read_content(spark: SparkSession, roots: str | list[str]) -> DataFrame:
    """path, content, size, mtime of whole files, empty and hidden ones too; each has to fit in a row."""

    def read_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at, contents, held = 0, [], 0
            for path in batch["path"]:
                files, raw = open_fs(path)
                with files.open_input_stream(raw, compression=None) as stream:
                    contents.append(stream.read())
                held += len(contents[-1])
                if held >= _HELD_BYTES:
                    yield batch.iloc[at : at + len(contents)].assign(content=contents)
                    at, contents, held = at + len(contents), [], 0
            if contents:
                yield batch.iloc[at:].assign(content=contents)

    files = walk_files(spark, roots).select("path", "size", "mtime")
    found = map_files(files, read_batches, StructType().add("content", BinaryType()))
    return found.select("path", "content", "size", "mtime")


def digest(uri: str, buffer_bytes: int = BUFFER_BYTES) -> str:
    """MD5 of a file of any size, one buffer in memory."""
    files, path = open_fs(uri)
    md5 = hashlib.md5()
    with files.open_input_stream(path, compression=None) as stream:
        while piece := stream.read(buffer_bytes):
            md5.update(piece)
    return md5.hexdigest()


def checksum_files(files: DataFrame, buffer_bytes: int = BUFFER_BYTES, parallelism: int | None = None,
                   streams: int = STREAMS_PER_TASK) -> DataFrame:
    """Add ``md5`` to a listing by reading every file once, whatever its size.

    A file that cannot be read has a null digest, which never verifies.
    """
    require_columns(files, ["path", "size"], "checksum_files")

    def digest_or_none(path: str) -> str | None:
        try:
            return digest(path, buffer_bytes)
        except OSError:
            return None

    def hash_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(streams) as pool:
            for batch in batches:
                digests = list(pool.map(digest_or_none, batch["path"]))
                yield batch.assign(md5=pd.Series(digests, index=batch.index, dtype=object))

    return map_files(files, hash_batches, StructType().add("md5", StringType()), parallelism)
