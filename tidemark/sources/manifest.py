"""Manifest rows from a listing. The two kinds of source name files differently."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.fixed import DEFAULT_PORT
from tidemark.functions import paths as P
from tidemark.schemas import MANIFEST, require_columns

_LISTED = ("root", "path", "relpath", "size", "mtime_s", "mtime")


def sftp_manifest(files: DataFrame, connection_ref: str, user: str, host: str, port: int = DEFAULT_PORT,
                  root: str | None = None) -> DataFrame:
    """``filename`` is the path below the root with its slash, ``basename`` the file's folder.

    ``root`` is the folder's name at the remote side when it is mounted elsewhere.
    """
    require_columns(files, _LISTED, "sftp_manifest")
    remote_root = F.col("root") if root is None else F.lit(root.rstrip("/"))
    filename = F.concat(F.lit("/"), F.col("relpath"))
    return _project(
        files,
        connection_ref,
        fullfilename=P.sftp_uri(user, host, str(port), remote_root, filename),
        filename=filename,
        basename=P.directory(F.concat(remote_root, filename)),
    )


def store_manifest(files: DataFrame, connection_ref: str, root_uri: str) -> DataFrame:
    """``filename`` is the leaf, ``basename`` the listed root as ``/bucket/folder/``."""
    require_columns(files, _LISTED, "store_manifest")
    basename = P.normalise_root(F.lit(root_uri))
    return _project(
        files,
        connection_ref,
        fullfilename=F.concat(basename, F.col("relpath")),
        filename=P.leaf("relpath"),
        basename=basename,
    )


def _project(files: DataFrame, connection_ref: str, **names) -> DataFrame:
    """The fixed manifest columns, then the physical path the copy reads."""
    columns = {
        "connection_ref": F.lit(connection_ref),
        **names,
        **{name: F.col(name) for name in ("relpath", "size", "mtime_s", "mtime")},
    }
    return files.select(*[columns[field.name].alias(field.name) for field in MANIFEST], "path")
