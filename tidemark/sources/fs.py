"""Small helpers for tasks that touch files. The scheme picks the file system."""

from __future__ import annotations

import posixpath
import re
import time

from pyarrow import fs as pafs
from pyspark import TaskContext

_URI = re.compile(r"\A([A-Za-z][A-Za-z0-9+.\-]*)://([^/]*)(/.*)?\Z", re.S)
# Hadoop's names for schemes that go by another name here.
_ALIASES = {"s3a": "s3", "s3n": "s3", "wasbs": "abfss"}
# Ends the name of a file that is still being written.
UNFINISHED = ".tidemark-part"
# Such a name in full; a source file that merely ends like it is a file like any other.
UNFINISHED_PATH = r"/\.[^/]+\.[0-9]+(-[0-9]+)?\.tidemark-part\z"
UNFINISHED_NAME = re.compile(r"\A\.[^/]+\.[0-9]+(-[0-9]+)?\.tidemark-part\Z", re.S)
_OBJECT_STORES = ("s3", "gcs", "abfs")
_OPENED: dict[tuple[str, str], pafs.FileSystem] = {}


def unfinished(path: str) -> str:
    """Where a file is written before it gets its name: beside it, under a name no other attempt of any task uses."""
    context = TaskContext.get()
    attempt = f"{context.taskAttemptId()}-{time.time_ns()}" if context else str(time.time_ns())
    folder, name = posixpath.split(path)
    return posixpath.join(folder, f".{name}.{attempt}{UNFINISHED}")


def strip_file_scheme(uri: str) -> str:
    return re.sub(r"\Afile:/+", "/", uri)


def is_local(uri: str) -> bool:
    return _URI.match(strip_file_scheme(uri)) is None


def split_uri(uri: str) -> tuple[str, str, str]:
    """Scheme, authority and the raw path as the file system wants it; nothing is percent-decoded."""
    uri = strip_file_scheme(uri)
    match = _URI.match(uri)
    if match is None:
        return "file", "", uri
    scheme, authority, path = match.group(1).lower(), match.group(2), match.group(3) or "/"
    if scheme not in ("hdfs", "viewfs"):
        # The container alone heads the path; the account behind it belongs to the client.
        path = (authority.partition("@")[0] if scheme in ("abfs", "abfss") else authority) + path
    return _ALIASES.get(scheme, scheme), authority, path


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and the raw path in it; one client per authority and process."""
    scheme, authority, path = split_uri(uri)
    if (scheme, authority) not in _OPENED:
        local = scheme == "file"
        _OPENED[scheme, authority] = (
            pafs.LocalFileSystem() if local else pafs.FileSystem.from_uri(f"{scheme}://{authority}/")[0]
        )
    return _OPENED[scheme, authority], path


def exists(uri: str) -> bool:
    files, path = open_fs(uri)
    return files.get_file_info(path).type != pafs.FileType.NotFound


def require_folder(uri: str) -> None:
    """Fail early: an empty folder is fine, a missing one is an error.

    An object store has no folders, so there the bucket has to exist.
    """
    files, path = open_fs(uri)
    if files.type_name in _OBJECT_STORES:
        path = path.split("/", 1)[0]
    if files.get_file_info(path).type != pafs.FileType.Directory:
        raise FileNotFoundError(f"folder does not exist: {uri}")


def make_folder(uri: str) -> None:
    files, path = open_fs(uri)
    files.create_dir(path, recursive=True)


def make_parent(files: pafs.FileSystem, path: str) -> None:
    """An object store needs no folders, and would keep them as empty objects."""
    if files.type_name not in _OBJECT_STORES:
        files.create_dir(posixpath.dirname(path), recursive=True)


def replaces_atomically(files: pafs.FileSystem) -> bool:
    """Whether a rename publishes a file at once. Object stores publish on close."""
    return files.type_name in ("local", "hdfs")


def move(files: pafs.FileSystem, source: str, target: str) -> None:
    if files.type_name == "hdfs" and files.get_file_info(target).type == pafs.FileType.File:
        files.delete_file(target)
    files.move(source, target)
