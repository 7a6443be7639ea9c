"""Options of a run, checked on the driver before anything is listed."""

from __future__ import annotations

import re
from dataclasses import dataclass, replace

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidemark.fixed import (
    BUCKET_PATTERN,
    BUFFER_BYTES,
    DEFAULT_PORT,
    DEFAULT_RETRIES,
    DEFAULT_SAFETY_S,
    DEFAULT_WAIT_S,
    ENCRYPTED_SUFFIX,
    MAX_RETRIES,
    MAX_WAIT_S,
)
from tidemark.session import qualify
from tidemark.sources.fs import is_local, strip_file_scheme

DIRECTIONS = ("to_store", "to_sftp")
ENCRYPTIONS = ("none", "aes_gcm")
ARCHIVE_MODES = (None, "rename", "remove")
_ROOTS = ("source_root", "target_root", "state_root", "archive_root", "key_uri", "legacy_state")
_OBJECT_STORES = ("gs", "s3", "s3a")


@dataclass(frozen=True)
class TransferOptions:
    """One pipeline: which folder to read, what of it, where to, and what happens to originals.

    ``state_root`` holds the ledger, the watermarks and the metrics. Without
    it a run remembers nothing and the next one starts from the beginning.
    ``legacy_state`` is a text file with the watermark of an older set-up, read
    until a run has committed one. ``remote_root`` is the source folder's name
    at its server, where the executors see it under another.
    """

    pipeline: str
    source_root: str
    target_root: str
    direction: str = "to_store"
    connection_ref: str = ""
    user: str = ""
    host: str = ""
    port: int = DEFAULT_PORT
    recursive: bool = False
    regex: str | None = None
    subtree: str = ""
    safety_s: int = DEFAULT_SAFETY_S
    from_delta: int | None = None
    lookback_s: int = 0
    state_root: str | None = None
    legacy_state: str | None = None
    remote_root: str | None = None
    retries: int = DEFAULT_RETRIES
    wait_s: int = DEFAULT_WAIT_S
    parallelism: int | None = None
    archive: str | None = None
    archive_root: str | None = None
    encryption: str = "none"
    key_uri: str | None = None
    suffix: str = ENCRYPTED_SUFFIX
    preview: bool = False
    buffer_bytes: int = BUFFER_BYTES
    # Larger files are copied by ranges; needs a local or mounted target.
    split_bytes: int | None = None

    @property
    def flatten(self) -> bool:
        """Originals of a store are archived by leaf name, those of a remote folder keep their sub-tree."""
        return self.direction == "to_sftp"

    @property
    def action(self) -> str:
        if self.encryption == "none":
            return "copy"
        return "encrypt" if self.direction == "to_store" else "decrypt"

    def qualified(self, spark: SparkSession) -> TransferOptions:
        """The same with every folder's file system named where it has to be."""
        roots = {name: getattr(self, name) for name in _ROOTS}
        return replace(self, **{name: qualify(spark, uri) for name, uri in roots.items() if uri})

    def validate(self, spark: SparkSession) -> None:
        """Raise one error that names everything wrong."""
        wrong = []
        for name in ("pipeline", "source_root", "target_root"):
            if not getattr(self, name):
                wrong.append(f"{name} is required")
        for name in _ROOTS:
            problem = uri_problem(getattr(self, name))
            if problem:
                wrong.append(f"{name} {problem}")
        if self.direction not in DIRECTIONS:
            wrong.append(f"direction is one of {DIRECTIONS}")
        if not 0 <= self.retries <= MAX_RETRIES:
            wrong.append(f"retries is between 0 and {MAX_RETRIES}")
        if not 0 <= self.wait_s <= MAX_WAIT_S:
            wrong.append(f"wait_s is between 0 and {MAX_WAIT_S}")
        if self.safety_s < 0 or self.lookback_s < 0:
            wrong.append("safety_s and lookback_s are not negative")
        if self.encryption not in ENCRYPTIONS:
            wrong.append(f"encryption is one of {ENCRYPTIONS}")
        elif self.encryption != "none" and not self.key_uri:
            wrong.append("key_uri is required with encryption")
        if self.archive not in ARCHIVE_MODES:
            wrong.append(f"archive is one of {ARCHIVE_MODES}")
        elif self.archive == "rename":
            if not self.archive_root:
                wrong.append("archive_root is required to archive by rename")
            elif _bare(self.archive_root) == _bare(self.source_root):
                wrong.append("archive_root differs from source_root")
        if self.buffer_bytes <= 0:
            wrong.append("buffer_bytes is positive")
        if self.split_bytes is not None and (self.split_bytes <= 0 or not is_local(self.target_root)):
            wrong.append("split_bytes is positive and needs a local or mounted target_root")
        if self.regex:
            problem = regex_problem(spark, self.regex)
            if problem:
                wrong.append(f"regex does not compile: {problem}")
        if wrong:
            raise ValueError("; ".join(wrong))


def _bare(uri: str) -> str:
    return strip_file_scheme(uri).rstrip("/")


def uri_problem(uri: str | None) -> str | None:
    """A folder is an absolute path or a URI; in an object store it starts with a well-formed bucket."""
    if not uri or uri.startswith(("/", "file:/")):
        return None
    parts = re.match(r"([a-z][a-z0-9+.\-]*)://([^/]*)", uri)
    if parts is None:
        return "is neither an absolute path nor a URI"
    if parts.group(1) in _OBJECT_STORES and not re.fullmatch(BUCKET_PATTERN, parts.group(2)):
        return "has no valid bucket"
    return None


def regex_problem(spark: SparkSession, regex: str) -> str | None:
    """Let Spark compile the pattern on one row, before a wide job meets it.

    By itself too: a pattern that closes the group around it would match a part of a name.
    """
    try:
        spark.range(1).select(F.lit("").rlike(regex), F.lit("").rlike(rf"\A(?:{regex})\z")).collect()
    except PySparkException as error:
        return error.getCondition() or str(error)
    return None


def safety_from_text(text: str | None) -> int:
    """A run argument as seconds; missing, bad or negative text means the default."""
    try:
        value = int(text) if text is not None else -1
    except ValueError:
        value = -1
    return value if value >= 0 else DEFAULT_SAFETY_S
