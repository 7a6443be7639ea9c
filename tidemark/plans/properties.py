"""Options from the properties a source and a sink were configured with before.

All values are texts by name, as a pipeline's export holds them. Connections
are not among the options: the executors reach the remote server's files under
a mounted folder, and the store by its scheme.
"""

from __future__ import annotations

from tidemark.fixed import DEFAULT_PORT
from tidemark.options import TransferOptions, safety_from_text


def options_from_properties(pipeline: str, source: dict[str, str], sink: dict[str, str], state_root: str | None = None,
                            mount: str = "", key_uri: str | None = None,
                            arguments: dict[str, str] | None = None) -> TransferOptions:
    """One pipeline's options; ``arguments`` are those of a single run.

    A source of the store (``gcsPath``) goes with a sink at the remote server
    and the other way round. ``persistDelta`` is read until the first run has
    committed a watermark of its own below ``state_root``. Encryption uses the
    key in ``key_uri``, whatever key ring was configured.
    """
    _refuse_macros({**source, **sink})
    arguments = arguments or {}
    to_sftp = "gcsPath" in source
    remote = sink if to_sftp else source
    remote_folder = mount.rstrip("/") + remote["sftpPath"]
    archive = sink.get("archiveOption") or "rename" if sink.get("archiveOriginals") == "yes" else None
    archive_root = sink.get("targetPath") or None
    if archive_root and not to_sftp:
        archive_root = mount.rstrip("/") + archive_root
    sealed = bool(sink.get("privateKeyPath")) if to_sftp else sink.get("encryption") == "PGP"
    return TransferOptions(
        pipeline=pipeline,
        source_root=source["gcsPath"] if to_sftp else remote_folder,
        target_root=remote_folder if to_sftp else sink["path"],
        direction="to_sftp" if to_sftp else "to_store",
        connection_ref=source.get("referenceName") or pipeline,
        user=remote.get("sftpUser") or "",
        host=remote.get("sftpServer") or "",
        port=_whole(remote, "sftpPort", DEFAULT_PORT),
        remote_root=None if to_sftp else remote["sftpPath"],
        recursive=source.get("recursive") in ("yes", "true"),
        regex=source.get("regexFilter") or None,
        safety_s=safety_from_text(arguments.get("safety.read.time")),
        from_delta=_whole(source, "fromDelta", None),
        state_root=state_root,
        legacy_state=source.get("persistDelta") or None,
        retries=_whole(sink, "numRetries", 0),
        wait_s=_whole(sink, "timeToWait", 0),
        archive=archive,
        archive_root=archive_root if archive == "rename" else None,
        encryption="aes_gcm" if sealed else "none",
        key_uri=key_uri if sealed else None,
        preview=arguments.get("exec.preview") == "true",
    )


def _whole(properties: dict[str, str], name: str, default: int | None) -> int | None:
    text = properties.get(name)
    if text is None or text == "":
        return default
    try:
        return int(text)
    except ValueError:
        raise ValueError(f"{name} is not a whole number: {text!r}") from None


def _refuse_macros(properties: dict[str, str]) -> None:
    open_ones = sorted(name for name, text in properties.items() if text and "${" in text)
    if open_ones:
        raise ValueError(f"properties still hold macros: {open_ones}")
