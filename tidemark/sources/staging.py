"""A file on its way: written under a name that no listing shows, hashed on the way, and published only when whole."""

from __future__ import annotations

import hashlib

from pyarrow import fs as pafs

from tidemark.sources.fs import make_parent, move, open_fs, replaces_atomically, unfinished


class Staged:
    """An object store publishes what is written when the stream is closed, also when it is merely given up: a client that
    lets go of a stream closes it. So a file has its own name nowhere until it is whole, and gets it by a rename, which a store
    does as a copy of its own."""

    def __init__(self, uri: str, content_type: str | None = None, written_as: str | None = None):
        self.uri = uri
        self.files, self.path = open_fs(uri)
        self.written_as = unfinished(self.path) if written_as is None else open_fs(written_as)[1]
        make_parent(self.files, self.path)
        metadata = {"Content-Type": content_type} if content_type and not replaces_atomically(self.files) else None
        self.stream = self.files.open_output_stream(self.written_as, compression=None, metadata=metadata)
        self.md5, self.bytes = hashlib.md5(), 0

    def write(self, data: bytes) -> None:
        self.stream.write(data)
        self.md5.update(data)
        self.bytes += len(data)

    def close(self) -> None:
        self.stream.close()

    def publish(self) -> None:
        self.close()
        move(self.files, self.written_as, self.path)

    def discard(self) -> None:
        """Leave nothing behind."""
        try:
            self.close()
        finally:
            if self.files.get_file_info(self.written_as).type == pafs.FileType.File:
                self.files.delete_file(self.written_as)
