"""Token ids in Arrow files of equal-length sequences.

A file is in Arrow's random-access format. Its record batches have two fixed-size-list
columns: ``ids``, ``length`` unsigned integers a row, and ``mask``, true where an id is one
of the documents' and false where it only fills the last sequence of the file. Both lie
in the file as plain arrays, so a mapped file gives any sequence without a copy. A second
Arrow file beside it has the documents: doc_id, start (ids before it in the file), n_tokens.

Documents go to files in ascending order of their ids: Spark deals them out by range, and a
task writes what it gets, sorted, under a name of its own. What the files are called is a
result of the tasks that ended well, so files of lost attempts are never read.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.base import whole, written
from tidemark.llm.tokens import encoder, in_pieces
from tidemark.sources.fs import make_parent, open_fs

_SEQUENCES_PER_BATCH = 256
_INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
MANIFEST = "part int, path string, documents long, tokens long, sequences long"


def _schema(length: int, kind: pa.DataType) -> pa.Schema:
    return pa.schema([("ids", pa.list_(pa.field("id", kind, False), length)), ("mask", pa.list_(pa.field("real", pa.bool_(), False), length))])


class Writer:
    """Writes one file and its documents. ``width``: bytes of an id, 2 or 4."""

    def __init__(self, uri: str, length: int, width: int):
        self.length, self.kind = length, np.dtype(f"<u{width}")
        self.schema = _schema(length, pa.from_numpy_dtype(self.kind))
        self.files, path = open_fs(uri)
        make_parent(self.files, path)
        self.streams = [self.files.open_output_stream(p, compression=None) for p in (path, f"{path}.documents")]
        self.out, self.index = pa.ipc.new_file(self.streams[0], self.schema), pa.ipc.new_file(self.streams[1], _INDEX)
        self.held, self.rows, self.tokens, self.documents, self.sequences = bytearray(), [], 0, 0, 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        n = len(ids) // self.kind.itemsize
        self.rows.append((doc_id, self.tokens, n))
        self.held += ids
        self.tokens += n
        self.documents += 1
        full = self.length * _SEQUENCES_PER_BATCH * self.kind.itemsize
        while len(self.held) >= full:
            self._write(bytes(self.held[:full]))
            del self.held[:full]
        if len(self.rows) >= 50_000:
            self._write_rows()

    def _write(self, data: bytes) -> None:
        ids = np.frombuffer(data, self.kind)
        n = -(-len(ids) // self.length)
        mask = np.arange(n * self.length) < len(ids)
        ids = np.pad(ids, (0, n * self.length - len(ids)))
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), type=f.type) for x, f in zip((ids, mask), self.schema)]
        self.out.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))
        self.sequences += n

    def _write_rows(self) -> None:
        columns = [pa.array(c, f.type) for c, f in zip(zip(*self.rows), _INDEX)]
        self.index.write_batch(pa.RecordBatch.from_arrays(columns, schema=_INDEX))
        self.rows = []

    def close(self) -> None:
        if self.held:
            self._write(bytes(self.held))
        if self.rows:
            self._write_rows()
        for x in (self.out, self.index, *self.streams):
            x.close()


class TokenFile:
    """Random access to the sequences of one file; a local file is mapped, so nothing is copied."""

    def __init__(self, uri: str):
        files, path = open_fs(uri)
        local = files.type_name == "local"
        source, index = (pa.memory_map(p) if local else files.open_input_file(p) for p in (path, f"{path}.documents"))
        self.reader, self.index = pa.ipc.open_file(source), pa.ipc.open_file(index)
        self.length = self.reader.schema.field("ids").type.list_size

    def batches(self):
        """The ids of batch after batch as one array each, with whatever fills the last sequence."""
        for i in range(self.reader.num_record_batches):
            yield self.reader.get_batch(i).column("ids").flatten().to_numpy()

    def sequence(self, at: int) -> tuple[np.ndarray, pa.Array]:
        """Sequence number ``at`` of the file: ids and mask."""
        batch = self.reader.get_batch(at // _SEQUENCES_PER_BATCH)
        row = at % _SEQUENCES_PER_BATCH
        ids, mask = (batch.column(i).flatten().slice(row * self.length, self.length) for i in (0, 1))
        return ids.to_numpy(), mask

    def documents(self):
        """doc_id, start, and the ids of document after document."""
        batches, data, base = self.batches(), np.zeros(0, np.uint32), 0
        for i in range(self.index.num_record_batches):
            for row in self.index.get_batch(i).to_pylist():
                start, end, parts = row["start"], row["start"] + row["n_tokens"], []
                while start < end:
                    while start >= base + len(data):
                        base += len(data)
                        data = next(batches)
                    parts.append(data[start - base : end - base])
                    start += len(parts[-1])
                yield row["doc_id"], row["start"], np.concatenate(parts) if len(parts) != 1 else parts[0]


def write_token_files(documents: DataFrame, folder: str, tokenizer: str, kind: str, end_id: int, vocabulary: int,
                      length: int = 2048, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode whole texts, put ``end_id`` after each, write the files and return their written list in order.

    A null text is an empty one. Null ids come first; rows with the same id are documents of their own, side by
    side. Other columns are not looked at. An empty table makes no file. Ids take two bytes if the vocabulary allows.
    """
    width = 2 if vocabulary <= 1 << 16 else 4
    end = np.array([end_id], f"<u{width}").tobytes()

    def write(batches):
        out, part = None, TaskContext.get().partitionId()
        uri = f"{folder}/{part:06d}-{uuid.uuid4().hex}.arrow"
        coder = encoder(tokenizer, kind, width)
        for batch in batches:
            ids, at = batch.column("doc_id").to_pylist(), 0
            for some in in_pieces(batch.column("text")):
                for coded in coder.encode(some):
                    out = out or Writer(uri, length, width)
                    out.add(ids[at], coded + end)
                    at += 1
        if out:
            out.close()
            row = {"part": [part], "path": [uri], "documents": [out.documents], "tokens": [out.tokens], "sequences": [out.sequences]}
            yield pa.RecordBatch.from_pydict(row, pa.schema([("part", pa.int32()), ("path", pa.string()), *((k, pa.int64()) for k in list(row)[2:])]))

    source = documents.select(F.col(doc_id).cast("long").alias("doc_id"), whole(text).alias("text"))
    dealt = source.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return written(dealt.mapInArrow(write, MANIFEST), "tokenfiles")


def read_token_files(files: DataFrame) -> DataFrame:
    """Read listed files back: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, a row a document."""
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    based = files.select("path", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("base"))

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                found = []
                for doc_id, start, ids in TokenFile(row["path"]).documents():
                    found.append((doc_id, row["base"] + start, len(ids), zlib.crc32(ids.astype("<u4"))))
                    if len(found) == 20_000:
                        yield rows(found)
                        found = []
                if found:
                    yield rows(found)

    def rows(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return based.repartition(max(1, files.count())).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
