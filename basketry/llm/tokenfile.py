"""Token-id files: fixed-size id chunks as byte or bit planes, each plane
compressed with zstandard, and an index of the chunks.

Layout of a file: magic; the planes of each chunk one after another; the
document table (ids, null marks and lengths, one zstandard frame each); the
index as JSON in a zstandard frame (per chunk: offset, number of ids, size of
each plane, CRC-32 of the ids; place of the document table); the index's
length (8 bytes, little-endian) and the magic again.

Documents are range-partitioned and sorted by id; each task writes one file
under a name of its own in the shared folder and returns it in a manifest, so
a repeated task leaves no trace in the result.  Tasks stream: a chunk of ids
is all they hold.

Defined results: a null or empty text is the end id alone; doc_ids are integers
(a table with others is refused before anything is read); null doc_ids come
first; repeated ids keep a row each, next to each other; an empty table
gives no rows; other columns are ignored.
"""
from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from .common import fresh_path, open_fs, written
from .encode import encoder

MAGIC = b"IDPLANE1"
CHUNK = 1 << 16


def to_planes(ids: np.ndarray, bits: bool) -> list[bytes]:
    """Byte or bit planes of unsigned 32-bit ids, low plane first; planes above
    the highest used one are left out."""
    raw = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if not bits:
        used = max(1, -(-int(ids.max()).bit_length() // 8)) if len(ids) else 1
        return [np.ascontiguousarray(raw[:, k]).tobytes() for k in range(used)]
    used = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    table = np.unpackbits(raw, axis=1, bitorder="little")
    return [np.packbits(np.ascontiguousarray(table[:, k])).tobytes() for k in range(used)]


def from_planes(planes: list[bytes], n: int, bits: bool) -> np.ndarray:
    if not bits:
        raw = np.zeros((n, 4), np.uint8)
        for k, p in enumerate(planes):
            raw[:, k] = np.frombuffer(p, np.uint8)
    else:
        table = np.zeros((n, 32), np.uint8)
        for k, p in enumerate(planes):
            table[:, k] = np.unpackbits(np.frombuffer(p, np.uint8), count=n)
        raw = np.packbits(table, axis=1, bitorder="little")
    return raw.reshape(-1).view("<u4")


class PlaneWriter:
    """Writes one file to a binary stream."""

    def __init__(self, stream, bits: bool = False, level: int = 3, chunk: int = CHUNK):
        import zstandard
        self.stream, self.bits, self.chunk = stream, bits, chunk
        self.pack = zstandard.ZstdCompressor(level=level, write_checksum=False).compress
        self.at = self.total = 0
        self.rest, self.chunks, self.doc_ids, self.lengths = bytearray(), [], [], []
        self._put(MAGIC)

    def _put(self, data: bytes) -> None:
        self.stream.write(data)
        self.at += len(data)

    def add(self, doc_id, ids: bytes) -> None:
        self.doc_ids.append(doc_id)
        self.lengths.append(len(ids) // 4)
        self.total += len(ids) // 4
        self.rest += ids
        size = 4 * self.chunk
        full = len(self.rest) // size * size
        for k in range(0, full, size):
            self._chunk(bytes(self.rest[k:k + size]))
        del self.rest[:full]

    def _chunk(self, ids: bytes) -> None:
        planes = [self.pack(p) for p in to_planes(np.frombuffer(ids, "<u4"), self.bits)]
        self.chunks.append([self.at, len(ids) // 4, [len(p) for p in planes], zlib.crc32(ids)])
        for p in planes:
            self._put(p)

    def close(self) -> None:
        if self.rest:
            self._chunk(bytes(self.rest))
        docs = []
        for column in (np.array([0 if d is None else d for d in self.doc_ids], "<i8"),
                       np.packbits(np.array([d is None for d in self.doc_ids], bool)),
                       np.array(self.lengths, "<u8")):
            data = self.pack(column.tobytes())
            docs.append([self.at, len(data)])
            self._put(data)
        index = self.pack(json.dumps({"bits": self.bits, "chunks": self.chunks, "docs": docs,
                                      "n_docs": len(self.lengths)}).encode())
        self._put(index + len(index).to_bytes(8, "little") + MAGIC)


class PlaneReader:
    """Reads one file from a seekable binary stream; any chunk by its index."""

    def __init__(self, stream):
        import zstandard
        self.stream = stream
        self.unpack = zstandard.ZstdDecompressor().decompress
        end = stream.seek(0, 2)
        if end < 24 or self._get(end - 8, 8) != MAGIC or self._get(0, 8) != MAGIC:
            raise ValueError("not a token-id file")
        size = int.from_bytes(self._get(end - 16, 8), "little")
        self.index = json.loads(self.unpack(self._get(end - 16 - size, size)))
        ids, nulls, lengths = (self.unpack(self._get(*place)) for place in self.index["docs"])
        n = self.index["n_docs"]
        self.doc_ids = np.frombuffer(ids, "<i8")
        self.nulls = np.unpackbits(np.frombuffer(nulls, np.uint8), count=n).astype(bool)
        self.lengths = np.frombuffer(lengths, "<u8").astype(np.int64)
        if sum(c[1] for c in self.index["chunks"]) != int(self.lengths.sum()):
            raise ValueError("document lengths and chunks disagree")

    def _get(self, at: int, n: int) -> bytes:
        self.stream.seek(at)
        return self.stream.read(n)

    def chunk(self, k: int) -> np.ndarray:
        at, n, sizes, crc = self.index["chunks"][k]
        planes = []
        for size in sizes:
            planes.append(self.unpack(self._get(at, size)))
            at += size
        ids = from_planes(planes, n, self.index["bits"])
        if zlib.crc32(ids.tobytes()) != crc:
            raise ValueError(f"chunk {k} is damaged")
        return ids

    def documents(self) -> Iterator[tuple[int, int, int]]:
        """(length, start in the file, CRC-32 of the ids) per document."""
        k, ids, used, start = -1, memoryview(b""), 0, 0
        for n in map(int, self.lengths):
            crc, need = 0, 4 * n
            while need:
                if used == len(ids):
                    k, used = k + 1, 0
                    ids = memoryview(self.chunk(k).tobytes())
                take = min(need, len(ids) - used)
                crc = zlib.crc32(ids[used:used + take], crc)
                used, need = used + take, need - take
            yield n, start, crc
            start += n


def write_files(docs: DataFrame, vocabulary: str = "word_bpe_49k.json", end_id: int = 1, bits: bool = False,
                folder: str | None = None) -> DataFrame:
    """Writes all documents in ascending id order; returns the manifest
    ``part, path, n_docs, n_ids, first_id`` (ids in the files before)."""
    if not isinstance(docs.schema["doc_id"].dataType, T.IntegralType):
        raise TypeError("doc_id must be of an integer type")
    folder = folder or fresh_path(docs.sparkSession, "token-files")
    tail = end_id.to_bytes(4, "little")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, fs_path = encoder(vocabulary), open_fs(folder)
        fs, base = fs_path
        path, stream, writer = f"{base}/ids-{uuid.uuid4().hex}.planes", None, None
        for batch in batches:
            if stream is None and batch.num_rows:
                fs.create_dir(base, recursive=True)
                stream = fs.open_output_stream(path, compression=None)
                writer = PlaneWriter(stream, bits)
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                writer.add(doc_id.as_py(), code.ids(text.as_py()) + tail)
        if writer is not None:
            writer.close()
            stream.close()
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([TaskContext.get().partitionId()], pa.int32()), "path": [path],
                "n_docs": pa.array([len(writer.lengths)], pa.int64()), "n_ids": pa.array([writer.total], pa.int64())})

    ranged = (docs.select("doc_id", "text", F.rand(7).alias("_tie"))
              .repartitionByRange(F.col("doc_id").asc_nulls_first(), "_tie")
              .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "_tie").drop("_tie"))
    files = written(ranged.mapInArrow(write, "part int, path string, n_docs long, n_ids long"), "token-manifest")
    # one row per file, so the unpartitioned window is small
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    return files.select("*", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("first_id"))


def read_files(manifest: DataFrame, scheme_of: str) -> DataFrame:
    """Reads the manifest's files back: ``doc_id, start, n_tokens, ids_crc32``.
    ``scheme_of``: a URI of the store that holds them."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = open_fs(scheme_of)
        for batch in batches:
            for path, first in zip(batch.column("path").to_pylist(), batch.column("first_id").to_pylist()):
                with fs.open_input_file(path) as stream:
                    reader = PlaneReader(stream)
                    rows = np.array(list(reader.documents()), np.int64).reshape(-1, 3)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(reader.doc_ids, mask=reader.nulls), pa.array(rows[:, 1] + first),
                     pa.array(rows[:, 0]), pa.array(rows[:, 2])], ["doc_id", "start", "n_tokens", "ids_crc32"])
    files = max(1, manifest.count())
    return manifest.select("path", "first_id").repartition(files).mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long")
