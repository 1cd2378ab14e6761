"""WARC archives compressed with zstandard: one dictionary, one frame per
record.

An archive starts with a skippable frame (magic 0x184D2A5D) that holds the
dictionary, itself in a zstandard frame; each record follows in a frame of its
own, made with that dictionary.  The reader loads the dictionary from the
leading skippable frame, decodes frame by frame, and checks version line,
mandatory headers, lengths, the record's end and its digests.

Of records with equal payloads of at least ``REVISIT_BYTES``, the one with the
largest page_id is a response and the others are revisits that refer to it.

Each writing task streams its rows into archives under names of its own in
the shared folder and returns them in a manifest, so a repeated task leaves no
trace in the result; readers stream one archive record by record.

Defined results: null html is an empty payload, a null url an empty target;
a null page_id gets a record id without a number and is never referred to
while another page has the payload; rows repeated with the largest page_id of
their payload are responses each; an empty table gives no archives and no
rows; other columns are ignored.
"""
from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh_path, hash_sample, open_fs, written

SKIPPABLE = (0x184D2A5D).to_bytes(4, "little")
REVISIT_BYTES = 1000
ARCHIVE_BYTES = 256 << 20
#: The dictionary is learned from so many pages and leading bytes of each.
SAMPLE_PAGES, SAMPLE_BYTES, DICT_BYTES = 512, 16384, 65536
DATE = "2024-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANDATORY = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")


class WarcError(ValueError):
    """An archive or record that breaks the format."""


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(record: str | None) -> int | None:
    if not record or record == record_id(None):
        return None
    if not (record.startswith("<urn:page:") and record.endswith(">")):
        raise WarcError(f"record id {record!r}")
    return int(record[len("<urn:page:"):-1])


def make_record(page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """One record: a response with its HTTP block, or a revisit (``refers_to``
    given) with the HTTP header alone."""
    block = HTTP % len(payload) + (b"" if refers_to is not None else payload)
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}",
            f"WARC-Target-URI: {quote(url or '', safe=':/?#[]@!$&()*+,;=%~-._' + chr(39))}",
            f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{hashlib.sha1(block).hexdigest()}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if refers_to is not None:
        head[2:2] = [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {PROFILE}",
                     f"WARC-Refers-To-Payload-Length: {len(payload)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, block) of one whole record, checked."""
    end = data.find(b"\r\n\r\n")
    lines = data[:end].decode("utf-8").split("\r\n") if end >= 0 else []
    if not lines or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise WarcError("no version line or header end")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name or name in headers:
            raise WarcError(f"header line {line!r}")
        headers[name] = value.strip()
    for name in MANDATORY:
        if name not in headers:
            raise WarcError(f"{name} is missing")
    if not headers["Content-Length"].isdecimal():
        raise WarcError("Content-Length is not a number")
    stop = end + 4 + int(headers["Content-Length"])
    if data[stop:] != b"\r\n\r\n":
        raise WarcError("Content-Length and the record's end disagree")
    block = data[end + 4:stop]
    if headers.get("WARC-Block-Digest", "sha1:") != "sha1:" + hashlib.sha1(block).hexdigest():
        raise WarcError("block digest")
    return headers, block


def payload_facts(headers: dict[str, str], block: bytes) -> tuple[int, str]:
    """(bytes, SHA-1) of the full payload, from a response's block or from a
    revisit's headers."""
    digest = headers.get("WARC-Payload-Digest", "")
    if not digest.startswith("sha1:"):
        raise WarcError("payload digest is missing")
    if headers["WARC-Type"] == "revisit":
        if "WARC-Refers-To" not in headers or "WARC-Profile" not in headers:
            raise WarcError("a revisit without WARC-Refers-To or WARC-Profile")
        return int(headers["WARC-Refers-To-Payload-Length"]), digest[5:]
    if headers["WARC-Type"] != "response":
        raise WarcError(f"record type {headers['WARC-Type']!r}")
    end = block.find(b"\r\n\r\n")
    if end < 0 or not block.startswith(b"HTTP/"):
        raise WarcError("no HTTP header")
    payload = block[end + 4:]
    if hashlib.sha1(payload).hexdigest() != digest[5:]:
        raise WarcError("payload digest")
    return len(payload), digest[5:]


class ArchiveWriter:
    def __init__(self, stream, dictionary: bytes, level: int = 3):
        import zstandard
        self.stream, self.size = stream, 0
        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.frame = zstandard.ZstdCompressor(level=level, dict_data=known, write_checksum=True).compress
        if dictionary:
            packed = zstandard.ZstdCompressor(level=19).compress(dictionary)
            self._put(SKIPPABLE + len(packed).to_bytes(4, "little") + packed)

    def _put(self, data: bytes) -> None:
        self.stream.write(data)
        self.size += len(data)

    def add(self, record: bytes) -> None:
        self._put(self.frame(record))


def read_archive(stream, piece: int = 1 << 20) -> Iterator[bytes]:
    """Decoded records of an archive, one per frame, holding one at a time."""
    import zstandard
    head = stream.read(8)
    known, rest = None, head
    if head[:4] == SKIPPABLE:
        size = int.from_bytes(head[4:], "little")
        packed = stream.read(size)
        if len(packed) != size:
            raise WarcError("the dictionary frame is cut off")
        plain = zstandard.ZstdDecompressor().decompress(packed) if packed[:4] == b"\x28\xb5\x2f\xfd" else packed
        known, rest = zstandard.ZstdCompressionDict(plain), b""
    decoder = zstandard.ZstdDecompressor(dict_data=known)
    while True:
        rest = rest or stream.read(piece)
        if not rest:
            return
        frame, parts = decoder.decompressobj(), []
        try:
            while not frame.eof:
                if not rest:
                    rest = stream.read(piece)
                    if not rest:
                        raise WarcError("the last frame is cut off")
                parts.append(frame.decompress(rest))
                rest = frame.unused_data if frame.eof else b""
        except zstandard.ZstdError as e:
            raise WarcError(f"frame: {e}") from e
        yield b"".join(parts)


def learn_dictionary(pages: DataFrame) -> bytes:
    """A dictionary from a bounded sample of pages (empty if they are too few
    or too small to learn from)."""
    import zstandard
    heads = pages.filter(F.length("html") > 0).select(
        "page_id", F.substring(F.col("html").cast("binary"), 1, SAMPLE_BYTES).alias("b"))
    few = hash_sample(heads, F.col("page_id"), SAMPLE_PAGES).collect()
    try:
        return zstandard.train_dictionary(DICT_BYTES, [bytes(r["b"]) for r in few]).as_bytes()
    except zstandard.ZstdError:
        return b""


def with_revisits(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """Adds ``digest`` and ``refers_to`` (null for responses)."""
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", body.alias("payload"), F.sha1(body).alias("digest"))
    groups = (pages.select("page_id", F.sha1(body).alias("digest"), F.octet_length(body).alias("n"))
              .filter(F.col("n") >= least).groupBy("digest")
              .agg(F.max("page_id").alias("kept"), F.count("*").alias("n")).filter("n > 1").drop("n"))
    # the rows' side may hold a hot digest, which the join can split
    return rows.join(groups, "digest", "left").select(
        "page_id", "url", "payload", "digest",
        F.when(~F.col("page_id").eqNullSafe(F.col("kept")), F.col("kept")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes a record per page; returns the manifest ``path, records``."""
    spark = pages.sparkSession
    folder = folder or fresh_path(spark, "warc")
    dictionary = spark.sparkContext.broadcast(learn_dictionary(pages))  # at most DICT_BYTES

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_fs(folder)
        path, stream, writer, done, count = "", None, None, [], 0

        def close():
            if stream is not None:
                stream.close()
                done.append((path, count))
        for batch in batches:
            for page, url, payload, digest, refers in zip(*(batch.column(c) for c in batch.schema.names)):
                if writer is None or writer.size >= ARCHIVE_BYTES:
                    close()
                    fs.create_dir(base, recursive=True)
                    path, count = f"{base}/pages-{uuid.uuid4().hex}.warc.zst", 0
                    stream = fs.open_output_stream(path, compression=None)
                    writer = ArchiveWriter(stream, dictionary.value)
                writer.add(make_record(page.as_py(), url.as_py(), payload.as_py(), digest.as_py(), refers.as_py()))
                count += 1
        close()
        yield pa.RecordBatch.from_pydict({"path": pa.array([p for p, _ in done], pa.string()),
                                          "records": pa.array([n for _, n in done], pa.int64())})
    return written(with_revisits(pages).mapInArrow(write, "path string, records long"), "warc-manifest")


def read_archives(manifest: DataFrame, store: str) -> DataFrame:
    """One row per record of the manifest's archives: ``page_id, url,
    payload_bytes, payload_digest, record_type, refers_to``.  ``store``: a URI
    of the store that holds them."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = open_fs(store)
        for batch in batches:
            for path, records in zip(batch.column("path").to_pylist(), batch.column("records").to_pylist()):
                rows = []
                with fs.open_input_stream(path, compression=None) as stream:
                    for data in read_archive(stream):
                        headers, block = parse_record(data)
                        size, digest = payload_facts(headers, block)
                        rows.append((page_of(headers["WARC-Record-ID"]), headers.get("WARC-Target-URI"), size, digest,
                                     headers["WARC-Type"], page_of(headers.get("WARC-Refers-To"))))
                if len(rows) != records:
                    raise WarcError(f"{path} holds {len(rows)} records, not {records}")
                columns = list(zip(*rows)) or [()] * 6
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.int64(), pa.string(),
                                                              pa.string(), pa.int64()))],
                    ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"])
    files = max(1, manifest.count())
    return manifest.repartition(files).mapInArrow(
        read, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long")
