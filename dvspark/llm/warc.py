"""WARC archives with dictionary-compressed records (.warc.zst), and back.

Writer: each task takes its pages, builds a Zstandard dictionary from the
records it is about to archive, puts it in a leading skippable frame (magic
0x184D2A5D) and compresses every record as a frame of its own, so any record
can be read alone given its offset.  An archive is closed at ``archive_bytes``
of content and a new one begun, with its own dictionary.  Files appear in the
shared folder when complete; a task that runs twice leaves a file that the
list of archives doesn't name.

Equal payloads: the row with the largest page_id is the response, the others
are revisits that refer to it, found by one aggregate on the digest and a join
back; payloads below ``least`` bytes are always responses.

Reader: one archive after another, record by record; the payload of a response
is checked against its digest.

Defined cases: null html is the empty payload; rows that repeat the largest
page_id of their payload are responses each; a null page_id is smaller than
any other, and a record without page_id reads back as null; a null url is left
out; an empty table writes no archive; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dvspark.llm.common import stored
from dvspark.llm.shared_files import get, put
from dvspark.session import work_path

ARCHIVE_BYTES = 24 << 20
DICTIONARY_BYTES = 64 << 10
#: Bytes of records that a dictionary is built from.
TRAINING_BYTES = 4 << 20
LEVEL = 3
_MAGIC = (0x184D2A5D).to_bytes(4, "little")
DATE = "2024-01-01T00:00:00Z"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def with_revisits(pages: DataFrame, least: int = 0) -> DataFrame:
    """page_id, url, html (empty for null), refers_to, is_revisit of every page."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.when(F.octet_length("html") >= least, F.unhex(F.sha1("html"))))
    # Only payloads that occur under several ids matter: unique ones never meet a join partner.
    latest = rows.where("digest IS NOT NULL").groupBy("digest").agg(F.max("page_id").alias("latest"), F.count(F.lit(1)).alias("n")).where("n > 1 AND latest IS NOT NULL").drop("n")
    marked = rows.join(latest, "digest", "left")
    revisit = F.col("latest").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") < F.col("latest")))
    return marked.select("page_id", "url", "html", F.when(revisit, F.col("latest")).alias("refers_to"))


def _name(page_id: int | None) -> str:
    return f"<urn:page:{page_id}>" if page_id is not None else f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, 'page')}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC/1.1 record: the payload behind an HTTP header, or the header alone for a revisit."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    head = [f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_name(page_id)}", f"WARC-Date: {DATE}", "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest_of(payload)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        head += [f"WARC-Refers-To: {_name(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(["WARC/1.1", *head, "", ""]).encode() + block + b"\r\n\r\n"


def dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """Built from records spread over the archive; None where they are too few or too small for one."""
    size, step = sum(map(len, records)), 1
    while size // step > TRAINING_BYTES:
        step += 1
    sample = records[::step]
    target = min(DICTIONARY_BYTES, sum(map(len, sample)) // 50)
    if len(sample) < 16 or target < 1024:
        return None
    try:
        return zstandard.train_dictionary(target, sample, k=200, d=8)
    except zstandard.ZstdError:
        return None  # e.g. all records alike


def archive(records: list[bytes]) -> bytes:
    own = dictionary(records)
    out = io.BytesIO()
    if own is not None:
        data = own.as_bytes()
        out.write(_MAGIC + len(data).to_bytes(4, "little") + data)
    compress = zstandard.ZstdCompressor(level=LEVEL, dict_data=own, write_content_size=True, write_checksum=True).compress
    for r in records:
        out.write(compress(r))
    return out.getvalue()


def _write(batches: Iterator[pa.RecordBatch], folder: str, archive_bytes: int) -> Iterator[pa.RecordBatch]:
    held: list[bytes] = []
    size = 0

    def flush() -> pa.RecordBatch:
        path = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        data = archive(held)
        put(path, data)
        return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([len(held)], pa.int64()), pa.array([size], pa.int64()), pa.array([len(data)], pa.int64())], names=["path", "records", "bytes", "stored_bytes"])

    for batch in batches:
        for page_id, url, html, refers_to in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
            held.append(record(page_id, url, html.encode("utf-8", "surrogatepass"), refers_to))
            size += len(held[-1])
            if size >= archive_bytes:
                yield flush()
                held, size = [], 0
    if held:
        yield flush()


def write_archives(pages: DataFrame, folder: str | None = None, least: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes the pages; returns path, records, bytes, stored_bytes of each archive."""
    folder = folder or work_path(pages.sparkSession, "warc")
    schema = "path string, records long, bytes long, stored_bytes long"
    return stored(with_revisits(pages, least).mapInArrow(lambda batches: _write(batches, folder, archive_bytes), schema), "warc-list")


def read_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record of an archive."""
    own, at = None, 0
    if data[:4] == _MAGIC:
        size = int.from_bytes(data[4:8], "little")
        own, at = zstandard.ZstdCompressionDict(data[8 : 8 + size]), 8 + size
    with zstandard.ZstdDecompressor(dict_data=own).stream_reader(memoryview(data)[at:], read_across_frames=True) as raw, io.BufferedReader(raw, 1 << 20) as stream:
        while line := stream.readline():
            if line.rstrip(b"\r\n") != b"WARC/1.1":
                raise ValueError(f"no WARC record begins with {line[:40]!r}")
            head: dict[str, str] = {}
            while (line := stream.readline().rstrip(b"\r\n")):
                key, _, value = line.decode().partition(":")
                head[key] = value.strip()
            block = stream.read(int(head["Content-Length"]))
            stream.read(4)
            yield head, block


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = lambda name: int(name[len("<urn:page:") : -1]) if name and name.startswith("<urn:page:") else None
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
    for batch in batches:
        for path in batch.column(0).to_pylist():
            rows = []
            for head, block in read_records(get(path)):
                http, _, payload = block.partition(b"\r\n\r\n")
                length = int(http.rpartition(b"Content-Length: ")[2])
                digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                if head["WARC-Type"] == "response" and (len(payload) != length or digest_of(payload) != digest):
                    raise ValueError(f"{path}: payload of {head['WARC-Record-ID']} doesn't match its digest")
                rows.append((number(head["WARC-Record-ID"]), length, digest, head["WARC-Type"], number(head.get("WARC-Refers-To")), head.get("WARC-Target-URI")))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def read_archives(archives: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, url of every record of the listed archives."""
    paths = archives.select("path")
    files = paths.count()
    return paths.repartition(max(1, files)).mapInArrow(_read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string")
