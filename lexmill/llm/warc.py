"""WARC archives as a chunked record table.

An archive is a table of rows (archive, record, chunk, data): the data of one archive, in order of record and chunk, are
the bytes of a WARC/1.1 file.  A record of at most ``chunk_bytes`` is one row; an oversized payload goes out as further
rows of at most that size, each carrying the SHA-1 of the payload so far, so neither writer nor reader builds a whole
record.  One archive is written for each task, by Spark's own committer, so a lost task leaves nothing behind.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.scratch import materialise

CHUNK = 1 << 20
REVISIT_LEAST = 1000
BROADCAST_ROWS = 1 << 20
END = b"\r\n\r\n"
TABLE = "archive int, record long, chunk int, last boolean, data binary, digest string"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(f'{page_id}|{digest}'.encode()).digest())}>"


def _uri(url: str | None, page_id: int | None) -> str:
    """A header-safe target: spaces and control characters are percent-encoded."""
    if not url:
        return f"urn:page:{page_id}"
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def header(page_id: int | None, url: str | None, size: int, digest: str, refers_to: int | None, date: str) -> bytes:
    """WARC and HTTP header blocks of a record; a revisit holds the HTTP header alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {_uri(url, page_id)}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if page_id is not None:
        lines.append(f"WARC-Page-ID: {page_id}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}", f"WARC-Refers-To-Page-ID: {refers_to}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + (size if refers_to is None else 0)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http


def parse_header(data: bytes) -> tuple[dict[str, str], int]:
    """Fields of a WARC record and its HTTP header (the latter as ``http-...``), and where the payload starts."""
    end = data.index(END)
    first, *lines = data[:end].decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("no WARC record")
    fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    start = end + 4
    if fields.get("content-type", "").startswith("application/http"):
        stop = data.index(END, start)
        for x in data[start:stop].decode().split("\r\n")[1:]:
            k, _, v = x.partition(":")
            fields["http-" + k.lower()] = v.strip()
        start = stop + 4
    return fields, start


def write_archives(pages: DataFrame, chunk_bytes: int = CHUNK, least: int = REVISIT_LEAST, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """The archive table of ``pages`` (page_id, url, html), written into the shared folder.

    A null html is an empty payload.  Of records with equal payloads of at least ``least`` bytes, that with the largest
    page_id is the response (every row with that page_id, if it is repeated) and the others revisit it; smaller ones, and
    rows with a null page_id, are all responses.
    """
    body = F.coalesce(F.col("html"), F.lit(""))
    keyed = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), body.alias("html")).withColumn("digest", F.sha1(F.col("html").cast("binary")))
    large = keyed.filter((F.octet_length("html") >= least) & F.col("page_id").isNotNull())
    shared = large.groupBy("digest").agg(F.max("page_id").alias("response"), F.min("page_id").alias("first")).filter("first < response").select("digest", "response")
    shared = materialise(shared, "shared-payloads")
    small = shared.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    marked = keyed.join(F.broadcast(shared) if small else shared, "digest", "left")  # broadcast at most BROADCAST_ROWS rows
    refers = F.when(F.col("page_id") < F.col("response"), F.col("response"))
    marked = marked.select("page_id", "url", "html", "digest", refers.alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, n = TaskContext.get().partitionId(), 0
        held: list[tuple] = []
        size = 0
        for batch in batches:
            ids, urls, digests, refs = (batch.column(i).to_pylist() for i in (0, 1, 3, 4))
            for i in range(len(batch)):
                raw = memoryview(batch.column(2)[i].as_buffer())
                head = header(ids[i], urls[i], len(raw), digests[i], refs[i], date)
                if refs[i] is not None or len(raw) <= chunk_bytes:
                    held.append((archive, n, 0, True, head + (b"" if refs[i] is not None else bytes(raw)) + END, digests[i]))
                    size += len(held[-1][4])
                else:
                    held.append((archive, n, 0, False, head, None))
                    so_far = hashlib.sha1()
                    for k, lo in enumerate(range(0, len(raw), chunk_bytes), 1):
                        piece = raw[lo : lo + chunk_bytes]
                        so_far.update(piece)
                        done = lo + chunk_bytes >= len(raw)
                        held.append((archive, n, k, done, bytes(piece) + (END if done else b""), so_far.hexdigest()))
                        size += len(piece)
                        if size >= 4 * chunk_bytes:
                            yield _rows(held)
                            held, size = [], 0
                n += 1
                if size >= 4 * chunk_bytes:
                    yield _rows(held)
                    held, size = [], 0
        if held:
            yield _rows(held)

    return materialise(marked.mapInArrow(run, TABLE), "warc")


def _rows(held: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int64(), pa.int32(), pa.bool_(), pa.binary(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), kinds)], names=["archive", "record", "chunk", "last", "data", "digest"])


class _Reader:
    """Takes the chunks of records in order and gives a row for each record that is complete."""

    def __init__(self) -> None:
        self.fields: dict[str, str] | None = None

    def take(self, chunk: int, last: bool, data: bytes, digest: str | None) -> tuple | None:
        view = memoryview(data)
        if chunk == 0:
            self.fields, start = parse_header(data)
            self.sha, self.size, self.next = hashlib.sha1(), 0, 0
            view = view[start:]
        if self.fields is None or chunk != self.next:
            raise ValueError("a chunk of the record is missing")
        self.next += 1
        if last:
            if bytes(view[-4:]) != END:
                raise ValueError("the record has no end")
            view = view[:-4]
        self.sha.update(view)
        self.size += len(view)
        f = self.fields
        if f["warc-type"] == "response" and digest is not None and self.sha.hexdigest() != digest:
            raise ValueError(f"digest differs after {self.size} bytes of {f['warc-record-id']}")
        if not last:
            return None
        self.fields = None
        page, of = f.get("warc-page-id"), f.get("warc-refers-to-page-id")
        want = f["warc-payload-digest"].removeprefix("sha1:")
        if f["warc-type"] == "response":
            if self.sha.hexdigest() != want or self.size != int(f["http-content-length"]):
                raise ValueError(f"payload of {f['warc-record-id']} differs from its header")
        return (None if page is None else int(page), int(f["http-content-length"]), want, f["warc-type"], None if of is None else int(of))


RESULT = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_archives(table: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of each record, checked against its bytes.

    Records of one row are read where they lie; only those of several chunks are brought together, in order of chunk.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader()
        for batch in batches:
            out = []
            chunks, lasts, digests = (batch.column(i).to_pylist() for i in (2, 3, 5))
            data = batch.column(4)
            for i in range(len(batch)):
                row = reader.take(chunks[i], lasts[i], data[i].as_py(), digests[i])
                if row:
                    out.append(row)
            cols = list(zip(*out)) if out else [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    whole = (F.col("chunk") == 0) & F.col("last")
    several = table.filter(~whole).repartition("archive", "record").sortWithinPartitions("archive", "record", "chunk")
    return table.filter(whole).mapInArrow(run, RESULT).unionByName(several.mapInArrow(run, RESULT))


def archive_stream(table: DataFrame, archive: int) -> Iterator[bytes]:
    """The bytes of one archive as a WARC file, chunk by chunk."""
    for row in table.filter(F.col("archive") == archive).orderBy("record", "chunk").select("data").toLocalIterator():
        yield bytes(row["data"])


def parse_stream(pieces: Iterable[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, payload) of each record of the bytes of a WARC file; one record is held at a time.

    ``parse_chunks`` gives payloads that needn't fit into memory in pieces.
    """
    held: list[bytes] = []
    for fields, piece, last in parse_chunks(pieces):
        held.append(piece)
        if last:
            yield fields, b"".join(held)
            held = []


def parse_chunks(pieces: Iterable[bytes]) -> Iterator[tuple[dict[str, str], bytes, bool]]:
    """(fields, piece of the payload, whether it is the last) of the records of a WARC file, holding one input piece."""
    source = iter(pieces)
    data = bytearray()

    def more() -> bool:
        piece = next(source, None)
        if piece is not None:
            data.extend(piece)
        return piece is not None

    while data or more():
        while (end := data.find(END)) < 0:
            if not more():
                raise ValueError("the record has no header")
        left = end + 4  # to the payload's end, from the record's start
        length = None
        while length is None:
            try:
                fields, start = parse_header(bytes(data[: max(left, 1 << 16)]))
                length = end + 4 + int(fields["content-length"]) - start
            except (ValueError, IndexError):
                if not more():
                    raise
        del data[:start]
        while length > len(data):
            if data:
                length -= len(data)
                yield fields, bytes(data), False
                data.clear()
            if not more():
                raise ValueError("the record is cut")
        yield fields, bytes(data[:length]), True
        del data[:length]
        while len(data) < 4:
            if not more():
                raise ValueError("the record has no end")
        if data[:4] != END:
            raise ValueError("the record has no end")
        del data[:4]
