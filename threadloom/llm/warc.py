"""WARC records packed in ZIP archives: a distributed writer, and a reader by directories and ranges.

An archive stores ``archive/data.warc.gz`` (each record gzipped by itself) and ``indexes/index.cdxj`` (a
line with place and length of each record). The reader parses the directories of each archive, finds its members
and indexes, and reads records by their ranges; archives are never extracted or read as a whole.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import itertools
import json
import re
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField

from threadloom.llm.arrow import add_columns, raw
from threadloom.llm.zip_directory import STORED, data_start, directory, filesystem, read_range
from threadloom.session import fresh_folder, stored

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
#: An archive is closed once it has so many bytes.
ARCHIVE_BYTES = 512 << 20
#: Bytes of packed records that one task reads.
READ_BYTES = 8 << 20
#: Cells of neighbouring records that a part is dealt, on average, and the most parts of a read.
CELLS, MOST_PARTS = 8, 50_000
#: Bytes of a range that are read at a time.
PIECE_BYTES = 4 << 20
#: Records of a batch that a task returns.
BATCH_RECORDS = 10_000
DATE = "1970-01-01T00:00:00Z"
RECORD = "page_id long, record_type string, refers_to long, payload_digest string, payload_bytes long, url string, payload binary"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def urn(page: int | None) -> str:
    return f"<urn:page:{'' if page is None else page}>"


def page_of(value: str) -> int | None:
    number = value.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def warc_record(page: int | None, url: str | None, payload: bytes, name: str, refers_to: int | None) -> bytes:
    """One record; a revisit has the digest and length of its payload, but not the payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", urn(page)),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha1:{name}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if refers_to is not None:
        fields += [
            ("WARC-Refers-To", urn(refers_to)),
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        ]
    if url is not None:
        fields.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parse_record(record: bytes) -> dict:
    """The fields of ``RECORD``. Digest and length of a response are taken from its payload, and the
    payload must fit the digest it came with."""
    head, _, rest = record.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("no WARC record")
    fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    sizes = [line.split(b":")[1] for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:")]
    made = {
        "page_id": page_of(fields["warc-record-id"]),
        "record_type": fields["warc-type"],
        "refers_to": page_of(fields["warc-refers-to"]) if "warc-refers-to" in fields else None,
        "payload_digest": fields["warc-payload-digest"].removeprefix("sha1:"),
        "payload_bytes": int(sizes[0]),
        "url": fields.get("warc-target-uri"),
        "payload": None,
    }
    if made["record_type"] == "response":
        if digest(payload) != made["payload_digest"] or len(payload) != made["payload_bytes"]:
            raise ValueError("a payload does not fit its digest")
        made["payload"] = payload
    return made


def with_digest(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with ``payload_digest`` and ``payload_bytes`` of the html in UTF-8 (null: empty)."""

    def make():
        def block(values: pa.Array) -> list[pa.Array]:
            payloads = raw(values)
            return [pa.array(map(digest, payloads), pa.string()), pa.array(map(len, payloads), pa.int64())]

        return block

    fields = [StructField("payload_digest", StringType()), StructField("payload_bytes", LongType())]
    return add_columns(pages, html, fields, make)


def revisits(narrow: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, payload_digest, refers_to) of the pages whose payload a page of smaller id has too.

    Only payloads of at least ``least_bytes`` bytes are looked at. Rows without an id neither revisit nor
    are revisited; rows that repeat id and payload are the same page.
    """
    long_enough = narrow.filter((F.col("payload_bytes") >= least_bytes) & F.col("page_id").isNotNull())
    firsts = long_enough.groupBy("payload_digest").agg(
        F.min("page_id").alias("refers_to"), F.max("page_id").alias("last")
    )
    shared = firsts.filter("refers_to < last").drop("last")
    found = long_enough.select("page_id", "payload_digest").distinct().join(shared, "payload_digest")
    return found.filter("page_id > refers_to").select("page_id", "payload_digest", "refers_to")


def write_archives(spark: SparkSession, pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Write a record for each row of (page_id, url, html); returns (path, records, bytes) of each archive.

    A null or empty html is an empty payload; a row without a link has no target, one without an id an empty one.
    Repeated rows are written as often as they come; an empty table gives no archive. Other columns are not read.

    Every attempt of a task writes under a name of its own and renames the file once it is complete;
    the returned table holds the files of the attempts that counted.
    """
    known = with_digest(pages.select("page_id", "url", "html"))
    narrow = stored(
        with_digest(pages.select("page_id", "html")).select("page_id", "payload_digest", "payload_bytes"), "digests"
    )
    # Stored, so that Spark knows the size when it chooses between broadcast and shuffle.
    again = stored(revisits(narrow, least_bytes), "revisits")
    rows = known.join(again, ["page_id", "payload_digest"], "left").select(
        "page_id", "url", "payload_digest", "refers_to", "html"
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = filesystem(folder)
        files.create_dir(base, recursive=True)
        archive = None
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns[:4]]
            for *fields, payload in zip(*columns, raw(batch.column(4))):
                page, url, name, refers_to = fields
                archive = archive or Archive(files, base, folder)
                archive.add(warc_record(page, url, payload, name, refers_to), page)
                if archive.size >= ARCHIVE_BYTES:
                    yield archive.close()
                    archive = None
        if archive:
            yield archive.close()

    return stored(rows.mapInArrow(write, "path string, records long, bytes long"), "archives")


class Archive:
    """A ZIP archive that is being written to a stream."""

    def __init__(self, files, base: str, folder: str):
        name = uuid.uuid4().hex
        self.files, self.part, self.whole = files, f"{base}/{name}.part", f"{base}/{name}.zip"
        self.path = f"{folder}/{name}.zip"
        self.stream = files.open_output_stream(self.part)
        self.zip = zipfile.ZipFile(self.stream, "w", zipfile.ZIP_STORED)
        self.data = self.zip.open(DATA, "w", force_zip64=True)
        self.index: list[str] = []
        self.size = 0

    def add(self, record: bytes, page: int | None) -> None:
        packed = gzip.compress(record, 6, mtime=0)
        self.data.write(packed)
        self.index.append(json.dumps({"page": page, "filename": DATA, "offset": self.size, "length": len(packed)}))
        self.size += len(packed)

    def close(self) -> pa.RecordBatch:
        self.data.close()
        self.zip.writestr(INDEX, "\n".join(self.index) + "\n")
        self.zip.close()
        self.stream.close()
        self.files.move(self.part, self.whole)
        return pa.RecordBatch.from_pylist([{"path": self.path, "records": len(self.index), "bytes": self.size}])


def member_ranges(file) -> list[tuple[int, int]]:
    """(start, length) of what there is to read in an archive: each record that an index line names, and each
    stored WARC member, gzipped or plain, that no index line names, as a whole. A line that names no member is an error."""
    members = directory(file)
    data = {m.name: (data_start(file, m), m.size) for m in members if m.name.endswith((".warc.gz", ".warc"))}
    ranges, named = [], set()
    for m in members:
        if not m.name.startswith("indexes/") or m.method != STORED:
            continue
        for line in read_range(file, data_start(file, m), m.size).splitlines():
            if not line.strip():
                continue
            entry = json.loads(line[line.index(b"{") :])
            name = entry["filename"] if entry["filename"] in data else f"archive/{entry['filename']}"
            named.add(name)
            ranges.append((data[name][0] + int(entry["offset"]), int(entry["length"])))
    return ranges + [place for name, place in data.items() if name not in named]


def locate_records(archives: DataFrame) -> DataFrame:
    """(path, start, length) of each range of records of the archives named in ``path``; rows without a path have none."""

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).drop_null().to_pylist():
                files, inner = filesystem(path)
                with files.open_input_file(inner) as file:
                    ranges = member_ranges(file)
                starts, lengths = zip(*ranges) if ranges else ((), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * len(starts), pa.string()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64())],
                    ["path", "start", "length"],
                )

    return archives.select("path").mapInArrow(locate, "path string, start long, length long")


def records_of(file, start: int, length: int) -> Iterator[bytes]:
    """The records of a range, one at a time. The range is read in pieces, so a member of any size takes little memory."""
    end = start + length
    pieces = (read_range(file, at, min(PIECE_BYTES, end - at)) for at in range(start, end, PIECE_BYTES))
    first = next(pieces, b"")
    pieces = itertools.chain([first], pieces)
    return plain_records(pieces) if first.startswith(b"WARC/") else packed_records(pieces)


def packed_records(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """Records that are gzipped one by one."""
    reader, made = None, []
    for piece in pieces:
        while piece:
            reader = reader or zlib.decompressobj(31)
            made.append(reader.decompress(piece))
            piece = reader.unused_data
            if reader.eof:
                yield b"".join(made)
                reader, made = None, []
    if reader:
        raise ValueError("a record ends too early")


def plain_records(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """Records that follow each other as they are, cut by the lengths in their heads."""
    held, at = bytearray(), 0
    for piece in pieces:
        held = held[at:] + piece
        at = 0
        while (blank := held.find(b"\r\n\r\n", at)) >= 0:
            size = re.search(rb"(?im)^content-length:\s*(\d+)", bytes(held[at:blank]))
            if not size:
                raise ValueError("a record has no length")
            end = blank + 8 + int(size[1])
            if end > len(held):
                break
            yield bytes(held[at:end])
            at = end
    if held[at:].strip():
        raise ValueError("a record ends too early")


def read_records(ranges: DataFrame, payloads: bool = True) -> DataFrame:
    """The records at (path, start, length), with the columns of ``RECORD``.

    Cells of neighbouring ranges are dealt out over the cluster by a hash of archive and place, so tasks share the
    records, not the archives, and nothing is sampled; there are as many parts as the records behind the narrow rows have
    ``READ_BYTES``, and larger parts beyond ``MOST_PARTS``. Without ``payloads`` the payload is checked, but not returned.
    An empty table gives no records; a range that is no record is an error.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, opened = None, None
        for batch in batches:
            made, size = [], 0
            for path, start, length in zip(*(c.to_pylist() for c in batch.columns)):
                if path != opened:
                    if file:
                        file.close()
                    files, inner = filesystem(path)
                    file, opened = files.open_input_file(inner), path
                for record in records_of(file, start, length):
                    row = parse_record(record)
                    row["payload"] = row["payload"] if payloads else None
                    made.append(row)
                    size += len(row["payload"] or b"")
                    if size > 8 << 20 or len(made) >= BATCH_RECORDS:
                        yield pa.RecordBatch.from_pylist(made, kind)
                        made, size = [], 0
            if made:
                yield pa.RecordBatch.from_pylist(made, kind)
        if file:
            file.close()

    types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    kind = pa.schema([(n, types[t]) for n, t in (f.split() for f in RECORD.split(", "))])
    total = ranges.agg(F.sum("length")).first()[0] or 0
    parts = min(1 + total // READ_BYTES, MOST_PARTS)
    cell = F.floor(F.col("start") / max(1, total // (parts * CELLS)))
    dealt = ranges.repartition(parts, "path", cell).sortWithinPartitions("path", "start")
    return dealt.mapInArrow(read, RECORD)


def round_trip(spark: SparkSession, pages: DataFrame, payloads: bool = True) -> DataFrame:
    """Records of all pages, written to a new folder in the shared one and read back."""
    archives = write_archives(spark, pages, fresh_folder(spark, "warc"))
    return read_records(stored(locate_records(archives), "ranges"), payloads)


ORACLE = """
WITH named AS (
  SELECT page_id, coalesce(html, '') AS html, CAST(unhex(sha1(coalesce(html, ''))) AS BIT)::VARCHAR AS bits FROM pages),
coded AS (
  SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
    array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(list_sum(
      list_transform(range(0, 5), lambda j: CAST(substr(bits, CAST(5 * i + j + 1 AS INT), 1) AS INT) * CAST(pow(2, 4 - j) AS INT))) AS INT), 1)), '')
    AS payload_digest FROM named)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM coded)
"""
