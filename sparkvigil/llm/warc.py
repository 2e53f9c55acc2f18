"""WARC archives with a two-level capture index.

Archives are written by the tasks that hold the pages, one gzip member per record. The index sorts
capture keys (host reversed, then path, then capture id) over range partitions; each partition is one
file of compressed blocks of lines, ended by a sparse directory of the blocks' first keys. A list of
the files' first keys is all that a reader needs: it finds the file, then the block by binary search
in the directory, and reads that range and no more; then it reads the record's range in the archive.

Files go to the folder of ``spark.checkpoint.dir`` through the file system that its address names,
under names of their own per attempt; a lost task writes new ones and only its rows are kept.

Defined results: a null payload is empty; a null url has the key ")"; of equal payloads of at least
``REVISIT_BYTES`` the capture with the largest id is the response (every row of that id, if rows
repeat), smaller payloads are all responses, and so are captures whose ids are all null; an empty
table gives no files and an empty result; columns other than the three named ones are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkvigil.session import scratch_path, stage

REVISIT_BYTES = 1000
# Payload bytes after which a task starts a new archive, lines of an index block, entries of an index file.
ARCHIVE_BYTES = 256 << 20
BLOCK_LINES = 512
FILE_ENTRIES = 1_000_000
LEVEL = 6

ENTRY = "key string, archive string, offset bigint, length bigint"
CAPTURE = (
    "page_id bigint, url string, record_type string, refers_to bigint, payload_digest string,"
    " payload_bytes bigint, payload binary"
)
RECORD_ID = "<urn:capture:{}>"


@dataclass
class Index:
    """Where the archives are, and the first key and path of every index file in key order."""

    root: str
    firsts: list[str]
    files: list[str]


def open_root(root: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(root)


def capture_key(page_id: str = "page_id", url: str = "url"):
    """Reversed host, ``)``, path and query, then the id at fixed width; sorts as text."""
    clean = F.regexp_replace(F.coalesce(F.col(url), F.lit("")), r"[\x00-\x20]", "%20")
    host = F.regexp_extract(F.lower(clean), r"^[a-z][a-z0-9+.-]*://(?:[^/@?#]*@)?([^/?#]*)", 1)
    rest = F.regexp_replace(F.regexp_replace(clean, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", ""), "#.*", "")
    reversed_host = F.array_join(F.reverse(F.split(host, r"\.")), ",")
    number = F.col(page_id).cast("decimal(20,0)") + F.lit("9223372036854775808").cast("decimal(20,0)")
    return F.concat(reversed_host, F.lit(")"), rest, F.lit(" "), F.lpad(F.coalesce(number.cast("string"), F.lit("-")), 20, "0"))


def with_payload(pages: DataFrame) -> DataFrame:
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    narrow = pages.select("page_id", "url", payload.alias("payload"))
    return narrow.withColumn("digest", F.sha1("payload")).withColumn("bytes", F.octet_length("payload"))


def representatives(captures: DataFrame) -> DataFrame:
    """digest and the response's id of every payload that occurs more than once and is large enough."""
    large = captures.filter(F.col("bytes") >= REVISIT_BYTES)
    groups = large.groupBy("digest").agg(F.max("page_id").alias("response"), F.count(F.lit(1)).alias("n"))
    return stage(groups.filter("n > 1 AND response IS NOT NULL").select("digest", "response"), "responses")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record; a revisit keeps the HTTP head, whose length is the payload's, and no payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = head.encode() + (payload if refers_to is None else b"")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {RECORD_ID.format('' if page_id is None else page_id)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: {RECORD_ID.format(refers_to)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def headers(text: bytes) -> dict[str, str]:
    pairs = (line.partition(": ") for line in text.decode().split("\r\n")[1:])
    return {name: value for name, _, value in pairs}


def capture_of(uri: str) -> int | None:
    number = uri[len("<urn:capture:") : -1]
    return int(number) if number else None


def parse(raw: bytes) -> dict:
    """The capture of one record; the digest of a stored payload is counted anew and must agree."""
    head, _, body = raw.partition(b"\r\n\r\n")
    fields = headers(head)
    block = body[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest, size = fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(headers(http)["Content-Length"])
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != size):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    url = fields.get("WARC-Target-URI")
    return {
        "page_id": capture_of(fields["WARC-Record-ID"]),
        "url": url and url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%"),
        "record_type": fields["WARC-Type"],
        "refers_to": capture_of(fields["WARC-Refers-To"]) if revisit else None,
        "payload_digest": digest,
        "payload_bytes": size,
        "payload": None if revisit else payload,
    }


def write_archives(captures: DataFrame, root: str) -> DataFrame:
    """Write the records of ``captures``; one index entry for each."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = open_root(root)
        sink, name, place, rows = None, "", 0, []

        def finish() -> pa.RecordBatch:
            """Entries go out when their archive is complete."""
            nonlocal sink
            sink.close()
            sink = None
            done = pa.RecordBatch.from_pylist(rows, ENTRY_TYPE)
            rows.clear()
            return done

        for batch in batches:
            for row in batch.to_pylist():
                if sink is None:
                    name, place = f"{uuid.uuid4().hex}.warc.gz", 0
                    system.create_dir(f"{base}/archives", recursive=True)
                    sink = system.open_output_stream(f"{base}/archives/{name}", compression=None)
                refers_to = None if row["response"] == row["page_id"] else row["response"]
                raw = record(row["page_id"], row["url"], row["payload"], row["digest"], refers_to)
                packer = zlib.compressobj(LEVEL, wbits=31)
                member = packer.compress(raw) + packer.flush()
                sink.write(member)
                rows.append({"key": row["key"], "archive": name, "offset": place, "length": len(member)})
                place += len(member)
                if place > ARCHIVE_BYTES:
                    yield finish()
        if sink is not None:
            yield finish()

    rows = captures.select("page_id", "url", "payload", "digest", "response", capture_key().alias("key"))
    return rows.mapInArrow(write, ENTRY)


ENTRY_TYPE = pa.schema(
    [("key", pa.string()), ("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]
)
FILE_TYPE = pa.schema([("first", pa.string()), ("file", pa.string())])


def write_index(entries: DataFrame, root: str) -> Index:
    """Sorted blocks and directories of the stored ``entries``; its files' first keys come back."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = open_root(root)
        name = f"{uuid.uuid4().hex}.idx"
        directory, lines, place, sink = [], [], 0, None

        def flush():
            nonlocal place
            block = zlib.compress("\n".join(lines).encode())
            directory.append(f"{lines[0].partition('\t')[0]}\t{place}\t{len(block)}")
            sink.write(block)
            place += len(block)
            lines.clear()

        for batch in batches:
            for key, *where in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if sink is None:
                    system.create_dir(f"{base}/index", recursive=True)
                    sink = system.open_output_stream(f"{base}/index/{name}", compression=None)
                lines.append("\t".join([key, *map(str, where)]))
                if len(lines) == BLOCK_LINES:
                    flush()
        if sink is None:
            return
        if lines:
            flush()
        sparse = zlib.compress("\n".join(directory).encode())
        sink.write(sparse + struct.pack("<QQ", place, len(sparse)))
        sink.close()
        yield pa.RecordBatch.from_pylist([{"first": directory[0].partition("\t")[0], "file": name}], FILE_TYPE)

    count = entries.count()
    spark = entries.sparkSession
    parts = max(-(-count // FILE_ENTRIES), min(int(spark.conf.get("spark.sql.shuffle.partitions")), count or 1))
    ordered = entries.repartitionByRange(parts, "key").sortWithinPartitions("key", "archive", "offset")
    # One row for each index file, of about FILE_ENTRIES entries.
    files = sorted((r["first"], r["file"]) for r in ordered.mapInArrow(write, "first string, file string").collect())
    return Index(root, [f[0] for f in files], [f[1] for f in files])


class IndexReader:
    """Range reads in the index files; keeps the last directory and block, as keys come sorted."""

    def __init__(self, index: Index):
        self.index = index
        self.system, self.base = open_root(index.root)
        self.file, self.source, self.firsts, self.ranges, self.block, self.lines = -1, None, [], [], -1, []

    def open(self, file: int) -> None:
        if file == self.file:
            return
        self.source = self.system.open_input_file(f"{self.base}/index/{self.index.files[file]}")
        place, size = struct.unpack("<QQ", self.source.read_at(16, self.source.size() - 16))
        rows = [r.split("\t") for r in zlib.decompress(self.source.read_at(size, place)).decode().split("\n")]
        self.firsts, self.ranges = [r[0] for r in rows], [(int(r[1]), int(r[2])) for r in rows]
        self.file, self.block = file, -1

    def read_block(self, block: int) -> list[list[str]]:
        if block != self.block:
            place, size = self.ranges[block]
            raw = zlib.decompress(self.source.read_at(size, place)).decode()
            self.lines, self.block = [line.split("\t") for line in raw.split("\n")], block
        return self.lines

    def find(self, key: str) -> Iterator[tuple[str, int, int]]:
        """(archive, offset, length) of all captures with this key; equal keys may cross blocks."""
        file = max(0, bisect_left(self.index.firsts, key) - 1)
        while file < len(self.index.files) and self.index.firsts[file] <= key:
            self.open(file)
            block = max(0, bisect_left(self.firsts, key) - 1)
            for block in range(block, bisect_right(self.firsts, key)):
                lines = self.read_block(block)
                at = bisect_left(lines, key, key=lambda line: line[0])
                while at < len(lines) and lines[at][0] == key:
                    yield lines[at][1], int(lines[at][2]), int(lines[at][3])
                    at += 1
            file += 1


def look_up(keys: DataFrame, index: Index) -> DataFrame:
    """Index entries of the distinct ``key``s, found by sorted range reads."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = IndexReader(index)
        for batch in batches:
            rows = [
                {"key": key, "archive": archive, "offset": offset, "length": length}
                for key in batch.column(0).to_pylist()
                for archive, offset, length in reader.find(key)
            ]
            yield pa.RecordBatch.from_pylist(rows, ENTRY_TYPE)

    ordered = keys.select("key").distinct().repartitionByRange("key").sortWithinPartitions("key")
    return ordered.mapInArrow(find, ENTRY)


def read_records(entries: DataFrame, root: str, payload: bool = True) -> DataFrame:
    """The captures at ``entries``, each archive read by one task in its own order."""
    kind = pa.schema(
        [
            ("page_id", pa.int64()),
            ("url", pa.string()),
            ("record_type", pa.string()),
            ("refers_to", pa.int64()),
            ("payload_digest", pa.string()),
            ("payload_bytes", pa.int64()),
            ("payload", pa.binary()),
        ]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = open_root(root)
        name, source = None, None
        for batch in batches:
            rows = []
            for archive, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if archive != name:
                    name, source = archive, system.open_input_file(f"{base}/archives/{archive}")
                row = parse(zlib.decompress(source.read_at(length, offset), wbits=31))
                rows.append(row if payload else row | {"payload": None})
            yield pa.RecordBatch.from_pylist(rows, kind)

    places = entries.select("archive", "offset", "length")
    return places.repartition("archive").sortWithinPartitions("archive", "offset").mapInArrow(read, CAPTURE)


def archive_pages(pages: DataFrame) -> Index:
    """Write ``pages`` as archives with their capture index."""
    spark: SparkSession = pages.sparkSession
    captures = with_payload(pages)
    responses = representatives(captures)
    root = scratch_path(spark, "warc")
    joined = captures.join(responses, "digest", "left")
    entries = stage(write_archives(joined, root), "captures")
    return write_index(entries, root)


def read_back(pages: DataFrame, index: Index, payload: bool = True) -> DataFrame:
    """The captures of ``pages`` (page_id, url), found through the index."""
    found = look_up(pages.select(capture_key().alias("key")), index)
    return read_records(found, index.root, payload)
