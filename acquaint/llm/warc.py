"""WARC archives: writing, and normalising archives that are one gzip stream.

A crawler that pipes its records through one gzip stream makes an archive that can
only be read from its start. The normaliser inflates such a stream once, writes
every record as a gzip member of its own and, beside the archive, an index with
the offset and length of each member, so that any record can be read alone.

Archives are files in the shared folder, reached through Arrow's file systems, one
or more a task. Files are written under a name of the attempt's own and then take
their own, so a task that is run again leaves whole files. Records pass one
at a time; nothing grows with the size of an archive.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acquaint.llm.shared import (
    bitmap_rows,
    bitmap_slots,
    giving_back,
    new_folder,
    with_bit,
    written,
)

#: Payloads of fewer bytes are always stored in full.
LEAST_REVISIT = 100

#: How hard to compress: the stream is read once and may be larger.
STREAM_LEVEL, MEMBER_LEVEL = 1, 5

READ_BYTES = 1 << 20

#: pages have no times; the format wants one.
NO_DATE = "1970-01-01T00:00:00Z"

_NAMESPACE = uuid.UUID("6c0e4a1c-35f4-4e0e-9d0c-7b9b1f6a7f11")


@dataclass(frozen=True)
class Record:
    headers: dict[str, str]
    block: bytes

    @property
    def payload(self) -> bytes:
        return self.block.partition(b"\r\n\r\n")[2]

    @property
    def http(self) -> dict[str, str]:
        lines = self.block.partition(b"\r\n\r\n")[0].decode("utf-8", "replace").split("\r\n")
        return _fields(lines[1:])


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = uri.replace("file:/", "file:///", 1)
    return fs.FileSystem.from_uri(uri)


def typed_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, payload_bytes, digest, record_type and refers_to.

    Of pages with equal payloads of at least ``LEAST_REVISIT`` bytes that with the
    smallest page_id is the response, the others revisit it and carry no payload.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        "url",
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha2(payload.cast("binary"), 256).alias("digest"),
    )
    firsts = (
        rows.where(F.col("payload_bytes") >= LEAST_REVISIT)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where((F.col("n") > 1) & F.col("first").isNotNull())
        .select("digest", "first")
    )
    firsts = written(firsts, "repeated")
    # A bitmap of repeated digests leaves the other pages, mostly all, out of the join.
    slots = bitmap_slots(firsts.count())
    marked = with_bit(rows, bitmap_rows(firsts, F.col("digest"), slots), F.col("digest"), slots, "again")
    single = marked.where(~F.col("again")).withColumn("first", F.lit(None).cast("long"))
    several = marked.where("again").join(firsts, "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return (
        several.unionByName(single)
        .withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))
        .select(
            "page_id",
            "url",
            F.when(~revisit, F.col("payload")).alias("payload"),
            "payload_bytes",
            "digest",
            "record_type",
            F.when(revisit, F.col("first")).alias("refers_to"),
        )
    )


def write_streams(typed: DataFrame, folder: str) -> DataFrame:
    """Write the pages as archives that are one gzip stream each; path and records.

    Archives are written when this is called, one a task.
    """
    file_system_, path = file_system(folder)
    file_system_.create_dir(path)

    @giving_back
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        name = f"{folder}/pages-{context.partitionId():06d}.stream.warc.gz"
        packer, records, out = zlib.compressobj(STREAM_LEVEL, zlib.DEFLATED, 31), 0, None
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                for row in batch.slice(at, 64).to_pylist():
                    out = out or _Output(name, context.taskAttemptId())
                    out.write(packer.compress(page_record(row)))
                    records += 1
        if out:
            out.write(packer.flush())
            out.finish()
            yield pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([records], pa.int64())], ["path", "records"]
            )

    return written(typed.mapInArrow(write, "path string, records long"), "streams")


def normalise(archives: DataFrame) -> DataFrame:
    """Rewrite each archive of the column ``path`` with a member for each record.

    Gives path, index and records of the new archives, written when this is
    called; an archive ``x.stream.warc.gz`` becomes ``x.warc.gz`` with the index
    ``x.warc.gz.idx`` beside it. Archives are dealt out one by one.
    """

    @giving_back
    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = TaskContext.get().taskAttemptId()
        for batch in batches:
            for source in batch.column("path").to_pylist():
                target = source.replace(".stream.warc.gz", ".warc.gz")
                records = normalise_archive(source, target, attempt)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([target]),
                        pa.array([f"{target}.idx"]),
                        pa.array([records], pa.int64()),
                    ],
                    ["path", "index", "records"],
                )

    dealt = _one_by_one(archives.select("path"))
    return written(dealt.mapInArrow(rewrite, "path string, index string, records long"), "archives")


def _one_by_one(archives: DataFrame) -> DataFrame:
    """Archives in about as many tasks as there are, by ranges of their names."""
    return archives.repartitionByRange(max(1, archives.count()), "path")


def normalise_archive(source: str, target: str, attempt: int = 0) -> int:
    """Number of records, each now a member; any gzip members of the source will do."""
    out, index = _Output(target, attempt), _Output(f"{target}.idx", attempt)
    offset = records = 0
    for record in stream_records(_inflated(source)):
        packer = zlib.compressobj(MEMBER_LEVEL, zlib.DEFLATED, 31)
        member = packer.compress(_bytes(record)) + packer.flush()
        out.write(member)
        line = {
            "offset": offset,
            "length": len(member),
            "type": record.headers.get("WARC-Type"),
            "uri": record.headers.get("WARC-Target-URI"),
            "id": record.headers.get("WARC-Record-ID"),
        }
        index.write(json.dumps(line).encode() + b"\n")
        offset += len(member)
        records += 1
    out.finish()
    index.finish()
    return records


def indexed_records(archive: str, index: str) -> Iterator[Record]:
    """The records of a normalised archive, each read by its offset."""
    file_system_, path = file_system(archive)
    with file_system_.open_input_file(path) as data:
        for line in _lines(index):
            entry = json.loads(line)
            data.seek(entry["offset"])
            member = zlib.decompress(data.read(entry["length"]), 31)
            yield from stream_records(iter([member]))


def read_pages(archives: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of all records.

    A response's size and digest are taken from its payload, and a record whose
    stated digest is another one raises an error; a revisit states them itself.
    """

    @giving_back
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = []
                for record in indexed_records(row["path"], row["index"]):
                    found.append(_page(record))
                    if len(found) == 1000:
                        yield pa.RecordBatch.from_pylist(found, _PAGE)
                        found = []
                if found:
                    yield pa.RecordBatch.from_pylist(found, _PAGE)

    dealt = _one_by_one(archives.select("path", "index"))
    return dealt.mapInArrow(
        read,
        "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long",
    )


def archive_pages(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write all pages as WARC, normalise the archives and read them back.

    A null html is an empty payload; a null url gives a record without a target;
    a null page_id is no smallest and stays null, and revisits a page that has an
    id. Of equal rows with the smallest id all are responses. Without pages there
    are no archives and no rows; other columns are ignored. Archives stay in
    ``folder``, by default a new one in the shared folder.
    """
    folder = folder or new_folder(pages.sparkSession, "warc")
    return read_pages(normalise(write_streams(typed_pages(pages), folder)))


_PAGE = pa.schema(
    [
        ("page_id", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
    ]
)


def _page(record: Record) -> dict:
    headers = record.headers
    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
    size = int(record.http["Content-Length"])
    if headers["WARC-Type"] == "response":
        found, size = hashlib.sha256(record.payload).hexdigest(), len(record.payload)
        if found != digest:
            raise ValueError(f"{headers['WARC-Record-ID']}: payload digest is {found}, not {digest}")
    page, refers_to = headers.get("X-Page-ID"), headers.get("X-Refers-To-Page-ID")
    return {
        "page_id": None if page is None else int(page),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": headers["WARC-Type"],
        "refers_to": None if refers_to is None else int(refers_to),
    }


def page_record(row: dict) -> bytes:
    """One page as a record: an HTTP answer, or for a revisit only its headers."""
    payload = (row["payload"] or "").encode()
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {row['payload_bytes']}\r\n\r\n"
    ).encode()
    headers = {
        "WARC-Type": row["record_type"],
        "WARC-Record-ID": _record_id(row["page_id"], row["digest"]),
        "WARC-Date": NO_DATE,
    }
    if row["url"] is not None:
        headers["WARC-Target-URI"] = re.sub(r"[\x00-\x20\x7f]", _escaped, row["url"])
    if row["page_id"] is not None:
        headers["X-Page-ID"] = str(row["page_id"])
    headers["WARC-Payload-Digest"] = f"sha256:{row['digest']}"
    if row["record_type"] == "revisit":
        headers["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        headers["WARC-Refers-To"] = _record_id(row["refers_to"], row["digest"])
        headers["X-Refers-To-Page-ID"] = str(row["refers_to"])
        payload = b""
    headers["Content-Type"] = "application/http;msgtype=response"
    return _bytes(Record(headers, http + payload))


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{page_id} {digest}')}>"


def _escaped(found: re.Match[str]) -> str:
    return f"%{ord(found[0]):02X}"


def _bytes(record: Record) -> bytes:
    lines = [f"{name}: {value}\r\n" for name, value in record.headers.items() if name != "Content-Length"]
    head = "WARC/1.1\r\n" + "".join(lines) + f"Content-Length: {len(record.block)}\r\n\r\n"
    return head.encode() + record.block + b"\r\n\r\n"


def stream_records(chunks: Iterator[bytes]) -> Iterator[Record]:
    """The records of a plain WARC stream, one held at a time."""
    held, at, ended = bytearray(), 0, False

    def more() -> None:
        nonlocal held, at, ended
        chunk = next(chunks, None)
        if chunk is None:
            ended = True
        else:
            del held[:at]
            at = 0
            held += chunk

    while True:
        while (end := held.find(b"\r\n\r\n", at)) < 0 and not ended:
            more()
        if end < 0:
            if bytes(held[at:]).strip():
                raise ValueError("the archive ends within a record's headers")
            return
        lines = bytes(held[at:end]).decode("utf-8").lstrip("\r\n").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not the start of a record: {lines[0][:80]!r}")
        headers = _fields(lines[1:])
        size = int(headers["Content-Length"])
        at = end + 4
        while len(held) - at < size + 4 and not ended:
            more()
        if len(held) - at < size:
            raise ValueError("the archive ends within a record")
        yield Record(headers, bytes(held[at : at + size]))
        at += size + 4


def _fields(lines: list[str]) -> dict[str, str]:
    return {name: value.strip() for name, _, value in (line.partition(":") for line in lines)}


def _inflated(uri: str) -> Iterator[bytes]:
    """The plain bytes of a gzip file of one or more members, read once."""
    file_system_, path = file_system(uri)
    with file_system_.open_input_stream(path, compression=None) as data:
        inflater = zlib.decompressobj(31)
        while chunk := data.read(READ_BYTES):
            while chunk:
                if plain := inflater.decompress(chunk):
                    yield plain
                chunk = inflater.unused_data
                if inflater.eof:
                    inflater = zlib.decompressobj(31)
        if plain := inflater.flush():
            yield plain


def _lines(uri: str) -> Iterator[bytes]:
    file_system_, path = file_system(uri)
    with file_system_.open_input_stream(path, compression=None) as data:
        rest = b""
        while chunk := data.read(READ_BYTES):
            *lines, rest = (rest + chunk).split(b"\n")
            yield from lines


class _Output:
    """A file that takes its name when it is whole."""

    def __init__(self, uri: str, attempt: int) -> None:
        self._system, self._path = file_system(uri)
        self._unfinished = f"{self._path}.attempt-{attempt}"
        self._stream = self._system.open_output_stream(self._unfinished, compression=None)

    def write(self, data: bytes) -> None:
        if data:
            self._stream.write(data)

    def finish(self) -> None:
        self._stream.close()
        self._system.move(self._unfinished, self._path)
