"""WARC archives in seekable Zstandard bundles, and reading them back whole or by record.

A bundle is a file of independent Zstandard frames, each with some whole WARC records, and a
skippable frame at the end with the seek table: compressed and decompressed size of each
frame, their number, and the format's magic number. Any Zstandard decoder reads a bundle as
one stream; a reader of one record decompresses one frame only. The index has, for each
record's id, its bundle, the frame, and the offset and length inside the decompressed frame.

Of records with equal payloads one is a response and the others are revisits without payload,
which name the response's record. A record's id follows from the run, the page and the payload,
so that a revisit knows it wherever the response is written.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from datetime import UTC, datetime

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nestflow.llm.base import arrow_schema, map_batches, settled, text_key
from nestflow.workspace import new_folder

#: Fixed values of the seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1

#: Decompressed bytes after which a frame is closed; a larger record has its own frame.
FRAME_BYTES = 1 << 20
#: Compressed bytes after which a bundle is closed.
BUNDLE_BYTES = 64 << 20
LEVEL = 3
#: Decompressed bytes of records that a task reads back.
READ_BYTES = 64 << 20
#: Smaller payloads are always written as responses.
LEAST_REVISIT = 100
#: Parts that the records of a repeated payload are dealt to.
SALTS = 32


class BundleWriter:
    """Write frames to a binary file; ``close`` adds the seek table."""

    def __init__(self, file, frame_bytes: int = FRAME_BYTES):
        self._file, self._limit = file, frame_bytes
        self._open = bytearray()
        self._frames: list[tuple[int, int]] = []
        self._packer = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)
        self.size = 0

    def add(self, record: bytes) -> tuple[int, int]:
        """Frame number and offset of the record."""
        if self._open and len(self._open) + len(record) > self._limit:
            self._flush()
        place = len(self._frames), len(self._open)
        self._open += record
        return place

    def close(self) -> None:
        if self._open:
            self._flush()
        entries = b"".join(struct.pack("<II", *frame) for frame in self._frames)
        footer = struct.pack("<IBI", len(self._frames), 0, SEEKABLE_MAGIC)
        self._file.write(struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + len(footer)))
        self._file.write(entries + footer)

    def _flush(self) -> None:
        packed = self._packer.compress(bytes(self._open))
        self._file.write(packed)
        self._frames.append((len(packed), len(self._open)))
        self.size += len(packed)
        self._open = bytearray()


class BundleReader:
    """Read frames of a seekable file by its seek table."""

    def __init__(self, file):
        self._file = file
        end = file.seek(0, 2)
        file.seek(end - 9)
        count, flags, magic = struct.unpack("<IBI", file.read(9))
        if magic != SEEKABLE_MAGIC:
            raise ValueError("no seek table at the end of the file")
        entry = 12 if flags & 0x80 else 8
        file.seek(end - 9 - entry * count)
        table = file.read(entry * count)
        sizes = [struct.unpack_from("<II", table, entry * i) for i in range(count)]
        self.sizes = [size for _, size in sizes]
        self._starts = np.cumsum([0, *(packed for packed, _ in sizes)]).tolist()
        self._unpacker = zstandard.ZstdDecompressor()

    def __len__(self) -> int:
        return len(self.sizes)

    def frame(self, number: int) -> bytes:
        start, end = self._starts[number], self._starts[number + 1]
        self._file.seek(start)
        return self._unpacker.decompress(self._file.read(end - start), self.sizes[number])


def warc_record(headers: list[tuple[str, str]], payload: bytes) -> bytes:
    """A record: header lines, an empty line, the payload, two line ends."""
    lines = "".join(f"{name}: {value}\r\n" for name, value in headers)
    head = f"WARC/1.1\r\n{lines}Content-Length: {len(payload)}\r\n\r\n"
    return head.encode() + payload + b"\r\n\r\n"


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes, int, int]]:
    """Headers, payload, offset and length of each record of a frame."""
    at = 0
    while at < len(data):
        body = data.index(b"\r\n\r\n", at) + 4
        first, *lines = data[at : body - 4].decode().split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no WARC record at {at}")
        headers = dict(line.split(": ", 1) for line in lines)
        end = body + int(headers["Content-Length"])
        yield headers, data[body:end], at, end + 4 - at
        at = end + 4


def _clean(value: str) -> str:
    """A header's value on one line, in a form that gives the text back."""
    return value.encode("unicode_escape").decode("ascii")


def _plain(value: str) -> str:
    return value.encode("ascii").decode("unicode_escape")


def _file_system(uri: str) -> tuple[fs.FileSystem, str]:
    named = "://" in uri or uri.startswith("file:")
    return fs.FileSystem.from_uri(uri if named else f"file://{uri}")


def _with_decision(pages: DataFrame, page_id: str) -> DataFrame:
    """The pages with ``refers_to``: the response that a page's record revisits, or null.

    Only digests that occur again are joined; their records are dealt to several parts, each
    with a copy of the digest's row, as a third of all pages may have the same payload.
    """
    again = (
        pages.filter(F.col("payload_bytes") >= LEAST_REVISIT)
        .groupBy(F.col("payload_digest").alias("again"))
        .agg(F.min(page_id).alias("response"), F.count(F.lit(1)).alias("times"))
        .filter("times > 1 AND response IS NOT NULL")
    )
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    again = settled(again.drop("times"), "repeated-payloads").withColumn("salt", salts)
    salt = F.pmod(text_key(page_id), F.lit(SALTS)).cast("int")
    same = (F.col("payload_digest") == F.col("again")) & (F.col("own_salt") == F.col("salt"))
    same &= F.col("payload_bytes") >= LEAST_REVISIT
    joined = pages.withColumn("own_salt", salt).join(again.hint("merge"), same, "left")
    other = ~F.col(page_id).eqNullSafe(F.col("response"))
    refers_to = F.when(other, F.col("response")).alias("refers_to")
    return joined.select(*pages.columns, refers_to)


def write_archives(
    pages: DataFrame,
    folder: str,
    page_id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    date: datetime | None = None,
    frame_bytes: int = FRAME_BYTES,
) -> DataFrame:
    """Write a WARC record per row to bundles in ``folder``; return the index.

    Index columns: ``record_id``, ``page_id``, ``bundle`` (file name), ``frame``, ``offset`` and
    ``length`` (in the decompressed frame) and ``record_type``. Records are HTTP responses of
    ``date``, now if none is given. The payload is the text in UTF-8, null
    as empty. Of records with equal payloads of ``LEAST_REVISIT`` bytes or more that with
    the smallest id is a response and the others, null ids too, are revisits of it; payloads
    whose ids are all null are responses. A repeated row with the response's own id is a
    response as well, and has its record id. A null url is left out of the record.

    A task that runs again writes other files; only those of the attempt that Spark
    commits are in the index, which is written too.
    """
    content = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    pages = pages.select(
        F.col(page_id).alias("page_id"),
        F.col(url).cast("string").alias("url"),
        content.alias("payload"),
        F.sha2(content, 256).alias("payload_digest"),
        F.octet_length(content).cast("bigint").alias("payload_bytes"),
    )
    texts = {"page_id_text": "page_id", "refers_text": "refers_to"}
    decided = _with_decision(pages, "page_id").withColumns(
        {name: F.col(column).cast("string") for name, column in texts.items()}
    )
    id_type = pages.schema["page_id"].dataType.simpleString()
    schema = (
        f"record_id string, page_id {id_type}, bundle string, frame int, offset bigint, "
        "length bigint, record_type string"
    )
    run = uuid.uuid4()
    date = (date or datetime.now(UTC)).astimezone(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _file_system(folder)
        store.create_dir(root, recursive=True)
        name = file = writer = None
        for batch in batches:
            places = []
            for row in batch.select(
                ["page_id_text", "url", "payload", "payload_digest", "payload_bytes", "refers_text"]
            ).to_pylist():
                if writer is None:
                    name = f"{uuid.uuid4().hex}.warc.zst"
                    # The frames are compressed already, whatever the name says.
                    file = store.open_output_stream(f"{root}/{name}", compression=None)
                    writer = BundleWriter(file, frame_bytes)
                record, record_id, kind = _record(row, run, date)
                places.append((record_id, name, *writer.add(record), len(record), kind))
                if writer.size >= BUNDLE_BYTES:
                    writer.close()
                    file.close()
                    writer = None
            record_id, bundle, frame, offset, length, kind = (
                zip(*places, strict=True) if places else [()] * 6
            )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(record_id, pa.string()),
                    batch.column("page_id"),
                    pa.array(bundle, pa.string()),
                    pa.array(frame, pa.int32()),
                    pa.array(offset, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(kind, pa.string()),
                ],
                ["record_id", "page_id", "bundle", "frame", "offset", "length", "record_type"],
            )
        if writer is not None:
            writer.close()
            file.close()

    return settled(map_batches(decided, write, schema), "warc-index")


def _record_id(run: uuid.UUID, page_id: str | None, digest: str) -> str:
    # Nothing refers to a page without id.
    named = uuid.uuid4() if page_id is None else uuid.uuid5(run, f"{digest} {page_id}")
    return f"<urn:uuid:{named}>"


def _record(row: dict, run: uuid.UUID, date: str) -> tuple[bytes, str, str]:
    revisit = row["refers_text"] is not None
    kind = "revisit" if revisit else "response"
    record_id = _record_id(run, row["page_id_text"], row["payload_digest"])
    headers = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", record_id),
        ("WARC-Date", date),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha256:{row['payload_digest']}"),
    ]
    if row["page_id_text"] is not None:
        headers.append(("X-Page-ID", _clean(row["page_id_text"])))
    if row["url"] is not None:
        headers.append(("WARC-Target-URI", _clean(row["url"])))
    if revisit:
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        refers_to = _record_id(run, row["refers_text"], row["payload_digest"])
        headers += [
            ("WARC-Profile", profile),
            ("WARC-Refers-To", refers_to),
            ("X-Refers-To-Page", _clean(row["refers_text"])),
        ]
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {row['payload_bytes']}\r\n\r\n"
    ).encode()
    return warc_record(headers, http if revisit else http + row["payload"]), record_id, kind


def _http_parts(block: bytes) -> tuple[int, bytes]:
    """The length that a response states, and the payload that is there."""
    end = block.index(b"\r\n\r\n") + 4
    stated = re.search(rb"\r\nContent-Length: (\d+)\r\n", block[:end])
    return int(stated[1]), block[end:]


_READ = (
    "record_id string, page_id string, url string, payload binary, payload_bytes bigint, payload_digest string, "
    "record_type string, refers_to string, refers_to_record string"
)


def _row(headers: dict[str, str], block: bytes, with_payload: bool) -> dict:
    """A record's row; the digest of a payload that is there is made anew."""
    response = headers["WARC-Type"] == "response"
    length, payload = _http_parts(block)
    stated = headers["WARC-Payload-Digest"].removeprefix("sha256:")
    whole = len(payload) == length and hashlib.sha256(payload).hexdigest() == stated
    if response and not whole:
        raise ValueError(f"the payload of {headers['WARC-Record-ID']} is damaged")
    page_id, url = headers.get("X-Page-ID"), headers.get("WARC-Target-URI")
    refers_to = headers.get("X-Refers-To-Page")
    return {
        "record_id": headers["WARC-Record-ID"],
        "page_id": None if page_id is None else _plain(page_id),
        "url": None if url is None else _plain(url),
        "payload": payload if response and with_payload else None,
        "payload_bytes": length,
        "payload_digest": stated,
        "record_type": headers["WARC-Type"],
        "refers_to": None if refers_to is None else _plain(refers_to),
        "refers_to_record": headers.get("WARC-Refers-To"),
    }


def _batches(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    part, size = [], 0
    for row in rows:
        part.append(row)
        size += len(row["payload"] or b"") + 200
        if size > 4 << 20:
            yield pa.RecordBatch.from_pylist(part, schema=schema)
            part, size = [], 0
    if part:
        yield pa.RecordBatch.from_pylist(part, schema=schema)


def read_archives(index: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """A row for each record of the index's bundles, frame by frame.

    Ids come as text. ``payload`` is null for revisits, and for all unless asked for.
    """
    schema = arrow_schema(index.sparkSession, _READ)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _file_system(folder)

        def rows() -> Iterator[dict]:
            for batch in batches:
                for name in batch.column("bundle").to_pylist():
                    with store.open_input_file(f"{root}/{name}") as file:
                        bundle = BundleReader(file)
                        for number in range(len(bundle)):
                            for headers, payload, _, _ in parse_records(bundle.frame(number)):
                                yield _row(headers, payload, with_payload)

        yield from _batches(rows(), schema)

    # A task for each, which adaptive execution would not give so short a list.
    bundles = index.select("bundle").distinct()
    return map_batches(bundles.repartition(max(1, bundles.count()), "bundle"), read, _READ)


def read_records(index: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """The records that the index's rows point at, and no others: a frame is read once for
    all its records that are asked for. A task reads about ``READ_BYTES`` of them."""
    schema = arrow_schema(index.sparkSession, _READ)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _file_system(folder)

        def rows() -> Iterator[dict]:
            name = file = bundle = number = data = None
            for batch in batches:
                for place in batch.to_pylist():
                    if place["bundle"] != name:
                        if file is not None:
                            file.close()
                        name, number = place["bundle"], None
                        file = store.open_input_file(f"{root}/{name}")
                        bundle = BundleReader(file)
                    if place["frame"] != number:
                        number = place["frame"]
                        data = bundle.frame(number)
                    start = place["offset"]
                    record = data[start : start + place["length"]]
                    for headers, payload, _, _ in parse_records(record):
                        yield _row(headers, payload, with_payload)
            if file is not None:
                file.close()

        yield from _batches(rows(), schema)

    places = index.select("bundle", "frame", "offset", "length")
    size = places.agg(F.sum("length"), F.count_distinct("bundle", "frame")).first()
    # By bytes, but as many tasks as run at one time if there are so many frames.
    at_once = min(size[1], index.sparkSession.sparkContext.defaultParallelism)
    tasks = max(1, at_once, -(-(size[0] or 0) // READ_BYTES))
    places = places.repartition(tasks, "bundle", "frame")
    return map_batches(places.sortWithinPartitions("bundle", "frame", "offset"), read, _READ)


def round_trip(pages: DataFrame, **names) -> DataFrame:
    """Write the pages to archives in the shared folder and read all records back by the index.

    Columns: those of ``read_records``, without payloads and record ids, ids in the type of
    ``page_id``.
    """
    spark: SparkSession = pages.sparkSession
    folder = new_folder(spark, "warc")
    index = write_archives(pages, folder, **names)
    id_type = index.schema["page_id"].dataType
    back = read_records(index, folder, with_payload=False)
    ids = {c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")}
    return back.withColumns(ids).drop("payload", "record_id", "refers_to_record")
