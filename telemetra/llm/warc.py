"""WARC archives in seekable Zstandard bundles.

Records are grouped into frames that can be read on their own; a bundle ends with a seek table, in a frame that
other readers skip, and an index maps every record to its bundle, its frame and its place in the frame. Of equal
payloads one is stored, the others refer to it. Bundles go to a folder that all executors reach. A task that is run again
writes new bundles; only those count whose index rows Spark has committed.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetra.sources.scans import materialise

# Shorter payloads are stored each time.
LEAST_BYTES = 100
# Bytes of records in a frame, and of frames in a bundle, after which the next one begins.
FRAME, BUNDLE = 1 << 18, 1 << 26
LEVEL = 3
INDEX = "page_id long, bundle string, frame int, start int, size int"
RECORD = "page_id long, url string, record_type string, payload binary, payload_bytes long, payload_digest string, refers_to long"
RESPONSE, REVISIT = "response", "revisit"

# Fixed values of the formats.
SEEK_HEADER, SEEK_FOOTER = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"


def _store(folder: str):  # noqa: ANN202
    """The file system of a folder, and its path there."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!//)", "file:///", folder))


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_id(name: str) -> int | None:
    number = name.removeprefix("<urn:page:").rstrip(">")
    return int(number) if number else None


def build_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record; a revisit has the head of the response, with the payload's length, and no payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = head if revisit else head + payload
    fields = [
        ("WARC-Type", REVISIT if revisit else RESPONSE),
        ("WARC-Record-ID", _name(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        # Line ends would break the header.
        fields.insert(3, ("WARC-Target-URI", url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A") if re.search(r"[\r\n]", url) else url))
    if revisit:
        fields[3:3] = [("WARC-Refers-To", _name(refers_to)), ("WARC-Profile", PROFILE)]
    header = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return f"WARC/1.1\r\n{header}\r\n".encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


@dataclass(frozen=True)
class Record:
    fields: dict[str, str]
    head: dict[str, str]
    payload: bytes


def parse_record(data: bytes) -> Record:
    """The parts of one record."""
    header, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = header.decode("utf-8", "surrogatepass").split("\r\n")
    if version != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    head, _, payload = block.partition(b"\r\n\r\n")
    return Record(fields, dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:]), payload)


class BundleWriter:
    """Writes records to bundles in a folder, and says where each of them went."""

    def __init__(self, folder: str, frame: int = FRAME, bundle: int = BUNDLE) -> None:
        self.files, self.path = _store(folder)
        self.frame, self.bundle = frame, bundle
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
        self.stream = None
        self.open, self.open_size = [], 0

    def add(self, page_id: int | None, record: bytes) -> Iterator[tuple]:
        """Index rows of the records whose frame is written by now."""
        self.open.append((page_id, record))
        self.open_size += len(record)
        if self.open_size >= self.frame:
            yield from self.end_frame()
            if self.written >= self.bundle:
                self.end_bundle()

    def end_frame(self) -> Iterator[tuple]:
        if not self.open:
            return
        if self.stream is None:
            self.name = f"{uuid.uuid4().hex}.warc.zst"
            self.files.create_dir(self.path, recursive=True)
            self.stream = self.files.open_output_stream(f"{self.path}/{self.name}.part")
            self.frames, self.written = [], 0
        raw = b"".join(record for _, record in self.open)
        packed = self.compressor.compress(raw)
        self.stream.write(packed)
        start = 0
        for page_id, record in self.open:
            yield page_id, self.name, len(self.frames), start, len(record)
            start += len(record)
        self.frames.append((len(packed), len(raw)))
        self.written += len(packed)
        self.open, self.open_size = [], 0

    def end_bundle(self) -> None:
        """Write the seek table and give the bundle its name."""
        if self.stream is None:
            return
        entries = b"".join(struct.pack("<II", *sizes) for sizes in self.frames)
        footer = struct.pack("<IBI", len(self.frames), 0, SEEK_FOOTER)
        self.stream.write(struct.pack("<II", SEEK_HEADER, len(entries) + len(footer)) + entries + footer)
        self.stream.close()
        self.files.move(f"{self.path}/{self.name}.part", f"{self.path}/{self.name}")
        self.stream = None

    def finish(self) -> Iterator[tuple]:
        yield from self.end_frame()
        self.end_bundle()


class BundleReader:
    """Reads single frames of a bundle by its seek table; keeps the last one."""

    def __init__(self, folder: str, name: str) -> None:
        files, path = _store(folder)
        self.file = files.open_input_file(f"{path}/{name}")
        size = self.file.size()
        n, _, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != SEEK_FOOTER:
            raise ValueError(f"{name} has no seek table")
        entries = self.file.read_at(8 * n, size - 9 - 8 * n)
        self.sizes = list(struct.iter_unpack("<II", entries))
        self.starts = [0]
        for packed, _ in self.sizes:
            self.starts.append(self.starts[-1] + packed)
        self.last: tuple[int, bytes] = (-1, b"")

    def record(self, frame: int, start: int, size: int) -> Record:
        if self.last[0] != frame:
            packed, raw = self.sizes[frame]
            data = zstandard.ZstdDecompressor().decompress(self.file.read_at(packed, self.starts[frame]), max_output_size=raw)
            self.last = (frame, data)
        return parse_record(self.last[1][start : start + size])

    def close(self) -> None:
        self.file.close()


def with_references(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Rows (page_id, url, html, digest, refers_to): what each record refers to, null for a response.

    Of rows with equal payloads of at least ``least_bytes``, those with the smallest page_id are responses. Shorter ones
    get a key of their own, so that they don't meet in one task.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", F.sha2(payload, 256).alias("digest"), (F.octet_length(payload) >= least_bytes).alias("long"))
    groups = rows.filter("long").groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    first = materialise(groups.filter("n > 1 and first is not null").select(F.col("digest").alias("same"), "first"), "warc-copies").until_exit()
    own = F.concat_ws("-", F.lit(""), "page_id", "digest")
    keyed = rows.withColumn("key", F.when(F.col("long"), F.col("digest")).otherwise(own))
    joined = keyed.join(first, F.col("key") == F.col("same"), "left")
    refers_to = F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("first")), F.col("first"))
    return joined.select("page_id", "url", "html", "digest", refers_to.alias("refers_to"))


def write(pages: DataFrame, folder: str, frame: int = FRAME, bundle: int = BUNDLE) -> DataFrame:
    """Write a record for every row of ``pages`` and return the stored index, one row for each record.

    A null page counts as empty, a null url leaves its field out. Repeated rows are repeated records. Bundles in the folder
    that no index row names were left by tasks that were run again, and may be removed.
    """

    def archive(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        writer = BundleWriter(folder, frame, bundle)
        columns = ["page_id", "bundle", "frame", "start", "size"]
        for batch in batches:
            rows = []
            ids, links = (batch[name].astype("object").where(batch[name].notna(), None) for name in ("page_id", "refers_to"))
            for page_id, url, page, digest, refers_to in zip(ids, batch["url"], batch["html"], batch["digest"], links):
                page_id, refers_to = (None if x is None else int(x) for x in (page_id, refers_to))
                record = build_record(page_id, url, (page or "").encode("utf-8", "surrogatepass"), digest, refers_to)
                rows += writer.add(page_id, record)
            yield _index(rows, columns)
        yield _index(list(writer.finish()), columns)

    # Ids travel as text where they may be null, since a column of floats would round them.
    named = with_references(pages).withColumns({name: F.col(name).cast("string") for name in ("page_id", "refers_to")})
    return materialise(named.mapInPandas(archive, INDEX), "warc-index").until_exit()


def _index(rows: list[tuple], columns: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=columns, dtype=object)
    return frame.assign(page_id=frame["page_id"].astype("Int64"))


def read(index: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """The records that some rows of the index name, whole: all of them, or the few that were looked up.

    Rows are sorted by place, so each frame is read once. Digest and length of a response are taken from the payload
    that was read, and must equal its header; those of a revisit from its header.
    """
    # Rows are small but stand for whole bundles, so there is a partition for each bundle, which Spark doesn't merge by size.
    n_bundles = index.agg(F.count_distinct("bundle").alias("n")).first()["n"]
    rows = index.repartition(max(1, n_bundles), "bundle").sortWithinPartitions("bundle", "frame", "start")
    columns = [column.split()[0] for column in RECORD.split(", ")]

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, reader = None, None
        for batch in batches:
            found = []
            for bundle, frame, start, size in zip(batch["bundle"], batch["frame"], batch["start"], batch["size"]):
                if bundle != name:
                    if reader:
                        reader.close()
                    name, reader = bundle, BundleReader(folder, bundle)
                found.append(_row(reader.record(frame, start, size), with_payload))
            table = pd.DataFrame(found, columns=columns, dtype=object)
            yield table.assign(page_id=table["page_id"].astype("Int64"), refers_to=table["refers_to"].astype("Int64"))
        if reader:
            reader.close()

    return rows.mapInPandas(fetch, RECORD)


def _row(record: Record, with_payload: bool) -> tuple:
    fields = record.fields
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha256:")
    length = int(record.head["Content-Length"])
    if kind == RESPONSE and (hashlib.sha256(record.payload).hexdigest() != digest or len(record.payload) != length):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} is damaged")
    refers_to = _page_id(fields["WARC-Refers-To"]) if kind == REVISIT else None
    payload = record.payload if with_payload and kind == RESPONSE else None
    return _page_id(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), kind, payload, length, digest, refers_to
