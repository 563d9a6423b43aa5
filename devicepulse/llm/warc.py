"""WARC archives of individually compressed records that share a dictionary.

Each archive begins with a skippable frame that holds a Zstandard dictionary built from the archive's own
first records; after it comes one frame per record, so a reader can take any record by its offset.
Payloads that were archived already become `revisit` records, which carry the digest and refer to the
response that holds the payload.

Tasks write archives of a bounded size straight to the shared folder, under a name of their own attempt,
and hand back only a list of archives; readers go by that list, so what a lost or repeated task left
behind is not read. Nothing larger than one record and the dictionary's sample is held in memory.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from devicepulse.llm.common import slices, stored
from devicepulse.sources.workspace import scratch_path

# Fixed by the format: the skippable frame that holds the dictionary.
DICTIONARY_FRAME = 0x184D2A5D
DEDUP_BYTES = 1000  # shorter payloads are always written whole
DATE = "1970-01-01T00:00:00Z"


@dataclass(frozen=True)
class Limits:
    """What bounds a task's memory and an archive's size."""

    sample_bytes: int = 2 << 20
    dictionary_bytes: int = 64 << 10
    archive_bytes: int = 64 << 20
    level: int = 6


def _build_dictionary(samples: list[bytes], limits: Limits) -> bytes:
    """A trained dictionary; with too few records to train on, the records themselves."""
    try:
        # Fixed segment and match lengths: trained in one pass.
        made = zstandard.train_dictionary(limits.dictionary_bytes, samples, k=512, d=8)
        return made.as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-limits.dictionary_bytes :]


def _as_dictionary(raw: bytes) -> zstandard.ZstdCompressionDict:
    return zstandard.ZstdCompressionDict(raw)


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


class _Archive:
    """One archive being written; records wait until there is a dictionary."""

    def __init__(self, folder: str, limits: Limits):
        self.limits, self.waiting, self.held, self.size, self.records = limits, [], 0, 0, 0
        self.path = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        self.out = self.coder = None

    def add(self, record: bytes) -> None:
        self.records += 1
        if self.coder is not None:
            self._put(self.coder.compress(record))
            return
        self.waiting.append(record)
        self.held += len(record)
        if self.held >= self.limits.sample_bytes:
            self._begin()

    def _begin(self) -> None:
        raw = _build_dictionary(self.waiting, self.limits)
        system, path = _open(self.path)
        system.create_dir(path.rpartition("/")[0], recursive=True)
        self.out = system.open_output_stream(path, compression=None)
        self._put(struct.pack("<II", DICTIONARY_FRAME, len(raw)) + raw)
        self.coder = zstandard.ZstdCompressor(level=self.limits.level, dict_data=_as_dictionary(raw))
        for record in self.waiting:
            self._put(self.coder.compress(record))
        self.waiting = []

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def close(self) -> tuple[str, int]:
        if self.coder is None:
            self._begin()
        self.out.close()
        return self.path, self.records


def _record(kind: str, record_id: str, uri: str, digest: str, refers: str | None, n: int, payload: bytes) -> bytes:
    """A record whose block is an HTTP response; that of a revisit has the header only, with the length
    of the payload that it stands for."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n".encode()
    block = http + payload
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {DATE}"]
    lines += [f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha1:{digest}"]
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
        lines += [f"WARC-Refers-To: <{refers}>"] if refers else []
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


_ID = "urn:page:"


def write(
    pages: DataFrame,
    folder: str,
    limits: Limits = Limits(),
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """Archive every row under `folder`; returns the list of archives (path, records), stored.

    The payload is the text in UTF-8; null is empty. Of rows with equal payloads of at least
    `DEDUP_BYTES`, the one with the largest id is a response and the others revisit it; rows that share
    the largest id are all responses, as are rows without an id where no equal row has one. Line ends in a
    URL become spaces. Rows are matched by digest on (digest, id) alone; payloads move at most once, by
    row, so however many copies there are no task gets them all.
    """
    text = F.encode(F.coalesce(F.col(f"`{html}`"), F.lit("")), "utf-8")
    whole = pages.select(
        F.col(f"`{page_id}`").cast("bigint").alias("id"),
        F.regexp_replace(F.coalesce(F.col(f"`{url}`"), F.lit("")), r"[\r\n]+", " ").alias("uri"),
        text.alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    # Partial counts leave one row per digest and task, and only repeated payloads come out.
    repeated = (
        whole.where(F.length("payload") >= DEDUP_BYTES)
        .groupBy("digest")
        .agg(F.max("id").alias("first"), F.count("*").alias("n"))
        .where("n > 1 AND first IS NOT NULL")
        .select("digest", "first")
    )
    rows = whole.join(repeated, "digest", "left").select("id", "uri", "digest", "first", "payload")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, done = None, []
        for batch in slices(batches, 64):
            for id_, uri, digest, first, payload in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                again = first is not None and first != id_
                if archive is None:
                    archive = _Archive(folder, limits)
                kind, kept = ("revisit", b"") if again else ("response", payload)
                refers = f"{_ID}{first}" if again else None
                name = f"{_ID}{'' if id_ is None else id_}"
                archive.add(_record(kind, name, uri, digest, refers, len(payload), kept))
                if archive.size >= limits.archive_bytes:
                    done.append(archive.close())
                    archive = None
        if archive is not None:
            done.append(archive.close())
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())],
            ["path", "records"],
        )

    return stored(rows.mapInArrow(run, "path string, records bigint"), "archives")


def frames(path: str) -> Iterator[bytes]:
    """The records of an archive, one at a time; the dictionary comes from its first frame."""
    system, name = _open(path)
    with system.open_input_stream(name, compression=None) as stream:
        head = stream.read(8)
        magic, size = struct.unpack("<II", head)
        if magic != DICTIONARY_FRAME:
            raise ValueError(f"{path} does not begin with a dictionary frame")
        coder = zstandard.ZstdDecompressor(dict_data=_as_dictionary(stream.read(size)))
        frame, parts, fed = coder.decompressobj(), [], False
        data = stream.read(1 << 20)
        while data:
            parts.append(frame.decompress(data))
            fed = True
            if frame.eof:
                yield b"".join(parts)
                data, frame, parts, fed = frame.unused_data, coder.decompressobj(), [], False
            else:
                data = b""
            data = data or stream.read(1 << 20)
        if fed:
            raise ValueError(f"{path} ends within a record")


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """A record's WARC headers, by lower-cased name, and its block."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = (line.partition(":") for line in head.decode("utf-8").split("\r\n")[1:])
    headers = {name.strip().lower(): value.strip() for name, _, value in fields}
    return headers, rest[: int(headers["content-length"])]


def read(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of listed archives: (page_id, url, record_type, payload, payload_bytes, payload_digest,
    refers_to). The payload of a revisit is null; its bytes and digest are those of the one it stands for. A
    response whose payload does not have the digest in its header raises. Without `payloads` they are
    read and checked, but left null in the rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "url", "record_type", "payload", "payload_bytes", "payload_digest", "refers_to"]
        kinds = [pa.int64(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.int64()]

        def made(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True) if rows else [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

        def number(urn: str | None) -> int | None:
            digits = (urn or "").strip("<>").removeprefix(_ID)
            return int(digits) if digits else None

        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, held = [], 0
                for record in frames(path):
                    headers, block = parse(record)
                    http, _, payload = block.partition(b"\r\n\r\n")
                    told = dict(x.split(b": ", 1) for x in http.split(b"\r\n")[1:])
                    digest = headers["warc-payload-digest"].removeprefix("sha1:")
                    response = headers["warc-type"] == "response"
                    if response and hashlib.sha1(payload).hexdigest() != digest:
                        raise ValueError(f"{path}: a payload does not have its digest")
                    rows.append(
                        (
                            number(headers["warc-record-id"]),
                            headers["warc-target-uri"],
                            headers["warc-type"],
                            payload if response and payloads else None,
                            int(told[b"Content-Length"]),
                            digest,
                            number(headers.get("warc-refers-to")),
                        )
                    )
                    held += 200 + len(payload) * payloads
                    if held > 1 << 20:
                        yield made(rows)
                        rows, held = [], 0
                yield made(rows)

    schema = (
        "page_id bigint, url string, record_type string, payload binary, payload_bytes bigint, "
        "payload_digest string, refers_to bigint"
    )
    # A number of partitions of its own, as the short list would be read by one task otherwise.
    parts = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return archives.select("path").repartition(parts, "path").mapInArrow(run, schema)


def new_folder(spark: SparkSession) -> str:
    """A fresh place for archives in the shared folder."""
    return scratch_path(spark, "warc")
