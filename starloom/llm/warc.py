"""WARC archives: written and read by tasks, one gzip member per record.

Writing: payload digests are compared by key, not payloads: the largest ``page_id``
of each digest of at least ``min_bytes`` bytes is found by one aggregation and joined
back; that page's record is the response, and the others become revisit records that
refer to it and leave the payload out. Each task writes its rows to one archive, under
a temporary name that is moved to the archive's name when it is whole; the name
follows from the partition, so a task that runs again replaces its own archive.

Reading: a sequential reader takes an archive in chunks, unpacks member by member
with an incremental zlib object, frames each record by its Content-Length and compares
the digests of block and payload. Memory holds one record. A damaged or cut archive
raises ``WarcError`` with its offset.

Files are reached through Arrow's file systems, so any scheme these know will do.

Cases: a null page is an empty payload; a null ``page_id`` or url is left out of the
record's header and comes back null (it never becomes a response that others refer
to); repeated rows of the response's id are responses all; an empty table gives
no records; other columns are not written.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from typing import BinaryIO

import pandas as pd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .stage import shared_path

CHUNK = 1 << 16
CRLF = b"\r\n"
MIN_BYTES = 1000
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class WarcError(ValueError):
    """An archive that cannot be read as written."""


@dataclass
class Record:
    """A record's headers in lower case, and its block."""

    headers: dict[str, str]
    block: bytes
    offset: int = 0
    http: dict[str, str] = field(default_factory=dict)
    payload: bytes = b""


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int) -> str:
    return f"<{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}').urn}>"


def _header(text: str) -> str:
    """A header value: one line, white space at the ends lost by the format anyway."""
    return text.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _plain(text: str) -> str:
    return text.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record as a gzip member."""
    http = [b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8",
            b"Content-Length: %d" % len(payload)]
    block = CRLF.join(http) + CRLF * 2 + (payload if refers_to is None else b"")
    kind = "response" if refers_to is None else "revisit"
    headers = [("WARC-Type", kind), ("WARC-Date", "1970-01-01T00:00:00Z")]
    if page_id is not None:
        headers += [("WARC-Record-ID", record_id(page_id)), ("X-Page-ID", str(page_id))]
    else:
        headers += [("WARC-Record-ID", f"<{uuid.uuid4().urn}>")]
    if url is not None:
        headers += [("WARC-Target-URI", _header(url))]
    if refers_to is not None:
        headers += [
            ("WARC-Profile", _REVISIT_PROFILE),
            ("WARC-Refers-To", record_id(refers_to)),
            ("X-Refers-To-Page-ID", str(refers_to)),
        ]
    headers += [
        ("WARC-Payload-Digest", _sha1(payload)),
        ("WARC-Block-Digest", _sha1(block)),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    head = "".join(f"{k}: {v}\r\n" for k, v in headers).encode()
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(b"WARC/1.1\r\n" + head + CRLF + block + CRLF * 2) + pack.flush()


class _Member:
    """Bytes of one gzip member, unpacked as they are asked for."""

    def __init__(self, source: "WarcReader"):
        self.source = source
        self.zip = zlib.decompressobj(31)
        self.ready = bytearray()

    def _more(self) -> bool:
        """Unpack some more; False at the member's end."""
        while not self.zip.eof:
            data = self.zip.unconsumed_tail or self.source.take()
            if not data:
                raise WarcError(f"archive ends within a record at {self.source.start}")
            try:
                got = self.zip.decompress(data, CHUNK)
            except zlib.error as e:
                raise WarcError(f"damaged record at {self.source.start}: {e}") from e
            if self.zip.eof:
                self.source.give_back(self.zip.unused_data)
            if got:
                self.ready += got
                return True
        return False

    def line(self) -> bytes:
        searched = 0
        while (at := self.ready.find(CRLF, searched)) < 0:
            searched = max(0, len(self.ready) - 1)
            if not self._more():
                raise WarcError(f"header without end at {self.source.start}")
        found = bytes(self.ready[:at])
        del self.ready[: at + 2]
        return found

    def exactly(self, n: int) -> bytes:
        while len(self.ready) < n:
            if not self._more():
                raise WarcError(f"record shorter than its Content-Length at {self.source.start}")
        found = bytes(self.ready[:n])
        del self.ready[:n]
        return found

    def rest(self) -> bytes:
        while len(self.ready) <= 4 and self._more():
            pass
        return bytes(self.ready)


class WarcReader:
    """The records of an archive, one after the other."""

    def __init__(self, stream: BinaryIO):
        self.stream = stream
        self.held = b""
        self.read = 0
        self.start = 0  # offset of the current record

    def take(self) -> bytes:
        if self.held:
            data, self.held = self.held, b""
            return data
        data = self.stream.read(CHUNK)
        self.read += len(data)
        return data

    def give_back(self, data: bytes) -> None:
        self.held = data

    def __iter__(self) -> Iterator[Record]:
        while True:
            first = self.take()
            if not first:
                return
            self.give_back(first)
            self.start = self.read - len(first)
            yield self._record()

    def _record(self) -> Record:
        member = _Member(self)
        if not member.line().startswith(b"WARC/"):
            raise WarcError(f"no WARC record at {self.start}")
        headers = self._headers(member)
        try:
            block = member.exactly(int(headers["content-length"]))
        except (KeyError, ValueError) as e:
            if isinstance(e, WarcError):
                raise
            raise WarcError(f"no Content-Length at {self.start}") from e
        if member.rest() != CRLF * 2:
            raise WarcError(f"record longer than its Content-Length at {self.start}")
        if headers.get("warc-block-digest", _sha1(block)) != _sha1(block):
            raise WarcError(f"block digest differs at {self.start}")
        record = Record(headers, block, self.start)
        if headers.get("warc-type") in ("response", "revisit"):
            head, _, record.payload = block.partition(CRLF * 2)
            for line in head.split(CRLF)[1:]:
                name, _, value = line.decode().partition(":")
                record.http[name.strip().lower()] = value.strip()
        if headers.get("warc-type") == "response":
            digest = headers.get("warc-payload-digest")
            if digest is not None and digest != _sha1(record.payload):
                raise WarcError(f"payload digest differs at {self.start}")
        return record

    @staticmethod
    def _headers(member: _Member) -> dict[str, str]:
        headers: dict[str, str] = {}
        while line := member.line():
            name, _, value = line.decode("utf-8").partition(":")
            headers[name.strip().lower()] = value.strip()
        return headers


def plan_records(
    pages: DataFrame, *, key: str = "page_id", url: str = "url", page: str = "html",
    min_bytes: int = MIN_BYTES,
) -> DataFrame:
    """``page_id, url, payload, refers_to`` of each page."""
    own = pages.select(
        F.col(key).alias("page_id"),
        F.col(url).alias("url"),
        F.encode(F.coalesce(F.col(page), F.lit("")), "UTF-8").alias("payload"),
    ).withColumn(
        "digest", F.when(F.length("payload") >= min_bytes, F.unhex(F.sha1("payload")))
    )
    shared = (
        own.where("digest is not null")
        .groupBy("digest")
        .agg(F.max("page_id").alias("response"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and response is not null")
        .select("digest", "response")
    )
    return own.join(shared, "digest", "left").select(
        "page_id",
        "url",
        "payload",
        F.when(~F.col("page_id").eqNullSafe(F.col("response")), F.col("response")).alias("refers_to"),
    )


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Write ``page_id, url, payload, refers_to`` rows and return ``path, n_records`` of
    the archives. Runs once, here; the result is a small written table."""

    def write(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get()
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        name = f"{root}/part-{part.partitionId():06d}.warc.gz"
        trial = f"{root}/_part-{part.partitionId():06d}-{part.taskAttemptId()}"
        n = 0
        out = None
        for batch in batches:
            for page_id, url, payload, refers_to in zip(
                *(batch[c].astype(object) for c in ("page_id", "url", "payload", "refers_to")),
                strict=True,
            ):
                out = out or store.open_output_stream(trial, compression=None)
                out.write(
                    record_bytes(
                        None if pd.isna(page_id) else int(page_id),
                        url,
                        bytes(payload),
                        None if pd.isna(refers_to) else int(refers_to),
                    )
                )
                n += 1
        if out is not None:
            out.close()
            store.move(trial, name)
            yield pd.DataFrame({"path": [name], "n_records": [n]})

    spark = records.sparkSession
    index = f"{folder}/_index"
    # 2^53 and above would not survive as a float beside a null
    as_text = records.withColumns({c: F.col(c).cast("string") for c in ("page_id", "refers_to")})
    as_text.mapInPandas(write, "path string, n_records long").write.parquet(index)
    return spark.read.parquet(index)


def read_archives(
    spark: SparkSession, folder: str, index: DataFrame, *, payloads: bool = True
) -> DataFrame:
    """Per record ``page_id, url, payload_bytes, payload_digest, record_type, refers_to,
    payload`` (null for revisits, and without ``payloads``). One archive goes to one task."""

    def read(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path in batch["path"]:
                with store.open_input_stream(path, compression=None) as stream:
                    rows, size = [], 0
                    for record in WarcReader(stream):
                        rows.append(_row(record, payloads))
                        size += len(record.payload) if payloads else 0
                        if size > 1 << 24 or len(rows) >= 10_000:
                            yield pd.DataFrame(rows, columns=_COLUMNS)
                            rows, size = [], 0
                    if rows:
                        yield pd.DataFrame(rows, columns=_COLUMNS)

    found = index.select("path").repartitionByRange(max(1, index.count()), "path").mapInPandas(
        read,
        "page_id string, url string, payload_bytes long, payload_digest string,"
        " record_type string, refers_to string, payload binary",
    )
    return found.withColumns({c: F.col(c).cast("long") for c in ("page_id", "refers_to")})


_COLUMNS = ("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload")


def _row(record: Record, payloads: bool) -> tuple:
    kind = record.headers["warc-type"]
    digest = record.headers["warc-payload-digest"].removeprefix("sha1:")
    target = record.headers.get("warc-target-uri")
    return (
        record.headers.get("x-page-id"),
        None if target is None else _plain(target),
        int(record.http["content-length"]),
        base64.b32decode(digest).hex(),
        kind,
        record.headers.get("x-refers-to-page-id"),
        record.payload if payloads and kind == "response" else None,
    )


def round_trip(pages: DataFrame, *, payloads: bool = True, **columns) -> DataFrame:
    """Write the pages to archives in the shared folder and read these back."""
    spark = pages.sparkSession
    folder = shared_path(spark, "warc")
    if "://" not in folder and not folder.startswith("file:"):
        folder = f"file://{folder}"
    index = write_archives(plan_records(pages, **columns), folder)
    return read_archives(spark, folder, index, payloads=payloads)
