"""Web archives as a Spark data source, in Python.

Reading plans partitions from the files' sizes, a large file in several ranges. A record's headers
are parsed first; record types and header values that a filter rules out are passed over
without touching the payload, in plain files without reading it. The option ``payload`` set to
``false`` does so for all records.

Writing makes one file for each task under a name of its own. Files become part of the archive
when the job commits, so that retried and lost tasks leave nothing behind. Each commit adds a list
of its files, which is never changed, with a place in every so many bytes where a record begins.
Ranges are cut at these places alone: payloads may quote whole records, so that no look at a place
tells whether a record begins there. Files of others have no such list and are read whole.

Paths are opened by ``pyarrow.fs``: local or mounted folders, and the object stores and HDFS it
knows.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import re
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from publicspend.llm.common import scratch, stored, take

VERSION = b"WARC/1.1"
END = b"\r\n\r\n"
MANIFEST = "_files-"
MOST_HEADER_BYTES = 1 << 24
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
#: Columns that come from one header each.
HEADERS = {
    "record_type": "warc-type",
    "record_id": "warc-record-id",
    "target_uri": "warc-target-uri",
    "refers_to": "warc-refers-to",
    "payload_digest": "warc-payload-digest",
}
READ_SCHEMA = (
    "record_type string, record_id string, target_uri string, refers_to string, "
    "payload_digest string, content_length bigint, http_headers string, payload binary"
)
#: Columns of a table to write: the record's headers, and the payload unless it is a revisit.
WRITE_SCHEMA = (
    "record_type string, record_id string, target_uri string, refers_to string, "
    "payload_digest string, payload_length bigint, payload binary"
)
_CONTROL = re.compile("[\x00-\x20\x7f]")


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _file_system(path: str) -> tuple[fs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


def _listed(files: fs.FileSystem, found: list[fs.FileInfo]) -> dict[str, list[int]] | None:
    """The files of the archive and where their records may be cut, if it was written here."""
    lists = [f for f in found if f.base_name.startswith(MANIFEST) and f.base_name.endswith(".json")]
    if not lists:
        return None
    names: dict[str, list[int]] = {}
    for each in lists:
        with files.open_input_stream(each.path) as stream:
            names |= json.loads(stream.read())
    return names


def _escaped(uri: str) -> str:
    """Without characters that would end a header."""
    return _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", uri)


def record_bytes(row: dict) -> bytes:
    """One record: WARC headers, HTTP headers and, unless it is a revisit, the payload."""
    revisit = row["record_type"] == "revisit"
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {row['payload_length']}\r\n\r\n"
    ).encode()
    body = http if revisit else http + (row["payload"] or b"")
    head = [
        ("WARC-Type", row["record_type"]),
        ("WARC-Record-ID", row["record_id"]),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", row["target_uri"] and _escaped(row["target_uri"])),
        ("WARC-Refers-To", row["refers_to"]),
        ("WARC-Profile", PROFILE if revisit else None),
        ("WARC-Payload-Digest", row["payload_digest"] and f"sha1:{row['payload_digest']}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(body))),
    ]
    lines = "".join(f"{name}: {value}\r\n" for name, value in head if value is not None)
    return VERSION + b"\r\n" + lines.encode() + b"\r\n" + body + END


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, compression: str, mark_bytes: int):
        self.path, self.compression, self.mark_bytes = path, compression, mark_bytes

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        files, folder = _file_system(self.path)
        files.create_dir(folder, recursive=True)
        packed = self.compression == "gzip"
        name = f"{uuid.uuid4().hex}.warc" + ".gz" * packed
        place, starts = 0, [0]
        with files.open_output_stream(f"{folder}/{name}", compression=None) as out:
            for batch in iterator:
                for i in range(batch.num_rows):  # payloads are turned into objects one at a time
                    record = record_bytes(batch.slice(i, 1).to_pylist()[0])
                    data = gzip.compress(record, 6) if packed else record
                    if place - starts[-1] >= self.mark_bytes:
                        starts.append(place)
                    out.write(data)
                    place += len(data)
        return Written(name if place else None, starts)

    def commit(self, messages: list) -> None:
        """The files listed here are part of the archive, once the list is whole."""
        files, folder = _file_system(self.path)
        files.create_dir(folder, recursive=True)
        names = {m.name: m.starts for m in messages if m is not None and m.name}
        name = uuid.uuid4().hex
        with files.open_output_stream(f"{folder}/.{name}") as out:
            out.write(json.dumps(names).encode())
        files.move(f"{folder}/.{name}", f"{folder}/{MANIFEST}{name}.json")

    def abort(self, messages: list) -> None:
        files, folder = _file_system(self.path)
        for message in messages:
            if message is not None and message.name:
                files.delete_file(f"{folder}/{message.name}")


@dataclass
class Written(WriterCommitMessage):
    name: str | None
    starts: list[int]


@dataclass
class Range(InputPartition):
    """The records of a file that start in [start, end)."""

    path: str
    start: int
    end: int


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.split = int(options.get("splitbytes", 64 << 20))
        self.with_payload = options.get("payload", "true").lower() != "false"
        self.wanted: list[tuple[str, frozenset[str]]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        """Takes over equality and membership tests on columns that are headers."""
        for each in filters:
            column = ".".join(each.attribute) if hasattr(each, "attribute") else ""
            if column in HEADERS and isinstance(each, EqualTo):
                self.wanted.append((HEADERS[column], frozenset([each.value])))
            elif column in HEADERS and isinstance(each, In):
                self.wanted.append((HEADERS[column], frozenset(each.value)))
            elif column in HEADERS and isinstance(each, IsNotNull):
                self.wanted.append((HEADERS[column], frozenset()))
            else:
                yield each

    def partitions(self) -> Sequence[Range]:
        files, folder = _file_system(self.path)
        info = files.get_file_info(folder)
        single = info.type == fs.FileType.File
        found = files.get_file_info(fs.FileSelector(folder.rsplit("/", 1)[0] if single else folder))
        names = _listed(files, found)
        known = names or {}
        chosen = [
            f
            for f in found
            if f.type == fs.FileType.File
            and (
                f.path == info.path
                if single
                else f.base_name in known
                if names is not None
                else ".warc" in f.base_name
            )
        ]
        ranges = []
        for file in sorted(chosen, key=lambda f: f.path):
            cuts = [0]
            for start in known.get(file.base_name, ()):
                if start - cuts[-1] >= self.split:
                    cuts.append(start)
            ends = [*cuts[1:], file.size]
            ranges += [Range(file.path, s, e) for s, e in zip(cuts, ends, strict=True) if e > s]
        return ranges or [Range("", 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        rows: list[tuple] = []
        size = 0
        files, _ = _file_system(self.path)
        with files.open_input_file(partition.path) as source:
            for row in self._records(source, partition):
                rows.append(row)
                size += len(row[-1] or b"")
                if size > 4 << 20 or len(rows) >= 2000:
                    yield _batch(rows)
                    rows, size = [], 0
        if rows:
            yield _batch(rows)

    def _passes(self, headers: dict[str, str]) -> bool:
        for name, values in self.wanted:
            value = _value(headers, name)
            if value is None or (values and value not in values):
                return False
        return True

    def _records(self, source, partition: Range) -> Iterator[tuple]:
        if partition.path.endswith(".gz"):
            data = _Stretch(source, partition.start, partition.end)
            reader, end = _Buffered(gzip.GzipFile(fileobj=data), 0), None
        else:
            reader, end = _Buffered(source, partition.start), partition.end
        while end is None or reader.place < end:
            headers = reader.headers()
            if headers is None:
                return
            length = int(headers.get("content-length", 0))
            if not self._passes(headers):
                reader.skip(length + len(END))
                continue
            http, body = b"", length
            if headers.get("content-type", "").startswith("application/http"):
                http = reader.until(END, length)
                body = length - len(http)
            if self.with_payload and headers.get("warc-type") != "revisit":
                payload = reader.exactly(body)
            else:
                payload = None
                reader.skip(body)
            reader.skip(len(END))
            yield (
                *(_value(headers, name) for name in HEADERS.values()),
                length,
                http.decode("latin-1"),
                payload,
            )


def _value(headers: dict[str, str], name: str) -> str | None:
    value = headers.get(name)
    return value.removeprefix("sha1:") if value and name == "warc-payload-digest" else value


class _Buffered:
    """Reads forward in a file or an unpacked stream; skipping a plain file seeks."""

    def __init__(self, stream, place: int):
        self.stream, self.place, self.ahead = stream, place, b""
        if place:
            stream.seek(place)

    def _more(self, size: int = 1 << 16) -> bool:
        data = self.stream.read(size)
        self.ahead += data
        return bool(data)

    def exactly(self, size: int) -> bytes:
        while len(self.ahead) < size:
            if not self._more(max(1 << 16, size - len(self.ahead))):
                raise EOFError("a record is cut off")
        found, self.ahead = self.ahead[:size], self.ahead[size:]
        self.place += size
        return found

    def skip(self, size: int) -> None:
        self.place += size
        if size <= len(self.ahead):
            self.ahead = self.ahead[size:]
        elif isinstance(self.stream, gzip.GzipFile):
            size -= len(self.ahead)
            self.ahead = b""
            while size > 0:
                got = len(self.stream.read(min(size, 1 << 20)))
                if not got:
                    raise EOFError("a record is cut off")
                size -= got
        else:
            self.ahead = b""
            self.stream.seek(self.place)

    def until(self, mark: bytes, limit: int) -> bytes:
        """Up to and with ``mark``, ``limit`` bytes at most."""
        searched = 0
        while (at := self.ahead.find(mark, searched, limit)) < 0:
            searched = max(0, len(self.ahead) - len(mark))
            if len(self.ahead) >= limit or not self._more():
                return self.exactly(min(limit, len(self.ahead)))
        return self.exactly(at + len(mark))

    def headers(self) -> dict[str, str] | None:
        if not self.ahead and not self._more():
            return None
        block = self.until(END, MOST_HEADER_BYTES)
        if not block.endswith(END):
            raise ValueError(f"headers at byte {self.place - len(block)} do not end")
        lines = block.decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {self.place - len(block)}")
        pairs = (line.partition(":") for line in lines[1:] if line)
        return {name.strip().lower(): value.strip() for name, _, value in pairs}


class _Stretch(io.RawIOBase):
    """The bytes of a file from ``start`` to ``end``; the members of a packed file can be read so."""

    def __init__(self, source, start: int, end: int):
        source.seek(start)
        self.source, self.left = source, end - start

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        data = self.source.read(min(len(buffer), self.left))
        buffer[: len(data)] = data
        self.left -= len(data)
        return len(data)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string()] * 5 + [pa.int64(), pa.string(), pa.binary()]
    names = [part.split()[0] for part in READ_SCHEMA.split(", ")]
    columns = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names)


class WarcDataSource(DataSource):
    """``spark.read.format("warc")`` and ``df.write.format("warc")``.

    Options: ``path``; to read ``payload`` and ``splitBytes``; to write ``compression``
    (``none`` or ``gzip``, a member for each record) and ``markBytes``, how far apart the places
    are at which a file may be cut. Headers of more than 16 MiB are refused.

    Load anew for each query: Spark keeps the filters that were pushed down with the loaded table,
    and a later query over the same DataFrame would meet them again.
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return READ_SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        marks = int(self.options.get("markbytes", 1 << 20))
        return _Writer(self.options["path"], self.options.get("compression", "none"), marks)


def register(spark: SparkSession) -> None:
    """Make the format known, and let filters reach it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def records_of(
    pages: DataFrame,
    least_bytes: int = 0,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
) -> DataFrame:
    """A record for each page, in the columns to write.

    Of pages with equal payloads of ``least_bytes`` or more, those with the largest id are
    responses and the others revisit it. Payloads are equal if their SHA-1 and length are.
    Null html is an empty payload. A page with a null id revisits a page with an id if there is
    one. Repeated rows of the largest id are all responses.
    """
    rows = take(pages, page_id=id_column, url=url_column, html=html_column)
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    known = rows.select("page_id", "url", payload.alias("payload")).withColumns(
        {"sha1": F.unhex(F.sha1("payload")), "payload_length": F.length("payload").cast("bigint")}
    )
    copied = (
        known.where(F.col("payload_length") >= least_bytes)
        .groupBy("sha1", "payload_length")
        .agg(F.max("page_id").alias("first_id"), F.count("*").alias("copies"))
        .where("copies > 1")
        .select(F.col("sha1").alias("_sha1"), F.col("payload_length").alias("_length"), "first_id")
    )
    groups = stored(copied, "copies")  # Spark then knows if they are few, and payloads stay in place
    same = (F.col("sha1") == F.col("_sha1")) & (F.col("payload_length") == F.col("_length"))
    met = known.join(groups, same, "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return met.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        _urn(F.col("page_id")).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.when(revisit, _urn(F.col("first_id"))).alias("refers_to"),
        base32(F.col("sha1")).alias("payload_digest"),
        "payload_length",
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def _urn(number: F.Column) -> F.Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(number.cast("string"), F.lit("none")), F.lit(">"))


def _number(urn: F.Column) -> F.Column:
    return F.regexp_extract(urn, "<urn:page:(-?[0-9]+)>", 1).try_cast("bigint")


def base32(digest: F.Column) -> F.Column:
    """Twenty bytes in base 32: each five bytes are eight digits."""
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    digits = []
    for part in range(4):
        value = F.conv(F.hex(F.substring(digest, 5 * part + 1, 5)), 16, 10).cast("bigint")
        for place in range(7, -1, -1):
            index = F.shiftright(value, 5 * place).bitwiseAND(F.lit(31))
            digits.append(F.substring(F.lit(alphabet), (index + 1).cast("int"), F.lit(1)))
    return F.concat(*digits)


def write_archive(
    records: DataFrame, path: str, compression: str = "none", mark_bytes: int = 1 << 20
) -> None:
    register(records.sparkSession)
    options = {"compression": compression, "markBytes": str(mark_bytes)}
    records.write.format("warc").options(**options).mode("append").save(path)


def read_archive(
    spark: SparkSession, path: str, payload: bool = True, split_bytes: int = 64 << 20
) -> DataFrame:
    register(spark)
    options = {"payload": str(payload).lower(), "splitBytes": str(split_bytes)}
    return spark.read.format("warc").options(**options).load(path)


def round_trip(pages: DataFrame, least_bytes: int = 0, compression: str = "none") -> DataFrame:
    """``page_id``, ``payload_bytes``, ``payload_digest``, ``record_type`` and ``refers_to`` of
    every page, as read back from an archive of them.

    Responses are read with their payloads, of which size and digest are taken; revisits have
    none, so they are read without, and both are from their headers. Each read pushes its record
    type down. An empty table gives an empty archive and no rows.
    """
    spark = pages.sparkSession
    path = scratch(spark, "warc")
    write_archive(records_of(pages, least_bytes), path, compression)
    responses = read_archive(spark, path).where("record_type = 'response'")
    revisits = read_archive(spark, path, payload=False).where("record_type = 'revisit'")
    length = F.regexp_extract("http_headers", "(?i)content-length: *([0-9]+)", 1).cast("bigint")

    def read(records: DataFrame, size: F.Column, digest: F.Column) -> DataFrame:
        return records.select(
            _number(F.col("record_id")).alias("page_id"),
            size.alias("payload_bytes"),
            digest.alias("payload_digest"),
            "record_type",
            _number(F.col("refers_to")).alias("refers_to"),
        )

    own = read(
        responses, F.length("payload").cast("bigint"), base32(F.unhex(F.sha1("payload")))
    )
    return own.union(read(revisits, length, F.col("payload_digest")))
