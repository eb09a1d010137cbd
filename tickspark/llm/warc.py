"""WARC archives as a Spark data source: ``spark.read.format("warc")`` and ``df.write.format("warc")``."""

from __future__ import annotations

import datetime
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceWriter,
    EqualTo,
    Filter,
    In,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from .common import same, stored

SCHEMA = (
    "record_id string, record_type string, target_uri string, payload_digest string, refers_to string, "
    "payload_bytes long, payload binary"
)
COLUMNS = tuple(part.split()[0] for part in SCHEMA.split(", "))
MANIFEST = "_archives.json"
FILE_BYTES = 128 << 20
PART_BYTES = 128 << 20
CHUNK = 1 << 20
# Names of the archive format's header fields, by column.
FIELDS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "payload_digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To",
}
LENGTH = "X-Payload-Length"  # of the full payload, also where a revisit leaves it out
VERSION = b"WARC/1.1\r\n"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def _file_system(path: str):
    """The store of ``path`` and the path inside it; executors and driver name files the same way."""
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[len("file:") :].lstrip("/")
    return fs.FileSystem.from_uri(path)


def _clean(value) -> str:
    """A header value on one line: control characters would end the field."""
    return "".join(" " if ord(c) < 32 or ord(c) == 127 else c for c in str(value)).strip()


def record_bytes(row) -> bytes:
    """One record. A revisit has no payload of its own; a null payload is empty."""
    payload = bytes(row.payload or b"")
    full = len(payload) if row.payload_bytes is None else row.payload_bytes
    revisit = row.record_type == "revisit"
    block = HTTP_HEAD + (b"" if revisit else payload)
    lines = [f"WARC-Date: {datetime.datetime.now(datetime.timezone.utc):%Y-%m-%dT%H:%M:%SZ}"]
    for name, header in FIELDS.items():
        value = getattr(row, name)
        if value is None:
            continue
        value = _clean(value)
        if name in ("record_id", "refers_to"):
            value = f"<{value}>"
        elif name == "payload_digest":
            value = f"sha1:{value}"
        lines.append(f"{header}: {value}")
    if revisit:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    lines += [f"{LENGTH}: {full}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return VERSION + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


@dataclass
class Written(WriterCommitMessage):
    files: list = field(default_factory=list)


class WarcWriter(DataSourceWriter):
    """Each task rolls archives of bounded size; only files in the manifest count, so that what lost
    or repeated attempts leave behind is never read."""

    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path.rstrip("/"), overwrite

    def write(self, iterator) -> Written:
        store, root = _file_system(self.path)
        store.create_dir(root, recursive=True)
        files, out, size = [], None, 0
        try:
            for row in iterator:
                if out is None:
                    name = f"part-{uuid.uuid4().hex}.warc"
                    out, size = store.open_output_stream(f"{root}/{name}"), 0
                record = record_bytes(row)
                out.write(record)
                size += len(record)
                if size >= FILE_BYTES:
                    out.close()
                    files.append([name, size])
                    out = None
        finally:
            if out is not None:
                out.close()
                files.append([name, size])
        return Written(files)

    def commit(self, messages) -> None:
        store, root = _file_system(self.path)
        store.create_dir(root, recursive=True)
        files = [f for m in messages if m is not None for f in m.files]
        if not self.overwrite:
            new = {name for name, _ in files}
            files += [f for f in read_manifest(self.path) if f[0] not in new]
        with store.open_output_stream(f"{root}/{MANIFEST}") as out:
            out.write(json.dumps(sorted(files)).encode())

    def abort(self, messages) -> None:
        store, root = _file_system(self.path)
        for name, _ in (f for m in messages if m is not None for f in m.files):
            store.delete_file(f"{root}/{name}")


def read_manifest(path: str) -> list:
    """[name, bytes] of each archive: from the manifest, else every ``*.warc`` file of the folder."""
    from pyarrow import fs

    store, root = _file_system(path.rstrip("/"))
    if store.get_file_info(f"{root}/{MANIFEST}").type == fs.FileType.File:
        with store.open_input_stream(f"{root}/{MANIFEST}") as f:
            return [list(x) for x in json.loads(f.read())]
    found = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
    return sorted([x.base_name, x.size] for x in found if x.is_file and x.base_name.endswith(".warc"))


@dataclass
class Archives(InputPartition):
    files: list

    def __init__(self, files):
        self.files = files


class WarcReader(DataSourceReader):
    """Plans partitions of whole archives by size. ``column = value`` and ``IN`` on header columns are
    tested on the header lines; records that fail, and payloads nobody asked for, are skipped in the
    file without being read or decoded."""

    def __init__(self, path: str, payload: bool):
        self.path, self.payload = path.rstrip("/"), payload
        self.wanted: list[tuple[str, frozenset]] = []

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            name = f.attribute[0] if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 else None
            if name not in FIELDS:
                yield f
            elif isinstance(f, EqualTo):
                self.wanted.append((name, frozenset([f.value])))
            else:
                self.wanted.append((name, frozenset(f.value)))

    def partitions(self):
        parts, now, size = [], [], 0
        for name, length in read_manifest(self.path):
            if now and size + length > PART_BYTES:
                parts.append(Archives(now))
                now, size = [], 0
            now.append(name)
            size += length
        return [*parts, Archives(now)] if now or not parts else parts

    def read(self, partition) -> Iterator[tuple]:
        store, root = _file_system(self.path)
        for name in partition.files:
            with store.open_input_file(f"{root}/{name}") as f:
                yield from self.records(f)

    def records(self, f) -> Iterator[tuple]:
        size, at, buffer, start = f.size(), 0, b"", 0
        while at < size:
            # buffer holds the file's bytes from start on
            head = buffer.find(b"\r\n\r\n", at - start) if at >= start else -1
            while head < 0:
                known = buffer[at - start :] if at - start < len(buffer) else b""
                f.seek(at + len(known))
                more = f.read(CHUNK)
                if not more:
                    if known.strip():
                        raise ValueError(f"an archive ends inside a header at byte {at}")
                    return
                buffer, start = known + more, at
                head = buffer.find(b"\r\n\r\n")
            fields = self.header(buffer[at - start : head])
            block = start + head + 4
            length = int(fields["content-length"])
            after = block + length + 4
            values = {c: fields.get(h.lower()) for c, h in FIELDS.items()}
            for c in ("record_id", "refers_to"):
                values[c] = values[c] and values[c].strip("<>")
            values["payload_digest"] = values["payload_digest"] and values["payload_digest"].removeprefix("sha1:")
            if all(values[c] in wanted for c, wanted in self.wanted):
                payload = None
                if self.payload and values["record_type"] != "revisit":
                    lead = block - start
                    if lead + length <= len(buffer):
                        body = buffer[lead : lead + length]
                    else:
                        f.seek(block)
                        body = f.read(length)
                    cut = body.find(b"\r\n\r\n") if fields.get("content-type", "").startswith("application/http") else -4
                    payload = body[cut + 4 :]
                full = fields.get(LENGTH.lower())
                values["payload_bytes"] = int(full) if full is not None else None if payload is None else len(payload)
                values["payload"] = payload
                yield tuple(values[c] for c in COLUMNS)
            at = after
            if at - start > len(buffer):
                buffer, start = b"", at

    @staticmethod
    def header(raw: bytes) -> dict[str, str]:
        first, *lines = raw.decode("utf-8", "replace").split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"not a record: {first[:40]!r}")
        pairs = (line.partition(":") for line in lines)
        return {k.strip().lower(): v.strip() for k, _, v in pairs}


class WarcSource(DataSource):
    """Options: ``path``; ``payload`` ("false" leaves payloads undecoded and null)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(self.options["path"], self.options.get("payload", "true").lower() != "false")

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        missing = set(COLUMNS) - set(schema.fieldNames())
        if missing:
            raise ValueError(f"columns missing for an archive: {sorted(missing)}")
        return WarcWriter(self.options["path"], overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known to the session and let it take filters."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def base32(digest_hex) -> Column:
    """Bare upper-case base 32 of a hex SHA-1 (160 bits, so no padding)."""
    # base 32 by 20-bit pieces: 5 hex digits are 4 characters
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    pieces = []
    for i in range(8):
        value = F.conv(F.substring(digest_hex, 5 * i + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            pieces.append(F.substring(F.lit(letters), F.shiftright(value, shift).bitwiseAND(31) + 1, F.lit(1)))
    return F.concat(*pieces)


def page_records(pages: DataFrame) -> DataFrame:
    """Records of pages (page_id, url, html), one for each row.

    Of rows with equal payloads (null html is the empty payload) the ones with the smallest page_id
    are responses, all others revisits of it. Null ids come last: they are responses only where no
    row with that payload has an id. Repeated rows are records of their own.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"), F.sha1(payload).alias("digest")).alias("p")
    # rows of one payload meet as partial minima; payloads themselves aren't shuffled for it
    firsts = (
        pages.select("page_id", F.sha1(payload).alias("digest"))
        .groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1 and first_id is not null")
    )
    firsts = stored(firsts.select("digest", "first_id"), "warc-firsts").alias("f")
    again = F.col("first_id").isNotNull() & ~same(F.col("page_id"), F.col("first_id"))
    return rows.join(firsts, F.col("p.digest") == F.col("f.digest"), "left").select(
        page_urn(F.col("page_id")).alias("record_id"),
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.col("url").alias("target_uri"),
        base32(F.col("p.digest")).alias("payload_digest"),
        F.when(again, page_urn(F.col("first_id"))).alias("refers_to"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.when(~again, F.col("payload")).alias("payload"),
    )


def page_urn(page_id) -> Column:
    return F.concat(F.lit("urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")))


def page_of(urn: str) -> Column:
    return F.regexp_extract(urn, "^urn:page:(-?[0-9]+)$", 1).try_cast("long")


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its store, by default the session's: every machine then means the same place."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(found).toString()


def write_pages(pages: DataFrame, path: str) -> None:
    """Write an archive folder of all pages."""
    register(pages.sparkSession)
    page_records(pages).write.format("warc").mode("append").save(qualified(pages.sparkSession, path))


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """Records of an archive folder; filter on header columns to skip the rest unread."""
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(qualified(spark, path))
