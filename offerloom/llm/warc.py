"""WARC archives as a Spark data source: one gzip member a record, read by byte ranges.

``spark.read.format("warc")`` cuts every file into byte ranges. A task looks for
the gzip magic in its range, takes a hit for a record only if what it inflates
to begins with a well-formed WARC header, and owns the records that start inside
its range; the last one may end beyond it. A hit inside compressed data fails
that test, or the CRC that ends a member, and the search goes on one byte later.

``df.write.format("warc")`` writes a file a task under a name of its own attempt,
so a task that runs twice leaves no half-written archive: commit removes the files
of attempts that weren't counted. Both reach the store through pyarrow's file
systems, by URI, and never through the driver.
"""

from __future__ import annotations

import uuid
import zlib
from dataclasses import dataclass
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

#: Fixed values of the format.
GZIP_MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

SCHEMA = "record_type string, record_id string, target_uri string, refers_to string, payload_digest string, payload_length long, payload binary"
CHUNK, PIECE = 1 << 20, 1 << 14


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _uri(path: str) -> str:
    return "file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path


def _header_value(value: str) -> str:
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _plain(value: str) -> str:
    return value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def encode_record(row: dict, date: str, level: int) -> bytes:
    """One gzip member. A revisit has no payload; its digest and length are those of the payload it stands for."""
    payload = row["payload"] or b""
    revisit = row["record_type"] == "revisit"
    block = HTTP_HEAD + (b"" if revisit else payload)
    head = ["WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: {_header_value(row['record_id'] or '')}", f"WARC-Date: {date}"]
    if row["target_uri"] is not None:
        head.append(f"WARC-Target-URI: {_header_value(row['target_uri'])}")
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_header_value(row['refers_to'] or '')}"]
    head += [f"WARC-Payload-Digest: sha256:{row['payload_digest']}", f"X-Payload-Length: {row['payload_length']}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    pack = zlib.compressobj(level, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + pack.flush()


def decode_record(raw: bytes) -> dict:
    """A record's fields, from a member's content."""
    end = raw.index(b"\r\n\r\n")
    fields = {}
    for line in raw[:end].decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    block = raw[end + 4 : end + 4 + int(fields["content-length"])]
    if fields.get("content-type", "").startswith("application/http"):
        block = block.partition(b"\r\n\r\n")[2]
    revisit = fields["warc-type"] == "revisit"
    digest = fields.get("warc-payload-digest", "").removeprefix("sha256:") or None
    return {
        "record_type": fields["warc-type"],
        "record_id": _plain(fields.get("warc-record-id", "")),
        "target_uri": _plain(fields["warc-target-uri"]) if "warc-target-uri" in fields else None,
        "refers_to": _plain(fields["warc-refers-to"]) if "warc-refers-to" in fields else None,
        "payload_digest": digest,
        "payload_length": int(fields.get("x-payload-length", len(block))),
        "payload": None if revisit else block,
    }


class _Window:
    """Forward reads of a file from any offset, a chunk at a time."""

    def __init__(self, file, size: int, at: int):
        self.file, self.size, self.base, self.skip, self.data = file, size, at, 0, bytearray()

    @property
    def at(self) -> int:
        return self.base + self.skip

    def seek(self, to: int) -> None:
        if self.base <= to <= self.base + len(self.data):
            self.skip = to - self.base
        else:
            self.base, self.skip, self.data = to, 0, bytearray()

    def more(self) -> bool:
        end = self.base + len(self.data)
        if end >= self.size:
            return False
        self.file.seek(end)
        got = self.file.read(min(CHUNK, self.size - end))
        self.base = self.at
        del self.data[: self.skip]  # cutting and appending in place, so a long record isn't copied for each piece read
        self.data += got
        self.skip = 0
        return bool(got)


def _member(win: _Window) -> tuple[bytes, int] | None:
    """The content and length of the member at the window's start; None if it isn't a WARC record's."""
    inflate, out, used, seen = zlib.decompressobj(31), [], 0, b""
    while not inflate.eof:
        if win.skip + used >= len(win.data) and not win.more():
            return None
        piece = win.data[win.skip + used : win.skip + used + PIECE]
        used += len(piece)
        try:
            got = inflate.decompress(piece)
        except zlib.error:
            return None
        out.append(got)
        if len(seen) < len(VERSION):
            seen += got[: len(VERSION)]
            if not VERSION.startswith(seen[: len(VERSION)]):
                return None
    return b"".join(out), used - len(inflate.unused_data)


def records_in_range(file, size: int, start: int, end: int):
    """(offset, fields) of the records whose member starts in [start, end)."""
    win = _Window(file, size, start)
    while win.at < end:
        hit = win.data.find(GZIP_MAGIC, win.skip)
        if hit < 0:  # the magic may lie across the window's end
            win.seek(win.base + max(win.skip, len(win.data) - len(GZIP_MAGIC) + 1))
            if not win.more():
                return
            continue
        win.seek(win.base + hit)
        if win.at >= end:
            return
        found = _member(win)
        fields = None
        if found:
            try:
                fields = decode_record(found[0])
            except (ValueError, KeyError):
                fields = None
        if fields is None:
            win.seek(win.at + 1)
            continue
        yield win.at, fields
        win.seek(win.at + found[1])


@dataclass
class Range(InputPartition):
    path: str
    size: int
    start: int
    end: int


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.split = _uri(options["path"]), int(options.get("splitBytes", 32 << 20))

    def partitions(self):
        from pyarrow import fs

        store, root = _open(self.path)
        info = store.get_file_info(root)
        found = [info] if info.type == fs.FileType.File else [x for x in store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)) if x.type == fs.FileType.File and x.path.endswith(".warc.gz")]
        cut = [Range(x.path, x.size, at, min(x.size, at + self.split)) for x in found for at in range(0, x.size, self.split)]
        return cut or [Range("", 0, 0, 0)]

    def read(self, part: Range):
        if not part.size:
            return
        schema = pa.schema([("record_type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()), ("refers_to", pa.string()), ("payload_digest", pa.string()), ("payload_length", pa.int64()), ("payload", pa.binary())])
        store, _ = _open(self.path)
        with store.open_input_file(part.path) as file:
            rows, held = [], 0
            for _, fields in records_in_range(file, part.size, part.start, part.end):
                rows.append(fields)
                held += len(fields["payload"] or b"") + 500
                if held > 8 << 20:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)


@dataclass
class Written(WriterCommitMessage):
    path: str


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options):
        self.path, self.level = _uri(options["path"]), int(options.get("level", 3))
        self.job = uuid.uuid4().hex  # names the write's files, as others may write into the folder at the same time
        self.date = options.get("date") or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def write(self, iterator):
        store, root = _open(self.path)
        store.create_dir(root, recursive=True)
        name = f"{root}/{self.job}-{uuid.uuid4().hex}.warc.gz"
        with store.open_output_stream(f"{name}.part") as out:
            for batch in iterator:
                for i in range(batch.num_rows):
                    out.write(encode_record({k: batch.column(k)[i].as_py() for k in batch.schema.names}, self.date, self.level))
        return Written(name)

    def commit(self, messages):
        store, _ = _open(self.path)
        for m in messages:
            if m is not None:
                store.move(f"{m.path}.part", m.path)
        self._drop_parts()

    def abort(self, messages):
        self._drop_parts()

    def _drop_parts(self):
        """Deletes what attempts of this write left unfinished."""
        from pyarrow import fs

        store, root = _open(self.path)
        for x in store.get_file_info(fs.FileSelector(root, allow_not_found=True)):
            if x.base_name.startswith(f"{self.job}-") and x.base_name.endswith(".part"):
                store.delete_file(x.path)


class WarcDataSource(DataSource):
    """Options: path; splitBytes when reading; level (of gzip) and date when writing."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options)


def read_warc(spark: SparkSession, path: str, split_bytes: int = 32 << 20) -> DataFrame:
    spark.dataSource.register(WarcDataSource)
    return spark.read.format("warc").option("path", path).option("splitBytes", split_bytes).load()


def write_warc(records: DataFrame, path: str, level: int = 3) -> None:
    """``records`` has the columns of SCHEMA."""
    records.sparkSession.dataSource.register(WarcDataSource)
    records.write.format("warc").option("path", path).option("level", level).mode("append").save()


def page_records(pages: DataFrame, min_revisit_bytes: int = 100) -> DataFrame:
    """A record a row of ``pages`` (page_id, url, html), with equal payloads written once.

    A null html is an empty payload. Of the rows with one payload of at least
    ``min_revisit_bytes`` bytes, the one with the smallest page_id is the
    response; rows with that same page_id are responses too, and all others
    revisit it. A null page_id is written without a number and never is the one
    that others refer to. Only the digest and two numbers of a row meet by
    payload, in a partial aggregate and a join that may split a hot payload;
    the html is never dealt by payload.
    """
    html = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("payload"))
    rows = rows.withColumns({"payload_digest": F.sha2("payload", 256), "payload_length": F.octet_length("payload").cast("long")})
    keyed = rows.filter((F.col("payload_length") >= min_revisit_bytes) & F.col("page_id").isNotNull()).select("page_id", "payload_digest")
    first = keyed.groupBy("payload_digest").agg(F.min("page_id").alias("first_id"), F.max("page_id").alias("last_id")).filter("last_id > first_id").select(F.concat(F.lit("p"), "payload_digest").alias("key"), "first_id")
    again = keyed.withColumn("key", F.concat(F.lit("p"), "payload_digest")).join(first, "key").filter("page_id > first_id").select("page_id", "payload_digest", "first_id").distinct()
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    return rows.join(again, ["page_id", "payload_digest"], "left").select(
        F.when(F.col("first_id").isNull(), "response").otherwise("revisit").alias("record_type"),
        urn(F.col("page_id")).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.when(F.col("first_id").isNotNull(), urn(F.col("first_id"))).alias("refers_to"),
        "payload_digest",
        "payload_length",
        F.when(F.col("first_id").isNull(), F.col("payload")).alias("payload"),
    )


def page_number(urn: str) -> Column:
    """The page_id in a record's id; null if it has none."""
    return F.expr(f"try_cast(regexp_extract({urn}, '^<urn:page:(-?[0-9]*)>$', 1) AS long)")
