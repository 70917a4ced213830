"""WARC archives as a PySpark Python data source.

Reading: files are planned into partitions of bounded size; predicates on record
type and headers are pushed down; a record's headers are parsed first, and
the block of a record that fails a predicate is skipped (in a plain archive by
seeking) without decoding. With option payload=false no block is decoded at all.

Writing: every task writes one archive into a hidden folder; the driver moves the archives of
committed tasks into place, so retried or lost tasks leave nothing behind.

Payload digests are bare upper-case base32 SHA-1. A record's id is a URN whose last
64 bits are the page_id.
"""

from __future__ import annotations

import base64
import datetime
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, StringContains, StringStartsWith, WriterCommitMessage

from corpusflow.llm.common import drop_at_exit, materialize, release_at_exit, new_path, ship

NAMESPACE = 0x6C1F0A4E5D2B4C3A << 64
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ_SCHEMA = "record_type string, record_id string, target_uri string, warc_date string, content_type string, payload_digest string, refers_to string, payload_bytes long, payload binary"
WRITE_SCHEMA = "page_id long, url string, payload binary, sha1 string, record_type string, refers_to long, payload_bytes long"
HEADERS = {"record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI", "warc_date": "WARC-Date", "content_type": "Content-Type", "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To"}
PARTITION_BYTES = 64 << 20
BATCH_BYTES = 8 << 20


def record_urn(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid4() if page_id is None else uuid.UUID(int=NAMESPACE | (page_id & (2**64 - 1)))}>"


def page_of(urn: F.Column) -> F.Column:
    """The page_id in a record's id; null for ids of other makers."""
    digits = F.regexp_replace(urn, "[<>-]|urn:uuid:", "")
    own = F.substring(digits, 1, 16) == f"{NAMESPACE >> 64:016x}"
    return F.when(own, F.conv(F.substring(digits, 17, 16), 16, -10).cast("long"))


def b32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    """One record. Line breaks and other controls in a value are percent-encoded; a null value has no header."""
    lines = ["WARC/1.1"]
    for name, value in (*fields, ("Content-Length", str(len(block)))):
        if value is not None:
            lines.append(f"{name}: " + "".join(c if " " <= c != "\x7f" else f"%{ord(c):02X}" for c in value))
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(re.sub("^file:/(?=[^/])", "file:///", path) if ":" in path else f"file://{path}")


@dataclass
class Archives(InputPartition):
    files: list[str]


class Headers(dict):
    """Names in any case."""

    def first(self, name: str) -> str | None:
        return self.get(name.lower())


def _parse(head: bytes) -> Headers:
    out = Headers()
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        if name:
            out[name.strip().lower()] = value.strip()
    return out


def _head(source) -> bytes | None:
    """The lines up to the empty one, None at the end of the archive."""
    lines = []
    while line := source.readline():
        if line == b"\r\n":
            if lines:
                return b"".join(lines).removesuffix(b"\r\n")
        else:
            lines.append(line)
    if lines:
        raise ValueError("an archive ends within a record's headers")
    return None


def _whole(source, length: int) -> bytes:
    block = source.read(length)
    if len(block) < length:
        raise ValueError("an archive ends within a record's block")
    return block


def _end(source) -> None:
    """Past the two line breaks after a block; a block that was skipped beyond the archive's end has none."""
    for _ in range(2):
        if source.readline(2) != b"\r\n":
            raise ValueError("an archive ends within a record, or a record is longer than it says")


def records(source, wanted, payloads: bool) -> Iterator[tuple[Headers, int | None, bytes | None]]:
    """(headers, payload length, payload) of the records that `wanted` accepts by their headers. An archive that ends within
    a record, whether that is wanted or skipped, is an error."""
    while (head := _head(source)) is not None:
        if not head.startswith(b"WARC/"):
            raise ValueError("no WARC record where one should begin")
        headers = _parse(head)
        length = int(headers.first("Content-Length") or 0)
        found = None
        if not wanted(headers):
            source.seek(length, io.SEEK_CUR)
        elif not (headers.first("Content-Type") or "").startswith("application/http"):
            found = headers, length, _whole(source, length) if payloads else None
            if not payloads:
                source.seek(length, io.SEEK_CUR)
        else:
            http, used = [], 0
            while used < length and (line := source.readline(length - used)):
                used += len(line)
                http.append(line)
                if line == b"\r\n":
                    break
            said = _parse(b"".join(http)).first("Content-Length")
            again = headers.first("WARC-Type") == "revisit"
            block = _whole(source, length - used) if payloads and not again else None
            if block is None:
                source.seek(length - used, io.SEEK_CUR)
            found = headers, (int(said) if said else None) if again else length - used, block
        _end(source)
        if found is not None:
            yield found


def _column(headers: Headers, column: str) -> str | None:
    value = headers.first(HEADERS[column])
    return value.removeprefix("sha1:") if value and column == "payload_digest" else value


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.payloads = options.get("payload", "true").lower() != "false"
        self.partition_bytes = int(options.get("partitionbytes", PARTITION_BYTES))
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters):
        """Keep what headers decide; hand the rest back to Spark."""
        for f in filters:
            name = f.attribute[0] if getattr(f, "attribute", None) and len(f.attribute) == 1 else None
            if name in HEADERS and isinstance(f, EqualTo):
                self.tests.append((name, "in", {f.value}))
            elif name in HEADERS and isinstance(f, In):
                self.tests.append((name, "in", set(f.value)))
            elif name in HEADERS and isinstance(f, StringStartsWith):
                self.tests.append((name, "starts", f.value))
            elif name in HEADERS and isinstance(f, StringContains):
                self.tests.append((name, "contains", f.value))
            else:
                yield f

    def wanted(self, headers: Headers) -> bool:
        for column, kind, value in self.tests:
            own = _column(headers, column)
            if own is None or not (own in value if kind == "in" else own.startswith(value) if kind == "starts" else value in own):
                return False
        return True

    def partitions(self):
        system, root = _filesystem(self.path)
        found = system.get_file_info(pafs.FileSelector(root, recursive=True)) if system.get_file_info(root).type == pafs.FileType.Directory else [system.get_file_info(root)]
        files = sorted((f.path, f.size) for f in found if f.is_file and re.search(r"\.warc(\.gz)?$", f.path) and "/_" not in f.path.removeprefix(root))
        out, room = [], 0
        for path, size in files:
            if size > room or not out:
                out.append(Archives([]))
                room = self.partition_bytes
            out[-1].files.append(path)
            room -= size
        return out or [Archives([])]

    def read(self, partition: Archives) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for path in partition.files:
            system, _ = _filesystem(self.path)
            with system.open_input_file(path) as raw:
                plain = raw if not path.endswith(".gz") else gzip.GzipFile(fileobj=raw)
                for headers, length, payload in records(io.BufferedReader(plain, 1 << 20) if plain is raw else plain, self.wanted, self.payloads):
                    rows.append((*[_column(headers, c) for c in HEADERS], length, payload))
                    held += 512 + len(payload or b"")
                    if held > BATCH_BYTES:
                        yield _batch(rows)
                        rows, held = [], 0
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    types = [pa.string()] * len(HEADERS) + [pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], [*HEADERS, "payload_bytes", "payload"])


@dataclass
class Written(WriterCommitMessage):
    file: str | None


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path, self.gzip = options["path"], options.get("compression", "none") == "gzip"
        self.date = options.get("date") or datetime.datetime.now(datetime.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
        self.job = uuid.uuid4().hex

    def _hidden(self) -> str:
        return f"{_filesystem(self.path)[1]}/_writing-{self.job}"

    def _records(self, batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
        first = True
        for batch in batches:
            if first:
                yield record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_urn(None)), ("WARC-Date", self.date), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
                first = False
            for row in batch.to_pylist():
                n = row["payload_bytes"]
                http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n".encode()
                fields = [
                    ("WARC-Type", row["record_type"]), ("WARC-Record-ID", record_urn(row["page_id"])), ("WARC-Date", self.date), ("WARC-Target-URI", row["url"]),
                    ("WARC-Payload-Digest", "sha1:" + b32(bytes.fromhex(row["sha1"]))), ("Content-Type", "application/http;msgtype=response"),
                ]
                if row["record_type"] == "revisit":
                    yield record([*fields, ("WARC-Profile", PROFILE), ("WARC-Refers-To", record_urn(row["refers_to"]))], http)
                else:
                    yield record(fields, http + (row["payload"] or b""))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, _ = _filesystem(self.path)
        name = f"part-{uuid.uuid4().hex}.warc" + ".gz" * self.gzip
        out = None
        for raw in self._records(iterator):
            if out is None:
                system.create_dir(self._hidden(), recursive=True)
                out = system.open_output_stream(f"{self._hidden()}/{name}", compression=None)
            out.write(gzip.compress(raw, 6) if self.gzip else raw)
        if out is None:
            return Written(None)
        out.close()
        return Written(name)

    def commit(self, messages) -> None:
        system, root = _filesystem(self.path)
        system.create_dir(root, recursive=True)
        for m in messages:
            if m is not None and m.file:
                system.move(f"{self._hidden()}/{m.file}", f"{root}/{m.file}")
        self.abort(messages)

    def abort(self, messages) -> None:
        system, _ = _filesystem(self.path)
        if system.get_file_info(self._hidden()).type == pafs.FileType.Directory:
            system.delete_dir(self._hidden())


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return READ_SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader({k.lower(): v for k, v in self.options.items()})

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter({k.lower(): v for k, v in self.options.items()})


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def read_warc(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """The records below path, with columns READ_SCHEMA. Options: payload=false leaves
    payload null without decoding it; partitionBytes bounds a partition's files. A folder
    without archives has no rows. A revisit's payload is null, its payload_bytes that
    of the payload it refers to."""
    register(spark)
    return spark.read.format("warc").options(**options).load(path)


def with_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """pages (page_id, url, html) as records of WRITE_SCHEMA. Of records with equal
    payloads of at least least_bytes bytes, that of the largest page_id is a
    response and others revisit it; records with smaller payloads are all responses. A null html
    is an empty payload. A null url has no target URI. Rows of a null page_id revisit the largest page_id that is not
    null, else they are responses; rows that repeat the largest page_id are all responses."""
    raw = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), raw.alias("payload"), F.sha1(raw).alias("sha1"), F.octet_length(raw).cast("long").alias("payload_bytes"))
    kept = rows.where(F.col("payload_bytes") >= least_bytes).groupBy("sha1", "payload_bytes").agg(F.max("page_id").alias("top"), F.count("*").alias("n"))
    # Written first, so that Spark knows its size: a small table is broadcast and payloads are not shuffled.
    kept = materialize(kept.where("n > 1").select("sha1", "payload_bytes", "top"), "repeated-payloads")
    release_at_exit(kept)
    again = F.col("top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("top"))
    rows = rows.join(kept, ["sha1", "payload_bytes"], "left").withColumn("record_type", F.when(again, "revisit").otherwise("response"))
    return rows.select("page_id", "url", F.when(~again | again.isNull(), F.col("payload")).alias("payload"), "sha1", "record_type", F.when(again, F.col("top")).alias("refers_to"), "payload_bytes")


def write_warc(pages: DataFrame, path: str, least_bytes: int = 0, **options: str) -> None:
    """Archives of pages (page_id, url, html, ...) in the folder path, added to what
    is there. Other columns are not written. Option compression=gzip makes .warc.gz.

    Archives appear once all tasks are done, one after the other: if the driver dies meanwhile, those already there are whole, the others stay in a
    hidden folder that readers skip, and the write must be repeated into another folder."""
    register(pages.sparkSession)
    with_revisits(pages, least_bytes).write.format("warc").mode("append").options(**options).save(path)


def digest_of(payload: F.Column) -> F.Column:
    """Bare upper-case base32 SHA-1, in Spark expressions."""
    bits = F.sha1(payload)
    group = lambda i: F.lpad(F.conv(F.conv(F.substring(bits, 10 * (i // 8) + 1, 10), 16, 10), 10, 32), 8, "0")
    return F.translate(F.upper(F.concat(*[group(8 * i) for i in range(4)])), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def op9_warc(spark, sf_dir: str) -> DataFrame:
    path = new_path(spark, "archives")
    drop_at_exit(spark, path)
    write_warc(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"), path)
    rows = read_warc(spark, path).where(F.col("record_type").isin("response", "revisit"))
    # A response's length and digest are those of the payload that came back.
    return rows.select(
        page_of(F.col("record_id")).alias("page_id"),
        F.coalesce(F.octet_length("payload").cast("long"), "payload_bytes").alias("payload_bytes"),
        F.coalesce(digest_of(F.col("payload")), "payload_digest").alias("payload_digest"),
        "record_type",
        page_of(F.col("refers_to")).alias("refers_to"),
    )


OP9_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b, sha1(coalesce(html, '')) AS h FROM pages),
g AS (SELECT h, max(page_id) AS top FROM p GROUP BY h)
SELECT p.page_id, octet_length(p.b)::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                1 + ((('0x' || substr(p.h, 1 + 10 * (i // 8), 10))::BIGINT >> (35 - 5 * (i % 8))::INTEGER) & 31)::INTEGER, 1)), '') AS payload_digest,
       CASE WHEN p.page_id = g.top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN p.page_id <> g.top THEN g.top END AS refers_to
FROM p JOIN g USING (h)
"""
