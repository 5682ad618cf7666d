"""WARC archives: written by Spark, read by a Python data source.

Writing: a record is a text that ends in CRLF CRLF, so Spark's text writer with
that line separator writes archives through any file system, with its own
commit protocol.  Of records with equal payloads one is a response, the others
are revisit records that refer to it and hold no payload.

Reading: partitions are archive files.  Of each record the headers are parsed
first; predicates on record type and header columns that Spark pushes down are
tested there, and the payload of a record that fails them, or of any record if
the schema asks for no payload, is skipped without being read or decoded.
"""

from __future__ import annotations

import io
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualNullSafe, EqualTo, Filter, In, InputPartition, IsNotNull, StringStartsWith

from ticklake.llm.common import broadcast_if_small
from ticklake.session import scratch_dir

# Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http;msgtype=response"
HEADER_COLUMNS = {
    "record_type": "warc-type",
    "record_id": "warc-record-id",
    "target_uri": "warc-target-uri",
    "date": "warc-date",
    "payload_digest": "warc-payload-digest",
    "refers_to": "warc-refers-to",
    "content_type": "content-type",
}
SCHEMA = ", ".join(f"{c} string" for c in HEADER_COLUMNS) + ", payload_bytes long, payload binary"

#: Payload bytes gathered before a batch is handed to Spark.
BATCH_BYTES, BATCH_ROWS = 8 << 20, 4096
#: Shared digests (under 100 bytes each) that may be broadcast.
BROADCAST_DIGESTS = 100_000


# --- writing ----------------------------------------------------------------


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 of the SHA-1 of a binary or string column: eight
    times five hex digits (20 bits) become four digits of base 32."""
    hexed = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(hexed, i, 5), 16, 32), 4, "0") for i in range(1, 41, 5)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _urn(key: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(key.cast("string"), F.lit("null")), F.lit(">"))


def _lines(*lines: Column) -> Column:
    """Header lines that are not null, each ending in CRLF."""
    return F.concat_ws("", *[F.concat(line, F.lit("\r\n")) for line in lines])


def warc_records(pages: DataFrame, date: str, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """One WARC record (column `record`, without its final CRLF CRLF) per row.

    Of records with equal payloads of at least `least_bytes` bytes the one with
    the largest id is a response and the others revisit it; smaller ones are
    all responses.  A null payload is empty; a null URL has no URL line, and
    control characters of a URL are percent-encoded; rows that repeat the
    largest id are all responses; a null id never wins over another.
    """
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    pages = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload"))
    pages = pages.withColumns({"digest": base32_sha1(F.col("payload").cast("binary")), "size": F.octet_length("payload").cast("long")})
    shared = pages.where(F.col("size") >= least_bytes).groupBy("digest").agg(F.max("id").alias("largest"), F.count(F.lit(1)).alias("n"))
    shared = broadcast_if_small(shared.where("n > 1").drop("n"), BROADCAST_DIGESTS)
    pages = pages.join(shared, "digest", "left")
    revisit = F.coalesce((F.col("size") >= least_bytes) & F.col("largest").isNotNull() & ~F.col("id").eqNullSafe(F.col("largest")), F.lit(False))

    size = F.col("size").cast("string")
    http = _lines(F.lit("HTTP/1.1 200 OK"), F.lit("Content-Type: text/html; charset=utf-8"), F.concat(F.lit("Content-Length: "), size), F.lit(""))
    url = F.col("url")
    for code in (*range(32), 127):
        url = F.replace(url, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    only_revisit = lambda line: F.when(revisit, line)
    block = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("size"))
    head = _lines(
        F.lit(VERSION),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        F.concat(F.lit("WARC-Record-ID: "), _urn(F.col("id"))),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), url),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        only_revisit(F.lit(f"WARC-Profile: {REVISIT_PROFILE}")),
        only_revisit(F.concat(F.lit("WARC-Refers-To: "), _urn(F.col("largest")))),
        F.lit(f"Content-Type: {HTTP_TYPE}"),
        F.concat(F.lit("Content-Length: "), block.cast("string")),
        F.lit(""),
    )
    return pages.select(F.concat(head, http, F.when(revisit, F.lit("")).otherwise(F.col("payload"))).alias("record"))


def write_warc(records: DataFrame, path: str, compression: str = "none") -> None:
    """Write records as archives under `path`, one for each partition."""
    records.write.option("lineSep", "\r\n\r\n").option("compression", compression).text(path)


# --- reading ----------------------------------------------------------------


class ArchivePartition(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


class WarcDataSource(DataSource):
    """`spark.read.format("warc").load(path)`; path is a file or a folder, as
    a path or a URI of a store that Arrow reads (local, HDFS, S3, GCS)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(self.options["path"], schema)


class WarcReader(DataSourceReader):
    def __init__(self, path: str, schema):
        self.path, self.schema = path, schema
        self.tests: list[tuple[str, str, tuple]] = []  # header, kind, values

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        kinds = {EqualTo: "in", EqualNullSafe: "in", In: "in", StringStartsWith: "prefix", IsNotNull: "any"}
        for f in filters:
            kind = kinds.get(type(f))
            header = HEADER_COLUMNS.get(f.attribute[0]) if kind and len(f.attribute) == 1 else None
            value = getattr(f, "value", None)
            values = tuple(value) if isinstance(f, In) else (value,)
            if header is None or kind != "any" and not all(isinstance(v, str) for v in values):
                yield f
            else:
                self.tests.append((header, kind, values))

    def partitions(self) -> Sequence[InputPartition]:
        store, path = _store(self.path)
        info = store.get_file_info(path)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        files = [info] if info.is_file else store.get_file_info(fs.FileSelector(path, recursive=True))
        found = [x.path for x in files if x.is_file and x.size and x.base_name[0] not in "._"]
        return [ArchivePartition(p) for p in sorted(found)]

    def wanted(self, headers: dict[str, str]) -> bool:
        for header, kind, values in self.tests:
            value = headers.get(header)
            if value is None or kind == "in" and value not in values or kind == "prefix" and not value.startswith(values[0]):
                return False
        return True

    def read(self, partition: ArchivePartition | None) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(self.schema)
        names = schema.names
        rows: list[dict] = []
        held = 0
        if partition is None:  # no archives
            return
        for record in self.records(partition.path, "payload" in names):
            rows.append(record)
            held += len(record.get("payload") or b"")
            if held >= BATCH_BYTES or len(rows) >= BATCH_ROWS:
                yield pa.RecordBatch.from_pydict({n: [r.get(n) for r in rows] for n in names}, schema)
                rows, held = [], 0
        yield pa.RecordBatch.from_pydict({n: [r.get(n) for r in rows] for n in names}, schema)

    def records(self, path: str, payloads: bool) -> Iterator[dict]:
        store, _ = _store(self.path)
        packed = path.endswith(".gz")
        raw = store.open_input_stream(path, compression="gzip") if packed else store.open_input_file(path)
        with io.BufferedReader(raw, 1 << 20) as f:
            while version := f.readline():
                if not version.startswith(b"WARC/"):
                    raise ValueError(f"{path}: no WARC record where one should begin: {version[:40]!r}")
                headers = _headers(f)
                left = int(headers["content-length"])
                if self.wanted(headers):
                    record = {c: headers.get(h) for c, h in HEADER_COLUMNS.items()}
                    inner: dict[str, str] = {}
                    if headers.get("content-type", "").startswith("application/http"):
                        status = f.readline()
                        inner = _headers(f, used := [len(status)])
                        left -= used[0]
                    has_payload = record["record_type"] != "revisit"
                    record["payload_bytes"] = left if has_payload else int(inner.get("content-length", 0))
                    if has_payload and payloads:
                        record["payload"] = _exactly(f, left, path)
                        left = 0
                    yield record
                _skip(f, left, packed, path)
                if _exactly(f, 4, path) != b"\r\n\r\n":
                    raise ValueError(f"{path}: a record doesn't end where its length says")


def _store(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path.removeprefix("file:")


def _headers(f: io.BufferedReader, used: list[int] | None = None) -> dict[str, str]:
    """Header lines up to the empty one, by lower-case name."""
    out, last = {}, None
    while line := f.readline():
        if used is not None:
            used[0] += len(line)
        text = line.rstrip(b"\r\n").decode(errors="replace")
        if not text:
            break
        if text[0] in " \t" and last:  # a folded line
            out[last] += " " + text.strip()
            continue
        name, _, value = text.partition(":")
        last = name.strip().lower()
        out[last] = value.strip()
    return out


def _exactly(f: io.BufferedReader, n: int, path: str) -> bytes:
    data = f.read(n)
    if len(data) < n:
        raise ValueError(f"{path}: a record is cut off")
    return data


def _skip(f: io.BufferedReader, n: int, packed: bool, path: str) -> None:
    if not packed:
        f.seek(n, io.SEEK_CUR)
    else:
        while n:
            n -= len(_exactly(f, min(n, 1 << 20), path))


def read_warc(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """The records under `path`; a schema without `payload` skips payloads.
    Turns Spark's filter push-down into Python data sources on."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)
    reader = spark.read.format("warc")
    return (reader.schema(schema) if schema else reader).load(path)


def archived(pages: DataFrame, date: str = "2024-01-01T00:00:00Z", least_bytes: int = 0) -> DataFrame:
    """Write a WARC record per row of `pages` (page_id, url, html), read the
    archives back and return per record: page_id, payload_bytes, payload_digest
    (both of the full payload; of responses measured on the payload as read),
    record_type, refers_to (the page of the response, for revisits).

    Nulls, ties and repeated rows as in warc_records(); extra columns are
    ignored; an empty table gives archives without records, and no rows.
    """
    spark = pages.sparkSession
    path = scratch_dir(spark, "warc")
    write_warc(warc_records(pages, date, least_bytes), path)
    page = lambda c: F.regexp_extract(c, "urn:page:(-?[0-9]+)", 1).try_cast("long")
    is_response = F.col("record_type") == "response"
    digest = F.when(is_response, base32_sha1(F.col("payload"))).otherwise(F.regexp_replace("payload_digest", "^sha1:", ""))
    size = F.when(is_response, F.octet_length("payload")).otherwise(F.col("payload_bytes"))
    return read_warc(spark, path).select(
        page(F.col("record_id")).alias("page_id"), size.cast("long").alias("payload_bytes"), digest.alias("payload_digest"), "record_type",
        page(F.col("refers_to")).alias("refers_to"),
    )
