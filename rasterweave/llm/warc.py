"""WARC archives as a PySpark Python data source.

format("warc") writes a gzip member per record; each member's extra field tells its length. Reading plans ranges of files as
partitions, pushes predicates on the record type and other headers down, inflates a record's headers first, and seeks past
members that the predicates exclude without decoding their payloads.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull, WriterCommitMessage

from rasterweave.llm.common import saved, scratch, table

#: Columns that are headers, and the headers' names.
HEADERS = {
    "record_id": "WARC-Record-ID", "record_type": "WARC-Type", "warc_date": "WARC-Date", "target_uri": "WARC-Target-URI", "refers_to": "WARC-Refers-To",
    "payload_digest": "WARC-Payload-Digest", "payload_length": "WARC-Payload-Length", "content_type": "Content-Type",
}
SCHEMA = ", ".join(f"{c} string" for c in HEADERS) + ", payload binary"
ARROW = pa.schema([*((c, pa.string()) for c in HEADERS), ("payload", pa.binary())])
#: gzip: deflate with an extra field; then time, flags, system, field length 12, field "sl" of 8 bytes: lengths of the member and of what it holds.
MEMBER = b"\x1f\x8b\x08\x04" + bytes(4) + b"\x00\xff" + struct.pack("<H2sH", 12, b"sl", 8)
HEAD = len(MEMBER) + 8
BATCH_BYTES = 8 << 20
DEFAULT_SPLIT = 64 << 20


def member(record: bytes) -> bytes:
    deflate = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = deflate.compress(record) + deflate.flush()
    size = HEAD + len(body) + 8
    return MEMBER + struct.pack("<II", size & 0xFFFFFFFF, len(record) & 0xFFFFFFFF) + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


def record_bytes(values: dict[str, str | None], payload: bytes) -> bytes:
    """A record: version, headers, blank line, payload, two blank lines. Line ends in a value become spaces; null headers are left out."""
    lines = ["WARC/1.1", *(f"{HEADERS[c]}: {' '.join(str(v).split())}" for c, v in values.items() if v is not None), f"Content-Length: {len(payload)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def parse_headers(block: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for line in block.decode().split("\r\n")[1:] if ":" in line for k, v in [line.split(":", 1)]}


def opened(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


@dataclass
class FileRange(InputPartition):
    file: str
    begin: int
    end: int


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.split = int(options.get("splitbytes", DEFAULT_SPLIT))
        self.payload = options.get("payload", "true").lower() != "false"
        self.wanted: dict[str, set[str]] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes equality and membership of header columns, and what they imply; yields the rest back to Spark."""
        taken = [f for f in filters if isinstance(f, EqualTo | In) and len(f.attribute) == 1 and f.attribute[0] in HEADERS]
        for f in taken:
            values = {f.value} if isinstance(f, EqualTo) else set(f.value)
            self.wanted[f.attribute[0]] = self.wanted.get(f.attribute[0], values) & values
        for f in filters:
            if f not in taken and not (isinstance(f, IsNotNull) and f.attribute[0] in self.wanted):
                yield f

    def partitions(self) -> list[FileRange]:
        fs, root = opened(self.path)
        files = [x for x in fs.get_file_info(pyarrow.fs.FileSelector(root, recursive=True)) if x.is_file and x.base_name.endswith((".warc.gz", ".warc"))]
        out = []
        for x in sorted(files, key=lambda x: x.path):
            step = self.split if x.base_name.endswith(".gz") else max(1, x.size)
            out += [FileRange(x.path, a, min(a + step, x.size)) for a in range(0, x.size, step)]
        return out or [FileRange("", 0, 0)]

    def row(self, headers: dict[str, str]) -> dict | None:
        values = {c: headers.get(h.lower()) for c, h in HEADERS.items()}
        return values if all(values[c] in w for c, w in self.wanted.items()) else None

    def read(self, partition: FileRange) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for row in self.rows(partition) if partition.file else ():
            rows.append(row)
            held += len(row["payload"] or b"") + 200
            if held > BATCH_BYTES:
                yield pa.RecordBatch.from_pylist(rows, ARROW)
                rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, ARROW)

    def rows(self, part: FileRange) -> Iterator[dict]:
        fs, _ = opened(self.path)
        with fs.open_input_file(part.file) as file:
            if part.file.endswith(".gz"):
                signed = file.read(len(MEMBER))[:4] == MEMBER[:4]
                if signed:
                    yield from self.members(file, part)
                elif not part.begin:  # members without lengths: one after the other from the start
                    yield from self.stream(file)
            else:
                yield from self.plain(file)

    def members(self, file, part: FileRange) -> Iterator[dict]:
        """Records whose members begin in the range."""
        at, size = part.begin, file.size()
        while at and at < part.end:  # the first member of the range: its signature, and WARC after it
            file.seek(at)
            block = file.read(1 << 20)
            k = block.find(MEMBER)
            if k < 0:
                at += max(1, len(block) - len(MEMBER) + 1)
            elif self.head(file, at + k)[0]:
                at += k
                break
            else:
                at += k + 1
        while at < min(part.end, size):
            headers, length, inflate, text, rest = self.head(file, at)
            if not headers:
                raise ValueError(f"no record at {at} of {part.file}")
            if row := self.row(headers):
                row["payload"] = None
                if self.payload:
                    n = int(headers["content-length"])
                    have = rest + (inflate.decompress(text + file.read(max(0, at + length - file.tell()))) if len(rest) < n else b"")
                    row["payload"] = have[:n]
                yield row
            at += length

    def head(self, file, at: int):
        """Headers of the member at a place, its length, and what is needed to inflate the rest."""
        file.seek(at)
        raw = file.read(HEAD + 4096)
        if not raw.startswith(MEMBER):
            return None, 0, None, b"", b""
        length = struct.unpack_from("<I", raw, len(MEMBER))[0]
        inflate, out = zlib.decompressobj(-15), b""
        try:
            out = inflate.decompress(raw[HEAD:length], 4096)
            while b"\r\n\r\n" not in out and not inflate.eof:
                more = inflate.unconsumed_tail or file.read(65536)
                if not more:
                    break
                out += inflate.decompress(more, 65536)
        except zlib.error:
            return None, 0, None, b"", b""
        head, found, rest = out.partition(b"\r\n\r\n")
        if not found or not head.startswith(b"WARC/1."):
            return None, 0, None, b"", b""
        return parse_headers(head), length, inflate, inflate.unconsumed_tail, rest

    def stream(self, file) -> Iterator[dict]:
        """Members whose lengths aren't told: what the predicates exclude is inflated, but not kept."""
        file.seek(0)
        raw = b""
        while raw := raw or file.read(65536):
            inflate, out, row, n = zlib.decompressobj(31), b"", None, -1
            while not inflate.eof:
                got = inflate.decompress(raw)
                raw = inflate.unused_data if inflate.eof else file.read(65536)
                if n < 0:
                    out += got
                    if b"\r\n\r\n" in out:
                        head, _, out = out.partition(b"\r\n\r\n")
                        n = int((headers := parse_headers(head))["content-length"])
                        row = self.row(headers)
                elif row is not None and self.payload and len(out) < n:
                    out += got
                if not raw and not inflate.eof:
                    return
            if row is not None:
                yield row | {"payload": out[:n] if self.payload else None}

    def plain(self, file) -> Iterator[dict]:
        file.seek(0)
        head = b""
        while block := file.read(65536):
            head += block
            while b"\r\n\r\n" in head:
                lines, _, rest = head.lstrip(b"\r\n").partition(b"\r\n\r\n")
                if not lines.startswith(b"WARC/1."):
                    break
                headers = parse_headers(lines)
                n, begin = int(headers["content-length"]), file.tell() - len(rest)
                if row := self.row(headers):
                    row["payload"] = (rest[:n] + file.read(max(0, n - len(rest)))) if self.payload else None
                    yield row
                file.seek(begin + n + 4)
                head = b""
                break


@dataclass
class Written(WriterCommitMessage):
    file: str | None


class WarcWriter(DataSourceArrowWriter):
    """Each task writes a file under a name of its own; the commit renames those of the tasks that count, an abort removes them."""

    def __init__(self, options: dict[str, str], overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = opened(self.path)
        fs.create_dir(root, recursive=True)
        name, out = f"{root}/{uuid.uuid4().hex}.warc.gz.open", None
        for batch in iterator:
            for row in batch.to_pylist():
                out = out or fs.open_output_stream(name, compression=None)
                payload = row.pop("payload") or b""
                out.write(member(record_bytes({c: row.get(c) for c in HEADERS}, payload)))
        if out is None:
            return Written(None)
        out.close()
        return Written(name)

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = opened(self.path)
        if self.overwrite and fs.get_file_info(root).type != pyarrow.fs.FileType.NotFound:
            for x in fs.get_file_info(pyarrow.fs.FileSelector(root)):
                if x.is_file and x.base_name.endswith((".warc.gz", ".warc")):
                    fs.delete_file(x.path)
        for m in messages:
            if m and m.file:
                fs.move(m.file, m.file.removesuffix(".open"))

    def abort(self, messages: list[Written | None]) -> None:
        fs, _ = opened(self.path)
        for m in messages:
            if m and m.file:
                fs.delete_file(m.file)


class WarcSource(DataSource):
    """Options: path; payload=false leaves payloads out; splitBytes, bytes of a partition."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options), overwrite)


def register(spark: SparkSession) -> SparkSession:
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark


def deduplicated(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """pages (page_id, url, html) with payload, sha1, payload_bytes, record_type and refers_to.

    Of pages with equal payloads of at least least_bytes, those with the largest page_id are responses, the others revisits of it; all
    smaller ones are responses. A null html is an empty payload; a null page_id is less than any other; repeated rows of the largest id
    are all responses. Other columns are not looked at.

    Ids and digests alone are grouped by payload; payloads are shuffled once, by id and digest, so a payload that very many pages share is no hot key.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"))
    slim = saved(rows.select("page_id", F.sha1("payload").alias("sha1"), F.octet_length("payload").cast("bigint").alias("payload_bytes")), "digests")
    shared = slim.where(F.col("payload_bytes") >= least_bytes).groupBy("sha1").agg(F.max("page_id").alias("first_id"), F.count("*").alias("pages")).where("pages > 1")
    again = slim.join(saved(shared.drop("pages"), "shared"), "sha1").where(~F.col("page_id").eqNullSafe(F.col("first_id")))
    again = saved(again.select(F.col("page_id").alias("again_id"), F.col("sha1").alias("again_sha1"), "first_id").distinct(), "revisits")
    named = rows.withColumn("sha1", F.sha1("payload"))
    # joined alike at every size
    joined = named.join(again.hint("merge"), named["page_id"].eqNullSafe(again["again_id"]) & (named["sha1"] == again["again_sha1"]), "left")
    first = F.col("again_sha1").isNull()
    return joined.select("page_id", "url", "payload", "sha1", F.octet_length("payload").cast("bigint").alias("payload_bytes"), F.when(first, "response").otherwise("revisit").alias("record_type"), F.when(~first, F.col("first_id")).alias("refers_to"))


def base32(sha1_hex: Column) -> Column:
    """A digest's 160 bits in base 32: each 40 of them are eight digits to the base, which have other names in conv()."""
    digits = [F.lpad(F.conv(F.substring(sha1_hex, i * 10 + 1, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*digits), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def write_pages(pages: DataFrame, path: str) -> None:
    """A record for each page: payloads of responses, headers alone for revisits."""
    rows = deduplicated(pages)
    urn = lambda c: F.concat(F.lit("urn:page:"), F.col(c))
    first = F.col("record_type") == "response"
    records = rows.select(
        urn("page_id").alias("record_id"), "record_type", F.lit("2024-01-01T00:00:00Z").alias("warc_date"), F.col("url").alias("target_uri"), urn("refers_to").alias("refers_to"),
        F.concat(F.lit("sha1:"), base32(F.col("sha1"))).alias("payload_digest"), F.col("payload_bytes").cast("string").alias("payload_length"), F.lit("text/html; charset=utf-8").alias("content_type"), F.when(first, F.col("payload")).alias("payload"),
    )
    records.write.format("warc").mode("append").save(path)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the archive to the shared folder and reads it back: responses are measured by their payloads; revisits are read by their headers, no payload decoded."""
    path = scratch(spark, "warc")
    register(spark)
    write_pages(table(spark, sf_dir, "pages"), path)
    number = lambda c: F.regexp_extract(c, r"^urn:page:(-?\d+)$", 1).try_cast("bigint")
    archive = lambda **options: spark.read.format("warc").options(**options).load(path)
    responses = archive().where(F.col("record_type") == "response").select("record_id", F.octet_length("payload").cast("bigint").alias("payload_bytes"), base32(F.sha1("payload")).alias("payload_digest"), "record_type", "refers_to")
    revisits = archive(payload="false").where(F.col("record_type") == "revisit").select("record_id", F.col("payload_length").cast("bigint").alias("payload_bytes"), F.substring_index("payload_digest", ":", -1).alias("payload_digest"), "record_type", "refers_to")
    return responses.unionByName(revisits).select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to"))
