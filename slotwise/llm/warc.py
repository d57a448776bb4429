"""WARC archives as a Spark data source, written and read by executors in parallel.

Reading plans partitions from files and their sizes, parses the header block of each record first and tests
the predicates Spark pushes down against it; the payload of a record that fails them, or that nobody asked
for, is stepped over.  Written files hold a gzip member for each header block and each payload, with the
member's size in an extra field (any gzip reader sees a plain WARC file, though one that opens records by offset finds
headers and payload in members of their own), so stepping over needs no inflating.  Archives of other writers are read
through.  An archive that ends inside a record or whose check sums do not fit fails the job; payloads stepped over are
not checked.
"""

from __future__ import annotations

import base64
import gzip
import io
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    StringContains,
    StringEndsWith,
    StringStartsWith,
    WriterCommitMessage,
)

from slotwise.operators.sizing import broadcast_if_small
from slotwise.sources.scratch import new_folder

# Equal payloads of at least so many bytes are stored once.
LEAST_REVISITED = 0
# Small files are read together up to so many bytes a partition.
PARTITION_BYTES = 64 * 1024 * 1024
BATCH_BYTES = 4 * 1024 * 1024
BATCH_ROWS = 2_000
LEVEL = 1
MANIFEST = "_files"
FIELDS = {
    "record_id": "WARC-Record-ID",
    "record_type": "WARC-Type",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "payload_digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To",
    "content_type": "Content-Type",
}
SCHEMA = ", ".join(f"{n} string" for n in FIELDS) + ", payload_length long, payload binary"
_LENGTH = "X-Payload-Length"
_EXTRA = b"WL"


def _filesystem(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:/") and not path.startswith("file://"):
        path = path[len("file:") :]
    return fs.FileSystem.from_uri(path)


def member(data: bytes) -> bytes:
    """A gzip member that carries its own size."""
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    size = 10 + 2 + 8 + len(body) + 8
    extra = _EXTRA + struct.pack("<HI", 4, size)
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def header_block(headers: dict[str, str]) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {' '.join(v.split())}" for k, v in headers.items())]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def parse_headers(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}


@dataclass
class Written(WriterCommitMessage):
    name: str


class WarcWriter(DataSourceArrowWriter):
    """Each task writes one file of its own name; only committed files are named in the manifest."""

    def __init__(self, path: str) -> None:
        self.path = path

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        system, path = _filesystem(self.path)
        system.create_dir(path, recursive=True)
        name = f"part-{uuid.uuid4().hex}.warc.gz"
        with system.open_output_stream(f"{path}/{name}", compression=None) as out:
            for batch in batches:
                columns = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
                for i in range(batch.num_rows):
                    row = {n: c[i].as_py() for n, c in columns.items()}
                    payload = row.pop("payload") or b""
                    length = row.pop("payload_length")
                    headers = {FIELDS[n]: v for n, v in row.items() if v is not None}
                    headers |= {_LENGTH: str(length), "Content-Length": str(len(payload))}
                    out.write(member(header_block(headers)))
                    out.write(member(payload + b"\r\n\r\n"))
        return Written(name)

    def commit(self, messages: list[Written | None]) -> None:
        system, path = _filesystem(self.path)
        system.create_dir(path, recursive=True)
        old = _manifest(system, path) or []
        with system.open_output_stream(f"{path}/{MANIFEST}", compression=None) as out:
            out.write("\n".join([*old, *(m.name for m in messages if m)]).encode())

    def abort(self, messages: list[Written | None]) -> None:
        """Files of an aborted write stay unnamed and are never read."""


def _manifest(system: fs.FileSystem, path: str) -> list[str] | None:
    if system.get_file_info(f"{path}/{MANIFEST}").type != fs.FileType.File:
        return None
    with system.open_input_stream(f"{path}/{MANIFEST}", compression=None) as source:
        return [x for x in source.read().decode().split("\n") if x]


@dataclass
class Files(InputPartition):
    paths: list[str]


def _tests(column: str, f: Filter):
    """The predicate as a function of a header's value, None if it is not one on a header."""
    if isinstance(f, EqualTo | EqualNullSafe):
        return lambda v: v == f.value
    if isinstance(f, In):
        wanted = set(f.value)
        return lambda v: v in wanted
    if isinstance(f, IsNotNull):
        return lambda v: v is not None
    if isinstance(f, StringStartsWith):
        return lambda v: v is not None and v.startswith(f.value)
    if isinstance(f, StringEndsWith):
        return lambda v: v is not None and v.endswith(f.value)
    if isinstance(f, StringContains):
        return lambda v: v is not None and f.value in v
    return None


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payload: bool) -> None:
        self.path, self.payload, self.filters = path, payload, []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = getattr(f, "attribute", (None,))
            if len(column) == 1 and column[0] in FIELDS and _tests(column[0], f):
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[Files]:
        system, path = _filesystem(self.path)
        infos = system.get_file_info(fs.FileSelector(path, recursive=True))
        named = _manifest(system, path)
        chosen = None if named is None else set(named)
        files = [
            (x.size, x.path)
            for x in infos
            if x.type == fs.FileType.File
            and x.base_name.endswith((".warc", ".warc.gz"))
            and (chosen is None or x.base_name in chosen)
        ]
        out, held, size = [], [], 0
        for n, file in sorted(files, reverse=True):
            if held and size + n > PARTITION_BYTES:
                out.append(Files(held))
                held, size = [], 0
            held.append(file)
            size += n
        return [*out, Files(held)] if held else out or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        system, _ = _filesystem(self.path)
        tests = [(FIELDS[f.attribute[0]].lower(), _tests(f.attribute[0], f)) for f in self.filters]
        wanted = lambda headers: all(t(headers.get(k)) for k, t in tests)
        rows, size = [], 0
        for path in partition.paths:
            with system.open_input_file(path) as source:
                for headers, payload in records(source, wanted, self.payload):
                    length = headers.get(_LENGTH.lower(), headers.get("content-length", "0"))
                    rows.append((*(headers.get(h.lower()) for h in FIELDS.values()), int(length), payload))
                    size += len(payload or b"") + 500
                    if size > BATCH_BYTES or len(rows) >= BATCH_ROWS:
                        yield _batch(rows)
                        rows, size = [], 0
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * (len(FIELDS) + 2)
    types = [pa.string()] * len(FIELDS) + [pa.int64(), pa.binary()]
    names = [*FIELDS, "payload_length", "payload"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def records(source, wanted, payload: bool) -> Iterator[tuple[dict[str, str], bytes | None]]:
    """(headers, payload) of the records whose headers are wanted; payload None where it is not."""
    start = source.read(16)
    source.seek(0)
    if not start:
        return
    if start[:4] == b"\x1f\x8b\x08\x04" and start[12:14] == _EXTRA:
        yield from _own_records(source, wanted, payload)
    else:
        stream = gzip.GzipFile(fileobj=source) if start[:2] == b"\x1f\x8b" else source
        yield from _any_records(io.BufferedReader(stream), wanted, payload)


class DamagedArchive(ValueError):
    """An archive that ends inside a record, or whose check sums do not fit."""


def _whole(source, size: int, what: str) -> bytes:
    data = source.read(size)
    if len(data) < size:
        raise DamagedArchive(f"the archive ends inside {what}")
    return data


def _member_size(source) -> int | None:
    """What is left of the next gzip member behind its header; None at the end."""
    head = source.read(20)
    if not head:
        return None
    if len(head) < 20 or head[:4] != b"\x1f\x8b\x08\x04" or head[12:14] != _EXTRA:
        raise DamagedArchive("a gzip member without its size")
    return struct.unpack("<I", head[16:20])[0] - 20


def _inflated(source, size: int, what: str) -> bytes:
    body = _whole(source, size, what)
    try:
        data = zlib.decompress(body[:-8], -15)
    except zlib.error as error:
        raise DamagedArchive(f"{what} cannot be inflated") from error
    if struct.unpack("<II", body[-8:]) != (zlib.crc32(data), len(data) & 0xFFFFFFFF):
        raise DamagedArchive(f"the check sum of {what} does not fit")
    return data


def _own_records(source, wanted, payload: bool) -> Iterator[tuple[dict[str, str], bytes | None]]:
    """Records whose headers and payload are members of known size; a payload stepped over is not checked."""
    end = source.size()
    while (size := _member_size(source)) is not None:
        headers = parse_headers(_inflated(source, size, "headers"))
        size = _member_size(source)
        if size is None or source.tell() + size > end:
            raise DamagedArchive("the archive ends inside a payload")
        asked = wanted(headers)
        if asked and payload:
            yield headers, _inflated(source, size, "a payload")[:-4]
        else:
            source.seek(size, 1)
            if asked:
                yield headers, None


def _any_records(source, wanted, payload: bool) -> Iterator[tuple[dict[str, str], bytes | None]]:
    """Records of a file by another writer, compressed or not; an unwanted payload is inflated, but no text is decoded."""
    while line := source.readline():
        if not line.strip():
            continue
        block = [line]
        while (line := source.readline()).strip():
            block.append(line)
        if not line:
            raise DamagedArchive("the archive ends inside headers")
        headers = parse_headers(b"".join(block).replace(b"\r\n", b"\n").replace(b"\n", b"\r\n"))
        data = _whole(source, int(headers.get("content-length", "0")), "a payload")
        if wanted(headers):
            yield headers, data if payload else None


class WarcSource(DataSource):
    """Format ``warc``; options: path, and payload (true unless given as false)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], self.options.get("payload", "true").lower() != "false")

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"])


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def write(records_: DataFrame, path: str) -> None:
    """Appends rows of SCHEMA to the archive folder."""
    register(records_.sparkSession)
    records_.select(*FIELDS, "payload_length", "payload").write.format("warc").mode("append").save(path)


def read(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def page_records(pages: DataFrame, least: int = LEAST_REVISITED) -> DataFrame:
    """A record per page: of equal payloads of at least ``least`` bytes the largest page_id is the response,
    the others revisit it and hold no payload.

    Defined for: null html (an empty payload), very long html (whole), null ids (smaller than all others),
    repeated rows (each is a record; all that share the largest page_id are responses), empty tables (no
    rows), other columns (ignored).
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        payload.alias("payload"),
        F.unhex(F.sha1(payload)).alias("digest"),
    )
    # Only digests and ids are grouped; a payload that many pages share is one row of the result.
    groups = (
        rows.select("digest", "page_id", F.length("payload").alias("n"))
        .where(F.col("n") >= least)
        .groupBy("digest")
        .agg(F.max("page_id").alias("last"), F.count("*").alias("pages"))
        .where("pages > 1")
        .select("digest", "last")
    )
    joined = rows.join(broadcast_if_small(groups), "digest", "left")
    revisit = F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    text = F.arrow_udf(_base32_of, "string")(F.col("digest"))
    return joined.select(
        urn(F.col("page_id")).alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.col("url").alias("target_uri"),
        F.lit("1970-01-01T00:00:00Z").alias("date"),
        F.concat(F.lit("sha1:"), text).alias("payload_digest"),
        F.when(revisit, urn(F.col("last"))).alias("refers_to"),
        F.lit("text/html; charset=utf-8").alias("content_type"),
        F.length("payload").cast("long").alias("payload_length"),
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def _base32_of(digests: pa.Array) -> pa.Array:
    return pa.array([base64.b32encode(x.as_py()).decode() for x in digests], pa.string())


def archived(pages: DataFrame) -> DataFrame:
    """Writes the pages as WARC files to the shared folder and reads the record headers back:
    (page_id, payload_bytes, payload_digest, record_type, refers_to)."""
    spark = pages.sparkSession
    path = new_folder(spark, "warc")
    write(page_records(pages), path)
    number = lambda c: F.regexp_extract(c, r"<urn:page:(-?\d+)>", 1).try_cast("long")
    back = read(spark, path, payload=False).where(F.col("record_type").isin("response", "revisit"))
    return back.select(
        number("record_id").alias("page_id"),
        F.col("payload_length").alias("payload_bytes"),
        F.regexp_replace("payload_digest", "^sha1:", "").alias("payload_digest"),
        "record_type",
        number("refers_to").alias("refers_to"),
    )
