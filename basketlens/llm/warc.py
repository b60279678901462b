"""Legacy archives: write ARC, convert ARC to WARC, read WARC.

Archives are ordinary files in the shared folder, written by Spark's text
writer (the line separator is the blank that each format puts after a record)
and read by its binary reader, so any store that Spark reaches will do. An
archive is bounded by ``ARCHIVE_BYTES`` of records (and one more record),
which bounds what a task holds.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.llm.common import slices, stage
from basketlens.session import scratch_path

ARCHIVE_BYTES = 16 << 20
_NOWHERE = "0.0.0.0"
# The field lines of ARC versions 1 and 2.
ARC_FIELDS = {1: "URL IP-address Archive-date Content-type Archive-length",
              2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"}
_WRITTEN = "archive int, seq long, record string"


def sha1_base32(raw: bytes) -> str:
    return base64.b32encode(hashlib.sha1(raw).digest()).decode()


def token(value: str | None) -> str:
    """A header field without blanks: they and other bytes outside the
    printable ASCII range are percent-encoded; empty or null is ``-``."""
    raw = (value or "").encode("utf-8", "surrogatepass")
    return "".join(chr(b) if 0x21 <= b <= 0x7E else f"%{b:02X}" for b in raw) or "-"


def _archived(records: Iterable[str], first: Callable[[int], str], number: int) -> Iterator[pa.RecordBatch]:
    """Deals a task's records to archives, each of which begins with ``first``."""
    archive, filled, rows = 0, ARCHIVE_BYTES, []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
            zip(*rows, strict=True), (pa.int32(), pa.int64(), pa.string()), strict=True)], ["archive", "seq", "record"])

    for seq, record in enumerate(records):
        if filled >= ARCHIVE_BYTES:
            if rows:
                yield batch()
                rows = []
            archive, filled = archive + 1, 0
            rows.append((archive, -1, first(number)))
        rows.append((archive, seq, record))
        filled += len(record)
    if rows:
        yield batch()


def _save(records: DataFrame, separator: str, name: str) -> str:
    path = scratch_path(records.sparkSession, name)
    (records.sortWithinPartitions("archive", "seq").select("archive", "record").write.partitionBy("archive")
     .option("lineSep", separator).option("compression", "gzip").text(path))
    return path


def _load(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def write_arc(pages: DataFrame) -> str:
    """ARC archives of (page_id, url, html): even tasks write version 1, odd
    ones version 2. A record holds the HTTP response whose body is the html
    in UTF-8 (null: empty); a null url is ``-``, a null page_id leaves its
    header out. Returns the folder."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        number = task.partitionId() if task else 0
        version = 1 + number % 2
        date = "20200101000000"

        def first(n: int) -> str:
            block = f"{version} 0 basketlens\n{ARC_FIELDS[version]}\n"
            head = f"filedesc://{n:06d}.arc {_NOWHERE} {date} text/plain "
            return head + ("" if version == 1 else f"200 - - 0 {n:06d}.arc ") + f"{len(block)}\n{block}"

        def records() -> Iterator[str]:
            for batch in slices(batches):
                for page, url, html in zip(*(batch.column(i) for i in range(3)), strict=True):
                    html = html.as_py() or ""
                    size = len(html.encode("utf-8", "surrogatepass"))
                    page = page.as_py()
                    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n"
                            + (f"X-Page-Id: {page}\r\n" if page is not None else "") + "\r\n")
                    more = "" if version == 1 else f"200 - - 0 {number:06d}.arc "
                    yield f"{token(url.as_py())} {_NOWHERE} {date} text/html {more}{len(http) + size}\n{http}{html}"

        yield from _archived(records(), first, number)

    given = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return _save(given.mapInArrow(run, _WRITTEN), "\n", "arc")


def parse_arc(raw: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, header fields, content) of each document record. The version
    block names the fields of the header lines, and each line's last field
    declares its content's length; both versions' separators are skipped."""
    at, names = 0, None
    while True:
        while raw[at:at + 1] == b"\n":
            at += 1
        end = raw.find(b"\n", at)
        if end < 0:
            return
        line = raw[at:end].decode("utf-8").split(" ")
        length = int(line[-1])
        content = raw[end + 1:end + 1 + length]
        if len(content) < length:
            raise ValueError(f"record at {at} declares {length} bytes, the archive has {len(content)}")
        if names is None:
            version, fields = content.split(b"\n")[:2]
            names = fields.decode().split(" ")
            if ARC_FIELDS.get(int(version.split(b" ")[0])) != " ".join(names):
                raise ValueError(f"unknown version block {content!r}")
        else:
            if len(line) != len(names):
                raise ValueError(f"record at {at} has {len(line)} header fields, not {len(names)}")
            yield at, dict(zip(names, line, strict=True)), content
        at = end + 1 + length


def split_http(content: bytes) -> tuple[bytes, bytes]:
    """HTTP head (with its blank line) and body; without a head all is body."""
    end = content.find(b"\r\n\r\n")
    return (content[:end + 4], content[end + 4:]) if content[:5] == b"HTTP/" and end >= 0 else (b"", content)


def http_field(head: bytes, name: str) -> str | None:
    mark = f"\r\n{name.lower()}:".encode()
    at = head.lower().find(mark)
    return head[at + len(mark):head.find(b"\r\n", at + 2)].decode().strip() if at >= 0 else None


def _place(path: str) -> str:
    """An archive's name within its folder."""
    return "/".join(path.split("/")[-2:])


def record_id(place: str, offset: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'arc:{place}:{offset}')}>"


def warc_date(arc_date: str) -> str:
    return datetime.strptime(arc_date, "%Y%m%d%H%M%S").replace(tzinfo=UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


def _head(fields: list[tuple[str, str]]) -> str:
    return "WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"


def _index(arcs: DataFrame) -> DataFrame:
    """``path, offset, page_id, payload_bytes, payload_digest, url, date`` of every ARC record."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            path, raw = batch.column(0)[0].as_py(), zlib.decompress(batch.column(1)[0].as_py(), 31)
            rows = []
            for offset, f, content in parse_arc(raw):
                head, body = split_http(content)
                page = http_field(head, "X-Page-Id")
                rows.append((path, offset, int(page) if page else None, len(body), sha1_base32(body), f["URL"],
                             f["Archive-date"]))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (
                        pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()), strict=True)],
                    ["path", "offset", "page_id", "payload_bytes", "payload_digest", "url", "date"])

    return arcs.mapInArrow(run, "path string, offset long, page_id long, payload_bytes long, payload_digest string, "
                                "url string, date string")


def convert(spark: SparkSession, arc_path: str, revisit_bytes: int = 0) -> str:
    """WARC archives of the ARC archives in a folder; returns their folder.

    Identifiers are name-based UUIDs of the record's archive and offset,
    timestamps the ARC dates in ISO 8601, digests SHA-1 in base32. Of records
    with equal payloads of at least ``revisit_bytes`` bytes the one with the
    largest page_id (a null is smaller than any; then the last place) is the
    response, the others revisit it and leave the payload out.
    """
    arcs = _load(spark, arc_path)
    index = stage(_index(arcs), "arc-index")
    large = index.where(F.col("payload_bytes") >= revisit_bytes)
    best = large.groupBy("payload_digest", "payload_bytes").agg(
        F.max(F.struct("page_id", "path", "offset", "url", "date")).alias("w"))
    revisits = (large.select("path", "offset", "payload_digest", "payload_bytes")
                .join(best, ["payload_digest", "payload_bytes"])
                .where("path != w.path or offset != w.offset")
                .groupBy("path").agg(F.collect_list(F.struct(  # the records of one archive
                    "offset", F.col("w.path").alias("to_path"), F.col("w.offset").alias("to_offset"),
                    F.col("w.url").alias("to_url"), F.col("w.date").alias("to_date"))).alias("revisits")))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        number = task.partitionId() if task else 0

        def first(n: int) -> str:
            body = "software: basketlens\r\nformat: WARC File Format 1.0\r\n"
            return _head([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'info:{n}')}>"),
                          ("WARC-Date", "2020-01-01T00:00:00Z"), ("Content-Type", "application/warc-fields"),
                          ("Content-Length", str(len(body)))]) + body

        def records() -> Iterator[str]:
            for batch in slices(batches, 1):
                path, raw = batch.column(0)[0].as_py(), zlib.decompress(batch.column(1)[0].as_py(), 31)
                known = {r["offset"]: r for r in batch.column(2)[0].as_py() or []}
                for offset, f, content in parse_arc(raw):
                    head, body = split_http(content)
                    to = known.get(offset)
                    block = content if to is None else head
                    fields = [("WARC-Type", "response" if to is None else "revisit"),
                              ("WARC-Record-ID", record_id(_place(path), offset)), ("WARC-Date", warc_date(f["Archive-date"])),
                              ("WARC-Target-URI", f["URL"]), ("WARC-IP-Address", f["IP-address"]),
                              ("WARC-Payload-Digest", f"sha1:{sha1_base32(body)}"),
                              ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}")]
                    if to is not None:
                        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"),
                                   ("WARC-Refers-To", record_id(_place(to["to_path"]), to["to_offset"])),
                                   ("WARC-Refers-To-Target-URI", to["to_url"]),
                                   ("WARC-Refers-To-Date", warc_date(to["to_date"]))]
                    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
                    yield _head(fields) + block.decode("utf-8", "surrogatepass")

        yield from _archived(records(), first, number)

    return _save(arcs.join(revisits, "path", "left").mapInArrow(run, _WRITTEN), "\r\n\r\n", "warc")


def parse_warc(raw: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record, by the declared lengths."""
    at = 0
    while at < len(raw):
        end = raw.index(b"\r\n\r\n", at)
        version, *lines = raw[at:end].decode("utf-8").split("\r\n")
        if version != "WARC/1.0":
            raise ValueError(f"no WARC record at {at}: {version!r}")
        fields = dict(x.split(": ", 1) for x in lines)
        length = int(fields["Content-Length"])
        block = raw[end + 4:end + 4 + length]
        if len(block) < length or raw[end + 4 + length:end + 8 + length] != b"\r\n\r\n":
            raise ValueError(f"record at {at} does not end where its length says")
        yield fields, block
        at = end + 8 + length


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """``record_id, record_type, page_id, payload_bytes, payload_digest,
    refers_to_id, url, date`` of every response and revisit. The digests of
    blocks and of payloads that are there are checked."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            rows = []
            for f, block in parse_warc(zlib.decompress(batch.column(1)[0].as_py(), 31)):
                kind = f["WARC-Type"]
                if kind not in ("response", "revisit"):
                    continue
                head, body = split_http(block)
                digest = f["WARC-Payload-Digest"].removeprefix("sha1:")
                if f["WARC-Block-Digest"] != f"sha1:{sha1_base32(block)}" or (
                        kind == "response" and digest != sha1_base32(body)):
                    raise ValueError(f"digest of {f['WARC-Record-ID']} does not fit")
                page = http_field(head, "X-Page-Id")
                size = len(body) if kind == "response" else int(http_field(head, "Content-Length") or 0)
                rows.append((f["WARC-Record-ID"], kind, int(page) if page else None, size, digest,
                             f.get("WARC-Refers-To"), f["WARC-Target-URI"], f["WARC-Date"]))
            names = ["record_id", "record_type", "page_id", "payload_bytes", "payload_digest", "refers_to_id", "url", "date"]
            if rows:
                kinds = [pa.int64() if n in ("page_id", "payload_bytes") else pa.string() for n in names]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return _load(spark, path).mapInArrow(run, "record_id string, record_type string, page_id long, payload_bytes long, "
                                              "payload_digest string, refers_to_id string, url string, date string")


def round_trip(pages: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of
    every row of ``pages``, written as ARC, converted and read back.

    A null html is an empty payload. Repeated rows are records of their own:
    one is the response. An empty table gives no rows.
    """
    spark = pages.sparkSession
    records = stage(read_warc(spark, convert(spark, write_arc(pages))), "warc-records")
    target = records.where("record_type = 'response'").select(F.col("record_id").alias("refers_to_id"),
                                                              F.col("page_id").alias("refers_to"))
    return (records.join(target, "refers_to_id", "left")
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
