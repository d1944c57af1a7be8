"""WARC archives: a writer with revisit records, and a reader that splits archives anywhere.

Archives are made of gzip members, one per record. A reading task gets a byte range, looks for gzip
magic in it, and tries every hit: it counts as a record only if it inflates whole (length and CRC hold)
and starts with a WARC header whose Content-Length fits. A task owns the records that start inside
its range and reads on past its end to finish the last one, so each record is read once wherever the
ranges are cut. A hit that fails is skipped by one byte, so magic inside of compressed data does no harm.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorstream.llm.common import pieces, spread
from sensorstream.llm.files import make_folder, open_file, publish

MAGIC = b"\x1f\x8b\x08"
RANGE_BYTES, READ_BYTES, OUT_BYTES = 16 << 20, 256 << 10, 4 << 20
#: Compressed bytes after which a task starts its next archive.
ARCHIVE_BYTES = 1 << 30
LEVEL = 5
DATE = "1970-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string"


def mark_revisits(pages: DataFrame, minimum: int = 1000, key: str = "page_id", payload: str = "html") -> DataFrame:
    """(page_id, url, html, payload_digest, refers_to): of rows with equal payloads of at least `minimum` bytes, all
    but those with the largest key refer to that key. Null payloads are empty. Rows that share the largest
    key are all originals; in a group whose keys are all null every row is. Digests alone decide the
    groups, and only digests that occur under several keys are joined, so a payload shared
    by a third of all rows is counted map-side and joined as Spark joins skewed keys."""
    rows = pages.select(F.col(key).cast("long").alias("page_id"), "url", F.coalesce(payload, F.lit("")).alias("html"))
    rows = rows.withColumn("payload_digest", F.sha1(F.col("html").cast("binary")))
    groups = rows.where(F.octet_length("html") >= minimum).groupBy("payload_digest").agg(F.max("page_id").alias("original"), F.count(F.lit(1)).alias("n"))
    joined = rows.join(groups.where("n > 1").drop("n"), "payload_digest", "left")
    refers = F.when(F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original")), F.col("original"))
    return joined.select("page_id", "url", "html", "payload_digest", refers.alias("refers_to"))


def record_id(page: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.UUID(hashlib.md5(f'{page} {digest}'.encode()).hexdigest())}>"


def make_record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record, inflated. A revisit keeps the HTTP header, with the full payload's length, and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", record_id(page, digest)),
        ("WARC-Date", DATE), ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if page is not None:
        fields.append(("X-Page-Id", str(page)))
    if refers_to is not None:
        fields += [("WARC-Refers-To", record_id(refers_to, digest)), ("X-Refers-To-Page-Id", str(refers_to)), ("WARC-Profile", REVISIT_PROFILE)]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def write_archives(marked: DataFrame, folder: str) -> DataFrame:
    """Write the rows of `mark_revisits` below `folder`; one row per archive (path, records, bytes). Running that
    plan writes; a task that runs again replaces its archives. An empty partition writes none."""

    make_folder(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        done: list[tuple[str, int, int]] = []
        rows = (row for batch in batches for part in pieces(batch, "html") for row in zip(*(part.column(c).to_pylist() for c in ("page_id", "url", "html", "payload_digest", "refers_to")), strict=True))
        row = next(rows, None)
        while row is not None:
            path = f"{folder}/pages-{task.partitionId():06d}-{len(done):04d}.warc.gz"
            count = size = 0
            with publish(path) as out:
                while row is not None and size < ARCHIVE_BYTES:
                    page, url, html, digest, refers_to = row
                    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                    member = packer.compress(make_record(page, url, html.encode(), digest, refers_to)) + packer.flush()
                    out.write(member)
                    count, size = count + 1, size + len(member)
                    row = next(rows, None)
            done.append((path, count, size))
        columns = list(zip(*done, strict=True)) or [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())], names=["path", "records", "bytes"])

    return marked.mapInArrow(run, "path string, records long, bytes long")


class _Window:
    """Bytes of a file by absolute place, read ahead in steps and forgotten behind the reader."""

    def __init__(self, file: pa.NativeFile):
        self.file, self.size, self.at, self.data = file, file.size(), 0, b""

    def get(self, at: int, n: int = READ_BYTES) -> bytes:
        if not (self.at <= at and min(at + n, self.size) <= self.at + len(self.data)):
            self.file.seek(at)
            self.at, self.data = at, self.file.read(max(n, 4 * READ_BYTES))
        return self.data[at - self.at : at - self.at + n]


def _inflate(window: _Window, at: int) -> tuple[bytes, int] | None:
    """The member that starts at `at` and where it ends; None if it is no whole gzip member that holds a WARC record."""
    engine, out, place = zlib.decompressobj(31), [], at
    try:
        while not engine.eof:
            data = window.get(place)
            if not data:
                return None
            part = engine.decompress(data)
            if part and not out and not part.startswith(b"WARC/1."[: len(part)]):
                return None
            out += [part] * bool(part)
            place += len(data)
    except zlib.error:
        return None
    return b"".join(out), place - len(engine.unused_data)


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes] | None:
    head, gap, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not gap or not lines[0].startswith("WARC/1."):
        return None
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    length = fields.get("content-length", "")
    if not length.isdigit() or len(rest) < int(length):
        return None
    return fields, rest[: int(length)]


def records_in(window: _Window, start: int, end: int) -> Iterator[tuple[dict[str, str], bytes]]:
    """All records whose member starts in [start, end)."""
    at = start
    while at < end:
        data = window.get(at, min(READ_BYTES, end - at) + len(MAGIC) - 1)
        hit = data.find(MAGIC)
        if hit < 0:
            if len(data) < len(MAGIC):
                return
            at += len(data) - len(MAGIC) + 1
            continue
        at += hit
        if at >= end:
            return
        member = _inflate(window, at)
        record = parse_record(member[0]) if member else None
        if record is None:
            at += 1
            continue
        yield record
        at = member[1]


def _row(fields: dict[str, str], block: bytes) -> tuple:
    kind = fields.get("warc-type")
    http, _, payload = block.partition(b"\r\n\r\n") if fields.get("content-type", "").startswith("application/http") else (b"", b"", block)
    stated = re.sub("^sha1:", "", fields.get("warc-payload-digest", ""))
    digest = base64.b32decode(stated).hex() if stated else None
    if kind == "revisit":
        length = re.search(rb"(?i)\ncontent-length:\s*(\d+)", http)
        size = int(length[1]) if length else None
        payload = None
    else:
        size, counted = len(payload), hashlib.sha1(payload).hexdigest()
        if digest not in (None, counted):
            raise ValueError(f"payload of {fields.get('warc-record-id')} does not have its digest")
        digest = counted
    page, refers = fields.get("x-page-id"), fields.get("x-refers-to-page-id")
    return page and int(page), fields.get("warc-target-uri"), kind, refers and int(refers), size, digest, payload


def read_archives(spark: SparkSession, folder: str, payload: bool = True, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Response and revisit records of all `*.warc.gz` below `folder`: page_id (X-Page-Id), url, record_type, refers_to
    (X-Refers-To-Page-Id), payload_bytes, payload_digest (hex) and, if `payload`, the payload (binary, null for a
    revisit; `resolve` fetches it). Payload digests are checked. Work is dealt by byte range, however few
    archives there are. A folder without archives gives an empty table."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder).select("path", "length")
    ranges = listed.select("path", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(range_bytes).cast("long"))).alias("start"))
    names = [f.split()[0] for f in RECORD.split(", ")] + ["payload"] * payload
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()][: len(names)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
                with open_file(path) as file:
                    window, rows, held = _Window(file), [], 0
                    for fields, block in records_in(window, start, min(start + range_bytes, window.size)):
                        if fields.get("warc-type") not in ("response", "revisit"):
                            continue
                        rows.append(_row(fields, block)[: len(names)])
                        held += len(block)
                        if held >= OUT_BYTES:
                            yield _batch(rows, names, kinds)
                            rows, held = [], 0
                    if rows:
                        yield _batch(rows, names, kinds)

    return spread(ranges, ranges.count()).mapInArrow(run, RECORD + ", payload binary" * payload)


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def resolve(records: DataFrame) -> DataFrame:
    """Give revisits the payload of the response they refer to."""
    originals = records.where("record_type = 'response'").select(F.col("page_id").alias("refers_to"), "payload_digest", F.col("payload").alias("_full"))
    joined = records.join(originals.dropDuplicates(["refers_to", "payload_digest"]), ["refers_to", "payload_digest"], "left")
    return joined.select("page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", F.coalesce("payload", "_full").alias("payload"))
