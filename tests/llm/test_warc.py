from __future__ import annotations

import glob
import gzip
import hashlib
import random

import pytest

from sensorstream.llm import queries, warc
from sensorstream.llm.common import shared_path

KIND = "page_id long, url string, html string, refers_to string, payload_digest string"


def rows():
    rnd = random.Random(1)
    big = "".join(rnd.choice("abcdefgh <p>") for _ in range(200_000))
    same = "é" * 600
    return [(1, "http://a/ b\n", same), (2, None, same), (3, "http://c", same), (3, "http://c", same), (4, "x", "short"), (5, "x", "short"), (6, "u", None), (7, "u", ""), (None, "n", same), (9, "u", big), (10, "v", big), (11, "w", "y" * 1000), (12, "w", "y" * 999), (13, "w", "y" * 999)]


def wanted(data):
    top = {}
    for page, _, text in data:
        if page is not None and len((text or "").encode()) >= 1000:
            top[text] = max(top.get(text, page), page)
    out = []
    for page, _, text in data:
        raw = (text or "").encode()
        to = top.get(text) if len(raw) >= 1000 and top.get(text) != page else None
        out.append((page, len(raw), hashlib.sha1(raw).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(out, key=repr)


@pytest.mark.parametrize("range_bytes", [997, 20_000, 1 << 24])
def test_records_come_back_whole_and_once(spark, range_bytes):
    data = rows()
    pages = spark.createDataFrame([(*r, "x", "y") for r in data], KIND)
    folder = shared_path(spark, "warc")
    assert sum(r.records for r in warc.write_archives(warc.mark_revisits(pages), folder).collect()) == len(data)
    back = warc.read_archives(spark, folder, range_bytes=range_bytes)
    found = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in back.collect()), key=repr)
    assert found == wanted(data)
    full = warc.resolve(back).collect()
    assert sorted(hashlib.sha1(bytes(r.payload)).hexdigest() for r in full) == sorted(f[2] for f in found)


def test_archives_are_plain_gzip(spark):
    folder = shared_path(spark, "warc")
    pages = spark.createDataFrame([(*r, "x", "y") for r in rows()], KIND)
    warc.write_archives(warc.mark_revisits(pages), folder).collect()
    text = b"".join(gzip.open(p).read() for p in glob.glob(folder.removeprefix("file://") + "/*.warc.gz"))
    assert text.count(b"WARC/1.1\r\n") == len(rows())


class Bytes:
    def __init__(self, data):
        self.data, self.at = data, 0

    def size(self):
        return len(self.data)

    def seek(self, at):
        self.at = at

    def read(self, n):
        return self.data[self.at : self.at + n]


def test_false_magic_is_passed_over():
    good = [gzip.compress(warc.make_record(i, f"http://x/{i}", bytes(f"page {i}", "ascii"), "00" * 20, None)) for i in range(4)]
    noise = [warc.MAGIC + b"garbage", warc.MAGIC * 3, gzip.compress(b"no record at all"), b"\x1f\x8b", gzip.compress(b"WARC/1.1\r\nContent-Length: 99\r\n\r\nshort")]
    data = b"".join(x for pair in zip(noise[:4], good, strict=True) for x in pair) + noise[4] + good[0][:20]
    for step in (1, 7, 64, 10_000):
        got = [f["x-page-id"] for k in range(0, len(data), step) for f, _ in warc.records_in(warc._Window(Bytes(data)), k, min(k + step, len(data)))]
        assert got == ["0", "1", "2", "3"]


def test_no_pages(spark):
    folder = shared_path(spark, "warc")
    assert warc.write_archives(warc.mark_revisits(spark.createDataFrame([], KIND)), folder).count() == 0
    assert warc.read_archives(spark, folder).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    data = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    found = queries.QUERIES["op10_warc_ranges"](spark, sf).collect()
    assert sorted((tuple(r) for r in found), key=repr) == wanted(data)
