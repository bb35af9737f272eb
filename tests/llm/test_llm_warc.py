import base64
import hashlib
import struct
from collections import Counter

import pytest
import zstandard
from pyspark.sql import functions as F

from matchmart.llm import warc as W

SCHEMA = "page_id long, url string, html string, payload string, same string, salt string, file string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA)


def expected(rows, min_bytes=0):
    first = {}
    for page_id, _, html in rows:
        if page_id is not None and (html not in first or page_id < first[html]):
            first[html] = page_id
    first = {(k or "").encode(): min([first[x] for x in first if (x or "") == (k or "")]) for k in first}
    out = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        response = first.get(payload) if len(payload) >= min_bytes else None
        revisit = response is not None and page_id != response
        out.append((page_id, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(),
                    "revisit" if revisit else "response", response if revisit else None))
    return sorted(out, key=str)


def written(spark, rows, folder, min_bytes=0, **options):
    return W.write_archives(W.with_record_types(table(spark, rows), min_bytes), str(folder), **options)


def read(index):
    return sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                   for r in W.read_archives(index).collect()], key=str)


EDGE = [(5, "http://a.net/x y", "same"), (3, "http://a.net/ü?q=%20", "same"), (3, "http://a.net/", "same"),
        (None, None, "same"), (None, "u", "alone"), (None, "u", "alone"), (7, None, None), (2, "", ""),
        (-4, "http://b\r\nInjected: 1", "a\r\n\r\nb"), (2**62, "v", "\x00퟿日本 \r\n"), (8, "long", "z" * 3_000_000)]


@pytest.mark.parametrize("min_bytes", [0, 5])
def test_rows_come_back(spark, tmp_path, min_bytes):
    index = written(spark, EDGE, tmp_path / "w", min_bytes, archive_bytes=1 << 20)
    assert read(index) == expected(EDGE, min_bytes)


def test_payloads_and_places(spark, tmp_path):
    rows = [(i, f"http://h{i % 7}.org/{i}", f"<html><head><title>Page {i % 90}</title></head><body class='main'>"
             f"<p>{'paragraph ' * (i % 40)}{i % 90}</p></body></html>") for i in range(600)]
    index = written(spark, rows, tmp_path / "w", archive_bytes=100_000)
    html = {i: h for i, _, h in rows}
    whole = W.read_archives(index).collect()
    assert len(whole) == 600
    for r in whole:
        source = r.page_id if r.record_type == "response" else r.refers_to
        assert r.payload_digest == base64.b32encode(hashlib.sha1(html[r.page_id].encode()).digest()).decode()
        assert html[source] == html[r.page_id]
        assert (r.payload is None) == (r.record_type == "revisit")
        if r.payload is not None:
            assert bytes(r.payload).decode() == html[r.page_id]
    some = index.where("page_id % 50 = 3")
    assert {r.page_id for r in W.read_records(some).collect()} == set(range(3, 600, 50))


def test_file_format(spark, tmp_path):
    """Each archive alone: the dictionary in the leading skippable frame, then one frame a record."""
    rows = [(i, f"http://a.org/{i}", f"<html><body><div class='item'>number {i}</div><footer>all rights reserved by us"
             "</footer></body></html>") for i in range(3000)]
    index = written(spark, rows, tmp_path / "w")
    with_dictionary = 0
    for path in {r.file for r in index.collect()}:
        data = open(path.removeprefix("file:"), "rb").read()
        magic, size = struct.unpack("<II", data[:8])
        assert magic == 0x184D2A5D
        dictionary = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(data[8:8 + size]))
        assert dictionary.dict_id() != 0
        plain = zstandard.ZstdDecompressor(dict_data=dictionary)
        for r in index.where(index.file == path).collect():
            frame = data[r.offset:r.offset + r.length]
            assert zstandard.get_frame_parameters(frame).dict_id == dictionary.dict_id()
            record = plain.decompress(frame)
            assert record.startswith(b"WARC/1.1\r\nWARC-Type: response") and len(record) == r.block_bytes
            assert record.endswith(rows[r.page_id][2].encode() + b"\r\n\r\n")
        own = sum(len(zstandard.ZstdCompressor(level=W.LEVEL).compress(plain.decompress(data[r.offset:r.offset + r.length])))
                  for r in index.where(index.file == path).collect())
        with_dictionary += len(data) < own
    assert with_dictionary >= 1


def test_damage_is_found(spark, tmp_path):
    index = written(spark, [(1, "u", "some text")], tmp_path / "w")
    path = index.first().file.removeprefix("file:")
    data = bytearray(open(path, "rb").read())
    data[-12] ^= 255
    open(path, "wb").write(bytes(data))
    with pytest.raises(Exception):
        W.read_archives(index).collect()


def test_empty_table(spark, tmp_path):
    index = written(spark, [], tmp_path / "w")
    assert index.count() == 0 and read(index) == []


def test_hot_payload_is_dealt(spark):
    rows = [(i, "u", "copy" if i % 3 == 0 else f"text {i}") for i in range(3000)]
    options = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in options}
    try:
        for k, v in options.items():
            spark.conf.set(k, v)
        out = W.with_record_types(table(spark, rows)).withColumn("part", F.spark_partition_id()).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    got = {r.page_id: (r.record_type, r.refers_to) for r in out}
    assert all(got[i] == (("response", None) if i == 0 or i % 3 else ("revisit", 0)) for i in range(3000))
    copies = Counter(r.part for r in out if r.page_id % 3 == 0)
    assert len(copies) == 8 and max(copies.values()) < 300
