"""WARC archives compressed with a dictionary of their own (operator 13).

Pages become WARC/1.1 records: a ``response`` with the payload, or a ``revisit``
that names the response with the same payload.  Of pages with equal payloads of
at least ``min_bytes`` bytes the one with the smallest page_id is the response.
That choice is one aggregate by (payload sha256, salt), a second one over the
salts, and a join back on both, so a payload that a third of the pages share is
dealt over ``SALTS`` parts.

Each task cuts its rows into archives of about ``ARCHIVE_BYTES``.  An archive
is a ``.warc.zst`` file: a Zstandard dictionary is trained on the archive's
own records (evenly spaced ones, at most ``SAMPLE_BYTES`` of them: the bound of
the training sample), it stands in a leading skippable frame, and every record
follows as a frame of its own, so a reader needs the file alone and can begin at any record.
An archive too small to train on has no dictionary frame.

A file's name holds its task and a random part; the index, written by Spark as
Parquet beside the files, names the files of the tasks that were committed and the
place of each record.  A lost or repeated task leaves at most a file that the
index does not name.  Files are written through ``pyarrow.fs``, so the folder
must be one that all executors share (local or mounted path, hdfs, s3, gs, abfs).

Reading goes through whole archives in tasks, one record at a time, and checks
every payload against its digest; :func:`read_records` fetches single records
by the index.  A task holds one archive's records, or the largest record.

Edge cases: a null html is an empty payload; a null page_id counts as larger than any other:
such a page refers to a response with an id if its payload has one, else it is
a response and nothing refers to it; repeated rows of a payload's smallest
page_id are all responses; a null url leaves out the target field; white space,
control and non-ASCII characters of a url are percent-encoded; a long text is
one record of its size; an empty table makes no archive and an empty result;
other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import io
import os
import struct
from collections.abc import Iterator
from datetime import datetime, timezone
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchmart.session import scratch_dir

SALTS = 64
ARCHIVE_BYTES = 32 << 20
DICTIONARY_BYTES = 64 << 10
SAMPLE_BYTES = 4 << 20
SAMPLE_PART = 64 << 10
LEVEL = 3
_LEAST_SAMPLES = 16
# The skippable frame that holds a dictionary, and the magic numbers inside it.
DICTIONARY_FRAME = 0x184D2A5D
ZSTD_FRAME = 0xFD2FB528
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_INDEX = ("page_id long, record_type string, refers_to long, payload_digest string, file string, offset long, "
          "length long, block_bytes long")
_READ = ("page_id long, target_uri string, record_type string, refers_to long, payload_bytes long, "
         "payload_digest string, payload binary")
_OUT_ROWS, _OUT_BYTES = 5000, 16 << 20


def with_record_types(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``page_id``, ``url``, ``payload``, ``record_type`` and ``refers_to`` of every row of ``pages``."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url",
                        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("same", F.sha2("payload", 256)).withColumn(
        "salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)))
    parts = rows.where(F.octet_length("payload") >= min_bytes).groupBy("same", "salt").agg(F.min("page_id").alias("least"))
    first = parts.groupBy("same").agg(F.min("least").alias("response"))
    # At most SALTS rows a payload meet in this join; the pages themselves meet by payload and salt.
    chosen = parts.select("same", "salt").join(first, "same")
    revisit = F.col("response").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response"))
    return rows.join(chosen, ["same", "salt"], "left").select(
        "page_id", "url", "payload", F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("response")).alias("refers_to"))


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _uri(url: str) -> str:
    return quote(url, safe="".join(chr(i) for i in range(33, 127)))


def _head(fields: list[tuple[str, str]]) -> bytes:
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode()


def _record_id(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def _page_of(record_id: str) -> int | None:
    number = record_id[len("<urn:x-page:"):-1]
    return int(number) if number else None


def page_record(page_id: int | None, url: str | None, payload: bytes, record_type: str, refers_to: int | None,
                date: str) -> tuple[bytes, str]:
    """A record's bytes and its payload digest."""
    digest = sha1_base32(payload)
    block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
             ).encode()
    fields = [("WARC-Type", record_type), ("WARC-Record-ID", _record_id(page_id)), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", _uri(url)))
    if record_type == "revisit":
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(refers_to))]
    else:
        block += payload
    fields += [("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"),
               ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    return _head(fields) + block + b"\r\n\r\n", digest


def _info_record(name: str, date: str) -> bytes:
    block = b"software: matchmart\r\nformat: WARC File Format 1.1\r\n"
    return _head([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:x-archive:{name}>"), ("WARC-Date", date),
                  ("WARC-Filename", name), ("Content-Type", "application/warc-fields"),
                  ("Content-Length", str(len(block)))]) + block + b"\r\n\r\n"


def build_dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A dictionary of evenly spaced records; None when there is too little to learn from."""
    total, taken, samples = sum(map(len, records)), 0.0, []
    share = min(1.0, SAMPLE_BYTES / max(total, 1))
    for record in records:
        before, taken = taken, taken + share * len(record)
        # A record is taken when its share of the bytes passes the next whole sample part.
        if share == 1.0 or int(taken / SAMPLE_PART) > int(before / SAMPLE_PART):
            samples += [record[a:a + SAMPLE_PART] for a in range(0, min(len(record), 4 * SAMPLE_PART), SAMPLE_PART)]
    if len(samples) < _LEAST_SAMPLES:
        return None
    size = min(DICTIONARY_BYTES, sum(map(len, samples)) // 8)
    try:
        return zstandard.train_dictionary(size, samples, k=512, d=8, level=LEVEL)
    except zstandard.ZstdError:  # nothing repeats in them
        return None


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[len("file:"):].lstrip("/")
    if "://" not in path:
        return pafs.LocalFileSystem(), path
    scheme, rest = path.split("://", 1)
    return pafs.FileSystem.from_uri({"s3a": "s3", "s3n": "s3"}.get(scheme, scheme) + "://" + rest)


def _write_archive(folder: str, rows: list[tuple], date: str) -> list[tuple]:
    """One archive of ``rows`` (page_id, record_type, refers_to, digest, record); their index rows."""
    name = f"pages-{TaskContext.get().partitionId():06d}-{os.urandom(8).hex()}.warc.zst"
    dictionary = build_dictionary([r[4] for r in rows])
    packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_checksum=True, write_content_size=True)
    system, base = _open(folder)
    system.create_dir(base, recursive=True)
    index = []
    with system.open_output_stream(f"{base}/{name}", compression=None) as out:
        at = 0
        if dictionary is not None:
            body = zstandard.ZstdCompressor(level=19).compress(dictionary.as_bytes())
            at += out.write(struct.pack("<II", DICTIONARY_FRAME, len(body)) + body)
        at += out.write(packer.compress(_info_record(name, date)))
        for page_id, record_type, refers_to, digest, record in rows:
            frame = packer.compress(record)
            out.write(frame)
            index.append((page_id, record_type, refers_to, digest, f"{folder}/{name}", at, len(frame), len(record)))
            at += len(frame)
    return index


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[kind]) for i, (_, kind) in enumerate(fields)],
                                      names=[name for name, _ in fields])


def write_archives(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the records of :func:`with_record_types` as archives below ``folder``; the index of the records.

    The index is written to ``folder``/index first and read back, so the archives are written once.
    """
    date = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "payload", "record_type", "refers_to")]
            for i in range(batch.num_rows):
                page_id, url, payload, record_type, refers_to = (c[i].as_py() for c in columns)
                record, digest = page_record(page_id, url, payload, record_type, refers_to, date)
                held.append((page_id, record_type, refers_to, digest, record))
                size += len(record)
                if size >= archive_bytes:
                    yield _batch(_write_archive(folder, held, date), _INDEX)
                    held, size = [], 0
        if held:
            yield _batch(_write_archive(folder, held, date), _INDEX)

    records.mapInArrow(run, _INDEX).write.parquet(f"{folder}/index")
    return records.sparkSession.read.parquet(f"{folder}/index")


def _dictionary_of(stream) -> zstandard.ZstdCompressionDict | None:
    """The dictionary of an archive; the stream then stands at the first record."""
    head = stream.read(8)
    if len(head) < 8 or struct.unpack("<I", head[:4])[0] != DICTIONARY_FRAME:
        stream.seek(0)
        return None
    body = stream.read(struct.unpack("<I", head[4:])[0])
    if struct.unpack("<I", body[:4])[0] == ZSTD_FRAME:
        body = zstandard.ZstdDecompressor().decompress(body)
    return zstandard.ZstdCompressionDict(body)


def _fields(lines: Iterator[bytes]) -> dict[str, str]:
    out = {}
    for line in lines:
        if line in (b"\r\n", b""):
            break
        name, _, value = line.decode().partition(":")
        out[name.strip().lower()] = value.strip()
    return out


def _records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Fields and block of each record of a decompressed stream."""
    while version := stream.readline():
        if not version.startswith(b"WARC/"):
            raise ValueError(f"no WARC record begins with {version[:40]!r}")
        fields = _fields(iter(stream.readline, b""))
        size = int(fields["content-length"])
        block = stream.read(size)
        if len(block) != size or stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"record {fields.get('warc-record-id')} is cut off")
        yield fields, block


def _page_row(fields: dict[str, str], block: bytes, payloads: bool) -> tuple | None:
    kind = fields["warc-type"]
    if kind not in ("response", "revisit"):
        return None
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    head, _, payload = block.partition(b"\r\n\r\n")
    http = _fields(iter(head.split(b"\r\n")[1:]))
    size = int(http["content-length"])
    if kind == "response" and (len(payload) != size or sha1_base32(payload) != digest):
        raise ValueError(f"payload of record {fields['warc-record-id']} does not match its digest")
    refers_to = _page_of(fields["warc-refers-to"]) if kind == "revisit" else None
    return (_page_of(fields["warc-record-id"]), fields.get("warc-target-uri"), kind, refers_to, size, digest,
            payload if payloads and kind == "response" else None)


def read_archive(path: str, payloads: bool = True) -> Iterator[tuple]:
    """The page rows of one archive, record after record, with nothing but the file."""
    system, name = _open(path)
    with system.open_input_file(name) as stream:
        unpacker = zstandard.ZstdDecompressor(dict_data=_dictionary_of(stream))
        with unpacker.stream_reader(stream, read_across_frames=True, closefd=False) as plain:
            for fields, block in _records(io.BufferedReader(plain, 1 << 20)):
                row = _page_row(fields, block, payloads)
                if row is not None:
                    yield row


def _row_batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[6] or b"")
        if len(held) >= _OUT_ROWS or size >= _OUT_BYTES:
            yield _batch(held, _READ)
            held, size = [], 0
    if held:
        yield _batch(held, _READ)


def read_archives(index: DataFrame, payloads: bool = True) -> DataFrame:
    """Every page record of the index's archives, read from the archives themselves."""
    files = index.select("file").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("file").to_pylist():
                yield from _row_batches(read_archive(path, payloads))

    # One archive a task: their number is that of the index's files.
    return files.repartition(max(1, files.count())).mapInArrow(run, _READ)


def read_records(index: DataFrame) -> DataFrame:
    """The records that the index rows name, each read at its own place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                places = zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length", "block_bytes")))
                at, stream, unpacker = None, None, None
                for path, offset, length, size in sorted(places):
                    if path != at:
                        system, name = _open(path)
                        at, stream = path, system.open_input_file(name)
                        unpacker = zstandard.ZstdDecompressor(dict_data=_dictionary_of(stream))
                    stream.seek(offset)
                    record = unpacker.decompress(stream.read(length), max_output_size=size)
                    yield from (_page_row(*r, True) for r in _records(io.BytesIO(record)))
        yield from _row_batches(rows())

    return index.select("file", "offset", "length", "block_bytes").mapInArrow(run, _READ)


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as WARC records, written to archives and read back from them."""
    records = with_record_types(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    index = write_archives(records, scratch_dir(spark, "warc"))
    return read_archives(index, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_BITS = "'0000000100100011010001010110011110001001101010111100110111101111'"
OP13_SQL = f"""
WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
digests AS (SELECT page_id, payload, octet_length(encode(payload)) AS payload_bytes, array_to_string(list_transform(
    range(1, 41), lambda i: substr({_BITS}, 4 * (strpos('0123456789abcdef', substr(sha1(payload), i, 1)) - 1) + 1, 4)),
    '') AS bits, min(page_id) OVER (PARTITION BY payload) AS response FROM payloads)
SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda i: substr(
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_sum(list_transform(range(1, 6),
        lambda j: substr(bits, (5 * i + j)::BIGINT, 1)::INTEGER * (1 << (5 - j)::INTEGER)))::BIGINT, 1)), '')
    AS payload_digest,
    CASE WHEN response IS NULL OR page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id IS DISTINCT FROM response THEN response END AS refers_to
FROM digests
"""
