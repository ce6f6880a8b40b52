"""WARC archives of Zstandard frames: a dictionary in a leading skippable frame, one frame per record.

Layout of an archive: a skippable frame (magic 0x184D2A5D) that holds the dictionary, raw or as a frame
of its own, then for each record one frame with the whole record.  An archive is trained on
its own first records (``TRAIN_RECORDS`` at most); where these are too few, there is no dictionary.

Payloads are deduplicated before writing: of records with equal payloads of at least ``MIN_BYTES``
bytes, the one of the largest id is a response and the others are revisits that refer to it.
A revisit keeps the HTTP head with the payload's length, and the payload's digest.

Tasks write archives of bounded size to the shared folder under names of their own attempt and
report them; only archives of reported attempts are read, so a lost executor leaves nothing that counts.

Defined results: a null payload is empty; a null url is left out; control characters and white space in
urls are percent-encoded; a null id is kept, but nothing refers to it; rows that repeat the largest id of a group
are all responses; an empty table gives no archives and no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm.shared import new_folder, stage

MIN_BYTES = 1000
ARCHIVE_BYTES = 8 << 20
TRAIN_RECORDS, TRAIN_BYTES, DICT_BYTES = 64, 1 << 20, 16 << 10
SKIPPABLE, FRAME = 0x184D2A5D, 0xFD2FB528
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_UNSAFE = re.compile("[\x00-\x20\x7f<>]")


def planned(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """(page_id, url, payload, refers_to): what each row is written as."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url",
                        F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload")).withColumn("_sha1", F.sha1("payload"))
    copies = (
        pages.select(F.col("page_id").cast("long").alias("page_id"), F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
        .where(F.length("payload") >= min_bytes).select("page_id", F.sha1("payload").alias("_sha1"))
        .groupBy("_sha1").agg(F.max("page_id").alias("_last"), F.count("*").alias("_n")).where("_n > 1 and _last is not null"))
    last = rows.join(copies.select("_sha1", "_last"), "_sha1", "left")
    return last.select("page_id", "url", "payload",
                       F.when(F.col("page_id").isNull() | (F.col("page_id") < F.col("_last")), F.col("_last")).alias("refers_to"))


def _name(page_id: int | None) -> str:
    return f"<urn:x-page:{'none' if page_id is None else page_id}>"


def _digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record with its trailing empty lines."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", _name(page_id)), ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url)))
    fields.append(("WARC-Payload-Digest", _digest(payload)))
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _name(refers_to))]
    fields += [("WARC-Block-Digest", _digest(block)), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def archive(records: list[bytes]) -> bytes:
    """An archive of these records."""
    sample, size = [], 0
    for r in records[:TRAIN_RECORDS]:
        if size < TRAIN_BYTES:
            sample.append(r[: TRAIN_BYTES])
            size += len(r)
    try:
        trained = zstandard.train_dictionary(DICT_BYTES, sample) if len(sample) >= 8 else None
    except zstandard.ZstdError:
        trained = None
    packer = zstandard.ZstdCompressor(level=3, dict_data=trained, write_content_size=True, write_checksum=True)
    out = []
    if trained is not None:
        body = zstandard.ZstdCompressor(level=9).compress(trained.as_bytes())
        out.append(struct.pack("<II", SKIPPABLE, len(body)) + body)
    out += [packer.compress(r) for r in records]
    return b"".join(out)


def write_archives(rows: DataFrame, folder: str) -> DataFrame:
    """Write (page_id, url, payload, refers_to) as archives; returns the reported (archive, records)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt, number, held, size = uuid.uuid4().hex, 0, [], 0
        fs, base = pafs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
        fs.create_dir(base, recursive=True)

        def flush():
            nonlocal number, held, size
            name = f"{attempt}-{number}.warc.zst"
            with fs.open_output_stream(f"{base}/{name}", compression=None) as sink:
                sink.write(archive(held))
            row = pa.record_batch({"archive": pa.array([name]), "records": pa.array([len(held)], pa.int64())})
            number, held, size = number + 1, [], 0
            return row

        for batch in batches:
            for page_id, url, payload, refers_to in zip(*[batch.column(c) for c in ("page_id", "url", "payload", "refers_to")]):
                held.append(record(page_id.as_py(), url.as_py(), payload.as_py(), refers_to.as_py()))
                size += len(held[-1])
                if size >= ARCHIVE_BYTES:
                    yield flush()
        if held:
            yield flush()

    return stage(rows.mapInArrow(run, "archive string, records long"), "warc-archives")


def frames(data: memoryview) -> Iterator[bytes]:
    """The records of an archive: dictionary first, then one frame after the other."""
    at, dictionary = 0, None
    while at + 8 <= len(data) and at == 0:
        magic, size = struct.unpack_from("<II", data, at)
        if magic != SKIPPABLE:
            break
        if at + 8 + size > len(data):
            raise ValueError("the dictionary frame is cut off")
        body = bytes(data[at + 8: at + 8 + size])
        if body[:4] == struct.pack("<I", FRAME):
            body = zstandard.ZstdDecompressor().decompress(body)
        dictionary = zstandard.ZstdCompressionDict(body)
        at += 8 + size
    opener = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    while at < len(data):
        one = opener.decompressobj()
        out = [one.decompress(data[at: at + (1 << 16)])]
        fed = min(len(data), at + (1 << 16))
        while not one.eof:
            if fed >= len(data):
                raise ValueError("a frame is cut off")
            out.append(one.decompress(data[fed: fed + (1 << 16)]))
            fed = min(len(data), fed + (1 << 16))
        at = fed - len(one.unused_data)
        yield b"".join(out)


_FIELD = re.compile(rb"([!#$%&'*+\-.^_`|~0-9A-Za-z]+):[ \t]*([^\r\n]*?)[ \t]*\r\n")
_PAGE = re.compile(r"<urn:x-page:(none|-?\d+)>")


def parse(data: bytes) -> dict:
    """Headers, block and payload of one record; ValueError where it is not valid."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head + b"\r\n"
    if not gap or not lines.startswith(b"WARC/1.1\r\n"):
        raise ValueError("not a WARC record")
    fields, at = {}, len(b"WARC/1.1\r\n")
    while at < len(lines):
        m = _FIELD.match(lines, at)
        if m is None:
            raise ValueError("bad header line")
        fields[m[1].decode().lower()] = m[2].decode()
        at = m.end()
    for needed in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if needed not in fields:
            raise ValueError(f"no {needed}")
    length = int(fields["content-length"])
    if length < 0 or len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError("wrong length")
    block = rest[:length]
    if fields.get("warc-block-digest", _digest(block)) != _digest(block):
        raise ValueError("wrong block digest")
    http, gap, payload = block.partition(b"\r\n\r\n")
    if not gap:
        raise ValueError("no HTTP head")
    sizes = [int(v) for k, v in _FIELD.findall(http.partition(b"\r\n")[2] + b"\r\n") if k.lower() == b"content-length"]
    if fields["warc-type"] == "response":
        if sizes != [len(payload)] or fields["warc-payload-digest"] != _digest(payload):
            raise ValueError("wrong payload length or digest")
    elif fields["warc-type"] != "revisit" or payload or not sizes or "warc-refers-to" not in fields:
        raise ValueError("wrong record type")
    return {"fields": fields, "payload": payload, "payload_bytes": sizes[0]}


def _page(name: str | None) -> int | None:
    found = _PAGE.fullmatch(name or "")
    return int(found[1]) if found and found[1] != "none" else None


def read_archives(spark: SparkSession, folder: str, reported: DataFrame, payloads: bool = True) -> DataFrame:
    """(page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload) of all reported archives.

    ``payload`` is null for revisits, and everywhere unless ``payloads``.
    """
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, expected in zip(batch.column("content"), batch.column("records").to_pylist()):
                rows = []
                for data in frames(memoryview(content.as_buffer())):
                    got = parse(data)
                    f = got["fields"]
                    digest = base64.b32decode(f["warc-payload-digest"].removeprefix("sha1:")).hex()
                    rows.append((_page(f["warc-record-id"]), f.get("warc-target-uri"), f["warc-type"], _page(f.get("warc-refers-to")),
                                 got["payload_bytes"], digest, got["payload"] if payloads and f["warc-type"] == "response" else None))
                if len(rows) != expected:
                    raise ValueError(f"{len(rows)} records where {expected} were written")
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], x.type) for k, x in enumerate(schema)], schema=schema)

    if reported.isEmpty():
        return spark.createDataFrame([], "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder).select(
        F.regexp_extract("path", "[^/]+$", 0).alias("archive"), "content")
    return files.join(reported, "archive").mapInArrow(
        run, "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary")


def roundtrip(pages: DataFrame, payloads: bool = False) -> DataFrame:
    """Write pages (page_id, url, html) to archives in the shared folder and read them back."""
    spark = pages.sparkSession
    folder = new_folder(spark, "warc")
    return read_archives(spark, folder, write_archives(planned(pages), folder), payloads)
