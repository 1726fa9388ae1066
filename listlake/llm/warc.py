"""WARC archives as seekable Zstandard bundles.

A bundle ``n.warc.zst`` holds WARC 1.1 records, grouped into independent Zstandard frames of about
``FRAME`` bytes of text (a larger record has a frame of its own). Its last frame is a skippable one with
the seek table of the seekable format: compressed and decompressed size of each frame, their number, a
descriptor byte and the magic number. ``n.index`` maps each record's identifier to its frame, and to
offset and length within the decompressed frame: entries of fixed width in the order of identifiers, so that one
record costs a binary search of short reads and one read of a frame. A bundle is named by its task and attempt;
the list of bundles names the attempts that ended, so a repeated task never mixes two attempts' files.
"""

from __future__ import annotations

import base64
import contextlib
import hashlib
import itertools
import struct
import uuid
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listlake.llm.common import fresh_path, slices
from listlake.llm.token_store import opened, put

FRAME = 256 << 10
LEVEL = 3
SHORTEST = 1000
DATE = "2024-01-01T00:00:00Z"

# Fixed values of the formats.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
#: An entry of the index: whether the page has a key, the key, frame, offset and length.
ENTRY = "<BqIQQ"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(page: int | None) -> str:
    return f"<urn:x-page:{'' if page is None else page}>"


def page_of(identifier: str) -> int | None:
    number = identifier.strip("<>").rpartition(":")[2]
    return int(number) if number else None


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers: int | None, revisit: bool, date: str) -> bytes:
    """One record. A revisit keeps the response's headers, with the length of the payload it stands for."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page)}", f"WARC-Date: {date}"]
    if url:
        head.append("WARC-Target-URI: " + "".join(c if c > " " else f"%{ord(c):02X}" for c in url))
    head.append(f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}")
    if revisit:
        head += [f"WARC-Refers-To: {record_id(refers)}", f"WARC-Profile: {REVISIT}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and end of the record at ``at``."""
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record at {at}")
    headers = dict(x.split(": ", 1) for x in lines[1:])
    start = end + 4
    stop = start + int(headers["Content-Length"])
    return headers, data[start:stop], stop + 4


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    body = b"".join(struct.pack("<II", *s) for s in sizes) + struct.pack("<IBI", len(sizes), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


class Bundle:
    """A bundle opened for reading."""

    def __init__(self, files: pafs.FileSystem, path: str):
        self.files, self.path = files, path
        size = files.get_file_info(f"{path}.warc.zst").size
        with files.open_input_file(f"{path}.warc.zst") as f:
            count, _, magic = struct.unpack("<IBI", f.read_at(9, size - 9))
            if magic != SEEKABLE:
                raise ValueError(f"{path}.warc.zst has no seek table")
            table = f.read_at(8 * count, size - 9 - 8 * count)
        self.frames, at = [], 0
        for packed, _ in struct.iter_unpack("<II", table):
            self.frames.append((at, packed))
            at += packed

    def frame(self, number: int) -> bytes:
        at, packed = self.frames[number]
        with self.files.open_input_file(f"{self.path}.warc.zst") as f:
            return zstandard.ZstdDecompressor().decompress(f.read_at(packed, at))

    def records(self) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
        """Frame, offset, headers and block of all records, each found through the index, in their order."""
        with self.files.open_input_file(f"{self.path}.index") as f:
            entries = sorted(struct.iter_unpack(ENTRY, f.readall()), key=lambda e: e[2:])
        for number, own in itertools.groupby(entries, key=lambda e: e[2]):
            data = self.frame(number)
            for keyed, page, _, at, length in own:
                headers, block, end = parsed(data, at)
                if headers["WARC-Record-ID"] != record_id(page if keyed else None) or end != at + length:
                    raise ValueError(f"{self.path}.index and its bundle differ at {number}, {at}")
                yield number, at, headers, block

    def read(self, page: int | None) -> tuple[dict[str, str], bytes]:
        """The first record of the page, found through the index by binary search."""
        wanted = (page is not None, page or 0)
        with self.files.open_input_file(f"{self.path}.index") as f:
            size = struct.calcsize(ENTRY)
            count = f.size() // size

            def entry(n: int) -> tuple[int, ...]:
                return struct.unpack(ENTRY, f.read_at(size, n * size))

            n = bisect_left(range(count), wanted, key=lambda n: entry(n)[:2])
            if n == count or entry(n)[:2] != wanted:
                raise KeyError(page)
            _, _, number, at, _ = entry(n)
        return parsed(self.frame(number), at)[:2]


def identified(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", shortest: int = SHORTEST) -> DataFrame:
    """``id, url, html, digest, refers, revisit`` of each row.

    Of rows with equal payloads of ``shortest`` bytes or more, the one with the largest key is the
    response. Only keys and digests are grouped; a payload that many rows share is one row of the join's
    other side, so its rows can be split among tasks. Shorter payloads, of which many may be equal, have
    keys of their own in the join.
    """
    rows = pages.select(
        F.col(key).cast("long").alias("id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(html).cast("string"), F.lit("")).alias("html")
    ).withColumn("digest", F.sha1(F.col("html").cast("binary")))
    large = F.octet_length("html") >= shortest
    repeated = rows.filter(large).groupBy("digest").agg(F.max("id").alias("refers"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    # A short payload's digest is never among the repeated ones: equal digests have equal lengths.
    alone = F.concat(F.lit("-"), F.monotonically_increasing_id().cast("string"))
    met = rows.withColumn("met", F.when(large, F.col("digest")).otherwise(alone))
    joined = met.join(repeated.withColumnRenamed("digest", "met"), "met", "left")
    revisit = F.col("refers").isNotNull() & (F.col("id").isNull() | (F.col("id") < F.col("refers")))
    return joined.select("id", "url", "html", "digest", "refers", revisit.alias("revisit"))


def write_archives(
    pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html", shortest: int = SHORTEST, frame: int = FRAME, date: str = DATE
) -> DataFrame:
    """Writes a bundle for each task; ``bundle`` (its name), ``records`` and ``frames`` of each.

    A null payload is empty; a row without key has an identifier without number; rows with equal keys
    repeat the identifier. Other columns are ignored.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        files, path = opened(folder)
        with contextlib.suppress(OSError):
            files.create_dir(path, recursive=True)
        bundle = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        name = f"{path}/{bundle}"
        part, packer = f"{name}.warc.zst.part", zstandard.ZstdCompressor(level=LEVEL)
        sizes, index, held, length, count = [], [], [], 0, 0
        with files.open_output_stream(part) as out:

            def flush() -> None:
                nonlocal held, length
                if held:
                    packed = packer.compress(b"".join(held))
                    out.write(packed)
                    sizes.append((len(packed), length))
                    held, length = [], 0

            for batch in slices(batches, "html"):
                columns = (batch.column(c).to_pylist() for c in ("id", "url", "html", "digest", "refers", "revisit"))
                for page, address, text, digest, refers, revisit in zip(*columns, strict=True):
                    data = record(page, address, text.encode(), digest, refers, revisit, date)
                    if length and length + len(data) > frame:
                        flush()
                    index.append((page is not None, page or 0, len(sizes), length, len(data)))
                    held.append(data)
                    length += len(data)
                    count += 1
            flush()
            out.write(seek_table(sizes))
        if not count:
            files.delete_file(part)
            return
        put(files, f"{name}.index", [struct.pack(ENTRY, *entry) for entry in sorted(index)])
        files.move(part, f"{name}.warc.zst")
        yield pa.RecordBatch.from_pydict({"bundle": [bundle], "records": [count], "frames": [len(sizes)]})

    rows = identified(pages, key, url, html, shortest).mapInArrow(work, "bundle string, records long, frames long")
    return pages.sparkSession.createDataFrame([tuple(r) for r in rows.collect()], rows.schema)  # a row per bundle


def read_archives(spark: SparkSession, bundles: DataFrame, folder: str, key: str = "page_id") -> DataFrame:
    """``<key>, payload_bytes, payload_digest, record_type, refers_to, url, bundle, frame, place`` of every record.

    Payloads of responses are digested again and must agree with their header.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = opened(folder)
        for batch in batches:
            for number in batch.column("bundle").to_pylist():
                out = []
                for frame, at, headers, block in Bundle(files, f"{path}/{number}").records():
                    kind, (http, _, payload) = headers["WARC-Type"], block.partition(b"\r\n\r\n")
                    digest = base64.b32decode(headers["WARC-Payload-Digest"].partition(":")[2]).hex()
                    size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
                    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
                        raise ValueError(f"payload of {headers['WARC-Record-ID']} is damaged")
                    refers = page_of(headers["WARC-Refers-To"]) if "WARC-Refers-To" in headers else None
                    out.append((page_of(headers["WARC-Record-ID"]), size, digest, kind, refers, headers.get("WARC-Target-URI"), number, frame, at))
                    if len(out) == 5000:
                        yield _batch(out)
                        out = []
                if out:
                    yield _batch(out)

    listed = bundles.select("bundle").repartition(max(1, bundles.count()), "bundle")
    fields = "page long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, bundle string, frame long, place long"
    return listed.mapInArrow(work, fields).withColumnRenamed("page", key)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
    names = ["page", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "bundle", "frame", "place"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def archived(pages: DataFrame, folder: str | None = None, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Writes the archives and reads them back, see ``write_archives`` and ``read_archives``."""
    folder = folder or fresh_path(pages.sparkSession, "warc")
    return read_archives(pages.sparkSession, write_archives(pages, folder, key, url, html), folder, key)
