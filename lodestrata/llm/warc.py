"""Web archives (WARC 1.1) with dictionary-compressed records.

An archive begins with a skippable Zstandard frame that holds a dictionary built from the archive's own records; each record
is a frame of its own, compressed with it. Any record can be read with the dictionary and its frame alone.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import urllib.parse
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.common import file_system, partitions, stored
from lodestrata.session import scratch_folder

#: Fixed values of the formats.
SKIPPABLE = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE = "urn:x-page:"
DATE = "2024-01-01T00:00:00Z"

#: An archive is closed at so many bytes of records; its dictionary is built from evenly spaced whole records of about
#: `SAMPLE_BYTES` together.
ARCHIVE_BYTES = 32 << 20
SAMPLE_BYTES = 2 << 20
DICTIONARY_BYTES = 32 << 10
LEVEL = 3
FILES = "path string, records long"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """A response with its payload, or a revisit with the head of the answer alone, which names the payload's length."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if not revisit:
        block += payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<{PAGE}{'' if page_id is None else page_id}>"),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        fields.insert(3, ("WARC-Target-URI", urllib.parse.quote(url, safe="!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")))
    if revisit:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{PAGE}{refers_to}>")]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict:
    """A dictionary from evenly spaced records; from the bytes of the records where they are too few to train on."""
    step = max(1, sum(map(len, records)) // SAMPLE_BYTES)
    sample = records[::step]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sample, k=256, d=8)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(sample)[:DICTIONARY_BYTES], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def write_archive(folder: str, records: list[bytes]) -> str:
    """Writes one archive under a name that no other attempt uses; returns its path."""
    name = f"pages-{uuid.uuid4().hex}.warc.zst"
    known = dictionary(records)
    known.precompute_compress(level=LEVEL)
    packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_checksum=True)
    fs, base = file_system(folder)
    with fs.open_output_stream(f"{base}/{name}") as out:
        raw = known.as_bytes()
        out.write(struct.pack("<II", SKIPPABLE, len(raw)) + raw)
        for r in records:
            out.write(packer.compress(r))
    return f"{folder}/{name}"


def records_of(stream: BinaryIO) -> Iterator[bytes]:
    """The records of an archive, one frame after another."""
    mark, size = struct.unpack("<II", stream.read(8))
    if mark != SKIPPABLE:
        raise ValueError("the archive does not begin with its dictionary")
    unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(stream.read(size)))
    waiting = stream.read(1 << 16)
    while waiting:
        frame, parts = unpacker.decompressobj(), []
        while not frame.eof:
            if not waiting:
                raise ValueError("the archive ends within a record")
            parts.append(frame.decompress(waiting))
            waiting = frame.unused_data if frame.eof else stream.read(1 << 16)
        waiting = waiting or stream.read(1 << 16)
        yield b"".join(parts)


def parse(raw: bytes) -> dict:
    """The fields of a record, with its payload (None for a revisit) and the payload's length and digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if first != "WARC/1.1":
        raise ValueError(f"not a record: {first[:20]}")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    answer, _, payload = block.partition(b"\r\n\r\n")
    told = int(dict(x.split(": ", 1) for x in answer.decode().split("\r\n")[1:])["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != told or payload_digest(payload) != digest):
        raise ValueError(f"{fields['WARC-Record-ID']} does not hold the payload that it names")

    def page(urn: str | None) -> int | None:
        number = (urn or "").removeprefix(f"<{PAGE}").removesuffix(">")
        return int(number) if number else None

    return {
        "page_id": page(fields["WARC-Record-ID"]),
        "url": fields.get("WARC-Target-URI"),
        "payload_bytes": told,
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": page(fields.get("WARC-Refers-To")),
        "payload": None if revisit else payload,
    }


def write_archives(pages: DataFrame, folder: str, least: int = 0) -> DataFrame:
    """Archives of all `pages` (page_id, url, html) in `folder`; returns the stored list of files.

    A null html is an empty payload. Of pages whose equal payloads have at least `least` bytes, the one with the largest
    page_id is a response and the others revisit it; pages without id come before all others, and rows that repeat the
    largest id are all responses. Without any row there is no file. The folder is one that all executors share.
    """
    fs, base = file_system(folder)
    fs.create_dir(base)
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "utf-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    keyed = rows.withColumn("digest", F.sha2("payload", 256))
    last = keyed.groupBy("digest").agg(F.max("page_id").alias("last")).withColumnRenamed("digest", "_digest")
    revisit = F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last")) & (F.octet_length("payload") >= least)
    joined = keyed.join(last, F.col("digest") == F.col("_digest")).select(
        "page_id", "url", "payload", F.when(revisit, F.col("last")).alias("refers_to"), revisit.alias("revisit")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[bytes] = []
        size = 0
        done: list[tuple[str, int]] = []

        def flush() -> None:
            if waiting:
                done.append((write_archive(folder, waiting), len(waiting)))
                waiting.clear()

        for batch in batches:
            columns = [batch.column(i).to_pylist() if i != 2 else batch.column(i).to_numpy(zero_copy_only=False).tolist() for i in range(5)]
            for row in zip(*columns):
                waiting.append(record(*row))
                size += len(waiting[-1])
                if size >= ARCHIVE_BYTES:
                    flush()
                    size = 0
        flush()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), (pa.string(), pa.int64()))], names=["path", "records"])

    return stored(joined.mapInArrow(write, FILES), f"{folder.rstrip('/')}/files")


KINDS = {
    "page_id": ("long", pa.int64()),
    "url": ("string", pa.string()),
    "payload_bytes": ("long", pa.int64()),
    "payload_digest": ("string", pa.string()),
    "record_type": ("string", pa.string()),
    "refers_to": ("long", pa.int64()),
    "payload": ("binary", pa.binary()),
}


def read_archives(files: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Every record of the listed archives: the chosen columns of `KINDS`, all by default."""
    chosen = columns or list(KINDS)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, at = file_system(path)
                with fs.open_input_stream(at) as stream:
                    rows: list[dict] = []
                    size = 0
                    for raw in records_of(stream):
                        rows.append(parse(raw))
                        size += len(raw)
                        if size >= 8 << 20:
                            yield _rows(rows, chosen)
                            rows, size = [], 0
                    yield _rows(rows, chosen)

    listed = files.select("path").repartition(partitions(files.sparkSession))
    return listed.mapInArrow(read, ", ".join(f"{c} {KINDS[c][0]}" for c in chosen))


def _rows(rows: list[dict], columns: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], KINDS[c][1]) for c in columns], names=columns)


def round_trip(pages: DataFrame, columns: list[str]) -> DataFrame:
    """Writes archives in a fresh shared folder and reads them back."""
    return read_archives(write_archives(pages, scratch_folder(pages.sparkSession)), columns)
