"""Zstandard WARC archives: writing and reading.

An archive is a ``.warc.zst`` file: a leading skippable frame that holds the dictionary, then one
Zstandard frame per record, each compressed with that dictionary. Here every record is followed by
an empty skippable frame, which readers pass over.

Writing is distributed: each partition makes one archive, trains its dictionary on a bounded
sample of its first payloads and hands the frames to Spark's text sink, which commits files
safely on any store Spark can write to. The sink ends every row with a separator; the separator
used is the empty skippable frame. Partition sizes, hence archive sizes, follow the session's
advisory partition size. Reading takes each archive as one row and decodes it frame by frame.

The reader checks the magic numbers, the dictionary frame, one record a frame, the declared
content sizes, the record and HTTP headers, ``Content-Length`` and the SHA-1 digests of block and
payload, and raises ``ValueError`` on any fault; it never skips a record.

Payloads of at least ``least_bytes`` that are equal are stored once: the page with the largest id
is a response, the others are revisits that refer to it and carry the HTTP headers only, with the
length and digest of the full payload. Equal pages with that same id are all responses.

Nulls: a null payload is empty; a null id gets a record id of its own and is read back as null, it
is never chosen as response over one with an id, and equal payloads that all lack an id are all
responses; a null url is left out of the headers. Repeated rows give repeated records; other
columns are ignored; an empty table gives no archive and an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

DICTIONARY_MAGIC = 0x184D2A5D
PADDING = "P*M\x18\x00\x00\x00\x00"  # an empty skippable frame
FRAME_MAGIC = 0xFD2FB528
TRAINED_MAGIC = 0xEC30A437
#: The dictionary is trained on so many bytes of the archive's first payloads at most.
SAMPLE_BYTES = 1 << 20
DICTIONARY_BYTES = 16 << 10
LEVEL = 3
_DATE = "2024-01-01T00:00:00Z"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(data: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None) -> str:
    """A UUID of the custom version 8 that spells the page id; all ones beyond it for a null id."""
    low = "0" if page_id is not None else "f"
    h = f"{(page_id or 0) & 0xFFFFFFFFFFFFFFFF:016x}"
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-8{low * 3}-8{low * 3}-{low * 8}{h[12:]}>"


def page_of(name: str) -> int | None:
    h = name.removeprefix("<urn:uuid:").removesuffix(">").replace("-", "")
    if len(h) != 32 or h[12] != "8" or h[16] != "8":
        raise ValueError(f"record id {name!r}")
    if h[13] == "f":
        return None
    return struct.unpack(">q", bytes.fromhex(h[:12] + h[28:]))[0]


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A WARC/1.1 response, or a revisit if ``refers_to`` is given."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}",
            f"WARC-Date: {_DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c if c > " " else f"%{ord(c):02X}" for c in url))
    if revisit:
        head += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {_REVISIT}"]
    head += [f"WARC-Payload-Digest: sha1:{digest(payload)}", f"WARC-Block-Digest: sha1:{digest(block)}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def dictionary_frame(samples: list[bytes]) -> tuple[bytes, zstandard.ZstdCompressionDict]:
    """The skippable frame and the dictionary; raw content where there is too little to train on."""
    size = min(DICTIONARY_BYTES, sum(map(len, samples)) // 8)
    try:
        made = zstandard.train_dictionary(size, samples) if size >= 512 else None
    except zstandard.ZstdError:  # too few or too uniform samples
        made = None
    made = made or zstandard.ZstdCompressionDict(b"WARC/1.1\r\nWARC-Type: response\r\nHTTP/1.1 200 OK\r\n")
    data = made.as_bytes()
    return struct.pack("<II", DICTIONARY_MAGIC, len(data)) + data, made


def with_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, refers_to) of pages (page_id, url, html)."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("name", F.unhex(F.sha1("payload")))
    names = rows.select("name", "page_id", F.octet_length("payload").alias("size"))
    # a payload's copies count map-side, so a common one sends one row a task
    copied = (names.where(F.col("size") >= least_bytes).groupBy("name")
              .agg(F.max("page_id").alias("kept"), F.count("*").alias("n")).where("n > 1 and kept is not null").drop("n"))
    out = rows.join(copied, "name", "left")
    to = F.when(F.col("page_id").eqNullSafe(F.col("kept")), None).otherwise(F.col("kept"))
    return out.select("page_id", "url", "payload", to.alias("refers_to"))


def _frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    packer = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        payloads = batch.column("payload")
        out = []
        if packer is None:
            samples, left = [], SAMPLE_BYTES
            for x in payloads:
                if left <= 0:
                    break
                samples.append(x.as_buffer()[:left].to_pybytes())
                left -= len(samples[-1])
            head, known = dictionary_frame([x for x in samples if x])
            out.append(head)
            packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_checksum=True, write_content_size=True)
        for page, url, payload, to in zip(batch.column("page_id").to_pylist(), batch.column("url").to_pylist(), payloads,
                                          batch.column("refers_to").to_pylist()):
            out.append(packer.compress(record(page, url, payload.as_py(), to)))
            if len(out) >= 256:
                yield pa.RecordBatch.from_pydict({"frame": pa.array(out, pa.binary())})
                out = []
        yield pa.RecordBatch.from_pydict({"frame": pa.array(out, pa.binary())})


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0) -> None:
    """Writes pages (page_id, url, html) as archives into ``folder``, one a partition."""
    frames = with_revisits(pages, least_bytes).mapInArrow(_frames, "frame binary")
    frames.select(F.col("frame").cast("string")).write.option("lineSep", PADDING).mode("errorifexists").text(folder)


def _headers(data: bytes, what: str) -> tuple[str, dict[str, str], int]:
    end = data.find(b"\r\n\r\n")
    if end < 0:
        raise ValueError(f"{what}: headers do not end")
    first, *lines = data[:end].decode("utf-8").split("\r\n")
    out: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon or not name.strip() or name.lower() in out:
            raise ValueError(f"{what}: header line {line!r}")
        out[name.lower()] = value.strip()
    return first, out, end + 4


def _length(headers: dict[str, str], what: str) -> int:
    value = headers.get("content-length", "")
    if not value.isascii() or not value.isdigit():
        raise ValueError(f"{what}: Content-Length {value!r}")
    return int(value)


def _same(headers: dict[str, str], name: str, data: bytes, what: str) -> None:
    if headers.get(name) != f"sha1:{digest(data)}":
        raise ValueError(f"{what}: {name} is {headers.get(name)!r}")


def parse(data: bytes, what: str = "record") -> dict:
    """The checked fields of one record."""
    first, head, at = _headers(data, what)
    if first not in ("WARC/1.0", "WARC/1.1"):
        raise ValueError(f"{what}: version {first!r}")
    missing = {"warc-type", "warc-record-id", "warc-date", "content-length"} - head.keys()
    if missing:
        raise ValueError(f"{what}: no {', '.join(sorted(missing))}")
    kind, size = head["warc-type"], _length(head, what)
    if len(data) != at + size + 4 or data[at + size:] != b"\r\n\r\n":
        raise ValueError(f"{what}: block of {len(data) - at - 4} bytes, Content-Length {size}")
    block = data[at:at + size]
    _same(head, "warc-block-digest", block, what)
    if kind not in ("response", "revisit"):
        return {"record_type": kind, "page_id": None, "url": None, "payload": block, "payload_bytes": size,
                "payload_digest": digest(block), "refers_to": None}
    status, http, begin = _headers(block, what)
    if not status.startswith("HTTP/"):
        raise ValueError(f"{what}: status line {status!r}")
    whole, payload = _length(http, what), block[begin:]
    named = head.get("warc-payload-digest", "")
    if not named.startswith("sha1:") or len(named) != 37:
        raise ValueError(f"{what}: payload digest {named!r}")
    if kind == "response":
        if len(payload) != whole:
            raise ValueError(f"{what}: payload of {len(payload)} bytes, Content-Length {whole}")
        _same(head, "warc-payload-digest", payload, what)
    elif payload or "warc-refers-to" not in head:
        raise ValueError(f"{what}: revisit with a payload or without WARC-Refers-To")
    return {"record_type": kind, "page_id": page_of(head["warc-record-id"]), "url": head.get("warc-target-uri"),
            "payload": payload if kind == "response" else None, "payload_bytes": whole, "payload_digest": named[5:],
            "refers_to": page_of(head["warc-refers-to"]) if kind == "revisit" else None}


def frame_end(content: memoryview, at: int, what: str) -> int:
    """Where the Zstandard frame that begins at ``at`` ends, by its block headers."""
    try:
        flags = content[at + 4]
        single = flags >> 5 & 1
        at += 5 + (1 - single) + (0, 1, 2, 4)[flags & 3] + (single, 2, 4, 8)[flags >> 6]
        last = False
        while not last:
            head = content[at] | content[at + 1] << 8 | content[at + 2] << 16
            last = bool(head & 1)
            at += 3 + (1 if head >> 1 & 3 == 1 else head >> 3)
        at += 4 * (flags >> 2 & 1)
    except IndexError:
        at = len(content) + 1
    if at > len(content):
        raise ValueError(f"{what}: frame is cut off")
    return at


def read_archive(content: memoryview, name: str = "archive") -> Iterator[dict]:
    """The records of one archive, in order."""
    content, at, n, packer = content.cast("B"), 0, 0, None
    while at < len(content):
        if len(content) - at < 8:
            raise ValueError(f"{name}: cut off at byte {at}")
        magic, size = struct.unpack_from("<II", content, at)
        if magic == DICTIONARY_MAGIC and at == 0 or magic & ~0xF == 0x184D2A50:
            if at + 8 + size > len(content):
                raise ValueError(f"{name}: skippable frame at byte {at} is cut off")
            if at == 0 and magic == DICTIONARY_MAGIC:
                data = bytes(content[8:8 + size])
                if data[:4] == struct.pack("<I", FRAME_MAGIC):  # the dictionary may itself be compressed
                    data = zstandard.ZstdDecompressor().decompressobj().decompress(data)
                trained = data[:4] == struct.pack("<I", TRAINED_MAGIC)
                kind = zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT
                packer = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data, dict_type=kind))
            at += 8 + size
            continue
        if magic != FRAME_MAGIC:
            raise ValueError(f"{name}: no frame at byte {at}")
        packer = packer or zstandard.ZstdDecompressor()
        what = f"{name}, record {n}"
        end = frame_end(content, at, what)
        declared = zstandard.frame_content_size(content[at:at + 18])
        try:
            data = packer.decompressobj().decompress(content[at:end])
        except zstandard.ZstdError as fault:
            raise ValueError(f"{what}: {fault}") from fault
        if declared >= 0 and declared != len(data):
            raise ValueError(f"{what}: {len(data)} bytes, frame declares {declared}")
        yield parse(data, what)
        at = end
        n += 1


def read_archives(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """(page_id, url, record_type, payload_bytes, payload_digest, refers_to[, payload]) of the
    records of all archives in ``folder``; revisits have a null payload."""
    columns = {"page_id": pa.int64(), "url": pa.string(), "record_type": pa.string(), "payload_bytes": pa.int64(),
               "payload_digest": pa.string(), "refers_to": pa.int64()} | ({"payload": pa.binary()} if payloads else {})

    def decode(batches):
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                rows, size = [], 0
                for r in read_archive(memoryview(content.as_buffer()), path.as_py()):
                    rows.append(r)
                    size += len(r["payload"] or b"") if payloads else 64
                    if size > 4 << 20:
                        yield to_batch(rows)
                        rows, size = [], 0
                yield to_batch(rows)

    def to_batch(rows):
        return pa.RecordBatch.from_pydict({c: pa.array([r[c] for r in rows], kind) for c, kind in columns.items()})

    schema = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long"
    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    return files.mapInArrow(decode, schema + (", payload binary" if payloads else ""))
