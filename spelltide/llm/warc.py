"""WARC archives compressed with Zstandard: one frame per record, the dictionary in a leading skippable frame."""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spelltide.llm.scratch import stored
from spelltide.sources.scratch import file_system, hadoop_path, scratch_path

# Magic numbers of the Zstandard and WARC-zstd formats.
DICTIONARY_MAGIC = b"\x5d\x2a\x4d\x18"
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
# An empty skippable frame. It ends each archive because Spark's text writer wants a line end.
EMPTY_FRAME = "P*M\x18\x00\x00\x00\x00"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ARCHIVE_BYTES = 16 << 20
DICTIONARY_BYTES = 64 << 10
SAMPLE_RECORDS = 200
SAMPLE_BYTES = 8 << 10
# A frame is decoded in steps, so that little of the next one has to be given back.
STEP_BYTES = 8 << 10

RECORDS = (
    "archive string, offset long, record_id string, page_id long, url string, record_type string, refers_to long, "
    "payload_bytes long, payload_digest string, payload binary, error string"
)


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id, url, payload_digest: str) -> str:
    """A stable id, so that a task that runs again writes the same bytes."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url} {payload_digest}')}>"


def _header_value(text) -> str:
    """A header value on one line."""
    return " ".join(str(text).split())


def encode_record(page_id, url, payload: bytes | None, length: int, payload_digest: str, refers_to) -> bytes:
    """One WARC record. Without a payload it is a revisit; its HTTP head still tells the full length."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = head + (payload or b"")
    fields = [
        ("WARC-Type", "response" if payload is not None else "revisit"),
        ("WARC-Record-ID", record_id(page_id, url, payload_digest)),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Payload-Digest", f"sha1:{payload_digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None and str(url).strip():
        fields.append(("WARC-Target-URI", _header_value(url)))
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if payload is None:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("X-Refers-To-Page-ID", str(refers_to))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


class RecordError(ValueError):
    """A record that does not follow the format."""


def _fields(lines: list[bytes]) -> dict[str, str]:
    found: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            raise RecordError(f"header line without a name: {line[:60]!r}")
        if name.strip().lower().decode("ascii", "replace") in found:
            raise RecordError(f"header given twice: {name[:60]!r}")
        found[name.strip().lower().decode("ascii", "replace")] = value.strip().decode("utf-8", "replace")
    return found


def _length(fields: dict[str, str]) -> int:
    text = fields.get("content-length", "")
    if not (text.isascii() and text.isdigit()):
        raise RecordError(f"Content-Length {text!r}")
    return int(text)


def decode_record(data: bytes) -> dict:
    """The fields and payload of one record; raises RecordError where headers or lengths do not hold."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.split(b"\r\n")
    if not gap or first not in (b"WARC/1.0", b"WARC/1.1"):
        raise RecordError("no WARC version line or no end of headers")
    fields = _fields(lines)
    for name in ("warc-type", "warc-record-id", "warc-date"):
        if not fields.get(name):
            raise RecordError(f"{name} is missing")
    length = _length(fields)
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise RecordError(f"the block has {len(rest) - 4} bytes, its header says {length}")
    kind = fields["warc-type"]
    found = {"record_id": fields["warc-record-id"], "url": fields.get("warc-target-uri"), "record_type": kind}
    page, refers = fields.get("x-page-id"), fields.get("x-refers-to-page-id")
    try:
        found |= {"page_id": int(page) if page is not None else None}
        found |= {"refers_to": int(refers) if refers not in (None, "None") else None}
    except ValueError as error:
        raise RecordError(f"page ids {page!r}, {refers!r}") from error
    if kind not in ("response", "revisit"):
        return found | {"payload": rest[:length], "payload_bytes": length, "payload_digest": None}
    http, gap, payload = rest[:length].partition(b"\r\n\r\n")
    status, *lines = http.split(b"\r\n")
    if not gap or not status.startswith(b"HTTP/"):
        raise RecordError("no HTTP head in the block")
    full = _length(_fields(lines))
    told = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind == "response":
        if len(payload) != full:
            raise RecordError(f"the payload has {len(payload)} bytes, its head says {full}")
        if told and told != digest(payload):
            raise RecordError("the payload does not fit its digest")
        told = told or digest(payload)
    elif payload or not told:
        raise RecordError("a revisit with a payload or without a digest")
    return found | {"payload": payload if kind == "response" else None, "payload_bytes": full, "payload_digest": told}


def _dictionary(samples: list[bytes]) -> bytes | None:
    """A dictionary trained on the first records of an archive, or None where they are too few or too alike."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, [s[:SAMPLE_BYTES] for s in samples]).as_bytes()
    except zstandard.ZstdError:
        return None


def encode_archives(records: Iterator[bytes], most: int = ARCHIVE_BYTES) -> Iterator[bytes]:
    """Archives of about `most` bytes; a dictionary is trained on the first records of each."""
    waiting: list[bytes] = []
    out, packer = bytearray(), None

    def begin():
        nonlocal packer
        trained = _dictionary(waiting)
        if trained:
            out.extend(DICTIONARY_MAGIC + struct.pack("<I", len(trained)) + trained)
        packer = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(trained) if trained else None)
        for record in waiting:
            out.extend(packer.compress(record))
        waiting.clear()

    held = 0
    for record in records:
        if packer is None:
            waiting.append(record)
            held += len(record)
            if len(waiting) >= SAMPLE_RECORDS or held >= most:
                begin()
                held = 0
        else:
            out.extend(packer.compress(record))
        if len(out) >= most:
            yield bytes(out)
            out.clear()
            packer = None
    if waiting:
        begin()
    if out:
        yield bytes(out)


def leading_dictionary(data: bytes) -> tuple[bytes | None, int]:
    """The dictionary of an archive and where its records begin. The frame may hold it compressed."""
    if data[:4] != DICTIONARY_MAGIC:
        return None, 0
    if len(data) < 8 or len(data) < 8 + (size := struct.unpack_from("<I", data, 4)[0]):
        raise RecordError("the dictionary frame is cut short")
    raw = bytes(data[8 : 8 + size])
    if raw[:4] == FRAME_MAGIC:
        raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
    return raw, 8 + size


def decode_archive(data: bytes) -> Iterator[tuple[int, bytes | None, str | None]]:
    """(offset, record, error) of every frame. A damaged frame ends the archive with an error row."""
    try:
        raw, at = leading_dictionary(data)
        reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw) if raw else None)
    except (RecordError, zstandard.ZstdError) as error:
        yield 0, None, str(error)
        return
    view = memoryview(data)
    while at < len(data):
        magic = struct.unpack_from("<I", data, at)[0] if at + 8 <= len(data) else 0
        if magic in SKIPPABLE:
            at += 8 + struct.unpack_from("<I", data, at + 4)[0]
            if at > len(data):
                yield at, None, "a skippable frame is cut short"
            continue
        frame, parts, end = reader.decompressobj(), [], at
        try:
            while end < len(data) and not frame.eof:
                parts.append(frame.decompress(view[end : end + STEP_BYTES]))
                end = min(len(data), end + STEP_BYTES)
        except zstandard.ZstdError as error:
            yield at, None, str(error)
            return
        if not frame.eof:
            yield at, None, "the last frame is cut short"
            return
        yield at, b"".join(parts), None
        at = end - len(frame.unused_data)


def write_archives(pages: DataFrame, path: str, most: int = ARCHIVE_BYTES) -> None:
    """Write one WARC record per row of `pages` (page_id, url, html) as Zstandard archives in a folder.

    The payload is the html in UTF-8, empty where it is null. Of the rows with equal payloads the one
    with the largest page_id (a null id comes last) is a response and the others are revisits that
    refer to it; rows that repeat that id too are all responses. Other columns are not stored. An
    empty table leaves an empty folder.

    Only (hash, id) pairs are grouped, with partial maxima before the shuffle; only payloads that
    occur again are joined back. Both sides of that join are read from storage, so AQE can split a
    payload that a third of the pages share. Archives are rows until Spark's text writer puts each in
    a file of its own, through the commit protocol of whatever store the path is in. That writer puts out the bytes
    of a string as they are, UTF-8 or not; Spark does not promise it, so whoever reads an archive checks every
    record's lengths and digest (`read_archives`), and `roundtrip` raises where one does not hold.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"),
    )
    keyed = rows.withColumn("_key", F.sha2("payload", 256))
    repeated = keyed.groupBy("_key").agg(F.max("page_id").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    joined = keyed.join(stored(repeated.drop("_n"), "warc-repeated").hint("merge"), "_key", "left")
    revisit = F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    ready = joined.select(
        "page_id",
        "url",
        F.octet_length("payload").cast("long").alias("length"),
        F.sha1("payload").alias("sha1"),
        F.when(~revisit, F.col("payload")).alias("payload"),
        F.when(revisit, F.col("_first")).alias("refers_to"),
    )

    def records(batches):
        for batch in batches:
            for row in zip(*(batch.column(i) for i in range(batch.num_columns))):
                page_id, url, length, sha1, payload, refers_to = (x.as_py() for x in row)
                yield encode_record(page_id, url, payload, length, base64.b32encode(bytes.fromhex(sha1)).decode(), refers_to)

    def pack(batches):
        for archive in encode_archives(records(batches), most):
            yield pa.RecordBatch.from_arrays([pa.array([archive], pa.binary())], ["archive"])

    archives = ready.mapInArrow(pack, "archive binary")
    archives.select(F.col("archive").cast("string").alias("value")).write.options(
        lineSep=EMPTY_FRAME, maxRecordsPerFile=1
    ).text(path)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives in a folder, one row each, with where it stands and what is wrong with it.

    The dictionary comes from the leading skippable frame, if there is one; each further frame holds
    one record, and other skippable frames are passed over. A record whose headers, block length,
    payload length or digest do not hold has an `error` and no other fields; a frame that cannot be
    decoded ends its archive. An archive is read by one task and must fit in it.
    """

    def unpack(batches):
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1)):
                rows, held = [], 0
                for offset, record, error in decode_archive(content.as_buffer().to_pybytes()):
                    row = {"archive": name.as_py(), "offset": offset, "error": error}
                    if error is None:
                        try:
                            row |= decode_record(record)
                        except RecordError as wrong:
                            row["error"] = str(wrong)
                    rows.append(row)
                    held += len(row.get("payload") or b"")
                    if held >= 4 << 20 or len(rows) >= 2_000:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    long, text = pa.int64(), pa.string()
    schema = pa.schema([
        ("archive", text), ("offset", long), ("record_id", text), ("page_id", long), ("url", text), ("record_type", text),
        ("refers_to", long), ("payload_bytes", long), ("payload_digest", text), ("payload", pa.binary()), ("error", text),
    ])
    files = spark.read.format("binaryFile").load(path).select("path", "content").where(F.length("content") > 0)
    return files.mapInArrow(unpack, RECORDS)


def roundtrip(pages: DataFrame) -> DataFrame:
    """Write the pages to archives under the shared folder and read all their records back.

    A record that comes back damaged raises when it is read. The folder goes when the driver's JVM ends.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path)
    file_system(spark, path).deleteOnExit(hadoop_path(spark, path))
    records = read_archives(spark, path)
    sound = F.when(F.col("error").isNull(), F.col("record_type")).otherwise(F.raise_error(F.concat(F.lit("damaged archive: "), "error")))
    return records.withColumn("record_type", sound.cast("string"))
