import struct

import pytest
import zstandard

from spelltide.llm import warc

PAGE = "page_id long, url string, html string"


def pages(spark, rows):
    return spark.createDataFrame(rows, PAGE)


def found(df):
    assert df.where("error is not null").isEmpty()
    return sorted(tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect())


def test_round_trip_with_revisits(spark):
    rows = [(1, "http://a/", "same"), (2, "http://b/", "same"), (3, None, None), (4, "x\r\ny", ""), (5, "http://é/", "é" * 200_000), (6, "", "other")]
    df = warc.roundtrip(pages(spark, rows))
    same, empty = warc.digest(b"same"), warc.digest(b"")
    assert found(df) == [
        (1, 4, same, "revisit", 2),
        (2, 4, same, "response", None),
        (3, 0, empty, "revisit", 4),
        (4, 0, empty, "response", None),
        (5, 400_000, warc.digest(("é" * 200_000).encode()), "response", None),
        (6, 5, warc.digest(b"other"), "response", None),
    ]
    payloads = {r.page_id: r.payload for r in df.collect()}
    assert payloads[5].decode() == "é" * 200_000 and payloads[1] is None and payloads[4] == b""


def test_repeated_rows_null_ids_and_extra_columns(spark):
    df = pages(spark, [(7, "u", "p"), (7, "u", "p"), (None, "v", "p"), (None, "w", "q")])
    out = warc.roundtrip(df.selectExpr("*", "1 as _key", "2 as payload", "3 as _first"))
    kinds = sorted((r.page_id or 0, r.record_type, r.refers_to or 0) for r in out.collect())
    assert kinds == [(0, "response", 0), (0, "revisit", 7), (7, "response", 0), (7, "response", 0)]


def test_empty_table(spark):
    assert warc.roundtrip(pages(spark, [])).count() == 0


def test_many_records_use_a_dictionary_and_several_archives(spark, tmp_path):
    rows = [(i, f"http://a/{i}", f"<html><head><title>Page {i}</title></head><body>{'text of the page ' * (i % 7)}{i}</body></html>") for i in range(900)]
    path = str(tmp_path / "warc")
    warc.write_archives(pages(spark, rows).coalesce(1), path, most=20_000)
    files = spark.read.format("binaryFile").load(path).where("length > 0").collect()
    assert len(files) > 1 and any(f.content[:4] == warc.DICTIONARY_MAGIC for f in files)
    df = warc.read_archives(spark, path)
    assert {r.page_id: r.payload.decode() for r in df.collect()} == {i: t for i, _, t in rows}


def record(**changed):
    fields = {"WARC-Type": "response", "WARC-Record-ID": "<urn:x>", "WARC-Date": "2020-01-01T00:00:00Z", "Content-Length": "40"} | changed
    block = b"HTTP/1.1 200 OK\r\nContent-Length: 2\r\n\r\nhi"
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v).encode() + b"\r\n" + block + b"\r\n\r\n"


def test_valid_record_of_another_writer():
    assert warc.decode_record(record())["payload"] == b"hi"


@pytest.mark.parametrize(
    "data",
    [
        record(**{"Content-Length": "41"}),
        record(**{"Content-Length": "x"}),
        record(**{"Content-Length": None}),
        record(**{"WARC-Date": None}),
        record(**{"WARC-Payload-Digest": "sha1:AAAA"}),
        record().replace(b"Content-Length: 2", b"Content-Length: 3"),
        record().replace(b"WARC/1.1", b"WARC/9"),
        record()[:-1],
        b"",
    ],
)
def test_headers_and_lengths_are_checked(data):
    with pytest.raises(warc.RecordError):
        warc.decode_record(data)


def test_compressed_dictionary_skippable_frames_and_damage():
    raw = zstandard.train_dictionary(4096, [f"sample {i} of many words {i * 7}".encode() * 5 for i in range(300)]).as_bytes()
    packer = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(raw))
    packed = zstandard.ZstdCompressor().compress(raw)
    skip = struct.pack("<II", 0x184D2A50, 3) + b"abc"
    frames = [packer.compress(b"one" * 100), packer.compress(b"two" * 9000)]
    data = warc.DICTIONARY_MAGIC + struct.pack("<I", len(packed)) + packed + frames[0] + skip + frames[1] + warc.EMPTY_FRAME.encode()
    assert [(r, e) for _, r, e in warc.decode_archive(data)] == [(b"one" * 100, None), (b"two" * 9000, None)]
    cut = list(warc.decode_archive(data[: -len(warc.EMPTY_FRAME) - 4]))
    assert cut[0][1] == b"one" * 100 and cut[1][1] is None and cut[1][2]
    assert list(warc.decode_archive(b"garbage!garbage!"))[0][2]
    assert list(warc.decode_archive(warc.DICTIONARY_MAGIC + struct.pack("<I", 99)))[0][2]
