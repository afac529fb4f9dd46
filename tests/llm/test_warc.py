"""op1: exact round trip and refusal of damaged archives."""

import hashlib
import struct

import pytest
import zstandard

from chronotab.llm import warc

PAGES = [(1, "http://a/x y", "<p>same</p>"), (2, None, "<p>same</p>"), (9, "http://b", "<p>same</p>"), (3, "u", None), (4, "u", ""),
         (5, "u", "é" * 50_000), (None, "u", "<p>same</p>"), (None, "v", "only null"), (None, "v", "only null"),
         (-7, "n", "neg"), (2**62, "n", "big"), (8, "r", "twice"), (8, "r", "twice"), (6, "r", "twice")]


def want(least):
    kept = {}
    for i, _, h in PAGES:
        b = (h or "").encode()
        if i is not None and len(b) >= least:
            kept[b] = max(i, kept.get(b, i))
    out = []
    for i, u, h in PAGES:
        b = (h or "").encode()
        to = kept.get(b)
        again = to is not None and to != i
        out.append((i, u.replace(" ", "%20") if u else u, "revisit" if again else "response", len(b), warc.digest(b),
                    to if again else None, None if again else b))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 8])
def test_round_trip(spark, tmp_path, least):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("payload", F.lit(1)).withColumn("name", F.lit(2))
    warc.write_archives(df, str(tmp_path / "a"), least)
    got = warc.read_archives(spark, str(tmp_path / "a")).collect()
    assert sorted(((r.page_id, r.url, r.record_type, r.payload_bytes, r.payload_digest, r.refers_to,
                    None if r.payload is None else bytes(r.payload)) for r in got), key=str) == want(least)
    assert warc.read_archives(spark, str(tmp_path / "a"), payloads=False).count() == len(PAGES)


def test_empty(spark, tmp_path):
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), str(tmp_path / "e"))
    assert warc.read_archives(spark, str(tmp_path / "e")).count() == 0


def archive(records, samples=(b"<html>sample</html>" * 400,) * 40, plain=False):
    head, known = warc.dictionary_frame(list(samples))
    if plain:
        data = zstandard.compress(known.as_bytes())
        head = struct.pack("<II", warc.DICTIONARY_MAGIC, len(data)) + data
    pack = zstandard.ZstdCompressor(dict_data=known, write_checksum=True)
    return head + b"".join(pack.compress(r) for r in records)


def test_compressed_dictionary_and_plain_records():
    rec = warc.record(3, "u", b"<html>sample</html>" * 9, None)
    for data in (archive([rec, rec], plain=True), archive([rec, rec]), zstandard.compress(rec) * 2):
        assert [r["page_id"] for r in warc.read_archive(memoryview(data))] == [3, 3]


def test_damage_is_refused():
    rec = warc.record(3, "u", b"payload", None)
    good = archive([rec])
    bad = [good[:-1], good[:-9], good + b"junk", good + b"xx" * 9, b"abc", good[:6]]
    for old, new in ((b"Content-Length: 7", b"Content-Length: 8"), (b"payload\r\n", b"payloaD\r\n"), (b"WARC/1.1", b"WARC/9.1"),
                     (b"WARC-Date", b"WARC-Dote"), (b"\r\n\r\n", b"\r\n"), (b"WARC-Type: response", b"WARC-Type: revisit")):
        assert old in rec
        bad.append(archive([rec.replace(old, new)]))
    bad.append(archive([rec + b"x"]))
    bad.append(archive([rec + rec]))
    for data in bad:
        with pytest.raises(ValueError):
            list(warc.read_archive(memoryview(data)))


def test_digest():
    assert warc.digest(b"") == "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ" and len(hashlib.sha1(b"").digest()) == 20
    for x in (0, 5, -1, 2**63 - 1, -2**63, None):
        assert warc.page_of(warc.record_id(x)) == x
