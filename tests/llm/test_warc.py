import io
import random
import zlib
from pathlib import Path

import pytest

from offerloom.llm import warc
from offerloom.llm.storage import work_path


def member(i, payload):
    row = {"record_type": "response", "record_id": f"<urn:page:{i}>", "target_uri": "http://a/\r\n%0A", "refers_to": None, "payload_digest": "d", "payload_length": len(payload), "payload": payload}
    return warc.encode_record(row, "2020-01-01T00:00:00Z", 1)


@pytest.mark.parametrize("cut", [1, 7, 64, 1000, 10**6])
def test_every_record_belongs_to_one_range(cut):
    rng = random.Random(3)
    payloads = [b"", b"x", rng.randbytes(3000), warc.GZIP_MAGIC * 50, zlib.compress(b"a" * 500, wbits=31), b"\r\n\r\nWARC/1.1\r\n" * 9]
    data = b"".join(member(i, p) for i, p in enumerate(payloads))
    if cut == 1:
        data = data[:1500]
    got = [x for at in range(0, len(data), cut) for x in warc.records_in_range(io.BytesIO(data), len(data), at, min(len(data), at + cut))]
    whole = list(warc.records_in_range(io.BytesIO(data), len(data), 0, len(data)))
    assert got == whole
    if cut > 1:
        assert [f["payload"] for _, f in whole] == payloads
        assert whole[0][1]["target_uri"] == "http://a/\r\n%0A"


def test_broken_member_is_skipped():
    a, b, c = member(0, b"one"), bytearray(member(1, b"two" * 99)), member(2, b"three")
    b[len(b) // 2] ^= 255
    data = a + bytes(b) + c
    assert [f["record_id"] for _, f in warc.records_in_range(io.BytesIO(data), len(data), 0, len(data))] == ["<urn:page:0>", "<urn:page:2>"]


def round_trip(spark, rows, split=300):
    path = work_path(spark, "warc-test")
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload string")
    warc.write_warc(warc.page_records(pages), path)
    return warc.read_warc(spark, path, split).collect()


def test_revisits_nulls_and_repeats(spark):
    big = "ä" * 60
    rows = [(5, "http://u", big, "x"), (3, None, big, None), (9, "http://v", big, ""), (9, "http://v", big, ""), (1, "a", None, ""), (2, "b", "tiny", ""), (4, "c", "tiny", ""), (None, "n", big, "")]
    got = sorted(((warc_id(r.record_id), r.record_type, warc_id(r.refers_to), r.payload_length) for r in round_trip(spark, rows)), key=str)
    assert got == sorted([(5, "revisit", 3, 120), (3, "response", None, 120), (9, "revisit", 3, 120), (9, "revisit", 3, 120), (1, "response", None, 0), (2, "response", None, 4), (4, "response", None, 4), (None, "response", None, 120)], key=str)


def test_empty_table(spark):
    assert round_trip(spark, []) == []


def test_parts_of_other_writers_stay(spark):
    path = work_path(spark, "warc-test")
    Path(path).mkdir(parents=True)
    Path(path, "other.warc.gz.part").write_bytes(b"unfinished")
    pages = spark.createDataFrame([(1, "u", "x" * 200)], "page_id long, url string, html string")
    warc.write_warc(warc.page_records(pages), path)
    assert sorted(x.name for x in Path(path).iterdir() if x.suffix == ".part") == ["other.warc.gz.part"]
    assert warc.read_warc(spark, path).count() == 1


def test_long_record_over_many_pieces(monkeypatch):
    monkeypatch.setattr(warc, "CHUNK", 1000)
    long = random.Random(4).randbytes(200_000)
    data = member(0, b"a") + member(1, long) + member(2, b"c")
    assert [f["payload"] for _, f in warc.records_in_range(io.BytesIO(data), len(data), 0, len(data))] == [b"a", long, b"c"]


def warc_id(urn):
    number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None
