"""The WARC writer and the salvage reader."""

import base64
import hashlib

import pytest

from sheafmill.llm import warc


def archive(payloads, packed):
    parts = [warc.record(i, f"http://h/{i}", p, None) for i, p in enumerate(payloads)]
    return [warc.member(p) + warc.EMPTY for p in parts] if packed else parts


PAYLOADS = [b"", b"one", "zwölf".encode() * 9000, b"\r\n\r\nWARC/1.1\r\n", bytes(range(256)) * 300]


@pytest.mark.parametrize("packed", [True, False])
def test_round_trip(packed):
    found = list(warc.salvage(b"".join(archive(PAYLOADS, packed))))
    assert [f.payload for f in found] == PAYLOADS
    assert found[1].headers["warc-payload-digest"] == "sha1:" + base64.b32encode(hashlib.sha1(b"one").digest()).decode()


@pytest.mark.parametrize("packed", [True, False])
@pytest.mark.parametrize("bad", range(5))
def test_damage_loses_only_its_record(packed, bad):
    parts = archive(PAYLOADS, packed)
    start = sum(map(len, parts[:bad]))
    hurt = bytearray(parts[bad])
    at = len(hurt) // 3 if packed else 2
    hurt[at] ^= 0x5A
    found = list(warc.salvage(b"".join(parts[:bad]) + bytes(hurt) + b"".join(parts[bad + 1 :])))
    kept = [f.payload for f in found if isinstance(f, warc.Record)]
    gaps = [f for f in found if isinstance(f, warc.Gap)]
    # a payload that holds a version line of its own may not give a record: its rest is part of the gap
    assert kept == PAYLOADS[:bad] + PAYLOADS[bad + 1 :]
    assert len(gaps) == 1 and gaps[0].offset == start and gaps[0].length >= len(hurt) - (len(warc.EMPTY) if packed else 0) and gaps[0].reason


def test_cut_end_and_junk():
    whole = b"".join(archive([b"a" * 50, b"b" * 5000], True))
    found = list(warc.salvage(b"junk" + whole[:-60]))
    assert [f.payload for f in found if isinstance(f, warc.Record)] == [b"a" * 50]
    gaps = [f for f in found if isinstance(f, warc.Gap)]
    assert gaps[0].offset == 0 and gaps[0].length == 4 and gaps[-1].offset + gaps[-1].length == len(whole) - 56
    assert list(warc.salvage(b"")) == []
    assert [type(f) for f in warc.salvage(b"nothing here")] == [warc.Gap]


def test_pages(spark):
    rows = [(1, "http://a/1", "same"), (2, "http://a/2", "same"), (3, None, None), (4, "u\n", ""), (4, "u", ""), (None, "x", "same"), (7, "y", "own")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", warc.F.lit(1))
    got = {(r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.round_trip(pages, "page_id", "url", "html").collect()}
    assert got == {(1, 4, "revisit", 2), (2, 4, "response", None), (3, 0, "revisit", 4), (4, 0, "response", None), (None, 4, "response", None), (7, 3, "response", None)}
    none = warc.round_trip(pages.where("false"), "page_id", "url", "html")
    assert none.count() == 0


def test_least_bytes(spark):
    pages = spark.createDataFrame([(1, "a", "abc"), (2, "b", "abc")], "page_id long, url string, html string")
    assert {r.record_type for r in warc.round_trip(pages, "page_id", "url", "html", least_bytes=4).collect()} == {"response"}


def test_header_of_any_length(spark):
    url = "http://h/" + "\n" * 40_000  # three bytes each when encoded
    found = list(warc.salvage(warc.member(warc.record(1, url, b"body", None))))
    assert [type(f) for f in found] == [warc.Record] and found[0].payload == b"body" and len(found[0].headers["warc-target-uri"]) > 100_000
    pages = spark.createDataFrame([(1, url, "abc")], "page_id long, url string, html string")
    assert [r.page_id for r in warc.round_trip(pages, "page_id", "url", "html").collect()] == [1]


def test_bad_record_inside_a_member_loses_only_itself():
    parts = [warc.record(i, f"http://h/{i}", b"payload %d" % i * 50, None) for i in range(4)]
    parts[1] = parts[1].replace(b"payload 1payload", b"payload 1pAyload", 1)
    other = warc.member(warc.record(9, "http://h/9", b"nine", None))
    data = warc.member(b"".join(parts)) + other
    found = list(warc.salvage(data))
    assert [f.headers["warc-record-id"] for f in found if isinstance(f, warc.Record)] == [f"<urn:page:{n}>" for n in (0, 2, 3, 9)]
    gaps = [f for f in found if isinstance(f, warc.Gap)]
    assert [(g.offset, g.length, g.reason) for g in gaps] == [(0, len(data) - len(other), "wrong payload digest")]


@pytest.mark.parametrize("harm", ["cut", "flip"])
def test_broken_member_gives_the_records_before_the_break(harm):
    import random

    rng = random.Random(3)
    parts = [warc.record(i, f"http://h/{i}", rng.randbytes(20_000), None) for i in range(6)]
    data = bytearray(warc.member(b"".join(parts)))
    if harm == "cut":
        data = data[: len(data) * 7 // 10]
    else:
        data[-6] ^= 1  # the checksum
    found = list(warc.salvage(bytes(data)))
    kept = [f.headers["warc-record-id"] for f in found if isinstance(f, warc.Record)]
    assert kept == [f"<urn:page:{n}>" for n in range(4 if harm == "cut" else 6)]
    assert [type(f) for f in found][-1] is warc.Gap


def test_only_record_of_a_broken_member_is_a_gap():
    data = bytearray(warc.member(warc.record(1, "http://h/1", b"one", None)))
    data[-6] ^= 1
    assert [type(f) for f in warc.salvage(bytes(data))] == [warc.Gap]
