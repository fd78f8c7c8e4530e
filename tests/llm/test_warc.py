import hashlib

import pytest

from threadlens.llm import warc

PAGES = "page_id bigint, url string, html string, record_id string, digest string"
BIG = "<html>" + "é" * 60 + "</html>"
ROWS = [
    (5, "http://a.b/c d", BIG), (3, "http://a.b/", BIG), (9, None, BIG), (4, "u", "x" * 99), (6, "u", "x" * 99),
    (7, "u", ""), (8, "u", None), (None, "u", BIG), (3, "again", BIG), (10, "u", "HTTP/1.1 200 OK\r\n\r\n" + "y" * 100),
    (11, "u", "WARC/1.1\r\n\r\n\n\nfiledesc:// 1 2 3\n" * 9), (12, "u", "z" * 300_000),
]


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], PAGES)


@pytest.mark.parametrize("version", [1, 2])
def test_archives_round_trip(spark, version):
    arc = warc.write_arc(pages(spark, ROWS).repartition(3), version)
    folder = warc.convert(spark, arc)
    found = warc.page_digests(spark, [folder]).collect()
    got = sorted((r.page_id is None, r.page_id, r.payload_bytes, r.payload_digest) for r in found)
    raw = [(i, (h or "").encode()) for i, _, h in ROWS]
    assert got == sorted((i is None, i, len(b), hashlib.sha256(b).hexdigest()) for i, b in raw)
    big = [r for r in found if r.payload_digest == hashlib.sha256(BIG.encode()).hexdigest()]
    assert sorted(r.record_type for r in big) == ["response"] + ["revisit"] * 4
    assert [r.page_id for r in big if r.record_type == "response"] == [3]
    assert {r.refers_to for r in big if r.record_type == "revisit"} == {3}
    assert all(r.record_type == "response" and r.refers_to is None for r in found if r.payload_bytes < 100)
    records = warc.read_warc(spark, folder).collect()
    assert len({r.record_id for r in records}) == len(ROWS)
    assert {r.date for r in records} == {"2020-01-01T00:00:00Z"}
    assert {r.url for r in records if r.page_id == 5} == {"http://a.b/c%20d"}
    assert {bytes(r.payload) for r in records if r.page_id == 12} == {b"z" * 300_000}


def test_both_versions_are_parsed_by_their_fields():
    for version in (1, 2):
        body = b"HTTP/1.0 200 OK\r\n\r\nhello\n\n"
        values = {"URL": "http://x/", "IP-address": "1.2.3.4", "Archive-date": "199704251035", "Content-type": "text/html"}
        raw = warc.arc_preamble(version, "19970425103500") + b"\n" + warc._arc_record(version, values, body) * 2
        found = list(warc.arc_records(raw))
        assert [f["IP-address"] for _, f, _ in found] == ["1.2.3.4"] * 2 and [b for *_, b in found] == [body] * 2
        assert warc.split_block(body) == (b"HTTP/1.0 200 OK\r\n\r\n", b"hello\n\n")
    assert warc.iso_time("199704251035") == "1997-04-25T10:35:00Z"


def test_broken_archives_are_refused():
    good = warc.arc_preamble(1, "19970425103500")
    with pytest.raises(ValueError):
        list(warc.arc_records(good + b"http://x/ 1.2.3.4 19970425103500 text/html 50\nshort\n"))
    with pytest.raises(ValueError):
        list(warc.arc_records(good + b"http://x/ 19970425103500 5\nshort\n"))
    with pytest.raises(ValueError):
        list(warc.arc_records(b"http://x/ 1.2.3.4 19970425103500 text/html 5\nshort\n"))
    with pytest.raises(ValueError):
        list(warc.arc_records(good.replace(b"1 0 thread", b"3 0 thread")))


def test_blanks_in_urls_and_content_types():
    for version in (1, 2):
        values = {"URL": "http://x/a b  c", "IP-address": "1.2.3.4", "Archive-date": "19970425103500", "Content-type": "text/html; charset=x"}
        raw = warc.arc_preamble(version, "19970425103500") + b"\n" + warc._arc_record(version, values, b"hello") * 2
        found = list(warc.arc_records(raw))
        assert [b for *_, b in found] == [b"hello"] * 2
        assert [(f["URL"], f["Content-type"]) for _, f, _ in found] == [("http://x/a b  c", "text/html; charset=x")] * 2


def test_damaged_files_are_listed(spark):
    sound = warc.write_arc(pages(spark, [(1, "http://x/", "hello"), (2, "http://y/", "there")]))
    values = {"URL": "http://z/", "IP-address": "-", "Archive-date": "19970425103500", "Content-type": "text/html"}
    bad = warc.member(warc.arc_preamble(1, "19970425103500") + warc._arc_record(1, values, b"fine") + b"http://z/ nonsense\n")
    broken = warc.write_blobs(spark.createDataFrame([(bytearray(bad),)], "file binary"), "file", warc.TAIL, "arc")
    assert warc.damaged_files(spark, sound).collect() == []
    listed = warc.damaged_files(spark, broken).collect()
    assert [(r.n_records, "header line" in r.damage) for r in listed] == [(1, True)]
    assert [r.url for r in warc.read_arc(spark, broken, strict=False).collect()] == ["http://z/"]
    with pytest.raises(Exception, match="header line"):
        warc.read_arc(spark, broken).collect()


def test_files_are_closed_by_what_they_unpack_to(spark):
    rows = [(k, "http://x/", "same words again " * 1_000_000) for k in range(5)]
    folder = warc.write_arc(pages(spark, rows).coalesce(1))
    sizes = [len(warc.unpacked(bytes(r.content))) for r in warc.read_blobs(spark, folder).collect()]
    assert len(sizes) == 3 and max(sizes) < warc.UNPACKED_BYTES + (18 << 20)
    assert warc.read_arc(spark, folder).count() == 5


def test_empty_table(spark):
    folder = warc.convert(spark, warc.write_arc(pages(spark, [])))
    assert warc.page_digests(spark, [folder]).count() == 0
