"""WARC: records there and back, revisits, and archives that were tampered with."""

import gzip
import hashlib
import io

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from presswork.llm import warc
from presswork.llm.files import filesystem

RAW = st.tuples(st.text(st.characters(exclude_categories=["Cs"]), min_size=1, max_size=8), st.text("ab:/%\r\n é", max_size=12), st.binary(max_size=300))


@settings(max_examples=100, deadline=None)
@given(st.lists(RAW, max_size=6), st.sampled_from([1, 7, 64, 1 << 16]))
def test_records_come_back_whatever_the_chunk(rows, chunk):
    raw = b"".join(warc.member(p, u, b, hashlib.sha256(b).hexdigest(), None) for p, u, b in rows)
    got = list(warc.read_records(io.BytesIO(raw), chunk))
    assert [(r.page, r.url, r.payload) for r in got] == rows
    assert gzip.decompress(raw).count(b"WARC/1.1\r\nWARC-Type") >= len(rows)


@pytest.mark.parametrize("at", [30, 60, -20, -5])
def test_tampered_archives_are_found(at):
    body = b"payload " * 40
    raw = bytearray(warc.member("1", "u", body, hashlib.sha256(body).hexdigest(), None))
    raw[at] ^= 0x41
    with pytest.raises((warc.CorruptRecord, UnicodeDecodeError, KeyError, ValueError)):
        list(warc.read_records(io.BytesIO(bytes(raw))))


def test_wrong_digests_and_cut_files_are_found():
    body = b"payload " * 40
    with pytest.raises(warc.CorruptRecord):
        list(warc.read_records(io.BytesIO(warc.member("1", "u", body, "0" * 64, None))))
    whole = warc.member("1", "u", body, hashlib.sha256(body).hexdigest(), None)
    for cut in (5, len(whole) // 2, len(whole) - 1):
        with pytest.raises(warc.CorruptRecord):
            list(warc.read_records(io.BytesIO(whole + whole[:cut])))


def test_pages(spark):
    same, short, long_page = "<p>" + "x" * 120, "tiny", "<b>é</b>" * 300_000
    rows = [
        (5, "u5", same, 1), (3, "u3", same, 1), (9, None, same, 1), (1, "u1", short, 1), (2, "u2", short, 1), (4, "u4", None, 1), (6, "u6", "", None),
        (7, "u7", long_page, 1), (8, "u8", long_page, 1), (None, "none", same, 1), (10, "u\n", "z" * 100, 1), (10, "u\n", "z" * 100, 1),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest int")
    archives = warc.write_archives(pages, file_bytes=2000)
    got = warc.read_archives(archives).collect()
    assert len(got) == len(rows)
    expected = {3: None, 5: "3", 9: "3", 1: None, 2: None, 4: None, 6: None, 7: None, 8: "7", 10: None, None: None}
    for r in got:
        page = int(r.page) if r.page else None
        text = next(x[2] or "" for x in rows if x[0] == page)
        assert r.refers_to == expected[page] and r.record_type == ("revisit" if expected[page] else "response")
        assert (r.payload_bytes, r.payload_digest) == (len(text.encode()), hashlib.sha256(text.encode()).hexdigest())
        assert r.payload == (None if expected[page] else text.encode())
    for row in archives.collect():
        fs, place = filesystem(row.path)
        with fs.open_input_stream(place, compression=None) as stream:
            raw = stream.read()
        assert len(raw) == row.bytes and len(list(warc.read_records(io.BytesIO(raw)))) == row.records
    warc.remove(archives)
    assert warc.read_archives(warc.write_archives(pages.where("false"))).count() == 0
