import gzip
import hashlib

import pytest

from fleetpulse.llm import warc as op


@pytest.fixture
def pages(spark):
    def build(*rows, partitions=3):
        return spark.createDataFrame(list(rows), "page_id long, url string, html string").repartition(partitions)

    return build


def convert(spark, pages, version=None):
    return op.read_warc(spark, op.arc_to_warc(spark, op.write_files(op.arc_records(pages, version), "arc", "\n"))).collect()


def brute(rows):
    out = []
    for page_id, _, html in rows:
        raw = (html or "").encode()
        equal = [r[0] for r in rows if r[2] == html and r[0] is not None]
        again = len(raw) >= 1000 and bool(equal) and page_id != max(equal)
        out.append((page_id, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", max(equal) if again else None))
    return out


@pytest.mark.parametrize("version", [1, 2, None])
def test_round_trip(spark, pages, version):
    tricky = "WARC/1.1\r\nWARC-Type: response\r\n\r\nhttp://a 0.0.0.0 1 text/html 5\nfiledesc://x\r\n\r\n" * 20
    rows = [
        (1, "http://a/b?c=d e", "<p>ö</p>"), (2, None, None), (3, "", ""), (4, "http://x", tricky), (9, "http://y", tricky), (5, "http://z", tricky),
        (6, "u", "long " * 300_000), (None, "v", "é" * 600), (8, "w", "é" * 600), (11, "q", "\x00\x01\r\n\n"), (12, "r", "z" * 999), (13, "r", "z" * 999),
    ]
    got = [tuple(r)[1:] for r in convert(spark, pages(*rows), version)]
    assert sorted(map(str, got)) == sorted(map(str, brute(rows)))


def test_repeated_rows_leave_one_response(spark, pages):
    got = convert(spark, pages(*[(7, "u", "same " * 300)] * 5, (None, "u", "none " * 300), (None, "u", "none " * 300)))
    assert sorted((str(r.page_id), r.record_type, str(r.refers_to)) for r in got) == (
        [("7", "response", "None")] + [("7", "revisit", "7")] * 4 + [("None", "response", "None"), ("None", "revisit", "None")]
    )
    assert len({r.record_id for r in got}) == 7


def test_no_rows(spark, pages):
    assert convert(spark, pages((1, "u", "x")).limit(0)) == []


def test_old_header_lines():
    head = b"1 0 maker\nURL IP-address Archive-date Content-type Archive-length\n"
    arc = b"filedesc://old.arc 1.2.3.4 1997 text/plain %d\n%s\n" % (len(head), head)
    arc += b"http://old/a b 1.2.3.4 19970102030405 text/html 9\nHTTP\r\n\r\nx\nhttp://two 1.2.3.4 1997 text/html 0\n\n"
    packed = gzip.compress(arc[:80]) + gzip.compress(arc[80:])  # members end anywhere
    assert [(h["URL"], h["Archive-date"], b) for _, h, b in op.parse_arc(packed)] == [
        ("http://old/a b", "19970102030405", b"HTTP\r\n\r\nx"), ("http://two", "1997", b"")
    ]
    with pytest.raises(ValueError, match="declared"):
        list(op.parse_arc(gzip.compress(arc[:arc.index(b"HTTP") + 3])))
