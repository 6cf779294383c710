import base64
import hashlib

from flowtables.llm import warc
from flowtables.llm.common import scratch_path
from llm_cases import rows


def _pages(spark, data):
    return spark.createDataFrame(data, "page_id long, url string, html string, payload string, sha int")


DATA = [
    (5, "http://a/x y", "<p>one</p>"),
    (2, None, "<p>one</p>"),
    (9, "", "<p>one</p>"),
    (3, "http://b/", None),
    (4, "http://c/", ""),
    (None, "http://d/", "<p>one</p>"),
    (None, "http://e/", "<p>only null ids</p>"),
    (None, "http://f/", "<p>only null ids</p>"),
    (7, "http://g/\r\nEvil: 1", "body\r\n\r\nWARC/1.1\r\n\r\nmore ü日本"),
    (8, "http://h/", "x" * 300_000),
    (1, "http://i/", "repeat"),
    (1, "http://i/", "repeat"),
    (6, "http://j/", "repeat"),
]


def _want(data, min_bytes=0):
    first = {}
    for page, _, body in data:
        if page is not None:
            first[body or ""] = min(page, first.get(body or "", page))
    out = []
    for page, _, body in data:
        raw = (body or "").encode()
        home = first.get(body or "")
        revisit = home is not None and page != home and len(raw) >= min_bytes
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out.append((page, len(raw), digest, "revisit" if revisit else "response", home if revisit else None, True))
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


COLS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload_ok")


def test_round_trip_against_brute_force(spark):
    pages = _pages(spark, [(*r, "clash", 1) for r in DATA])
    for least in (0, 5):
        path = scratch_path(spark, "warc-test")
        warc.write_archives(warc.resolve_revisits(pages, least), path, records_per_file=3)
        assert rows(warc.read_archives(spark, path), *COLS) == _want(DATA, least)


def test_archives_hold_each_payload_once(spark):
    path = scratch_path(spark, "warc-test")
    warc.write_archives(warc.resolve_revisits(_pages(spark, [(i, "u", "same " * 50, "", 0) for i in range(20)])), path)
    got = warc.read_archives(spark, path).select("record_type", "block_bytes", "payload_bytes", "record_id").collect()
    assert [r[0] for r in got].count("response") == 1
    assert all(r[1] < 120 for r in got if r[0] == "revisit") and {r[2] for r in got} == {250}
    assert len({r[3] for r in got}) == 20


def test_no_pages(spark):
    path = scratch_path(spark, "warc-test")
    warc.write_archives(warc.resolve_revisits(_pages(spark, [])), path)
    assert rows(warc.read_archives(spark, path)) == []
