import gzip
import hashlib

import pytest

from shelfwise.llm import warc as op
from shelfwise.session import new_shared_path

LONG, OTHER = "é" * 60, "<html>" + "y" * 200 + "\r\n\r\nWARC/1.1\r\n"
ROWS = [
    (5, "http://a/ b\r\nX: y", LONG), (3, "http://b", LONG), (9, None, LONG), (1, "http://c", None), (2, "", ""), (4, "http://d", "z" * 99),
    (6, "http://e", "z" * 99), (7, "http://f", OTHER), (8, "http://g", "x" * 300_000), (8, "http://g", "x" * 300_000), (11, "http://h", "x" * 300_000),
]


@pytest.fixture
def pages(spark):
    return spark.createDataFrame(ROWS, "page_id long, url string, html string").repartition(3)


def test_round_trip(pages):
    def brute():
        texts = [(i, (h or "").encode()) for i, _, h in ROWS]
        for i, t in texts:
            first = min(j for j, u in texts if u == t)
            revisit = len(t) >= 100 and i != first
            yield i, len(t), hashlib.sha256(t).hexdigest(), "revisit" if revisit else "response", first if revisit else None

    assert sorted(map(str, map(tuple, op.round_trip(pages).collect()))) == sorted(map(str, brute()))
    assert op.round_trip(pages.limit(0)).count() == 0


def test_predicates_reach_the_reader_and_payloads_only_where_asked_for(spark, pages):
    path = new_shared_path(spark, "warc-test")
    op.write_pages(pages, path, partitionBytes="1")
    found = op.read_warc(spark, path, "record_type", "record_id", "target_uri", "payload_length").filter("record_type = 'revisit' and payload_length > 200")
    assert [r.record_id for r in found.collect()] == ["<urn:x-page:11>"]
    odd = op.read_warc(spark, path).filter("record_id = '<urn:x-page:5>'").first()
    assert odd.target_uri == "http://a/%20b%0D%0AX:%20y" and odd.refers_to == "<urn:x-page:3>" and odd.payload is None
    assert odd.headers["warc-profile"] == op.IDENTICAL
    reader = op.WarcReader({"path": path}, op.SCHEMA)
    left = list(reader.pushFilters([op.EqualTo(("record_type",), "revisit"), op.EqualTo(("headers", "x"), "y")]))
    assert len(left) == 1 and reader.tests == [("record_type", "eq", "revisit")]


def test_plain_and_single_member_archives(tmp_path, spark):
    row = dict(record_type="response", record_id="<urn:x-page:1>", target_uri="http://a", date="d", payload=OTHER.encode(), payload_digest=None, payload_length=None, refers_to=None)
    data = op.record_bytes(row) + op.record_bytes(row | {"record_type": "revisit", "payload": None, "payload_length": 7}) + op.record_bytes(row)
    (tmp_path / "a.warc").write_bytes(data)
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(data))
    got = op.read_warc(spark, f"file://{tmp_path}").collect()
    assert sorted((r.record_type, r.payload_length, r.payload and bytes(r.payload).decode()) for r in got) == sorted(
        [("response", len(OTHER), OTHER)] * 4 + [("revisit", 7, None)] * 2, key=str)
    skipped = op.read_warc(spark, f"file://{tmp_path}", "record_type").filter("record_type = 'revisit'")
    assert skipped.count() == 2
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(data[:-300]))
    with pytest.raises(Exception, match="ends inside"):
        op.read_warc(spark, f"file://{tmp_path}").collect()


def test_members_tell_their_length():
    data = op._member(b"x" * 1000, 6)
    assert gzip.decompress(data) == b"x" * 1000 and int.from_bytes(data[16:20], "little") == len(data)
