import duckdb
import pytest
from conftest import rows

from cohortloom.llm import warc as W
from cohortloom.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
LONG = "<html>" + "é" * 200


def test_round_trip_and_edges(spark, tmp_path):
    pages = [
        (3, "http://a/b\r\nWARC-Type: x", LONG), (1, "http://a/c", LONG), (1, "http://a/c", LONG), (None, None, LONG), (5, "u", None), (9, "", ""),
        (6, "http://h?q", "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\n"), (7, "http://h", "short"), (8, "http://h", "short"),
        (2, "http://big/", "long text " * 300_000),
    ]
    table = spark.createDataFrame(pages, "page_id long, url string, html string")
    W.write_archives(table.selectExpr("*", "1 AS page", "2 AS payload", "3 AS digest", "4 AS again"), str(tmp_path / "w"))
    records = W.read_records(spark, str(tmp_path / "w"))
    assert records.count() == 3 * len(pages)
    captures = W.assemble(records)
    got = {}
    for r in captures.collect():
        assert r.request.concurrent_to == r.metadata.concurrent_to == r.response.record_id
        got.setdefault(r.metadata.fields.get("page_id"), []).append(r.response)
    assert len(got["1"]) == 2 and all(x.payload.decode() == LONG and x.record_type == "response" for x in got["1"])
    assert [x.record_type for x in got["3"] + got[None]] == ["revisit", "revisit"]
    assert got["6"][0].payload.decode() == pages[6][2] and got["2"][0].payload.decode() == pages[9][2]
    assert got["5"][0].payload == b"" and got["7"][0].record_type == got["8"][0].record_type == "response"
    refers = {r.page_id: r.refers_to for r in W.digests(captures).collect()}
    assert refers == {3: 1, 1: None, None: 1, 5: None, 9: None, 6: None, 7: None, 8: None, 2: None}
    assert W.digests(captures).count() == len(pages)


def test_empty_table_and_partial_captures(spark, tmp_path):
    W.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), str(tmp_path / "e"))
    assert W.read_records(spark, str(tmp_path / "e")).collect() == []
    path = tmp_path / "f" / "x.warc"
    path.parent.mkdir()
    path.write_bytes(
        b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <a>\r\nContent-Type: application/http\r\nContent-Length: 23\r\n\r\nHTTP/1.1 200 OK\r\n\r\nbody\r\n\r\n"
        b"WARC/1.0\r\nWARC-Type: metadata\r\nWARC-Record-ID: <b>\r\nWARC-Concurrent-To: <gone>\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n"
    )
    found = {r.capture_id: r for r in W.assemble(W.read_records(spark, str(path))).collect()}
    assert found["<a>"].response.payload == b"body" and found["<a>"].request is None and found["<a>"].metadata is None
    assert found["<gone>"].response is None and found["<gone>"].metadata.payload == b"hi"


@pytest.mark.parametrize("damage", [lambda b: b[:-30], lambda b: b"junk\r\n" + b])
def test_damaged_archives_fail(spark, tmp_path, damage):
    path = tmp_path / "d" / "x.warc"
    path.parent.mkdir()
    path.write_bytes(damage(b"WARC/1.0\r\nWARC-Type: metadata\r\nWARC-Record-ID: <b>\r\nContent-Length: 40\r\n\r\n" + b"x" * 40 + b"\r\n\r\n"))
    with pytest.raises(Exception, match="record"):
        W.read_records(spark, str(path)).collect()


def test_query(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{FOLDER}/pages.parquet'")
    want = con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({SQL['op7_warc']})").fetchall()
    assert rows(QUERIES["op7_warc"](spark, FOLDER), *COLUMNS) == sorted(want, key=repr)
