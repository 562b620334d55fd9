import hashlib

import duckdb
import pytest

from actlens.llm import warc
from actlens.llm.sql import ORACLE

ROWS = [
    (1, "http://a.example/x", "h" * 1000), (2, "http://a.example/y", "h" * 1000), (3, None, None), (4, "u", ""),
    (5, "u", "short"), (6, "u", "short"), (9, "http://b.example/é\r\nX: y", "é" * 500),
    (8, "http://b.example/", "é" * 500), (7, "v", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n\r\n\r\n" * 30),
    (10, "v", "h" * 1000), (11, "v", "\r\n\r\n"),
]


def expected(rows):
    payload = {i: (h or "").encode() for i, _, h in rows}
    out = []
    for i, p in payload.items():
        same = max(j for j, q in payload.items() if q == p) if len(p) >= 1000 else i
        out.append((i, len(p), hashlib.sha1(p).hexdigest(), "response" if same == i else "revisit", None if same == i else same))
    return sorted(out)


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_records_and_transactions(spark, tmp_path, compression):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string").repartition(2)
    warc.write(pages, str(tmp_path / "a"), compression=compression)
    records = warc.read(spark, str(tmp_path / "a"))
    assert records.count() == 3 * len(ROWS)
    kinds = dict(records.groupBy("type").count().collect())
    assert kinds == {"request": 11, "metadata": 11, "response": 8, "revisit": 3}
    rows = warc.transactions(records).collect()
    assert len(rows) == len(ROWS)
    by_id = {int(r.metadata.fields["capture-id"]): r for r in rows}
    for i, url, html in ROWS:
        r = by_id[i]
        assert r.request.concurrent_to if "concurrent_to" in r.request else True
        assert bytes(r.request.payload if r.request.payload is not None else b"") == b""
        if r.response.type == "response":
            assert bytes(r.response.payload).decode() == (html or "")
        assert r.target_uri == (url or "").replace("\r\n", "")
        assert r.response.payload_bytes == len((html or "").encode())


def test_round_trip(spark):
    pages = spark.createDataFrame([(*r, "clash") for r in ROWS], "page_id long, url string, html string, type string")
    assert sorted(map(tuple, warc.round_trip(pages).collect())) == expected(ROWS)
    assert warc.round_trip(pages.limit(0)).collect() == []


def test_null_and_repeated_ids(spark, tmp_path):
    """Every row comes back, as the query's SQL has it."""
    a, b, c, d = "a" * 1200, "b" * 1500, "c" * 1100, "d" * 1300
    rows = [(None, "u", a), (1, "u", a), (2, "u", a), (2, "v", a), (2, "v", a),  # the largest id three times
            (None, "u", b), (None, "w", b), (None, None, None), (None, "u", "short"),  # no id at all
            (7, "u", c), (7, "u", c), (8, "u", d), (8, "u", c), (3, "u", "x"), (3, "u", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    con = duckdb.connect()
    con.register("pages", pages.toPandas().astype({"page_id": "Int64"}))
    want = con.sql(ORACLE["op3_warc"]).fetchall()
    got = sorted(map(tuple, warc.round_trip(pages).collect()), key=repr)
    assert len(got) == len(rows) and got == sorted(want, key=repr)
    warc.write(pages, str(tmp_path / "a"))
    records = warc.read(spark, str(tmp_path / "a")).collect()
    ids = {r.record_id for r in records}
    assert len(records) == len(ids) == 3 * len(rows)
    assert {r.refers_to for r in records if r.type == "revisit"} <= {r.record_id for r in records if r.type == "response"}
    assert sorted(bytes(r.payload).decode() for r in records if r.type == "response") == sorted(
        [a] * 4 + [b] * 2 + ["", "short", c, d, "x", "x"])
    assert sum("capture-id" not in r.fields for r in records if r.type == "metadata") == 5


def test_broken_archives():
    with pytest.raises(ValueError):
        list(warc.records_in(b"HTTP/1.1 200 OK\r\n\r\n"))
    with pytest.raises(ValueError):
        list(warc.records_in(b"WARC/1.0\r\nContent-Length: 10\r\n\r\nabc"))
    assert list(warc.records_in(b"\r\n\r\n")) == []


def test_long_payloads_have_files_of_their_own(spark, tmp_path, monkeypatch):
    """A run of long pages among short ones: no archive holds much more than FILE_BYTES, or one capture."""
    monkeypatch.setattr(warc, "FILE_BYTES", 200_000)
    rows = [(i, f"http://a.org/{i}", f"page {i} " + "x" * (i % 900)) for i in range(600)]
    rows += [(1000 + i, f"http://b.org/{i}", f"long {i} " + "y" * 150_000) for i in range(8)] + [(2000, "http://c.org/", "z" * 20_000_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    path = str(tmp_path / "warc")
    warc.write(pages, path, compression="none")
    sizes = sorted(r.length for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("length").collect())
    assert sizes[-1] < 20_010_000 and sizes[-2] < 200_000 * warc.LARGE and len(sizes) > 9
    got = {r.page_id: (r.payload_bytes, r.payload_digest) for r in warc.round_trip(pages).collect()}
    assert got == {i: (len(t), hashlib.sha1(t.encode()).hexdigest()) for i, _, t in rows}
