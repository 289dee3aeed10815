import gzip
import hashlib

from quern.llm import queries, warc
from quern.llm.workspace import new_path

PAGES = "page_id bigint, url string, html string"


def _pages(spark, rows):
    return spark.createDataFrame(rows, PAGES)


def test_round_trip_with_revisits(spark):
    big = "<p>" + "é" * 900 + "</p>"
    rows = [(1, "http://a/1", big), (2, "http://a/2", big), (9, "http://a/9", big), (3, None, None), (4, "http://a/4", "short"), (5, "http://a/5", "short"), (6, "http://a\r\nX: y", "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n" * 3), (7, "u", "\x00\x01 \r\n\r\n tail\r\n")]
    got = {}
    for r in warc.round_trip(_pages(spark, rows)).collect():
        page = int(r["metadata"][0]["fields"].split("pageId: ")[1].split()[0])
        got[page] = r
    assert sorted(got) == [1, 2, 3, 4, 5, 6, 7, 9]
    assert {k: v["kind"] for k, v in got.items() if k in (1, 2, 9)} == {1: "revisit", 2: "revisit", 9: "response"}
    assert got[1]["refers_to"] == got[2]["refers_to"] == got[9]["record_id"]
    assert all(got[k]["kind"] == "response" for k in (3, 4, 5, 6, 7))
    for page, _, html in rows:
        body = (html or "").encode()
        assert got[page]["declared_bytes"] == len(body)
        assert got[page]["payload_digest"] == "sha1:" + hashlib.sha1(body).hexdigest()
        assert got[page]["request"] is not None
        if got[page]["kind"] == "response":
            assert got[page]["payload_sha1"] == hashlib.sha1(body).hexdigest()


def test_empty_and_extra_columns(spark):
    assert warc.round_trip(_pages(spark, [])).count() == 0
    df = _pages(spark, [(1, "u", "x")]).selectExpr("*", "'c' AS digest", "'c' AS salt", "'c' AS key", "'c' AS value")
    assert warc.round_trip(df).count() == 1


def _record(kind, rid, block=b"", **more):
    lines = [f"WARC-Type: {kind}", f"WARC-Record-ID: {rid}"] + [f"{k.replace('_', '-')}: {x}" for k, v in more.items() for x in (v if isinstance(v, list) else [v])]
    head = "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(block)}"]).encode()
    return head + b"\r\n\r\n" + block + b"\r\n\r\n"


def test_links_in_either_direction_and_over_a_request(spark, tmp_path):
    data = [
        _record("warcinfo", "i"),
        _record("request", "q1", b"GET", Content_Type="application/http"),
        _record("response", "r1", b"HTTP/1.1 200\r\n\r\nbody\r\n\r\n", Content_Type="application/http", WARC_Concurrent_To="q1"),
        _record("metadata", "m1", b"a: b", WARC_Concurrent_To="q1"),
        _record("metadata", "m2", b"c: d", WARC_Concurrent_To=["r1", "q1"]),
        _record("response", "r2", b"HTTP/1.1 200\r\n\r\n", Content_Type="application/http"),
        _record("request", "q9", b"GET", WARC_Concurrent_To="gone"),
        _record("request", "q1", b"GET", Content_Type="application/http"),
    ]
    d = tmp_path / "w"
    d.mkdir()
    (d / "a.warc.gz").write_bytes(b"".join(gzip.compress(x) for x in data[:4]))
    (d / "b.warc").write_bytes(b"".join(data[4:]) + b"WARC/1.1\r\nContent-Length: 99\r\n\r\ncut")
    rows = {r["record_id"]: r for r in warc.assemble(spark, f"file://{d}").collect()}
    assert set(rows) == {"r1", "r2"}
    assert rows["r1"]["request"]["record_id"] == "q1"
    assert [m["record_id"] for m in rows["r1"]["metadata"]] == ["m1", "m2"]
    assert bytes(rows["r1"]["payload"]) == b"body\r\n\r\n"
    assert rows["r2"]["request"] is None and rows["r2"]["metadata"] == []


def _plain(rows):
    out = []
    for page, _, html in rows:
        body = (html or "").encode()
        least = lambda p: (p is not None, p or 0)
        same = [p for p, _, h in rows if (h or "") == (html or "")]
        lead = max(same, key=least)
        revisit = len(body) >= 1000 and lead != page
        out.append((page, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", lead if revisit else None, True))
    return sorted(out, key=str)


def test_a_row_per_page_whatever_its_id(spark):
    big = "é" * 600
    rows = [(None, "u", "small"), (None, "u", "small"), (None, None, big), (None, "u", big), (7, "u", big), (7, "u", big), (7, "u", "other"), (3, "u", big), (8, "u", None), (8, "u", None), (5, "u", "z" * 30_000), (4, "u", "z" * 30_000), (6, "u", "y" * 1_200_000), (2, "u", "x" * 999), (1, "u", "x" * 999)]
    got = sorted((tuple(r) for r in queries.captured_pages(_pages(spark, rows).repartition(3)).collect()), key=str)
    assert got == _plain(rows)
    lone = [(None, "u", big), (None, "u", big)]
    assert [tuple(r) for r in queries.captured_pages(_pages(spark, lone)).collect()] == _plain(lone)


def test_archives_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(warc, "CLASSES", ((20, 3), (100, 2), (None, 1)))
    path = new_path(spark, "t")
    warc.write_archives(_pages(spark, [(i, "u", "x" * (i * 13)) for i in range(20)]).coalesce(1), path)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).collect()
    sizes = [[len(b) for h, b in warc.parse_archive(bytes(f["content"])) if h["warc-type"] == ["response"]] for f in files]
    head = 80
    assert sum(map(len, sizes)) == 20 and all(len(s) <= 3 for s in sizes)
    assert all(len(s) <= 2 for s in sizes if max(s) >= head + 20) and all(len(s) == 1 for s in sizes if max(s) >= head + 100)


def test_broken_archives_are_read_as_far_as_they_go():
    good = _record("request", "q1", b"GET" * 700_000)
    assert [h["warc-record-id"] for h, _ in warc.parse_archive(good * 3)] == [["q1"]] * 3
    packed = gzip.compress(good) + gzip.compress(good)
    assert len(list(warc.parse_archive(packed))) == 2 and list(warc.parse_archive(packed))[1][1] == b"GET" * 700_000
    assert len(list(warc.parse_archive(packed[:-20]))) == 2 or len(list(warc.parse_archive(packed[:-20]))) == 1
    broken = gzip.compress(good) + b"\x1f\x8b" + b"\x00" * 50
    assert len(list(warc.parse_archive(broken))) == 1
    assert list(warc.parse_archive(good.replace(b"Content-Length: ", b"Content-Length: x"))) == []
    assert list(warc.parse_archive(b"")) == [] and list(warc.parse_archive(b"WARC")) == []


def test_archives_are_plain_records(spark):
    path = new_path(spark, "t")
    warc.write_archives(_pages(spark, [(1, "u", "x")]), path)
    data = b"".join(bytes(r["content"]) for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).collect())
    kinds = [h["warc-type"][0] for h, _ in warc.parse_archive(data)]
    assert kinds == ["request", "response", "metadata"]
