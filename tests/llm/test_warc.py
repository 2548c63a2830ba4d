"""Archives from here and from elsewhere, both ARC versions, revisits, damaged input, the query against SQL."""

import gzip
import hashlib
import uuid

import duckdb
import pytest

from docflow.llm import warc as w
from docflow.llm.common import materialise
from docflow.llm.queries import ORACLES


def http(payload, status=b"HTTP/1.1 200 OK"):
    return status + b"\r\nContent-Type: text/html\r\n\r\n" + payload


#: Written by hand, as old crawlers wrote them: dns records, spaces in urls, short dates, parameters in content types, no header of ours.
def version_1():
    body = b"1 0 Crawler Inc\nURL IP-address Archive-date Content-type Archive-length\n"
    page, dns, late = http(b"<p>one</p>"), b"20010203040506\nexample.org. 3600 IN A 1.2.3.4\n", http(b"x" * 150)
    return b"".join(
        [
            b"filedesc://old.arc 0.0.0.0 200102030405 text/plain %d\n" % len(body), body, b"\n",
            b"dns:example.org 9.9.9.9 20010203040506 text/dns %d\n" % len(dns), dns, b"\n",
            b"http://example.org/a b c.html 1.2.3.4 200102030405 text/html; charset=iso-8859-1 %d\n" % len(page), page, b"\n",
            b"http://example.org/late 1.2.3.4 20010203040507 text/html %d\n" % len(late), late, b"\n",
            b"ftp://example.org/file 1.2.3.4 20010203040508123 application/zip 4\n", b"PK\x03\x04", b"\n",
        ]
    )


def version_2():
    body = b"2 0 Crawler Inc\nURL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length\n"
    page, copy = http(b"<p>two</p>", b"HTTP/1.0 404 Not Found"), http(b"x" * 150)
    return b"".join(
        [
            b"filedesc://new.arc 0.0.0.0 20020101000000 text/plain 200 - - 0 new.arc %d\n" % len(body), body, b"\n",
            b"http://example.org/two 1.2.3.4 20020102 text/html 404 abc - 200 new.arc %d\n" % len(page), page, b"\n",
            b"http://example.org/copy 1.2.3.4 99999999999999 text/html 200 abc http://to 300 new.arc %d\n" % len(copy), copy, b"\n",
        ]
    )


def test_foreign_records():
    one, two = list(w.read_arc(version_1())), list(w.read_arc(version_2()))
    assert [r.url for r in one] == ["filedesc://old.arc", "dns:example.org", "http://example.org/a b c.html", "http://example.org/late", "ftp://example.org/file"]
    assert [r.version for r in one + two] == [1] * 5 + [2] * 3 and one[2].content_type == "text/html; charset=iso-8859-1"
    assert [r.status for r in two] == ["200", "404", "200"] and two[1].block.endswith(b"<p>two</p>")
    assert [w.kind_of(r)[0] for r in one] == ["warcinfo", "resource", "response", "response", "resource"]
    assert [w.kind_of(r)[1] for r in one] == ["application/warc-fields", "text/dns", *["application/http; msgtype=response"] * 2, "application/zip"]


@pytest.mark.parametrize(
    ("digits", "iso"),
    [("20010203040506", "2001-02-03T04:05:06Z"), ("200102030405", "2001-02-03T04:05:00Z"), ("20010203", "2001-02-03T00:00:00Z"), ("2001", "2001-01-01T00:00:00Z"), ("20010203040506123", "2001-02-03T04:05:06.123Z"), ("99999999999999", None), ("-", None), ("20010203٠٤", None)],
)
def test_dates(digits, iso):
    assert w.warc_date(digits) == iso


def converted(spark, archives, **how):
    known = materialise(w.originals(archives), "test")
    return [gzip.decompress(r.record) for r in w.convert(archives, known, **how).selectExpr("cast(record as binary) as record").collect()]


@pytest.mark.parametrize("limit", [32 << 20, 0])
def test_foreign_archives_become_warc(spark, limit):
    archives = spark.createDataFrame([("old.arc", version_1(), "x"), ("new.arc", version_2(), "y")], "name string, content binary, offset string")
    out = [next(iter(w.read_warc(r))) for r in converted(spark, archives, max_broadcast_bytes=limit)]
    by = {h.get("warc-target-uri", h.get("warc-filename")): (h, b) for h, b in out}
    assert len(out) == len(by) == 8 and len({h["warc-record-id"] for h, _ in out}) == 8
    assert all(uuid.UUID(h["warc-record-id"][10:-1]).version == 8 and uuid.UUID(h["warc-record-id"][10:-1]).variant == uuid.RFC_4122 for h, _ in out)
    info, body = by["old.arc"]
    assert info["warc-type"] == "warcinfo" and info["warc-date"] == "2001-02-03T04:05:00Z" and b"Crawler Inc" in body
    dns, body = by["dns:example.org"]
    assert (dns["warc-type"], dns["content-type"], dns["warc-ip-address"]) == ("resource", "text/dns", "9.9.9.9") and body.startswith(b"2001")
    page, body = by["http://example.org/a%20b%20c.html"]
    assert (page["warc-type"], page["warc-date"]) == ("response", "2001-02-03T04:05:00Z") and page["warc-payload-digest"] == "sha256:" + hashlib.sha256(b"<p>one</p>").hexdigest()
    # Equal payloads: the first by archive name stays.
    first, copy = by["http://example.org/copy"][0], by["http://example.org/late"][0]
    assert first["warc-type"] == "response" and first["warc-date"] == "2002-01-01T00:00:00Z"
    assert copy["warc-type"] == "revisit" and copy["warc-refers-to"] == first["warc-record-id"] and copy["warc-refers-to-target-uri"] == "http://example.org/copy" and copy["x-payload-length"] == "150"
    assert by["http://example.org/late"][1] == http(b"")


def test_broken_places_are_rows(spark):
    good = version_1()
    junk = good.replace(b"\ndns:example.org 9.9.9.9 20010203040506 text/dns", b"\ndns:example.org bad line text/dns")
    cases = {"junk": junk, "cut": good[:-3], "version": good.replace(b"1 0 Crawler", b"7 0 Crawler"), "none": b"", "text": b"no archive\nat all", "headless": good[good.index(b"dns:") :]}
    archives = spark.createDataFrame(list(cases.items()), "name string, content binary")
    found = {}
    for r in w.quarantine(archives).collect():
        found.setdefault(r.name, []).append((r.reason, r.line[:12]))
    assert found == {"junk": [("no header line", "dns:example.")], "cut": [("the record is cut off", "ftp://exampl")], "version": [("unknown version 7", "filedesc://o")], "text": [("no header line", "no archive")]}
    kept = {k: [r.url for r in w.read_arc(v) if isinstance(r, w.ArcRecord)] for k, v in cases.items()}
    whole = [r.url for r in w.read_arc(good)]
    assert kept["junk"] == [whole[0], *whole[2:]] and kept["cut"] == whole[:-1] and kept["version"] == kept["headless"] == whole[1:] and kept["text"] == kept["none"] == []


@pytest.mark.parametrize("version", [1, 2])
def test_arc_round_trip(version):
    records = [("http://a/b c\n", "text/html", http(b"\n\nURL 0 0 x 5\n")), ("", "image/png", bytes(range(256))), ("http://é", "text/html", http(b""))]
    out = list(w.read_arc(w.write_arc("x.arc", version, records)))[1:]
    assert [r.block for r in out] == [r[2] for r in records] and [r.version for r in out] == [version] * 3
    assert [r.url for r in out] == ["http://a/b%20c%0A", "-", "http://é"] and out[1].content_type == "image/png" and out[0].status == ("200" if version == 2 else "")


@pytest.mark.parametrize("pack", [bytes, gzip.compress, lambda d: b"".join(gzip.compress(d[k : k + 70]) + gzip.compress(b"") for k in range(0, len(d), 70))])
def test_warc_reader(pack):
    arcs = list(w.read_arc(w.write_arc("x", 2, [("u", "t/t", http(b"x" * 200)), ("u", "t/t", http(b"WARC/1.1\r\n\r\n" * 30)), ("u", "t/t", http(b"x" * 200))])))[1:]
    first = w.Original(w.record_id("x", arcs[0]), "u", "2020-01-01T00:00:00Z", 5)
    data = b"".join(w.warc_record("x", a, source=k, original=o) for k, (a, o) in enumerate(zip(arcs, (None, None, first), strict=True)))
    out = list(w.read_warc(pack(data)))
    assert [o["warc-type"] for o, _ in out] == ["response", "response", "revisit"] and [o["x-source-id"] for o, _ in out] == ["0", "1", "2"]
    assert out[0][1] == arcs[0].block and out[2][1] == w.split_http(arcs[2].block)[0] and out[2][0]["x-refers-to-source-id"] == "5"
    assert out[0][0]["warc-payload-digest"] == "sha256:" + hashlib.sha256(b"x" * 200).hexdigest() == out[2][0]["warc-payload-digest"]
    for bad in (data[:-2], data[:-40], data.replace(b"\r\nContent-Length: 2", b"\r\nContent-Length: 1", 1), data.replace(b"xxx", b"xyx", 1)):
        with pytest.raises(ValueError):
            list(w.read_warc(pack(bad)))
    with pytest.raises(ValueError):
        list(w.read_warc(gzip.compress(data)[:-5]))


ROWS = [(5, "u", "é" * 50), (3, "u", "é" * 50), (9, None, "é" * 50), (1, "u", "s" * 99), (2, "u", "s" * 99), (7, "u", None), (8, "u", ""), (-4, "u v", "<p>\r\n\r\n" * 40), (3, "again", "é" * 50), (None, "u", "é" * 50), (None, "n", "n" * 120), (None, "n", "n" * 120), (10, "u", "x" * 3_000_000)]
#: Rows that share an id with other payloads.
ROWS += [(21, "u", "a" * 200), (22, "u", "b" * 200), (27, "u", "a" * 200), (27, "u", "b" * 200), (27, "u", "c" * 200), (27, "u", "c" * 200), (27, "u", "short")]


@pytest.mark.parametrize("empty", [False, True])
def test_query(spark, tmp_path, empty):
    path = str(tmp_path / "pages.parquet")
    df = spark.createDataFrame([(*r, "n", b"c") for r in ROWS], "page_id long, url string, html string, name string, content binary")
    (df.limit(0) if empty else df).write.parquet(path)
    out = [tuple(r) for r in w.op1_warc(spark, str(tmp_path)).collect()]
    db = duckdb.connect()
    db.execute(f"CREATE VIEW pages AS SELECT * FROM '{path}/*.parquet'")
    want = db.execute(ORACLES["op1_warc"]).fetchall()
    assert len(out) == (0 if empty else len(ROWS)) and sorted(map(repr, out)) == sorted(map(repr, want))
    if not empty:
        by = {(r[0], r[2]): r[3:] for r in out}
        long, other = (hashlib.sha256(x.encode()).hexdigest() for x in ("é" * 50, "c" * 200))
        assert by[3, long] == ("response", None) and by[5, long] == by[9, long] == by[None, long] == ("revisit", 3) and by[27, other] == ("response", None)
        assert sorted(r[3] for r in out if r[2] == hashlib.sha256(b"n" * 120).hexdigest()) == ["response", "revisit"]


def test_files_hold_one_member_a_record(spark, tmp_path):
    pages = spark.createDataFrame([(k, f"http://h/{k}", f"<p>{k}</p>" * 30) for k in range(25)], "page_id long, url string, html string").coalesce(1)
    archives = materialise(w.archive_pages(pages), "test")
    path = str(tmp_path / "out")
    w.write_warc(w.convert(archives, materialise(w.originals(archives), "test")), path, per_file=10)
    files = sorted((tmp_path / "out").glob("part-*"))
    assert len(files) == 3
    for f in files:
        data = f.read_bytes()
        # Each piece between separators is a record by itself.
        pieces = data.split(w._EMPTY_MEMBER)
        assert pieces[-1] == b"" and all(len(list(w.read_warc(x))) == 1 for x in pieces[:-1])
        assert len(list(w.read_warc(data))) == len(pieces) - 1 and gzip.decompress(data).startswith(b"WARC/1.1\r\n")
    assert w.read_archives(spark, path).count() == 25
