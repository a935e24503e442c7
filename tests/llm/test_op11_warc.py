import base64
import gzip
import hashlib
import random

import duckdb
import pytest

from tallyloom.llm import op11_warc as op
from tallyloom.operators.staging import run_scope
from tests.compare import same_rows

V1 = (b"filedesc://old.arc 0.0.0.0 19970917 text/plain 70\n1 0 Some Body\nURL IP-address Archive-date Content-type Archive-length\n"
      b"\n\nhttp://a.org/one page 10.0.0.1 19970917101112 text/html 27\nHTTP/1.0 200 OK\r\n\r\n12\n\r\n45\n"
      b"\ndns:a.org 10.0.0.2 199709171011 text/dns 7\n1.2.3.4\n\nhttp://a.org/empty 10.0.0.1 1997091710 text/html 0\n\n")
V2_LIST = b"2 0 Some Body\nURL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length\n"
V2 = (b"filedesc://new.arc 0.0.0.0 20010101000000 text/plain 200 - - 0 new.arc %d\n" % len(V2_LIST) + V2_LIST +
      b"\nhttp://b.org/ 10.0.0.1 20010102030405 text/html 404 abc - 200 new.arc 30\nHTTP/1.1 404 No\nA: b\n\nhttp://\n")


def brute(pages):
    """Result rows of ``(page_id, html)`` in order."""
    full = [(i, (h or "").encode()) for i, h in pages]
    first = {}
    for n, (i, p) in enumerate(full):
        best = first.get(p)
        if best is None or (i is None, i or 0, n) < best[0]:
            first[p] = ((i is None, i or 0, n), i)
    out = []
    for n, (i, p) in enumerate(full):
        same = first[p][0] != (i is None, i or 0, n)
        out.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if same else "response", first[p][1] if same else None))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def awkward_pages(spark):
    html = "<p>x</p>" * 40_000 + "\r\n\r\nWARC/1.1\r\n\n\nhttp://z 0 0 0 9\n"
    rows = [(5, "http://a", "same"), (3, "http://b c\n", "same"), (3, None, "same"), (9, "", None), (None, "u", ""), (None, "v", "only null"),
            (None, "v", "only null"), (7, "http://é\x85 \t", html), (8, "w", html), (-4, "w", html), (10, "w", "\r\n\r\n"), (11, "x", "HTTP/1.1 200 OK\r\n\r\nz"),
            (12, "y", "é漢😀"), (1 << 62, "z", f"{op.KEY_HEADER}: 3\r\n")]
    return spark.createDataFrame([(*r, "clash") for r in rows], "page_id bigint, url string, html string, record_id string").withColumnRenamed("record_id", "type")


def test_query(spark, sf_dir, duck):
    assert same_rows(op.query(spark, sf_dir), duck, op.SQL) > 0


def test_copies_awkward_and_empty(spark, tmp_path):
    pages = awkward_pages(spark)
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    want = brute([(r.page_id, r.html) for r in pages.collect()])
    assert got(op.query(spark, str(tmp_path))) == want
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
        same_rows(op.query(spark, str(tmp_path)), con, op.SQL)
    pages.limit(0).write.parquet(f"{tmp_path}/none/pages.parquet")
    none = op.query(spark, f"{tmp_path}/none")
    assert none.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"] and none.count() == 0


def test_many_archives_and_hot_payloads(spark, tmp_path, monkeypatch):
    """A third of the rows are copies of one page; the join by frequency gives what a plain one does."""
    rng = random.Random(1)
    rows = [(i, f"http://h/{i}", "hot" if i % 3 == 0 else f"text {rng.randint(0, 900)}") for i in range(3000)]
    spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(5).write.parquet(f"{tmp_path}/pages.parquet")
    assert got(op.query(spark, str(tmp_path))) == brute([(r[0], r[2]) for r in rows])


def test_round_trip_of_payloads(spark, tmp_path):
    """Any bytes survive both formats, compressed or not, and digests in the files agree."""
    rows = [(i, f"http://h/{i}", bytes(random.Random(i).randbytes(i * 997 % 5000)) + b"\r\n\r\n\n" * (i % 3)) for i in range(60)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html binary").repartition(3)
    for compression in ("gzip", None):
        with run_scope(spark) as folder:
            op.write_arc(df, f"{folder}/arc", compression=compression)
            arc = op.read_arc(spark, f"{folder}/arc", op.KEY_HEADER)
            assert {r.key: bytes(r.payload) for r in arc.collect()} == {r[0]: r[2] for r in rows}
            op.convert(spark, f"{folder}/arc", f"{folder}/warc", key_header=op.KEY_HEADER, least=1, compression=compression)
            found = op.read_warc(spark, f"{folder}/warc", op.KEY_HEADER).collect()
            assert {r.key: bytes(r.payload) for r in found if r.type == "response"} == {r[0]: r[2] for r in rows}
            assert {r.error for r in found} == {None}
            assert {(r.key, r.record_id, r.url, r.date) for r in found} == {(r.key, r.record_id, r.url, r.date) for r in arc.collect()}
            assert arc.select("version").distinct().count() == 2


def write_bytes(folder, name, data):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(data)


def test_legacy_files(spark, tmp_path):
    write_bytes(tmp_path / "arc", "a.arc", V1)
    write_bytes(tmp_path / "arc", "b.arc.gz", gzip.compress(V2[:V2.index(b"\nhttp") + 1]) + gzip.compress(V2[V2.index(b"\nhttp") + 1:]))  # a member a record
    rows = {r.url: r for r in op.read_arc(spark, str(tmp_path / "arc")).collect()}
    assert {(r.url, r.version, r.type, r.date, bytes(r.payload)) for r in rows.values()} == {
        ("http://a.org/one page", 1, "response", "1997-09-17T10:11:12Z", b"12\n\r\n45\n"), ("dns:a.org", 1, "resource", "1997-09-17T10:11:00Z", b"1.2.3.4"),
        ("http://a.org/empty", 1, "resource", "1997-09-17T10:00:00Z", b""), ("http://b.org/", 2, "response", "2001-01-02T03:04:05Z", b"http://\n")}
    assert rows["http://b.org/"].record_id == op.record_name("new.arc", V2.index(b"http://b"))
    op.convert(spark, str(tmp_path / "arc"), str(tmp_path / "warc"))
    assert {(r.url, r.type) for r in op.read_warc(spark, str(tmp_path / "warc")).collect()} == {(r.url, r.type) for r in rows.values()}


@pytest.mark.parametrize("data, records, reason", [
    (V1[:V1.index(b"3.4")], 1, "declared"), (V1.replace(b"text/dns 7", b"text/dns x"), 1, "no URL record"), (V1.replace(b"\n1 0 Some", b"\n7 0 Some"), 0, "unknown version"),
    (b"http://a 1 2 3 0\n", 0, "no URL record"), (V1.replace(b"plain 70\n1", b"plain 70\n2"), 0, "listed fields"), (b"\x1f\x8b broken", 0, "Error"), (b"", 0, None)])
def test_damage_ends_a_file_with_a_row(spark, tmp_path, data, records, reason):
    write_bytes(tmp_path / "arc", "a.arc", data)
    write_bytes(tmp_path / "arc", "b.arc", V2)
    rows = op.read_arc(spark, str(tmp_path / "arc")).collect()
    bad = [r for r in rows if r.type == "damaged"]
    assert len(rows) - len(bad) == records + 1 and [reason in r.error for r in bad] == ([True] if reason else [])


def test_changed_warc_is_told(spark, tmp_path):
    write_bytes(tmp_path / "arc", "a.arc", V2)
    op.convert(spark, str(tmp_path / "arc"), str(tmp_path / "warc"), compression=None)
    file = next((tmp_path / "warc").glob("*.txt"))
    data = file.read_bytes()
    write_bytes(tmp_path / "bad", "a.warc", data.replace(b"\n\nhttp://", b"\n\nhttp:/x"))
    write_bytes(tmp_path / "short", "a.warc", data[:-12])
    assert [r.error for r in op.read_warc(spark, str(tmp_path / "bad")).collect()] == ["payload digest differs"]
    assert [r.type for r in op.read_warc(spark, str(tmp_path / "short")).collect()] == ["damaged"]


def test_dates_and_urls():
    assert [op.iso_date(x) for x in ("19991231235959", "19991231", "1999123", "x", "")] == ["1999-12-31T23:59:59Z", "1999-12-31T00:00:00Z", None, None, None]
    assert op.escaped("a b\r\nc") == "a%20b%0D%0Ac" and op.escaped(None) == op.escaped("") == "-"
