import gzip
import hashlib

from helixframe.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, payload string, refers_to string, n int"


def pages(spark):
    big, other = "a\r\n\r\nWARC/1.1\r\n" + "é" * 800, "b" * 999
    rows = [(1, "http://a/1", big), (9, "http://a/9", big), (4, "http://a/4\r\nX: y", big), (2, None, other), (3, "u", other), (5, "u", ""), (6, "u", None), (7, "u", "c" * 1000), (8, "u", "c" * 1000), (8, "u", "c" * 1000), (None, "u", big), (None, "u", "d" * 2000), (10, "u", "x\r\n\r\n"), (11, "u", "z" * 300_000)]
    return spark.createDataFrame([(*r, "q", "q", "q", 1) for r in rows], SCHEMA)


def brute(rows):
    out = []
    for r in rows:
        payload = (r.html or "").encode()
        same = [x.page_id for x in rows if (x.html or "") == (r.html or "") and x.page_id is not None]
        again = len(payload) >= 1000 and sum((x.html or "") == (r.html or "") for x in rows) > 1 and same and r.page_id != max(same)
        out.append((r.page_id, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if again else "response", max(same) if again else None))
    return sorted(out, key=str)


def test_against_brute_force(spark):
    df = pages(spark)
    got = warc.revisit_table(df)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(df.collect())


def test_many_revisits_are_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(warc, "MOST_SENT", 0)
    df = pages(spark)
    assert sorted(map(tuple, warc.revisit_table(df).collect()), key=str) == brute(df.collect())


def test_archives_hold_payloads_once(spark, tmp_path):
    df = pages(spark)
    path = str(tmp_path / "warc")
    warc.write_archives(df.repartition(2), path, archive_bytes=4000)
    files = list((tmp_path / "warc").glob("part-*"))
    data = b"".join(gzip.decompress(f.read_bytes()) for f in files)
    assert len(files) > 2
    assert data.count("é".encode() * 800) == 1
    assert data.startswith(b"WARC/1.1\r\n") and data.endswith(b"\r\n\r\n")
    records = warc.read_archives(spark, path).collect()
    assert len(records) == df.count()
    for r in records:
        if r.record_type == "response":
            assert hashlib.sha1(r.payload).hexdigest() == r.payload_digest
        else:
            assert r.payload == b"" and r.refers_to_id in {x.record_id for x in records if x.record_type == "response"}


def test_revisit_without_its_response_stays(spark, tmp_path):
    df = pages(spark)
    warc.write_archives(df, str(tmp_path / "warc"))
    records = warc.read_archives(spark, str(tmp_path / "warc"))
    left = records.where("record_type = 'revisit'")
    got = warc.resolved(left).collect()
    assert len(got) == left.count() > 0
    told = {(r.page_id, r.payload_digest) for r in left.collect()}
    assert {(r.page_id, r.payload_digest) for r in got} == told
    assert all(r.payload_bytes is None and r.refers_to is None and r.record_type == "revisit" for r in got)


def test_foreign_archives(spark, tmp_path):
    """Other names, a gzip member for each record, plain files, and records that hold no page."""
    df = pages(spark)
    warc.write_archives(df, str(tmp_path / "own"))
    data = b"".join(gzip.decompress(f.read_bytes()) for f in (tmp_path / "own").glob("part-*"))
    info = b"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:i>\r\nContent-Type: application/warc-fields\r\nContent-Length: 4\r\n\r\na: b\r\n\r\n"
    asked = b"WARC/1.1\r\nWARC-Type: request\r\nWARC-Record-ID: <urn:r>\r\nContent-Type: application/http; msgtype=request\r\nContent-Length: 5\r\n\r\nGET /\r\n\r\n"
    at, pieces = 0, [info, asked]
    while at < len(data):
        head = data.index(b"\r\n\r\n", at) + 4
        end = head + int(data[at:head].split(b"Content-Length: ")[-1].split(b"\r\n")[0]) + 4
        pieces.append(data[at:end])
        at = end
    half = len(pieces) // 2
    away = tmp_path / "away" / "deep"
    away.mkdir(parents=True)
    (away / "CC-MAIN-0.warc.gz").write_bytes(b"".join(map(gzip.compress, pieces[:half])) + b"\0" * 99)
    (away / "rest.warc").write_bytes(b"".join(pieces[half:]))
    records = warc.read_archives(spark, str(tmp_path / "away"))
    assert records.count() == df.count() + 2
    got = warc.resolved(records).selectExpr("cast(page_id as long)", "payload_bytes", "payload_digest", "record_type", "cast(refers_to as long)")
    assert sorted(map(tuple, got.collect()), key=str) == brute(df.collect())


def test_many_members_are_read_once():
    data = gzip.compress(b"x" * 50) * 20_000
    assert warc._unzipped(data) == b"x" * 1_000_000


def test_empty_table(spark):
    assert warc.revisit_table(pages(spark).limit(0)).count() == 0
