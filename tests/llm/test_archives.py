"""ARC volumes and their conversion to WARC."""

import gzip
import io

import pytest
from oracle import duck, normal

from cliptrack.llm import arc_to_warc, shared
from cliptrack.llm.arc_to_warc import FIELDS, arc_records, warc_date, warc_record, warc_records

SCHEMA = "page_id long, url string, html string"


@pytest.fixture(autouse=True)
def _workers(spark):
    shared.visible(spark)


def volume(version, records):
    block = f"{version} 0 Somebody\n{FIELDS[version]}\n\n".encode()
    middle = "200 - - 0 x.arc " if version == 2 else ""
    out = f"filedesc://x.arc 0.0.0.0 19990102030405 text/plain {middle}{len(block)}\n".encode() + block + b"\n"
    for url, date, mime, body in records:
        out += f"{url} 1.2.3.4 {date} {mime} {middle}{len(body)}\n".encode() + body + b"\n"
    return b"".join(gzip.compress(out[i : i + 50]) for i in range(0, len(out), 50))


BODIES = [
    ("http://a.example/", "19961231235959", "text/html", b"HTTP/1.0 200 OK\r\nA: b\r\n\r\nhttp://b 1 2 3 4\n\nno header line"),
    ("http://a.example/with space", "199612", "text/html", b""),
    ("dns:a.example", "19961231235959", "text/dns", b"a.example. 1 IN A 1.2.3.4"),
]


@pytest.mark.parametrize("version", [1, 2])
def test_records_are_read_by_version_and_length(version):
    read = list(arc_records(volume(version, BODIES)))
    assert [r.number for r in read] == [0, 1, 2, 3] and read[0].url == "filedesc://x.arc"
    assert [(r.url, r.date, r.mime, r.block) for r in read[1:]] == [tuple(b) for b in BODIES]
    assert {r.ip for r in read[1:]} == {"1.2.3.4"}


def test_broken_volumes_are_errors():
    whole = gzip.decompress(volume(1, BODIES))
    with pytest.raises(ValueError, match="ends after"):
        list(arc_records(gzip.compress(whole[:-20])))
    with pytest.raises(ValueError, match="header line"):
        list(arc_records(gzip.compress(whole.replace(b"text/dns 25", b"text/dns none"))))
    with pytest.raises(ValueError, match="version"):
        list(arc_records(gzip.compress(whole.replace(b"1 0 Somebody", b"9 0 Somebody"))))


def test_warc_records_say_what_arc_leaves_open():
    records = list(arc_records(volume(1, BODIES)))
    made = [warc_record("v", r) for r in records]
    first = {"id": "<urn:uuid:1>", "uri": "http://a", "date": "19961231235959"}
    made.append(warc_record("v", records[1], first))
    read = list(warc_records(b"".join(map(gzip.compress, made))))
    assert [h["warc-type"] for h, _ in read] == ["warcinfo", "response", "resource", "resource", "revisit"]
    assert [h["warc-date"] for h, _ in read[:3]] == ["1999-01-02T03:04:05Z", "1996-12-31T23:59:59Z", "1996-12-01T00:00:00Z"]
    assert read[1][1] == records[1].block and read[1][0]["warc-ip-address"] == "1.2.3.4"
    assert read[1][0]["warc-payload-digest"] == read[4][0]["warc-payload-digest"]
    assert read[4][0]["warc-refers-to"] == "<urn:uuid:1>" and read[4][1].endswith(b"A: b\r\n\r\n")
    assert len({h["warc-record-id"] for h, _ in read}) == 4  # the revisit is made of a record made before
    assert made == [warc_record("v", r) for r in records] + [made[-1]]


def test_dates_of_any_length():
    assert [warc_date(d) for d in ("1997", "19970315", "199703151230", "19970315123045678")] == [
        "1997-01-01T00:00:00Z",
        "1997-03-15T00:00:00Z",
        "1997-03-15T12:30:00Z",
        "1997-03-15T12:30:45Z",
    ]


def compare(spark, rows, folder):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'clash' as digest", "1 as number", "'x' as volume")
    df.repartition(4).write.parquet(f"{folder}/pages.parquet")
    got = arc_to_warc.op12_warc(spark, str(folder))
    connection = duck("/nowhere")
    connection.execute(f"create view pages as select * from '{folder}/pages.parquet/*.parquet'")
    want = connection.sql(arc_to_warc.OP12_SQL)
    found = [tuple(r) for r in got.collect()]
    assert normal(found, got.columns) == normal(want.fetchall(), want.columns)
    return found


def test_pages_come_back_as_sql_says(spark, tmp_path, monkeypatch):
    trap = "HTTP/1.1 200 OK\r\n\r\nWARC/1.1\r\n\r\nfiledesc://x 0.0.0.0 1 text/plain 3\n" * 5
    rows = [(1, None, None), (2, "http://a b/é", ""), (3, "x", "y" * 99), (4, "x", "y" * 99)]
    rows += [(9, "u", trap), (8, "u", trap), (7, "u", "\x00é漢" * 100), (None, None, trap)]
    rows += [(20, "u", "z" * 100)] * 30 + [(19, "u", "z" * 100), (None, "u", "w" * 100), (None, "u", "w" * 100)]
    rows += [(50, "u", "long " * 2_000_000)]
    found = compare(spark, rows, tmp_path)
    assert sum(r[3] == "revisit" for r in found) == 2 + 30 + 1


def test_volumes_are_closed_by_size(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://x/{i}", f"{i} " * 40) for i in range(50)], SCHEMA).coalesce(1)

    def small(batches):
        arc_to_warc.VOLUME = 1000
        return arc_to_warc._archive(batches)

    archive = arc_to_warc._write
    archive(
        pages.withColumn("html", pages["html"].cast("binary")).mapInArrow(small, arc_to_warc._RECORDS),
        f"{tmp_path}/arc",
    )
    volumes = arc_to_warc._volumes(spark, f"{tmp_path}/arc").collect()
    assert len(volumes) > 5
    openings = [next(iter(arc_records(v.content))).block[:1] for v in volumes]
    assert set(openings) == {b"1", b"2"}
    arc_to_warc.convert(spark, f"{tmp_path}/arc", f"{tmp_path}/warc")
    back = arc_to_warc.read_warc(spark, f"{tmp_path}/warc").collect()
    assert sorted(r.page_id for r in back) == list(range(50))
    some = arc_to_warc._volumes(spark, f"{tmp_path}/warc").first().content
    assert gzip.GzipFile(fileobj=io.BytesIO(some)).read().startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")


def test_no_pages(spark, tmp_path):
    assert compare(spark, [], tmp_path) == []
