"""Legacy ARC archives, and their conversion to WARC.

An ARC volume opens with a `filedesc` record that names its version and the fields of its
header lines; version 1 has five, version 2 ten. Each record is such a line and as many
bytes as the line declares. The converter walks a volume by these lengths and synthesises
for every record what WARC wants and ARC lacks: an identifier (from volume and place, so
that a task that runs again gives the same), a timestamp, a type, digests of block and
payload, and for a payload that another record holds already a `revisit` of that record.

Volumes hold one gzip member a record, as both formats recommend. Spark's text writer and
binaryFile reader move them, so any file system Spark knows will do: a row is a member,
and what stands between rows is an empty member, which unpacks to nothing.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cliptrack.llm.shared import shared_folder, visible, written

#: Unpacked bytes after which a volume is closed; a longer record is alone in its volume.
VOLUME = 64 << 20
#: Bytes of records that a task hands on at a time.
HELD = 8 << 20
#: Payloads below this many bytes are stored each time.
LEAST = 100
CRAWLED = "20000101000000"

# The fields of ARC's header lines by version, and WARC's names.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename "
    "Archive-length",
}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http; msgtype=response"

_LEVEL = 3
_EMPTY = zlib.compressobj(9, zlib.DEFLATED, 31).flush()
_PAGE = "X-Page-Id"


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(_LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class _Out:
    """Records of volumes as Arrow batches of bounded size."""

    schema = pa.schema([("volume", pa.string()), ("number", pa.int64()), ("record", pa.binary())])

    def __init__(self):
        self.rows, self.size = [], 0

    def add(self, volume: str, number: int, data: bytes) -> Iterator[pa.RecordBatch]:
        packed = _member(data)
        self.rows.append((volume, number, packed))
        self.size += len(packed)
        if self.size > HELD:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            arrays = [pa.array(c, f.type) for c, f in zip(zip(*self.rows, strict=True), self.schema, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=self.schema.names)
            self.rows, self.size = [], 0


_RECORDS = "volume string, number long, record binary"


def _write(records: DataFrame, folder: str) -> None:
    """Records in volumes, one file a volume, in the order of their numbers."""
    (
        records.sortWithinPartitions("volume", "number")
        .select("volume", F.col("record").cast("string").alias("value"))
        .write.partitionBy("volume")
        .option("encoding", "ISO-8859-1")
        .option("lineSep", _EMPTY.decode("latin-1"))
        .text(folder)
    )


def _volumes(spark: SparkSession, folder: str) -> DataFrame:
    """(volume, content) of every volume in a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.select(F.regexp_extract("path", r"volume=([^/]+)/", 1).alias("volume"), "content")


# -- ARC ----------------------------------------------------------------------


def _plain(url: str | None, page_id: int | None) -> str:
    """An address without white space, control or other than ASCII characters."""
    if not url:
        return f"urn:page:{'' if page_id is None else page_id}"
    return re.sub(rb"[^\x21-\x7e]", lambda m: b"%%%02X" % m[0][0], url.encode("utf-8", "surrogatepass")).decode()


def arc_line(version: int, url: str, date: str, mime: str, size: int, name: str, offset: int) -> str:
    """A header line of that version."""
    if version == 1:
        return f"{url} 0.0.0.0 {date} {mime} {size}\n"
    return f"{url} 0.0.0.0 {date} {mime} 200 - - {offset} {name} {size}\n"


def _opening(version: int, name: str) -> bytes:
    block = f"{version} 0 cliptrack\n{FIELDS[version]}\n\n"
    return (arc_line(version, f"filedesc://{name}", CRAWLED, "text/plain", len(block), name, 0) + block + "\n").encode()


def _response(page_id: int | None, html: bytes) -> bytes:
    own = "" if page_id is None else f"{_PAGE}: {page_id}\r\n"
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{own}Content-Length: {len(html)}\r\n\r\n"
    return head.encode() + html


def _archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages as records of ARC volumes, versions in turn."""
    task = TaskContext.get().partitionId()
    out, volume, size, number, version, count = _Out(), None, 0, 0, 1, 0
    for batch in batches:
        for at in range(batch.num_rows):
            page_id, url, html = (batch.column(c)[at].as_py() for c in ("page_id", "url", "html"))
            block = _response(page_id, html)
            if volume is None or size + len(block) > VOLUME:
                volume, version = f"{task:06d}-{count:05d}", (task + count) % 2 + 1
                count, size, number = count + 1, 0, 0
                yield from out.add(volume, 0, _opening(version, f"{volume}.arc.gz"))
            line = arc_line(version, _plain(url, page_id), CRAWLED, "text/html", len(block), f"{volume}.arc.gz", size)
            number, size = number + 1, size + len(block)
            yield from out.add(volume, number, line.encode() + block + b"\n")
    yield from out.rest()


def write_arc(pages: DataFrame, folder: str) -> None:
    """Pages (page_id, url, html) as ARC volumes; a null html is empty.

    A page is archived as the HTTP response that brought it, with its page_id as a header;
    without one if that is null. Volumes are closed by size, so no page is cut.
    """
    visible(pages.sparkSession)
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        "url",
        F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("html"),
    )
    _write(rows.mapInArrow(_archive, _RECORDS), folder)


class Record(NamedTuple):
    """A record of an ARC volume; number 0 is the volume's own."""

    number: int
    url: str
    ip: str
    date: str
    mime: str
    block: bytes


def arc_records(content: bytes) -> Iterator[Record]:
    """The records of a volume, by the header lines of its version and declared lengths."""
    source = gzip.GzipFile(fileobj=io.BytesIO(content))
    fields, number = FIELDS[1].split(), 0
    while line := source.readline():
        if not line.strip():
            continue
        text = line.decode("latin-1").rstrip("\r\n")
        if number == 0:
            # The opening tells by its own number of fields which version it has.
            fields = FIELDS[2 if len(text.split(" ")) >= 10 else 1].split()
        # Only the address may hold spaces.
        parts = text.rsplit(" ", len(fields) - 1)
        if len(parts) != len(fields) or not parts[-1].isdigit():
            raise ValueError(f"not a header line of {len(fields)} fields: {text[:200]!r}")
        named = dict(zip(fields, parts, strict=True))
        size = int(named["Archive-length"])
        block = source.read(size)
        if len(block) != size:
            raise ValueError(f"record {number} ends after {len(block)} of {size} bytes")
        if number == 0:
            told = block.decode("latin-1").split("\n")
            if told[0][:1] not in ("1", "2"):
                raise ValueError(f"ARC version {told[0]!r}")
            fields = told[1].split()
        yield Record(number, named["URL"], named["IP-address"], named["Archive-date"], named["Content-type"], block)
        number += 1


# -- WARC ---------------------------------------------------------------------


def warc_date(date: str) -> str:
    """ARC's digits as WARC's timestamp; digits that are missing are the least ones."""
    filled = (date + "00000101000000"[len(date) :])[:14]
    return datetime.strptime(filled, "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ")


def record_id(volume: str, number: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'arc:{volume}:{number}')}>"


def _sha256(data: bytes) -> str:
    return f"sha256:{hashlib.sha256(data).hexdigest()}"


def http_parts(block: bytes) -> tuple[dict[str, str], int] | None:
    """(headers by name in lower case, where the payload begins); None if it is no HTTP."""
    if not block.startswith(b"HTTP/"):
        return None
    end = block.find(b"\r\n\r\n")
    if end < 0:
        return None
    pairs = (line.partition(":") for line in block[:end].decode("latin-1").split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs}, end + 4


def warc_record(volume: str, record: Record, first: dict | None = None) -> bytes:
    """The WARC record of an ARC record; a revisit of `first` (id, uri, date) if given."""
    http = http_parts(record.block)
    block, head = record.block, [("WARC-Record-ID", record_id(volume, record.number))]
    head.append(("WARC-Date", warc_date(record.date)))
    if record.number == 0:
        kind, mime = "warcinfo", "application/warc-fields"
        block = f"software: cliptrack\r\nformat: WARC File Format 1.1\r\nisPartOf: {record.url}\r\n".encode()
        head.append(("WARC-Filename", f"{volume}.warc.gz"))
    else:
        head.append(("WARC-Target-URI", record.url))
        if record.ip != "0.0.0.0":
            head.append(("WARC-IP-Address", record.ip))
        if http is None:
            kind, mime = "resource", record.mime
            head.append(("WARC-Payload-Digest", _sha256(block)))
        else:
            kind, mime = "response", HTTP_TYPE
            head.append(("WARC-Payload-Digest", _sha256(memoryview(block)[http[1] :])))
            if first is not None:
                kind, block = "revisit", block[: http[1]]
                head += [
                    ("WARC-Profile", PROFILE),
                    ("WARC-Refers-To", first["id"]),
                    ("WARC-Refers-To-Target-URI", first["uri"]),
                    ("WARC-Refers-To-Date", warc_date(first["date"])),
                ]
    head += [("WARC-Block-Digest", _sha256(block)), ("Content-Type", mime), ("Content-Length", str(len(block)))]
    lines = "".join(f"{name}: {value}\r\n" for name, value in [("WARC-Type", kind), *head])
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the search for equal payloads has to know of each archived response."""
    names = ["volume", "number", "page_id", "digest", "size", "id", "uri", "date"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
    for batch in batches:
        for at in range(batch.num_rows):
            volume, rows = batch.column("volume")[at].as_py(), []
            for record in arc_records(batch.column("content")[at].as_py()):
                http = http_parts(record.block)
                if record.number and http is not None:
                    page, payload = http[0].get(_PAGE.lower()), memoryview(record.block)[http[1] :]
                    rows.append(
                        (volume, record.number, None if page is None else int(page), _sha256(payload), len(payload))
                        + (record_id(volume, record.number), record.url, record.date)
                    )
            columns = zip(*rows, strict=True) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


_DESCRIBED = "volume string, number long, page_id long, digest string, size long, id string, uri string, date string"
_FIRST = "number long, id string, uri string, date string"


def _convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = _Out()
    for batch in batches:
        for at in range(batch.num_rows):
            volume = batch.column("volume")[at].as_py()
            firsts = {f["number"]: f for f in batch.column("firsts")[at].as_py() or []}
            for record in arc_records(batch.column("content")[at].as_py()):
                made = warc_record(volume, record, firsts.get(record.number))
                yield from out.add(volume, record.number, made)
    yield from out.rest()


def convert(spark: SparkSession, arcs: str, warcs: str) -> None:
    """The ARC volumes of one folder as WARC volumes in another.

    Of responses with equal payloads of at least LEAST bytes the one with the smallest
    page_id (none: last; ties: the first in its archive) is kept; the others become
    revisits of it. What is compared are digests and places; a volume gets the list of its
    own revisits.
    """
    visible(spark)
    found = written(_volumes(spark, arcs).mapInArrow(_described, _DESCRIBED)).where(F.col("size") >= LEAST)
    rank = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "volume", "number", "id", "uri", "date")
    firsts = (
        found.groupBy("digest")
        .agg(F.min(rank).alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", "first")
    )
    again = (
        found.select("digest", "volume", "number")
        .join(firsts, "digest")
        .where((F.col("volume") != F.col("first.volume")) | (F.col("number") != F.col("first.number")))
        .groupBy("volume")
        .agg(F.collect_list(F.struct("number", "first.id", "first.uri", "first.date")).alias("firsts"))
    )
    # Written, so that Spark knows its size: where it is small, no volume moves for it.
    again = written(again)
    _write(_volumes(spark, arcs).join(again, "volume", "left").mapInArrow(_convert, _RECORDS), warcs)


def warc_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers by name in lower case, block) of every record of a volume."""
    source = gzip.GzipFile(fileobj=io.BytesIO(content))
    while line := source.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/1."):
            raise ValueError(f"not a WARC record: {line[:100]!r}")
        head = {}
        while (line := source.readline()).strip():
            name, _, value = line.decode("utf-8").partition(":")
            head[name.strip().lower()] = value.strip()
        size = int(head["content-length"])
        block = source.read(size)
        if len(block) != size:
            raise ValueError(f"a record ends after {len(block)} of {size} bytes")
        yield head, block


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "id", "first"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string()]
    for batch in batches:
        for content in batch.column("content"):
            rows = []
            for head, block in warc_records(content.as_py()):
                kind = head["warc-type"]
                if kind not in ("response", "revisit"):
                    continue
                if _sha256(block) != head["warc-block-digest"]:
                    raise ValueError(f"{head['warc-record-id']} has another block digest")
                named, start = http_parts(block)
                size, digest = int(named["content-length"]), head["warc-payload-digest"]
                if kind == "response":
                    size, told = len(block) - start, digest
                    if (digest := _sha256(memoryview(block)[start:])) != told:
                        raise ValueError(f"{head['warc-record-id']} has another payload digest")
                page = named.get(_PAGE.lower())
                rows.append(
                    (None if page is None else int(page), size, digest.partition(":")[2], kind)
                    + (head["warc-record-id"], head.get("warc-refers-to"))
                )
            columns = zip(*rows, strict=True) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


_LISTED = "page_id long, payload_bytes long, payload_digest string, record_type string, id string, first string"


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every response and
    revisit in a folder of WARC volumes. refers_to is the page_id of the record revisited."""
    visible(spark)
    records = written(_volumes(spark, folder).mapInArrow(_listed, _LISTED))
    revisited = records.where("first is not null").select(F.col("first").alias("id")).distinct()
    named = records.where("record_type = 'response'").join(revisited, "id").select(
        F.col("id").alias("first"), F.col("page_id").alias("refers_to")
    )
    return records.join(named, "first", "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op12_warc(spark, sf_dir: str) -> DataFrame:
    """All pages through ARC volumes into WARC volumes, read back.

    A null page_id stays null, a null html is an empty payload, rows that repeat are
    records of their own. Without pages there is no row.
    """
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    place = f"{shared_folder(spark)}/archive-{uuid.uuid4().hex}"
    write_arc(pages, f"{place}/arc")
    if pages.isEmpty():
        return spark.createDataFrame(
            [], "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
        )
    convert(spark, f"{place}/arc", f"{place}/warc")
    return read_warc(spark, f"{place}/warc")


OP12_SQL = f"""
with payloads as (
    select page_id, strlen(coalesce(html, '')) as payload_bytes, sha256(coalesce(html, '')) as payload_digest,
           row_number() over (partition by payload_digest order by page_id nulls last) as place,
           min(page_id) over (partition by payload_digest) as first_id
    from pages
)
select page_id, payload_bytes::bigint as payload_bytes, payload_digest,
       case when payload_bytes >= {LEAST} and place > 1 then 'revisit' else 'response' end as record_type,
       case when payload_bytes >= {LEAST} and place > 1 then first_id end as refers_to
from payloads
"""
