"""Converter of legacy ARC archives to WARC, and readers and writers of both.

**ARC.** A file begins with a version block (``filedesc://`` line, version line, list of the fields of a URL record). Version 1 lines
hold five fields, version 2 lines ten; the declared length, always last, says how many bytes of network document follow. Records are found by these
lengths alone, never by looking for a separator, so a payload may hold anything. Fields are split from the right, as old URLs may
hold spaces. A line that cannot be read, or a length beyond the end, ends the reading of that file with one row that says why
(``error``); the records before it stay.

**WARC.** For each ARC record the converter synthesises an equivalent one: the identifier is a name-based UUID of the ARC file's own name and the record's offset
(the same on every run), the date is the archive date in ISO form, the type is ``response`` for HTTP documents and ``resource`` for others, and the digests of
payload and block are base-32 SHA-1. Of records with equal payloads of at least ``least`` bytes the first stays a response (smallest key, then earliest date,
then identifier; the key is an integer HTTP header, if one is named) and the others become ``revisit`` records that refer to it and keep their HTTP headers only.

**In Spark.** An archive file is one row of a text table, written with ``maxRecordsPerFile`` 1 and the format's own record end as line end, so
Spark's committer publishes files and a lost task leaves none. Files hold about ``ARCHIVE_BYTES`` before compression and are read whole, one after the other, by
``binaryFile`` tasks; compressed files of either format (also with one member a record) are read as well. Originals are found from a table
without payloads; only digests that occur twice or more are joined to the records, and frequent ones by broadcast of a bounded list.

Defined results for pages: null html is an empty payload, a null or empty URL becomes ``-``, signs that would break a header line are percent-encoded; a null id
bears no key header and comes after all others as an original; repeated rows are records of their own, the first written being the
original; further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.skew import join_counted
from tallyloom.operators.staging import stage, staging_folder

ARCHIVE_BYTES = 8 << 20
BATCH_BYTES = 4 << 20

# Fixed values of the formats: fields of a URL record by ARC version, WARC version and profile, record ends.
ARC_FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: ("URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"),
}
WARC_VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ARC_END, WARC_END = "\n", "\r\n\r\n"
KEY_HEADER = "X-Page-Id"

RECORD = ("archive string, offset bigint, version int, record_id string, type string, url string, ip string, date string, mime string, key bigint, "
          "refers_to string, payload_bytes bigint, payload_digest string, head binary, payload binary, error string")
_ARROW = pa.schema([("archive", pa.string()), ("offset", pa.int64()), ("version", pa.int32()), ("record_id", pa.string()), ("type", pa.string()),
                    ("url", pa.string()), ("ip", pa.string()), ("date", pa.string()), ("mime", pa.string()), ("key", pa.int64()),
                    ("refers_to", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("head", pa.binary()),
                    ("payload", pa.binary()), ("error", pa.string())])


class Damaged(ValueError):
    """An archive cannot be read beyond ``offset``."""

    def __init__(self, offset: int, reason: str):
        super().__init__(f"at byte {offset}: {reason}")
        self.offset = offset


@dataclass
class Raw:
    """One record as it lies in an archive."""

    offset: int
    version: int
    fields: dict
    block: bytes


def digest(data: bytes) -> str:
    """Upper-case base-32 SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def plain(data: bytes) -> bytes:
    """The content of an archive file, decompressed if it is made of gzip members."""
    out = []
    while data[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        out.append(member.decompress(data) + member.flush())
        data = member.unused_data.lstrip(b"\r\n\0")
    return b"".join(out) if out else data


def head_and_payload(block: bytes) -> tuple[bytes, bytes]:
    """HTTP headers with their closing blank line, and what follows; no headers in a block that is no HTTP message."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    ends = [at + len(end) for end in (b"\r\n\r\n", b"\n\n") if (at := block.find(end)) >= 0]
    return (block[:min(ends)], block[min(ends):]) if ends else (block, b"")


def arc_records(data: bytes) -> Iterator[Raw]:
    """Records of a plain ARC file, the version block first."""
    at, names, version = 0, None, 0
    while True:
        while data[at:at + 1] in (b"\n", b"\r"):
            at += 1
        if at >= len(data):
            return
        end = data.find(b"\n", at)
        line = data[at:end if end >= 0 else len(data)].rstrip(b"\r")
        first = line.startswith(b"filedesc:")
        # the line of a version 1 version block has the fields of that version, whatever the records that follow have
        parts = line.rsplit(b" ", 4 if first and line.count(b" ") < 9 else len(names or ARC_FIELDS[2]) - 1)
        if end < 0 or not parts[-1].isdigit() or not (first or names and len(parts) == len(names)):
            raise Damaged(at, "no URL record of the declared version")
        length = int(parts[-1])
        block = data[end + 1:end + 1 + length]
        if len(block) < length:
            raise Damaged(at, f"{length} bytes declared, {len(block)} left")
        if first:
            lines = block.split(b"\n")
            number = lines[0].split(b" ")[0]
            if not number.isdigit() or int(number) not in ARC_FIELDS:
                raise Damaged(at, "unknown version")
            version, names = int(number), ARC_FIELDS[int(number)]
            listed = lines[1].split() if len(lines) > 1 else []
            if listed and len(listed) != len(names):
                raise Damaged(at, "the listed fields are not those of the version")
            yield Raw(at, version, {"URL": parts[0].decode("utf-8", "replace")}, block)
        else:
            yield Raw(at, version, {n: p.decode("utf-8", "replace") for n, p in zip(names, parts)}, block)
        at = end + 1 + length


def warc_records(data: bytes) -> Iterator[Raw]:
    """Records of a plain WARC file; field names in lower case."""
    at = 0
    while True:
        while data[at:at + 1] in (b"\n", b"\r"):
            at += 1
        if at >= len(data):
            return
        end = data.find(b"\r\n\r\n", at)
        lines = data[at:max(end, at)].decode("utf-8", "replace").split("\r\n")
        fields, name = {}, None
        for line in lines[1:]:
            if line[:1] in (" ", "\t") and name:
                fields[name] += " " + line.strip()
            else:
                name, _, value = line.partition(":")
                name = name.strip().lower()
                fields[name] = value.strip()
        if end < 0 or not lines[0].startswith("WARC/") or not fields.get("content-length", "").isdigit():
            raise Damaged(at, "no WARC header")
        length = int(fields["content-length"])
        block = data[end + 4:end + 4 + length]
        if len(block) < length:
            raise Damaged(at, f"{length} bytes declared, {len(block)} left")
        yield Raw(at, 0, fields, block)
        at = end + 4 + length


def iso_date(archive_date: str) -> str | None:
    """``YYYYMMDD[hh[mm[ss]]]`` as an ISO date in UTC; null if it is none."""
    if not re.fullmatch(r"\d{8}(\d\d){0,3}", archive_date):
        return None
    d = archive_date.ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:]}Z"


def record_name(archive: str, offset: int) -> str:
    """Identifier of a record, the same whenever the same archive is converted."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{archive}#{offset}')}>"


def escaped(url: str | None) -> str:
    """A URL without signs that end a field or a line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url or "") or "-"


def _key_of(head: bytes, header: str | None) -> int | None:
    if header is None:
        return None
    hit = re.search(rb"(?mi)^" + re.escape(header.encode()) + rb":[ \t]*(-?\d{1,19})[ \t]*\r?$", head)
    return int(hit[1]) if hit and -(1 << 63) <= int(hit[1]) < 1 << 63 else None


def _from_arc(data: bytes, header: str | None) -> Iterator[dict]:
    archive = None
    for raw in arc_records(data):
        f = raw.fields
        if "Archive-length" not in f:
            archive = f["URL"].removeprefix("filedesc://")
            continue
        head, payload = head_and_payload(raw.block)
        yield {"archive": archive, "offset": raw.offset, "version": raw.version, "record_id": record_name(archive, raw.offset),
               "type": "response" if head else "resource", "url": f["URL"], "ip": f["IP-address"], "date": iso_date(f["Archive-date"]), "mime": f["Content-type"],
               "key": _key_of(head, header), "payload_bytes": len(payload), "payload_digest": digest(payload), "head": head, "payload": payload}


def _from_warc(data: bytes, header: str | None) -> Iterator[dict]:
    archive = None
    for raw in warc_records(data):
        f = raw.fields
        kind = f.get("warc-type")
        if kind == "warcinfo":
            archive = f.get("warc-filename")
            continue
        head, payload = head_and_payload(raw.block)
        declared = f.get("warc-payload-digest", "").removeprefix("sha1:") or None
        row = {"archive": archive, "offset": raw.offset, "record_id": f.get("warc-record-id"), "type": kind, "url": f.get("warc-target-uri"),
               "ip": f.get("warc-ip-address"), "date": f.get("warc-date"), "mime": f.get("content-type"), "key": _key_of(head, header),
               "refers_to": f.get("warc-refers-to"), "head": head}
        if kind == "revisit":
            yield row | {"payload_digest": declared}
            continue
        found = digest(payload)
        wrong = [n for n, want, got in (("payload", declared, found), ("block", f.get("warc-block-digest", "").removeprefix("sha1:") or None, digest(raw.block)))
                 if want is not None and want != got]
        yield row | {"payload_bytes": len(payload), "payload_digest": found, "payload": payload, "error": f"{wrong[0]} digest differs" if wrong else None}


def _read(spark: SparkSession, path: str, parse, header: str | None, payloads: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0

        def batch() -> pa.RecordBatch:
            nonlocal size
            made = pa.RecordBatch.from_pylist(rows, _ARROW)
            rows.clear()
            size = 0
            return made

        for files in batches:
            for name, content in zip(files.column(0).to_pylist(), files.column(1)):
                try:
                    for row in parse(plain(content.as_py()), header):
                        if payloads:
                            size += row["payload_bytes"] or 0
                        else:
                            row |= {"head": None, "payload": None}
                        rows.append(row)
                        if size > BATCH_BYTES or len(rows) >= 5000:
                            yield batch()
                except (Damaged, zlib.error) as e:
                    rows.append({"archive": name, "offset": getattr(e, "offset", None), "type": "damaged", "error": str(e)})
        if rows:
            yield batch()

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, RECORD)


def read_arc(spark: SparkSession, path: str, key_header: str | None = None, payloads: bool = True) -> DataFrame:
    """Records of ARC files as :data:`RECORD` rows, with the identity that they get in WARC; unreadable rests have type ``damaged``."""
    return _read(spark, path, _from_arc, key_header, payloads)


def read_warc(spark: SparkSession, path: str, key_header: str | None = None, payloads: bool = True) -> DataFrame:
    """Records of WARC files as :data:`RECORD` rows; digests are computed anew and differences told in ``error``."""
    return _read(spark, path, _from_warc, key_header, payloads)


def _archives(rows: DataFrame, path: str, begin, record, end: str, compression: str | None) -> str:
    """Write files of about ``ARCHIVE_BYTES``: ``begin(task, number)``, then ``record(values, file, offset)`` for each row."""
    closing = end.encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, parts, size = TaskContext.get().partitionId(), 0, [], 0

        def archive() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([closing.join(parts)], pa.large_binary() if size >= 1 << 31 else pa.binary())], ["value"])

        for b in batches:
            columns = [c.to_pylist() if not pa.types.is_binary(c.type) else c for c in b.columns]
            for i in range(b.num_rows):
                values = {n: (c[i].as_py() if isinstance(c, pa.Array) else c[i]) for n, c in zip(b.schema.names, columns)}
                if not parts:
                    parts, size = [begin(task, number)], 0
                    size = len(parts[0]) + len(closing)
                made = record(values, task, number, size)
                parts.append(made)
                size += len(made) + len(closing)
                if size >= ARCHIVE_BYTES:
                    yield archive()
                    parts, number = [], number + 1
        if parts:
            yield archive()

    files = rows.mapInArrow(run, "value binary").select(F.col("value").cast("string"))
    files.write.option("maxRecordsPerFile", 1).option("lineSep", end).option("compression", compression or "none").text(path)
    return path


def write_arc(pages: DataFrame, path: str, name: str = "pages", captured: str = "20000101000000", id_col: str = "page_id", url_col: str = "url",
              payload_col: str = "html", compression: str | None = "gzip") -> str:
    """Write pages as ARC files below ``path``, versions 1 and 2 by turns; each page is an HTTP message that names its id."""
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"))
    named = lambda task, number: f"{name}-{task:06d}-{number:06d}.arc"
    version = lambda task, number: 1 + (task + number) % 2

    def begin(task: int, number: int) -> bytes:
        v = version(task, number)
        block = f"{v} 0 {name}\n{' '.join(ARC_FIELDS[v])}\n"
        more = "" if v == 1 else f" 200 - - 0 {named(task, number)}"
        return f"filedesc://{named(task, number)} 0.0.0.0 {captured} text/plain{more} {len(block.encode())}\n{block}".encode()

    def record(row: dict, task: int, number: int, offset: int) -> bytes:
        key = "" if row["id"] is None else f"{KEY_HEADER}: {row['id']}\r\n"
        head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(row['payload'])}\r\n{key}\r\n".encode()
        more = "" if version(task, number) == 1 else f" 200 - - {offset} {named(task, number)}"
        line = f"{escaped(row['url'])} 0.0.0.0 {captured} text/html{more} {len(head) + len(row['payload'])}\n"
        return line.encode() + head + row["payload"]

    return _archives(rows, path, begin, record, ARC_END, compression)


def originals(index: DataFrame, least: int = 0) -> DataFrame:
    """``(payload_digest, n, original, original_url, original_date)`` of responses whose payload occurs twice or more."""
    order = F.struct(F.col("key").isNull().alias("none"), "key", F.col("date").isNull().alias("undated"), "date", "record_id", "url")
    return (index.where((F.col("type") == "response") & (F.col("payload_bytes") >= least)).groupBy("payload_digest")
            .agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first")).where("n > 1")
            .select("payload_digest", "n", F.col("first.record_id").alias("original"), F.col("first.url").alias("original_url"), F.col("first.date").alias("original_date")))


def convert(spark: SparkSession, arc: str, warc: str, name: str = "converted", key_header: str | None = None, least: int = 0,
            compression: str | None = "gzip") -> str:
    """Convert the ARC files below ``arc`` to WARC files below ``warc``."""
    index = stage(read_arc(spark, arc, key_header, payloads=False).where("type != 'damaged'")
                  .select("record_id", "type", "url", "date", "key", "payload_bytes", "payload_digest"), "arc-index")
    firsts = stage(originals(index, least), "originals")
    records = read_arc(spark, arc, key_header).where("type != 'damaged'")
    total = index.count()
    decided = join_counted(records, firsts, "payload_digest", "record_id", total) if not firsts.isEmpty() else records.withColumns(
        {c: F.lit(None).cast("string") for c in ("original", "original_url", "original_date")})
    again = (F.col("type") == "response") & F.col("original").isNotNull() & (F.col("original") != F.col("record_id")) & (F.col("payload_bytes") >= least)
    decided = decided.withColumn("again", F.coalesce(again, F.lit(False))).withColumn("payload", F.expr("CASE WHEN NOT again THEN payload END"))
    named = lambda task, number: f"{name}-{task:06d}-{number:06d}.warc"

    def written(fields: list[tuple[str, object]], block: bytes) -> bytes:
        lines = [WARC_VERSION] + [f"{k}: {v}".encode() for k, v in fields if v is not None] + [f"Content-Length: {len(block)}".encode()]
        return b"\r\n".join(lines) + b"\r\n\r\n" + block

    def begin(task: int, number: int) -> bytes:
        block = b"software: tallyloom\r\nformat: WARC File Format 1.1\r\ndescription: converted from ARC\r\n"
        return written([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_name(named(task, number), 0)), ("WARC-Date", "2000-01-01T00:00:00Z"),
                        ("WARC-Filename", named(task, number)), ("Content-Type", "application/warc-fields")], block)

    def record(row: dict, task: int, number: int, offset: int) -> bytes:
        same = row["again"]
        block = row["head"] + (b"" if same else row["payload"])
        http = row["type"] == "response"
        fields = [("WARC-Type", "revisit" if same else row["type"]), ("WARC-Record-ID", row["record_id"]), ("WARC-Date", row["date"]),
                  ("WARC-Target-URI", row["url"]), ("WARC-IP-Address", row["ip"]), ("WARC-Warcinfo-ID", record_name(named(task, number), 0)),
                  ("WARC-Payload-Digest", f"sha1:{row['payload_digest']}"), ("WARC-Block-Digest", f"sha1:{digest(block)}"),
                  ("Content-Type", "application/http; msgtype=response" if http else row["mime"])]
        if same:
            fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", row["original"]), ("WARC-Refers-To-Target-URI", row["original_url"]),
                       ("WARC-Refers-To-Date", row["original_date"])]
        return written(fields, block)

    columns = ("record_id", "type", "url", "ip", "date", "mime", "payload_digest", "head", "payload", "again", "original", "original_url", "original_date")
    return _archives(decided.select(*columns), warc, begin, record, WARC_END, compression)


def resolved(records: DataFrame) -> DataFrame:
    """``(record_id, type, key, payload_bytes, payload_digest, refers_key)`` of written records; revisits get theirs from the record they refer to."""
    names = ("record_id", "type", "key", "refers_to", "payload_bytes", "payload_digest")
    rows = stage(records.where("type IN ('response', 'resource', 'revisit')").select(*names), "warc-index")
    counted = rows.where("type = 'revisit'").groupBy("refers_to").agg(F.count(F.lit(1)).alias("n"))
    target = rows.where("type != 'revisit'").select(F.col("record_id").alias("refers_to"), F.col("key").alias("refers_key"), F.col("payload_bytes").alias("full_bytes"))
    lookup = stage(counted.join(target, "refers_to"), "referred")
    found = join_counted(rows, lookup, "refers_to", "record_id", rows.count())
    return found.select("record_id", "type", "key", F.coalesce("payload_bytes", "full_bytes").alias("payload_bytes"), "payload_digest", "refers_key")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: all pages as ARC files, converted to WARC files, read back; one row a page."""
    arc, warc = staging_folder(spark, "arc"), staging_folder(spark, "warc")
    write_arc(spark.read.parquet(f"{sf_dir}/pages.parquet"), arc)
    convert(spark, arc, warc, key_header=KEY_HEADER)
    found = resolved(read_warc(spark, warc, KEY_HEADER, payloads=False))
    return found.select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"), F.col("refers_key").alias("refers_to"))


SQL = """
SELECT page_id, CAST(strlen(p) AS BIGINT) AS payload_bytes,
    array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + ((CAST('0x' || substr(sha1(p), CAST(5 * (i // 4) + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31), 1)), '') AS payload_digest,
    CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN k > 1 THEN first_id END AS refers_to
FROM (SELECT page_id, coalesce(html, '') AS p, row_number() OVER w AS k, first_value(page_id) OVER w AS first_id
    FROM pages WINDOW w AS (PARTITION BY coalesce(html, '') ORDER BY page_id NULLS LAST))
"""
