"""Legacy ARC archives to WARC: parse version-specific headers and declared lengths, write WARC
records with synthesised identifiers, times, types and digests, and read WARC files back."""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import record_batches, stage
from tallybrook.session import run_dir

#: Header fields of an ARC record by the version its archive declares.
ARC_FIELDS = {
    1: ("url", "ip", "date", "mime", "length"),
    2: ("url", "ip", "date", "mime", "status", "checksum", "location", "offset", "filename", "length"),
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
#: An archive is closed once it holds so many bytes.
ARCHIVE_BYTES = 4 << 20
ARCHIVES_DDL = "path string, content binary"
RECORDS_DDL = (
    "record_id string, warc_date string, target_uri string, ip string, head binary, payload binary, "
    "payload_digest string, block_digest string, head_digest string, page_id long, kind string, content_type string"
)
RESPONSE, RESOURCE, METADATA = "response", "resource", "metadata"
HTTP_TYPE = "application/http; msgtype=response"
# Media types that legacy crawlers write where they know none.
NO_MIME = ("", "-", "no-type", "unknown")
READ_DDL = (
    "record_id string, record_type string, page_id long, payload_bytes long, payload_digest string, refers_to_id string"
)


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def arc_record(version: int, url: str, date: str, mime: str, content: bytes, offset: int, name: str) -> bytes:
    values = {
        "url": url, "ip": "0.0.0.0", "date": date, "mime": mime, "length": str(len(content)), "status": "200",
        "checksum": hashlib.md5(content).hexdigest(), "location": "-", "offset": str(offset), "filename": name,
    }
    return " ".join(values[f] for f in ARC_FIELDS[version]).encode() + b"\n" + content + b"\n"


def arc_start(version: int, name: str, date: str) -> bytes:
    titles = {
        1: "URL IP-address Archive-date Content-type Archive-length",
        2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
    }
    content = f"{version} 0 tallybrook\n{titles[version]}\n".encode()
    return arc_record(version, f"filedesc://{name}", date, "text/plain", content, 0, name)


def parse_arc(archive: bytes) -> Iterator[tuple[dict[str, str], int, bytes]]:
    """(header fields, offset, content) of every record after the version block.

    The version block's own second line says the version, so the number of fields; the declared
    length alone bounds a content. A record that is cut off or whose header does not fit the version
    is an error, never skipped.
    """
    if not archive:
        return
    line_end = archive.index(b"\n")
    version = int(archive[line_end + 1 : line_end + 3].split()[0])
    fields, at, first = ARC_FIELDS[version], 0, True
    while at < len(archive):
        line_end = archive.find(b"\n", at)
        values = archive[at:line_end].decode("utf-8").split(" ") if line_end >= 0 else []
        if len(values) != len(fields):
            raise ValueError(f"no ARC version {version} header at byte {at}")
        header = dict(zip(fields, values))
        start, length = line_end + 1, int(header["length"])
        if start + length > len(archive):
            raise ValueError(f"the record at byte {at} is cut off")
        if not first:
            yield header, at, archive[start : start + length]
        first, at = False, start + length
        while archive[at : at + 1] in (b"\n", b"\r"):
            at += 1


def archive_pages(pages: DataFrame, date: str = "20000101000000") -> DataFrame:
    """(path, content) archives of pages, versions 1 and 2 in turn, as a legacy crawler leaves them.

    A null url becomes ``urn:none``; white space in one is percent-encoded; a null html is empty.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, parts, size, version = TaskContext.get().partitionId(), 0, [], 0, 1

        def closed():
            return pa.RecordBatch.from_pydict({"path": [f"part-{part:06}-{number:06}.arc"], "content": [b"".join(parts)]})

        for batch in record_batches(batches, 500):
            for page_id, url, html in zip(*(column.to_pylist() for column in batch.columns)):
                name = f"part-{part:06}-{number:06}.arc"
                if not parts:
                    version = number % 2 + 1
                    parts.append(arc_start(version, name, date))
                    size = len(parts[0])
                payload = (html or "").encode()
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n"
                head += "" if page_id is None else f"X-Page-Id: {page_id}\r\n"
                safe = re.sub(r"\s", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url or "") or "urn:none"
                parts.append(arc_record(version, safe, date, "text/html", head.encode() + b"\r\n" + payload, size, name))
                size += len(parts[-1])
                if size >= ARCHIVE_BYTES:
                    yield closed()
                    parts, number = [], number + 1
        if parts:
            yield closed()

    return pages.select("page_id", "url", "html").mapInArrow(build, ARCHIVES_DDL)


def record_kind(url: str, mime: str, block: bytes) -> tuple[str, str]:
    """(WARC type, content type) of an ARC record: what came with an HTTP head is a response, what a
    crawler noted about itself is metadata, all else (``dns:`` answers, files, content whose head
    was not kept) a resource of its media type."""
    scheme = url.partition(":")[0].lower()
    if scheme in ("http", "https", "urn") or "://" not in url and scheme != "dns":
        if block[:5] == b"HTTP/":
            return RESPONSE, HTTP_TYPE
    if scheme in ("metadata", "filedesc", "warcinfo"):
        return METADATA, mime if mime not in NO_MIME else "application/warc-fields"
    if scheme == "dns":
        return RESOURCE, "text/dns"
    return RESOURCE, mime if mime not in NO_MIME else "application/octet-stream"


def convert_archives(archives: DataFrame) -> DataFrame:
    """One row for each record of the ARC archives (path, content), with what WARC asks for.

    The record id follows from archive and offset, so a repeated conversion gives the same one. Type and
    content type follow from scheme, media type and HTTP head. A response's head and payload are split
    at the first empty line; the content of any other record is all payload.
    """

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [field.split()[0] for field in RECORDS_DDL.split(", ")]
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                path, rows = path.as_py(), []
                for header, offset, block in parse_arc(content.as_py() or b""):
                    kind, content_type = record_kind(header["url"], header["mime"], block)
                    head, mark, payload = block.partition(b"\r\n\r\n")
                    head, payload = (head + mark, payload) if mark and kind == RESPONSE else (b"", block)
                    page = re.search(rb"^X-Page-Id: (-?\d+)\r$", head, re.MULTILINE)
                    date = header["date"]
                    rows.append((
                        f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{path}#{offset}')}>",
                        f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:14]}Z",
                        header["url"], header["ip"], head, payload, sha1_base32(payload), sha1_base32(block),
                        sha1_base32(head), int(page[1]) if page else None, kind, content_type,
                    ))
                for at in range(0, len(rows), 500):
                    columns = zip(*rows[at : at + 500])
                    yield pa.RecordBatch.from_pydict(
                        dict(zip(names, map(list, columns))),
                        schema=pa.schema([(n, pa.binary() if n in ("head", "payload") else pa.int64() if n == "page_id" else pa.string()) for n in names]),
                    )

    return archives.select("path", "content").mapInArrow(convert, RECORDS_DDL)


def warc_record(payload_first: Column) -> Column:
    """The bytes of a record but for the last line feed; ``payload_first``: the record holds its payload,
    it is no revisit."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    response = payload_first
    block = F.when(response, F.concat(F.col("head"), F.col("payload"))).otherwise(F.col("head"))
    header = F.concat(
        F.lit("WARC/1.0\r\n"),
        line("WARC-Type", F.when(response, F.col("kind")).otherwise("revisit")),
        line("WARC-Record-ID", F.col("record_id")),
        line("WARC-Date", F.col("warc_date")),
        line("WARC-Target-URI", F.col("target_uri")),
        line("WARC-IP-Address", F.col("ip")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        line("WARC-Block-Digest", F.concat(F.lit("sha1:"), F.when(response, F.col("block_digest")).otherwise(F.col("head_digest")))),
        F.when(response, F.lit("")).otherwise(
            F.concat(line("WARC-Profile", F.lit(REVISIT_PROFILE)), line("WARC-Refers-To", F.col("response_id")))
        ),
        line("Content-Type", F.col("content_type")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
    )
    return F.concat(header, block.cast("string"), F.lit("\r\n\r"))


def write_warc(records: DataFrame, path: str) -> None:
    """Write converted records as gzip WARC files.

    Of the responses with one payload digest, that with the largest page id (then record id) stays one;
    the others become revisits that refer to it. Other records are written whole. A third of all records may share a payload:
    the responses come from a pre-combined aggregate, and the join back is over two written tables,
    which adaptive execution splits.
    """
    records = stage(records, "warc-records", "zstd")
    best = F.max(F.struct("page_id", "record_id"))
    answers = records.where(F.col("kind") == RESPONSE)
    responses = stage(answers.groupBy("payload_digest").agg(best["record_id"].alias("response_id")), "warc-responses")
    others = records.where(F.col("kind") != RESPONSE).withColumn("response_id", F.col("record_id"))
    joined = answers.join(responses, "payload_digest").unionByName(others)
    written = joined.select(warc_record(F.col("record_id") == F.col("response_id")).alias("value"))
    written.write.option("compression", "gzip").text(path)


def parse_warc(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of every record; a cut-off record is an error."""
    at = 0
    while at < len(archive):
        end = archive.find(b"\r\n\r\n", at)
        lines = archive[at:end].decode("utf-8").split("\r\n")
        if end < 0 or not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC header at byte {at}")
        header = dict(line.split(": ", 1) for line in lines[1:])
        start, length = end + 4, int(header["Content-Length"])
        if start + length + 4 > len(archive):
            raise ValueError(f"the record at byte {at} is cut off")
        yield header, archive[start : start + length]
        at = start + length + 4


def read_warc(spark, path: str) -> DataFrame:
    """One row for each record of the WARC files below ``path``; digests are checked on the way."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [field.split()[0] for field in READ_DDL.split(", ")]
        kinds = [pa.int64() if field.endswith(" long") else pa.string() for field in READ_DDL.split(", ")]
        for batch in batches:
            for content in batch["content"]:
                rows = []
                for header, block in parse_warc(gzip.decompress(content.as_py())):
                    head, mark, payload = block.partition(b"\r\n\r\n")
                    page = re.search(rb"^X-Page-Id: (-?\d+)\r?$", head, re.MULTILINE)
                    digest, response = header["WARC-Payload-Digest"], header["WARC-Type"] != "revisit"
                    if header["WARC-Type"] != RESPONSE:
                        mark = mark if not response else b""  # no head: the block is the payload
                        page = page if mark else None
                    if response and digest != f"sha1:{sha1_base32(payload if mark else block)}":
                        raise ValueError(f"wrong payload digest in {header['WARC-Record-ID']}")
                    rows.append((
                        header["WARC-Record-ID"], header["WARC-Type"], int(page[1]) if page else None,
                        len(payload if mark else block) if response else None, digest.removeprefix("sha1:"), header.get("WARC-Refers-To"),
                    ))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(read, READ_DDL)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Page ids and payload sizes in place of record ids: what each revisit refers to."""
    records = stage(records, "warc-read")
    targets = records.where("record_type = 'response'").select(
        F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("_full")
    )
    return records.join(targets, "refers_to_id", "left").select(
        "page_id", F.coalesce("payload_bytes", "_full").alias("payload_bytes"), "payload_digest", "record_type", "refers_to", "record_id"
    )


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Pages to ARC archives, to WARC files in the shared folder, and back to one row a page.

    Null, empty and repeated pages each get their record; empty payloads are equal payloads too; of
    repeated rows with one page id just one is the response. No pages give no rows.
    """
    spark = pages.sparkSession
    path = run_dir(spark, "warc")
    write_warc(convert_archives(archive_pages(pages)), path)
    return resolve_revisits(read_warc(spark, path))
