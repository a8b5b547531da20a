"""WARC archives of pages, and a reader that goes on after damage.

Each record is a gzip member of its own. The reader checks every member (its CRC, its WARC header, its length, its block
digest). Where a check fails, it looks for the next place at which a whole valid record starts, a gzip member or a version
line, goes on from there, and reports the bytes between as a gap. Inside a valid member it does the same with the inflated bytes.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendloom.llm.frames import arrow_map, column, read_file, settled, write_file
from trendloom.session import shared_folder

#: Payloads of at least so many bytes are stored once.
SHARED_FROM = 1000
#: Uncompressed bytes after which a file ends, and parts a large group of copies is dealt to.
FILE_BYTES, SALTS = 64 << 20, 32

#: Record types that a page can have.
PAGES = ("response", "revisit")

_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
_START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# Records


def record_name(page_id: int | None) -> str:
    return f"<urn:x-page:{'none' if page_id is None else page_id}>"


def page_of(name: str | None) -> int | None:
    found = re.fullmatch(r"<urn:x-page:(-?\d+)>", name or "")
    return int(found[1]) if found else None


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [("WARC-Type", kind), *headers, ("WARC-Block-Digest", _sha1(block)), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines).encode("utf-8") + b"\r\n" + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """A response, or a revisit that has the response's HTTP header but not its payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = [("WARC-Record-ID", record_name(page_id)), ("WARC-Date", date), ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", _sha1(payload))]
    if url is not None:
        headers.append(("WARC-Target-URI", quote(url, safe="%/:?#[]@!$&'()*+,;=~")))
    if refers_to is None:
        return record("response", headers, http + payload)
    return record("revisit", [*headers, ("WARC-Profile", _PROFILE), ("WARC-Refers-To", record_name(refers_to))], http)


def member(data: bytes, level: int = 6) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


# Reading


def _inflate(data: memoryview, at: int) -> tuple[bytes, int] | None:
    """The member that starts at ``at`` and where it ends; None if it isn't whole and valid."""
    unpacker = zlib.decompressobj(31)
    parts, step = [], 1 << 14
    place = at
    try:
        while not unpacker.eof and place < len(data):
            parts.append(unpacker.decompress(data[place : place + step]))
            place += step
            step = min(step * 2, 1 << 20)
    except zlib.error:
        return None
    return (b"".join(parts), min(place, len(data)) - len(unpacker.unused_data)) if unpacker.eof else None


def _parse(data: bytes, at: int) -> tuple[dict[str, str], bytes, int] | None:
    """Headers, block and end of the record whose version line is at ``at``; None if any check fails."""
    if not _VERSION.match(data, at):
        return None
    headers, line_at = {}, at + 10
    while (stop := data.find(b"\r\n", line_at)) != line_at:
        name, colon, value = data[line_at : max(stop, line_at)].decode("utf-8", "replace").partition(":")
        if not colon:
            return None
        headers[name.strip().lower()] = value.strip()
        line_at = stop + 2
    if not re.fullmatch(r"\d{1,18}", headers.get("content-length", "")) or "warc-type" not in headers:
        return None
    start = stop + 2
    end = start + int(headers["content-length"])
    if data[end : end + 4] != b"\r\n\r\n":
        return None
    block = data[start:end]
    digest = headers.get("warc-block-digest", "")
    if digest.startswith("sha1:") and digest != _sha1(block):
        return None
    return headers, block, end + 4


def _inside(inner: bytes) -> Iterator[tuple[int, int, tuple[dict[str, str], bytes] | None]]:
    """``(start, end, (headers, block))`` of the records in a member's inflated bytes, and ``(start, end, None)`` of the gaps."""
    at, lost = 0, -1
    while at < len(inner):
        parsed = _parse(inner, at)
        if parsed:
            if lost >= 0:
                yield lost, at, None
                lost = -1
            yield at, parsed[2], parsed[:2]
            at = parsed[2]
            continue
        lost = at if lost < 0 else lost
        following = _VERSION.search(inner, at + 1)
        at = following.start() if following else len(inner)
    if lost >= 0 or not inner:
        yield max(lost, 0), len(inner), None


def salvage(data: bytes) -> Iterator[tuple[str, int, int, object]]:
    """``("record", start, end, (headers, block))`` and ``("gap", start, end, reason)``, covering all of ``data`` in order.

    All records and gaps of a valid member have the member's place; the reason of such a gap says which inflated bytes it is.
    """
    view, at, lost, why = memoryview(data), 0, -1, ""
    while at < len(data):
        found, reason = None, "no record starts here"
        if data[at : at + 3] == b"\x1f\x8b\x08":
            inflated = _inflate(view, at)
            reason = "damaged member"
            if inflated:
                found, end = _inside(inflated[0]), inflated[1]
        elif _VERSION.match(data, at):
            parsed = _parse(data, at)
            reason = "damaged record"
            if parsed:
                found, end = [(at, parsed[2], parsed[:2])], parsed[2]
        if found:
            if lost >= 0:
                yield "gap", lost, at, why
                lost = -1
            for start, stop, parsed in found:
                if parsed:
                    yield "record", at, end, parsed
                else:
                    yield "gap", at, end, f"damaged record in a whole member: inflated bytes {start} to {stop}"
            at = end
            continue
        if lost < 0:
            lost, why = at, reason
        following = _START.search(data, at + 1)
        at = following.start() if following else len(data)
    if lost >= 0:
        yield "gap", lost, len(data), why


# On Spark


def with_references(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """``page_id, url, payload, refers_to``: for equal payloads of some size, the largest page id, null for that page itself.

    Equality is by SHA-256 and length. Groups are reduced to their largest id before the shuffle, and only groups of two or
    more are joined back, dealt to several partitions each.
    """
    rows = pages.select(column(key).cast("long").alias("page_id"), column(url).cast("string").alias("url"), F.coalesce(column(payload).cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("bytes", F.octet_length("payload").cast("long"))
    groups = rows.where(F.col("bytes") >= SHARED_FROM).groupBy("digest", "bytes").agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    groups = groups.select("digest", "bytes", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    joined = rows.join(groups, ["digest", "bytes", "salt"], "left")
    return joined.select("page_id", "url", "payload", F.when(F.col("page_id") != F.col("first"), F.col("first")).alias("refers_to"))


def _written(rows: Iterator[tuple], folder: str, date: str, file_bytes: int) -> Iterable[tuple]:
    head = member(record("warcinfo", [("WARC-Record-ID", "<urn:x-file:info>"), ("WARC-Date", date), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
    parts, size, n = [head], 0, 0
    for page_id, url, payload, refers_to in rows:
        data = page_record(page_id, url, payload, refers_to, date)
        parts.append(member(data))
        size, n = size + len(data), n + 1
        if size >= file_bytes:
            yield write_file(folder, "pages.warc.gz", b"".join(parts)), n
            parts, size, n = [head], 0, 0
    if n:
        yield write_file(folder, "pages.warc.gz", b"".join(parts)), n


def write_archives(pages: DataFrame, folder: str, date: str = "2000-01-01T00:00:00Z", file_bytes: int = FILE_BYTES, **columns: str) -> DataFrame:
    """Writes a record per page and returns the list of the files (``path, records``), which is itself a written table.

    Null payloads are empty. Pages without an id, and all of the same id as the largest, are responses. Without a URL a
    record has no target. Rows that repeat a page id repeat its record name. No rows: no files. Other columns are not read.
    """
    files = arrow_map(with_references(pages, **columns), _written, "path string, records long", folder, date, file_bytes)
    return settled(files, "archives")


def _records(rows: Iterator[tuple]) -> Iterable[tuple]:
    for path, written in rows:
        pages = 0
        for kind, start, end, found in salvage(read_file(path)):
            if kind == "gap":
                if written is not None:
                    raise ValueError(f"{path}, bytes {start} to {end}: {found}")
                yield path, start, end, found, None, None, None, None, None, None, None
                continue
            headers, block = found
            pages += headers["warc-type"] in PAGES
            http, _, body = block.partition(b"\r\n\r\n")
            length = re.search(rb"(?im)^content-length:\s*(\d{1,18})\s*$", http)
            digest = headers.get("warc-payload-digest", "")
            digest = base64.b32decode(digest[5:]).hex() if re.fullmatch(r"sha1:[A-Z2-7]{32}", digest) else None
            kept = body if headers["warc-type"] == "response" else None
            yield (
                path, start, end, None, headers["warc-type"], page_of(headers.get("warc-record-id")), headers.get("warc-target-uri"),
                page_of(headers.get("warc-refers-to")), digest, int(length[1]) if length else None, kept,
            )
        if written is not None and pages != written:
            raise ValueError(f"{path}: {written} records were written and {pages} read")


def read_archives(files: DataFrame, strict: bool = False) -> DataFrame:
    """Every record and every gap of the files listed in ``path``: a gap has a ``gap`` text and no record columns.

    ``strict`` is for files that must be whole: a gap, or another number of pages than ``records`` says, is an error.
    """
    written = F.col("records") if strict else F.lit(None).cast("long")
    spread = files.select("path", written.alias("written")).repartition(max(1, files.sparkSession.sparkContext.defaultParallelism), "path")
    return arrow_map(
        spread, _records,
        "path string, start long, end long, gap string, record_type string, page_id long, url string, refers_to long, payload_digest string, payload_bytes long, payload binary",
    )


def pages_of(records: DataFrame) -> DataFrame:
    """The page records among ``records``."""
    return records.where(F.col("gap").isNull() & F.col("record_type").isin(*PAGES))


def gaps_of(records: DataFrame) -> DataFrame:
    """The log of quarantined bytes: ``path, start, end, gap``."""
    return records.where("gap IS NOT NULL").select("path", "start", "end", "gap")


def through_archives(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """The page records of ``pages``, written and read again; a page that can't be read again is an error."""
    return pages_of(read_archives(write_archives(pages, shared_folder(spark, "warcs")), strict=True))
