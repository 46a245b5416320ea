"""WARC archives: writing through Spark's text sink, and a salvage reader.

One record per page. Equal payloads of at least 100 bytes are stored once: the page with the smallest id
is the response, the others are revisits that refer to it. The text sink ends every row with its line
separator; a record's last byte is that line feed, so the files are plain concatenated WARC/1.1 records,
committed by Spark and readable by any tool.

The reader takes whole archives (plain, or with gzip members) as binary files. A record counts when its
header parses, its length fits, its end mark stands and its block digest agrees. After a failed check the
reader searches for the next version line or gzip member from which a record passes, goes on there, and logs
the bytes between as a quarantined gap. A file may hold both kinds; a damaged member gives the records before
its damage.
"""

from __future__ import annotations

import functools
import hashlib
import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.common import col, for_workers, saved, work_dir

LEAST_PAYLOAD = 100
RECORDS_PER_ARCHIVE = 1000
ARCHIVE_BYTES = 128 << 20
_ROWS_BYTES = 32 << 20
_LINE = re.compile(rb"WARC/1\.[0-9]\r\n")
_GZIP = b"\x1f\x8b\x08"
_END = b"\r\n\r\n"
_MEMBER_STEP = 1 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _payload(html: str):
    return F.coalesce(col(html).cast("string"), F.lit(""))


def first_pages(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(digest, first): the smallest id of each payload of LEAST_PAYLOAD bytes and more that occurs twice or more."""
    slim = pages.select(col(id_col).cast("long").alias("id"), F.sha2(_payload(html_col).cast("binary"), 256).alias("digest"), F.octet_length(_payload(html_col)).alias("size"))
    groups = slim.filter(F.col("size") >= LEAST_PAYLOAD).groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    return groups.filter("n > 1").select("digest", "first")


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            date: str = "2000-01-01T00:00:00Z", firsts: DataFrame | None = None) -> DataFrame:
    """One column, the text of each page's record without its last line feed.

    A page whose id equals the smallest one (repeated rows too) is a response, null ids come last. A
    null url leaves out the target; control characters in urls are percent-coded. Null html is empty.
    firsts: the table of first_pages, if pages are a part of those of the archives.
    """
    if firsts is None:
        firsts = saved(first_pages(pages, id_col, html_col), "warc-first")
    url = F.regexp_replace(col(url_col).cast("string"), r"[\x00-\x20\x7F]", "%20")
    body = _payload(html_col)
    p = pages.select(col(id_col).cast("long").alias("id"), url.alias("url"), body.alias("body"), F.octet_length(body).alias("size"), F.sha2(body.cast("binary"), 256).alias("digest"))
    p = p.join(firsts.withColumnRenamed("digest", "same"), F.col("digest") == F.col("same"), "left").drop("same")
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("id"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit("\r\n\r\n"))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("body")))
    uri = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("null")), F.lit(">"))
    p = p.withColumn("revisit", revisit).withColumn("block", block)
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    return p.select(F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")), line("WARC-Record-ID", uri("id")), line("WARC-Date", F.lit(date)),
        F.coalesce(line("WARC-Target-URI", F.col("url")), F.lit("")), F.when(F.col("revisit"), F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", uri("first")))).otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")), line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        line("WARC-Block-Digest", F.concat(F.lit("sha256:"), F.sha2(F.col("block").cast("binary"), 256))), line("Content-Length", F.octet_length("block").cast("string")),
        F.lit("\r\n"), F.col("block"), F.lit("\r\n\r")).alias("record"))


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   per_archive: int = RECORDS_PER_ARCHIVE, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write the records as archives below ``path``, each of at most ``per_archive`` records and
    ``archive_bytes`` bytes; a larger record has an archive of its own.

    Pages above archive_bytes / per_archive are written by classes of size, each up to twice the size of the
    one before with half the records an archive.
    """
    firsts = saved(first_pages(pages, id_col, html_col), "warc-first")
    # a percent-coded url has up to three times its bytes; all other header lines stay below 1 KiB
    most = F.octet_length(_payload(html_col)).cast("long") + 3 * F.coalesce(F.octet_length(col(url_col).cast("string")), F.lit(0)) + 1024
    level = F.greatest(F.lit(0), F.ceil(F.log2(most * per_archive / F.lit(float(archive_bytes))))).cast("int")
    classes = {r["level"] for r in pages.select(level.alias("level")).distinct().collect()}  # at most 32 numbers
    for i, c in enumerate(sorted(classes | {0})):
        some = pages if classes <= {0} else pages.filter(level == c)
        out = records(some, id_col, url_col, html_col, firsts=firsts).write.mode("append" if i else "error")
        out.option("lineSep", "\n").option("maxRecordsPerFile", max(1, per_archive >> c)).text(path)


class _Ahead:
    """The next place of a mark at or after a position. Positions hardly ever go back, and a place that is still
    ahead is not searched again: all searches together read the data about once, however many marks fail."""

    def __init__(self, data: bytes):
        self.data = data
        self.known: dict = {}

    def find(self, mark, at: int, use: int = 0) -> int:
        """mark: bytes, or a compiled pattern. len(data) if there is none. use: who asks; each has its own memory."""
        low, place = self.known.get((mark, use), (0, -1))
        if low <= at <= place:
            return place
        if isinstance(mark, bytes):
            place = self.data.find(mark, at)
        else:
            m = mark.search(self.data, at)
            place = m.start() if m else -1
        place = len(self.data) if place < 0 else place
        self.known[mark, use] = at, place
        return place


def _record(data: bytes, at: int, strict: bool, ahead: _Ahead) -> tuple[dict, bytes, int] | str:
    """(header, block, end) of the record at ``at``, or what is wrong with it."""
    if not _LINE.match(data, at):
        return "no version line"
    head = ahead.find(_END, at)
    if head == len(data):
        return "no end of header"
    if ahead.find(_LINE, at + 1) < head:
        return "version line inside header"  # what is between was lost
    lines = data[at:head].split(b"\r\n")
    header = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return "bad header line"
        header[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    length = header.get("content-length", "")
    if not (length.isascii() and length.isdigit() and len(length) < 19):
        return "bad length"
    start = head + 4
    end = start + int(length)
    if end > len(data):
        return "record is cut"
    if data[end:end + 4] != _END:
        return "no end mark"
    block = data[start:end]
    algorithm, _, digest = header.get("warc-block-digest", "").partition(":")
    if strict and algorithm != "sha256":
        return "no digest"
    if algorithm == "sha256" and hashlib.sha256(block).hexdigest() != digest.lower():
        return "digest differs"
    return header, block, end + 4


def _plain(data: bytes, strict: bool):
    """("record", header, block) and ("gap", start, end, why) of uncompressed records."""
    at, ahead = 0, _Ahead(data)
    while at < len(data):
        got = _record(data, at, strict, ahead)
        if not isinstance(got, str):
            yield "record", got[0], got[1]
            at = got[2]
            continue
        start, why = at, got
        while True:  # the next version line from which a whole record passes
            at = ahead.find(_LINE, at + 1)
            if at == len(data) or not isinstance(_record(data, at, strict, ahead), str):
                break
        yield "gap", start, at, why


_PLAIN_HEAD = _GZIP + b"\x00\x00\x00\x00\x00\x00\xff"


def _deflated(data: bytes, at: int, ahead: _Ahead) -> int:
    """Where the compressed bytes of the gzip member at ``at`` begin; len(data) if its header is not one.
    Names in the header are passed over without being read again for every mark inside them."""
    if at + 10 > len(data) or data[at + 3] & 0xE0:
        return len(data)
    flags, pos = data[at + 3], at + 10
    if flags & 4:
        pos += 2 + int.from_bytes(data[pos:pos + 2], "little")
    for name in (8, 16):
        if flags & name:
            pos = ahead.find(b"\x00", pos, name) + 1
    pos += 2 if flags & 2 else 0
    return min(pos, len(data)) if pos < len(data) and data[pos] & 6 != 6 else len(data)  # 6: no such block


def _inflate(data: bytes, pos: int, limit: int | None = None):
    """(bytes, place behind them, what is wrong) from the compressed bytes at ``pos``; at most ``limit`` bytes."""
    z, out, step, grow, left = zlib.decompressobj(31), [], 64, True, limit
    z.decompress(_PLAIN_HEAD)
    while not z.eof and pos < len(data) and (left is None or left > 0):
        before, piece = z.copy(), data[pos:pos + step]
        try:
            got = z.decompress(piece, 0 if left is None else left)
        except zlib.error as e:
            if step == 1:
                return b"".join(out), pos, f"bad member: {e}"
            z, step, grow = before, step // 2, False
            continue
        out.append(got)
        pos += len(piece) - len(z.unconsumed_tail)
        left = None if left is None else left - len(got)
        step = min(2 * step, _MEMBER_STEP) if grow else step  # most marks that are no member fail in a few bytes
    if not z.eof:
        return b"".join(out), pos, "member is cut"
    return b"".join(out), pos - len(z.unused_data), ""


def _member(data: bytes, at: int, ahead: _Ahead) -> tuple[bytes, int, str]:
    """What the gzip member at ``at`` inflates to, its end and what is wrong with it ("": nothing, its
    checksum is checked by zlib). Of a bad member the part before the first bad byte is inflated."""
    start = _deflated(data, at, ahead)
    return (b"", len(data), "bad member: header") if start == len(data) else _inflate(data, start)


def _piece(data: bytes, at: int, strict: bool, ahead: _Ahead) -> tuple[list, int, str] | str:
    """What the record or gzip member at ``at`` gives, where to go on and what is wrong from there on; or why it gives no record.

    A member that fails gives the records before its damage. Without its checksum to vouch for them, those of a
    bad member need a SHA-256 block digest. A cut member with one record and nothing else gives none.
    """
    if not data.startswith(_GZIP, at):
        got = _record(data, at, strict, ahead)
        return got if isinstance(got, str) else ([("record", got[0], got[1])], got[2], "")
    inflated, end, why = _member(data, at, ahead)
    inner = list(_plain(inflated, strict or why.startswith("bad")))
    last = max((i for i, x in enumerate(inner) if x[0] == "record"), default=-1)
    if last < 0 or (why == "member is cut" and len(inner) == 1):
        return why or "no record in member"
    if why:
        size = inner[last + 1][1] if last + 1 < len(inner) else len(inflated)
        inner, end = inner[:last + 1], _inflate(data, _deflated(data, at, ahead), size)[1]
        if end == len(data):  # nothing is left to be logged as the gap
            inner.append(("gap", 0, 0, why))
    return [x if x[0] == "record" else ("gap", at, end, x[3]) for x in inner], end, why


def salvage(data: bytes, strict: bool = False):
    """All good records and quarantined gaps of an archive, in order. Gaps are in bytes of the file.

    Plain records and gzip members may follow each other. After a failed check the reader goes on at the
    next version line or gzip magic, whichever comes first, that gives a record.
    strict: a record without a SHA-256 block digest fails too (write_archives gives all of them one).
    """
    at, got, ahead = 0, None, _Ahead(data)
    while at < len(data):
        got = got or _piece(data, at, strict, ahead)
        if isinstance(got, str):
            start, why, scan = at, got, at + 1
        else:
            items, at, why = got
            yield from items
            got, start, scan = None, at, at
            if not why:
                continue
        while True:
            at, got = min(ahead.find(_LINE, scan), ahead.find(_GZIP, scan)), None
            if at == len(data):
                break
            got = _piece(data, at, strict, ahead)
            if not isinstance(got, str):
                break
            scan = at + 1
        if start < at:
            yield "gap", start, at, why


_SCHEMA = ("archive string, gap_start long, gap_end long, reason string, record_id string, record_type string, "
           "refers_to string, target string, payload_digest string, payload_bytes long, payload binary")
_ARROW = pa.schema([("archive", pa.string()), ("gap_start", pa.int64()), ("gap_end", pa.int64()), ("reason", pa.string()), ("record_id", pa.string()), ("record_type", pa.string()),
                    ("refers_to", pa.string()), ("target", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])


def _row(archive: str, item, keep: bool) -> dict:
    if item[0] == "gap":
        return {"archive": archive, "gap_start": item[1], "gap_end": item[2], "reason": item[3]}
    _, header, block = item
    head, _, payload = block.partition(_END) if block.startswith(b"HTTP/") else (b"", b"", block)
    kind = header.get("warc-type")
    digest, size = hashlib.sha256(payload).hexdigest(), len(payload)
    if kind == "revisit":  # the payload is with the record that is referred to
        digest = header.get("warc-payload-digest", "").removeprefix("sha256:")
        sizes = [x.split(b":")[1].strip() for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:")]
        size = int(sizes[0]) if sizes and sizes[0].isdigit() else None
    return {"archive": archive, "record_id": header.get("warc-record-id"), "record_type": kind, "refers_to": header.get("warc-refers-to"), "target": header.get("warc-target-uri"),
            "payload_digest": digest, "payload_bytes": size, "payload": payload if keep and kind != "revisit" else None}


def _read_batches(batches, keep: bool, strict: bool, step: int = 500):
    for b in batches:
        for path, data in zip(b.column(0), b.column(1), strict=True):
            rows, size = [], 0
            for item in salvage(memoryview(data.as_buffer()).tobytes(), strict):
                rows.append(_row(path.as_py(), item, keep))
                size += len(rows[-1].get("payload") or b"")
                if len(rows) == step or size > _ROWS_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, _ARROW)
                    rows, size = [], 0
            yield pa.RecordBatch.from_pylist(rows, _ARROW)


def read_archives(spark, path: str, payloads: bool = True, strict: bool = False) -> DataFrame:
    """Records and gaps of all archives below path; gap rows have a reason and no record_id.

    One archive is one unit of work: keep archives well below an executor's memory, as write_archives does.
    """
    for_workers(spark)
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(functools.partial(_read_batches, keep=payloads, strict=strict), _SCHEMA)


def store_and_read(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", payloads: bool = True) -> DataFrame:
    """Write the pages' archives into the shared folder and read them back."""
    path = work_dir(pages.sparkSession, "warc")
    write_archives(pages, path, id_col, url_col, html_col)
    return read_archives(pages.sparkSession, path, payloads, strict=True)
