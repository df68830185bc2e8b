"""WARC archives: writing with segmentation, and reading with segment reassembly.

Writing: one response record per page, its HTTP block in chunked transfer framing. Of pages with
equal payloads of at least ``REVISIT_FROM`` bytes the one with the largest id is the response,
the others are revisit records that refer to it. A block longer than a segment is cut: the
first part stays in the response (segment 1), the others are continuation records that name the
origin's record id; the last one also states the total length. Each record is a gzip member of its own.
Archives are written by Spark's text writer to any store it can reach: a row is a run of members, and the
writer's separator is the zero byte with which a member ends (the top byte of its length). A file has at most
``BUNDLES`` runs of about ``BUNDLE_BYTES`` before compression.

Reading: gzip members are inflated one by one, so a task holds one file's compressed bytes and
one run of records; plain archives are read as well. Each archive is read once. Records that are whole are decoded
there. Segments are grouped by origin id, ordered by number, checked (numbers 1 to n once each, total
length as stated) and joined, and then decoded; only they are shuffled. A group is one record, as long as one page.
A record that fails a check (framing, length, segments) comes out with ``complete`` false and no payload; bytes
that are no record end that archive with one row without a record id, ``complete`` false. No record are a header of more than
``HEADER_BYTES`` bytes, and one whose ``Content-Length`` is absent, repeated or not plain digits; a chunk's size must be
plain hexadecimal digits. Files are limited to the 2 GB that one binary value of Spark holds.

A revisit names the record id of the response it repeats (``WARC-Refers-To``), which is a record of the archive; revisits are
resolved by that id. ``refers_to_record`` gives it for any archive, ``refers_to`` the page id of our own records.

Defined cases: a null page is an empty payload; a null id or url is an empty header and comes back as
null; pages that repeat id and payload are all responses if they are the largest id; very long pages are cut into
segments of bounded size; an empty table gives no archive records; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import store

REVISIT_FROM = 1000
SEGMENT = 8 << 10
#: The size of a gzip member fits in three bytes below this, so that its last byte is the separator.
LONGEST_SEGMENT = 15 << 20
HEADER_BYTES = 64 << 10
CHUNK = 4 << 10
BUNDLES, BUNDLE_BYTES = 16, 4 << 20
_DATE = "2024-01-01T00:00:00Z"
_FIELDS = "record_id string, page_id long, url string, record_type string, refers_to long, refers_to_record string, digest string"
_DIGITS, _HEX, _OWN_ID = re.compile("[0-9]{1,18}"), re.compile(rb"[0-9A-Fa-f]{1,15}"), re.compile("<urn:page:(-?[0-9]+)#[^>]*>")


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return b"WARC/1.1\r\n" + head.encode() + b"Content-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n"


def _chunked(payload: bytes) -> bytes:
    parts = []
    for i in range(0, len(payload), CHUNK):
        part = payload[i : i + CHUNK]
        parts += [b"%x\r\n" % len(part), part, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def dechunked(body: bytes) -> bytes:
    """The payload of a chunked body; ValueError if the framing is broken."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        told = body[at:end].split(b";")[0].strip(b" \t")
        if not _HEX.fullmatch(told):
            raise ValueError("chunk size isn't plain hexadecimal digits")
        size, at = int(told, 16), end + 2
        if size == 0:
            return b"".join(out)
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk without its end")
        out.append(body[at : at + size])
        at += size + 2


def _page_records(page, url, number, payload, digest, target, segment) -> list[bytes]:
    name = "" if page is None else str(page)
    rid = f"<urn:page:{name}#{number}>"
    fields = [("WARC-Type", "revisit" if target is not None else "response"), ("WARC-Record-ID", rid), ("WARC-Date", _DATE),
              ("WARC-Target-URI", (url or "").replace("\r", "").replace("\n", "")), ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Page-ID", name)]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if target is not None:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                   ("WARC-Refers-To", f"<urn:page:{target}#{digest}>"), ("Content-Type", "application/http;msgtype=response")]
        return [_record(fields, http + b"\r\n")]
    fields.append(("Content-Type", "application/http;msgtype=response"))
    block = http + b"Transfer-Encoding: chunked\r\n\r\n" + _chunked(payload)
    if len(block) <= segment:
        return [_record(fields, block)]
    out = [_record([*fields, ("WARC-Segment-Number", "1")], block[:segment])]
    for k, i in enumerate(range(segment, len(block), segment), 2):
        own = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:page:{name}#{number}-{k}>"), ("WARC-Date", _DATE),
               ("WARC-Segment-Origin-ID", rid), ("WARC-Segment-Number", str(k))]
        if i + segment >= len(block):
            own.append(("WARC-Segment-Total-Length", str(len(block))))
        out.append(_record(own, block[i : i + segment]))
    return out


def _member(record: bytes) -> bytes:
    """One gzip member that ends with a zero byte."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    out = packer.compress(record) + packer.flush()
    return out if out.endswith(b"\0") else out + b"\0"


def _writer(segment: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("page_id", "url", "tag", "digest", "target")]
            pages = batch.column("html").cast(pa.binary())
            held, size = [], 0
            for k, (page, url, number, digest, target) in enumerate(zip(*cols)):
                for record in _page_records(page, url, number, pages[k].as_py() or b"", digest, target, segment):
                    held.append(_member(record))
                    size += len(record)
                    if size > BUNDLE_BYTES:
                        # the text writer adds the zero byte that ends the last member
                        yield pa.record_batch([pa.array([b"".join(held)[:-1]], pa.binary())], names=["records"])
                        held, size = [], 0
            if held:
                yield pa.record_batch([pa.array([b"".join(held)[:-1]], pa.binary())], names=["records"])

    return run


def write_archives(pages: DataFrame, path: str, segment: int = SEGMENT) -> None:
    """Write ``pages`` (page_id, url, html) as gzip archives under ``path``."""
    if not 0 < segment <= LONGEST_SEGMENT:
        raise ValueError(f"a segment has from 1 to {LONGEST_SEGMENT} bytes")
    body = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    d = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), F.sha1(body).alias("digest"),
                     F.octet_length(body).alias("size"))
    d = d.withColumn("n", F.monotonically_increasing_id())
    # rows of the largest id may repeat: the first of them is the one referred to
    of_id = d.where(F.col("size") >= REVISIT_FROM).groupBy("digest", "size", "page_id").agg(F.count("*").alias("c"), F.min("n").alias("first"))
    equal = store.saved(
        of_id.groupBy("digest", "size").agg(F.sum("c").alias("c"), F.max(F.struct("page_id", F.col("c").alias("times"), "first")).alias("top"))
        .where("c > 1 and top.page_id is not null").select("digest", "size", "top"),
        "equal-pages",
    )
    d = d.join(store.hinted(equal), ["digest", "size"], "left")
    same = F.col("page_id").eqNullSafe(F.col("top.page_id"))
    target = F.when(F.col("top").isNotNull() & ~same, F.col("top.page_id"))
    # the record id of a response that others refer to is known beforehand: it ends with the digest
    named = F.col("top").isNotNull() & same & ((F.col("top.times") == 1) | (F.col("n") == F.col("top.first")))
    tag = F.when(named, F.col("digest")).otherwise(F.col("n").cast("string"))
    rows = d.select("page_id", "url", "html", "digest", target.alias("target"), tag.alias("tag"))
    (
        rows.mapInArrow(_writer(segment), "records binary").select(F.col("records").cast("string").alias("value"))
        .write.option("lineSep", "\0").option("maxRecordsPerFile", BUNDLES).text(path)
    )


def _inflated(data: bytes) -> Iterator[bytes]:
    """The members of a gzip file, zero bytes between them skipped; a plain file as it is."""
    if data[:2] != b"\x1f\x8b":
        yield data
        return
    at = 0
    while at < len(data):
        if data[at] == 0:
            at += 1
            continue
        member, parts = zlib.decompressobj(31), []
        while at < len(data) and not member.eof:
            parts.append(member.decompress(data[at : at + (1 << 16)]))
            at += min(1 << 16, len(data) - at) - len(member.unused_data)
        if not member.eof:
            raise ValueError("gzip member without its end")
        yield b"".join(parts)


def records(data: bytes) -> Iterator[tuple[dict[str, str], bytes, bool]]:
    """(headers, block, whether the block is as long as stated) of each record of an archive.

    Raises ValueError where the bytes are no record; those before it have come out by then.
    """
    try:
        for part in _inflated(data):
            at = 0
            while at < len(part):
                end = part.index(b"\r\n\r\n", at, at + HEADER_BYTES)
                lines = part[at:end].decode("utf-8").split("\r\n")
                if not lines[0].startswith("WARC/"):
                    raise ValueError("no WARC record here")
                pairs = [(k.strip().lower(), v.strip()) for k, _, v in (x.partition(":") for x in lines[1:])]
                lengths, head = [v for k, v in pairs if k == "content-length"], dict(pairs)
                if len(lengths) != 1 or not _DIGITS.fullmatch(lengths[0]):
                    raise ValueError("the length of a record is one number of plain digits")
                size = int(lengths[0])
                block = part[end + 4 : end + 4 + size]
                yield head, block, len(block) == size and part[end + 4 + size : end + 8 + size] == b"\r\n\r\n"
                at = end + 8 + size
    except zlib.error as broken:
        raise ValueError("broken gzip member") from broken


def _http_payload(block: bytes) -> bytes:
    head, _, body = block.partition(b"\r\n\r\n")
    return dechunked(body) if b"transfer-encoding: chunked" in head.lower() else body


def _number(text: str | None) -> int | None:
    return int(text) if text and _DIGITS.fullmatch(text.removeprefix("-")) else None


def _page(head: dict[str, str]):
    refers = head.get("warc-refers-to") or None
    own = _OWN_ID.fullmatch(refers or "")
    return (head.get("warc-record-id"), _number(head.get("x-page-id")), head.get("warc-target-uri") or None, head.get("warc-type"),
            _number(own[1]) if own else None, refers, head.get("warc-payload-digest", "").partition(":")[2] or None)


_NAMES = [f.split()[0] for f in _FIELDS.split(", ")]
_READ = _FIELDS + ", origin string, number long, total long, block binary, payload binary, complete boolean"


def _reader(batches: Iterator) -> Iterator:
    """Whole records with their payloads, and segments with their origin and blocks."""
    import pyarrow as pa

    names = [f.split()[0] for f in _READ.split(", ")]
    types = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}
    kinds = [types[f.split()[1]] for f in _READ.split(", ")]

    def batch_of(rows):
        cols = list(zip(*rows)) or [()] * len(names)
        return pa.record_batch([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)

    def row_of(head, block, sound):
        if "warc-segment-number" in head and (head.get("warc-segment-origin-id") or head.get("warc-record-id")):
            return (*_page(head), head.get("warc-segment-origin-id") or head.get("warc-record-id"), _number(head["warc-segment-number"]),
                    _number(head.get("warc-segment-total-length")), block, None, sound)
        payload = None
        if sound and head.get("warc-type") != "revisit":
            try:
                payload = _http_payload(block)
            except ValueError:
                sound = False
        return (*_page(head), None, None, None, None, payload, sound)

    for batch in batches:
        for content in batch.column("content"):
            rows, size = [], 0
            try:
                for head, block, sound in records(content.as_py()):
                    rows.append(row_of(head, block, sound))
                    size += len(block)
                    if size > 4 << 20:
                        yield batch_of(rows)
                        rows, size = [], 0
            except ValueError:
                rows.append((None,) * (len(names) - 1) + (False,))
            if rows:
                yield batch_of(rows)


def _joined(key, table):
    import pyarrow as pa

    rows = sorted(table.to_pylist(), key=lambda r: r["number"] or 0)
    first = rows[0]
    block = b"".join(r["block"] for r in rows)
    sound = ([r["number"] for r in rows] == list(range(1, len(rows) + 1)) and rows[-1]["total"] == len(block) and len(rows) > 1
             and all(r["complete"] for r in rows))
    payload = None
    if sound:
        try:
            payload = _http_payload(block)
        except ValueError:
            sound = False
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary(), pa.bool_()]
    values = [first[c] for c in _NAMES] + [payload, sound]
    return pa.table([pa.array([v], t) for v, t in zip(values, kinds)], names=[*_NAMES, "payload", "complete"])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """record_id, page_id, url, record_type, refers_to, refers_to_record, digest, payload (null for revisits), complete."""
    files = spark.read.format("binaryFile").load(path).select("content")
    read = store.saved(files.mapInArrow(_reader, _READ), "warc-read")
    joined = read.where("origin is not null").groupBy("origin").applyInArrow(_joined, _FIELDS + ", payload binary, complete boolean")
    return read.where("origin is null").select(*_NAMES, "payload", "complete").unionByName(joined)


def round_trip(pages: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """Write, read back and resolve: page_id, payload_bytes, payload_digest, record_type, refers_to, complete."""
    spark = pages.sparkSession
    path = store.new_path(spark, "warc")
    write_archives(pages, path, segment)
    found = store.saved(
        read_archives(spark, path).where("record_id is not null").select(
            "record_id", "page_id", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"),
            "record_type", "refers_to", "refers_to_record", "digest", "complete"),
        "warc-records",
    )
    own = found.where("record_type <> 'revisit'")
    at = own.where("payload_bytes is not null").select(
        F.col("record_id").alias("refers_to_record"), F.col("payload_digest").alias("there"), F.col("payload_bytes").alias("bytes"))
    again = found.where("record_type = 'revisit'").join(at, "refers_to_record", "left")
    resolved = F.coalesce(F.col("there") == F.col("digest"), F.lit(False))
    again = again.select(
        "page_id", F.when(resolved, F.col("bytes")).alias("payload_bytes"), F.when(resolved, F.col("digest")).alias("payload_digest"),
        "record_type", "refers_to", resolved.alias("complete"))
    same = F.col("complete") & F.col("payload_digest").eqNullSafe(F.col("digest"))
    return own.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", same.alias("complete")).unionByName(again)
