"""WARC archives: writing captures and assembling transactions (operator 5).

Writing. One capture is three records: a request, a response (or a revisit
of an equal payload) and a metadata record; request and metadata name the
response in WARC-Concurrent-To. Records are built by Spark expressions and
written through Spark's text writer: every record ends in CRLF CRLF, which is
the writer's line separator, so the files are WARC/1.1 files (gzip), written
under Spark's commit protocol to any file system that Spark reaches. A file
holds at most ``captures_per_file`` captures, and so few that it stays under
``FILE_BYTES`` if all were as long as the longest.

Which capture of equal payloads is the response (the one with the largest
id) is decided on narrow rows (id, digest): a partial aggregate, so a payload
that a third of all pages share is one row per input split. Only the revisits
are joined back to the pages, by a join planned on their stored size.

Reading. Plain (.warc) and gzip (.gz) files come through Spark's binary
reader, one task a file, and are parsed by Content-Length (a payload may hold
any bytes, also separators or record headers). SHA-1 digests of blocks and of
response payloads are checked where a record has them (this writer gives
payload digests); a wrong one fails the read, or, on request, drops the
record or keeps it with ``digest_ok`` false.

Transaction assembly. Requests, responses or revisits, and metadata are
joined through the concurrent-to identifiers into one nested row per capture.

Defined results: a NULL html is an empty payload; payloads under
``revisit_from`` bytes are never revisited; a NULL url is written as an empty
target; repeated rows with one id are captures of their own, with names of
their own, and rows that repeat the id and payload of a response are
responses too; rows without an id are not written (a record needs a name); an
empty table gives no captures; pages of any length that a row can hold are
written whole, a very long one in a file of its own; other columns of the
pages may have any name.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from candela.llm.common import stored

#: Bytes of an archive file before compression, unless one capture needs more.
FILE_BYTES = 256 << 20
CRLF = "\r\n"
END = CRLF + CRLF
# The RFC 4648 alphabet, the revisit profile, record names of this writer.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAME = "urn:capture:"

RECORD = (
    "file string, offset long, type string, record_id string, concurrent_to string, target_uri string, date string, "
    "refers_to string, payload_digest string, payload_bytes long, digest_ok boolean, payload binary, fields string"
)


DIGEST_OK = [c.split()[0] for c in RECORD.split(", ")].index("digest_ok")


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a column: five bits a letter, 40 bits (ten hex digits) at a time."""
    digest = F.sha1(payload)
    letters = []
    for part in range(4):
        number = F.conv(F.substring(digest, 1 + 10 * part, 10), 16, 10).cast("long")
        for letter in range(8):
            five = F.shiftright(number, 35 - 5 * letter).bitwiseAND(F.lit(31).cast("long")).cast("int")
            letters.append(F.substr(F.lit(BASE32), five + 1, F.lit(1)))
    return F.concat(*letters)


def _record(kind: Column | str, name: Column, date: str, headers: list[tuple[str, Column | None]], block: Column) -> Column:
    """A record up to its last block byte; the writer adds the closing CRLF CRLF."""
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.lit(kind) if isinstance(kind, str) else kind),
        F.concat(F.lit("WARC-Record-ID: <"), name, F.lit(">")),
        F.lit(f"WARC-Date: {date}"),
    ]
    lines += [F.concat(F.lit(f"{key}: "), value) for key, value in headers]  # NULL values: concat_ws leaves the line out
    lines.append(F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(END), block)


def decide_revisits(digests: DataFrame, revisit_from: int = 0) -> DataFrame:
    """(page_id, digest, refers_to) of the captures that revisit an equal payload; ``digests``: page_id, digest, bytes."""
    groups = (
        digests.where(F.col("bytes") >= revisit_from).groupBy("digest")
        .agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("least"))
        .where("least <> refers_to").select("digest", "refers_to")
    )
    groups = stored(groups, "warc-repeated")
    revisits = digests.join(groups, "digest").where("page_id <> refers_to")
    return revisits.select("page_id", "digest", "refers_to").distinct()


def write_archive(
    pages: DataFrame, path: str, revisit_from: int = 0, captures_per_file: int = 1000, date: str = "2024-01-01T00:00:00Z"
) -> None:
    """Write ``pages`` (page_id, url, html) as gzipped WARC files under ``path``."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.where("page_id IS NOT NULL").select(
        "page_id", F.coalesce("url", F.lit("")).alias("url"), html.alias("html"), base32_sha1(html).alias("digest")
    )
    longest = rows.agg(F.max(F.octet_length("html") + 2 * F.octet_length("url"))).first()[0] or 0
    captures_per_file = max(1, min(captures_per_file, FILE_BYTES // (longest + 2000)))
    digests = stored(rows.select("page_id", "digest", F.octet_length("html").cast("long").alias("bytes")), "warc-digests")
    repeated = digests.groupBy("page_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("page_id")
    again = digests.join(stored(repeated, "warc-ids"), "page_id", "left_semi").select("page_id", "digest", F.lit(True).alias("again")).distinct()
    # Narrow notes on the rows that need any, joined to the pages once (broadcast only where they are small).
    notes = stored(decide_revisits(digests, revisit_from).join(again, ["page_id", "digest"], "full"), "warc-notes")
    known = rows.join(notes, ["page_id", "digest"], "left")
    copy = F.when(F.col("again"), F.concat(F.lit("."), F.monotonically_increasing_id().cast("string"))).otherwise(F.lit(""))
    known = known.withColumn("name", F.concat(F.lit(NAME), F.col("page_id").cast("string"), copy))

    digest = F.concat(F.lit("sha1:"), F.col("digest"))
    target = ("WARC-Target-URI", F.regexp_replace("url", r"[\r\n]", ""))
    response_id = F.concat("name", F.lit(":response"))
    concurrent = ("WARC-Concurrent-To", F.concat(F.lit("<"), response_id, F.lit(">")))
    host = F.coalesce(F.regexp_extract("url", r"^[a-z+.-]+://([^/?#\r\n]*)", 1), F.lit(""))
    resource = F.regexp_replace(F.regexp_extract("url", r"^[a-z+.-]+://[^/?#\r\n]*([^#\r\n]*)", 1), "^$", "/")
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.octet_length("html").cast("string"), F.lit(END),
    )
    revisit = F.col("refers_to").isNotNull()
    request = _record(
        "request", F.concat("name", F.lit(":request")), date, [target, concurrent, ("Content-Type", F.lit("application/http; msgtype=request"))],
        F.concat(F.lit("GET "), resource, F.lit(f" HTTP/1.1{CRLF}Host: "), host, F.lit(END)),
    )
    response = _record(
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")), response_id, date,
        [
            target, ("WARC-Payload-Digest", digest),
            ("WARC-Refers-To", F.concat(F.lit(f"<{NAME}"), F.col("refers_to").cast("string"), F.lit(":response>"))),
            ("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
            ("Content-Type", F.lit("application/http; msgtype=response")),
        ],
        F.when(revisit, http).otherwise(F.concat(http, F.col("html"))),
    )
    metadata = _record(
        "metadata", F.concat("name", F.lit(":metadata")), date, [target, concurrent, ("Content-Type", F.lit("application/warc-fields"))],
        F.concat(F.lit("pageId: "), F.col("page_id").cast("string"), F.lit(CRLF)),
    )
    records = known.select(F.concat_ws(END, request, response, metadata).alias("value"))
    (
        records.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", captures_per_file).text(path)
    )


# -- reading -----------------------------------------------------------------

_HEADER = re.compile(rb"([^:\r\n]+):[ \t]*([^\r\n]*)")


#: Bytes of a file that are looked at in one step.
STEP = 1 << 20


def _plain(data: bytes | memoryview) -> Iterator[bytes]:
    """Decompressed parts of a file: plain, or any number of gzip members. The file itself is never copied as a whole."""
    view = memoryview(data)
    if bytes(view[:2]) != b"\x1f\x8b":
        for at in range(0, len(view), STEP):
            yield bytes(view[at : at + STEP])
        return
    member, left = zlib.decompressobj(wbits=31), b""
    for at in range(0, len(view), STEP):
        left = bytes(view[at : at + STEP])
        while left:
            if member.eof:
                member = zlib.decompressobj(wbits=31)
            part = member.decompress(left, STEP)
            left = member.unused_data if member.eof else member.unconsumed_tail
            if part:
                yield part
        while not member.eof and (part := member.decompress(b"", STEP)):
            yield part
    if not member.eof:
        raise ValueError("a gzip member is cut off")


def parse_records(parts: Iterator[bytes]) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers with lower-case names, block) of each record of a file, by Content-Length."""
    held, at = b"", 0

    def fill(n: int) -> bool:
        nonlocal held
        if len(held) < n:
            more = [held]
            size = len(held)
            while size < n:
                part = next(parts, None)
                if part is None:
                    break
                more.append(part)
                size += len(part)
            held = b"".join(more)
        return len(held) >= n

    while True:
        while fill(2) and held[:2] == b"\r\n":
            held, at = held[2:], at + 2
        if not held:
            return
        end = held.find(b"\r\n\r\n")
        while end < 0:
            if not fill(len(held) + 1):
                raise ValueError(f"no end of the record header at {at}")
            end = held.find(b"\r\n\r\n")
        head = held[:end]
        if not head.startswith(b"WARC/"):
            raise ValueError(f"no WARC record at {at}")
        headers = {k.strip().lower().decode(): v.strip().decode() for k, v in _HEADER.findall(head[head.find(b"\r\n") :])}
        size = int(headers["content-length"])
        if not fill(end + 4 + size):
            raise ValueError(f"the record at {at} is cut off")
        yield at, headers, held[end + 4 : end + 4 + size]
        held, at = held[end + 4 + size :], at + end + 4 + size


def _row(file: str, at: int, h: dict[str, str], block: bytes, with_payload: bool) -> tuple:
    kind = h.get("warc-type")
    bare = lambda name: h[name].strip("<>") if name in h else None
    payload = size = fields = None
    said_digest, block_digest = _sha1_of(h, "warc-payload-digest"), _sha1_of(h, "warc-block-digest")
    digest, checks = said_digest, []
    if block_digest is not None:
        checks.append(block_digest == _base32(block))
    if kind in ("response", "revisit"):
        cut = block.find(b"\r\n\r\n") + 4
        http, payload = block[:cut], block[cut:]
        said = {k.strip().lower(): v.strip() for k, v in _HEADER.findall(http)}
        if kind == "response":
            size = len(payload)
            digest = _base32(payload)
            if said_digest is not None:
                checks.append(said_digest == digest)
        else:  # its block has the HTTP header of the payload that it leaves out
            size, payload = int(said[b"content-length"]) if b"content-length" in said else None, None
    elif kind == "metadata":
        fields = block.decode("utf-8", "replace")
    return (
        file, at, kind, bare("warc-record-id"), bare("warc-concurrent-to"), h.get("warc-target-uri"), h.get("warc-date"),
        bare("warc-refers-to"), digest, size, all(checks) if checks else None, payload if with_payload else None, fields,
    )


def _sha1_of(h: dict[str, str], name: str) -> str | None:
    """The SHA-1 that a header gives; None without one, or where it is of another kind."""
    kind, _, value = h.get(name, "").partition(":")
    return value.upper() if kind.lower() == "sha1" and value else None


def _base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def read_records(spark: SparkSession, path: str, with_payload: bool = True, bad_digests: str = "fail") -> DataFrame:
    """All records of the WARC files under ``path`` (see RECORD); payloads are NULL without ``with_payload``.

    ``digest_ok`` is NULL where a record has no digest that is checked;
    ``bad_digests`` says what becomes of a record with a wrong one: "fail",
    "drop" or "keep".
    """
    if bad_digests not in ("fail", "drop", "keep"):
        raise ValueError("bad_digests must be 'fail', 'drop' or 'keep'")
    names = [c.split()[0] for c in RECORD.split(", ")]
    kinds = [
        pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(),
        pa.int64(), pa.bool_(), pa.binary(), pa.string(),
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                file, content = batch.column("path")[k].as_py(), batch.column("content")[k].as_buffer()
                rows, held = [], 0
                for at, headers, block in parse_records(_plain(memoryview(content))):
                    row = _row(file, at, headers, block, with_payload)
                    if row[DIGEST_OK] is False and bad_digests != "keep":
                        if bad_digests == "fail":
                            raise ValueError(f"wrong digest of the record at {at} in {file}")
                        continue
                    rows.append(row)
                    held += len(block) if with_payload else 200
                    if held > 8 << 20:
                        yield _batch(rows)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "{*.gz,*.warc}").load(path).select("path", "content")
    return files.mapInArrow(run, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: (capture_id, response, request, metadata).

    ``response`` is the response or revisit record; the others name it in
    their concurrent-to field (NULL where a capture has none).
    """
    side = lambda kind: (
        records.where(F.col("type") == kind)
        .select(F.col("concurrent_to").alias("capture_id"), F.struct("record_id", "target_uri", "date", "fields").alias(kind))
        .where("capture_id IS NOT NULL")
    )
    response = records.where(F.col("type").isin("response", "revisit")).select(
        F.col("record_id").alias("capture_id"),
        F.struct(
            "type", "record_id", "target_uri", "date", "refers_to", "payload_digest", "payload_bytes", "digest_ok", "payload"
        ).alias("response"),
    )
    return response.join(side("request"), "capture_id", "left").join(side("metadata"), "capture_id", "left")


def read_captures(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The captures of the archive under ``path``: its records are parsed once, stored, and assembled."""
    return assemble(stored(read_records(spark, path, with_payload), "warc-records"))


def capture_page_id(fields: Column) -> Column:
    """The pageId field of a metadata record."""
    return F.regexp_extract(fields, r"(?m)^pageId: (-?\d+)", 1).cast("long")


def referred_page_id(refers_to: Column) -> Column:
    """The page id in a record name of this writer."""
    return F.regexp_extract(refers_to, r"^" + re.escape(NAME) + r"(-?\d+)", 1).cast("long")
