"""WARC archives: a writer with deduplicated revisits and a splittable reader.

Archives are files of gzip members, one record each. The reader cuts files into byte ranges; a task
looks for the gzip magic in its range, takes a candidate as a member only if its header decodes and
the data begin with a WARC version line, and owns the records that start inside the range, reading
past its end for the last one. From a member's end it goes on to the next without searching.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partflow.llm.common import shared_dir, table, written

REVISIT_BYTES = 1000
ARCHIVE_BYTES, SPLIT_BYTES, READ_BYTES = 256 << 20, 4 << 20, 1 << 18
#: Ranges are longer than SPLIT_BYTES where there would be more than so many.
MOST_SPLITS = 200_000
DATE = "2001-08-02T00:00:00Z"
MAGIC = b"\x1f\x8b\x08"
RECORD = (
    "path string, offset long, length long, warc_type string, record_id string, refers_to string, "
    "target_uri string, digest string, full_length long, payload binary"
)


def _store(uri: str):
    from pyarrow import fs

    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    return (fs.LocalFileSystem(), uri) if uri.startswith("/") else fs.FileSystem.from_uri(uri)


def _header_value(text: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def encode_record(page_id, url, payload: bytes, refers_to, is_revisit: bool) -> bytes:
    """A gzip member with one response or revisit record; a revisit has the HTTP header alone."""
    urn = lambda i: f"<urn:page:{'none' if i is None else i}>"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http if is_revisit else http + payload
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if is_revisit else 'response'}", f"WARC-Record-ID: {urn(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_header_value(url)}")
    if is_revisit:
        lines += [f"WARC-Refers-To: {urn(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(body)}"]
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n") + pack.flush()


def _sha1_of(digest: str) -> str | None:
    """The digest in hexadecimal; None if it isn't a SHA-1 in base 32 or base 16."""
    if not digest.lower().startswith("sha1:"):
        return None
    digest = digest[5:]
    if re.fullmatch(r"[0-9a-fA-F]{40}", digest):
        return digest.lower()
    return base64.b32decode(digest.upper()).hex() if re.fullmatch(r"[A-Za-z2-7]{32}", digest) else None


def decode_record(data: bytes) -> dict | None:
    """The fields of a decompressed record, or None if it isn't a whole WARC record."""
    head, found, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not found or not lines[0].startswith(b"WARC/1."):
        return None
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.decode("utf-8", "replace").partition(":") for x in lines[1:])}
    n = fields.get("content-length", "")
    if not n.isdigit() or len(rest) < int(n):
        return None
    body, full = rest[: int(n)], None
    if fields.get("content-type", "").startswith("application/http"):
        http, _, body = body.partition(b"\r\n\r\n")
        m = re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", http)
        full = int(m[1]) if m else None
    return {
        "warc_type": fields.get("warc-type"),
        "record_id": fields.get("warc-record-id"),
        "refers_to": fields.get("warc-refers-to"),
        "target_uri": fields.get("warc-target-uri"),
        "digest": _sha1_of(fields.get("warc-payload-digest", "")),
        "full_length": full if full is not None else len(body),
        "payload": body,
    }


class _Bytes:
    """A file's bytes, read in blocks as they are asked for and held until they are let go."""

    def __init__(self, file, start: int, size: int):
        self.file, self.first, self.size, self.data = file, start, size, bytearray()

    def let_go(self, place: int) -> None:
        """What is before place isn't needed again."""
        del self.data[: place - self.first]
        self.first = place

    def at(self, place: int, n: int) -> bytes:
        """Up to n bytes from place on; fewer only at the file's end."""
        while self.first + len(self.data) < min(place + n, self.size):
            self.file.seek(self.first + len(self.data))
            got = self.file.read(max(READ_BYTES, place + n - self.first - len(self.data)))
            if not got:
                break
            self.data += got
        return bytes(self.data[place - self.first : place - self.first + n])


def _member(source: _Bytes, place: int) -> tuple[bytes, int] | None:
    """The data and compressed length of a gzip member at place, if it holds a WARC record."""
    head = source.at(place, 10)
    if len(head) < 10 or head[:3] != MAGIC or head[3] & 0xE0:
        return None
    out, used = [], 0
    unpack, n = zlib.decompressobj(31), 4096
    try:
        while not unpack.eof:
            got = source.at(place + used, n)
            if not got:
                return None  # cut off
            out.append(unpack.decompress(got))
            used += len(got)
            if len(out) == 1 and not b"WARC/1.".startswith(out[0][:7]) and out[0][:7] != b"WARC/1.":
                return None
            n = READ_BYTES
    except zlib.error:
        return None
    return b"".join(out), used - len(unpack.unused_data)


def records_in(file, size: int, start: int, end: int) -> Iterator[tuple[int, int, dict]]:
    """Offset, length and fields of the records that start in [start, end)."""
    source, place = _Bytes(file, start, size), start
    while place < end:
        source.let_go(min(place, source.first + len(source.data)))
        found = _member(source, place)
        fields = decode_record(found[0]) if found else None
        if fields:
            yield place, found[1], fields
            place += found[1]
            continue
        block = source.at(place + 1, READ_BYTES)
        at = block.find(MAGIC)
        if at >= 0:
            place += 1 + at
        elif len(block) < READ_BYTES:
            return
        else:
            place += 1 + len(block) - 2  # the magic may begin in the last two bytes


def write_archives(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes rows (page_id, url, payload, is_revisit, refers_to) as archives; returns rows (path, size).

    Every task attempt writes files of its own, and only those of attempts that Spark accepted are
    in the returned table, so lost executors leave at worst files that nothing names.
    """

    def write(batches):
        fs, base = _store(folder)
        fs.create_dir(base, recursive=True)
        done, file, path, size = [], None, "", 0
        for batch in batches:
            for row in batch.itertuples(index=False):
                if file is None:
                    path = f"{uuid.uuid4().hex}.warc.gz"
                    file, size = fs.open_output_stream(f"{base}/{path}", compression=None), 0
                number = lambda x: None if pd.isna(x) else int(x)
                size += file.write(
                    encode_record(number(row.page_id), row.url, bytes(row.payload), number(row.refers_to), bool(row.is_revisit))
                )
                if size >= archive_bytes:
                    file.close()
                    done.append((f"{folder}/{path}", size))
                    file = None
        if file is not None:
            file.close()
            done.append((f"{folder}/{path}", size))
        yield pd.DataFrame(done, columns=["path", "size"])

    rows = records.select(
        F.col("page_id").cast("string"), "url", "payload", F.col("refers_to").cast("string"), "is_revisit"
    )
    return written(rows.mapInPandas(write, "path string, size long"), "archives")


def read_archives(archives: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The records of archives (path, size): where each lies, its header fields and its payload.

    full_length is the length that the HTTP header names, for a revisit that of the payload it
    leaves out. Bytes between records, records cut off at a file's end and members that aren't WARC
    are passed over; a digest that isn't a SHA-1 is null. An empty table or empty files give no rows. A
    task holds one record at a time whole, of any length, and passes on records in batches of some megabytes.
    """
    split_bytes = max(split_bytes, -(-(archives.agg(F.sum("size")).first()[0] or 0) // MOST_SPLITS))
    n_splits = archives.agg(F.sum(F.ceil(F.col("size") / split_bytes))).first()[0] or 1

    def read(batches):
        for batch in batches:
            for row in batch.itertuples(index=False):
                fs, path = _store(row.path)
                with fs.open_input_file(path) as file:
                    rows, held = [], 0
                    for offset, length, fields in records_in(file, row.size, row.start, row.end):
                        rows.append({"path": row.path, "offset": offset, "length": length, **fields})
                        held += len(fields["payload"])
                        if held > 8 << 20:
                            yield pd.DataFrame(rows)
                            rows, held = [], 0
                    if rows:
                        yield pd.DataFrame(rows)

    starts = F.explode(F.sequence(F.lit(0), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(split_bytes))).alias("start")
    splits = archives.select("path", "size", starts).withColumn("end", F.least("size", F.col("start") + split_bytes))
    # As many tasks as ranges: the rows that name them are too small for Spark to tell how much each task reads.
    splits = splits.repartition(int(n_splits), F.col("path"), F.col("start"))
    return splits.select("path", "size", "start", "end").mapInPandas(read, RECORD)


def with_revisits(pages: DataFrame, least_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Rows (page_id, url, payload, is_revisit, refers_to) for pages (page_id, url, html).

    Null html is an empty payload. Of equal payloads of least_bytes or more, the row with the
    largest page_id is the response (each row, if that page_id repeats) and the others revisit it;
    a null page_id is smaller than any, and among null ones alone all are responses. Other columns are
    ignored, whatever their names; an empty table gives an empty result.
    """
    rows = pages.select("page_id", "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    first = (
        rows.filter(F.octet_length("payload") >= least_bytes)
        .groupBy("digest")
        .agg(F.max("page_id").alias("response"), F.count("*").alias("n"))
        .filter("n > 1")
        .drop("n")
    )
    # Written first: a join of two plain shuffles can split the rows of a frequent payload. Small payloads are spread.
    first = written(first, "responses")
    key = F.when(F.octet_length("payload") >= least_bytes, F.col("digest")).otherwise(F.concat(F.lit("-"), F.xxhash64("page_id", "url")))
    rows = rows.withColumn("digest", key)
    revisit = F.col("response").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response"))
    return rows.join(first, "digest", "left").select(
        "page_id", "url", "payload", revisit.alias("is_revisit"), F.when(revisit, F.col("response")).alias("refers_to")
    )


def op7_warc(spark, sf_dir: str) -> DataFrame:
    folder = f"{shared_dir(spark)}/partflow-warc-{uuid.uuid4().hex}"
    found = read_archives(write_archives(with_revisits(table(spark, sf_dir, "pages")), folder))
    page = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")
    is_revisit = F.col("warc_type") == "revisit"
    return found.select(
        page("record_id").alias("page_id"),
        F.when(is_revisit, F.col("full_length")).otherwise(F.octet_length("payload")).cast("long").alias("payload_bytes"),
        F.when(is_revisit, F.col("digest")).otherwise(F.sha1("payload")).alias("payload_digest"),
        F.col("warc_type").alias("record_type"),
        F.when(is_revisit, page("refers_to")).alias("refers_to"),
    )


OP7_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS digest FROM pages),
first AS (SELECT digest, max(page_id) AS response FROM p WHERE n >= 1000 GROUP BY digest)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
  CASE WHEN response IS NULL OR response IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN response IS NULL OR response IS NOT DISTINCT FROM page_id THEN NULL ELSE response END AS refers_to
FROM p LEFT JOIN first USING (digest)
"""
