"""WARC archives: written with an index, read back by coalesced byte ranges.

Writing: every page becomes one gzip member.  Of equal payloads the one with the
smallest page_id is a response, the others are revisits without payload.  Who revisits
whom is settled on digests, before any payload moves; payloads are shuffled once.
Every task writes archives of its own, under names no other attempt uses, and returns
the index rows of what it wrote.  Only archives named in the index count, so a task
that runs twice after a loss leaves an orphan file but no wrong record.

Reading: the selected index rows are dealt by archive and sorted by offset, ranges that
lie close together become one read, and every payload is checked against its digest.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymatrix.session import materialize, new_folder

MIN_REVISIT_BYTES = 100
ARCHIVE_BYTES = 256 << 20  # an archive is closed beyond this size
GAP_BYTES = 64 << 10  # unselected bytes read along rather than skipped
READ_BYTES = 8 << 20  # a coalesced read ends beyond this size
SALTS = 16
DATE = "2024-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = (
    "page_id bigint, url string, archive string, offset bigint, length bigint, payload_bytes bigint, "
    "payload_digest string, record_type string, refers_to bigint"
)


def _payload(html: Column) -> Column:
    return F.coalesce(html, F.lit("")).cast("binary")


def revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(page_id, digest, refers_to) of the pages that repeat an earlier payload."""
    keys = materialize(
        pages.select("page_id", F.sha2(_payload(F.col("html")), 256).alias("digest"), F.octet_length(_payload(F.col("html"))).alias("n"))
        .where((F.col("n") >= min_bytes) & F.col("page_id").isNotNull())
        .select("page_id", "digest"),
        "digests",
    )
    # A payload may own a third of all rows: copies are spread, their first is repeated.
    firsts = (
        keys.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1")
        .select("digest", "refers_to", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    )
    copies = keys.withColumn("salt", F.pmod("page_id", F.lit(SALTS)).cast("int"))
    return copies.join(firsts, ["digest", "salt"]).where("page_id <> refers_to").select("page_id", "digest", "refers_to").distinct()


def _header(url: str | None, page: int | None, digest: str, refers_to: int | None, size: int, payload: int, date: str) -> bytes:
    target = "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url or "about:blank")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page is None else page}>",
        f"WARC-Target-URI: {target}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Payload-Length: {payload}",
    ]
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {size}"]
    return "\r\n".join(lines).encode("utf-8", "replace") + b"\r\n\r\n"


def write_archives(pages: DataFrame, folder: str, min_bytes: int = MIN_REVISIT_BYTES, date: str = DATE) -> DataFrame:
    """Write a record per page below ``folder`` and return the written index.

    Null html is an empty payload.  Rows that repeat a page_id are written each; a row
    equal to the response of its payload is a response too.  Pages without an id are
    responses.  Other columns are ignored.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = fs.FileSystem.from_uri(folder)
        out, name, at = None, "", 0
        try:
            for batch in batches:
                rows = []
                for page, url, html, digest, refers_to in batch.itertuples(index=False):
                    page = None if pd.isna(page) else int(page)
                    refers_to = None if pd.isna(refers_to) else int(refers_to)
                    payload = (html or "").encode("utf-8", "surrogatepass") if isinstance(html, str) else b""
                    block = HTTP + payload if refers_to is None else HTTP
                    head = _header(url, page, digest, refers_to, len(block), len(payload), date)
                    member = gzip.compress(head + block + b"\r\n\r\n", 6, mtime=0)
                    if out is None or at >= ARCHIVE_BYTES:
                        if out is not None:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = system.open_output_stream(f"{root}/{name}", compression=None)
                    out.write(member)
                    kind = "response" if refers_to is None else "revisit"
                    rows.append((page, url, name, at, len(member), len(payload), digest, kind, refers_to))
                    at += len(member)
                yield _index_frame(rows)
        finally:
            if out is not None:
                out.close()

    system, root = fs.FileSystem.from_uri(folder)
    system.create_dir(root, recursive=True)
    again = revisits(pages, min_bytes)
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), "url", "html",
        F.sha2(_payload(F.col("html")), 256).alias("digest"),
    ).join(again, ["page_id", "digest"], "left").select("page_id", "url", "html", "digest", "refers_to")
    return materialize(rows.mapInPandas(write, INDEX), "index")


def _index_frame(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=[c.split()[0] for c in INDEX.split(", ")])
    return frame.astype({"page_id": "Int64", "refers_to": "Int64"})


def coalesced(ranges: list[tuple[int, int]], gap: int = GAP_BYTES, most: int = READ_BYTES) -> list[tuple[int, int, list[int]]]:
    """Sorted (offset, length) as reads: (offset, length, which ranges)."""
    reads: list[tuple[int, int, list[int]]] = []
    for i, (offset, length) in enumerate(ranges):
        if reads:
            start, size, held = reads[-1]
            if offset - (start + size) <= gap and offset + length - start <= most:
                reads[-1] = (start, max(size, offset + length - start), [*held, i])
                continue
        reads.append((offset, length, [i]))
    return reads


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload of one record."""
    record = gzip.decompress(member)
    head, _, block = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = block[: int(fields["Content-Length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """Records named by (a selection of) the index, as read from the archives:
    page_id, url, payload_bytes, payload_digest, record_type, refers_to, html (null
    for revisits).  A payload that does not match its digest raises an error."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, part in batch.groupby("archive", sort=False):
                part = part.sort_values("offset")
                spots = list(zip(part["offset"].tolist(), part["length"].tolist()))
                urls = part["url"].tolist()
                with system.open_input_file(f"{root}/{name}") as file:
                    for start, size, held in coalesced(spots):
                        data = file.read_at(size, start)
                        yield _records(data, start, [spots[i] for i in held], [urls[i] for i in held])

    schema = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, html string"
    dealt = index.select("archive", "offset", "length", "url").repartitionByRange("archive", "offset").sortWithinPartitions("archive", "offset")
    return dealt.mapInPandas(read, schema)


def _id(field: str | None) -> int | None:
    number = field[len("<urn:page:") : -1] if field else ""
    return int(number) if number else None


def _records(data: bytes, start: int, spots: list[tuple[int, int]], urls: list[str | None]) -> pd.DataFrame:
    rows = []
    for (offset, length), url in zip(spots, urls):
        fields, payload = parse(data[offset - start : offset - start + length])
        digest = fields["WARC-Payload-Digest"].partition(":")[2]
        kind = fields["WARC-Type"]
        if kind == "response":
            if hashlib.sha256(payload).hexdigest() != digest or len(payload) != int(fields["X-Payload-Length"]):
                raise ValueError(f"record at {offset} does not match its digest")
        rows.append((
            _id(fields["WARC-Record-ID"]), url, int(fields["X-Payload-Length"]), digest, kind,
            _id(fields.get("WARC-Refers-To")), payload.decode("utf-8", "surrogatepass") if kind == "response" else None,
        ))
    frame = pd.DataFrame(rows, columns=["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "html"])
    return frame.astype({"page_id": "Int64", "refers_to": "Int64"})


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages into a new folder below the shared one and read them back."""
    folder = new_folder(pages.sparkSession, "warc")
    if "://" not in folder and folder.startswith("file:"):
        folder = "file://" + folder.removeprefix("file:")
    return read_records(write_archives(pages, folder), folder)


ORACLE_SQL = f"""
WITH payloads AS (
  SELECT page_id, sha256(coalesce(html, '')) AS payload_digest,
    CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes
  FROM pages
), firsts AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM payloads
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= {MIN_REVISIT_BYTES} AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= {MIN_REVISIT_BYTES} AND page_id <> first THEN first END AS refers_to
FROM firsts
"""
