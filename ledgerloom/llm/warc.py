"""Derivatives of web archive responses: linked metadata and plain-text conversion records.

Every response gives a ``metadata`` record (what is known of the page: length, title, number of links) and a ``conversion`` record
(the text of its payload). Both name the response in ``WARC-Refers-To`` and repeat its target, date and payload digest, so
the chain can be followed and checked. Ids are derived from the ids of the responses: a rerun writes the same records.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.pages import _events

_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: the name space for URLs
RESPONSE = "record_id string, target_uri string, date string, http string, payload string"
RECORD = (
    "source_id string, record_type string, record_id string, refers_to string, target_uri string, date string, content_type string, "
    "payload_digest string, block_digest string, content_length long, source_headers string, block string"
)
_COLUMNS = [c.split()[0] for c in RECORD.split(", ")]


def digest(data: bytes) -> str:
    """The usual form in archives: SHA-1 in base 32."""
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def derived_id(of: str, kind: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'{kind}|{of}')}>"


def page_responses(pages: DataFrame, date: str, page: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Response records of a table of pages: one ``RESPONSE`` per row, id and HTTP head derived from page id, URL and length.

    ``date`` is when they were fetched. NULL pages are empty payloads. The id of a page is part of its
    record id, so equal pages keep their own records.
    """

    def respond(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for i, u, h in zip(batch["page"], batch["url"], batch["html"]):
                size = len((h or "").encode())
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n"
                rows.append((i, derived_id(f"{i}|{u}|{digest((h or '').encode())}", "response"), u, date, head, h or ""))
            yield pd.DataFrame(rows, columns=["page", "record_id", "target_uri", "date", "http", "payload"])

    held = pages.select(F.col(page).cast("string").alias("page"), F.col(url).alias("url"), F.col(html).alias("html"))
    found = held.mapInPandas(respond, f"page string, {RESPONSE}")
    return found.withColumn("page", F.col("page").cast(pages.schema[page].dataType)).withColumnRenamed("page", page)


def plain_text(html: str | None) -> tuple[str, str, int]:
    """All visible text, menus, forms and boilerplate with it, one line per block; the title; the number of links."""
    parser = _events(html or "", visible=True)
    return "\n".join(x.text for x in parser.lines), parser.title, parser.links


def _records(r) -> Iterator[tuple]:
    text, title, links = plain_text(r.payload)
    payload = digest((r.payload or "").encode())
    meta = f"title: {title}\r\nlinks: {links}\r\npayload-length: {len((r.payload or '').encode())}\r\ntext-length: {len(text.encode())}\r\n"
    for kind, mime, block in (("metadata", "application/warc-fields", meta), ("conversion", "text/plain", text)):
        data = block.encode()
        yield (
            r.record_id, kind, derived_id(str(r.record_id), kind), r.record_id, r.target_uri, r.date, mime, payload, digest(data),
            len(data), r.http, block,
        )


def derivatives(responses: DataFrame) -> DataFrame:
    """Two rows (metadata, conversion) per response, ``RECORD`` columns.

    ``payload_digest`` is that of the source's payload, ``block_digest`` and ``content_length`` are the record's own;
    ``source_headers`` is the HTTP head of the response, unchanged. A NULL payload is an empty one, other NULLs stay
    NULL. Repeated responses give repeated records. Further columns are not read. An empty table gives none.
    """

    def derive(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([x for r in batch.itertuples(index=False) for x in _records(r)], columns=_COLUMNS)

    return responses.select("record_id", "target_uri", "date", "http", "payload").mapInPandas(derive, RECORD)


def record_bytes(r) -> bytes:
    """One record as it stands in a file."""
    block = (r.block or "").encode()
    head = [
        ("WARC-Type", r.record_type), ("WARC-Record-ID", r.record_id), ("WARC-Refers-To", r.refers_to), ("WARC-Target-URI", r.target_uri),
        ("WARC-Date", r.date), ("WARC-Payload-Digest", r.payload_digest), ("WARC-Block-Digest", r.block_digest),
        ("Content-Type", r.content_type), ("Content-Length", str(len(block))),
    ]
    # The source's head is folded into one field, line feeds as spaces after a tab.
    if r.source_headers:
        head.append(("X-Source-Headers", "\t ".join(r.source_headers.strip().splitlines())))
    lines = "".join(f"{k}: {v}\r\n" for k, v in head if v is not None)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def written_files(records: DataFrame, path: str) -> None:
    """Write records as a table of files' contents: each row of ``part`` is one compressed member of a WARC file.

    Members can be joined in any order into a ``.warc.gz``. They are written by Spark, to wherever Spark can write.
    """

    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            data = [gzip.compress(record_bytes(r), mtime=0) for r in batch.itertuples(index=False)]
            yield pd.DataFrame({"record_id": batch["record_id"], "member": data})

    records.mapInPandas(members, "record_id string, member binary").write.mode("errorifexists").parquet(path)


def read_records(data: bytes) -> list[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a (compressed) file; checks lengths and block digests."""
    data, out = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data, []
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        n = int(fields["Content-Length"])
        block = rest[:n]
        if digest(block) != fields["WARC-Block-Digest"] or rest[n : n + 4] != b"\r\n\r\n":
            raise ValueError(f"{fields['WARC-Record-ID']}: block is damaged")
        out.append((fields, block))
        data = rest[n + 4 :]
    return out
