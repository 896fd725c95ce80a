"""WARC derivatives: metadata and plain-text conversion records of responses."""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the format.
VERSION, CRLF = "WARC/1.1", "\r\n"
FIELDS_TYPE, TEXT_TYPE = "application/warc-fields", "text/plain; charset=UTF-8"

_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
_HIDDEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template)\b[^>]*>.*?(?:</\1\s*>|\Z)", re.S | re.I
)
_BREAK = re.compile(
    r"</?(?:p|div|br|hr|li|ul|ol|dl|dt|dd|h[1-6]|tr|td|th|table|article|section|nav|header|footer"
    r"|title|head|body|html|main|aside|form|pre|blockquote)\b[^<>]*>", re.I
)
_TAG = re.compile(r"<[^<>]*>")
_TITLE = re.compile(r"<title\b[^<>]*>([^<]*)", re.I)
_LANGUAGE = re.compile(r"<html\b[^<>]*\blang\s*=\s*[\"']?([A-Za-z-]+)", re.I)
_LINK = re.compile(r"<a\b[^<>]*\bhref\s*=\s*[\"']([^\"'<>]*)", re.I)
_BLANKS = re.compile(r"[^\S\n]+")


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def plain_text(markup: str) -> str:
    """Visible text, a line per block element, character references resolved."""
    shown = _TAG.sub("", _BREAK.sub("\n", _HIDDEN.sub(" ", markup)))
    lines = (_BLANKS.sub(" ", line).strip() for line in html.unescape(shown).split("\n"))
    return "\n".join(line for line in lines if line)


def one_line(value: str) -> str:
    """A value as it may stand in a header or field: no line breaks."""
    return " ".join(value.split())


def parse(text: str) -> tuple[dict[str, str], str]:
    """Headers and block of one record."""
    head, _, rest = text.partition(CRLF + CRLF)
    version, *lines = head.split(CRLF)
    if version != VERSION:
        raise ValueError(f"not a record: {version[:40]!r}")
    headers = dict(line.split(": ", 1) for line in lines)
    return headers, rest.encode()[: int(headers["Content-Length"])].decode()


def _derive(response: dict) -> list[dict]:
    source, uri, date = response["record_id"], response["target_uri"], response["date"]
    head, payload = response["http_headers"] or "", response["payload"] or ""
    ids = {
        kind: f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{source} {kind}')}>"
        for kind in ("metadata", "conversion")
    }
    payload_digest = response["payload_digest"] or digest(payload.encode())
    title, language = _TITLE.search(payload), _LANGUAGE.search(payload)
    fields = [
        ("source-block-digest", digest((head + CRLF + CRLF + payload).encode())),
        ("source-payload-digest", payload_digest),
        ("conversion", ids["conversion"]),
        ("title", html.unescape(title.group(1)) if title else None),
        ("language", language.group(1) if language else None),
        *[("source-header", line) for line in head.split(CRLF) if line],
        *[("outlink", html.unescape(link)) for link in _LINK.findall(payload)],
    ]
    blocks = {
        "metadata": "".join(f"{n}: {one_line(v)}{CRLF}" for n, v in fields if v is not None),
        "conversion": plain_text(payload),
    }
    out = []
    for kind, block in blocks.items():
        data = block.encode()
        out.append({
            "warc_type": kind, "record_id": ids[kind], "refers_to": source,
            "concurrent_to": ids["conversion" if kind == "metadata" else "metadata"],
            "target_uri": uri, "date": date, "content_type": FIELDS_TYPE if kind == "metadata" else TEXT_TYPE,
            "content_length": len(data), "block_digest": digest(data),
            "source_payload_digest": payload_digest, "block": block,
        })
    return out


_COLUMNS = ["warc_type", "record_id", "refers_to", "concurrent_to", "target_uri", "date",
            "content_type", "content_length", "block_digest", "source_payload_digest", "block"]
_INPUT = ["record_id", "target_uri", "date", "http_headers", "payload", "payload_digest"]
_ARROW = pa.schema([(c, pa.int64() if c == "content_length" else pa.string()) for c in _COLUMNS])


def _convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 200):
            rows = [r for response in batch.slice(at, 200).to_pylist() for r in _derive(response)]
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)


def derivatives(responses: DataFrame) -> DataFrame:
    """Two records for every response: ``metadata`` and ``conversion``.

    ``responses``: record_id, target_uri, date, http_headers (lines of the response head),
    payload (markup), payload_digest (worked out if null). Both records refer to the response
    by id, address and date, and to each other. Metadata carries the digests of the
    source, its header lines one by one, title, language and links; the conversion is the
    visible text. Null heads and payloads are empty, headers without a value are left
    out. Ids follow from the response's id, so reruns agree and repeated rows repeat their records.
    No shuffle; each row by itself.

    Columns: as in ``_COLUMNS``; ``record`` makes a whole record of them.
    """
    schema = ", ".join(f"{c} {'long' if c == 'content_length' else 'string'}" for c in _COLUMNS)
    return responses.select(*[F.col(c).cast("string").alias(c) for c in _INPUT]).mapInArrow(
        _convert, schema
    )


def responses_of_pages(pages: DataFrame, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Crawled pages (page_id, url, html) as response records. They have no date of
    their own, so one for all is given. The id follows from all three columns."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    name = F.md5(F.concat_ws("\n", F.col("page_id").cast("string"), F.md5("url"), F.md5(payload)))
    parts = [F.substring(name, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length(payload),
    )
    return pages.select(
        F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">")).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.lit(date).alias("date"),
        head.alias("http_headers"),
        payload.alias("payload"),
        F.lit(None).cast("string").alias("payload_digest"),
    )


# Header names, and the columns they take their values from.
HEADERS = {
    "WARC-Type": "warc_type", "WARC-Record-ID": "record_id", "WARC-Refers-To": "refers_to",
    "WARC-Refers-To-Target-URI": "target_uri", "WARC-Refers-To-Date": "date",
    "WARC-Concurrent-To": "concurrent_to", "WARC-Target-URI": "target_uri", "WARC-Date": "date",
    "WARC-Block-Digest": "block_digest", "Content-Type": "content_type",
    "Content-Length": "content_length",
}


def record() -> Column:
    """A record as text: header lines, blank line and block. Headers without a value
    are left out; the two line ends that close a record are put in by ``write_warc``."""
    lines = [
        F.concat(F.lit(f"{name}: "), F.regexp_replace(F.col(column).cast("string"), r"\s+", " "))
        for name, column in HEADERS.items()
    ]
    return F.concat(F.concat_ws(CRLF, F.lit(VERSION), *lines), F.lit(CRLF + CRLF), F.col("block"))


def write_warc(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Store records as WARC files, one a task."""
    records.select(record().alias("record")).write.option("lineSep", CRLF + CRLF).option(
        "compression", compression
    ).text(path)
