"""WARC derivatives: of each response record a metadata record and a plain-text conversion record.

Both refer to the response by its record id and repeat its target, date and
digests. Record ids are made from what the record holds, so a task that runs
again, on another executor, writes the same records.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
from collections.abc import Iterator
from urllib.parse import quote, urljoin

import pandas as pd
from pyspark.sql import DataFrame, functions as F

VERSION = b"WARC/1.1"
#: Date of responses whose source has none.
NO_DATE = "1970-01-01T00:00:00Z"

_HIDDEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|template|noscript)\b.*?(?:</\1\s*>|\Z)", re.S | re.I)
_TITLE = re.compile(r"<title\b[^>]*>(.*?)</title\s*>", re.S | re.I)
_LINK = re.compile(r"""<a\b[^>]*?\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.S | re.I)
_CHARSET = re.compile(rb"""<meta\b[^>]*?\bcharset\s*=\s*["']?\s*([\w.:-]+)""", re.I)
_BLOCK = re.compile(
    r"</?(?:address|article|aside|blockquote|body|br|caption|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|h[1-6]"
    r"|head|header|hr|html|li|main|nav|ol|option|p|pre|section|select|table|tbody|td|tfoot|th|thead|title|tr|ul)\b[^>]*>",
    re.I,
)
_TAG = re.compile(r"</?[a-zA-Z][^>]*>|<[!?][^>]*>")
_TYPE_CHARSET = re.compile(r"charset\s*=\s*\"?([\w.:-]+)", re.I)


def digest(data: bytes) -> str:
    """SHA-1 in base 32, as WARC files write it."""
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str | bytes) -> str:
    """A name-based URN of what a record holds."""
    sized = [p if isinstance(p, bytes) else p.encode("utf-8", "surrogatepass") for p in parts]
    name = hashlib.sha256(b"".join(len(p).to_bytes(8, "big") + p for p in sized)).digest()
    return f"<urn:uuid:{uuid.UUID(bytes=name[:16], version=5)}>"


def one_line(value: str) -> str:
    """A header value without line ends and other control characters."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: quote(m[0]), value)


def serialize(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A record: version, headers, block and the two line ends after it."""
    head = [VERSION] + [f"{k}: {one_line(v)}".encode("utf-8", "surrogatepass") for k, v in headers]
    return b"\r\n".join(head) + f"\r\nContent-Length: {len(block)}".encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers by lower-case name, and the block. Raises ValueError where a record breaks the format."""
    head, found, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not found or not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record")
    headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    size = int(headers.get("content-length", "-1"))
    if not 0 <= size <= len(rest):
        raise ValueError("the block is cut off")
    return headers, rest[:size]


def response(url: str | None, body: bytes, name: str, date: str = NO_DATE) -> bytes:
    """The response record of a fetched page."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode()
    headers = [
        ("WARC-Type", "response"), ("WARC-Record-ID", record_id("response", name, url or "", body)), ("WARC-Date", date),
        *([("WARC-Target-URI", url)] if url is not None else []), ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", digest(body)), ("WARC-Block-Digest", digest(http + body)),
    ]
    return serialize(headers, http + body)


def http_message(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status line, headers and payload of an HTTP response; a block without headers is all payload."""
    head, found, payload = block.partition(b"\r\n\r\n")
    if not found or not block.startswith(b"HTTP/"):
        return "", [], block
    first, *lines = head.decode("latin-1").split("\r\n")
    return first, [(k.strip(), v.strip()) for k, _, v in (line.partition(":") for line in lines)], payload


def decode(payload: bytes, content_type: str) -> tuple[str, str]:
    """The payload as text, and the character set: that of the header, else of the page, else UTF-8."""
    stated = _TYPE_CHARSET.search(content_type)
    meta = None if stated else _CHARSET.search(payload)
    name = stated[1] if stated else meta[1].decode() if meta else "utf-8"
    try:
        return payload.decode(name, "replace"), name.lower()
    except (LookupError, ValueError):
        return payload.decode("utf-8", "replace"), "utf-8"


def plain_text(visible: str) -> str:
    """Text of a page without hidden parts: a line for each block, white space collapsed, no empty lines."""
    lines = html.unescape(_TAG.sub("", _BLOCK.sub("\n", visible))).split("\n")
    return "\n".join(line for line in (" ".join(line.split()) for line in lines) if line)


def derive(record: bytes) -> list[dict]:
    """The metadata and the conversion record of a response; nothing for other types of records."""
    source, block = parse(record)
    if source.get("warc-type") != "response":
        return []
    status, http, payload = http_message(block)
    content_type = next((v for k, v in http if k.lower() == "content-type"), "")
    page, charset = decode(payload, content_type)
    visible = _HIDDEN.sub(" ", page)
    title, url = _TITLE.search(visible), source.get("warc-target-uri")
    links = []
    for match in _LINK.finditer(visible):
        link = html.unescape(match[1] or match[2] or match[3] or "").strip()
        try:
            links.append(urljoin(url or "", link))
        except ValueError:
            links.append(link)
    payload_digest = source.get("warc-payload-digest") or digest(payload)
    fields = [("status", status), ("charset", charset), ("title", " ".join(html.unescape(title[1]).split()) if title else "")]
    fields += [("source-header", f"{k}: {v}") for k, v in http]
    fields += [("source-payload-digest", payload_digest), ("source-block-digest", source.get("warc-block-digest") or digest(block))]
    fields += [("outlink", link) for link in links]
    about = "".join(f"{k}: {one_line(v)}\r\n" for k, v in fields).encode("utf-8", "surrogatepass")
    text = plain_text(visible).encode("utf-8", "surrogatepass")
    out = []
    for kind, mime, content in (("metadata", "application/warc-fields", about), ("conversion", "text/plain; charset=utf-8", text)):
        name, refers = record_id(kind, source.get("warc-record-id", ""), content), source.get("warc-record-id", "")
        headers = [("WARC-Type", kind), ("WARC-Record-ID", name), ("WARC-Date", source.get("warc-date", NO_DATE)), ("WARC-Refers-To", refers)]
        headers += [("WARC-Target-URI", url)] if url is not None else []
        headers += [("Content-Type", mime), ("WARC-Block-Digest", digest(content))]
        out.append({
            "record_type": kind, "record_id": name, "refers_to": refers, "target_uri": url, "content_type": mime,
            "content_length": len(content), "block_digest": digest(content), "source_payload_digest": payload_digest,
            "record": serialize(headers, content),
        })
    return out


_FIELDS = (
    "record_type string, record_id string, refers_to string, target_uri string, content_type string, "
    "content_length bigint, block_digest string, source_payload_digest string, record binary"
)


def responses(pages: DataFrame, key: str = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """``key, record``: a response record for each page. A null page has an empty body, a null address no target."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = zip(batch["name"], batch["url"], batch["body"])
            records = [response(u, (b or "").encode("utf-8", "surrogatepass"), n or "") for n, u, b in rows]
            yield pd.DataFrame({"key": batch["key"], "record": records})

    rows = pages.select(F.col(key).alias("key"), F.col(key).cast("string").alias("name"), F.col(url).alias("url"), F.col(body).alias("body"))
    out = rows.mapInPandas(work, f"key {rows.schema['key'].dataType.simpleString()}, record binary")
    return out.withColumnRenamed("key", key)


def derivatives(records: DataFrame, key: str = "page_id", record: str = "record") -> DataFrame:
    """Two rows for each response record: its metadata record and its plain-text conversion record.

    ``key`` and the fields of the new record, and ``record``, the whole record as
    bytes: written one after another they are a WARC file. Null and broken records
    and records of other types give no rows. Equal responses give equal records.
    Null keys are kept; other columns are not read.
    """

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for k, data in zip(batch["key"].tolist(), batch["record"]):
                try:
                    rows += [{"key": k, **made} for made in derive(data)] if data is not None else []
                except ValueError:
                    continue
            if rows:
                yield pd.DataFrame(rows).astype({"key": object})

    rows = records.select(F.col(key).alias("key"), F.col(record).alias("record"))
    out = rows.mapInPandas(work, f"key {rows.schema['key'].dataType.simpleString()}, {_FIELDS}")
    return out.withColumnRenamed("key", key)
