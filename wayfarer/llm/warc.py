"""WARC derivatives: linked metadata and plain-text conversion records of response records.

A response is a row (record_id, target_uri, date, status, headers, payload,
payload_digest, block_digest); ``responses_of_pages`` makes such rows of a page
table, ``responses_of_warc`` of the response records of WARC files. Of each response, ``derivatives`` makes
two records: a ``metadata`` record, whose JSON block holds the source record's
WARC headers, its HTTP headers, digests and lengths, and the title, metas and
links of its HTML; and a ``conversion`` record, whose block is the text that a
reader sees. Both refer to the response by WARC-Refers-To, share its URI and
date, carry the digest of their own block, and the metadata names the
conversion record. Record ids come from the source's id and the record's kind,
so a job that runs again writes the same records.

Null HTML is an empty payload and gives an empty text; a null URI leaves its
header out; repeated rows give equal records, once for each row. Line ends and
other control characters in header values are percent-encoded. Nothing is cut
off, however long the page.

Files may be gzip members. What cannot be read as a record (no length, a length
that does not lead to the record's end, a damaged or cut member) becomes a row
marked ``malformed`` with its bytes; reading goes on at the next record. Blocks
and payloads that are not UTF-8 are read by their declared charset, else as
Latin-1. Chunks and content codings of HTTP are undone in ``payload``; the
payload digest stays that of the bytes as they were kept.
"""

from __future__ import annotations

import base64
import hashlib
import html
import json
import re
import uuid
import zlib
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfarer.llm.common import map_texts

RESPONSE = ("record_id string, target_uri string, date string, status string, headers array<struct<name:string,value:string>>, "
            "payload string, payload_digest string, block_digest string")
RECORD = ("warc_type string, record_id string, refers_to string, target_uri string, date string, content_type string, "
          "content_length long, block_digest string, source_payload_digest string, linked_record_id string, block string")
_HEADER = pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())]))
#: Names under which record ids are made, one for each kind of record.
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:warc-derivatives")

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"                                                             # comment
    r"|<(script|style|noscript|template)\b[^>]*+>.*?(?:</\1\s*+>|\Z)"                # content that is not shown
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"              # tag
    r"|<[!?][^>]*+>", re.S | re.I)                                                    # declaration
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?")
_BLOCKS = frozenset("address article aside blockquote body br caption dd div dl dt fieldset figure footer form h1 h2 h3 h4 h5 h6 head "
                    "header hr html li main nav ol option p pre section table tbody td tfoot th thead title tr ul".split())
_LINKS = {"a": "href", "area": "href", "img": "src", "link": "href", "iframe": "src", "form": "action", "source": "src",
          "video": "src", "audio": "src", "embed": "src", "base": "href"}


def digest(raw: bytes) -> str:
    """A WARC digest label: SHA-1 in base 32."""
    return "sha1:" + base64.b32encode(hashlib.sha1(raw).digest()).decode("ascii")


def http_block(status: str, headers: list[tuple[str, str]], payload: bytes) -> bytes:
    """The block of a response record: status line, headers, payload."""
    head = "".join(f"{k}: {v}\r\n" for k, v in headers)
    return f"HTTP/1.1 {status}\r\n{head}\r\n".encode("utf-8") + payload


def _attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(text):
        out.setdefault(name.lower(), html.unescape(a or b or c))
    return out


def parse_page(page: str, uri: str | None) -> tuple[str, dict]:
    """(shown text, {title, metas, links}) of an HTML page; links are resolved against its URI."""
    lines, line, title, metas, links = [], [], [], [], []
    base, in_title, anchor, at = uri or "", False, None, 0

    def flush() -> None:
        text = " ".join("".join(line).split())
        if text:
            lines.append(text)
        line.clear()

    def shown(raw: str) -> None:
        text = html.unescape(raw)
        line.append(text)
        if in_title:
            title.append(text)
        if anchor is not None:
            anchor[1].append(text)

    for m in _TOKEN.finditer(page):
        if m.start() > at:
            shown(page[at:m.start()])
        at = m.end()
        name = m[3]
        if not name:
            continue
        name, closing = name.lower(), bool(m[2])
        if name in _BLOCKS:
            flush()
        if name == "title":
            in_title = not closing
        elif name == "a" and closing:
            anchor = None
        if closing:
            continue
        if name in _LINKS or name == "meta":
            attrs = _attributes(m[4])
            if name == "meta":
                metas.append(attrs)
            elif value := attrs.get(_LINKS[name]):
                try:
                    target = urljoin(base, value.strip())
                except ValueError:
                    target = value
                if name == "base":
                    base = target
                    continue
                links.append((f"{name.upper()}@/{_LINKS[name]}", [], target, attrs.get("alt") or attrs.get("rel")))
                anchor = links[-1] if name == "a" else anchor
    if at < len(page):
        shown(page[at:])
    flush()
    squeeze = lambda parts: " ".join("".join(parts).split())
    found = []
    for path, text, target, note in links:
        link = {"path": path, "url": target}
        if label := squeeze(text) or note:
            link["text"] = label
        found.append(link)
    return "\n".join(lines), {"title": squeeze(title) or None, "metas": metas, "links": found}


def record_id(source: str, kind: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{kind}:{source}')}>"


def derive(r: dict) -> tuple[dict, dict]:
    """The metadata and the conversion record of a response."""
    payload = r["payload"] or ""
    raw = payload.encode("utf-8", "surrogatepass")
    text, page = parse_page(payload, r["target_uri"])
    conversion, meta = record_id(r["record_id"], "conversion"), record_id(r["record_id"], "metadata")
    headers = [(h["name"], h["value"]) for h in r["headers"] or []]
    envelope = {
        "WARC-Header-Metadata": {k: v for k, v in (
            ("WARC-Type", "response"), ("WARC-Record-ID", r["record_id"]), ("WARC-Target-URI", r["target_uri"]),
            ("WARC-Date", r["date"]), ("WARC-Payload-Digest", r["payload_digest"]), ("WARC-Block-Digest", r["block_digest"]))
            if v is not None},
        "Payload-Metadata": {"HTTP-Response-Metadata": {
            "Response-Message": {"Status": r["status"], "Version": "HTTP/1.1"}, "Headers": headers,
            "Entity-Length": len(raw), "Entity-Digest": digest(raw), "HTML-Metadata": {
                "Head": {"Title": page["title"], "Metas": page["metas"]}, "Links": page["links"]}}},
        "Conversion-Record-ID": conversion}
    common = {"refers_to": r["record_id"], "target_uri": r["target_uri"], "date": r["date"],
              "source_payload_digest": r["payload_digest"]}
    out = []
    for kind, own, other, mime, block in (
            ("metadata", meta, conversion, "application/json", json.dumps({"Envelope": envelope}, ensure_ascii=False)),
            ("conversion", conversion, meta, "text/plain; charset=utf-8", text)):
        b = block.encode("utf-8", "surrogatepass")
        out.append({"warc_type": kind, "record_id": own, "linked_record_id": other, "content_type": mime,
                    "content_length": len(b), "block_digest": digest(b), "block": block, **common})
    return out[0], out[1]


def responses_of_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                       date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """(id, response columns) of a page table: each page as the response that a crawler would have kept."""
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html"))

    def make(batches):
        for b in batches:
            out = []
            for i, u, h in zip(b.column("id").to_pylist(), b.column("url").to_pylist(), b.column("html").to_pylist()):
                raw = (h or "").encode("utf-8", "surrogatepass")
                headers = [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(raw)))]
                own = digest(raw)
                out.append({"id": i, "record_id": record_id(f"{i}:{u}:{own}", "response"), "target_uri": u, "date": date,
                            "status": "200 OK", "headers": [{"name": k, "value": v} for k, v in headers], "payload": h or "",
                            "payload_digest": own, "block_digest": digest(http_block("200 OK", headers, raw))})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([
                b.schema.field("id"), *[(n, _HEADER if n == "headers" else pa.string()) for n in (
                    "record_id", "target_uri", "date", "status", "headers", "payload", "payload_digest", "block_digest")]]))

    kind = rows.schema["id"].dataType.simpleString()
    return map_texts(rows, make, f"id {kind}, {RESPONSE}")


def derivatives(responses: DataFrame) -> DataFrame:
    """(id, record columns): a metadata and a conversion record of each response (id, response columns)."""
    names = [c.split()[0] for c in RECORD.split(", ")]
    keep = ["id", "record_id", "target_uri", "date", "status", "headers", "payload", "payload_digest", "block_digest"]
    rows = responses.select(*keep)

    def make(batches):
        for b in batches:
            records, at = [], []
            for k, r in enumerate(b.to_pylist()):
                records += derive(r)
                at += [k, k]
            yield pa.RecordBatch.from_arrays(
                [b.column("id").take(pa.array(at, pa.int64()))]
                + [pa.array([r[n] for r in records], pa.int64() if n == "content_length" else pa.string()) for n in names],
                names=["id", *names])

    kind = rows.schema["id"].dataType.simpleString()
    return map_texts(rows, make, f"id {kind}, {RECORD}")


# -- HTTP -------------------------------------------------------------------------

def decoded(raw: bytes, charset: str | None = None) -> str:
    """``raw`` in its declared charset, else UTF-8, else Latin-1: the first that fits."""
    for name in (charset, "utf-8"):
        try:
            if name:
                return raw.decode(name)
        except (UnicodeDecodeError, LookupError, ValueError):
            continue
    return raw.decode("latin-1")


def _unchunked(raw: bytes) -> bytes:
    """The data of a chunked body; ``raw`` itself where its chunks do not fit."""
    out, at = [], 0
    while True:
        end = raw.find(b"\r\n", at)
        size = raw[at:max(end, at)].split(b";")[0].strip()
        if not re.fullmatch(rb"[0-9A-Fa-f]{1,15}", size) or end + 2 + int(size, 16) > len(raw):
            return raw
        if not int(size, 16):
            return b"".join(out)
        out.append(raw[end + 2:end + 2 + int(size, 16)])
        at = end + 2 + int(size, 16) + 2


def http_response(block: bytes) -> tuple[str | None, list[tuple[str, str]], bytes, str]:
    """(status, headers, payload bytes as kept, payload as text) of a response block.

    A block without a status line is all payload, with status null.
    """
    if not block.startswith(b"HTTP/"):
        return None, [], block, decoded(block)
    head, gap, payload = block.partition(b"\r\n\r\n")
    first, *lines = decoded(head).split("\r\n")
    headers: list[tuple[str, str]] = []
    for line in lines:
        name, colon, value = line.partition(":")
        if line[:1] in " \t" and headers:                      # a value that goes on
            headers[-1] = (headers[-1][0], f"{headers[-1][1]} {line.strip()}")
        elif colon:
            headers.append((name.strip(), value.strip()))
    of = {k.lower(): v for k, v in reversed(headers)}
    body = _unchunked(payload) if "chunked" in of.get("transfer-encoding", "").lower() else payload
    if of.get("content-encoding", "").lower() in ("gzip", "x-gzip", "deflate"):
        for bits in (47, -15):
            try:
                body = zlib.decompressobj(bits).decompress(body)
                break
            except zlib.error:
                continue
    charset = re.search(r"charset\s*=\s*[\"']?([^\s;\"']+)", of.get("content-type", ""), re.I)
    return first.partition(" ")[2], headers, payload, decoded(body, charset and charset[1])


# -- files ------------------------------------------------------------------------

def _header(name: str, value: Column) -> Column:
    safe = F.regexp_replace(value, r"[\x00-\x1F\x7F]", "%20")
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), safe, F.lit("\r\n"))).otherwise("")


def write_warc(records: DataFrame, path: str, compression: str | None = None) -> None:
    """Write records as WARC files, one for each partition, through Spark's own writer (any file system).

    The two line ends that close a WARC record are the writer's line separator.
    """
    c = F.col
    text = F.concat(
        F.lit("WARC/1.0\r\n"), _header("WARC-Type", c("warc_type")), _header("WARC-Record-ID", c("record_id")),
        _header("WARC-Date", c("date")), _header("WARC-Target-URI", c("target_uri")), _header("WARC-Refers-To", c("refers_to")),
        _header("WARC-Block-Digest", c("block_digest")),
        F.when(c("warc_type") == "response", _header("WARC-Payload-Digest", c("source_payload_digest")))
        .otherwise(_header("X-Source-Payload-Digest", c("source_payload_digest"))),
        _header("X-Linked-Record-ID", c("linked_record_id")), _header("Content-Type", c("content_type")),
        _header("Content-Length", c("content_length").cast("string")), F.lit("\r\n"), c("block"))
    w = records.select(text.alias("value")).write.option("lineSep", "\r\n\r\n")
    (w.option("compression", compression) if compression else w).text(path)


def response_records(responses: DataFrame) -> DataFrame:
    """(id, record columns): the response records themselves, as ``write_warc`` takes them."""
    names = [c.split()[0] for c in RECORD.split(", ")]

    def make(batches):
        for b in batches:
            records = []
            for r in b.to_pylist():
                block = http_block(r["status"], [(h["name"], h["value"]) for h in r["headers"] or []],
                                   (r["payload"] or "").encode("utf-8", "surrogatepass"))
                records.append({**r, "warc_type": "response", "content_type": "application/http; msgtype=response",
                                "content_length": len(block), "block_digest": digest(block), "block": block.decode("utf-8"),
                                "source_payload_digest": r["payload_digest"]})
            yield pa.RecordBatch.from_arrays(
                [b.column("id")] + [pa.array([r.get(n) for r in records], pa.int64() if n == "content_length" else pa.string())
                                    for n in names], names=["id", *names])

    rows = responses.select("id", "record_id", "target_uri", "date", "status", "headers", "payload", "payload_digest")
    return map_texts(rows, make, f"id {rows.schema['id'].dataType.simpleString()}, {RECORD}")


def gunzip(raw: bytes) -> tuple[bytes, bool]:
    """What the gzip members of ``raw`` hold up to the first damage, and whether all of it could be read."""
    out, at = [], 0
    while raw[at:at + 2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        while at < len(raw) and not member.eof:
            part = raw[at:at + (1 << 16)]
            try:
                out.append(member.decompress(part))
            except zlib.error:
                return b"".join(out), False
            at += len(part) - len(member.unused_data)
        if not member.eof:
            return b"".join(out), False
    return b"".join(out), not raw[at:].strip(b"\0")


def parse_warc(raw: bytes) -> list[dict]:
    """Records of a WARC file: headers (lower-case names) and block, by their Content-Length; or ``malformed`` and its bytes."""
    raw, whole = gunzip(raw) if raw[:2] == b"\x1f\x8b" else (raw, True)
    out, at = [], 0
    while at < len(raw):
        if raw[at:at + 2] == b"\r\n":                           # blank lines between records
            at += 2
            continue
        end = raw.find(b"\r\n\r\n", at)
        lines = raw[at:max(end, at)].decode("utf-8", "replace").split("\r\n")
        head = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        size = head.get("content-length", "")
        stop = end + 4 + int(size) if re.fullmatch(r"[0-9]{1,15}", size) else -1
        if lines[0].startswith("WARC/") and 0 <= stop <= len(raw) and raw[stop:stop + 4] in (b"\r\n\r\n", b""):
            out.append({"version": lines[0], **head, "block": raw[end + 4:stop]})
            at = stop + 4
        else:
            after = raw.find(b"\r\n\r\nWARC/", at)
            stop = len(raw) if after < 0 else after + 4
            out.append({"malformed": True, "block": raw[at:stop]})
            at = stop
    return out if whole else [*out, {"malformed": True, "block": b""}]


def _parsed_files(spark: SparkSession, path: str, rows_of, schema: pa.Schema, ddl: str) -> DataFrame:
    def make(batches):
        for b in batches:
            for content in b.column("content"):
                records = parse_warc(content.as_py())
                for i in range(0, len(records), 256):
                    yield pa.RecordBatch.from_pylist([x for r in records[i:i + 256] for x in rows_of(r)], schema=schema)

    return map_texts(spark.read.format("binaryFile").load(path).select("content"), make, ddl)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(warc_type, record_id, refers_to, target_uri, date, digests, content_type, linked_record_id, block, malformed) of the
    records of WARC files, compressed or not.

    A file is read by one task, as only the lengths in it tell records apart;
    write files of a size that a task can hold.
    """
    names = {"warc_type": "warc-type", "record_id": "warc-record-id", "refers_to": "warc-refers-to",
             "target_uri": "warc-target-uri", "date": "warc-date", "block_digest": "warc-block-digest",
             "payload_digest": "warc-payload-digest", "source_payload_digest": "x-source-payload-digest",
             "linked_record_id": "x-linked-record-id", "content_type": "content-type"}

    def rows_of(r: dict) -> list[dict]:
        return [{**{k: r.get(v) for k, v in names.items()}, "block": decoded(r["block"]), "malformed": "malformed" in r}]

    schema = pa.schema([*[(k, pa.string()) for k in (*names, "block")], ("malformed", pa.bool_())])
    return _parsed_files(spark, path, rows_of, schema, ", ".join(f"{k} string" for k in (*names, "block")) + ", malformed boolean")


def responses_of_warc(spark: SparkSession, path: str) -> DataFrame:
    """(id, response columns) of the response records of WARC files, ``id`` being the record's id; digests that the record
    does not name are made of its bytes. Other and malformed records are for ``read_warc``."""
    def rows_of(r: dict) -> list[dict]:
        if r.get("warc-type", "").lower() != "response":
            return []
        status, headers, kept, payload = http_response(r["block"])
        own = r.get("warc-block-digest") or digest(r["block"])
        name = r.get("warc-record-id") or record_id(f"{r.get('warc-target-uri')}:{own}", "response")
        return [{"id": name, "record_id": name, "target_uri": r.get("warc-target-uri"), "date": r.get("warc-date"),
                 "status": status, "headers": [{"name": k, "value": v} for k, v in headers], "payload": payload,
                 "payload_digest": r.get("warc-payload-digest") or digest(kept), "block_digest": own}]

    schema = pa.schema([(n, _HEADER if n == "headers" else pa.string()) for n in (
        "id", "record_id", "target_uri", "date", "status", "headers", "payload", "payload_digest", "block_digest")])
    return _parsed_files(spark, path, rows_of, schema, f"id string, {RESPONSE}")
