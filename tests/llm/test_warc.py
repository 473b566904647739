"""WARC derivatives: text against an independent parser, digests, links and files."""

import base64
import hashlib
import json
from html.parser import HTMLParser

from wayfarer.llm.warc import derivatives, parse_page, parse_warc, read_warc, responses_of_pages, write_warc

PAGES = [
    (1, "http://a.example/x/y?q=1#f", "<!DOCTYPE html><html><head><title>A &amp; B</title><meta name=k content='v'><style>p{}</style>"
        "<script>var t=\"</p>\";</script></head><body><nav><a href='/one'>One <b>1</b></a><img src=\"p.png\" alt=\"pic > x\"></nav>"
        "<!-- no <p>text</p> --><p>Caf&eacute;   au\nlait<br>next</p><P>caps</P>1 < 2 & 3</body></html>"),
    (2, "http://b.example/", ""), (3, None, None), (4, "not a url\r\nX: y", "plain text only"), (5, "http://c.example", "<p>open <b>tag"),
    (None, "http://d.example", "<p>null id</p>"), (6, "http://e.example", "<div " + "x" * 50_000 + ">" + "<p>long</p>" * 20_000),
    (7, "http://f.example", "<a href=\"http://[bad\">b</a><base href='http://g.example/d/'><a href=e>rel</a> 日本語 \U0001f600"),
    (8, "http://a.example", "<p>same</p>"), (8, "http://a.example", "<p>same</p>"), (9, "u", "<p title='unclosed>text</p>"),
]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1) for r in rows],
                                 "page_id long, url string, html string, record_id string, id string, block int")


class Shown(HTMLParser):
    """What a plain event parser shows, blanks squeezed."""

    def __init__(self):
        super().__init__()
        self.skip, self.out = 0, []

    def handle_starttag(self, tag, attrs):
        self.skip += tag in ("script", "style")
        self.out.append(" " if tag not in ("b", "a") else "")

    def handle_endtag(self, tag):
        self.skip -= tag in ("script", "style")
        self.out.append(" " if tag not in ("b", "a") else "")

    def handle_data(self, data):
        if not self.skip:
            self.out.append(data)


def sha(raw):
    return "sha1:" + base64.b32encode(hashlib.sha1(raw).digest()).decode()


def test_text_and_links():
    text, page = parse_page(PAGES[0][2], PAGES[0][1])
    assert text.split("\n") == ["A & B", "One 1", "Café au lait", "next", "caps", "1 < 2 & 3"]
    assert page["title"] == "A & B" and page["metas"] == [{"name": "k", "content": "v"}]
    assert page["links"] == [{"path": "A@/href", "url": "http://a.example/one", "text": "One 1"},
                             {"path": "IMG@/src", "url": "http://a.example/x/p.png", "text": "pic > x"}]
    assert parse_page(PAGES[7][2], PAGES[7][1])[1]["links"][1]["url"] == "http://g.example/d/e"
    assert len(parse_page(PAGES[6][2], None)[0].split("\n")) == 20_000


def test_text_of_the_given_pages(spark):
    for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect():
        p = Shown()
        p.feed(r.html)
        p.close()
        assert parse_page(r.html, r.url)[0].split() == "".join(p.out).split(), r.page_id


def test_records(spark):
    responses = responses_of_pages(frame(spark, PAGES))
    source = {r.record_id: r for r in responses.collect()}
    got = derivatives(responses).collect()
    assert len(got) == 2 * len(PAGES) and len(source) == len(PAGES) - 1
    by = {(r.warc_type, r.refers_to): r for r in got}
    for rid, s in source.items():
        meta, conv = by["metadata", rid], by["conversion", rid]
        assert meta.linked_record_id == conv.record_id and conv.linked_record_id == meta.record_id
        assert len({rid, meta.record_id, conv.record_id}) == 3
        for r in (meta, conv):
            raw = r.block.encode()
            assert (r.content_length, r.block_digest) == (len(raw), sha(raw))
            assert (r.target_uri, r.date, r.source_payload_digest) == (s.target_uri, s.date, s.payload_digest)
        payload = s.payload.encode()
        assert s.payload_digest == sha(payload)
        head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
        assert s.block_digest == sha(head + payload)
        env = json.loads(meta.block)["Envelope"]
        assert env["WARC-Header-Metadata"]["WARC-Record-ID"] == rid and env["Conversion-Record-ID"] == conv.record_id
        http = env["Payload-Metadata"]["HTTP-Response-Metadata"]
        assert http["Entity-Length"] == len(payload) and http["Headers"][0] == ["Content-Type", "text/html; charset=utf-8"]
        assert conv.block == parse_page(s.payload, s.target_uri)[0]
    assert derivatives(responses_of_pages(frame(spark, []))).count() == 0


def test_files_round_trip(spark, tmpdir_path):
    import glob

    records = derivatives(responses_of_pages(frame(spark, PAGES)))
    write_warc(records, f"{tmpdir_path}/warc")
    back = read_warc(spark, f"{tmpdir_path}/warc/*.txt").collect()
    key = lambda r: (r.record_id, r.warc_type, r.refers_to, r.block_digest, r.content_type, r.block)
    assert sorted(map(key, back)) == sorted(map(key, records.collect()))
    raw = b"".join(open(f, "rb").read() for f in sorted(glob.glob(f"{tmpdir_path}/warc/*.txt")))
    for r in parse_warc(raw):
        assert r["version"] == "WARC/1.0" and r["warc-block-digest"] == sha(r["block"])
        assert "\r" not in r.get("warc-target-uri", "")


def test_response_files_to_derivatives(spark, tmpdir_path):
    from wayfarer.llm.warc import response_records, responses_of_warc

    # line ends in a URI are encoded in a file, so that page stays out of the comparison
    responses = responses_of_pages(frame(spark, [p for p in PAGES if p[0] != 4]))
    want = derivatives(responses).drop("id").collect()
    for compression, ending in ((None, "txt"), ("gzip", "txt.gz")):
        write_warc(response_records(responses), f"{tmpdir_path}/r{ending}", compression)
        read = responses_of_warc(spark, f"{tmpdir_path}/r{ending}/*.{ending}")
        same = ["record_id", "target_uri", "date", "status", "headers", "payload", "payload_digest", "block_digest"]
        rows = lambda df: sorted(map(repr, df.select(same).collect()))
        assert rows(read) == rows(responses)
        assert sorted(map(repr, derivatives(read).drop("id").collect())) == sorted(map(repr, want))


def test_foreign_and_malformed_files(spark, tmpdir_path):
    import gzip
    import os
    import zlib

    from wayfarer.llm.warc import digest, responses_of_warc

    def record(block, kind=b"response", length=None, extra=b""):
        size = str(len(block) if length is None else length).encode()
        return (b"WARC/1.0\r\nWARC-Type: " + kind + b"\r\nWARC-Date: 2020-01-02T03:04:05Z\r\n" + extra + b"Content-Length: " + size
                + b"\r\n\r\n" + block + b"\r\n\r\n")

    latin = b"HTTP/1.1 404 Not Found\r\nContent-Type: text/html; charset=iso-8859-1\r\nX-A: one\r\n  two\r\n\r\n<p>caf\xe9</p>"
    chunked = b"HTTP/1.0 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n3\r\n<p>\r\n4;x=y\r\nabcd\r\n0\r\n\r\n"
    packed = b"HTTP/1.1 200 OK\r\nContent-Encoding: gzip\r\n\r\n" + gzip.compress("<p>日本</p>".encode())
    bare = b"HTTP/1.1 200 OK\r\nContent-Encoding: deflate\r\n\r\n" + zlib.compress(b"<p>z</p>")[2:-4]
    parts = [record(b"info", b"warcinfo"), record(latin), record(chunked, length=5), record(chunked, extra=b"WARC-Payload-Digest: sha1:X\r\n"),
             b"WARC/1.0\r\nWARC-Type: response\r\n\r\nno length\r\n\r\n", record(packed), record(bare), record(b"\xff\xfe", b"resource")]
    os.makedirs(f"{tmpdir_path}/in")
    names = {"plain.warc": b"".join(parts), "members.warc.gz": b"".join(map(gzip.compress, parts)),
             "cut.warc.gz": b"".join(map(gzip.compress, parts))[:-9], "empty.warc": b""}
    for name, raw in names.items():
        open(f"{tmpdir_path}/in/{name}", "wb").write(raw)
    for name, bad in (("plain.warc", 2), ("members.warc.gz", 2), ("cut.warc.gz", 3), ("empty.warc", 0)):
        rows = read_warc(spark, f"{tmpdir_path}/in/{name}").collect()
        good = [r for r in rows if not r.malformed]
        assert len(rows) - len(good) >= bad and (bad == 3 or len(rows) - len(good) == bad)
        responses = responses_of_warc(spark, f"{tmpdir_path}/in/{name}").collect()
        if name == "empty.warc":
            assert not rows and not responses
            continue
        assert [r.warc_type for r in good][:5] == ["warcinfo", "response", "response", "response", "response"]
        assert [(r.status, r.payload) for r in responses] == [
            ("404 Not Found", "<p>café</p>"), ("200 OK", "<p>abcd"), ("200 OK", "<p>日本</p>"), ("200 OK", "<p>z</p>")]
        assert responses[0].headers[1]["value"] == "one two" and responses[0].block_digest == digest(latin)
        assert responses[1].payload_digest == "sha1:X" and responses[0].payload_digest == digest(b"<p>caf\xe9</p>")
        assert all(r.date == "2020-01-02T03:04:05Z" for r in responses) and len({r.record_id for r in responses}) == 4
        text = [r.block for r in derivatives(responses_of_warc(spark, f"{tmpdir_path}/in/{name}")).where("warc_type = 'conversion'").collect()]
        assert text == ["café", "abcd", "日本", "z"]
