import gzip
import hashlib
from pathlib import Path

from bundleflow.llm import warc

PAGE = """<!DOCTYPE html><html lang="fr"><head><title>A &amp; B</title><style>p{}</style><script>var t="</p>";</script></head>
<body><nav><a href="/x">one</a> <a href='y?a=1&amp;b=2'>two</a></nav><!-- <p>no</p> --><p>Caf&eacute;   au<br>lait</p><p>&lt;b&gt;
 end <img src=pic.png></body></html>"""


def test_page_text():
    text, title, lang, links = warc.page_text(PAGE)
    assert text == "one two\nCafé au\nlait\n<b>\nend" and title == "A & B" and lang == "fr"
    assert links == [("/x", "a", "href"), ("y?a=1&b=2", "a", "href"), ("pic.png", "img", "src")]


def test_broken_pages_end():
    for text in ("", "<", "<a", "<script>" * 2000, "<!--" * 2000, "<a href=\"" * 5000, "a<b>c</", "<p" + " x" * 50000):
        warc.page_text(text)
    assert warc.page_text("1 < 2 and 3 > 2")[0] == "1 < 2 and 3 > 2"


def sha(data):
    return "sha256:" + hashlib.sha256(data).hexdigest()


def parse(data):
    """Records of a WARC file: (headers, block)."""
    out = []
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        assert lines[0] == "WARC/1.1"
        headers = dict(line.split(": ", 1) for line in lines[1:])
        n = int(headers["Content-Length"])
        assert rest[n:n + 4] == b"\r\n\r\n"
        out.append((headers, rest[:n]))
        data = rest[n + 4:]
    return out


def test_records_and_files(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://x.org/a/", PAGE, "extra"), (2, None, None, "extra"), (3, "http://y.org", "", "extra"),
                                   (None, "http://z.org", "é" * 50_000, "extra"), (1, "http://x.org/a/", PAGE, "again")],
                                  "page_id long, url string, html string, block string").select("page_id", "url", "html", "block")
    responses = warc.responses(pages)
    source = {r.record_id: r for r in responses.collect()}
    rows = warc.derive(responses).collect()
    assert len(rows) == 10 and len({r.record_id for r in rows}) == 8  # a page stands there twice
    for r in rows:
        s = source[r.refers_to]
        head, body = s.block.split("\r\n\r\n", 1)
        assert r.payload_digest == sha(body.encode()) and r.block_digest == sha(r.block.encode())
        if r.record_type == "conversion":
            assert r.block == warc.page_text(body)[0] and r.content_type.startswith("text/plain")
        else:
            assert f"source-block-digest: {sha(s.block.encode())}\r\n" in r.block
            assert all(f"http-header: {line}\r\n" in r.block for line in head.split("\r\n"))
    meta = next(r for r in rows if r.source_id == 1 and r.record_type == "metadata")
    assert "outlink: http://x.org/a/y?a=1&b=2 a/@href\r\n" in meta.block and "title: A & B\r\n" in meta.block
    out = str(tmp_path / "warc")
    warc.write_warc(warc.derive(responses), out)
    files = list(Path(out).glob("part-*.gz"))
    parsed = [x for f in files for x in parse(gzip.decompress(f.read_bytes()))]
    assert len(parsed) == 10
    for headers, block in parsed:
        assert headers["WARC-Block-Digest"] == sha(block) and headers["WARC-Refers-To"] in source
        assert ("WARC-Target-URI" in headers) == (source[headers["WARC-Refers-To"]].target_uri is not None)


def test_pages_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    html = {r.page_id: r.html for r in pages.collect()}
    rows = warc.derive(warc.responses(pages)).collect()
    assert len(rows) == 2 * len(html)
    for r in rows:
        if r.record_type == "conversion":
            assert r.block == warc.page_text(html[r.source_id])[0] and "<p>" not in r.block
    assert warc.derive(warc.responses(pages.filter("false"))).count() == 0


def test_head_without_an_end():
    assert warc.page_text("<head><title>T</title><p>all text")[:2] == ("all text", "T")
    assert warc.page_text("<html><head><title>T</title>all <b>text</b></html>")[:2] == ("all text", "T")
    assert warc.page_text("<head><meta charset=x><title>T <b>x</b></title><link href=y>all text")[0] == "all text"
    assert warc.page_text("<head><title>T</title>\n<div>one</div>two")[0] == "one\ntwo"
    assert warc.page_text("<head><title>T<p>all text")[0].endswith("all text")


def test_stray_quotes_in_tags():
    page = '<a href="x"">link text</a> more text <b class="y">bold</b> <a title=\'a>b\' href = "z>">end</a> <p id="open>last</p>'
    text, _, _, links = warc.page_text(page)
    assert text == "link text more text bold end\nlast" and links == [("x", "a", "href"), ("z>", "a", "href")]
