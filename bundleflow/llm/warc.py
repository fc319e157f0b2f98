"""Derived WARC records: from each response a metadata record and a plain-text
conversion record, both linked to it."""

from __future__ import annotations

import html
import re
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bundleflow.llm.common import fresh, small_batches

CRLF = "\r\n"
#: The date of responses that have none.
NO_DATE = "1970-01-01T00:00:00Z"

# Fixed values of HTML: elements without text of their own, and those that break a line.
SILENT = "script style template noscript head"
BREAKING = set(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table "
    "tbody td tfoot th thead title tr ul".split())
LINK_ATTRIBUTES = {"a": "href", "area": "href", "link": "href", "img": "src", "script": "src", "iframe": "src",
                   "frame": "src", "source": "src", "video": "src", "audio": "src", "embed": "src", "form": "action"}

#: Elements that may stand in a head; any other one ends it, as text does.
IN_HEAD = set("html head base basefont bgsound link meta title script style template noscript noframes".split())

# Possessive parts: an unclosed tag, quote or comment costs one look at the
# text. A quote opens a value only behind an equals sign.
_MARKUP = re.compile(
    r"<!--(?:.*?-->|.*)|<(script|style|template|noscript)\b([^>]*+)>(?:.*?</\1\s*+>|.*)"
    r"|<[!?][^>]*+>?|<(/?)([a-z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]++)?+)*+)>", re.S | re.I)
_ATTRIBUTE = re.compile(r"([^\s=\"'<>/]++)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++))")
_TITLE = re.compile(r"<title\b[^>]*+>(.*?)</title\s*+>", re.S | re.I)
_TITLE_END = re.compile(r"</title\s*+>", re.I)
_SPACES = re.compile(r"[^\S\n]+")
_LINES = re.compile(r" *\n\s*")


def _attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(text):
        out.setdefault(name.lower(), html.unescape("".join(values)).strip())
    return out


def page_text(source: str) -> tuple[str, str, str, list[tuple[str, str, str]]]:
    """Text, title, language and links (url, element, attribute) of a page.
    Text is what stands between tags, without silent elements and comments;
    elements that break lines end one, spaces are single, lines not empty. A
    head without an end tag ends where text or another element begins."""
    parts: list[str] = []
    links: list[tuple[str, str, str]] = []
    language, at, head, title_end = "", 0, False, 0
    for m in _MARKUP.finditer(source):
        if head and m.start() < title_end:
            continue  # what looks like a tag in a title is its text
        at = max(at, title_end)
        if head and source[at:m.start()].strip():
            head = False
        if not head:
            parts.append(source[at:m.start()])
        at = m.end()
        silent, own, closing, name, rest = m.groups()
        name = (silent or name or "").lower()
        if not name:
            continue
        if name == "head":
            head = not closing
        elif name not in IN_HEAD or closing and name == "html":
            head = False
        elif head and name == "title" and not closing and title_end >= 0:
            end = _TITLE_END.search(source, at)
            title_end = end.end() if end else -1
        if name in BREAKING:
            parts.append("\n")
        if closing:
            continue
        if name == "html":
            language = _attributes(rest).get("lang", "")
        wanted = LINK_ATTRIBUTES.get(name)
        if wanted and (url := _attributes(own or rest or "").get(wanted)):
            links.append((url, name, wanted))
    # text behind the last tag is no part of a head
    parts.append(source[max(at, title_end):])
    text = html.unescape("".join(parts))
    text = _LINES.sub("\n", _SPACES.sub(" ", text)).strip()
    found = _TITLE.search(source)
    title = " ".join(html.unescape(found[1]).split()) if found else ""
    return text, title, language, links


def _resolved(base: str, url: str) -> str:
    try:
        return urljoin(base, url)
    except ValueError:
        return url


PAGE = T.StructType([T.StructField(n, T.StringType()) for n in ("text", "title", "lang")] + [
    T.StructField("links", T.ArrayType(T.StringType()))])


def page_column(target: Column, body: Column) -> Column:
    """struct(text, title, lang, links) of a page's source; links are
    ``url element/@attribute``, resolved against the target."""
    def run(targets: pa.Array, bodies: pa.Array) -> pa.Array:
        rows = []
        for base, source in zip(targets.to_pylist(), bodies.to_pylist()):
            text, title, lang, links = page_text(source or "")
            rows.append({"text": text, "title": title, "lang": lang,
                         "links": [f"{_resolved(base or '', u)} {e}/@{a}" for u, e, a in links]})
        return pa.array(rows, pa.struct([("text", pa.string()), ("title", pa.string()), ("lang", pa.string()),
                                         ("links", pa.list_(pa.string()))]))

    return F.arrow_udf(run, PAGE)(target, body)


def sha256_digest(data: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(data.cast("binary"), 256))


def uuid_of(*parts: Column) -> Column:
    """A record id that depends on the parts alone, so a repeated task writes
    the same ids."""
    joined = F.concat_ws("\0", *(F.coalesce(p.cast("string"), F.lit("\1")) for p in parts))
    return F.regexp_replace(F.md5(joined.cast("binary")), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "<urn:uuid:$1-$2-$3-$4-$5>")


def responses(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              date: str = NO_DATE) -> DataFrame:
    """Pages as response records: source_id, record_id, target_uri, date,
    block (an HTTP message). A NULL page has an empty body."""
    body = F.coalesce(F.col(html_col), F.lit(""))
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.octet_length(body).cast("string"), F.lit(CRLF + CRLF))
    return pages.select(
        F.col(id_col).alias("source_id"), uuid_of(F.lit("response"), F.col(id_col), F.col(url_col), F.md5(body.cast("binary"))).alias("record_id"),
        F.col(url_col).alias("target_uri"), F.lit(date).alias("date"), F.concat(head, body).alias("block"))


def _header(name: str, value: Column) -> Column:
    """One header line; none for a NULL. Line breaks in values become spaces."""
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), F.regexp_replace(value, r"[\r\n]+", " "), F.lit(CRLF)))


def derive(records: DataFrame) -> DataFrame:
    """Response records (source_id, record_id, target_uri, date, block) to two
    rows each: source_id, record_type (conversion, metadata), record_id,
    refers_to, target_uri, date, content_type, block, block_digest,
    payload_digest (of the response's payload), record (the whole record
    without the empty lines that end it).

    The metadata record holds the response's digests, its HTTP status and
    headers, title, language and links. A block without an empty line is all
    headers; a NULL one is empty. Repeated responses give repeated records. No
    row is shuffled.
    """
    small_batches(records.sparkSession)
    block = F.coalesce(F.col("block"), F.lit(""))
    cut = F.locate(CRLF + CRLF, block)
    rows = records.select("source_id", "record_id", "target_uri", F.coalesce("date", F.lit(NO_DATE)).alias("date"),
                          sha256_digest(block).alias("source_digest"),
                          F.when(cut > 0, F.substring(block, F.lit(1), cut - 1)).otherwise(block).alias("head"),
                          F.when(cut > 0, F.substring(block, cut + 4, F.length(block))).otherwise(F.lit("")).alias("body"))
    rows = rows.withColumn("payload_digest", sha256_digest(F.col("body")))
    rows = rows.withColumn("page", page_column(F.col("target_uri"), F.col("body"))).drop("body")

    def lines(name: str, values: Column) -> Column:
        return F.array_join(F.transform(values, lambda v: F.concat(F.lit(f"{name}: "), F.regexp_replace(v, r"[\r\n]+", " "), F.lit(CRLF))), "")

    fields = F.concat(
        F.concat(F.lit("source-block-digest: "), F.col("source_digest"), F.lit(CRLF)),
        F.concat(F.lit("source-payload-digest: "), F.col("payload_digest"), F.lit(CRLF)),
        lines("http-header", F.filter(F.split("head", r"\r\n"), lambda x: x != "")),
        _header("title", F.col("page.title")), _header("language", F.col("page.lang")),
        lines("outlink", F.col("page.links")))
    kinds = F.array(
        F.struct(F.lit("conversion").alias("record_type"), F.lit("text/plain; charset=utf-8").alias("content_type"),
                 F.col("page.text").alias("block")),
        F.struct(F.lit("metadata").alias("record_type"), F.lit("application/warc-fields").alias("content_type"),
                 fields.alias("block")))
    rows = rows.select("source_id", F.col("record_id").alias("refers_to"), "target_uri", "date", "payload_digest",
                       "source_digest", F.inline(kinds))
    rows = rows.withColumn("record_id", uuid_of(F.col("record_type"), F.col("refers_to"), F.col("source_digest")))
    rows = rows.withColumn("block_digest", sha256_digest(F.col("block")))
    header = F.concat_ws(
        "", F.lit(f"WARC/1.1{CRLF}"), _header("WARC-Type", F.col("record_type")), _header("WARC-Record-ID", F.col("record_id")),
        _header("WARC-Date", F.col("date")), _header("WARC-Target-URI", F.col("target_uri")),
        _header("WARC-Refers-To", F.col("refers_to")), _header("WARC-Refers-To-Target-URI", F.col("target_uri")),
        _header("WARC-Refers-To-Date", F.col("date")), _header("WARC-Payload-Digest", F.when(F.col("record_type") == "conversion", F.col("block_digest"))),
        _header("WARC-Block-Digest", F.col("block_digest")), _header("Content-Type", F.col("content_type")),
        _header("Content-Length", F.octet_length("block").cast("string")), F.lit(CRLF))
    return rows.select("source_id", "record_type", "record_id", "refers_to", "target_uri", "date", "content_type",
                       "block", "block_digest", "payload_digest", F.concat(header, F.col("block")).alias("record"))


def write_warc(records: DataFrame, path: str) -> None:
    """The records as gzip WARC files, one per partition, in any file system
    that Spark writes: two line ends stand behind each record."""
    records.select("record").write.option("lineSep", CRLF + CRLF).option("compression", "gzip").text(path)
