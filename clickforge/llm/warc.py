"""WARC derivatives: metadata and plain-text conversion records for response records, as columns and as bytes.

A response is (record_id, uri, date, status, headers, payload). Each gives two records that refer to it: ``metadata`` with its
links and headers as JSON, and ``conversion`` with its plain text. Both keep the response's identifier in WARC-Refers-To, its
URI and date, and have digests of their own blocks. Identifiers are derived from the response's, so a rerun makes the same records;
responses with different payloads have different identifiers, and rows equal in page_id, url and html are one response.
"""

from __future__ import annotations

from collections.abc import Callable
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CRLF = "\r\n"
REFERENCE = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"
#: The target of a link: ``href`` of an ``a`` in any case, quoted either way or not at all.
LINK = r"""(?i)<a(?:[ \t\r\n\f][^>]*?)?[ \t\r\n\f]href[ \t\r\n\f]*=[ \t\r\n\f]*("[^"]*"|'[^']*'|[^ \t\r\n\f"'>]+)"""
#: Character of each named reference of HTML 4, and the apostrophe's; no-break spaces become plain ones.
NAMED = {**{name: chr(code) for name, code in sorted(name2codepoint.items())}, "apos": "'", "nbsp": " "}


def _uuid(seed: Column) -> Column:
    """An identifier from a text: its md5 in the form of a UUID."""
    h = F.md5(seed)
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def responses(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Response records of ``pages`` (page_id, url, html): identifier, URI, date, HTTP headers, payload and its digest. Null is empty."""
    page = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    uri, body = F.coalesce(F.col("url").cast("string"), F.lit("")), F.coalesce(F.col("html").cast("string"), F.lit(""))
    size = F.octet_length(body)
    return pages.select(
        F.col("page_id").cast("long"), _uuid(F.concat_ws(" ", page, uri, F.sha1(body))).alias("record_id"),
        uri.alias("uri"), F.lit(date).alias("date"), F.lit(200).alias("status"),
        F.map_from_arrays(F.array(F.lit("Content-Type"), F.lit("Content-Length")), F.array(F.lit("text/html; charset=utf-8"), size.cast("string"))).alias("headers"),
        body.alias("payload"), F.concat(F.lit("sha1:"), F.sha1(body)).alias("payload_digest"))


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once; behind a generator nothing else shares what stands in a row's expressions twice."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _character(reference: Column) -> Column:
    """The character of one reference; unknown names stay as they are, numbers of no character give U+FFFD."""
    body = F.substring(reference, 2, 40)  # without the ampersand; a reference is shorter than this
    return _let(F.left(body, F.char_length(body) - 1), lambda b: _of_body(b, reference))


def _of_body(body: Column, reference: Column) -> Column:
    hexed = F.lower(F.substring(body, 2, 1)) == "x"
    number = F.when(hexed, F.conv(F.substring(body, 3, 6), 16, 10)).otherwise(F.substring(body, 2, 7)).cast("int")
    real = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
    coded = F.decode(F.unhex(F.lpad(F.hex(number.cast("long")), 8, "0")), "UTF-32")
    space = F.when(number == 160, " ").otherwise(coded)
    table = F.create_map(*[F.lit(x) for pair in NAMED.items() for x in pair])
    return F.when(F.startswith(body, F.lit("#")), F.when(real, space).otherwise("\ufffd")).otherwise(
        F.coalesce(F.try_element_at(table, body), reference))


def decoded(text: Column) -> Column:
    """``text`` with its character references replaced, once: what a reference gives is not read again."""
    return _let(text, lambda t: F.when(F.contains(t, F.lit("&")), _replaced(t)).otherwise(t))


def _replaced(text: Column) -> Column:
    found = F.transform(F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(0)), _character)
    parts = F.zip_with(F.split(text, REFERENCE, -1), found, lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    return F.array_join(parts, "")


def plain_text(html: Column) -> Column:
    """The text of a page: scripts, styles and comments out, tags to line feeds at blocks and else to nothing, references decoded, blanks folded."""
    for pattern, to in (
        (r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " "), (r"(?s)<!--.*?-->", " "), (r"(?i)<(/?(p|div|li|ul|ol|h[1-6]|article|nav|footer|header|title|tr|table)|br)[^>]*>", "\n"),
        (r"<[^>]*>", ""),
    ):
        html = F.regexp_replace(html, pattern, to)
    return F.btrim(F.regexp_replace(F.regexp_replace(decoded(html), r"[ \t\r\f]+", " "), r" ?\n[ \n]*", "\n"), F.lit(" \n"))


def derivatives(records: DataFrame) -> DataFrame:
    """Two rows for each row of ``records`` (as ``responses`` gives them): the metadata and the conversion record.

    Returns page_id, type, record_id, refers_to, uri, date, block, block_digest, headers (the record's header lines) and record (its
    bytes as text, ready to be compressed and put end to end). Empty payloads give an empty conversion block. Links are as they stand
    in the page, without their quotes; a ``>`` inside an attribute ends its tag.
    """
    bare = lambda x: F.when(x.rlike("^[\"']"), F.substr(x, F.lit(2), F.char_length(x) - 2)).otherwise(x)
    links = F.transform(F.regexp_extract_all("payload", F.lit(LINK), F.lit(1)), bare)
    title = F.btrim(F.regexp_extract("payload", r"(?is)<title[^>]*>(.*?)</title>", 1))
    meta = F.to_json(F.struct(
        F.col("status").alias("http_status"), F.col("headers").alias("http_headers"), F.col("payload_digest"), title.alias("title"), links.alias("links")))
    made = records.select("*", F.explode(F.array(
        F.struct(F.lit("metadata").alias("type"), F.lit("application/json").alias("mime"), meta.alias("block")),
        F.struct(F.lit("conversion").alias("type"), F.lit("text/plain").alias("mime"), plain_text(F.col("payload")).alias("block")))).alias("d"))
    block = F.col("d.block")
    head = made.select(
        "page_id", F.col("d.type").alias("type"), _uuid(F.concat("d.type", F.lit(" "), "record_id")).alias("record_id"),
        F.col("record_id").alias("refers_to"), "uri", "date", "payload_digest", F.col("d.mime").alias("mime"), block.alias("block"),
        F.concat(F.lit("sha1:"), F.sha1(block)).alias("block_digest"), F.octet_length(block).alias("size"))
    lines = F.concat_ws(
        CRLF, F.lit("WARC/1.0"), *[F.concat(F.lit(f"{name}: "), F.col(c).cast("string")) for name, c in (
            ("WARC-Type", "type"), ("WARC-Target-URI", "uri"), ("WARC-Date", "date"), ("WARC-Record-ID", "record_id"), ("WARC-Refers-To", "refers_to"),
            ("WARC-Block-Digest", "block_digest"), ("WARC-Source-Payload-Digest", "payload_digest"), ("Content-Type", "mime"), ("Content-Length", "size"))])
    return head.select(
        "page_id", "type", "record_id", "refers_to", "uri", "date", "payload_digest", "block", "block_digest", lines.alias("headers"),
        F.concat(lines, F.lit(CRLF * 2), F.col("block"), F.lit(CRLF * 2)).alias("record"))


def write_warc(made: DataFrame, path: str) -> None:
    """The records as gzip text files below ``path``, one for each partition. Each ends with two empty lines, as records must."""
    made.select(F.regexp_replace("record", r"\r\n\z", "").alias("value")).write.option("lineSep", CRLF).option("compression", "gzip").text(path)
