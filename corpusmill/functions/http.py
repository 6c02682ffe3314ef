"""HTTP responses in WARC records: predicates and header fields, Column -> Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The one WARC content type of responses, the kinds of pages, and the size from which records are left out.
RESPONSE = "application/http; msgtype=response"
PAGES = ["text/html", "application/xhtml+xml"]
TOO_LONG = 10_000_000


def is_response(content_type: Column) -> Column:
    return content_type == RESPONSE


def _latin(content: Column) -> Column:
    # header fields stand at the start; a byte is a character, so no byte is lost
    return F.decode(content, "ISO-8859-1")


def header(content: Column) -> Column:
    """The HTTP header: what stands before the first empty line of a content that starts with HTTP, else null."""
    text = _latin(content)
    at = F.instr(text, "\r\n\r\n")
    return F.when(F.startswith(text, F.lit("HTTP")) & (at > 1), F.substr(text, F.lit(1), at - 1))


def _nullif_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def page_type(http_header: Column) -> Column:
    """The first Content-Type of a header, lower case, without parameters; null without one."""
    return _nullif_empty(F.lower(F.regexp_extract(http_header, r"Content-Type:\s*([^\s;]+)", 1)))


def page_charset(http_header: Column) -> Column:
    """The last charset on the first Content-Type line that has one, lower case; null without one."""
    return _nullif_empty(F.lower(F.regexp_extract(http_header, r"Content-Type:.*charset=\s*([^\s;]+)", 1)))


def is_page(content_type: Column, content_length: Column, content: Column) -> Column:
    """Whether a record is a response with an HTML page of less than ten million bytes. Null counts as no.

    The cheap tests come first, so the content of other records is not decoded.
    """
    return F.coalesce(is_response(content_type) & (content_length < TOO_LONG) & page_type(header(content)).isin(*PAGES), F.lit(False))


def body(content: Column) -> Column:
    """The bytes after the HTTP header; all of them where the header has no end."""
    at = F.instr(_latin(content), "\r\n\r\n")
    return F.when(at > 0, F.substr(content, at + 4)).otherwise(content)
