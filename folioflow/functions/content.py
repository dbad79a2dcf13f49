"""Column expressions over document bytes, MIME types, names and hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# File extension by MIME type.
LANDING_EXTENSIONS = {
    "application/pdf": ".pdf",
    "application/msword": ".doc",
    "application/vnd.openxmlformats-officedocument.wordprocessingml.document": ".docx",
    "text/html": ".html",
    "text/plain": ".txt",
}
PROCESSED_EXTENSIONS = {**LANDING_EXTENSIONS, "text/htm": ".html"}
# Extensions accepted from a URL.
URL_EXTENSIONS = [".pdf", ".doc", ".docx", ".html", ".htm", ".txt"]
# MIME types by treatment.
HTML_TYPES = ["text/html", "text/htm"]
DOCUMENT_TYPES = [
    "application/pdf",
    "application/msword",
    "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
]
DEFAULT_MIME = "application/octet-stream"
SNIFF_BYTES = 1024

# Everything Python's str.strip() removes.
_SPACE = r"[\s\x1c-\x1f\x85\p{Z}]+"


def strip(text: Column) -> Column:
    """Trim all Unicode white space on both ends."""
    return F.regexp_replace(text, f"^{_SPACE}|{_SPACE}$", "")


def _lookup(table: dict[str, str], key: Column, default: str) -> Column:
    pairs = [F.lit(part) for item in table.items() for part in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.lit(default))


def content_hash(content: Column) -> Column:
    """SHA-256 of the bytes as 64 hex digits."""
    return F.sha2(content, 256)


def _base_type(mime: Column) -> Column:
    return F.when(mime.contains(";"), strip(F.substring_index(mime, ";", 1))).otherwise(mime)


def mime_ingest(header: Column) -> Column:
    """Content-Type header without parameters, case kept; a missing header is octet-stream."""
    return _base_type(F.coalesce(header, F.lit(DEFAULT_MIME)))


def mime_transform(mime: Column) -> Column:
    """MIME type without parameters in lower case."""
    return F.lower(_base_type(mime))


def ext_landing(url: Column, mime: Column) -> Column:
    """Extension of the URL path if it is a known one, else by (case-sensitive) MIME type."""
    path = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    path = F.regexp_replace(path, r";[^/]*$", "")
    # Leading dots of the file name do not start an extension.
    ext = F.lower(F.regexp_extract(path, r"(?:^|/)\.*[^./][^/]*?(\.[^./]*)$", 1))
    return F.when(ext.isin(URL_EXTENSIONS), ext).otherwise(
        _lookup(LANDING_EXTENSIONS, mime, ".bin")
    )


def ext_processed(mime: Column) -> Column:
    """Extension by MIME type alone."""
    return _lookup(PROCESSED_EXTENSIONS, mime_transform(mime), ".bin")


def object_path(zone: Column | str, object_name: Column) -> Column:
    """``zone/object``."""
    zone = F.lit(zone) if isinstance(zone, str) else zone
    return F.concat(zone, F.lit("/"), object_name)


def object_name(path: Column) -> Column:
    """Part after the first slash; the whole path if there is none."""
    slash = F.instr(path, "/")
    return F.when(slash > 0, F.substring(path, slash + 1, F.length(path))).otherwise(path)


def decode_ignore(content: Column) -> Column:
    """UTF-8 text of the bytes with undecodable bytes left out."""
    text = content.cast("string")
    bad = F.lit("\ufffd")
    # Genuine replacement characters in a damaged text are set aside first.
    repaired = F.replace(
        F.replace(F.make_valid_utf8(F.replace(text, bad, F.lit("\x00kept\x00"))), bad, F.lit("")),
        F.lit("\x00kept\x00"),
        bad,
    )
    return F.when(F.is_valid_utf8(text), text).otherwise(repaired)


def html_sniff(mime: Column, content: Column) -> Column:
    """Is it HTML, by MIME type or by the first bytes?"""
    head = F.lower(decode_ignore(F.substring(content, 1, SNIFF_BYTES)))
    return F.coalesce(
        mime.startswith("text/html") | head.contains("<!doctype html") | head.contains("<html"),
        F.lit(False),
    )


def doc_route(mime: Column) -> Column:
    """``html``, ``document`` or ``unknown`` (handled like a document)."""
    base = mime_transform(mime)
    return (
        F.when(base.isin(HTML_TYPES), "html")
        .when(base.isin(DOCUMENT_TYPES), "document")
        .otherwise("unknown")
    )


def size_reduction(original: Column, cleaned: Column) -> Column:
    """Percentage of characters removed; NULL for an empty original."""
    n = F.length(original)
    return F.when(n > 0, (n - F.length(cleaned)) / n * 100)
