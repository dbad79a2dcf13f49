"""Column expressions against plain Python."""

import hashlib
import os.path
from datetime import datetime
from urllib.parse import urlencode, urljoin, urlparse

import pytest
from pyspark.sql import functions as F

from folioflow.functions import content as fc
from folioflow.functions.links import abs_link, form_encode, search_url
from folioflow.functions.times import iso_time


def evaluate(spark, values, schema, expression):
    rows = [(i, *v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, {schema}").select("i", expression.alias("v"))
    return [r.v for r in df.orderBy("i").collect()]


BYTES = [b"", b"abc", "é�".encode(), b"A\xffB", b"\xe2\x82A", "x�y".encode() + b"\xff", b"\xed\xa0\x80z", b"\xf0\x9f\x98"]


def test_decode_ignore(spark):
    got = evaluate(spark, [(b,) for b in BYTES], "b binary", fc.decode_ignore(F.col("b")))
    assert got == [b.decode("utf-8", errors="ignore") for b in BYTES]


def test_content_hash(spark):
    got = evaluate(spark, [(b,) for b in BYTES], "b binary", fc.content_hash(F.col("b")))
    assert got == [hashlib.sha256(b).hexdigest() for b in BYTES]


HEADERS = ["text/html", "Text/HTML; charset=x", " a/b ;c", " a/b ", "", ";x", "\ta/b\x0b;", None]


def base_type(header):
    return header.split(";")[0].strip() if ";" in header else header


def test_mime(spark):
    rows = [(h,) for h in HEADERS]
    got = evaluate(spark, rows, "m string", fc.mime_ingest(F.col("m")))
    assert got == [base_type(h) if h is not None else "application/octet-stream" for h in HEADERS]
    got = evaluate(spark, rows, "m string", fc.mime_transform(F.col("m")))
    assert got == [base_type(h).lower() if h is not None else None for h in HEADERS]


URLS = [
    "https://x.test/a/b.pdf", "https://x.test/a.PDF?q=1.doc", "https://x.test/a.b/c", "https://x.test/.pdf",
    "https://x.test/..txt", "https://x.test/a..html", "https://x.test", "https://x.pdf", "https://x.test/a.htm#f",
    "https://x.test/a.docx;v=1", "/rel/file.txt", "file.doc", "//h.test/x.html", "https://x.test/a.csv",
    "https://x.test/dir.pdf/", "https://x.test/a;b/c.txt", "mailto:a.pdf", "",
]
KNOWN = {".pdf", ".doc", ".docx", ".html", ".htm", ".txt"}


def test_ext_landing_by_url(spark):
    def expected(url):
        ext = os.path.splitext(urlparse(url).path)[1].lower()
        return ext if ext in KNOWN else ".bin"

    got = evaluate(spark, [(u, "x/y") for u in URLS], "u string, m string", fc.ext_landing(F.col("u"), F.col("m")))
    assert got == [expected(u) for u in URLS]


def test_extensions_by_type(spark):
    types = ["application/pdf", "application/msword", "text/html", "text/htm", "text/plain", "TEXT/HTML", "x/y",
             "application/vnd.openxmlformats-officedocument.wordprocessingml.document", "text/html; charset=utf-8"]
    rows = [("http://x.test/doc", t) for t in types]
    got = evaluate(spark, rows, "u string, m string", fc.ext_landing(F.col("u"), F.col("m")))
    assert got == [".pdf", ".doc", ".html", ".bin", ".txt", ".bin", ".bin", ".docx", ".bin"]
    got = evaluate(spark, rows, "u string, m string", fc.ext_processed(F.col("m")))
    assert got == [".pdf", ".doc", ".html", ".html", ".txt", ".html", ".bin", ".docx", ".html"]


def test_object_paths(spark):
    paths = ["landing-zone/a.pdf", "a.pdf", "z/b/c.html", "/x", ""]
    got = evaluate(spark, [(p,) for p in paths], "p string", fc.object_name(F.col("p")))
    assert got == [p.split("/", 1)[1] if "/" in p else p for p in paths]
    got = evaluate(spark, [("a.pdf",)], "p string", fc.object_path("processed", F.col("p")))
    assert got == ["processed/a.pdf"]


def test_html_sniff(spark):
    cases = [
        ("text/html", b"x"), ("text/html5", b"x"), ("TEXT/HTML", b"x"), ("a/b", b"  <!DOCTYPE HTML>"),
        ("a/b", b"x" * 1019 + b"<html"), ("a/b", b"x" * 1020 + b"<html"), ("a/b", b"\xff<HTML lang"),
        ("a/b", "é".encode() * 510 + b"<html"), ("a/b", b"<ht"), (None, None),
    ]

    def expected(mime, data):
        if mime is None:
            return False
        head = data[:1024].decode("utf-8", errors="ignore").lower()
        return mime.startswith("text/html") or "<!doctype html" in head or "<html" in head

    got = evaluate(spark, cases, "m string, c binary", fc.html_sniff(F.col("m"), F.col("c")))
    assert got == [expected(*c) for c in cases]


def test_doc_route(spark):
    types = ["text/html", "TEXT/HTM; x", "application/pdf", "application/msword", "text/plain", ""]
    got = evaluate(spark, [(t,) for t in types], "m string", fc.doc_route(F.col("m")))
    assert got == ["html", "html", "document", "document", "unknown", "unknown"]


def test_size_reduction(spark):
    got = evaluate(spark, [("abcd", "a"), ("é", "é"), ("", "")], "a string, b string",
                   fc.size_reduction(F.col("a"), F.col("b")))
    assert got == [75.0, 0.0, None]


PAGES = ["https://h.test/en/list?p=1#top", "https://h.test", "http://h.test/a/b/c.html", "https://h.test/a/?x=/y/z"]
HREFS = [
    "https://o.test/x", "//cdn.test/y", "/root/x.pdf", "?p=2", "#frag", "x.html", "d/e?q=1#f", "../up.html", "./same",
    "/a/../b", "../../..", "..", "mailto:a@b.test", "/x?u=a/../b", "g/./h/../i",
]


@pytest.mark.parametrize("page", PAGES)
def test_abs_link(spark, page):
    got = evaluate(spark, [(h, page) for h in HREFS], "h string, p string", abs_link(F.col("h"), F.col("p")))
    assert got == [urljoin(page, h) for h in HREFS]


def test_abs_link_fallback(spark):
    got = evaluate(spark, [("", PAGES[0]), (None, PAGES[0])], "h string, p string", abs_link(F.col("h"), F.col("p")))
    assert got == [PAGES[0], PAGES[0]]


def test_form_encoding(spark):
    texts = ["a b", "~*-._", "é/ü", "x&y=z+1%", "WRC"]
    got = evaluate(spark, [(t,) for t in texts], "t string", form_encode(F.col("t")))
    assert got == [urlencode({"k": t})[2:] for t in texts]


def test_search_url(spark):
    got = evaluate(spark, [("15376", "2024-01-01", "2024-01-31")], "b string, s string, e string",
                   search_url(F.col("b"), F.col("s").cast("date"), F.col("e").cast("date")))
    query = urlencode({"decisions": "1", "body": "15376", "from": "01/01/2024", "to": "31/01/2024"})
    assert got == [f"https://www.workplacerelations.ie/en/search/?{query}"]


def test_iso_time(spark):
    times = [datetime(2024, 1, 15, 10, 30), datetime(2024, 1, 15, 10, 30, 5, 7), datetime(1999, 12, 31, 23, 59, 59, 500000)]
    got = evaluate(spark, [(t,) for t in times], "t timestamp_ntz", iso_time(F.col("t")))
    assert got == [t.isoformat() for t in times]
