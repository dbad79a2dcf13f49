"""Links against the standard library, and ties among items."""

from urllib.parse import urljoin

from pyspark.sql import functions as F

from folioflow.functions.links import abs_link
from folioflow.operators import records

BASE = "https://e.org/x/y/list.html?p=1"
HREFS = [
    " /doc/A.html", "\n?p=2", "a\tb\n.html", "x//y", "?", "?#top", "https://other.org/a?", "https://other.org/a?#", "http://other.org/a?",
    "//cdn.org/z?", "../up.html", "./same", "", "#frag", "/abs//keep", "x//", "a/../b?q=1#f",
]


def test_links_resolve_like_the_standard_library(spark):
    df = spark.createDataFrame([(i, h) for i, h in enumerate(HREFS)], "i int, h string")
    got = {r["i"]: r["l"] for r in df.select("i", abs_link(F.col("h"), F.lit(BASE)).alias("l")).collect()}
    assert {HREFS[i]: v for i, v in got.items()} == {h: urljoin(BASE, h) for h in HREFS}


def test_tied_items_are_new_or_duplicates(spark):
    rows = [("a", "2024-01-01", 1), ("a", "2024-01-01", 1), ("a", "2024-01-02", 1), ("b", "2024-01-01", 1)]
    items = spark.createDataFrame(rows, "identifier string, partition_date string, position int")
    store = spark.createDataFrame([("b", "ok")], "identifier string, status string")
    new, duplicates = records.new_records(items, store)
    assert [r["identifier"] for r in new.collect()] == ["a"]
    assert sorted(r["identifier"] for r in duplicates.collect()) == ["a", "a", "b"]


def test_one_response_per_url(spark):
    rows = [("u", b"x", "t"), ("u", b"x", "t"), ("u", None, "a"), ("u", b"y", "z"), ("v", None, None)]
    got = records.one_per_url(spark.createDataFrame(rows, "url string, content binary, content_type string")).collect()
    assert sorted((r["url"], r["content_type"] or "") for r in got) == [("u", "t"), ("v", "")]
