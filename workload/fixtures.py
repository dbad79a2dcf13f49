"""Tables of documents, records, items and families derived by Spark from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.functions.times import as_of_literal
from folioflow.operators.ranking import page_position
from folioflow.schema import LANDING_ZONE, METADATA, OBJECTS, RECORDS

AS_OF = "2024-07-01 12:00:00"
SITE = "https://example.org"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# -- landing zone, from `pages` ------------------------------------------------------


def _doc_id(page_id) -> F.Column:
    return F.concat(F.lit("DOC-"), F.lpad(page_id.cast("string"), 8, "0"))


def _nth(number, values: list) -> F.Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), number.cast("int") + 1)


def landing_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per page: mixed MIME types, some errors, some missing fields and objects."""
    p = table(spark, sf_dir, "pages")
    n = F.col("page_id")
    identifier = _doc_id(n)
    published = F.date_add(F.lit("2024-01-01").cast("date"), (n * 7 % 366).cast("int"))
    path = (
        F.when(n % 23 == 0, None)
        .when(n % 29 == 0, F.concat(F.lit(f"{LANDING_ZONE}/missing-"), identifier, F.lit(".html")))
        .otherwise(F.concat(F.lit(f"{LANDING_ZONE}/"), identifier, F.lit(".html")))
    )
    mime = (
        F.when(n % 10 <= 5, "text/html; charset=utf-8")
        .when(n % 10 == 6, "TEXT/HTML")
        .when(n % 10 == 7, "application/pdf")
        .when(n % 10 == 8, "application/octet-stream")
    )
    # Every eleventh record was written with a hash that does not match its document.
    file_hash = F.sha2(F.when(n % 11 == 0, F.col("url")).otherwise(F.col("html")), 256)
    columns = {
        "identifier": identifier,
        "published_date": F.date_format(published, "dd/MM/yyyy"),
        "body_type": _nth(n % 4, ["WRC", "LC", "EAT", "ET"]),
        "source_url": F.col("url"),
        "doc_link": F.col("url"),
        "partition_date": F.date_format(F.trunc(published, "MM"), "yyyy-MM-dd"),
        "file_path": path,
        "file_hash": file_hash,
        "mime_type": mime,
        "status": F.when(n % 17 == 0, "error").otherwise("extracted"),
        "created_at": as_of_literal("2024-06-30 08:00:00"),
        "updated_at": as_of_literal("2024-06-30 08:00:00"),
    }
    return p.select(
        *[
            columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in RECORDS.fields
        ]
    )


def landing_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document of every page."""
    p = table(spark, sf_dir, "pages")
    return p.select(
        F.lit(LANDING_ZONE).alias("zone"),
        F.concat(_doc_id(F.col("page_id")), F.lit(".html")).alias("object_name"),
        F.col("html").cast("binary").alias("content"),
        F.lit("text/html").alias("content_type"),
        F.octet_length("html").cast("long").alias("length"),
    ).select(*OBJECTS.fieldNames())


# Container that replaces <article>, by page_id % 5.
VARIANTS = [
    ("<article>", "</article>"),
    ("<main>", "</main>"),
    ('<div class="Content-Box">', "</div>"),
    ('<section class="content">', "</section>"),
    ('<div class="x">', "</div>"),
]


def variant_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose main content sits in different containers."""
    p = table(spark, sf_dir, "pages")
    which = F.col("page_id") % len(VARIANTS)
    opening = _nth(which, [v[0] for v in VARIANTS])
    closing = _nth(which, [v[1] for v in VARIANTS])
    html = F.replace(
        F.replace("html", F.lit("<article>"), opening), F.lit("</article>"), closing
    )
    return p.select("page_id", "url", html.alias("html"))


# -- result listings, from `documents` -----------------------------------------------

PAGE_SIZE = 10


def listing_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in its source's listing."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return page_position(d, "source", "doc_id", PAGE_SIZE)


def _list_url(page_no) -> F.Column:
    return F.concat(F.lit(f"{SITE}/list/"), F.col("source"), F.lit("?p="), page_no.cast("string"))


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result pages of ten documents each, linked by a next link."""
    items = listing_items(spark, sf_dir)
    doc = F.col("doc_id").cast("string")
    block = F.concat(
        F.lit('<div class="row"><h2 class="title"><a href="/doc/'), doc, F.lit('.html">'), doc,
        F.lit('</a></h2><span class="date">'), F.col("lang"), F.lit("</span></div>\n"),
        F.lit('<p class="description">'), F.col("n_chars").cast("string"),
        F.lit('</p><div class="bottom-ref"><span class="refNO">'), doc, F.lit("</span></div>\n"),
    )
    entry = F.struct("position", block.alias("block"))
    pages = items.groupBy("source", "page_no", "last_page").agg(
        F.array_sort(F.collect_list(entry)).alias("entries")  # ten at most
    )
    following = F.when(
        F.col("page_no") < F.col("last_page"),
        F.concat(F.lit('<a href="?p='), (F.col("page_no") + 1).cast("string"), F.lit('"> » </a>')),
    ).otherwise("")
    return pages.select(
        F.xxhash64("source", "page_no").alias("page_id"),
        _list_url(F.col("page_no")).alias("url"),
        F.concat(
            F.lit("<html><body>\n"),
            F.array_join(F.transform("entries", lambda e: e["block"]), ""),
            following,
            F.lit("</body></html>"),
        ).alias("html"),
    )


def search_pages(spark: SparkSession, sf_dir: str, seeds: DataFrame) -> DataFrame:
    """The result pages behind planned searches: ten documents each, by body and month of the document.

    ``seeds`` are (url, body, partition_date) of the searches; later pages have addresses of their own.
    """
    n = F.col("doc_id")
    month = F.concat(F.lit("2024-0"), (n % 6 + 1).cast("string"), F.lit("-01"))
    d = table(spark, sf_dir, "documents").select(
        "doc_id", _nth(n % 4, ["WRC", "LC", "EAT", "ET"]).alias("body"), month.alias("partition_date")
    )
    task = F.concat("body", F.lit("/"), "partition_date")
    items = page_position(d.withColumn("task", task), "task", "doc_id", PAGE_SIZE)
    doc = n.cast("string")
    block = F.concat(
        F.lit(f'<div class="row"><h2 class="title"><a href="{SITE}/doc/'), doc, F.lit('.html">'), doc,
        F.lit('</a></h2></div><div class="bottom-ref"><span class="refNO">'), doc, F.lit("</span></div>\n"),
    )
    pages = items.groupBy("body", "partition_date", "task", "page_no", "last_page").agg(
        F.array_sort(F.collect_list(F.struct("position", block.alias("block")))).alias("entries")  # ten at most
    )

    def address(page_no) -> F.Column:
        return F.concat(F.lit(f"{SITE}/results/"), "task", F.lit("?p="), page_no.cast("string"))

    following = F.concat(F.lit('<a href="'), address(F.col("page_no") + 1), F.lit('">»</a>'))
    first = seeds.select(F.col("url").alias("search"), "body", "partition_date")
    return pages.join(first, ["body", "partition_date"]).select(
        F.xxhash64("task", "page_no").alias("page_id"),
        F.when(F.col("page_no") == 1, F.col("search")).otherwise(address(F.col("page_no"))).alias("url"),
        F.concat(
            F.lit("<html><body>"),
            F.array_join(F.transform("entries", lambda e: e["block"]), ""),
            F.when(F.col("page_no") < F.col("last_page"), following).otherwise(""),
            F.lit("</body></html>"),
        ).alias("html"),
    )


def listing_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first page of every source's listing."""
    sources = table(spark, sf_dir, "documents").select("source").distinct()
    return sources.select(
        _list_url(F.lit(1)).alias("url"),
        F.col("source").alias("body"),
        F.lit("2024-01-01").alias("partition_date"),
    )


def document_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The captured document behind each listing entry; every thirteenth is missing."""
    d = table(spark, sf_dir, "documents")
    n = F.col("doc_id")
    return d.where(n % 13 != 0).select(
        F.concat(F.lit(f"{SITE}/doc/"), n.cast("string"), F.lit(".html")).alias("url"),
        F.col("text").cast("binary").alias("content"),
        F.when(n % 2 == 0, "text/plain; charset=utf-8").otherwise("application/pdf").alias("content_type"),
    )


def document_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents held already, some with an error."""
    d = table(spark, sf_dir, "documents")
    n = F.col("doc_id")
    return d.where(n % 3 == 0).select(
        n.cast("string").alias("identifier"),
        F.when(n % 2 == 0, "error").otherwise("extracted").alias("status"),
    )


# -- scraped items, from `events` ------------------------------------------------------

ITEM_ORDER = ["event_id"]


def items_of(events: DataFrame) -> DataFrame:
    """Events as scraped items, many per identifier."""
    user = F.col("user_id").cast("string")
    return events.select(
        F.concat(F.lit("U-"), user).alias("identifier"),
        F.concat(F.lit(f"{SITE}/user/"), user, F.lit(".pdf")).alias("doc_link"),
        F.date_format("ts", "yyyy-MM-dd").alias("partition_date"),
        F.col("event_type").alias("body_type"),
        "event_id",
    )


def scraped_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items_of(table(spark, sf_dir, "events"))


def item_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = table(spark, sf_dir, "events").select("user_id").distinct()
    n = F.col("user_id")
    return users.where(n % 3 == 0).select(
        F.concat(F.lit("U-"), n.cast("string")).alias("identifier"),
        F.when(n % 2 == 0, "error").otherwise("extracted").alias("status"),
    )


def item_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = table(spark, sf_dir, "events").select("user_id").distinct()
    n = F.col("user_id")
    user = n.cast("string")
    return users.where(n % 5 != 0).select(
        F.concat(F.lit(f"{SITE}/user/"), user, F.lit(".pdf")).alias("url"),
        F.concat(F.lit("profile of user "), user).cast("binary").alias("content"),
        F.lit("application/pdf").alias("content_type"),
    )


# -- families, from `orders` -----------------------------------------------------------


def family_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as files of their customer."""
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("C-"), F.col("o_custkey").cast("string")).alias("parent_id"),
        F.concat(F.lit("O-"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("identifier"),
        F.col("o_orderkey").alias("file_seq"),
        F.concat(F.col("o_orderpriority"), F.lit(".html")).alias("file_name"),
    )


def family_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parents that list their children, and the children.

    Every fiftieth child is missing and every seventy-seventh is not declared. A
    parent's list is spread over records of at most a thousand children.
    """
    files = family_files(spark, sf_dir)
    seq = F.col("file_seq")

    def record(df: DataFrame, identifier: str, **metadata) -> DataFrame:
        fields = [
            metadata.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in METADATA.fields
        ]
        return df.select(F.col(identifier).alias("identifier"), F.struct(*fields).alias("metadata"))

    declared = (
        files.where(seq % 77 != 0)
        .groupBy("parent_id", F.floor(seq / 1000).alias("chunk"))
        .agg(F.array_sort(F.collect_list("identifier")).alias("children"))
    )
    parents = record(
        declared, "parent_id", role=F.lit("parent"), children=F.col("children"),
        total_children=F.size("children"),
    )
    children = record(
        files.where(seq % 50 != 0), "identifier", role=F.lit("child"), parent=F.col("parent_id"),
        file_name=F.col("file_name"),
    )
    return parents.unionByName(children)
