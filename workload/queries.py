"""One query per operator, each over whole tables of the data set."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from folioflow import scale
from folioflow.functions import content as fc
from folioflow.functions.html_nodes import to_html
from folioflow.functions.links import abs_link, search_url
from folioflow.functions.times import iso_time
from folioflow.operators import aggregates, filters, html, planning, ranking, records
from folioflow.plans.audit import audit_job
from folioflow.plans.ingest import crawl, ingest_items, ingest_job, ingest_range, search_seeds
from folioflow.plans.transform import (
    REQUIRED,
    processed_objects,
    processed_records,
    publish_transform,
    routed,
    transform_job,
)
from folioflow.schema import LANDING_ZONE, PROCESSED_RECORDS, PROCESSED_ZONE, RECORDS
from folioflow.sources import feed, objects, pages, tables
from folioflow.sources.store import Collection, KeyTable, ObjectStore
from folioflow.streaming import incremental
from workload import fixtures as fx

START, END = "2024-01-01", "2024-06-30"


# -- planning ----------------------------------------------------------------------


def _order_spans(spark, sf_dir, key) -> DataFrame:
    day = F.to_date("o_orderdate")
    return fx.table(spark, sf_dir, "orders").groupBy(key).agg(
        F.min(day).alias("first_day"), F.max(day).alias("last_day")
    )


def partition_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    def parts(key, interval, name):
        spans = _order_spans(spark, sf_dir, key)
        return planning.partitions_of(spans, "first_day", "last_day", interval).select(
            F.col(key).cast("string").alias("key"),
            F.lit(name).alias("step"),
            F.date_format("partition_date", "yyyy-MM-dd").alias("partition_date"),
        )

    return (
        parts("o_custkey", "monthly", "monthly")
        .unionByName(parts("o_custkey", 90, "90 days"))
        .unionByName(parts("o_orderpriority", "weekly", "weekly"))
        .unionByName(parts("o_orderstatus", "daily", "daily"))
    )


def search_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = _order_spans(spark, sf_dir, "o_orderpriority")
    parts = planning.partitions_of(spans, "first_day", "last_day", "monthly")
    tasks = planning.search_tasks(
        parts, ["WRC", "LC", "EAT", "ET", "OTHER"], F.col("first_day"), F.col("last_day")
    )
    return tasks.select(
        "o_orderpriority", "body", "body_code", "partition_date",
        F.date_format("period_start", "yyyy-MM-dd").alias("period_start"),
        F.date_format("period_end", "yyyy-MM-dd").alias("period_end"),
        "search_url",
    )


def search_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.to_date("o_orderdate")
    body = F.concat("o_orderpriority", F.lit(" ~*/&"), "o_orderstatus")
    return fx.table(spark, sf_dir, "orders").select(
        "o_orderkey", search_url(body, day, F.add_months(day, 1)).alias("search_url")
    )


def assign_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fx.table(spark, sf_dir, "events").select("event_id", "ts")
    monthly = planning.assign_partition(events, "ts").withColumnRenamed("partition_date", "month")
    weekly = planning.assign_partition(monthly, "ts", "weekly", "2024-01-03")
    return planning.assign_partition(
        weekly.withColumnRenamed("partition_date", "week"), "ts", 10, "2024-01-01"
    ).select("event_id", "month", "week", F.col("partition_date").alias("ten_days"))


def assign_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uneven opening hours with gaps and overlaps, on the days that have events."""
    events = fx.table(spark, sf_dir, "events").select("event_id", "ts")
    day = F.to_timestamp(F.to_date("ts"))
    days = events.where("event_id % 3 <> 0").select(day.alias("day"), F.dayofyear("ts").alias("n")).distinct()

    def hours(n) -> F.Column:
        return F.make_dt_interval(hours=n)

    grid = days.select(
        F.explode(
            F.array(
                F.struct(F.lit("early").alias("shift"), F.col("day").alias("a"), (F.col("day") + hours(F.col("n") % 5 * 2)).alias("b")),
                F.struct(F.lit("late").alias("shift"), (F.col("day") + hours(F.lit(6))).alias("a"), (F.col("day") + hours(F.lit(7) + F.col("n") % 30)).alias("b")),
            )
        ).alias("x")
    )
    grid = grid.select("x.shift", F.col("x.a").alias("interval_start"), F.col("x.b").alias("interval_end"))
    text = "yyyy-MM-dd HH:mm"
    return planning.assign_interval(events, "ts", grid).select(
        "event_id", "shift", F.date_format("interval_start", text).alias("opens"), F.date_format("interval_end", text).alias("closes")
    )


# -- sources and sinks -----------------------------------------------------------------


def records_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scale.scratch_path(spark, "records")
    fx.landing_records(spark, sf_dir).write.json(path)
    return tables.records_scan(spark, path, RECORDS, "json").select(
        "identifier", "body_type", "partition_date", "file_path", "mime_type", "status"
    )


def records_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scale.scratch_path(spark, "records")
    all_records = fx.landing_records(spark, sf_dir)
    tables.records_append(all_records.where("status = 'extracted'"), path)
    tables.records_append(all_records.where("status = 'error'"), path)
    return tables.records_scan(spark, path).select("identifier", "partition_date", "status")


def records_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    all_records = fx.landing_records(spark, sf_dir)
    path = scale.scratch_path(spark, "records")
    tables.records_append(all_records, path)
    updates = all_records.where("status = 'error'").select(
        "identifier",
        F.lit("extracted").alias("status"),
        F.concat(F.lit("retried "), "doc_link").alias("notes"),
    )
    tables.records_update_table(spark, path, updates, fx.AS_OF)
    return tables.records_scan(spark, path).select(
        "identifier", "status", "notes", "partition_date",
        F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss").alias("updated_at"),
    )


def _page_files(spark: SparkSession, sf_dir: str) -> str:
    """A folder with every landing document as a file."""
    path = scale.scratch_path(spark, "files")
    objects.objects_export(fx.landing_objects(spark, sf_dir), path)
    return path


def objects_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return objects.objects_scan(spark, _page_files(spark, sf_dir), LANDING_ZONE).select(
        "zone", "object_name", "length", fc.content_hash(F.col("content")).alias("content_hash")
    )


def objects_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs into one store, compacted in between: the newest object of each name counts."""
    store = ObjectStore(spark, scale.scratch_path(spark, "store"), LANDING_ZONE, 4)
    landing = fx.landing_objects(spark, sf_dir)
    store.append(landing.withColumn("content_type", F.lit("text/plain")))
    store.append(landing)
    store.compact()
    store.append(_events_as_objects(spark, sf_dir, last=True))
    return store.objects().select(
        "object_name", "content_type", "length", fc.content_hash(F.col("content")).alias("content_hash")
    )


def _events_as_objects(spark: SparkSession, sf_dir: str, last: bool = False) -> DataFrame:
    """Users 0.. written over or added as documents, the latest event last."""
    events = fx.table(spark, sf_dir, "events")
    if last:
        events = events.groupBy("user_id").agg(F.max_by("props", "event_id").alias("props"), F.max("event_id").alias("event_id"))
    return events.select(
        F.lit(LANDING_ZONE).alias("zone"),
        F.concat(F.lit("DOC-"), F.lpad(F.col("user_id").cast("string"), 8, "0"), F.lit(".html")).alias(
            "object_name"
        ),
        F.col("props").cast("binary").alias("content"),
        F.lit("application/json").alias("content_type"),
        F.octet_length("props").cast("long").alias("length"),
        "event_id",
    )


def objects_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    existing = fx.landing_objects(spark, sf_dir)
    merged = objects.objects_upsert(existing, _events_as_objects(spark, sf_dir), [F.desc("event_id")])
    return merged.select(
        "object_name", "content_type", "length", fc.content_hash(F.col("content")).alias("content_hash")
    )


def feed_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.scraped_items(spark, sf_dir)
    path = scale.scratch_path(spark, "feed")
    options = {"json": {}, "csv": {"header": "true", "escape": '"'}, "xml": {"rowTag": "item"}}
    parts = []
    for fmt, how in options.items():
        feed.feed_export(rows, f"{path}/{fmt}", fmt)
        back = spark.read.schema(rows.schema).format(fmt).options(**how).load(f"{path}/{fmt}")
        parts.append(back.select(F.lit(fmt).alias("fmt"), "*"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def pages_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages as a table and as files, read as text and as bytes."""
    files = _page_files(spark, sf_dir)
    name = F.regexp_extract("url", r"DOC-0*(\d+)\.html$", 1).cast("long")
    parts = [
        pages.pages_scan(spark, f"{sf_dir}/pages.parquet").select(F.lit("table").alias("read_as"), "page_id", "html"),
        pages.pages_scan(spark, files, "text").select(F.lit("text").alias("read_as"), name.alias("page_id"), "html"),
        pages.pages_scan(spark, files, "binaryFile").select(F.lit("bytes").alias("read_as"), name.alias("page_id"), "html"),
    ]
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return every.select("read_as", "page_id", F.length("html").cast("long").alias("n_chars"), F.sha2("html", 256).alias("html_hash"))


def zone_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return objects.zone_listing(fx.landing_objects(spark, sf_dir), LANDING_ZONE)


# -- filters -------------------------------------------------------------------------


def records_by_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = filters.records_by_range(
        fx.landing_records(spark, sf_dir), "2024-02-15", "2024-09-01", "extracted"
    )
    return chosen.select("identifier", "partition_date", "status")


def record_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.record_lookup(fx.landing_records(spark, sf_dir), "DOC-00000042").select(
        "identifier", "doc_link", "partition_date", "mime_type"
    )


def required_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = filters.required_fields(
        fx.landing_records(spark, sf_dir), ["identifier", "file_path", "mime_type"]
    )
    return checked.select("identifier", "reject_reason")


def object_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Every fifth record is looked for in another zone.
    other = F.substring("identifier", -1, 1).isin("0", "5")
    named = fx.landing_records(spark, sf_dir).select(
        "identifier",
        F.when(other, PROCESSED_ZONE).otherwise(F.substring_index("file_path", "/", 1)).alias("zone"),
        fc.object_name(F.col("file_path")).alias("name"),
    )
    listing = objects.zone_listing(fx.landing_objects(spark, sf_dir), LANDING_ZONE)
    return filters.object_exists(named, listing, "name")


def body_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.body_filter(fx.landing_records(spark, sf_dir), ["WRC", "EAT"]).select(
        "identifier", "body_type"
    )


def nested_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.nested_filter(fx.family_records(spark, sf_dir), "metadata.role", "child").select(
        "identifier", F.col("metadata.parent").alias("parent")
    )


def mime_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.mime_filter(fx.landing_records(spark, sf_dir), "application/pdf").select(
        "identifier", "mime_type"
    )


# -- column expressions ------------------------------------------------------------------


def content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.table(spark, sf_dir, "documents").select(
        "doc_id", fc.content_hash(F.col("text").cast("binary")).alias("file_hash")
    )


def _mimes(spark, sf_dir) -> DataFrame:
    """Events with header-like MIME strings in mixed case, spacing and parameters."""
    n = F.col("event_id")
    base = fx._nth(
        n % 7,
        ["text/html", "Application/PDF", "application/msword", "text/htm", "text/plain", "image/png",
         "application/vnd.openxmlformats-officedocument.wordprocessingml.document"],
    )
    suffix = fx._nth(n % 4, ["", "; charset=utf-8", " ;q=1", ";a;b"])
    mime = F.when(n % 11 != 0, F.concat(F.when(n % 5 == 0, " ").otherwise(""), base, suffix))
    path = fx._nth(
        n % 9,
        ["/doc.PDF", "/a.b/file", "/.pdf", "/x/report.docx?dl=1", "/page.htm#top", "/data.csv",
         "", "/..txt", "/v.html;s=1"],
    )
    url = F.concat(F.lit("https://www.example.org"), path)
    return fx.table(spark, sf_dir, "events").select("event_id", mime.alias("mime"), url.alias("url"))


def mime_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mimes(spark, sf_dir).select("event_id", fc.mime_ingest(F.col("mime")).alias("mime_type"))


def mime_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mimes(spark, sf_dir).select(
        "event_id", fc.mime_transform(F.col("mime")).alias("mime_type")
    )


def ext_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mimes(spark, sf_dir).select(
        "event_id", fc.ext_landing(F.col("url"), fc.mime_ingest(F.col("mime"))).alias("ext")
    )


def ext_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mimes(spark, sf_dir).select("event_id", fc.ext_processed(F.col("mime")).alias("ext"))


def object_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = fx.table(spark, sf_dir, "pages").select(
        "page_id", fc.object_path("processed", F.concat("url", F.lit(".html"))).alias("path")
    )
    return named.withColumn("name", fc.object_name(F.col("path"))).withColumn(
        "inner_name", fc.object_name(F.col("name"))
    )


def html_sniff(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = fx.table(spark, sf_dir, "pages").select(
        F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("key"),
        F.lit("application/pdf").alias("mime"),
        # Every third page begins with so much text that its markup is out of reach.
        F.when(F.col("page_id") % 3 == 0, F.concat(F.repeat(F.lit("x"), 1017), "html"))
        .otherwise(F.col("html"))
        .alias("body"),
    )
    text = fx.table(spark, sf_dir, "documents").select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("key"),
        F.when(F.col("doc_id") % 4 == 0, "text/html5").otherwise("text/plain").alias("mime"),
        F.col("text").alias("body"),
    )
    return page.unionByName(text).select(
        "key", fc.html_sniff(F.col("mime"), F.col("body").cast("binary")).alias("is_html")
    )


def decode_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.table(spark, sf_dir, "documents").select(
        "doc_id", fc.decode_ignore(F.col("text").cast("binary")).alias("text")
    )


def doc_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = filters.required_fields(fx.landing_records(spark, sf_dir), REQUIRED)
    done = routed(checked, fx.landing_objects(spark, sf_dir))
    ok = F.col("failure").isNull()
    return done.select("identifier", "failure", *[F.when(ok, F.col(c)).alias(c) for c in ("route", "new_name", "new_hash")])


def stamp_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamped = records.stamp_record(
        fx.landing_records(spark, sf_dir),
        "transformed",
        fx.AS_OF,
        file_path=F.concat(F.lit("processed/"), "identifier", fc.ext_processed(F.coalesce("mime_type", F.lit("")))),
    )
    return stamped.select(
        "identifier", "file_path", "status",
        F.date_format("transformation_date", "yyyy-MM-dd HH:mm:ss").alias("transformation_date"),
    )


def abs_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("page_id")
    href = fx._nth(
        n % 7, ["/doc/A.html", "?p=2", "#top", "//cdn.example.org/x", "https://other.org/y", "", "b/c.pdf"]
    )
    return fx.table(spark, sf_dir, "pages").select(
        "page_id",
        abs_link(F.when(n % 11 != 0, href), F.concat(F.lit("https://example.org/en/s?q="), n.cast("string"))).alias(
            "link"
        ),
    )


def iso_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.when(F.col("event_id") % 2 == 0, F.date_trunc("second", "ts")).otherwise(F.col("ts"))
    return fx.table(spark, sf_dir, "events").select("event_id", iso_time(ts).alias("iso"))


def size_reduction(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = html.clean_html(
        fx.table(spark, sf_dir, "pages").withColumn("original", F.col("html"))
    )
    return cleaned.select(
        "page_id", F.round(fc.size_reduction(F.col("original"), F.col("clean_html")), 6).alias("reduction")
    )


# -- joins ------------------------------------------------------------------------------


def new_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, store = fx.scraped_items(spark, sf_dir), fx.item_store(spark, sf_dir)
    new, duplicates = records.new_records(items, store, order_cols=fx.ITEM_ORDER)
    return new.select("identifier", "event_id", F.lit(True).alias("is_new")).unionByName(
        duplicates.select("identifier", "event_id", F.lit(False).alias("is_new"))
    )


def new_records_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same against a key table that grew in two runs."""
    items, store = fx.scraped_items(spark, sf_dir), fx.item_store(spark, sf_dir)
    known = KeyTable(spark, scale.scratch_path(spark, "keys"), 4)
    known.append(store.where("status = 'error'"))
    known.append(store.where("status <> 'error'"))
    new, duplicates = records.new_records(items, known, order_cols=fx.ITEM_ORDER)
    return new.select("identifier", "event_id", F.lit(True).alias("is_new")).unionByName(
        duplicates.select("identifier", "event_id", F.lit(False).alias("is_new"))
    )


def records_with_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = fx.landing_records(spark, sf_dir).where(F.col("file_path").isNotNull())
    joined = records.records_with_content(r, fx.landing_objects(spark, sf_dir))
    return joined.select(
        "identifier", "object_name", "failure",
        F.octet_length("content").cast("long").alias("n_bytes"),
    )


def ingest_attach(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = fx.table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("identifier"),
        F.concat(F.lit(f"{fx.SITE}/doc/"), F.col("doc_id").cast("string"), F.lit(".html")).alias("doc_link"),
    )
    attached = records.ingest_attach(items, fx.document_responses(spark, sf_dir), fx.AS_OF)
    return attached.select(
        "identifier", "mime_type", "file_path", "file_hash", "stored_hash", "status", "notes"
    )


def _transformed(spark, sf_dir) -> DataFrame:
    return transform_job(
        fx.landing_records(spark, sf_dir), fx.landing_objects(spark, sf_dir), START, END, fx.AS_OF
    )


def before_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = processed_records(_transformed(spark, sf_dir))
    compared = records.before_after(fx.landing_records(spark, sf_dir), done)
    return compared.select(
        "identifier", "processed", "new_name", "name_ok", "hash_changed", "source_zone", "new_zone",
        "zone_ok", "old_status", "new_status", "status_ok",
    )


def body_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = fx.landing_records(spark, sf_dir)
    d = fx.table(spark, sf_dir, "documents")
    bodies = r.select(F.col("identifier").alias("key"), F.col("body_type").alias("body")).unionByName(
        d.select(F.col("doc_id").cast("string").alias("key"), F.col("source").alias("body"))
    )
    return planning.body_code(bodies)


def parent_child(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.parent_child(fx.family_records(spark, sf_dir))


def child_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.child_diff(fx.family_records(spark, sf_dir))


def pagination_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = html.next_link(html.parse_pages(fx.listing_pages(spark, sf_dir)))
    chain = html.pagination_chain(links, fx.listing_seeds(spark, sf_dir))
    return chain.select("url", "body", "hop")


# -- HTML -----------------------------------------------------------------------------------


def html_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = html.html_nodes(fx.table(spark, sf_dir, "pages"))
    return (
        nodes.where("kind = 'elem'")
        .groupBy("page_id", "tag")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def drop_boilerplate(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = html.drop_boilerplate(html.parse_pages(fx.table(spark, sf_dir, "pages")))
    return kept.select("page_id", to_html().alias("html"))


def main_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = html.parse_pages(fx.variant_pages(spark, sf_dir))
    found = html.main_content(html.drop_boilerplate(parsed))
    return found.select("page_id", to_html().alias("html"))


def clean_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.clean_html(fx.table(spark, sf_dir, "pages")).select(
        "page_id", "clean_html", "clean_hash"
    )


def normalize_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.normalize_html(fx.table(spark, sf_dir, "pages")).select(
        "page_id", "normal_html", "stored_hash"
    )


def result_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = html.page_facts(html.parse_pages(fx.listing_pages(spark, sf_dir)))
    return html.result_records(facts).select(
        "source_url", "identifier", "description", "published_date", "doc_link"
    )


def next_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.next_link(html.parse_pages(fx.listing_pages(spark, sf_dir)))


def node_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = html.parse_pages(fx.listing_pages(spark, sf_dir))
    return html.node_text(parsed, "p", "description").select("url", "node_text")


# -- aggregations -------------------------------------------------------------------------------


def transform_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.transform_stats(_transformed(spark, sf_dir))


def _ingested_items(spark, sf_dir):
    return ingest_items(
        fx.scraped_items(spark, sf_dir),
        fx.item_store(spark, sf_dir),
        fx.item_responses(spark, sf_dir),
        fx.AS_OF,
        order_cols=fx.ITEM_ORDER,
    )


def ingest_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ingested_items(spark, sf_dir).stats


def count_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.count_where(
        fx.landing_records(spark, sf_dir),
        (F.col("mime_type") == "application/pdf") & (F.col("status") == "extracted"),
    )


def group_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.group_counts(fx.family_files(spark, sf_dir), ["parent_id"])


def extension_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = processed_objects(_transformed(spark, sf_dir))
    return aggregates.extension_counts(done)


def group_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.group_members(fx.family_files(spark, sf_dir), per_row=8).select(
        "parent_id", "part_no", "n_members", F.array_join("members", ",").alias("members")
    )


def results_per_task(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.results_per_task(fx.scraped_items(spark, sf_dir))


def hash_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.hash_audit(
        fx.landing_records(spark, sf_dir), fx.landing_objects(spark, sf_dir)
    )


def zone_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = fx.landing_objects(spark, sf_dir)
    return aggregates.zone_totals(
        landing.unionByName(processed_objects(_transformed(spark, sf_dir)))
    )


def quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = aggregates.count_where(fx.landing_records(spark, sf_dir), "status = 'extracted'")
    return aggregates.quality_gate(before, aggregates.transform_stats(_transformed(spark, sf_dir)))


def html_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = fx.table(spark, sf_dir, "pages").select("page_id", "html")
    after = html.clean_html(before).select("page_id", F.col("clean_html").alias("html"))
    return aggregates.html_audit(before, after, "page_id").withColumn(
        "size_reduction", F.round("size_reduction", 6)
    )


# -- windows and sets -------------------------------------------------------------------------------


def first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.first_wins(fx.scraped_items(spark, sf_dir), fx.ITEM_ORDER)


def file_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.file_index(fx.family_files(spark, sf_dir)).select(
        "parent_id", "identifier", "file_index", "total_files"
    )


def page_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.listing_items(spark, sf_dir).select("doc_id", "source", "page_no", "position")


def sample_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = processed_records(_transformed(spark, sf_dir))
    return filters.sample_limit(done.select("identifier", "mime_type", "doc_link", "file_path"), 5)


def feed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = _ingested_items(spark, sf_dir)
    return result.feed.select("identifier", "event_id", "status", "file_path")


# -- streaming ------------------------------------------------------------------------------------------


def _event_stream(spark, sf_dir) -> DataFrame:
    schema = fx.table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
    return fx.items_of(stream.parquet(sf_dir))


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scale.scratch_path(spark, "stream")
    incremental.stream_ingest(
        _event_stream(spark, sf_dir), fx.item_store(spark, sf_dir), fx.item_responses(spark, sf_dir),
        f"{out}/records", f"{out}/objects", f"{out}/checkpoint", fx.AS_OF, fx.ITEM_ORDER,
    ).awaitTermination()
    return spark.read.parquet(f"{out}/records").select(
        "identifier", "event_id", "status", "file_path", "file_hash"
    )


def stream_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The earliest event of each user, though later ones arrive first: four files, the latest events in the first."""
    out = scale.scratch_path(spark, "earliest")
    events = fx.table(spark, sf_dir, "events").select(
        F.col("user_id").alias("identifier"), F.col("ts").cast("timestamp").alias("ts"), "event_id"
    )
    last = events.agg(F.max("ts").alias("last"))
    # A row far behind all others ends the wait for them.
    closing = last.select(F.lit(-1).cast("long").alias("identifier"), F.expr("last + INTERVAL 4000 DAYS").alias("ts"), F.lit(-1).cast("long").alias("event_id"))
    quarter = F.ntile(4).over(W.partitionBy(F.lit(0)).orderBy("day"))
    days = events.select(F.to_date("ts").alias("day")).distinct().withColumn("quarter", quarter)  # one row per day
    dated = events.withColumn("day", F.to_date("ts")).join(days, "day").drop("day")
    for k in (4, 3, 2, 1):
        dated.where(F.col("quarter") == k).drop("quarter").coalesce(1).write.mode("append").parquet(f"{out}/in")
    closing.coalesce(1).write.mode("append").parquet(f"{out}/in")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{out}/in")
    won = incremental.stream_first_wins(stream, "ts", "1000 days", 86_400_000)
    (
        won.writeStream.format("parquet")
        .option("path", f"{out}/rows")
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return spark.read.schema(events.schema).parquet(f"{out}/rows").select("identifier", text.alias("first_seen"))


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scale.scratch_path(spark, "dedup")
    deduped = incremental.stream_dedup(_event_stream(spark, sf_dir), unbounded=True).select("identifier", "doc_link")
    (
        deduped.writeStream.format("parquet")
        .option("path", f"{out}/rows")
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.schema(deduped.schema).parquet(f"{out}/rows")


def stream_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scale.scratch_path(spark, "transform")
    tables.records_append(fx.landing_records(spark, sf_dir), f"{out}/landing")
    landed = spark.readStream.schema(RECORDS).parquet(f"{out}/landing")
    incremental.stream_transform(
        landed, fx.landing_objects(spark, sf_dir), START, END,
        f"{out}/records", f"{out}/objects", f"{out}/checkpoint", fx.AS_OF,
    ).awaitTermination()
    return spark.read.schema(PROCESSED_RECORDS).parquet(f"{out}/records").select(
        "identifier", "file_path", "file_hash", "status"
    )


# -- whole jobs -------------------------------------------------------------------------------------------


def crawl_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = crawl(fx.listing_pages(spark, sf_dir), fx.listing_seeds(spark, sf_dir), fx.AS_OF)
    return items.select(
        "identifier", "description", "published_date", "body_type", "source_url", "doc_link",
        "partition_date", "page_no", "position",
    )


def ingest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = ingest_job(
        fx.listing_pages(spark, sf_dir), fx.listing_seeds(spark, sf_dir),
        fx.document_store(spark, sf_dir), fx.document_responses(spark, sf_dir), fx.AS_OF,
    )
    return result.records.select(
        "identifier", "body_type", "page_no", "position", "mime_type", "file_path", "file_hash", "status"
    )


def transform_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _transformed(spark, sf_dir).select(
        "identifier", "outcome", "status", "file_path", "file_hash",
        F.octet_length("new_content").cast("long").alias("n_bytes"),
    )


def _processed(spark: SparkSession, name: str) -> Collection:
    return Collection(spark, scale.scratch_path(spark, name), PROCESSED_ZONE, PROCESSED_RECORDS, 4)


def ingest_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From a date range and bodies to the tables read back; a second run of the same range adds nothing."""
    start, end, bodies = "2024-02-10", "2024-04-20", ["WRC", "EAT"]
    target = Collection(spark, scale.scratch_path(spark, "collection"), buckets=4)
    found = scale.materialise(fx.search_pages(spark, sf_dir, search_seeds(spark, start, end)), "pages")
    for _ in range(2):
        ingest_range(found, fx.document_responses(spark, sf_dir), target, start, end, fx.AS_OF, bodies)
    listing = target.objects.listing().select(fc.object_path(F.col("zone"), F.col("object_name")).alias("file_path"), "length")
    return target.records().join(listing, "file_path", "left").select(
        "identifier", "body_type", "partition_date", "metadata.page", "metadata.position", "mime_type", "file_path",
        "file_hash", "status", "length",
    )


def transform_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transform job over a stored zone, whose documents stay in their buckets."""
    store = ObjectStore(spark, scale.scratch_path(spark, "landing"), LANDING_ZONE, 4)
    store.append(fx.landing_objects(spark, sf_dir))
    done = transform_job(fx.landing_records(spark, sf_dir), store, START, END, fx.AS_OF)
    return done.select(
        "identifier", "outcome", "status", "file_path", "file_hash",
        F.octet_length("new_content").cast("long").alias("n_bytes"),
    )


def publish_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics counted while the outcomes are written, next to those the log of runs holds."""
    target = _processed(spark, "counted")
    told = publish_transform(_transformed(spark, sf_dir), target).withColumn("told_by", F.lit("write"))
    return told.unionByName(target.log.counts().drop("run").withColumn("told_by", F.lit("log")))


def transform_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = _processed(spark, "published")
    publish_transform(_transformed(spark, sf_dir), target)
    return target.records().select(
        "identifier", "partition_date", "file_path", fc.object_name(F.col("file_path")).alias("object_name")
    ).join(target.objects.listing().select("object_name", "length"), "object_name", "left")


def transform_republished(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects after publishing the same run twice: one of each name."""
    target = _processed(spark, "republished")
    outcomes = scale.materialise(_transformed(spark, sf_dir), "outcomes")
    for _ in range(2):
        publish_transform(outcomes, target)
    return target.objects.objects().select("zone", "object_name", "length", F.sha2("content", 256).alias("stored_hash"))


def audit_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = fx.landing_records(spark, sf_dir)
    family = fx.family_records(spark, sf_dir)
    outcomes = scale.materialise(_transformed(spark, sf_dir), "outcomes")
    zones = fx.landing_objects(spark, sf_dir).unionByName(processed_objects(outcomes))
    both = landing.unionByName(family, allowMissingColumns=True)
    return audit_job(both, processed_records(outcomes), zones)


QUERIES = {
    "partition_dates": partition_dates,
    "search_tasks": search_tasks,
    "search_url": search_urls,
    "assign_partition": assign_partition,
    "assign_interval": assign_interval,
    "records_scan": records_scan,
    "objects_scan": objects_scan,
    "records_append": records_append,
    "records_update": records_update,
    "objects_upsert": objects_upsert,
    "objects_stored": objects_stored,
    "feed_export": feed_export,
    "pages_scan": pages_scan,
    "zone_listing": zone_listing,
    "records_by_range": records_by_range,
    "record_lookup": record_lookup,
    "required_fields": required_fields,
    "object_exists": object_exists,
    "body_filter": body_filter,
    "nested_filter": nested_filter,
    "mime_filter": mime_filter,
    "content_hash": content_hash,
    "mime_ingest": mime_ingest,
    "mime_transform": mime_transform,
    "ext_landing": ext_landing,
    "ext_processed": ext_processed,
    "object_path": object_path,
    "html_sniff": html_sniff,
    "decode_ignore": decode_ignore,
    "doc_route": doc_route,
    "stamp_record": stamp_record,
    "abs_link": abs_links,
    "iso_time": iso_times,
    "size_reduction": size_reduction,
    "new_records": new_records,
    "new_records_stored": new_records_stored,
    "records_with_content": records_with_content,
    "ingest_attach": ingest_attach,
    "before_after": before_after,
    "body_code": body_code,
    "parent_child": parent_child,
    "pagination_chain": pagination_chain,
    "html_nodes": html_nodes,
    "drop_boilerplate": drop_boilerplate,
    "main_content": main_content,
    "clean_html": clean_html,
    "normalize_html": normalize_html,
    "result_records": result_records,
    "next_link": next_link,
    "node_text": node_text,
    "transform_stats": transform_stats,
    "ingest_stats": ingest_stats,
    "count_where": count_where,
    "group_counts": group_counts,
    "extension_counts": extension_counts,
    "group_members": group_members,
    "results_per_task": results_per_task,
    "hash_audit": hash_audit,
    "zone_totals": zone_totals,
    "quality_gate": quality_gate,
    "html_audit": html_audit,
    "first_wins": first_wins,
    "file_index": file_index,
    "page_position": page_position,
    "sample_limit": sample_limit,
    "feed_rows": feed_rows,
    "child_diff": child_diff,
    "stream_ingest": stream_ingest,
    "stream_first_wins": stream_first_wins,
    "stream_dedup": stream_dedup,
    "stream_transform": stream_transform,
    "crawl_items": crawl_items,
    "ingest_job": ingest_run,
    "ingest_published": ingest_published,
    "transform_job": transform_run,
    "transform_stored": transform_stored,
    "publish_stats": publish_stats,
    "transform_published": transform_published,
    "transform_republished": transform_republished,
    "audit_job": audit_run,
}
