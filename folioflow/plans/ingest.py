"""The ingest job: search tasks and captured result pages to the landing zone."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from folioflow.functions.times import as_of_literal
from folioflow.operators.aggregates import INGEST_STATS, stats_row
from folioflow.operators.filters import accepted, body_filter, rejected, required_fields
from folioflow.operators.html import page_facts, pagination_chain, parse_pages, result_records
from folioflow.operators.planning import partition_dates, search_tasks
from folioflow.operators.records import feed_rows, ingest_attach, new_records, without
from folioflow.scale import materialise
from folioflow.schema import LANDING_ZONE, METADATA
from folioflow.sources.store import Collection, KeyTable

ORDER = ["partition_date", "body_type", "page_no", "position"]
STORAGE_ONLY = ["object_name", "stored_content", "stored_type", "is_html"]


class IngestResult(NamedTuple):
    """What a run produced; all frames read from tables already written."""

    records: DataFrame  # new records, stored with status extracted or error
    objects: DataFrame  # their documents
    feed: DataFrame  # all items seen, new and duplicate
    stats: DataFrame  # one row of counts


def crawl(pages: DataFrame, seeds: DataFrame, as_of, bodies=None) -> DataFrame:
    """Items of all result pages reachable from the seeds ``(url, body, partition_date)``."""
    if bodies is not None:
        seeds = body_filter(seeds, bodies, "body")
    facts = materialise(page_facts(parse_pages(pages)), "facts")
    visited = pagination_chain(facts.select("url", "next_url"), seeds)
    results = result_records(facts.join(visited.select("url"), "url", "left_semi"))
    in_page = W.partitionBy("source_url").orderBy("pos")
    now = as_of_literal(as_of)
    return (
        results.withColumn("position", F.row_number().over(in_page).cast("long"))
        .join(visited.withColumnRenamed("url", "source_url"), "source_url")
        .select(
            "identifier",
            "description",
            "published_date",
            F.col("body").alias("body_type"),
            "source_url",
            "doc_link",
            "partition_date",
            (F.col("hop") + 1).alias("page_no"),
            "position",
            now.alias("created_at"),
            now.alias("updated_at"),
        )
    )


def ingest_items(
    items: DataFrame,
    store: DataFrame | KeyTable,
    responses: DataFrame,
    as_of,
    retry_errors: bool = False,
    zone: str = LANDING_ZONE,
    order_cols: list[str] | None = None,
) -> IngestResult:
    """Store the new ones among scraped items together with their documents.

    The statistics are observed while the items and the attached documents are written; nothing is read again for them.
    """
    seen, kept = Observation("items"), Observation("stored")
    checked = required_fields(items, ["identifier", "doc_link"]).observe(seen, F.count(F.lit(1)).alias("total_items"))
    checked = materialise(checked, "items")
    order_cols = order_cols or ORDER
    fresh, _ = new_records(accepted(checked), store, retry_errors, order_cols)
    # Read several times below, and much smaller than what was scraped.
    new = materialise(fresh, "new")
    duplicates = without(accepted(checked), new, order_cols)
    attached = ingest_attach(new, responses, as_of, zone).observe(
        kept,
        F.count(F.lit(1)).alias("items_stored"),
        F.count_if(F.col("status") == "extracted").alias("files_downloaded"),
        F.count_if(F.col("status") == "error").alias("errors"),
    )
    attached = materialise(attached, "attached")

    records = attached.drop(*STORAGE_ONLY)
    objects = attached.where(F.col("status") == "extracted").select(
        F.lit(zone).alias("zone"),
        "object_name",
        F.col("stored_content").alias("content"),
        F.col("stored_type").alias("content_type"),
        F.octet_length("stored_content").cast("long").alias("length"),
    )
    stats = stats_row(items.sparkSession, seen.get | kept.get, INGEST_STATS)
    return IngestResult(records, objects, feed_rows(records, duplicates), stats)


def ingest_job(
    pages: DataFrame,
    seeds: DataFrame,
    store: DataFrame | KeyTable,
    responses: DataFrame,
    as_of,
    bodies: str | list[str] | None = None,
    retry_errors: bool = False,
) -> IngestResult:
    """Crawl, select new items, attach documents.

    ``pages`` are the captured result pages, ``seeds`` the first page of each search
    task, ``store`` the records already held or their key table, and ``responses`` the captured documents
    ``(url, content, content_type)``.
    """
    return ingest_items(crawl(pages, seeds, as_of, bodies), store, responses, as_of, retry_errors)


def search_seeds(spark: SparkSession, start, end, bodies: str | list[str] | None = None) -> DataFrame:
    """(url, body, partition_date) of the first page of every search: one per body and month of the range."""
    tasks = search_tasks(partition_dates(spark, start, end), bodies, start, end)
    return tasks.select(F.col("search_url").alias("url"), "body", "partition_date")


def publish_ingest(result: IngestResult, target: Collection) -> DataFrame:
    """Publish a run's documents, records, identifiers and feed, and return its statistics.

    All parts are staged under the run's name first and become visible by one marker; a run that fails before leaves
    nothing visible, and its next attempt stages under another name.
    """
    records = result.records
    if "metadata" not in records.columns and {"page_no", "position"} <= set(records.columns):
        place = {"page": F.col("page_no"), "position": F.col("position")}
        fields = [place.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in METADATA.fields]
        records = records.withColumn("metadata", F.struct(*fields))
    run = target.log.begin()
    target.objects.append(result.objects, run)
    target.append_records(records, run)
    target.known.append(result.records, run)
    target.append_feed(result.feed, run)
    target.log.commit(run, result.stats.first().asDict())
    return result.stats


def ingest_range(
    pages: DataFrame,
    responses: DataFrame,
    target: Collection,
    start,
    end,
    as_of,
    bodies: str | list[str] | None = None,
    retry_errors: bool = False,
) -> DataFrame:
    """The whole job: plan the searches of a date range, follow them, store what the collection lacks; its statistics."""
    seeds = search_seeds(pages.sparkSession, start, end, bodies)
    return publish_ingest(ingest_job(pages, seeds, target.known, responses, as_of, None, retry_errors), target)
