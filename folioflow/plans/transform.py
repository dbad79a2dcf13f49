"""The transform job: landing zone to processed zone."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from folioflow.functions.content import (
    content_hash,
    decode_ignore,
    doc_route,
    ext_processed,
    object_path,
)
from folioflow.functions.html_nodes import clean_html, parse_html
from folioflow.functions.times import as_of_literal
from folioflow.operators.aggregates import TRANSFORM_STATS, stat_columns, stats_row
from folioflow.operators.filters import records_by_range, required_fields
from folioflow.operators.records import records_with_content
from folioflow.scale import materialise, spread
from folioflow.schema import LANDING_ZONE, PROCESSED_ZONE
from folioflow.sources.store import Collection, ObjectStore

REQUIRED = ["identifier", "file_path", "mime_type"]


def process_files(files: DataFrame) -> DataFrame:
    """Clean HTML and pass other documents through.

    Needs ``identifier``, ``mime_type`` and ``content``; adds ``route``,
    ``new_content``, ``new_hash``, ``new_name`` and ``error``. Only HTML rows reach
    the parser, and all rows stay in their partition.
    """
    text = F.when(F.col("route") == "html", decode_ignore(F.col("content")))
    cleaned = F.when(F.col("error").isNull(), clean_html("_parsed.nodes"))
    return (
        files.withColumn("route", doc_route(F.col("mime_type")))
        .withColumn("_parsed", parse_html(text))
        .withColumn("error", F.col("_parsed.error"))
        .withColumn(
            "new_content",
            F.when(F.col("route") == "html", cleaned.cast("binary")).otherwise(F.col("content")),
        )
        .withColumn("new_hash", content_hash(F.col("new_content")))
        .withColumn("new_name", F.concat("identifier", ext_processed(F.col("mime_type"))))
        .drop("_parsed")
    )


def routed(checked: DataFrame, objects: DataFrame | ObjectStore, zone: str = LANDING_ZONE) -> DataFrame:
    """Every record with its route and new document, or with the ``failure`` that keeps it from having one.

    ``checked`` has gone through ``required_fields``: records it rejects fail with that reason, the others if their object is
    missing or cannot be read.
    """
    usable = checked.where(F.col("reject_reason").isNull())
    unusable = checked.where(F.col("reject_reason").isNotNull()).withColumn("failure", F.col("reject_reason"))
    documents = objects if isinstance(objects, ObjectStore) else spread(objects.where(F.col("zone") == zone))
    done = process_files(records_with_content(usable, documents))
    done = done.withColumn("failure", F.coalesce("failure", "error")).drop("error", "content", "object_name")
    return done.unionByName(unusable, allowMissingColumns=True)


def transform_job(
    records: DataFrame,
    objects: DataFrame | ObjectStore,
    start: str,
    end: str,
    as_of,
    processed: DataFrame | None = None,
    skip_existing: bool = False,
    zone: str = LANDING_ZONE,
    new_zone: str = PROCESSED_ZONE,
) -> DataFrame:
    """One row per selected record with its ``outcome``: processed, failed or skipped.

    Processed rows carry the new record columns, ``new_name`` and ``new_content``.
    With ``skip_existing`` records already in ``processed`` are not selected again;
    by default a rerun processes them once more. ``objects`` is a table of objects or the store of the zone.
    """
    selected = required_fields(records_by_range(records, start, end, "extracted"), REQUIRED)
    if skip_existing:
        if processed is None:
            raise ValueError("skip_existing needs the processed records")
        selected = selected.join(
            processed.select("identifier").distinct(), "identifier", "left_anti"
        )
    done = routed(selected, objects, zone)
    skipped = F.col("reject_reason").isNotNull()
    ok = F.col("failure").isNull()
    now = as_of_literal(as_of)
    return (
        done.withColumns(
            {
                "outcome": F.when(ok, "processed").when(skipped, "skipped").otherwise("failed"),
                "reason": F.col("failure"),
                "file_path": F.when(ok, object_path(new_zone, F.col("new_name"))).otherwise(
                    F.col("file_path")
                ),
                "file_hash": F.when(ok, F.col("new_hash")).otherwise(F.col("file_hash")),
                "updated_at": F.when(ok, now).otherwise(F.col("updated_at")),
                "transformation_date": F.when(ok, now),
                "status": F.when(ok, "transformed").otherwise(F.col("status")),
            }
        )
        .select(
            *records.columns, "transformation_date", "outcome", "reason", "new_name", "new_content"
        )
    )


def processed_records(outcomes: DataFrame) -> DataFrame:
    """New records of the processed zone."""
    return outcomes.where(F.col("outcome") == "processed").drop(
        "outcome", "reason", "new_name", "new_content"
    )


def processed_objects(outcomes: DataFrame, new_zone: str = PROCESSED_ZONE) -> DataFrame:
    """New objects of the processed zone."""
    return outcomes.where(F.col("outcome") == "processed").select(
        F.lit(new_zone).alias("zone"),
        F.col("new_name").alias("object_name"),
        F.col("new_content").alias("content"),
        F.col("mime_type").alias("content_type"),
        F.octet_length("new_content").cast("long").alias("length"),
    )


def publish_transform(outcomes: DataFrame, target: Collection) -> DataFrame:
    """Publish the records and objects of a run together and return its statistics.

    The outcomes are computed and counted once, on their way into scratch space; records and objects are written from there.
    Objects take the place of those of the same name, so a rerun leaves one of each; records are appended. Nothing is visible before all
    of it is written.
    """
    counts = Observation("transform")
    outcomes = materialise(outcomes.observe(counts, *stat_columns()), "outcomes")
    run = target.log.begin()
    target.objects.append(processed_objects(outcomes, target.objects.zone), run)
    target.append_records(processed_records(outcomes), run)
    target.log.commit(run, counts.get)
    return stats_row(outcomes.sparkSession, counts.get, TRANSFORM_STATS)
