"""Counts, totals and audits. Every one is a partial aggregate before its shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.functions.content import content_hash, object_path
from folioflow.operators.filters import matches
from folioflow.operators.records import file_name, file_suffix


def _count_if(cond: Column) -> Column:
    return F.count_if(F.coalesce(cond, F.lit(False)))


TRANSFORM_STATS = ["total", "processed", "failed", "skipped"]


def stat_columns() -> list[Column]:
    """Counts of outcomes, for an aggregate or to be observed while the outcomes are written."""
    outcome = F.col("outcome")
    return [F.count(F.lit(1)).alias("total"), *[_count_if(outcome == x).alias(x) for x in TRANSFORM_STATS[1:]]]


def transform_stats(outcomes: DataFrame) -> DataFrame:
    """One row: total, processed, failed, skipped."""
    return outcomes.agg(*stat_columns())


def stats_row(spark: SparkSession, counts: dict, names: list[str]) -> DataFrame:
    """Observed counts as one row; a write without any row observes nothing."""
    return spark.createDataFrame([tuple(int(counts.get(n) or 0) for n in names)], ", ".join(f"{n} bigint" for n in names))


INGEST_STATS = ["total_items", "items_stored", "files_downloaded", "errors"]


def ingest_stats(outcomes: DataFrame) -> DataFrame:
    """One row: items seen, records stored, files downloaded, errors."""
    stored = F.col("outcome") == "stored"
    return outcomes.agg(
        F.count(F.lit(1)).alias("total_items"),
        _count_if(stored).alias("items_stored"),
        _count_if(stored & (F.col("status") == "extracted")).alias("files_downloaded"),
        _count_if(stored & (F.col("status") == "error")).alias("errors"),
    )


def count_where(df: DataFrame, cond: Column | str) -> DataFrame:
    """Number of rows that satisfy the condition."""
    return df.agg(_count_if(matches(cond)).alias("n"))


def group_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows per group, sorted by the group."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).orderBy(*cols)


def extension_counts(objects: DataFrame) -> DataFrame:
    """Objects per file extension, sorted."""
    named = objects.select(file_suffix(file_name(F.col("object_name"))).alias("extension"))
    return group_counts(named, ["extension"])


def results_per_task(items: DataFrame) -> DataFrame:
    """Results found per body and partition."""
    return items.groupBy("body_type", "partition_date").agg(F.count(F.lit(1)).alias("n"))


def hash_audit(records: DataFrame, objects: DataFrame) -> DataFrame:
    """Per MIME type: documents whose recomputed hash differs from the recorded one.

    Hashes are computed where the bytes are; only names and hashes are shuffled. A record's
    document is the object of its own zone and name.
    """
    actual = objects.select(
        object_path(F.col("zone"), F.col("object_name")).alias("file_path"),
        content_hash(F.col("content")).alias("actual_hash"),
    )
    joined = records.select("file_path", "mime_type", "file_hash").join(actual, "file_path", "left")
    return joined.groupBy("mime_type").agg(
        _count_if(F.col("actual_hash") == F.col("file_hash")).alias("unchanged"),
        _count_if(F.col("actual_hash") != F.col("file_hash")).alias("changed"),
        _count_if(F.col("actual_hash").isNull()).alias("missing"),
    )


def zone_totals(objects: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Objects and bytes per zone, or by other columns; the bytes themselves are not read."""
    return objects.groupBy(*(by or ["zone"])).agg(
        F.count(F.lit(1)).alias("n_objects"), F.sum("length").alias("n_bytes")
    )


def quality_gate(before: DataFrame, stats: DataFrame, threshold: float = 0.9) -> DataFrame:
    """Did the run process at least the given share of the records counted before?

    Both inputs have exactly one row: ``before`` with ``n``, ``stats`` with ``processed``.
    """
    return stats.select(
        before.select("n").scalar().alias("before_count"),
        "processed",
        (F.col("processed") >= before.select("n").scalar() * threshold).alias("passed"),
    )


def html_audit(before: DataFrame, after: DataFrame, key: str = "identifier") -> DataFrame:
    """Per page: boilerplate present before and after cleaning, and the size reduction.

    Both inputs are ``(key, html)``. The tags are looked for where the text is, so
    only flags and lengths are shuffled.
    """
    tags = ["nav", "header", "footer", "button"]

    def flags(df: DataFrame, prefix: str) -> DataFrame:
        return df.select(
            key,
            *[F.col("html").contains(f"<{t}").alias(f"{prefix}_{t}") for t in tags],
            F.length("html").alias(f"{prefix}_chars"),
        )

    joined = flags(before, "before").join(flags(after, "after"), key, "inner")
    reduction = (F.col("before_chars") - F.col("after_chars")) / F.col("before_chars") * 100
    return joined.withColumn(
        "removed_ok", ~(F.col("after_nav") | F.col("after_header") | F.col("after_footer"))
    ).withColumn("size_reduction", F.when(F.col("before_chars") > 0, reduction))


def html_audit_totals(audit: DataFrame) -> DataFrame:
    """Pages with each kind of boilerplate before and after, and the mean size reduction."""
    tags = ["nav", "header", "footer", "button"]
    return audit.agg(
        F.count(F.lit(1)).alias("pages"),
        *[_count_if(F.col(f"{s}_{t}")).alias(f"{s}_{t}") for t in tags for s in ("before", "after")],
        _count_if(F.col("removed_ok")).alias("removed_ok"),
        F.avg("size_reduction").alias("mean_reduction"),
    )

