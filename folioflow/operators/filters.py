"""Row selection: date ranges, lookups, required fields, bodies, nested fields, MIME types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.schema import DEFAULT_BODIES


def records_by_range(
    records: DataFrame, start: str, end: str, status: str | None = None
) -> DataFrame:
    """Records with ``start <= partition_date <= end`` as text, optionally of one status.

    The table is partitioned by that column, so the range prunes directories.
    """
    chosen = records.where(F.col("partition_date").between(start, end))
    return chosen.where(F.col("status") == status) if status else chosen


def record_lookup(records: DataFrame, identifier: str) -> DataFrame:
    """The record of that identifier, or no row; of repeated ones the first by date, creation and link."""
    order = [c for c in ("partition_date", "created_at", "body_type", "source_url", "doc_link") if c in records.columns]
    found = records.where(F.col("identifier") == identifier)
    return (found.orderBy(*order) if order else found).limit(1)


def required_fields(df: DataFrame, cols: list[str]) -> DataFrame:
    """Add ``reject_reason``: the names of missing or empty required columns, else NULL."""
    missing = F.array_compact(
        F.array(*[F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) == "", c) for c in cols])
    )
    return df.withColumn(
        "reject_reason",
        F.when(F.size(missing) > 0, F.concat(F.lit("missing: "), F.array_join(missing, ","))),
    )


def accepted(df: DataFrame) -> DataFrame:
    return df.where(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected(df: DataFrame) -> DataFrame:
    return df.where(F.col("reject_reason").isNotNull())


def object_exists(keys: DataFrame, listing: DataFrame, key: str = "object_name", zone: str = "zone") -> DataFrame:
    """Add ``found``: is there an object of that zone and name in the listing?

    A name that another zone holds is not found; a missing zone or name is not either.
    """
    names = listing.select(F.col("zone").alias("_zone"), F.col("object_name").alias("_name")).distinct()
    return (
        keys.join(names, (F.col(zone) == F.col("_zone")) & (F.col(key) == F.col("_name")), "left")
        .withColumn("found", F.col("_name").isNotNull())
        .drop("_zone", "_name")
    )


def body_filter(
    df: DataFrame, bodies: str | list[str] | None = None, body: str = "body_type"
) -> DataFrame:
    """Rows of the requested bodies; all default bodies if none are named."""
    bodies = DEFAULT_BODIES if bodies is None else [bodies] if isinstance(bodies, str) else bodies
    return df.where(F.col(body).isin(bodies))


def nested_filter(df: DataFrame, path: str, value) -> DataFrame:
    """Rows whose nested field ``path`` (dotted) equals ``value``."""
    return df.where(F.col(path) == value)


def mime_filter(df: DataFrame, mime: str) -> DataFrame:
    """Rows of exactly that MIME type."""
    return df.where(F.col("mime_type") == mime)


def sample_limit(df: DataFrame, n: int, order: str = "identifier") -> DataFrame:
    """The first ``n`` rows by ``order``."""
    return df.orderBy(order).limit(n)


def matches(cond: Column | str) -> Column:
    return F.expr(cond) if isinstance(cond, str) else cond
