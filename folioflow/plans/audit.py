"""The audit job: completeness and integrity of both zones."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.functions.content import content_hash, object_path
from folioflow.operators.aggregates import zone_totals
from folioflow.operators.records import before_after, parent_child
from folioflow.scale import materialise

#: Share of the extracted records that must have been processed.
QUALITY = 0.9
_TAGS = ("nav", "header", "footer")


def object_facts(objects: DataFrame) -> DataFrame:
    """(path, hash, length, boilerplate) of every object, computed where its bytes are."""
    text = F.col("content").cast("string")
    return objects.select(
        object_path(F.col("zone"), F.col("object_name")).alias("path"),
        content_hash(F.col("content")).alias("hash"),
        F.octet_length("content").cast("long").alias("length"),
        reduce(Column.__or__, [text.contains(f"<{t}") for t in _TAGS]).alias("boilerplate"),
    )


def looked_up(df: DataFrame, facts: DataFrame, path: str, prefix: str) -> DataFrame:
    """Compared records with the hash and length of the object at a path, NULL without one."""
    own = facts.select(F.col("path").alias(f"{prefix}_path"), *[F.col(c).alias(f"{prefix}_{c}") for c in ("hash", "length")])
    # Most records have no path: a key of their own spreads them over all tasks.
    key = F.coalesce(path, F.concat(F.lit("\0"), F.xxhash64("identifier", "old_hash").cast("string")))
    return df.join(own, (key == F.col(f"{prefix}_path")) & F.col(path).isNotNull(), "left")


def _report(df: DataFrame, checks: dict[str, tuple[Column, Column]], least: dict[str, float]) -> DataFrame:
    """All checks (rows looked at, rows that fail) over one aggregate, one row each."""

    def counted(cond: Column) -> Column:
        return F.count_if(F.coalesce(cond, F.lit(False)))

    counters = [
        c
        for k, (looked, failed) in enumerate(checks.values())
        for c in (counted(looked).alias(f"n{k}"), counted(looked & failed).alias(f"f{k}"))
    ]
    rows = ", ".join(f"'{name}', n{k}, f{k}, {least.get(name, 1.0)}D" for k, name in enumerate(checks))
    stacked = df.agg(*counters).selectExpr(f"stack({len(checks)}, {rows}) AS (check_name, n_checked, n_failed, least)")
    enough = F.col("n_checked") - F.col("n_failed") >= F.col("n_checked") * F.col("least")
    return stacked.select("check_name", "n_checked", "n_failed", enough.alias("passed"))


def audit_job(records: DataFrame, processed: DataFrame, objects: DataFrame, quality: float = QUALITY) -> DataFrame:
    """One row per check: how many rows it looked at, how many failed, and whether it passed.

    Each input is read once, for a narrow table of what the checks need; the documents are hashed and looked through where they are.
    A check passes if nothing fails, the quality gate if at least its share of the extracted records was processed.
    """
    source = materialise(records.select("identifier", "mime_type", "file_path", "file_hash", "status", "metadata"), "audited-records")
    done = materialise(
        processed.select("identifier", "mime_type", "file_path", "file_hash", "status", "transformation_date"), "audited-processed"
    )
    facts = materialise(object_facts(objects), "object-facts")

    compared = looked_up(looked_up(before_after(source, done), facts, "old_path", "before"), facts, "new_path", "after")
    html = F.lower("mime_type").startswith("text/html")
    found, extracted = F.col("processed"), F.col("old_status") == "extracted"
    both = F.col("before_length").isNotNull() & F.col("after_length").isNotNull()
    of_records = {
        "processed": (F.lit(True), ~found),
        "quality_gate": (extracted, ~found),
        "html_changed": (found & html, ~F.col("hash_changed")),
        "zone_moved": (found, ~F.col("zone_ok")),
        "status_set": (found, ~F.col("status_ok")),
        "landing_hash": (F.col("before_hash").isNotNull(), F.col("before_hash") != F.col("old_hash")),
        "html_shrunk": (found & html & both, F.col("after_length") >= F.col("before_length")),
    }
    stored = done.join(facts.withColumnRenamed("hash", "actual"), F.col("file_path") == F.col("path"), "left")
    of_processed = {
        "object_present": (F.lit(True), F.col("path").isNull()),
        "processed_hash": (F.col("path").isNotNull(), F.col("actual") != F.col("file_hash")),
        "html_clean": (html & F.col("path").isNotNull(), F.col("boilerplate")),
    }
    family = {"children_complete": (F.lit(True), ~F.col("complete"))}
    parts = [_report(compared, of_records, {"quality_gate": quality}), _report(stored, of_processed, {}), _report(parent_child(source), family, {})]
    return reduce(DataFrame.unionByName, parts)


def zone_report(objects: DataFrame) -> DataFrame:
    """Objects and bytes per zone and type."""
    return zone_totals(objects, ["zone", "content_type"])
