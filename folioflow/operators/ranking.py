"""Positions within groups: files of a parent, results of a listing, member lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.scale import numbered

# Members per row of a group's member list.
MEMBERS_PER_ROW = 1000


def file_index(records: DataFrame, parent: str = "parent_id", order: str = "file_seq") -> DataFrame:
    """Add each file's zero-based ``file_index`` and its parent's ``total_files``."""
    out = numbered(records, [parent], order, "_no", "total_files")
    return out.withColumn("file_index", F.col("_no") - 1).drop("_no")


def page_position(
    items: DataFrame,
    listing: str = "body",
    order: str = "item_seq",
    page_size: int = 10,
) -> DataFrame:
    """Add the one-based ``page_no`` and ``position`` of each item and its listing's ``last_page``."""
    out = numbered(items, [listing], order, "_no", "_total")
    return out.withColumns(
        {
            "page_no": F.floor((F.col("_no") - 1) / page_size) + 1,
            "position": F.pmod(F.col("_no") - 1, F.lit(page_size)) + 1,
            "last_page": F.ceil(F.col("_total") / page_size),
        }
    ).drop("_no", "_total")


def group_members(
    records: DataFrame,
    parent: str = "parent_id",
    member: str = "identifier",
    per_row: int = MEMBERS_PER_ROW,
) -> DataFrame:
    """Sorted members of each parent, in rows of at most ``per_row`` members.

    ``part_no`` numbers a parent's rows from zero; read in that order they are the
    whole list, however long it is.
    """
    listed = numbered(records.select(parent, member), [parent], member, "_no", "n_members")
    return (
        listed.withColumn("part_no", F.floor((F.col("_no") - 1) / per_row))
        .groupBy(parent, "part_no")
        .agg(
            F.max("n_members").alias("n_members"),
            F.array_sort(F.collect_list(member)).alias("members"),
        )
    )
