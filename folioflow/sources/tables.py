"""Record tables: Parquet partitioned by ``partition_date``."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow.functions.times import as_of_literal
from folioflow.scale import broadcast_if_small, materialise
from folioflow.schema import RECORDS


def records_scan(
    spark: SparkSession, path: str, schema: T.StructType = RECORDS, fmt: str = "parquet"
) -> DataFrame:
    """Read a record table. The schema is given, so partition values stay text."""
    return spark.read.schema(schema).format(fmt).load(path)


def records_append(records: DataFrame, path: str) -> None:
    """Append records; an empty frame writes nothing.

    Rows are gathered by partition so that each gets few files; the rebalance hint
    lets a large partition fill several tasks.
    """
    if records.isEmpty():
        return
    (
        records.hint("rebalance", "partition_date")
        .write.mode("append")
        .partitionBy("partition_date")
        .parquet(path)
    )


def _with_identity(records: DataFrame) -> DataFrame:
    """Records with the file and the place in it that each row was read from; frames that are no files become some."""
    identity = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")]
    try:
        return records.select("*", *identity)
    except AnalysisException:
        return materialise(records, "records").select("*", *identity)


def _chosen(own: DataFrame, updates: DataFrame, order_cols: list[str], *carried: str) -> DataFrame:
    """(file, row) of the first record of each updated identifier, with its new values: one pass over the keys."""
    fields = [c for c in updates.columns if c != "identifier"]
    changes = updates.select(F.col("identifier").alias("_id"), *[F.col(c).alias(f"_new_{c}") for c in fields])
    keyed = own.select("identifier", *dict.fromkeys([*order_cols, *carried]), "_file", "_row")
    met = keyed.join(broadcast_if_small(changes), F.col("identifier") == F.col("_id"))
    first = F.struct(*dict.fromkeys([*order_cols, "_file", "_row", *carried]))
    best = met.groupBy("identifier").agg(F.min(first).alias("_first"), F.first(F.struct("_id", *[f"_new_{c}" for c in fields])).alias("_new"))
    names = [F.col("_first._file").alias("_its_file"), F.col("_first._row").alias("_its_row"), F.col("_new.*")]
    return best.select(*names, *[F.col(f"_first.{c}").alias(f"_its_{c}") for c in carried])


def _changed(own: DataFrame, chosen: DataFrame, updates: DataFrame, as_of) -> DataFrame:
    fields = [c for c in updates.columns if c != "identifier"]
    here = (F.col("_file") == F.col("_its_file")) & (F.col("_row") == F.col("_its_row"))
    joined = own.join(broadcast_if_small(chosen), here, "left").withColumn("was_updated", F.col("_its_row").isNotNull())
    values = {c: F.coalesce(F.col(f"_new_{c}"), F.col(c)) for c in fields}
    values["updated_at"] = F.when(F.col("was_updated"), as_of_literal(as_of)).otherwise(F.col("updated_at"))
    kept = [c for c in own.columns if c not in ("_file", "_row")]
    return joined.select(*[values[c].alias(c) if c in values else F.col(c) for c in kept], "was_updated")


_FIRST = ["created_at", "partition_date", "file_path"]


def records_update(
    records: DataFrame, updates: DataFrame, as_of, order_cols: list[str] | None = None
) -> DataFrame:
    """Set fields on the first record of each updated identifier.

    ``updates`` has one row per identifier and the fields to set; NULL leaves a field
    alone. The result is all records plus ``was_updated``. The record is chosen by its keys alone and met again by its place in its file, so
    records of a much-repeated identifier do not gather anywhere.
    """
    own = _with_identity(records)
    return _changed(own, _chosen(own, updates, order_cols or _FIRST), updates, as_of)


def records_update_table(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    as_of,
    schema: T.StructType = RECORDS,
    order_cols: list[str] | None = None,
) -> DataFrame:
    """Apply updates to a stored table, rewriting only the partitions they touch.

    The new rows are written to scratch space first, so the table is never read and
    replaced by one plan and a repeated attempt finds its input intact. Returns the
    identifiers that were updated.
    """
    own = _with_identity(records_scan(spark, path, schema))
    chosen = materialise(_chosen(own, updates, order_cols or _FIRST, "partition_date"), "chosen")
    # One row per partition directory; the join prunes the others.
    touched = broadcast_if_small(chosen.select(F.col("_its_partition_date").alias("_touched")).distinct())
    affected = own.join(touched, F.col("partition_date") == F.col("_touched"), "left_semi")
    rewritten = materialise(_changed(affected, chosen.drop("_its_partition_date"), updates, as_of), "update")
    (
        rewritten.drop("was_updated")
        .hint("rebalance", "partition_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("partition_date")
        .parquet(path)
    )
    return rewritten.where("was_updated").select("identifier")
