"""Document objects: files or a content table ``(zone, object_name, content, content_type, length)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from folioflow.scale import broadcast_if_small
from folioflow.schema import OBJECTS
from folioflow.sources.object_files import ObjectFiles


def objects_scan(spark: SparkSession, path: str, zone: str) -> DataFrame:
    """Files below a folder as objects of a zone, named by their path within the folder.

    Spark's reader leaves out files without a byte.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    )
    # File paths are URIs ("file:/a" or "s3://b/a"); the folder may be given either way.
    folder = F.regexp_replace(F.lit(path.rstrip("/")), r"^[A-Za-z][A-Za-z0-9+.\-]*:/*", "/")
    plain = F.regexp_replace("path", r"^[A-Za-z][A-Za-z0-9+.\-]*:/*", "/")
    return files.select(
        F.lit(zone).alias("zone"),
        F.substring(plain, F.length(folder) + 2, F.length(plain)).alias("object_name"),
        "content",
        F.lit(None).cast("string").alias("content_type"),
        "length",
    )


def objects_table(spark: SparkSession, path: str) -> DataFrame:
    """Read a content table."""
    return spark.read.schema(OBJECTS).parquet(path).select(*OBJECTS.names)


def objects_export(objects: DataFrame, path: str) -> None:
    """Write every object as a file, named by its object name below the folder; a file of that name is replaced.

    Of several objects of one name the one with the smallest hash is written.
    """
    one = W.partitionBy("object_name").orderBy(F.xxhash64("content"))
    rows = objects.select("object_name", "content").withColumn("_rank", F.row_number().over(one)).where("_rank = 1")
    objects.sparkSession.dataSource.register(ObjectFiles)
    rows.drop("_rank").write.format(ObjectFiles.name()).mode("append").option("path", path).save()


def objects_append(objects: DataFrame, path: str) -> None:
    """Add objects to a content table, one directory per zone."""
    if not objects.isEmpty():
        objects.write.mode("append").partitionBy("zone").parquet(path)


def objects_upsert(
    existing: DataFrame, incoming: DataFrame, newest_first: list
) -> DataFrame:
    """Existing objects with the incoming ones put in their place or added.

    Of several incoming objects of one name the first by ``newest_first`` is kept. Existing documents are filtered by
    name only; they stay in their partitions as long as the incoming names are few.
    """
    key = ["zone", "object_name"]
    columns = existing.columns
    newest = W.partitionBy(*key).orderBy(*newest_first)
    incoming = incoming.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1")
    kept = existing.join(broadcast_if_small(incoming.select(*key)), key, "left_anti")
    return kept.select(*columns).unionByName(incoming.select(*columns))


def zone_listing(objects: DataFrame, zone: str | None = None) -> DataFrame:
    """Names, types and sizes of a zone's objects; the content column is not read."""
    chosen = objects.where(F.col("zone") == zone) if zone else objects
    return chosen.select("zone", "object_name", "content_type", "length")
