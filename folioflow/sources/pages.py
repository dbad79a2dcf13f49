"""Captured web pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.functions.content import decode_ignore


def pages_scan(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Pages from a table, or from a folder of HTML files (``text`` or ``binaryFile``).

    Files are their own address; their ``page_id`` is a hash of it.
    """
    if fmt == "text":
        files = spark.read.text(path, wholetext=True).select(
            F.input_file_name().alias("url"), F.col("value").alias("html")
        )
    elif fmt == "binaryFile":
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        files = files.select(F.col("path").alias("url"), decode_ignore(F.col("content")).alias("html"))
    else:
        return spark.read.format(fmt).load(path)
    return files.select(F.xxhash64("url").alias("page_id"), "url", "html")
