"""Table schemas shared by all jobs."""

from __future__ import annotations

from pyspark.sql import types as T

# The field names of METADATA and RECORDS are the data contract.
METADATA = T.StructType(
    [
        T.StructField("page", T.IntegerType()),
        T.StructField("position", T.IntegerType()),
        T.StructField("parent_id", T.StringType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("file_index", T.IntegerType()),
        T.StructField("total_files", T.IntegerType()),
        T.StructField("role", T.StringType()),
        T.StructField("children", T.ArrayType(T.StringType())),
        T.StructField("total_children", T.IntegerType()),
        T.StructField("parent", T.StringType()),
    ]
)

# One row per collected document; `partition_date` is ISO text and compared as text.
RECORDS = T.StructType(
    [
        T.StructField("identifier", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("published_date", T.StringType()),
        T.StructField("body_type", T.StringType()),
        T.StructField("source_url", T.StringType()),
        T.StructField("doc_link", T.StringType()),
        T.StructField("partition_date", T.StringType()),
        T.StructField("file_path", T.StringType()),
        T.StructField("file_hash", T.StringType()),
        T.StructField("mime_type", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("updated_at", T.TimestampNTZType()),
        T.StructField("notes", T.StringType()),
        T.StructField("original_filename", T.StringType()),
        T.StructField("metadata", METADATA),
    ]
)

PROCESSED_RECORDS = T.StructType(
    RECORDS.fields + [T.StructField("transformation_date", T.TimestampNTZType())]
)

# Document bytes live apart from the records, so audits never read them.
OBJECTS = T.StructType(
    [
        T.StructField("zone", T.StringType()),
        T.StructField("object_name", T.StringType()),
        T.StructField("content", T.BinaryType()),
        T.StructField("content_type", T.StringType()),
        T.StructField("length", T.LongType()),
    ]
)

# Captured web pages, standing in for live responses.
PAGES = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
    ]
)

LANDING_ZONE = "landing-zone"
PROCESSED_ZONE = "processed"

# Issuing bodies collected by default and their codes on the search site.
DEFAULT_BODIES = ["WRC", "LC", "EAT", "ET"]
BODY_CODES = {"ET": "1", "EAT": "2", "LC": "3", "WRC": "15376"}
