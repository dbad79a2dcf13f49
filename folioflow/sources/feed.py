"""Item feeds as JSON Lines, CSV or XML."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def feed_export(rows: DataFrame, path: str, fmt: str = "json") -> bool:
    """Write the items; an empty feed writes nothing. Returns whether anything was written.

    CSV has no nested values, so structs, arrays and maps become JSON text there.
    """
    if rows.isEmpty():
        return False
    writer_options = {
        "json": {"ignoreNullFields": "true"},
        "csv": {"header": "true", "escape": '"'},
        "xml": {"rowTag": "item", "rootTag": "items"},
    }
    if fmt not in writer_options:
        raise ValueError("a feed is written as json, csv or xml")
    if fmt == "csv":
        nested = (T.StructType, T.ArrayType, T.MapType)
        rows = rows.select(
            *[
                F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
                for f in rows.schema.fields
            ]
        )
    rows.write.format(fmt).options(**writer_options[fmt]).mode("errorifexists").save(path)
    return True
