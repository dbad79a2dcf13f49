"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Asks a column maker for the values of one Arrow batch, given the input columns as Python lists.
Step = Callable[..., list[pa.Array]]


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names like the wanted ones that no column of ``df`` has, whatever the case."""
    taken = {c.lower() for c in df.columns}
    names = []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        names.append(name)
    return names


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` less the columns that an operator is about to add; its own results replace them."""
    drop = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in drop])


def release_memory() -> None:
    """Give freed memory back to the system: workers stay alive, idle, next to those of later stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library: it keeps its own counsel


def map_columns(
    df: DataFrame, inputs: list[str], schema: str, start: Callable[[], Step], drop: tuple[str, ...] = ()
) -> DataFrame:
    """Add columns computed per Arrow batch; a map without a shuffle.

    ``start`` runs once per task and returns the step; the step gets the input columns
    of a batch as lists and returns one Arrow array per column of ``schema``. Columns of
    ``df`` that ``schema`` names too are replaced, those named by ``drop`` left out.
    """
    added = T._parse_datatype_string(schema).fields
    new = {f.name.lower() for f in added} | {c.lower() for c in drop}
    kept = [f for f in df.schema.fields if f.name.lower() not in new]
    keep = [f.name for f in kept]
    names = [f.name for f in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = start()
        for batch in batches:
            if not batch.num_rows:
                continue
            arrays = step(*[batch.column(batch.schema.get_field_index(c)).to_pylist() for c in inputs])
            old = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays([*old, *arrays], names=[*keep, *names])
        del step
        release_memory()

    return df.mapInArrow(run, T.StructType([*kept, *added]))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else; texts of ASCII alone take the short way."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def sha256_hex(text: Column) -> Column:
    """Lowercase hex digest of a string's UTF-8 bytes."""
    return F.sha2(text, 256)
