"""Helpers that keep jobs distributed: input spread, checked broadcasts, scratch space, numbering."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

# A side is broadcast only if its measured text size stays below this.
BROADCAST_BYTES = 64 * 1024 * 1024


def tune(spark: SparkSession) -> SparkSession:
    """Session settings the jobs rely on; call once per session."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Documents are large rows: small Arrow batches bound the Python workers' memory.
        "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
        "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
        # Plans here have hundreds of expressions; do not record a call site for each.
        "spark.sql.dataFrameQueryContext.enabled": "false",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    return spark


def spread(df: DataFrame) -> DataFrame:
    """Give a table of less than one full split per core one partition per core.

    A larger table is returned as it is: its own splits already keep every core busy
    and moving the raw documents would only cost a shuffle. What is moved is bounded by
    cores times the size of a split, taken from the planner's statistics.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size < cores * split else df


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint if the rows' measured size is below the bound, else unchanged.

    Measuring is one aggregate over ``df``; pass narrow frames.
    """

    def octets(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType | T.BinaryType):
            return F.coalesce(F.octet_length(column), F.lit(0)) + 16
        if isinstance(field.dataType, T.AtomicType):
            return F.lit(16)
        return F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0)) + 16

    row = reduce(add, [octets(f) for f in df.schema.fields], F.lit(0))
    size = df.select(F.sum(row.cast("long"))).first()[0] or 0
    return F.broadcast(df) if size <= max_bytes else df


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="folioflow-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and continue from there, column by column as needed."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise in reliable storage, so a lost executor costs no recomputation."""
    scratch_root(df.sparkSession)
    return df.checkpoint(eager=True)


# -- numbering ---------------------------------------------------------------------


def row_hash(df: DataFrame) -> Column:
    """Hash of a whole row; it orders rows that tie alike in every run."""
    plain = [F.to_json(f.name) if "map<" in f.dataType.simpleString() else F.col(f"`{f.name}`") for f in df.schema.fields]
    return F.xxhash64(*plain)


def _counted(df: DataFrame, group: list[str], name: str) -> DataFrame:
    """Number the rows of each run of equal ``group`` values within a partition; adds the partition and the place, too."""
    added = [T.StructField(n, T.LongType()) for n in (name, f"{name}_part", f"{name}_at")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, last, n = TaskContext.get().partitionId(), 0, None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = np.stack([batch.column(batch.schema.get_field_index(g)).to_numpy() for g in group])
            begins = np.ones(batch.num_rows, dtype=bool)
            begins[1:] = (ids[:, 1:] != ids[:, :-1]).any(axis=0)
            begins[0] = last is None or bool((ids[:, 0] != last).any())
            place = np.arange(batch.num_rows)
            # A group that goes on from the batch before counts on.
            start = np.maximum.accumulate(np.where(begins, place, -n))
            number = place - start + 1
            last, n = ids[:, -1], int(number[-1])
            columns = [number, np.full(batch.num_rows, part), place + at]
            at += batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(c.astype(np.int64)) for c in columns]], names=[*batch.schema.names, *[f.name for f in added]]
            )

    return df.mapInArrow(run, T.StructType([*df.schema.fields, *added]))


def _carried(edges: DataFrame, own: str, other: str, order: Column, name: str) -> DataFrame:
    """For each partition, how many rows of its group ``own`` the partitions ahead in ``order`` hold as their ``other``."""
    ask = edges.select("_part", F.col(f"{own}.g1").alias("g1"), F.col(f"{own}.g2").alias("g2"), F.lit(0).cast("long").alias("n"), F.lit(0).alias("tells"))
    tell = edges.select("_part", f"{other}.g1", f"{other}.g2", f"{other}.n", F.lit(1).alias("tells"))
    ahead = W.partitionBy("g1", "g2").orderBy(order, "tells").rowsBetween(W.unboundedPreceding, -1)
    return ask.unionByName(tell).withColumn(name, F.coalesce(F.sum("n").over(ahead), F.lit(0))).where("tells = 0").drop("n", "tells")


def numbered(df: DataFrame, keys: list[str], order: str, number: str = "row_no", total: str | None = None) -> DataFrame:
    """Row number within ``keys`` by ``order``, and the group's size; a group may fill any number of tasks.

    The rows are sorted by keys and order over all tasks, in ranges; a large group simply spans several. Each task
    numbers its rows from both ends of their groups. Only the first group of a range can have begun, and only the last can
    go on in others: one count per range tells how far. Rows that tie on ``order`` stand by the hash of the whole row, so numbers are
    the same in every run and for every number of tasks; equal rows are interchangeable.
    """
    marked = df.withColumns(
        {"_g1": F.xxhash64(F.lit(1), *keys), "_g2": F.xxhash64(F.lit(2), *keys), "_tie": row_hash(df)}
    )
    by = [*keys, order, "_tie"]
    ranged = _counted(marked.repartitionByRange(*by).sortWithinPartitions(*by), ["_g1", "_g2"], "_no")
    back = ranged.sortWithinPartitions(*[F.desc(k) for k in keys], F.desc("_g1"), F.desc("_no"))
    stored = materialise(_counted(back, ["_g1", "_g2"], "_back"), "numbered")

    def group(n: str) -> Column:
        return F.struct(F.col("_g1").alias("g1"), F.col("_g2").alias("g2"), F.col(n).alias("n"))

    edges = stored.groupBy(F.col("_no_part").alias("_part")).agg(
        F.min_by(group("_back"), "_no_at").alias("first"), F.max_by(group("_no"), "_no_at").alias("last")
    )
    edges = materialise(edges, "range-edges")
    before = _carried(edges, "first", "last", F.col("_part"), "_before")
    after = _carried(edges, "last", "first", F.desc("_part"), "_after")
    # Two rows per range at most.
    shift = before.join(after, ["_part", "g1", "g2"], "full").select(
        F.col("_part").alias("_range"), F.col("g1").alias("_s1"), F.col("g2").alias("_s2"), "_before", "_after"
    )
    same = (F.col("_no_part") == F.col("_range")) & (F.col("_g1") == F.col("_s1")) & (F.col("_g2") == F.col("_s2"))
    out = stored.join(broadcast_if_small(shift), same, "left")
    zero = F.lit(0).cast("long")
    ahead, behind = F.coalesce("_before", zero), F.coalesce("_after", zero)
    columns = [(F.col("_no") + ahead).alias(number)]
    if total:
        columns.append((F.col("_no") + F.col("_back") - 1 + ahead + behind).alias(total))
    return out.select(*[F.col(f"`{c}`") for c in df.columns if c not in (number, total)], *columns)
