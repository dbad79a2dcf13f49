"""Stored tables that grow run by run: objects, identifiers and whole collections.

A run writes its rows into folders of its own and is committed by one marker; readers see committed
runs only, so a run that fails half-way leaves nothing visible. The tables are registered with Spark and bucketed by their
key: what joins them by that key is shuffled to the buckets, the stored rows stay in place.

Of several objects of one name the one of the newest run counts. A narrow table of names and runs says
which that is, so storing k objects writes k rows and rewrites none; ``ObjectStore.compact`` drops what no longer counts.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from folioflow.schema import LANDING_ZONE, OBJECTS, RECORDS

#: Buckets of a new store; ``compact`` chooses again by size.
BUCKETS = 64
#: Stored bytes that a bucket should hold.
BUCKET_BYTES = 256 << 20


def _folder(spark: SparkSession, path: str):
    """The file system and the Hadoop path of a folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    system, folder = _folder(spark, path)
    return system.exists(folder)


def _matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths below a folder that match a pattern; none if the folder is not there."""
    system, folder = _folder(spark, pattern)
    return [status.getPath().toString() for status in system.globStatus(folder) or []]


class RunLog:
    """The committed runs of a store, oldest first. One writer at a time; readers may be many."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def committed(self) -> list[str]:
        """Names of the runs whose marker is complete."""
        return sorted(p.split("/run=")[-1].split("/")[0] for p in _matching(self.spark, f"{self.path}/run=*/_SUCCESS"))

    def begin(self) -> str:
        """A name behind all committed ones; a second attempt gets a name of its own."""
        done = self.committed()
        number = int(done[-1].split("-")[0]) + 1 if done else 1
        return f"{number:010d}-{uuid.uuid4().hex[:12]}"

    def commit(self, run: str, counts: dict[str, int] | None = None) -> None:
        """Make a run visible: its marker, a small file with its counts, appears last and at once."""
        entry = {"run": run} | {k: int(v) for k, v in (counts or {}).items()}
        schema = ", ".join(f"`{k}` {'string' if k == 'run' else 'bigint'}" for k in entry)
        self.spark.createDataFrame([tuple(entry.values())], schema).coalesce(1).write.json(f"{self.path}/run={run}")

    def counts(self) -> DataFrame:
        """What the committed runs counted, one row per run."""
        paths = [f"{self.path}/run={run}" for run in self.committed()]
        if not paths:
            return self.spark.createDataFrame([], "run string")
        return self.spark.read.option("basePath", self.path).json(paths)


class RunTable:
    """A registered table with a folder per run, bucketed by one column."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, by: str, buckets: int):
        self.spark, self.schema, self.buckets = spark, schema, buckets
        self.name = f"runs_{hashlib.sha256(f'{path} {by} {buckets}'.encode()).hexdigest()[:24]}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        place = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}, run STRING) USING parquet "
            f"PARTITIONED BY (run) CLUSTERED BY ({by}) INTO {buckets} BUCKETS LOCATION '{place}'"
        )

    def append(self, rows: DataFrame, run: str) -> None:
        rows.select(*self.schema.names, F.lit(run).alias("run")).write.mode("append").insertInto(self.name)

    def read(self, runs: list[str]) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name).where(F.col("run").isin(runs) if runs else F.lit(False))


_NAMES = T.StructType([f for f in OBJECTS.fields if f.name != "content"])


class ObjectStore:
    """The objects of one zone. Usable wherever the library takes a table of objects."""

    def __init__(self, spark: SparkSession, path: str, zone: str = LANDING_ZONE, buckets: int = BUCKETS, log: RunLog | None = None):
        self.spark, self.path, self.zone = spark, path.rstrip("/"), zone
        self.log = log or RunLog(spark, f"{self.path}/runs")
        self._first = buckets
        self._open(self.log.committed())

    def _open(self, committed: list[str]) -> None:
        """The tables of the newest layout whose run is committed; without one, those of the first."""
        layouts = [p.rsplit("/layout=", 1)[-1] for p in _matching(self.spark, f"{self.path}/layout=*")]
        ready = sorted(x for x in layouts if x.split("_")[0] in committed)
        first = [x for x in layouts if x.startswith("first_")]
        layout = ready[-1] if ready else first[0] if first else f"first_{self._first}"
        self._use(layout)

    def _use(self, layout: str) -> None:
        self.base, self.buckets = layout.split("_")[0], int(layout.split("_")[1])
        root = f"{self.path}/layout={layout}"
        self.content = RunTable(self.spark, f"{root}/content", OBJECTS, "object_name", self.buckets)
        self.names = RunTable(self.spark, f"{root}/names", _NAMES, "object_name", self.buckets)

    def _runs(self) -> list[str]:
        """The committed runs of the newest layout, from its first one on."""
        committed = self.log.committed()
        self._open(committed)
        return [r for r in committed if self.base == "first" or r >= self.base]

    def append(self, objects: DataFrame, run: str | None = None) -> str:
        """Store objects; of several of one name the one with the smallest hash. Without ``run`` it is committed at once.

        The names are written after the documents: a run that stops in between is no run.
        """
        own = run or self.log.begin()
        self._runs()
        one = W.partitionBy("object_name").orderBy(F.xxhash64("content"), "content_type")
        rows = objects.select(*OBJECTS.names).withColumn("_rank", F.row_number().over(one)).where("_rank = 1")
        self.content.append(rows.withColumn("zone", F.lit(self.zone)), own)
        self.names.append(self.content.read([own]).select(*_NAMES.names), own)
        if run is None:
            self.log.commit(own)
        return own

    def newest(self) -> DataFrame:
        """(object_name, content_type, length, run) of the objects that count; no document is read or moved."""
        rows = self.names.read(self._runs())
        last = rows.groupBy("object_name").agg(F.max(F.struct("run", "content_type", "length")).alias("last"))
        return last.select("object_name", "last.content_type", "last.length", "last.run")

    def listing(self) -> DataFrame:
        """(zone, object_name, content_type, length) of the objects that count."""
        return self.newest().select(F.lit(self.zone).alias("zone"), "object_name", "content_type", "length")

    def with_content(self, rows: DataFrame) -> DataFrame:
        """Rows (object_name, run, ...) with the ``content`` of that run; names without an object there go.

        Only ``rows`` are shuffled, to the buckets, where they are hashed and the documents pass by.
        """
        documents = self.content.read(self._runs()).select(
            F.col("object_name").alias("_name"), F.col("run").alias("_run"), "content"
        )
        # Not written as an equation: a second join key would ask for another bucketing.
        same_run = (F.col("run") <= F.col("_run")) & (F.col("run") >= F.col("_run"))
        joined = documents.join(rows.hint("shuffle_hash"), (F.col("object_name") == F.col("_name")) & same_run)
        return joined.select(*rows.columns, "content")

    def objects(self) -> DataFrame:
        """The objects that count, with their documents."""
        return self.with_content(self.newest()).select(
            F.lit(self.zone).alias("zone"), "object_name", "content", "content_type", "length"
        )

    def compact(self, buckets: int | None = None) -> str:
        """Write the objects that count into a new layout and switch to it; the old one stays for running readers.

        The number of buckets follows the stored bytes if it is not given.
        """
        size = self.newest().agg(F.sum("length")).first()[0] or 0
        buckets = buckets or max(1, -(-size // BUCKET_BYTES))
        run, kept = self.log.begin(), self.objects()
        self._use(f"{run}_{buckets}")
        self.content.append(kept, run)
        self.names.append(self.content.read([run]).select(*_NAMES.names), run)
        self.log.commit(run)
        return run


_KEYS = T.StructType([T.StructField("identifier", T.StringType()), T.StructField("status", T.StringType())])


class KeyTable:
    """Identifiers of stored records with their status, appended per run and bucketed by identifier."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS, log: RunLog | None = None):
        self.log = log or RunLog(spark, f"{path.rstrip('/')}/runs")
        self.table = RunTable(spark, f"{path.rstrip('/')}/keys", _KEYS, "identifier", buckets)

    def append(self, records: DataFrame, run: str | None = None) -> str:
        own = run or self.log.begin()
        self.table.append(records, own)
        if run is None:
            self.log.commit(own)
        return own

    def keys(self) -> DataFrame:
        """(identifier, status) of all committed runs."""
        return self.table.read(self.log.committed()).select(*_KEYS.names)


class Collection:
    """Records, their objects, identifiers and feeds, published together: one marker commits a run of all."""

    def __init__(
        self, spark: SparkSession, path: str, zone: str = LANDING_ZONE, schema: T.StructType = RECORDS, buckets: int = BUCKETS
    ):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.log = RunLog(spark, f"{self.path}/runs")
        self.objects = ObjectStore(spark, f"{self.path}/objects", zone, buckets, self.log)
        self.known = KeyTable(spark, f"{self.path}/identifiers", buckets, self.log)

    def append_records(self, records: DataFrame, run: str) -> None:
        """Write a run's records by partition date; columns that the schema lacks go."""
        empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema.fields if f.name not in records.columns]
        rows = records.select("*", *empty).select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields])
        rows.hint("rebalance", "partition_date").write.partitionBy("partition_date").parquet(f"{self.path}/records/run={run}")

    def append_feed(self, feed: DataFrame, run: str) -> None:
        feed.write.option("ignoreNullFields", "true").json(f"{self.path}/feed/run={run}")

    def _read(self, part: str, schema: T.StructType, fmt: str) -> DataFrame:
        paths = [f"{self.path}/{part}/run={run}" for run in self.log.committed()]
        paths = [p for p in paths if exists(self.spark, p)]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/{part}").format(fmt).load(paths)

    def records(self) -> DataFrame:
        """The records of all committed runs, pruned by partition date."""
        return self._read("records", self.schema, "parquet").select(*self.schema.names)

    def feed(self, schema: T.StructType) -> DataFrame:
        return self._read("feed", schema, "json").select(*schema.names)
