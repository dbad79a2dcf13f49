"""Stored tables that grow run by run: what is visible, what is written, what is moved."""

import os
import subprocess
import sys
import textwrap
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from folioflow.operators import records
from folioflow.plans import ingest
from folioflow.plans.transform import transform_job
from folioflow.scale import scratch_path
from folioflow.schema import LANDING_ZONE, OBJECTS
from folioflow.sources import object_files, objects
from folioflow.sources.store import Collection, KeyTable, ObjectStore
from tests.test_records import content, rec, record_rows
from workload import fixtures as fx

AS_OF = datetime(2024, 7, 1, 12)
SF = "/root/testdata/sf0.001"


def stored(store):
    return sorted((r.object_name, bytes(r.content)) for r in store.objects().collect())


def files(path):
    found = [os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith((".parquet", ".json"))]
    return {f: os.path.getmtime(f) for f in found}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def moved(plan, column):
    """Exchanges of a plan that something with this column in its output goes through."""
    lines = plan.split("\n")
    depth = [len(x) - len(x.lstrip(" :+-")) for x in lines]
    found = []
    for i, line in enumerate(lines):
        if "Exchange" in line:
            below = []
            for j in range(i + 1, len(lines)):
                if depth[j] <= depth[i]:
                    break
                below.append(lines[j])
            if any("Scan" in x and column in x.split("ReadSchema")[-1] for x in below):
                found.append(line)
    return found


@pytest.fixture
def unbroadcast(spark, monkeypatch):
    """As if no side were small enough to broadcast."""
    monkeypatch.setattr(records, "broadcast_if_small", lambda df: df)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_the_newest_run_of_a_name_counts(spark):
    path = scratch_path(spark, "store")
    store = ObjectStore(spark, path, buckets=3)
    assert stored(store) == [] and store.listing().count() == 0
    store.append(content(spark, ("a", b"1"), ("b", b"2"), ("c", b"3")))
    store.append(content(spark, ("b", b"22"), ("d", b"4"), ("d", b"4")))
    assert stored(store) == [("a", b"1"), ("b", b"22"), ("c", b"3"), ("d", b"4")]
    assert sorted((r.object_name, r.length) for r in store.listing().collect()) == [("a", 1), ("b", 2), ("c", 1), ("d", 1)]
    # Another session would find the same.
    assert stored(ObjectStore(spark, path)) == stored(store)


def test_storing_objects_writes_them_and_nothing_else(spark):
    path = scratch_path(spark, "store")
    store = ObjectStore(spark, path, buckets=2)
    store.append(content(spark, *[(f"n{i}", b"x" * 1000) for i in range(400)]))
    before = files(path)
    run = store.append(content(spark, ("n7", b"y"), ("new", b"z")))
    after = files(path)
    assert all(after[f] == t for f, t in before.items())
    new = [f for f in after if f not in before]
    assert all(f"run={run}" in f for f in new) and sum(map(os.path.getsize, new)) < 20_000
    assert dict(stored(store))["n7"] == b"y" and store.objects().count() == 401


@pytest.mark.parametrize("step", ["names", "log"])
def test_a_run_that_stops_half_way_is_not_seen(spark, monkeypatch, step):
    path = scratch_path(spark, "store")
    store = ObjectStore(spark, path, buckets=2)
    store.append(content(spark, ("a", b"1")))

    def broken(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        if step == "log":
            m.setattr(type(store.log), "commit", broken)
        else:
            append = type(store.names).append
            m.setattr(type(store.names), "append", lambda self, rows, run: broken() if self.schema != OBJECTS else append(self, rows, run))
        with pytest.raises(RuntimeError):
            store.append(content(spark, ("a", b"2"), ("b", b"2")))
        with pytest.raises(RuntimeError):
            store.compact()
    assert stored(ObjectStore(spark, path)) == [("a", b"1")]
    store.append(content(spark, ("b", b"3")))
    assert stored(store) == [("a", b"1"), ("b", b"3")]


def test_compaction_keeps_what_counts(spark):
    path = scratch_path(spark, "store")
    store = ObjectStore(spark, path, buckets=2)
    for k in range(3):
        store.append(content(spark, ("a", b"%d" % k), (f"b{k}", b"x")))
    want = stored(store)
    old = store.objects()
    store.compact(5)
    assert store.buckets == 5 and stored(store) == want and store.content.read(store._runs()).count() == 4
    assert old.count() == 4  # who read the old layout can go on
    store.append(content(spark, ("a", b"last")))
    assert dict(stored(ObjectStore(spark, path)))["a"] == b"last" and store.objects().count() == 4


def test_documents_stay_in_their_buckets(spark, unbroadcast):
    store = ObjectStore(spark, scratch_path(spark, "store"), buckets=4)
    landing = fx.landing_objects(spark, SF)
    store.append(landing)
    store.append(landing.limit(7))
    r = fx.landing_records(spark, SF)
    joined = records.records_with_content(r.where("file_path IS NOT NULL"), store)
    plan = plan_of(joined)
    assert "content:binary" in plan and moved(plan, "content:binary") == [] and "Bucketed: true" in plan
    assert joined.where("failure IS NULL").count() == r.where("file_path NOT LIKE '%/missing-%'").count()
    job = transform_job(r, store, "2024-01-01", "2024-12-31", AS_OF)
    assert moved(plan_of(job), "content:binary") == []
    # The same over a plain table moves them, so the test would see it.
    assert moved(plan_of(records.records_with_content(r, landing)), "html:string") != []
    want = transform_job(r, landing, "2024-01-01", "2024-12-31", AS_OF)
    key = ["identifier", "outcome", "file_hash", "reason"]
    assert sorted(map(str, job.select(*key).collect())) == sorted(map(str, want.select(*key).collect()))


def test_reading_all_objects_moves_none(spark, unbroadcast):
    store = ObjectStore(spark, scratch_path(spark, "store"), buckets=4)
    store.append(fx.landing_objects(spark, SF))
    plan = plan_of(store.objects())
    assert "Exchange" not in plan and "content:binary" not in plan_of(store.listing())


def test_known_identifiers_stay_in_their_buckets(spark, unbroadcast):
    known = KeyTable(spark, scratch_path(spark, "keys"), 4)
    items, store = fx.scraped_items(spark, SF), fx.item_store(spark, SF)
    known.append(store)
    new, _ = records.new_records(items, known, order_cols=fx.ITEM_ORDER)
    assert moved(plan_of(new), f"Location: InMemoryFileIndex(1 paths)[file:{known.table.name}") == []
    scans = [x for x in plan_of(new).split("\n") if "Scan parquet spark_catalog.default." + known.table.name in x]
    assert scans and moved(plan_of(new), "status:string") == [] and "Bucketed: true" in scans[0]
    first = new.count()
    assert first > 0
    known.append(new.withColumn("status", F.lit("extracted")))
    again, rest = records.new_records(items, known, order_cols=fx.ITEM_ORDER)
    assert again.count() == 0 and rest.count() == items.count()


def crawled(spark, start, end):
    seeds = ingest.search_seeds(spark, start, end)
    return fx.search_pages(spark, SF, seeds), fx.document_responses(spark, SF)


def test_ingest_of_a_range_is_published_whole_or_not_at_all(spark, monkeypatch):
    start, end = "2024-01-01", "2024-03-10"
    pages, responses = crawled(spark, start, end)
    target = Collection(spark, scratch_path(spark, "collection"), buckets=2)
    with monkeypatch.context() as m:
        m.setattr(Collection, "append_feed", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            ingest.ingest_range(pages, responses, target, start, end, AS_OF, "WRC")
    assert target.log.committed() == [] and target.records().count() == 0
    assert target.objects.listing().count() == 0 and target.known.keys().count() == 0
    stats = ingest.ingest_range(pages, responses, target, start, end, AS_OF, "WRC").collect()[0]
    docs = fx.table(spark, SF, "documents").where("doc_id % 4 = 0 AND doc_id % 6 < 3")
    assert stats.total_items == stats.items_stored == docs.count() == target.records().count()
    assert stats.errors == docs.where("doc_id % 13 = 0").count()
    assert target.objects.listing().count() == stats.files_downloaded
    again = ingest.ingest_range(pages, responses, target, start, end, AS_OF, ["WRC", "EAT"]).collect()[0]
    both = fx.table(spark, SF, "documents").where("doc_id % 2 = 0 AND doc_id % 6 < 3").count()
    assert again.total_items == both and again.items_stored == both - stats.items_stored
    feed = target.feed(target.records().select("identifier", "status").schema)
    assert feed.count() == stats.total_items + both
    assert [r.items_stored for r in target.log.counts().orderBy("run").collect()] == [stats.items_stored, again.items_stored]
    pruned = plan_of(target.records().where("partition_date = '2024-02-01'"))
    assert "PartitionFilters: [isnotnull(partition_date" in pruned


RETRIED = """
import os, sys
sys.path.insert(0, {repo!r})
from pyspark import TaskContext
from pyspark.sql import SparkSession, functions as F
from pyspark.sql import Observation
from folioflow.scale import materialise, tune
from folioflow.operators.aggregates import stat_columns
spark = tune(SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false").getOrCreate())
spark.sparkContext.setLogLevel("OFF")

def once(batches):
    for batch in batches:
        yield batch
    if TaskContext.get().attemptNumber() < 2:
        raise RuntimeError("this attempt is lost after its rows")

df = spark.range(1000, numPartitions=4).select(F.when(F.col("id") % 4 == 0, "failed").otherwise("processed").alias("outcome"))
seen = Observation("seen")
out = materialise(df.mapInArrow(once, "outcome string").observe(seen, *stat_columns()), "outcomes")
print("COUNTS", seen.get["total"], seen.get["failed"], out.count())
"""


def test_retried_tasks_are_counted_once(tmp_path):
    script = tmp_path / "run.py"
    script.write_text(textwrap.dedent(RETRIED.format(repo=str(Path(__file__).parent.parent))))
    done = subprocess.run([sys.executable, str(script)], capture_output=True, text=True, timeout=300, cwd=tmp_path)
    assert "COUNTS 1000 250 1000" in done.stdout, done.stderr[-2000:]


# -- objects as files -------------------------------------------------------------------


def test_objects_become_files(spark, tmp_path):
    folder = str(tmp_path / "zone")
    first = content(spark, ("a.pdf", b"A"), ("sub/b.html", b"<p>"), ("a.pdf", b"A"), ("empty", b""))  # Spark reads no file without a byte
    objects.objects_export(first, folder)
    objects.objects_export(content(spark, ("a.pdf", b"AA\xff")), folder)
    got = objects.objects_scan(spark, folder, LANDING_ZONE).orderBy("object_name").collect()
    assert [(r.object_name, bytes(r.content)) for r in got] == [("a.pdf", b"AA\xff"), ("sub/b.html", b"<p>")]
    assert os.path.getsize(os.path.join(folder, "empty")) == 0
    assert [os.listdir(os.path.join(folder, object_files.STAGING))] == [[]]
    for name in ("/etc/x", "../x", "a/../../x", "", None):
        with pytest.raises(ValueError):
            object_files.checked_name(name)


def batch_of(*rows):
    import pyarrow as pa

    return pa.RecordBatch.from_pydict({"object_name": [r[0] for r in rows], "content": pa.array([r[1] for r in rows], pa.binary())})


def visible(folder):
    return {f: (folder / f).read_bytes() for f in os.listdir(folder) if (folder / f).is_file()}


def test_a_retried_task_leaves_one_file_and_a_failed_job_none(tmp_path):
    (tmp_path / "old").write_bytes(b"before")
    writer = object_files._Writer(str(tmp_path), "job")

    def lost():
        yield batch_of(("x", b"1"), ("old", b"half"))
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        writer.write(lost())
    assert visible(tmp_path) == {"old": b"before"}
    messages = [writer.write(iter([batch_of(("x", b"1"), ("old", b"new"))])) for _ in range(2)]
    assert visible(tmp_path) == {"x": b"1", "old": b"new"}
    writer.abort([messages[1], None])
    assert visible(tmp_path) == {"old": b"before"}
    writer = object_files._Writer(str(tmp_path), "next")
    done = writer.write(iter([batch_of(("x", b"1"))]))
    writer.commit([done])
    assert (done.files, done.size) == (1, 1) and visible(tmp_path) == {"old": b"before", "x": b"1"}
