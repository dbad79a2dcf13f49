"""Whole jobs, batch and incremental."""

from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from folioflow.plans.audit import audit_job, looked_up, zone_report
from folioflow.plans.ingest import ingest_items, ingest_job
from folioflow.plans.transform import (
    process_files,
    processed_objects,
    processed_records,
    publish_transform,
    transform_job,
)
from folioflow.scale import scratch_path
from folioflow.schema import PROCESSED_RECORDS, PROCESSED_ZONE
from folioflow.sources.store import Collection
from folioflow.streaming import incremental
from tests.test_records import content, rec, record_rows
from workload import fixtures as fx

AS_OF = datetime(2024, 7, 1, 12)
SF = "/root/testdata/sf0.001"


def test_process_files(spark):
    docx = "application/vnd.openxmlformats-officedocument.wordprocessingml.document"
    types = ["text/html", "application/pdf", "application/msword", docx, "text/html; charset=utf-8", "a/b", "TEXT/HTM"]
    page = b"<nav>n</nav><main>m\xff</main>"
    df = spark.createDataFrame([(str(i), t, page) for i, t in enumerate(types)], "identifier string, mime_type string, content binary")
    got = process_files(df).orderBy("identifier").collect()
    assert [r.new_name for r in got] == ["0.html", "1.pdf", "2.doc", "3.docx", "4.html", "5.bin", "6.html"]
    assert [bytes(r.new_content) == b"<main>m</main>" for r in got] == [True, False, False, False, True, False, True]
    assert [bytes(r.new_content) == page for r in got] == [False, True, True, True, False, True, False]


def processed_collection(spark):
    return Collection(spark, scratch_path(spark, "t"), PROCESSED_ZONE, PROCESSED_RECORDS, 2)


def small_zone(spark):
    r = record_rows(
        spark, rec("a", mime_type="text/html", file_path="landing-zone/a.html", file_hash="0"), rec("b"), rec("gone"), rec("x", mime_type=None),
        rec("", file_path="landing-zone/b.pdf"), rec("late", partition_date="2025-01-01"), rec("failed", status="error"),
        rec("broken", mime_type="text/html", file_path="landing-zone/broken"),
    )
    o = content(spark, ("a.html", b"<main>x</main>y"), ("b.pdf", b"B"), ("broken", b"&#xDFFF;"), ("late.pdf", b"L"))
    return r, o


def test_transform_outcomes(spark):
    r, o = small_zone(spark)
    got = {x.identifier: x for x in transform_job(r, o, "2024-01-01", "2024-12-31", AS_OF).collect()}
    assert {k: v.outcome for k, v in got.items()} == {
        "a": "processed", "b": "processed", "gone": "failed", "broken": "failed", "x": "skipped", "": "skipped",
    }
    a = got["a"]
    assert (a.file_path, a.status, a.transformation_date, a.updated_at) == ("processed/a.html", "transformed", AS_OF, AS_OF)
    assert bytes(a.new_content) == b"<main>x</main>" and a.file_hash != "0" and a.doc_link == "http://x.test/a"
    assert got["gone"].status == "extracted" and "gone.pdf" in got["gone"].reason and "Unicode" in got["broken"].reason
    assert got["x"].reason == "missing: mime_type"


def test_transform_keeps_extra_columns(spark):
    r, o = small_zone(spark)
    r = r.withColumn("original_filename", F.lit("n.pdf")).withColumn("extra", F.lit(1))
    out = processed_records(transform_job(r, o, "2024-01-01", "2024-12-31", AS_OF)).collect()
    assert {(x.original_filename, x.extra) for x in out} == {("n.pdf", 1)}


def test_nothing_selected(spark):
    r, o = small_zone(spark)
    target = processed_collection(spark)
    stats = publish_transform(transform_job(r, o, "2020-01-01", "2020-01-31", AS_OF), target)
    assert tuple(stats.collect()[0]) == (0, 0, 0, 0)
    assert target.records().count() == target.objects.objects().count() == 0


def test_reruns_append_unless_existing_are_skipped(spark):
    r, o = small_zone(spark)
    target = processed_collection(spark)
    run = lambda **kw: transform_job(r, o, "2024-01-01", "2024-12-31", AS_OF, **kw)
    for _ in range(2):
        stats = publish_transform(run(), target).collect()[0]
        assert tuple(stats) == (6, 2, 2, 2)
    assert [tuple(x)[1:] for x in target.log.counts().select("run", *stats.__fields__).collect()] == [(6, 2, 2, 2)] * 2
    done = target.records()
    assert sorted(x.identifier for x in done.collect()) == ["a", "a", "b", "b"]
    stored = target.objects.listing().select("zone", "object_name").collect()
    assert len(stored) == len(set(stored)) == 2
    again = run(processed=done, skip_existing=True)
    assert {x.identifier for x in again.collect()} == {"gone", "broken", "x", ""}
    with pytest.raises(ValueError):
        run(skip_existing=True)


def test_ingest_items_counts(spark):
    items = spark.createDataFrame(
        [("a", "http://x.test/1", 1), ("a", "http://x.test/1", 2), ("b", "http://x.test/2", 3), ("old", "http://x.test/3", 4),
         ("", "http://x.test/4", 5), ("c", None, 6)],
        "identifier string, doc_link string, n int",
    )
    store = spark.createDataFrame([("old", "extracted")], "identifier string, status string")
    responses = spark.createDataFrame([("http://x.test/1", b"%PDF", "application/pdf")], "url string, content binary, content_type string")
    result = ingest_items(items, store, responses, AS_OF, order_cols=["n"])
    assert tuple(result.stats.collect()[0]) == (6, 2, 1, 1)
    assert sorted((r.identifier, r.n, r.status) for r in result.records.collect()) == [("a", 1, "extracted"), ("b", 3, "error")]
    assert [r.object_name for r in result.objects.collect()] == ["a.pdf"]
    assert sorted((r.identifier, r.n, r.status) for r in result.feed.collect()) == [
        ("a", 1, None), ("a", 2, None), ("b", 3, "error"), ("old", 4, None),
    ]


def test_ingest_job_runs_twice_without_new_records(spark):
    pages, seeds = fx.listing_pages(spark, SF), fx.listing_seeds(spark, SF)
    responses, store = fx.document_responses(spark, SF), fx.document_store(spark, SF)
    first = ingest_job(pages, seeds, store, responses, AS_OF)
    n = fx.table(spark, SF, "documents").count()
    stats = first.stats.collect()[0]
    assert stats.total_items == n and stats.items_stored == first.records.count()
    grown = store.unionByName(first.records.select("identifier", "status"))
    second = ingest_job(pages, seeds, grown, responses, AS_OF)
    assert second.records.count() == 0 and second.stats.collect()[0].total_items == n
    only = ingest_job(pages, seeds, store, responses, AS_OF, bodies="src0")
    assert {r.body_type for r in only.feed.collect()} == {"src0"}


def test_audit(spark):
    r, o = small_zone(spark)
    out = transform_job(r, o, "2024-01-01", "2024-12-31", AS_OF)
    done, new = processed_records(out), processed_objects(out)
    zones = o.unionByName(new)
    report = {x.check_name: (x.n_checked, x.n_failed, x.passed) for x in audit_job(r, done, zones).collect()}
    assert report["processed"] == (8, 6, False) and report["object_present"] == (2, 0, True)
    assert report["html_changed"] == (1, 0, True) and report["children_complete"] == (0, 0, True)
    assert report["quality_gate"] == (7, 5, False) and report["processed_hash"] == (2, 0, True)
    assert report["html_clean"] == (1, 0, True) and report["html_shrunk"] == (1, 0, True)
    # Five records have a document on file; only that of "a" has a recorded hash, and that is another one.
    assert report["landing_hash"] == (5, 1, False)
    lenient = audit_job(r, done, zones, quality=2 / 7).where("check_name = 'quality_gate'").collect()[0]
    assert lenient.passed
    spoiled = new.withColumn("content", F.concat("content", F.lit(b"<nav>")))
    bad = {x.check_name: x.n_failed for x in audit_job(r, done, o.unionByName(spoiled)).collect()}
    assert bad["processed_hash"] == 2 and bad["html_clean"] == 1
    lost = audit_job(r, done, o).where("check_name = 'object_present'").collect()[0]
    assert (lost.n_failed, lost.passed) == (2, False)
    assert {x.zone: x.n_objects for x in zone_report(o).collect()} == {"landing-zone": 4}


def test_audit_reads_each_input_once(spark, monkeypatch):
    from folioflow.plans import audit

    r, o = small_zone(spark)
    out = transform_job(r, o, "2024-01-01", "2024-12-31", AS_OF)
    inputs = {}
    for name, df in {"r": r, "p": processed_records(out), "o": o.unionByName(processed_objects(out))}.items():
        inputs[name] = scratch_path(spark, name)
        df.write.parquet(inputs[name])
    plans = []
    write = audit.materialise
    monkeypatch.setattr(audit, "materialise", lambda df, name: plans.append(plan_of(df)) or write(df, name))
    tables = [spark.read.parquet(p) for p in inputs.values()]
    plans.append(plan_of(audit.audit_job(*tables)))
    for path in inputs.values():
        assert sum(plan.count(path.split("/")[-1]) for plan in plans) == 1
    assert "ArrowEvalPython" not in "".join(plans)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# -- incremental ---------------------------------------------------------------------------


def write_files(df, path, n):
    df.repartition(n).write.parquet(path)
    return df.sparkSession.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_stream_of_many_batches_equals_one_batch(spark):
    items, store, responses = fx.scraped_items(spark, SF), fx.item_store(spark, SF), fx.item_responses(spark, SF)
    path = scratch_path(spark, "s")
    stream = write_files(items, f"{path}/in", 3)

    def run(checkpoint):
        incremental.stream_ingest(stream, store, responses, f"{path}/r", f"{path}/o", checkpoint, AS_OF, fx.ITEM_ORDER).awaitTermination()
        return spark.read.parquet(f"{path}/r")

    batch = ingest_items(items, store, responses, AS_OF, order_cols=fx.ITEM_ORDER)
    want = sorted((r.identifier, r.status, r.file_hash) for r in batch.records.collect())
    got = run(f"{path}/c")
    assert sorted((r.identifier, r.status, r.file_hash) for r in got.collect()) == want
    assert got.select("batch_id").distinct().count() >= 1
    objs = spark.read.parquet(f"{path}/o")
    assert objs.count() == batch.objects.count()
    # Nothing new arrives: nothing changes. Everything is replayed: nothing changes either.
    assert sorted((r.identifier, r.status, r.file_hash) for r in run(f"{path}/c").collect()) == want
    assert sorted((r.identifier, r.status, r.file_hash) for r in run(f"{path}/c2").collect()) == want


def test_stream_dedup(spark):
    path = scratch_path(spark, "s")
    items = fx.scraped_items(spark, SF).withColumn("ts", F.col("partition_date").cast("timestamp"))
    stream = write_files(items, f"{path}/in", 3)
    for i, kept in enumerate([incremental.stream_dedup(stream, unbounded=True), incremental.stream_dedup(stream, "identifier", ("ts", "400 days"))]):
        kept.writeStream.format("parquet").option("path", f"{path}/out{i}").option("checkpointLocation", f"{path}/c{i}").trigger(
            availableNow=True
        ).start().awaitTermination()
        got = [r.identifier for r in spark.read.parquet(f"{path}/out{i}").collect()]
        assert sorted(got) == sorted({r.identifier for r in items.collect()})
    with pytest.raises(ValueError):
        incremental.stream_dedup(stream)


def test_the_earliest_row_wins_though_it_arrives_later(spark):
    path = scratch_path(spark, "s")
    schema = "identifier string, ts timestamp, n int"
    hour = lambda h, m=0: datetime(2024, 1, 1, h, m)
    files = [
        [("a", hour(5), 1), ("b", hour(6), 2), ("n", None, 0)],
        [("a", hour(4), 3), ("a", hour(4, 30), 4)],  # the earlier one arrives later
        [("c", hour(12), 5)],  # the watermark passes a and b
        [("a", hour(9), 6), ("d", hour(13), 7)],  # a duplicate of a winner that is still remembered
        [("e", hour(23), 8)],  # everything before is settled, and a to d forgotten
        [("z", datetime(2024, 1, 9), 9)],
        [("y", datetime(2024, 1, 20), 10)],
    ]

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
        won = incremental.stream_first_wins(stream, "ts", "3 hours", 5 * 3_600_000)
        query = won.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/c")
        query = query.trigger(availableNow=True).start()
        query.awaitTermination()
        return [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]

    sizes = []
    for rows in files:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{path}/in")
        sizes += run()
    got = sorted((r.identifier, r.ts, r.n) for r in spark.read.schema(schema).parquet(f"{path}/out").collect())
    assert got == [("a", hour(4), 3), ("b", hour(6), 2), ("c", hour(12), 5), ("d", hour(13), 7), ("e", hour(23), 8), ("z", datetime(2024, 1, 9), 9)]
    assert max(sizes) >= 3 and sizes[-1] <= 2


def test_keys_of_a_bucket_share_one_state(spark):
    path = scratch_path(spark, "s")
    rows = [(k, datetime(2024, 1, 1, h), 10 * h + n) for n, k in enumerate(["a", "b", "c", "d", "e", "f", None, ""]) for h in (5, 3, 7)]
    schema = "identifier string, ts timestamp, n int"
    for some in (rows, [("z", datetime(2024, 2, 1), 1)]):
        spark.createDataFrame(some, schema).coalesce(1).write.mode("append").parquet(f"{path}/in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    won = incremental.stream_first_wins(stream, "ts", "3 hours", 86_400_000, buckets=2)
    query = won.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/c")
    query = query.trigger(availableNow=True).start()
    query.awaitTermination()
    got = {(r.identifier, r.ts, r.n) for r in spark.read.schema(schema).parquet(f"{path}/out").collect()}
    assert got == {(k, t, n) for k, t, n in rows if t.hour == 3}
    assert max(p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators) <= 2


def test_stream_transform_equals_batch(spark):
    path = scratch_path(spark, "s")
    r, o = fx.landing_records(spark, SF), fx.landing_objects(spark, SF)
    stream = write_files(r, f"{path}/in", 4)
    incremental.stream_transform(stream, o, "2024-01-01", "2024-06-30", f"{path}/r", f"{path}/o", f"{path}/c", AS_OF).awaitTermination()
    want = processed_records(transform_job(r, o, "2024-01-01", "2024-06-30", AS_OF))
    key = lambda x: (x.identifier, x.file_path, x.file_hash, x.status)
    assert sorted(map(key, spark.read.parquet(f"{path}/r").collect())) == sorted(map(key, want.collect()))


def test_objects_written_by_publish(spark):
    r, o = small_zone(spark)
    target = processed_collection(spark)
    publish_transform(transform_job(r, o, "2024-01-01", "2024-12-31", AS_OF), target)
    got = target.objects.objects().orderBy("object_name").collect()
    assert [(x.zone, x.object_name, bytes(x.content), x.content_type, x.length) for x in got] == [
        ("processed", "a.html", b"<main>x</main>", "text/html", 14), ("processed", "b.pdf", b"B", "application/pdf", 1),
    ]


def test_records_without_a_path_spread_over_the_tasks(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in conf}
    rows = [(f"O-{i}", None, None) for i in range(400)] + [("a", "z/a.html", "h"), ("b", "z/b.html", "h"), (None, None, None)]
    compared = spark.createDataFrame(rows, "identifier string, old_path string, old_hash string")
    facts = spark.createDataFrame([("z/a.html", "x", 1), (None, "y", 2), ("\0", "y", 3)], "path string, hash string, length long")
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        found = looked_up(compared, facts, "old_path", "before").withColumn("part", F.spark_partition_id()).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(found) == 403
    assert [(r.identifier, r.before_hash, r.before_length) for r in found if r.before_path] == [("a", "x", 1)]
    sizes = Counter(r.part for r in found)
    assert len(sizes) == 8 and max(sizes.values()) < 120
