"""Filters, joins, counts and tables of records and objects."""

from datetime import datetime

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from folioflow.operators import aggregates, filters, ranking, records
from folioflow.scale import scratch_path
from folioflow.schema import OBJECTS, RECORDS
from folioflow.sources import feed, objects, pages, tables

AS_OF = datetime(2024, 7, 1, 12)


def record_rows(spark, *rows):
    names = RECORDS.fieldNames()
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], RECORDS)


def rec(identifier, **fields):
    base = {"partition_date": "2024-01-01", "status": "extracted", "mime_type": "application/pdf",
            "file_path": f"landing-zone/{identifier}.pdf", "doc_link": f"http://x.test/{identifier}"}
    return base | {"identifier": identifier} | fields


def ids(df):
    return sorted(r.identifier for r in df.collect())


def test_range_is_inclusive_text(spark):
    r = record_rows(spark, rec("a"), rec("b", partition_date="2024-02-01"), rec("c", partition_date=None),
                    rec("d", partition_date="2024-03-01", status="error"))
    assert ids(filters.records_by_range(r, "2024-01-01", "2024-03-01")) == ["a", "b", "d"]
    assert ids(filters.records_by_range(r, "2024-01-02", "2024-02-01")) == ["b"]
    assert ids(filters.records_by_range(r, "2024-01-01", "2024-03-01", "error")) == ["d"]
    assert ids(filters.records_by_range(r, "2024-01-01", "2024-03-01", "")) == ["a", "b", "d"]
    assert ids(filters.records_by_range(r, "2024-01-01", "2024-02-01T")) == ["a", "b"]


def test_lookup_and_simple_filters(spark):
    r = record_rows(spark, rec("a", body_type="WRC"), rec("a", body_type="LC"), rec("b", body_type="X", mime_type=None))
    assert filters.record_lookup(r, "a").count() == 1
    assert filters.record_lookup(r, "zz").count() == 0
    assert ids(filters.body_filter(r, "X")) == ["b"]
    assert ids(filters.body_filter(r)) == ["a", "a"]
    assert ids(filters.mime_filter(r, "application/pdf")) == ["a", "a"]
    assert aggregates.count_where(r, "body_type = 'WRC'").collect() == [Row(n=1)]
    assert aggregates.count_where(r, F.col("mime_type") == "application/pdf").collect() == [Row(n=2)]


def test_required_fields(spark):
    checked = filters.required_fields(
        record_rows(spark, rec("a"), rec("", file_path=None), rec("c", mime_type="")), ["identifier", "file_path", "mime_type"]
    )
    reasons = {r.identifier: r.reject_reason for r in checked.collect()}
    assert reasons == {"a": None, "": "missing: identifier,file_path", "c": "missing: mime_type"}
    assert ids(filters.accepted(checked)) == ["a"]
    assert filters.rejected(checked).count() == 2


def test_object_exists(spark):
    listing = spark.createDataFrame([("z", "a"), ("z", "a"), ("y", "b")], "zone string, object_name string")
    keys = spark.createDataFrame([("z", "a"), ("z", "b"), ("y", "b"), ("z", None), (None, "a")], "zone string, object_name string")
    got = {(r.zone, r.object_name): r.found for r in filters.object_exists(keys, listing).collect()}
    assert got == {("z", "a"): True, ("z", "b"): False, ("y", "b"): True, ("z", None): False, (None, "a"): False}


ITEMS = [("a", 3), ("a", 1), ("b", 2), ("c", 4), ("c", 5), ("d", 6)]


def items_df(spark):
    return spark.createDataFrame(ITEMS, "identifier string, n int")


def test_first_wins(spark):
    got = records.first_wins(items_df(spark), ["n"])
    assert sorted((r.identifier, r.n) for r in got.collect()) == [("a", 1), ("b", 2), ("c", 4), ("d", 6)]


@pytest.mark.parametrize("retry,new", [(False, [("a", 1), ("d", 6)]), (True, [("a", 1), ("c", 4), ("d", 6)])])
def test_new_records(spark, retry, new):
    store = spark.createDataFrame([("b", "extracted"), ("c", "error"), ("b", None)], "identifier string, status string")
    fresh, duplicates = records.new_records(items_df(spark), store, retry, ["n"])
    got = sorted((r.identifier, r.n) for r in fresh.collect())
    rest = sorted((r.identifier, r.n) for r in duplicates.collect())
    assert got == new
    assert sorted(got + rest) == sorted(ITEMS)


def test_items_that_tie_are_new_or_duplicate_once(spark):
    items = spark.createDataFrame([("a", 1, f"x{i}") for i in range(40)], "identifier string, n int, extra string")
    for parts in (1, 6):
        new, rest = records.new_records(items.repartition(parts), spark.createDataFrame([], "identifier string, status string"), order_cols=["n"])
        got = [r.extra for r in new.collect()] + [r.extra for r in rest.collect()]
        assert sorted(got) == sorted(f"x{i}" for i in range(40))
        first = got[0] if parts == 1 else first
        assert got[0] == first


def test_feed_rows(spark):
    new = spark.createDataFrame([("a", "extracted", "p"), ("b", "error", None)], "identifier string, status string, file_path string")
    old = spark.createDataFrame([("c",)], "identifier string")
    got = sorted(records.feed_rows(new, old).collect())
    assert [(r.identifier, r.status) for r in got] == [("a", None), ("b", "error"), ("c", None)]
    assert [r.status for r in records.feed_rows(old, old).collect()] == [None, None]


def content(spark, *rows):
    return spark.createDataFrame([("landing-zone", n, c, None, len(c)) for n, c in rows], OBJECTS)


def test_records_with_content(spark):
    r = record_rows(spark, rec("a"), rec("b"), rec("c", file_path="c.pdf"))
    got = records.records_with_content(r, content(spark, ("a.pdf", b"A"), ("c.pdf", b"C"), ("x", b"X")))
    assert {x.identifier: (x.content and bytes(x.content), x.failure) for x in got.collect()} == {
        "a": (b"A", None), "b": (None, "no object b.pdf"), "c": (b"C", None),
    }


def test_ingest_attach(spark):
    items = spark.createDataFrame(
        [("pdf", "http://x.test/1.pdf"), ("page", "http://x.test/2"), ("sniffed", "http://x.test/3.pdf"),
         ("gone", "http://x.test/4"), ("plain", "http://x.test/5"), ("bad", "http://x.test/6")],
        "identifier string, doc_link string",
    )
    responses = spark.createDataFrame(
        [("http://x.test/1.pdf", b"%PDF", "application/pdf; q=1"), ("http://x.test/2", b"<p>a<br>", "text/html"),
         ("http://x.test/3.pdf", b"<!DOCTYPE html><p>\xffx", "application/pdf"), ("http://x.test/5", b"t", None),
         ("http://x.test/6", b"<p>&#xD800;\xff", "text/html")],
        "url string, content binary, content_type string",
    )
    got = {r.identifier: r for r in records.ingest_attach(items, responses, AS_OF).collect()}
    assert got["pdf"].file_path == "landing-zone/pdf.pdf" and got["pdf"].mime_type == "application/pdf"
    assert got["pdf"].file_hash == got["pdf"].stored_hash and got["pdf"].status == "extracted"
    assert bytes(got["page"].stored_content) == b"<p>a<br/></p>" and got["page"].file_hash != got["page"].stored_hash
    # Sniffed pages are stored as .html but keep the MIME type they were sent with.
    assert got["sniffed"].file_path == "landing-zone/sniffed.html" and got["sniffed"].mime_type == "application/pdf"
    assert bytes(got["sniffed"].stored_content) == b"<!DOCTYPE html>\n<p>x</p>"
    assert got["gone"].status == "error" and got["gone"].notes.startswith("File processing error: ")
    assert got["gone"].file_path is None and got["gone"].updated_at == AS_OF
    assert (got["plain"].mime_type, got["plain"].file_path) == ("application/octet-stream", "landing-zone/plain.bin")
    # A page that cannot be re-serialised is stored as received.
    assert bytes(got["bad"].stored_content) == b"<p>&#xD800;" and got["bad"].status == "extracted"


def test_before_after(spark):
    source = record_rows(spark, rec("a", file_path="landing-zone/x1.pdf", file_hash="1"), rec("b"), rec("c", file_path="landing-zone/noext", file_hash="3"))
    done = source.where("identifier <> 'b'").withColumns(
        {"file_path": F.concat(F.lit("processed/"), "identifier", F.lit(".pdf")), "status": F.lit("transformed"),
         "transformation_date": F.lit(AS_OF), "file_hash": F.when(F.col("identifier") == "a", "1").otherwise("9")}
    )
    got = {r.identifier: r for r in records.before_after(source, done.unionByName(done)).collect()}
    assert len(got) == 3
    assert (got["a"].processed, got["a"].name_ok, got["a"].hash_changed, got["a"].zone_ok, got["a"].status_ok) == (True, True, False, True, True)
    assert not got["b"].processed and got["b"].new_name is None
    assert not got["c"].name_ok and got["c"].hash_changed


def family(spark, *rows):
    schema = "identifier string, metadata struct<role string, parent string, children array<string>>"
    return spark.createDataFrame(rows, schema)


def test_parent_child(spark):
    r = family(
        spark,
        ("P1", ("parent", None, ["a", "b", "b"])), ("P1", ("parent", None, ["c"])),
        ("P2", ("parent", None, ["x"])), ("P3", ("parent", None, [])), ("P4", ("parent", None, None)),
        ("a", ("child", "P1", None)), ("b", ("child", "P1", None)), ("c", ("child", "P1", None)),
        ("y", ("child", "P2", None)), ("z", ("child", "P9", None)), ("n", None),
    )
    got = {r.parent: tuple(r)[1:] for r in records.parent_child(r).collect()}
    assert got == {"P1": (3, 3, 0, 0, True), "P2": (1, 1, 1, 1, False), "P3": (0, 0, 0, 0, True), "P4": (0, 0, 0, 0, True)}
    diff = sorted(tuple(x) for x in records.child_diff(r).collect())
    assert diff == [("P2", "x", "missing"), ("P2", "y", "extra")]
    assert ids(filters.nested_filter(r, "metadata.role", "child")) == ["a", "b", "c", "y", "z"]


def test_stats(spark):
    outcomes = spark.createDataFrame([("processed",), ("processed",), ("failed",), ("skipped",)], "outcome string")
    stats = aggregates.transform_stats(outcomes)
    assert stats.collect() == [Row(total=4, processed=2, failed=1, skipped=1)]
    before = aggregates.count_where(outcomes, "true")
    assert aggregates.quality_gate(before, stats).collect() == [Row(before_count=4, processed=2, passed=False)]
    assert aggregates.quality_gate(before, stats, 0.5).collect()[0].passed
    assert aggregates.transform_stats(outcomes.where("false")).collect() == [Row(total=0, processed=0, failed=0, skipped=0)]


def test_extension_counts(spark):
    objs = content(spark, ("a.pdf", b""), ("b.PDF", b""), ("x/c.tar.gz", b""), ("none", b""), (".hidden", b""), ("d.", b""))
    got = [tuple(r) for r in aggregates.extension_counts(objs).collect()]
    assert got == [("", 3), (".PDF", 1), (".gz", 1), (".pdf", 1)]


def test_hash_audit_and_zones(spark):
    import hashlib

    objs = content(spark, ("a.pdf", b"A"), ("b.pdf", b"B"))
    r = record_rows(spark, rec("a", file_hash=hashlib.sha256(b"A").hexdigest()), rec("b", file_hash="0"), rec("c"))
    assert aggregates.hash_audit(r, objs).collect() == [Row(mime_type="application/pdf", unchanged=1, changed=1, missing=1)]
    assert aggregates.zone_totals(objs).collect() == [Row(zone="landing-zone", n_objects=2, n_bytes=2)]
    assert objects.zone_listing(objs, "other").count() == 0


def test_html_audit(spark):
    before = spark.createDataFrame([("a", "<nav></nav><button>b</button>xx"), ("b", "")], "identifier string, html string")
    after = spark.createDataFrame([("a", "xx"), ("b", "")], "identifier string, html string")
    got = aggregates.html_audit(before, after)
    row = got.where("identifier = 'a'").collect()[0]
    assert row.before_nav and row.before_button and not row.before_header and row.removed_ok
    assert row.size_reduction == (31 - 2) / 31 * 100
    totals = aggregates.html_audit_totals(got).collect()[0]
    assert (totals.pages, totals.before_nav, totals.after_nav, totals.removed_ok) == (2, 1, 0, 2)


def test_pagination_and_multi_file_shapes(spark):
    paged = spark.createDataFrame([(f"PAG-{p:02d}-{n:02d}", "list", p * 5 + n) for p in range(3) for n in range(5)],
                                  "identifier string, body string, item_seq int")
    placed = ranking.page_position(paged, page_size=5)
    assert [tuple(r) for r in aggregates.group_counts(placed, ["page_no"]).collect()] == [(1, 5), (2, 5), (3, 5)]
    assert {r.position for r in placed.collect()} == {1, 2, 3, 4, 5}
    files = spark.createDataFrame([(f"M{p}", f"M{p}-{i}", i) for p, n in ((1, 3), (2, 2), (3, 3)) for i in range(n)],
                                  "parent_id string, identifier string, file_seq int")
    indexed = {r.identifier: (r.file_index, r.total_files) for r in ranking.file_index(files).collect()}
    assert indexed["M1-2"] == (2, 3) and indexed["M2-0"] == (0, 2)
    members = sorted((r.parent_id, r.part_no, r.n_members, r.members) for r in ranking.group_members(files, per_row=2).collect())
    assert members[:2] == [("M1", 0, 3, ["M1-0", "M1-1"]), ("M1", 1, 3, ["M1-2"])]


# -- tables ----------------------------------------------------------------------------


def test_append_and_scan(spark):
    path = scratch_path(spark, "t")
    tables.records_append(record_rows(spark).where("false"), path)
    tables.records_append(record_rows(spark, rec("a"), rec("b", partition_date="2024-02-01")), path)
    tables.records_append(record_rows(spark, rec("a")), path)
    back = tables.records_scan(spark, path)
    assert ids(back) == ["a", "a", "b"]
    assert dict(back.dtypes)["partition_date"] == "string"
    plan = filters.records_by_range(back, "2024-02-01", "2024-02-28")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(partition_date" in plan


def test_update_first_match(spark):
    path = scratch_path(spark, "t")
    tables.records_append(
        record_rows(spark, rec("a", created_at=datetime(2024, 1, 2)), rec("a", created_at=datetime(2024, 1, 1)),
                    rec("b", partition_date="2024-02-01"), rec("c", partition_date="2024-03-01")), path,
    )
    untouched = [f for f in spark.read.parquet(path).inputFiles() if "2024-03-01" in f]
    updates = spark.createDataFrame([("a", "error", None), ("zz", "error", "n"), ("b", None, "note")],
                                    "identifier string, status string, notes string")
    changed = tables.records_update_table(spark, path, updates, AS_OF)
    assert ids(changed) == ["a", "b"]
    got = sorted((r.identifier, str(r.created_at)[:10], r.status, r.notes, r.updated_at) for r in tables.records_scan(spark, path).collect())
    assert got == [
        ("a", "2024-01-01", "error", None, AS_OF), ("a", "2024-01-02", "extracted", None, None),
        ("b", "None", "extracted", "note", AS_OF), ("c", "None", "extracted", None, None),
    ]
    assert [f for f in spark.read.parquet(path).inputFiles() if "2024-03-01" in f] == untouched


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_update_chooses_by_keys_and_joins_once(spark):
    path = scratch_path(spark, "t")
    hot = [rec("hot", created_at=datetime(2024, 1, 1 + i % 28), doc_link=f"http://x.test/{i}", file_path=f"z/{i:03d}") for i in range(200)]
    tables.records_append(record_rows(spark, *hot, rec("b")), path)
    updates = spark.createDataFrame([("hot", "error"), ("b", "error")], "identifier string, status string")
    out = tables.records_update(tables.records_scan(spark, path), updates, AS_OF)
    plan = plan_of(out)
    assert plan.count("Scan ") <= 3 and plan.count("Exchange ") <= 3
    changed = sorted((r.identifier, r.file_path) for r in out.where("was_updated").collect())
    assert changed == [("b", "landing-zone/b.pdf"), ("hot", "z/000")] and out.count() == 201


def test_objects_upsert(spark):
    old = content(spark, ("a", b"1"), ("b", b"2"))
    new = content(spark, ("b", b"33"), ("b", b"4"), ("c", b"5"))
    got = objects.objects_upsert(old, new, [F.desc("length")])
    assert sorted((r.object_name, bytes(r.content)) for r in got.collect()) == [("a", b"1"), ("b", b"33"), ("c", b"5")]


def test_object_files(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.pdf").write_bytes(b"A\xff")
    (tmp_path / "sub" / "b.html").write_bytes(b"<p>b")
    for path in (str(tmp_path), f"file://{tmp_path}/"):
        got = objects.objects_scan(spark, path, "landing-zone").orderBy("object_name").collect()
        assert [(r.object_name, bytes(r.content), r.length) for r in got] == [("a.pdf", b"A\xff", 2), ("sub/b.html", b"<p>b", 4)]
    for fmt in ("text", "binaryFile"):
        got = pages.pages_scan(spark, str(tmp_path / "sub"), fmt).collect()
        assert [(r.url.endswith("/sub/b.html"), r.html) for r in got] == [(True, "<p>b")]


def test_pages_of_several_lines_stay_whole(spark, tmp_path):
    (tmp_path / "a.html").write_bytes(b"<p>\n\r\n<p>b\n")
    for fmt in ("text", "binaryFile"):
        assert [r.html for r in pages.pages_scan(spark, str(tmp_path), fmt).collect()] == ["<p>\n\r\n<p>b\n"]


@pytest.mark.parametrize("fmt", ["json", "csv", "xml"])
def test_feed_export(spark, fmt):
    rows = spark.createDataFrame([("a", "x,\"y\"\nz", 1), ("b", None, 2)], "identifier string, description string, page_no long")
    path = scratch_path(spark, "feed")
    assert not feed.feed_export(rows.where("false"), path, fmt)
    assert feed.feed_export(rows, path, fmt)
    reader = spark.read.schema(rows.schema)
    options = {"csv": {"header": True, "escape": '"', "multiLine": True}, "xml": {"rowTag": "item"}, "json": {}}[fmt]
    back = reader.format(fmt).options(**options).load(path)
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in rows.collect())


def test_feed_csv_writes_nested_values_as_json(spark):
    rows = spark.sql("select 'a' as identifier, named_struct('page', 1) as metadata")
    path = scratch_path(spark, "feed")
    feed.feed_export(rows, path, "csv")
    assert spark.read.option("header", True).option("escape", '"').csv(path).collect()[0].metadata == '{"page":1}'
    with pytest.raises(ValueError):
        feed.feed_export(rows, path, "yaml")
