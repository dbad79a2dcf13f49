"""Joins between scraped items, stored records and document objects."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from folioflow.functions.content import (
    content_hash,
    decode_ignore,
    ext_landing,
    html_sniff,
    mime_ingest,
    object_name,
    object_path,
)
from folioflow.functions.html_nodes import parse_html, to_html
from folioflow.functions.times import as_of_literal
from folioflow.scale import broadcast_if_small, materialise, row_hash
from folioflow.schema import LANDING_ZONE
from folioflow.sources.store import KeyTable, ObjectStore

ITEM_ORDER = ["partition_date", "body_type", "page_no", "position"]


def first_wins(items: DataFrame, order_cols: list[str], key: str = "identifier") -> DataFrame:
    """The first item of each identifier in the given order.

    The rank filter is applied before the shuffle as well, so each task sends at
    most one row per identifier.
    """
    first = W.partitionBy(key).orderBy(*order_cols, row_hash(items))
    return (
        items.withColumn("_rank", F.row_number().over(first)).where(F.col("_rank") == 1).drop("_rank")
    )


def stored_keys(store: DataFrame | KeyTable, retry_errors: bool = False) -> DataFrame:
    """Identifiers that block a new ingest; failed records block too unless retried.

    Those of a key table come bucketed: items are shuffled to them and the store stays where it is.
    """
    keys = store.keys() if isinstance(store, KeyTable) else store
    kept = keys.where(~F.col("status").eqNullSafe("error")) if retry_errors else keys
    return kept.select("identifier").distinct()


def new_records(
    items: DataFrame,
    store: DataFrame | KeyTable,
    retry_errors: bool = False,
    order_cols: list[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Split items into new ones and duplicates.

    New is the first item of an identifier that is not stored, everything else is a
    duplicate. Of items that tie on the order columns the one with the smallest hash of its row comes first.
    """
    order_cols = order_cols or [c for c in ITEM_ORDER if c in items.columns]
    # First by identifier, so a task sends one row of each to the join however often it repeats.
    fresh = first_wins(items, order_cols).join(stored_keys(store, retry_errors), "identifier", "left_anti")
    return fresh, without(items, fresh, order_cols)


def without(items: DataFrame, chosen: DataFrame, order_cols: list[str]) -> DataFrame:
    """Items that are not among the chosen ones; each chosen row takes away one item.

    Joined on the order as well, so a much-repeated identifier spreads over all tasks; items that tie
    on all of that are numbered by the hash of their row, as ``first_wins`` takes them, so the chosen one comes first.
    """
    exact = ["identifier", *order_cols]
    tied = W.partitionBy(*exact).orderBy(row_hash(items))
    numbered = items.withColumn("_tie", F.row_number().over(tied))
    names = chosen.groupBy(*exact).agg(F.count(F.lit(1)).alias("_taken"))
    names = names.select(*[F.col(c).alias(f"_{c}") for c in exact], "_taken")
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in exact])
    return numbered.join(names, same & (F.col("_tie") <= F.col("_taken")), "left_anti").drop("_tie")


def feed_rows(new: DataFrame, duplicates: DataFrame) -> DataFrame:
    """All items of a run: new ones and duplicates; a status is only shown for errors."""
    rows = new.unionByName(duplicates, allowMissingColumns=True)
    if "status" not in rows.columns:
        return rows.withColumn("status", F.lit(None).cast("string"))
    return rows.withColumn("status", F.when(F.col("status") == "error", F.col("status")))


def _with_document(rows: DataFrame, key: str, documents: DataFrame, *carried: str) -> DataFrame:
    """``rows`` left-joined with ``documents`` by ``key`` without shuffling documents needlessly.

    Matches come from an inner join, so few rows are broadcast to the documents, which
    then stay where they are; rows without a document come from a join that reads the
    documents' keys only. ``has_document`` tells them apart.
    """
    found = (
        documents.select(key, *carried)
        .join(broadcast_if_small(rows), key, "inner")
        .select(*rows.columns, *carried, F.lit(True).alias("has_document"))
    )
    absent = [F.lit(None).cast(documents.schema[c].dataType).alias(c) for c in carried]
    missing = rows.join(documents.select(key), key, "left_anti").select(
        *rows.columns, *absent, F.lit(False).alias("has_document")
    )
    return found.unionByName(missing)


def _with_stored(rows: DataFrame, store: ObjectStore) -> DataFrame:
    """``rows`` with the documents of a store: joined with its names first, then with the documents, which stay in their buckets."""
    names = store.newest().select(F.col("object_name").alias("_object"), "run")
    met = rows.join(names, F.col("object_name") == F.col("_object"), "left")
    found = store.with_content(met.where("run IS NOT NULL").drop("_object")).withColumn("has_document", F.lit(True))
    missing = met.where("run IS NULL").drop("_object").withColumns({"content": F.lit(None).cast("binary"), "has_document": F.lit(False)})
    return found.unionByName(missing).drop("run")


def records_with_content(records: DataFrame, objects: DataFrame | ObjectStore) -> DataFrame:
    """Records with their object's ``content``; ``failure`` is set where there is no object.

    The documents of an ``ObjectStore`` are never moved, however many records there are.
    """
    named = records.withColumn("object_name", object_name(F.col("file_path")))
    if isinstance(objects, ObjectStore):
        joined = _with_stored(named, objects)
    else:
        joined = _with_document(named, "object_name", objects, "content")
    missing = F.concat(F.lit("no object "), F.coalesce("object_name", F.lit("without a name")))
    return joined.withColumn("failure", F.when(~F.col("has_document"), missing)).drop("has_document")


def one_per_url(responses: DataFrame) -> DataFrame:
    """One response of each URL: one with content before one without, then by type and hash.

    Chosen on narrow columns; only URLs that repeat are looked at again.
    """
    narrow = responses.select(
        "url", F.col("content").isNull().alias("_empty"), "content_type", F.xxhash64("content").alias("_hash")
    )
    key = F.struct("_empty", "content_type", "_hash")
    best = narrow.groupBy("url").agg(F.min(key).alias("_best"), F.count(F.lit(1)).alias("_n"))
    # Found once; a side that is small by measure leaves the responses where they are.
    repeated = materialise(best.where("_n > 1").select(F.col("url").alias("_url"), "_best"), "repeated-urls")
    repeated = broadcast_if_small(repeated)
    single = responses.join(repeated, F.col("url") == F.col("_url"), "left_anti")
    several = responses.join(repeated, F.col("url") == F.col("_url")).where(
        F.struct(F.col("content").isNull().alias("_empty"), "content_type", F.xxhash64("content").alias("_hash")).eqNullSafe(F.col("_best"))
    )
    return single.unionByName(several.dropDuplicates(["url"]).select(*responses.columns))


def ingest_attach(
    items: DataFrame, pages: DataFrame, as_of, zone: str = LANDING_ZONE
) -> DataFrame:
    """Attach each item's fetched document and describe how it is stored.

    ``pages`` holds the responses ``(url, content, content_type)``. The recorded
    ``file_hash`` is that of the received bytes; for HTML the stored bytes are the
    re-serialised page, whose hash is ``stored_hash``. An item without a response is
    kept with status ``error``.
    """
    responses = one_per_url(pages).select(F.col("url").alias("doc_link"), "content", "content_type")
    joined = _with_document(items, "doc_link", responses, "content", "content_type")
    ok = F.col("has_document") & F.col("content").isNotNull()
    joined = (
        joined.withColumn("has_document", ok)
        .withColumn("mime_type", F.when(ok, mime_ingest(F.col("content_type"))))
        .withColumn("is_html", html_sniff(F.col("mime_type"), F.col("content")))
        .withColumn("_text", F.when(F.col("is_html"), decode_ignore(F.col("content"))))
        .withColumn("_parsed", parse_html(F.col("_text")))
    )
    # A page that cannot be re-serialised is stored as it was received.
    page = F.when(F.col("_parsed.error").isNull(), to_html("_parsed.nodes")).otherwise(
        F.col("_text")
    )
    stored = F.when(F.col("is_html"), page.cast("binary")).otherwise(F.col("content"))
    ext = F.when(F.col("is_html"), ".html").otherwise(
        ext_landing(F.col("doc_link"), F.col("mime_type"))
    )
    named = joined.withColumn("stored_content", stored).withColumn(
        "object_name", F.when(ok, F.concat("identifier", ext))
    )
    problem = F.concat(F.lit("File processing error: no response for "), F.col("doc_link"))
    return named.withColumns(
        {
            "file_path": object_path(zone, F.col("object_name")),
            "file_hash": content_hash(F.col("content")),
            "stored_hash": content_hash(F.col("stored_content")),
            "stored_type": F.when(F.col("is_html"), "text/html").otherwise(F.col("mime_type")),
            "status": F.when(F.col("has_document"), "extracted").otherwise("error"),
            "notes": F.when(~F.col("has_document"), problem),
            "updated_at": as_of_literal(as_of),
        }
    ).drop("content", "content_type", "has_document", "_text", "_parsed")


def stamp_record(df: DataFrame, status: str, as_of, **changes) -> DataFrame:
    """Set the status and times of a run, and any further columns, on every row."""
    now = as_of_literal(as_of)
    stamps = {"status": F.lit(status), "updated_at": now, **changes}
    if status == "transformed":
        stamps["transformation_date"] = now
    return df.withColumns(stamps)


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def file_suffix(name: Column) -> Column:
    """Last dot and what follows; a name that starts or ends with its last dot has none."""
    return F.regexp_extract(name, r"(?s)^.+(\.[^.]+)$", 1)


def before_after(
    source: DataFrame, processed: DataFrame, order_cols: list[str] | None = None
) -> DataFrame:
    """Compare every source record with its processed one, the first if there are several."""
    order_cols = order_cols or ["transformation_date", "file_path"]
    after = first_wins(
        processed.select("identifier", "file_path", "file_hash", "status", *[
            c for c in order_cols if c not in ("identifier", "file_path", "file_hash", "status")
        ]),
        order_cols,
    ).select(
        "identifier",
        F.lit(True).alias("found"),
        F.col("file_path").alias("new_path"),
        F.col("file_hash").alias("new_hash"),
        F.col("status").alias("new_status"),
    )
    original_name = file_name(F.col("file_path"))
    new_name = file_name(F.col("new_path"))
    suffix = file_suffix(original_name)
    return source.join(after, "identifier", "left").select(
        "identifier",
        "mime_type",
        F.coalesce("found", F.lit(False)).alias("processed"),
        original_name.alias("original_name"),
        new_name.alias("new_name"),
        (new_name == F.concat("identifier", suffix)).alias("name_ok"),
        (F.col("file_hash") != F.col("new_hash")).alias("hash_changed"),
        F.substring_index("file_path", "/", 1).alias("source_zone"),
        F.substring_index("new_path", "/", 1).alias("new_zone"),
        F.col("new_path").contains("processed").alias("zone_ok"),
        F.col("status").alias("old_status"),
        F.col("new_status"),
        (F.col("new_status") == "transformed").alias("status_ok"),
        F.col("file_path").alias("old_path"),
        "new_path",
        F.col("file_hash").alias("old_hash"),
    )


def family_pairs(records: DataFrame) -> DataFrame:
    """Every (parent, child) pair, declared by the parent or found on a child record.

    Pairs are compared one by one, so a parent's children may fill any number of
    tasks and a parent may spread its list over several records.
    """
    declared = (
        records.where(F.col("metadata.role") == "parent")
        .select(
            F.col("identifier").alias("parent"),
            F.explode("metadata.children").alias("child"),
            F.lit(1).alias("declared"),
            F.lit(0).alias("present"),
        )
    )
    present = records.where(F.col("metadata.role") == "child").select(
        F.col("metadata.parent").alias("parent"),
        F.col("identifier").alias("child"),
        F.lit(0).alias("declared"),
        F.lit(1).alias("present"),
    )
    # A pair hardly repeats within a task: straight to the shuffle, whose partitions bound what a task holds.
    return (
        declared.unionByName(present)
        .repartition("parent", "child")
        .groupBy("parent", "child")
        .agg(F.max("declared").alias("declared"), F.max("present").alias("present"))
    )


def parent_child(records: DataFrame) -> DataFrame:
    """Completeness of each parent: declared, found, missing and extra children."""
    counts = family_pairs(records).groupBy("parent").agg(
        F.sum("declared").alias("n_declared"),
        F.sum("present").alias("n_present"),
        F.sum(F.col("declared") * (1 - F.col("present"))).alias("n_missing"),
        F.sum(F.col("present") * (1 - F.col("declared"))).alias("n_extra"),
    )
    parents = (
        records.where(F.col("metadata.role") == "parent")
        .select(F.col("identifier").alias("parent"))
        .distinct()
    )
    zero = F.lit(0).cast("long")
    return parents.join(counts, "parent", "left").select(
        "parent",
        *[F.coalesce(c, zero).alias(c) for c in ("n_declared", "n_present", "n_missing", "n_extra")],
        (F.coalesce(F.col("n_missing") + F.col("n_extra"), zero) == 0).alias("complete"),
    )


def child_diff(records: DataFrame) -> DataFrame:
    """Children a parent declares but lacks (``missing``) or has but does not declare (``extra``)."""
    pairs = family_pairs(records)
    parents = (
        records.where(F.col("metadata.role") == "parent")
        .select(F.col("identifier").alias("parent"))
        .distinct()
    )
    return (
        pairs.where(F.col("declared") != F.col("present"))
        .join(parents, "parent", "left_semi")
        .select(
            "parent",
            "child",
            F.when(F.col("declared") == 1, "missing").otherwise("extra").alias("difference"),
        )
    )
