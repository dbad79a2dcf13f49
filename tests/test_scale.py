"""Hot groups, checked broadcasts, scratch space and the plans of the main jobs."""

import random

import pytest
from pyspark.sql import functions as F

from folioflow import scale
from folioflow.operators import html, ranking, records
from workload import fixtures as fx

SF = "/root/testdata/sf0.001"


def skewed(spark, n=3000):
    rng = random.Random(7)
    orders = list(range(n))
    rng.shuffle(orders)
    rows = [("hot" if i % 3 == 0 else None if i % 50 == 1 else f"k{i % 40}", o) for i, o in enumerate(orders)]
    return rows, spark.createDataFrame(rows, "k string, o long").repartition(5)


def expected(rows):
    groups = {}
    for k, o in rows:
        groups.setdefault(k, []).append(o)
    return {(k, o): (i + 1, len(v)) for k, v in groups.items() for i, o in enumerate(sorted(v))}


@pytest.mark.parametrize("tasks", [1, 7, 64])
def test_numbered(spark, tasks):
    """A hot group, a null group, and groups whose orders do not overlap."""
    rows, df = skewed(spark)
    apart = [("low", o) for o in range(-500, 0)] + [("high", o) for o in range(10**6, 10**6 + 500)]
    df = df.unionByName(spark.createDataFrame(apart, "k string, o long"))
    spark.conf.set("spark.sql.shuffle.partitions", tasks)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = scale.numbered(df, ["k"], "o", "no", "n")
        got = {(r.k, r.o): (r.no, r.n) for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert out.columns == ["k", "o", "no", "n"] and got == expected(rows + apart)


def test_numbered_by_text_and_two_keys(spark):
    df = spark.range(2000).select(
        F.lit("a").alias("k1"), (F.col("id") % 2).alias("k2"), F.sha2(F.col("id").cast("string"), 256).alias("o")
    )
    got = scale.numbered(df, ["k1", "k2"], "o", "no", "n").collect()
    for side in (0, 1):
        part = sorted((r.o, r.no, r.n) for r in got if r.k2 == side)
        assert [p[1] for p in part] == list(range(1, 1001)) and {p[2] for p in part} == {1000}


def test_numbers_of_repeated_orders_are_the_same_for_any_number_of_tasks(spark):
    df = spark.range(900).select((F.col("id") % 2).alias("k"), (F.col("id") % 5).alias("o"), F.col("id").alias("v"))
    df = df.unionByName(df.where("v < 40"))  # and rows that are wholly equal
    seen = []
    for tasks in (1, 7, 64):
        ranged = scale.numbered(df.repartition(tasks), ["k"], "o", "no")
        seen.append(sorted(map(tuple, ranged.collect())))
    assert seen[0] == seen[1] == seen[2]
    assert sorted(r[3] for r in seen[0] if r[0] == 0) == list(range(1, 471))


def test_a_hot_group_is_numbered_by_several_tasks(spark):
    df = spark.range(40_000, numPartitions=8).select(F.lit("hot").alias("k"), F.col("id").alias("o"))
    ranged = df.repartitionByRange(8, "k", "o")
    assert ranged.groupBy(F.spark_partition_id()).count().count() == 8
    out = scale.numbered(df, ["k"], "o", "no", "n")
    assert out.where("no <> o + 1 OR n <> 40000").isEmpty() and out.count() == 40_000


def test_numbering_nothing(spark):
    none = spark.createDataFrame([], "k string, o long")
    assert scale.numbered(none, ["k"], "o", "no", "n").collect() == []


def test_group_members_of_a_hot_parent(spark):
    rows, df = skewed(spark)
    files = df.select(F.col("k").alias("parent_id"), F.lpad(F.col("o").cast("string"), 6, "0").alias("identifier"))
    got = ranking.group_members(files, per_row=37).orderBy("parent_id", "part_no").collect()
    assert max(len(r.members) for r in got) == 37
    lists = {}
    for r in got:
        lists.setdefault(r.parent_id, []).extend(r.members)
    want = {}
    for k, o in rows:
        want.setdefault(k, []).append(f"{o:06d}")
    assert lists == {k: sorted(v) for k, v in want.items()}


def test_broadcast_only_below_the_bound(spark):
    df = spark.range(100).withColumn("s", F.lit("x" * 100))

    def plan(small):
        return spark.range(10**7).join(small, "id")._jdf.queryExecution().optimizedPlan().toString()

    assert "strategy=broadcast" in plan(scale.broadcast_if_small(df))
    assert "strategy=broadcast" not in plan(scale.broadcast_if_small(df, max_bytes=1000))


def test_scratch_follows_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    root = scale.scratch_root(spark)
    assert root == (named or spark.sparkContext.getCheckpointDir())
    path = scale.scratch_path(spark, "x")
    assert path.startswith(root) and path != scale.scratch_path(spark, "x")
    assert spark.sparkContext.getCheckpointDir()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_cleaning_parses_once_and_does_not_shuffle_many_files(spark):
    path = scale.scratch_path(spark, "pages")
    fx.table(spark, SF, "pages").repartition(12).write.parquet(path)
    # A table below one split per core is spread once; splits are made small here, so this table is above.
    assert "RoundRobinPartitioning" in plan_of(html.clean_html(spark.read.parquet(path)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        plan = plan_of(html.clean_html(spark.read.parquet(path)))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert "Exchange" not in plan and plan.count("ArrowEvalPython") == 1
    assert "ReadSchema: struct<page_id:bigint,url:string,html:string>" in plan


def test_first_wins_limits_rows_before_the_shuffle(spark):
    plan = plan_of(records.first_wins(fx.scraped_items(spark, SF), fx.ITEM_ORDER))
    assert "WindowGroupLimit" in plan[plan.index("Exchange") :]


def test_listing_does_not_read_content(spark):
    from folioflow.sources import objects

    path = scale.scratch_path(spark, "objects")
    objects.objects_append(fx.landing_objects(spark, SF), path)
    plan = plan_of(objects.zone_listing(objects.objects_table(spark, path), "landing-zone"))
    assert "content:binary" not in plan and "PartitionFilters: [isnotnull(zone" in plan


def test_hash_audit_shuffles_hashes_only(spark):
    from folioflow.operators import aggregates

    df = aggregates.hash_audit(fx.landing_records(spark, SF), fx.landing_objects(spark, SF))
    plan = plan_of(df)
    below_join = plan[plan.index("Join") :]
    assert "sha2" in below_join


def test_no_shared_state_between_partition_counts(spark):
    few = records.new_records(fx.scraped_items(spark, SF).coalesce(1), fx.item_store(spark, SF), order_cols=fx.ITEM_ORDER)
    many = records.new_records(fx.scraped_items(spark, SF).repartition(9), fx.item_store(spark, SF), order_cols=fx.ITEM_ORDER)
    for a, b in zip(few, many):
        assert sorted(a.collect()) == sorted(b.collect())
