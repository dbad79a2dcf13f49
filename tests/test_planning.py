"""Partitions and search tasks."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from folioflow.operators import planning


def starts(spark, start, end, interval="monthly"):
    return [r[0] for r in planning.partition_dates(spark, start, end, interval).orderBy("partition_date").collect()]


def test_partition_dates(spark):
    assert starts(spark, "2024-01-15", "2024-03-20") == [date(2024, m, 1) for m in (1, 2, 3)]
    assert starts(spark, "2023-12-31", "2024-01-01", "Monthly") == [date(2023, 12, 1), date(2024, 1, 1)]
    assert starts(spark, "2024-01-01", "2024-01-10", "daily") == [date(2024, 1, d) for d in range(1, 11)]
    assert starts(spark, date(2024, 1, 3), "2024-01-17", "WEEKLY") == [date(2024, 1, d) for d in (3, 10, 17)]
    assert starts(spark, "2024-01-01", "2024-01-15", 5) == [date(2024, 1, d) for d in (1, 6, 11)]
    assert starts(spark, "2024-02-29", "2024-02-29", 400) == [date(2024, 2, 29)]


@pytest.mark.parametrize("interval", ["yearly", 0, -1, 1.5, None, True])
def test_bad_interval(spark, interval):
    with pytest.raises(ValueError):
        planning.partition_dates(spark, "2024-01-01", "2024-01-02", interval)


def test_bad_range(spark):
    with pytest.raises(ValueError):
        planning.partition_dates(spark, "2024-01-02", "2024-01-01")
    with pytest.raises(ValueError):
        planning.partition_dates(spark, "2024-02-30", "2024-03-01")


def tasks(spark, start, end, bodies=None):
    parts = planning.partition_dates(spark, start, end)
    rows = planning.search_tasks(parts, bodies, start, end).orderBy("partition_date", "body").collect()
    return [(r.body, r.body_code, r.partition_date, str(r.period_start), str(r.period_end)) for r in rows]


def test_search_tasks(spark):
    assert tasks(spark, "2024-01-01", "2024-01-31", "WRC") == [
        ("WRC", "15376", "2024-01-01", "2024-01-01", "2024-01-31")
    ]
    assert {t[:2] for t in tasks(spark, "2024-01-01", "2024-01-31")} == {
        ("WRC", "15376"), ("LC", "3"), ("EAT", "2"), ("ET", "1"),
    }
    assert tasks(spark, "2024-06-15", "2024-06-20", ["EAT"]) == [
        ("EAT", "2", "2024-06-01", "2024-06-15", "2024-06-20")
    ]
    assert tasks(spark, "2023-12-10", "2024-02-05", ["New"]) == [
        ("New", "New", "2023-12-01", "2023-12-10", "2024-01-01"),
        ("New", "New", "2024-01-01", "2024-01-01", "2024-02-01"),
        ("New", "New", "2024-02-01", "2024-02-01", "2024-02-05"),
    ]


def test_search_url_of_task(spark):
    parts = planning.partition_dates(spark, "2024-01-01", "2024-01-15")
    url = planning.search_tasks(parts, "LC", "2024-01-01", "2024-01-15").collect()[0].search_url
    assert url.endswith("?decisions=1&body=3&from=01%2F01%2F2024&to=15%2F01%2F2024")


@pytest.mark.parametrize("interval", ["monthly", "weekly", "daily", 10])
def test_assign_partition_inverts_partition_dates(spark, interval):
    start, end = date(2024, 1, 3), date(2024, 4, 2)
    days = [start + timedelta(n) for n in range((end - start).days + 1)]
    df = spark.createDataFrame([(d,) for d in days], "d date").withColumn("ts", F.col("d").cast("timestamp"))
    got = {r.d: r.partition_date for r in planning.assign_partition(df, "ts", interval, start).collect()}
    parts = starts(spark, start, end, interval)
    assert got == {d: max(p for p in parts if p <= d).isoformat() for d in days}


def test_assign_partition_before_the_start(spark):
    df = spark.sql("select timestamp '2023-12-31 23:59:59' as ts")
    assert planning.assign_partition(df, "ts", "weekly", "2024-01-01").collect()[0].partition_date is None
    with pytest.raises(ValueError):
        planning.assign_partition(df, "ts", 7)


def test_ranges_in_a_table(spark):
    df = spark.createDataFrame(
        [("a", date(2024, 1, 5), date(2024, 2, 1)), ("b", date(2024, 3, 1), date(2024, 1, 1)), ("c", None, None)],
        "k string, s date, e date",
    )
    got = sorted((r.k, r.partition_date) for r in planning.partitions_of(df, "s", "e").collect())
    assert got == [("a", date(2024, 1, 1)), ("a", date(2024, 2, 1))]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_assign_interval(spark):
    """Uneven intervals, gaps, overlaps, bounds, times before 1970, rows without a time."""
    rng = random.Random(3)
    base = datetime(1969, 12, 20)
    grid = [(f"g{i}", base + timedelta(minutes=rng.randrange(60_000)), rng.choice([0, 1, 7, 90, 4000, 50_000])) for i in range(60)]
    grid = [(g, a, a + timedelta(minutes=m)) for g, a, m in grid] + [("us", base, base + timedelta(microseconds=1)), ("back", base, base - timedelta(days=9))]
    times = [g[1] for g in grid] + [g[2] for g in grid] + [base + timedelta(seconds=rng.randrange(4_000_000)) for _ in range(200)]
    rows = [(i, t) for i, t in enumerate(times + times[:20] + [None, None])]
    got = planning.assign_interval(
        spark.createDataFrame(rows, "id int, ts timestamp").repartition(3), "ts",
        spark.createDataFrame(grid, "g string, a timestamp, b timestamp"), "a", "b",
    )
    want = []
    for i, t in rows:
        held = [g for g, a, b in grid if t is not None and a <= t < b]
        want += [(i, g) for g in held] or [(i, None)]
    assert sorted((r.id, str(r.g)) for r in got.collect()) == sorted((i, str(g)) for i, g in want)
    plan = plan_of(got)
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert [c for c in got.columns if c.startswith("_")] == []


def test_assign_interval_to_an_empty_grid(spark):
    rows = spark.createDataFrame([(1, datetime(2024, 1, 1))], "id int, ts timestamp")
    none = spark.createDataFrame([], "g string, a timestamp, b timestamp")
    assert [(r.id, r.g) for r in planning.assign_interval(rows, "ts", none, "a", "b").collect()] == [(1, None)]
