"""Collection planning: date partitions, search tasks and partition assignment."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.functions.links import SEARCH_ADDRESS, search_url
from folioflow.schema import BODY_CODES, DEFAULT_BODIES

_STEP_DAYS = {"daily": 1, "weekly": 7}


def interval_days(interval: str | int) -> int | None:
    """Days per partition; ``None`` stands for calendar months."""
    if isinstance(interval, str):
        name = interval.lower()
        if name == "monthly":
            return None
        if name in _STEP_DAYS:
            return _STEP_DAYS[name]
    elif isinstance(interval, int) and not isinstance(interval, bool):
        if interval <= 0:
            raise ValueError("an interval in days must be positive")
        return interval
    raise ValueError("interval must be 'daily', 'weekly', 'monthly' or a positive number of days")


def _day(value: str | date) -> date:
    return value if isinstance(value, date) else date.fromisoformat(value)


def partition_dates(
    spark: SparkSession, start: str | date, end: str | date, interval: str | int = "monthly"
) -> DataFrame:
    """Start dates of the partitions that cover ``start`` .. ``end``.

    Months begin on the first of the month; day-based partitions begin at ``start``.
    """
    days = interval_days(interval)
    start, end = _day(start), _day(end)
    if end < start:
        raise ValueError("end must not be before start")
    row = spark.range(1).select(F.lit(start).alias("start"), F.lit(end).alias("end"))
    return row.select(F.explode(_starts(F.col("start"), F.col("end"), days)).alias("partition_date"))


def _starts(start: Column, end: Column, days: int | None) -> Column:
    if days is None:
        return F.sequence(F.trunc(start, "MM"), F.trunc(end, "MM"), F.expr("interval 1 month"))
    return F.sequence(start, end, F.expr(f"interval {days} day"))


def partitions_of(ranges: DataFrame, start: str, end: str, interval: str | int = "monthly") -> DataFrame:
    """Partition dates of every ``[start, end]`` range in a table, one row per partition.

    A range that ends before it starts has no partitions.
    """
    days = interval_days(interval)
    return ranges.where(F.col(end) >= F.col(start)).withColumn(
        "partition_date", F.explode(_starts(F.col(start), F.col(end), days))
    )


def body_code(df: DataFrame, mapping: dict[str, str] | None = None, body: str = "body") -> DataFrame:
    """Add the site's code of each body; an unknown body stands for itself.

    The mapping is configuration of a handful of entries, so it is a literal map
    in the plan and needs no join.
    """
    mapping = BODY_CODES if mapping is None else mapping
    code = F.col(body)
    if mapping:
        pairs = [F.lit(part) for item in mapping.items() for part in item]
        code = F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(body)), code)
    return df.withColumn("body_code", code)


def search_tasks(
    partitions: DataFrame,
    bodies: str | list[str] | None,
    start: str | date | Column,
    end: str | date | Column,
    mapping: dict[str, str] | None = None,
    address: str = SEARCH_ADDRESS,
) -> DataFrame:
    """One search per body and month, the period clamped to ``start`` .. ``end``.

    A period ends on the first day of the next month, so neighbouring periods share
    a day; the double results are removed when new records are selected. Further
    columns of ``partitions`` are kept, and the limits may be columns of it.
    """
    bodies = DEFAULT_BODIES if bodies is None else [bodies] if isinstance(bodies, str) else bodies
    start, end = [v if isinstance(v, Column) else F.lit(_day(v)) for v in (start, end)]
    part = F.col("partition_date")
    tasks = partitions.withColumns(
        {
            "body": F.explode(F.array(*[F.lit(b) for b in bodies])),
            "period_start": F.greatest(part, start),
            "period_end": F.least(F.add_months(part, 1), end),
        }
    )
    tasks = body_code(tasks, mapping)
    url = search_url(F.col("body_code"), F.col("period_start"), F.col("period_end"), address)
    return tasks.withColumns(
        {"partition_date": F.date_format(part, "yyyy-MM-dd"), "search_url": url}
    )


def assign_partition(
    df: DataFrame, ts_col: str, interval: str | int = "monthly", start: str | date | None = None
) -> DataFrame:
    """Add the ISO start date of the partition each row's time falls into.

    Day-based partitions count from ``start``; rows before it belong to none.
    """
    days = interval_days(interval)
    day = F.to_date(ts_col)
    if days is None:
        begin = F.trunc(day, "MM")
        if start is not None:
            begin = F.when(begin >= F.trunc(F.lit(_day(start)), "MM"), begin)
    else:
        if start is None:
            raise ValueError("day-based partitions need a start date")
        offset = F.datediff(day, F.lit(_day(start)))
        begin = F.when(offset >= 0, F.date_sub(day, F.pmod(offset, F.lit(days))))
    return df.withColumn("partition_date", F.date_format(begin, "yyyy-MM-dd"))


def assign_interval(
    df: DataFrame, ts_col: str, grid: DataFrame, start: str = "interval_start", end: str = "interval_end"
) -> DataFrame:
    """Each row with every interval ``[start, end)`` of an arbitrary grid that its time falls into.

    Intervals may be of any length, leave gaps and overlap; a row that none holds, or without a time, stays once with nulls. An interval
    is cut into bins of the power of two at or above its length, so it touches two at most however uneven the
    grid is; times look for their bin once per such length in the grid. Bins are joined by equality, and only
    instants that occur take part, each once. Columns of ``grid`` must not be named like those of ``df``.
    """
    length = F.expr(f"unix_micros(CAST({end} AS TIMESTAMP)) - unix_micros(CAST({start} AS TIMESTAMP))")
    level = F.when(length > 1, F.length(F.bin(length - 1))).otherwise(F.lit(0))
    cut = grid.where(length > 0).withColumn("_level", level)
    # One per power of two: 64 at most.
    levels = [row[0] for row in cut.select("_level").distinct().collect()]
    first, last = F.expr(f"shiftright(unix_micros(CAST({start} AS TIMESTAMP)), _level)"), F.expr(f"shiftright(unix_micros(CAST({end} AS TIMESTAMP)) - 1, _level)")
    cut = cut.select("*", F.explode(F.sequence(first, last)).alias("_bin"))
    instants = df.where(F.col(ts_col).isNotNull()).select(F.col(ts_col).alias("_instant")).distinct()
    instants = instants.select("_instant", F.explode(F.array(*[F.lit(x) for x in levels]).cast("array<int>")).alias("_its_level"))
    instants = instants.withColumn("_its_bin", F.expr("shiftright(unix_micros(CAST(_instant AS TIMESTAMP)), _its_level)"))
    same = (F.col("_its_level") == F.col("_level")) & (F.col("_its_bin") == F.col("_bin"))
    inside = (F.col(start) <= F.col("_instant")) & (F.col("_instant") < F.col(end))
    found = instants.join(cut, same & inside).drop("_its_level", "_its_bin", "_level", "_bin")
    known = df.where(F.col(ts_col).isNotNull()).join(found, F.col(ts_col) == F.col("_instant"), "left").drop("_instant")
    return known.unionByName(df.where(F.col(ts_col).isNull()), allowMissingColumns=True)
