"""Compares every query with its SQL in DuckDB: ``python -m workload.check SF_DIR [query ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from folioflow.scale import tune

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def local_session(cpus: str = "8", shuffle_partitions: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("folioflow")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"create view {name} as select * from '{path}'")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if hasattr(value, "tolist"):
        return value.tolist()
    return value


def _sort_key(row):
    return tuple((v is None, str(v)) for v in row)


def difference(df, con, sql) -> str | None:
    """``None`` if both sides hold the same rows, else what differs."""
    got_cols = sorted(df.columns)
    got = sorted((tuple(_cell(r[c]) for c in got_cols) for r in df.collect()), key=_sort_key)
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    if sorted(names) != got_cols:
        return f"columns {got_cols} != {sorted(names)}"
    order = [names.index(c) for c in got_cols]
    want = sorted((tuple(_cell(r[i]) for i in order) for r in rel.fetchall()), key=_sort_key)
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    if not want:
        return "no rows on either side"
    for g, w in zip(got, want):
        if g != w or [type(x) for x in g] != [type(x) for x in w]:
            return f"{got_cols}: {str(g)[:700]} != {str(w)[:700]}"
    return None


def main(argv: list[str]) -> int:
    from workload.oracles import ORACLES
    from workload.queries import QUERIES

    sf_dir, names = argv[0], argv[1:] or list(QUERIES)
    spark, con, bad = local_session(), duck(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in ORACLES:
                problem = difference(df, con, ORACLES[name])
            else:
                problem = f"no SQL, {df.count()} rows"
        except Exception as exc:
            problem = f"{type(exc).__name__}: {str(exc)[:1500]}"
        bad += problem is not None
        print(f"{name:24s} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
