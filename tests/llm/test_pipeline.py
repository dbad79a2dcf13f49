import os

import pytest

import corpus_pipeline
from folioflow.llm import decontaminate
from folioflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [(r[0], r[1]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    columns, sizes = docs.columns, [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert docs.columns == columns
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0.5 * sizes[0]
    texts = [r["text"] for r in docs.collect()]
    phrases = decontaminate.Phrases(items)
    assert not any(spans for _, spans, _ in decontaminate.find_in_shard(texts, phrases))
    assert len(set(texts)) == len(texts)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert len(last) == len(texts) and all(r["round_trip"] for r in last)


def test_odd_rows_go_through_every_stage(spark):
    """Nulls, empty and repeated rows, no rows, and columns of the stages' own names."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = docs.limit(30).unionByName(docs.limit(30)).selectExpr("*", "1 AS row_no", "'x' AS grade", "2 AS unit", "3 AS found_words")
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (None, "", "", "", 0), (7, None, "en", "s", None), (7, "word " * 300, "en", "s", 1500)], docs.schema
    )
    odd = odd.unionByName(odd).selectExpr("*", "1 AS row_no", "'x' AS grade", "2 AS unit", "3 AS found_words")
    for df in (extra.unionByName(odd), extra.limit(0)):
        columns = df.columns
        for _, stage in corpus_pipeline.STAGES[:-1]:
            df = stage(spark, df, SF)
            assert df.columns == columns
            df = spark.createDataFrame(df.collect(), df.schema)
        assert all(r["round_trip"] for r in corpus_pipeline.STAGES[-1][1](spark, df, SF).collect())


def test_all_operators_are_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
