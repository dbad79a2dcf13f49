import numpy as np
from pyspark.sql import functions as F

from folioflow.llm.topk import integer_vectors, top_inner_products

SCHEMA = "vec_id bigint, embedding array<float>"


def brute(ids, rows, queries, k):
    out = {}
    for q in queries:
        scores = sorted((-int(rows[q] @ rows[j]), ids[j]) for j in range(len(ids)) if ids[j] != ids[q])[:k]
        out[ids[q]] = [(v, -s) for s, v in scores]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


def test_matches_brute_force_with_copies_and_signs(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(400, 16)).astype(np.float32) * 0.2
    base[100:200] = base[7]
    base[200:220] = -np.abs(base[200:220])
    base[300:340, ::2] = 0
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    vectors = spark.createDataFrame(rows, SCHEMA).select("vec_id", integer_vectors(F.col("embedding")).alias("weights"))
    want = brute(list(range(400)), np.floor(base.astype(np.float64) * 256).astype(np.int64), range(0, 400, 10), 5)
    assert found(top_inner_products(vectors, vectors.where("vec_id % 10 = 0"), 5)) == want


def test_edge_rows(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [float("nan"), 1.0]), (3, [None, 1.0]), (4, [float("inf"), 0.0]), (5, []), (None, [1.0, 1.0])]
    vectors = spark.createDataFrame([*rows, (6, [0.5])], SCHEMA).select("vec_id", integer_vectors(F.col("embedding")).alias("weights"))
    got = found(top_inner_products(vectors, vectors.where("vec_id in (0, 1, 2)"), 5))
    assert got == {0: [(6, 128 * 256), (5, 0)]}
    assert top_inner_products(vectors.limit(0), vectors, 5).collect() == []
    assert top_inner_products(vectors, vectors.limit(0), 5).collect() == []
    alone = vectors.where("vec_id = 0")
    assert top_inner_products(alone, alone, 5).collect() == []
