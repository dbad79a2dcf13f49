import os
import random

import numpy as np
import pytest

from folioflow.llm import quality

SF = "/root/testdata/sf0.1"


def test_recovers_an_ordinal_scale():
    rng = np.random.default_rng(0)
    weights = rng.normal(size=40)
    rows, grades = [], []
    for _ in range(1500):
        r = np.sort(rng.choice(40, 12, replace=False))
        x = weights[r].sum() + rng.logistic()
        rows.append(r)
        grades.append(int(x > -1.5) + int(x > 1.5))
    model = quality.fit(rows, np.array(grades))
    assert model.thresholds[0] < model.thresholds[1]
    telling = model.weights[:40] != 0  # weak features stay out
    assert telling.sum() > 10 and np.corrcoef(model.weights[:40][telling], weights[telling])[0, 1] > 0.9
    tails = np.array([model.tails(r) for r in rows])
    assert (tails[:, 0] >= tails[:, 1]).all()
    assert abs(tails[:, 1].mean() - np.mean(np.array(grades) > 1)) < 0.05


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    held = labels.where("pmod(hash(doc_id), 4) = 0")
    model = quality.train(docs, labels.where("pmod(hash(doc_id), 4) <> 0"))
    rated = quality.rate(docs.join(held, "doc_id"), model).toPandas()
    clean = rated[(rated.quality == 1) & (rated.toxic == 0)]
    assert clean.keep.mean() > 0.97
    assert (~rated[rated.toxic == 1].keep).mean() > 0.85
    assert (~rated[(rated.quality == 0)].keep).mean() > 0.9


def test_edge_rows(spark, docs_frame):
    rng = random.Random(0)
    rows = [(i, " ".join(rng.choice("abcdefgh") for _ in range(9)) + (" bad" if i % 3 == 0 else " fine"), "x") for i in range(60)]
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(60)] + [(None, 1, 0), (5, None, None), (99, 1, 0), (4, 1, 0)], "doc_id bigint, quality int, toxic int")
    docs = docs_frame([*rows, (70, None, "n"), (None, "", None)], ", keep string").selectExpr("*", "1 AS grade", "'y' AS label_doc")
    model = quality.train(docs, labels)
    # Rows that repeat an id do not change the model, whatever their order.
    again = quality.train(docs.unionByName(docs).repartition(5), labels)
    assert np.array_equal(again.weights, model.weights) and np.array_equal(again.thresholds, model.thresholds)
    got = {r["doc_id"]: r for r in quality.rate(docs, model).collect()}
    assert all((r["grade"], r["label_doc"]) == (1, "y") for r in got.values())
    assert len(got) == 62 and all(0 <= r["expected_grade"] <= 2 for r in got.values())
    assert sum(got[i]["keep"] == (i % 3 != 0) for i in range(60)) >= 57
    empty = quality.train(docs.limit(0), labels)
    assert empty.thresholds[0] < empty.thresholds[1] and quality.rate(docs.limit(0), model).collect() == []
