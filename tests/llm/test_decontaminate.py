import hashlib
import random

import numpy as np

from folioflow.llm import decontaminate as dc


def brute(texts, items, window=10):
    def words(t):
        return dc.words_of(t)

    phrases = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            phrases.setdefault(tuple(w[i : i + window]), set()).add(str(item))
    out = []
    for t in texts:
        w, hit, found = words(t), set(), set()
        for n in {len(p) for p in phrases}:
            for i in range(len(w) - n + 1):
                owners = phrases.get(tuple(w[i : i + n]))
                if owners:
                    hit.update(range(i, i + n))
                    found |= owners
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((len(w), len(hit), len(found), digest, bool(hit)))
    return out


def case(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(12)] + ["É", "日本", "Don't"]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, say(rng.choice([1, 4, 12, 25]))) for i in range(1, 12)] + [(90, None), (91, "..."), (12, "w1 W2")]
    texts = []
    for _ in range(60):
        text = say(rng.randint(0, 60))
        if rng.random() < 0.5:
            text += ", " + (rng.choice(items)[1] or "").upper() + "! " + say(rng.randint(0, 9))
        texts.append(text)
    return texts, items


def test_matches_brute_force_in_one_and_in_several_passes(spark, docs_frame):
    texts, items = case(1)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    want = brute(texts, items)
    for options in ({}, {"shard_bytes": 200}, {"part_bytes": 150}):
        rows = dc.decontaminate(docs_frame(list(enumerate(texts))), bench, **options).collect()
        got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in rows}
        assert [got[i] for i in range(len(texts))] == want, options


def test_a_large_benchmark_takes_one_part_per_stage(spark, docs_frame):
    items = [(i, " ".join(f"w{i}x{k}" for k in range(12))) for i in range(60)]
    docs = docs_frame([(i, f"before {text} after") for i, text in items] + [(99, "clean")])
    df = dc.decontaminate(docs, spark.createDataFrame(items, "item_id bigint, text string"), part_bytes=150)
    assert sum(1 for _ in dc._benchmark_parts(spark.createDataFrame(items, "item_id bigint, text string"), 150)) >= 20
    # The last part's map and the one that cuts the spans out.
    assert df._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 2
    assert {r["doc_id"]: r["n_hit"] for r in df.collect()} == {i: 12 for i in range(60)} | {99: 0}


def test_spans_cut_what_is_hit_and_nothing_else(spark, docs_frame):
    passage = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"
    bench = spark.createDataFrame([(1, passage)], "item_id bigint, text string")
    text = f"É before; {passage.upper()}, {passage} after"
    row = dc.decontaminate(docs_frame([(1, text), (2, "quite clean")]), bench).orderBy("doc_id").collect()
    assert row[0]["clean_text"] == "É before;  after" and row[0]["n_hit"] == 22
    assert [text[s["start"] : s["end"]] for s in row[0]["spans"]] == [f"{passage.upper()}, {passage}"]
    assert row[1]["clean_text"] == "quite clean" and not row[1]["contaminated"]


def test_index_finds_all_places():
    rng = np.random.default_rng(0)
    text = np.concatenate((rng.integers(0, 4, 500), [0]))
    index = dc.FmIndex(text, sample=5)
    patterns = np.full((40, 4), -1)
    for p in patterns:
        n = rng.integers(1, 5)
        p[4 - n :] = rng.integers(1, 4, n)
    low, high = index.search(patterns)
    for p, lo, hi in zip(patterns, low, high):
        p = p[p >= 0]
        want = [i for i in range(len(text) - len(p) + 1) if (text[i : i + len(p)] == p).all()]
        assert sorted(index.locate(np.arange(lo, hi)).tolist()) == want


def test_edge_rows(spark, docs_frame):
    bench = spark.createDataFrame([(1, "one two"), (1, "one two"), (None, "x")], "item_id bigint, text string")
    rows = [(1, None, "a"), (None, "", "b"), (2, "ONE two three", "c"), (2, "ONE two three", "c")]
    # Columns of the operator's own names stay, those of its results are replaced.
    df = docs_frame(rows, ", spans string").selectExpr("*", "1 AS found_words", "'y' AS found_spans", "2 AS found_items")
    df = dc.decontaminate(df, bench)
    assert {(r["found_words"], r["found_spans"], r["found_items"]) for r in df.collect()} == {(1, "y", 2)}
    got = sorted((r["doc_id"] or 0, r["n_words"], r["n_hit"], r["n_items"], r["clean_text"]) for r in df.where("text is not null").collect())
    assert got == [(0, 0, 0, 0, ""), (2, 3, 2, 1, " three"), (2, 3, 2, 1, " three")]
    assert dc.decontaminate(docs_frame([]), bench).collect() == []
    assert dc.decontaminate(docs_frame([(1, "a b")]), bench.limit(0)).first()["n_hit"] == 0


def test_long_text(spark, docs_frame):
    bench = spark.createDataFrame([(1, " ".join(f"b{i}" for i in range(12)))], "item_id bigint, text string")
    text = "b1 b2 " * 100_000 + " ".join(f"b{i}" for i in range(12))
    assert dc.decontaminate(docs_frame([(1, text)]), bench).first()["n_hit"] == 12
