import random
from collections import defaultdict

from pyspark.sql import functions as F

from folioflow.llm import line_dedup


def brute(rows, min_chars=40, min_docs=5):
    def key(line):
        line = line.strip(" \t\n\x0b\x0c\r")
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line)

    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(doc)
    out = {}
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [l for l in lines if not (len(holders[key(l)]) >= min_docs and max(holders[key(l)]) != doc)]
        out[doc] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def test_matches_brute_force(docs_frame):
    rng = random.Random(2)
    shared = [f"A shared LINE number {i} that is long enough to count É" for i in range(12)]
    shared += [s.lower() + "  \t" for s in shared] + ["short line"] * 5 + [""] * 3
    rows = [(i, "\n".join(rng.choice(shared) if rng.random() < 0.5 else f"own {i} {j} " + "x" * 40 for j in range(9))) for i in range(80)]
    df = line_dedup.dedup_lines(docs_frame(rows))
    got = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept_text"]) for r in df.collect()}
    assert got == brute(rows)


def test_runs_are_disjoint_and_compacted(spark):
    runs = line_dedup.LineRuns(spark)
    for b in range(5):
        batch = [(f"k{i:02}", 1, 100 * b + i) for i in range(b, b + 10)]
        runs.add(spark.createDataFrame(batch, "line string, n_docs bigint, last_doc bigint"))
    lines = [r["line"] for run in runs.runs() for r in run.collect()]
    assert sorted(lines) == sorted(set(lines)) and len(lines) == 14
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    got = {r["line"]: r["last_doc"] for r in runs.repeated(5).collect()}
    assert got == {f"k{i:02}": 400 + i for i in range(4, 10)}


def test_no_python_in_the_plan(docs_frame):
    plan = line_dedup.dedup_lines(docs_frame([(1, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_edge_rows(docs_frame):
    line = "this very line is found in many documents indeed"
    rows = [(i, line, "x") for i in range(1, 5)] + [(4, line, "again"), (None, line, None), (8, None, "n"), (9, "", "e")]
    df = line_dedup.dedup_lines(docs_frame(rows, ", line string"))
    got = sorted((r["doc_id"] or -1, r["n_dropped"], r["kept_text"], r["line"] or "") for r in df.collect())
    assert got == [
        (-1, 1, "", ""), (1, 1, "", "x"), (2, 1, "", "x"), (3, 1, "", "x"), (4, 0, line, "again"), (4, 0, line, "x"),
        (8, 0, "", "n"), (9, 0, "", "e"),
    ]
    assert line_dedup.dedup_lines(docs_frame([])).collect() == []
    nulls = line_dedup.dedup_lines(docs_frame([(None, line)] * 5))
    assert nulls.agg(F.sum("n_dropped")).first()[0] == 0


def test_long_text(docs_frame):
    text = "\n".join(f"line {i} of a long text that goes on and on" for i in range(20_000))
    rows = line_dedup.dedup_lines(docs_frame([(i, text if i < 2 else text[:400]) for i in range(5)])).collect()
    assert sum(r["n_lines"] for r in rows) > 40_000
