"""The filter audit against a count in plain Python, order by order."""

import random
import re
from itertools import permutations

import pytest

from folioflow.llm import filter_audit as fa

RESULT = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def counted(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return [len(words), len(set(words)), len(re.findall("[A-Z]", text)), len(text), len(re.findall(r"[#$%&*|]", text))]


def brute_force(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    first = {}
    for i, _, text in rows:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    docs = []
    for i, lang, text in rows:
        w, d, c, n, s = counted(text or "")
        fails = {x for x, bad in zip("ABCD", (w < 200, 100 * d < 50 * w, 100 * c > 3 * n, s > 0)) if bad}
        if i is not None and i > first[text or ""]:
            fails.add("E")
        docs.append((lang or "", i in good, i in toxic, fails))
    out = {}
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        removed = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            for k, x in enumerate(order):
                before = set(order[:k])
                here = [d for d in own if x in d[3] and not d[3] & before]
                removed[x] += len(here)
                out[part, "".join(order), k + 1] = [
                    sum(not d[3] & (before | {x}) for d in own), len(here), sum(x in d[3] and bool(d[3] & before) for d in own),
                    sum(d[3] == {x} for d in own), sum(d[1] for d in here), sum(d[2] for d in here),
                ]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(removed[order[step - 1]])
    return out


def text_like(rng):
    kinds = ["Ab", "ab", "Ñ", "\n", " ", "\t", "#", "a" * 9, "b" * 300, "　", "Z", "😀", "w%d " % rng.randrange(500)]
    return "".join(rng.choice(kinds) for _ in range(rng.randrange(700)))


@pytest.mark.parametrize("block", [64, 1000, 1 << 18])
def test_measures_in_blocks_of_any_size(monkeypatch, block):
    monkeypatch.setattr(fa, "BLOCK", block)
    rng = random.Random(block)
    long = ["x" * 5000 + " " + "x" * 5000 + " " + "x" * 4999 + "y", "q" * 600 + "a" + "q" * 600 + " " + "q" * 600 + "b" + "q" * 600]
    texts = ["", "  ", "a", "A A a", *long, *[text_like(rng) for _ in range(120)]]
    want = [counted(t) for t in texts]
    assert fa._measure([memoryview(t.encode()) for t in texts]).tolist() == want
    assert [fa._measure([memoryview(t.encode())]).tolist()[0] for t in texts] == want


def test_words_whose_hashes_meet_are_told_apart(monkeypatch):
    monkeypatch.setattr(fa.WordTable, "_digests", lambda self, doc, begin, size: (size % 2).astype("uint64"))
    text = " ".join(f"w{i % 300}" for i in range(2000))
    assert fa._measure([memoryview(text.encode()), memoryview(text.encode())]).tolist() == [counted(text)] * 2


def test_every_order_matches_brute_force(spark):
    rng = random.Random(5)
    texts = [text_like(rng) for _ in range(40)] + ["", "same text"]
    rows = [(rng.choice([None, *range(150)]), rng.choice(["en", "de", None, ""]), rng.choice([None, *texts])) for _ in range(300)]
    rows += [(7, "en", "same text"), (7, "en", "same text"), (3, "de", "same text")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 150, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(3)
    # Columns with names of the operator's own do not matter.
    docs = docs.selectExpr("*", "1 AS mask", "'x' AS text_key", "2 AS n_words", "0 AS part")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {(r.part, r.filter_order, r.step): [r[c] for c in RESULT] for r in fa.audit(docs, marks).collect()}
    assert got == brute_force(rows, labels)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, lang string, text string")
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert fa.audit(none, marks).collect() == []
    one = spark.createDataFrame([(1, None, None)], "doc_id long, lang string, text string")
    rows = fa.audit(one, marks).collect()
    assert len(rows) == 600 and {r.part for r in rows} == {""}
    assert sum(r.removed for r in rows) == 120 and {r.shapley for r in rows if r.filter_order[r.step - 1] == "A"} == {120}
