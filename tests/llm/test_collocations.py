"""Collocations against a count of all phrases in plain Python."""

import random
import re
from collections import Counter

import pytest

from folioflow.llm import collocations as co


def brute_force(rows, min_count, longest, top, cover):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, longest + 1):
                f.update((lang, tuple(words[i : i + size])) for i in range(len(words) - size + 1))
    kept = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= min_count}
    out = []
    for (lang, p), a in kept.items():
        score, _, left, right = min(
            (2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p))
        )
        inside = any(
            x == lang and len(q) > len(p) and 100 * b >= cover * a and any(q[i : i + len(p)] == p for i in range(len(q)))
            for (x, q), b in kept.items()
        )
        if not inside:
            out.append((lang, " ".join(p), a, left, right, n[lang], score))
    got = []
    for lang in n:
        own = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        got += [(lang, i + 1, *r[1:]) for i, r in enumerate(own[:top])]
    return sorted(got)


def corpus(rng, n):
    words = ["of", "the", "The", "a", "b", "c", "süß", "x1", "new", "york", "city", "é", "　", "q r", "😀"]
    marks = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "\r", "? "]
    rows = []
    for _ in range(n):
        text = "".join(rng.choice(words) + rng.choice(marks) for _ in range(rng.randrange(40)))
        if rng.random() < 0.3:
            text += " in the city of new york "
        rows.append((rng.choice(["en", "de", None, "und", ""]), rng.choice([text, text, text, None, ""])))
    return rows + [("en", "to be or not to be " * 20), ("en", "to be or not to be " * 20), ("rare", "once only")]


@pytest.mark.parametrize("share", [1 / 8, 1.0, 1e-6])
def test_every_sample_gives_the_exact_result(spark, share):
    rows = corpus(random.Random(7), 250)
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "lang string, text string, phrase int, a int").repartition(3)
    got = co.collocations(docs, min_count=5, top=40, share=share)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == brute_force(rows, 5, 4, 40, 80)


def test_a_failing_border_is_expanded(spark, monkeypatch):
    """Nothing is proposed: words are counted first, and one more pass counts two, three and four of them."""
    passes = []
    count = co.count_phrases
    monkeypatch.setattr(co, "count_phrases", lambda *a: passes.append(a[1]) or count(*a))
    docs = spark.createDataFrame([("en", "one two three four five")] * 6, "lang string, text string")
    found = co.frequent_phrases(docs, 5, 4, share=0.0).where("size > 0").collect()
    assert len(found) == 5 + 4 + 3 + 2 and {r.a for r in found} == {6}
    assert passes == [[1], [2], [3], [0, 1, 2, 3, 4], [2, 3, 4]]
    passes.clear()
    assert co.frequent_phrases(docs, 5, 4, share=1.0).where("size > 0").count() == 14
    assert passes == [[1], [2], [3], [0, 1, 2, 3, 4]]


def test_rare_phrases_of_frequent_words_are_not_counted_by_their_text(spark, monkeypatch):
    counted = []
    count = co.count_phrases
    monkeypatch.setattr(co, "count_phrases", lambda *a: counted.append(count(*a)) or counted[-1])
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(60)}" for _ in range(40)) + ". in the city" for _ in range(100)]
    docs = spark.createDataFrame([("en", t) for t in texts], "lang string, text string").repartition(4)
    found = co.frequent_phrases(docs, 20, 4, share=1.0)
    words = Counter(w for t in texts for w in re.findall(r"\w+", t))
    assert {r.phrase: r.a for r in found.where("size = 1").collect()} == {w: n for w, n in words.items() if n >= 20}
    assert {r.phrase for r in found.where("size > 1").collect()} == {"in the", "the city", "in the city"}
    passed = counted[-1].where("phrase LIKE '% %'").count()
    assert passed < 20  # of more than two thousand pairs; a few may share bits with others


def test_long_texts_are_cut_between_pieces(monkeypatch):
    monkeypatch.setattr(co, "CHUNK", 10)
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"lang": ["en"], "text": ["aa bb cc dd ee. ff gg hh ii jj, kk"]})
    assert list(co._chunks(iter([batch]))) == [("en", [b"aa bb cc dd ee"]), ("en", [b". ff gg hh ii jj"]), ("en", [b", kk"])]


def test_filter_has_all_members():
    import numpy as np

    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 1 << 63, 1000).astype(np.uint64)
    bits = np.zeros(1 << 10, dtype=np.uint64)
    for slot in co.Filter.slots(hashes, 1 << 16):
        np.bitwise_or.at(bits, (slot >> np.uint64(6)).astype(np.int64), np.uint64(1) << (slot & np.uint64(63)))
    made = co.Filter(bits)
    assert made.has(hashes).all()
    assert made.has(rng.integers(0, 1 << 63, 10000).astype(np.uint64)).mean() < 0.01


def test_empty_table(spark):
    none = spark.createDataFrame([], "lang string, text string")
    assert co.collocations(none).collect() == []
    blank = spark.createDataFrame([(None, None), ("en", "  . ")], "lang string, text string")
    assert co.collocations(blank).collect() == []
