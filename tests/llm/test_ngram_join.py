"""The n-gram join against all pairs compared in plain Python."""

import random
import re

import numpy as np
import pytest

from folioflow.llm import ngram_join as nj


def word_sets(text, size=4):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def brute_force(rows, percent=85):
    sets = [word_sets(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                root[top(i)] = top(j)
    low = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            low[top(i)] = min(doc_id, low.get(top(i), doc_id))
    return sorted((str(d), len(sets[i]), str(low.get(top(i)) if sets[i] else d)) for i, (d, _) in enumerate(rows))


def near_copies(rng, n, groups=6, words=90):
    vocabulary = [f"w{i}" for i in range(400)] + ["Ä", "The", "x y"]
    bases = [[rng.choice(vocabulary) for _ in range(rng.randrange(3, words))] for _ in range(groups)]
    out = []
    for i in range(n):
        text = list(rng.choice(bases))
        for _ in range(rng.randrange(4)):
            text[rng.randrange(len(text))] = rng.choice(vocabulary)
        if rng.random() < 0.2:
            text += rng.choice(bases)[:20]
        text = rng.choice([" ", "\n", "  "]).join(text)
        out.append((i, text.upper() if rng.random() < 0.1 else text))
    return out


def check(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    # Columns with names of the operator's own do not matter.
    docs = docs.selectExpr("*", "1 AS row", "'x' AS component_id", "2 AS token", "3 AS node", "4 AS set_key")
    out = nj.similar_documents(docs, **options)
    assert set(out.columns) == {"doc_id", "text", "row", "token", "node", "set_key", "n_shingles", "component_id"}
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in out.collect())
    assert got == brute_force(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_all_pairs(spark, seed):
    rng = random.Random(seed)
    rows = near_copies(rng, 220)
    rows += [(500, None), (501, ""), (502, " \n"), (503, "one two"), (504, "ONE  two"), (505, "x" * 50000), (None, rows[3][1])]
    rows += [rows[5], rows[5], (None, None), (None, "only here without an id"), (None, "only here without an id")]
    check(spark, rows)


def test_large_groups_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(nj, "BLOCK_ROWS", 40)
    rng = random.Random(9)
    check(spark, near_copies(rng, 260, groups=1, words=60))


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert nj.similar_documents(none).collect() == []
    blank = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sorted(map(tuple, nj.similar_documents(blank, carry=["doc_id"]).collect())) == [(1, 0, 1), (2, 0, 2)]


def test_similar_sets_share_prefix_tokens_in_every_order():
    rng = np.random.default_rng(4)
    levels = rng.integers(0, 4, nj.BUCKETS).astype(np.uint8)
    for _ in range(300):
        a = np.unique(rng.integers(0, 1 << 63, rng.integers(1, 200)).astype(np.uint64))
        gone = rng.random(len(a)) > rng.uniform(0.8, 1)
        b = np.unique(np.concatenate([a[~gone], rng.integers(0, 1 << 63, rng.integers(0, 12)).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if 100 * both >= 85 * (len(a) + len(b) - both):
            for order in (0, *nj.MORE_ORDERS):
                assert np.isin(nj.prefix(a, order, levels, 85), nj.prefix(b, order, levels, 85)).any()
            octets = min(len(nj.parity(a)), len(nj.parity(b)))
            differ = np.bitwise_count(nj.folded(nj.parity(a), octets) ^ nj.folded(nj.parity(b), octets)).sum()
            assert 185 * differ <= 15 * (len(a) + len(b))


def test_a_pair_is_reported_once():
    low = np.array([[3, 5, 9], [5, 7, 9], [1, 2, 4]])
    told = nj._reported(np.array([5, 9, 9]), low[[0, 0, 0]], low[[1, 1, 2]])
    assert told.tolist() == [True, False, True]


def test_shared_tokens_keeps_what_meets(spark):
    rows = [(i, [i % 7, 100 + i, 1000]) for i in range(60)]
    sets = spark.createDataFrame(rows, "row long, prefix array<bigint>").repartition(5)
    got = {(r.token, r.row) for r in nj.shared_tokens(sets).collect()}
    want = {(t, i) for i, p in rows for t in p if t < 100 or t == 1000}
    # Beyond those only rows at the ends of partitions may stay.
    assert want <= got and len(got - want) <= 2 * 8


def test_token_sets_are_the_shingles():
    rng = random.Random(3)
    texts = ["a b c d e a b c d", "one", "ÄB c\tD\x0be f", "", None, " \n", "x" * 9 + " " + "x" * 17 + " y z w"] + [t for _, t in near_copies(rng, 40)]
    for words in (1, 2, 4):
        sets = nj.token_sets(texts, words)
        assert [len(x) for x in sets] == [len(word_sets(t, words)) for t in texts]
        by_shingle = {}
        for text, tokens in zip(texts, sets, strict=True):
            assert np.array_equal(tokens, nj.token_sets([text], words)[0])
            for shingle in word_sets(text, words):
                by_shingle.setdefault(shingle, nj.token_sets([" ".join(shingle)], words)[0][0])
            assert sorted(by_shingle[g] for g in word_sets(text, words)) == tokens.tolist()
        assert len(set(by_shingle.values())) == len(by_shingle)
    assert nj.token_sets([], 4) == []


def test_folded_parity_is_that_of_fewer_bits():
    rng = np.random.default_rng(1)
    for n in (0, 3, 600, 5000):
        tokens = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        bits = nj.parity(tokens)
        assert 8 * len(bits) >= max(n, nj.PARITY)
        places = (nj._mixed(tokens, 99) % np.uint64(nj.PARITY)).astype(int)
        want = np.packbits(np.bincount(places, minlength=nj.PARITY) & 1 == 1)
        assert np.array_equal(nj.folded(bits, nj.PARITY // 8), want)
