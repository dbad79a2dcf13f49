import random

import numpy as np
import xxhash

from folioflow.llm import simhash
from folioflow.llm.components import components


def brute_fingerprint(text, k):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius):
    """prints: list of (doc_id, number); smallest doc_id reachable by links."""
    label = list(range(len(prints)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= radius:
                label[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(prints):
        least[root(i)] = min(doc, least.get(root(i), doc))
    return {doc: least[root(i)] for i, (doc, _) in enumerate(prints)}


def texts(n, seed=3):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(300)] + ["É", "Straße", "日本"]
    out = []
    for i in range(n):
        if out and rng.random() < 0.5:
            base = rng.choice(out).split(" ")
            base[rng.randrange(len(base))] = rng.choice(words)
            out.append(" ".join(base))
        else:
            out.append(" ".join(rng.choice(words) for _ in range(rng.choice([1, 2, 3, 40, 400]))))
    return out


def test_fingerprints_and_components_match_brute_force(docs_frame):
    rows = list(enumerate(texts(250)))
    got = {r["doc_id"]: r for r in simhash.near_duplicates(docs_frame(rows)).collect()}
    prints = [(i, brute_fingerprint(t, 3)) for i, t in rows]
    assert {i: int(got[i]["fingerprint"], 16) for i, _ in rows} == dict(prints)
    assert {i: got[i]["component_id"] for i, _ in rows} == brute_components(prints, 2)


def test_gray_rank_inverts_and_steps_by_one_bit():
    bits = np.unpackbits(np.random.default_rng(0).integers(0, 256, (50, 8), dtype=np.uint8), axis=1)
    assert (simhash.gray_codes(simhash.gray_ranks(bits)) == bits).all()
    ranks = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1)
    codes = simhash.gray_codes(ranks)
    assert ((codes[1:] ^ codes[:-1]).sum(axis=1) == 1).all()


def test_large_group_search_links_the_same_classes():
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 2**63, 12, dtype=np.uint64)
    codes = []
    for _ in range(900):
        c = int(rng.choice(centres))
        for b in rng.integers(0, 64, rng.integers(0, 5)):
            c ^= 1 << int(b)
        codes.append(c)
    codes = np.unique(np.array(codes, dtype=np.uint64))
    bits = np.unpackbits(codes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    order = np.lexsort(simhash.gray_ranks(bits).T[::-1])
    codes = codes[order]
    for radius in (2, 6):
        labels = list(range(len(codes)))

        def root(x):
            while labels[x] != x:
                x = labels[x]
            return x

        for a, b in simhash._search_group(codes[:, None], radius):
            assert (int(codes[a]) ^ int(codes[b])).bit_count() <= radius
            labels[root(a)] = root(b)
        got = {i: root(i) for i in range(len(codes))}
        want = brute_components([(i, int(c)) for i, c in enumerate(codes)], radius)
        classes = lambda d: sorted(sorted(k for k in d if d[k] == v) for v in set(d.values()))
        assert classes(got) == classes(want)


def test_components_of_chains_hubs_and_loops(spark):
    chain = [(f"c{i:03}", f"c{i + 1:03}") for i in range(60)]
    hub = [("h", f"l{i}") for i in range(50)] + [("l3", "h"), ("z", "z")]
    rows = components(spark.createDataFrame(chain + hub, "src string, dst string")).collect()
    got = {r["node"]: r["root"] for r in rows}
    assert len(got) == len(rows)
    assert {got[f"c{i:03}"] for i in range(61)} == {"c000"}
    assert {got[x] for x in ["h", *(f"l{i}" for i in range(50))]} == {"h"}


def test_edge_rows(docs_frame):
    rows = [(5, None, "x"), (3, "", "y"), (9, " \t\n", "z"), (None, "a b c d", None), (7, "a b c d", "q"), (7, "a b c d", "q")]
    df = simhash.near_duplicates(docs_frame(rows, ", component_id string"))
    got = {(r["doc_id"], r["fingerprint"] == "0" * 16, r["component_id"]) for r in df.collect()}
    assert got == {(5, True, 3), (3, True, 3), (9, True, 3), (None, False, 7), (7, False, 7)}
    assert df.count() == 6
    assert simhash.near_duplicates(docs_frame([])).collect() == []
    assert simhash.one_of_each(docs_frame(rows, ", print string")).count() == 2
    assert simhash.one_of_each(docs_frame([])).collect() == []


def test_one_of_each_group_stays(docs_frame):
    rows = list(enumerate(texts(250, seed=5))) + [(400, "a row that stands here twice")] * 2 + [(None, "w1 w2 nobody's"), (None, "w1 w2 nobody's")]
    random.Random(1).shuffle(rows)
    df = docs_frame(rows)
    groups = {}
    for r in simhash.near_duplicates(df).collect():
        groups.setdefault(r["component_id"], []).append(r["doc_id"])
    kept = [r["doc_id"] for r in simhash.one_of_each(docs_frame(rows, "")).collect()]
    assert sorted(str(k) for k in kept if k is not None) == sorted(str(g) for g in groups if g is not None)
    assert kept.count(None) == (1 if None in groups else 0)


def test_large_groups_are_dealt_out_in_blocks_and_lose_nothing(spark):
    rng = np.random.default_rng(8)
    codes = {int(x) << 8 for x in rng.integers(0, 2**8, 100)} | {1 << int(a) | 1 << int(b) for a, b in rng.integers(0, 32, (120, 2))}
    codes = sorted(codes)
    prints = spark.createDataFrame([(f"{c:016x}",) for c in codes], "print string")
    scheme = simhash.exact_scheme()
    dealt = simhash._dealt(prints, scheme)
    sizes = simhash._placed(dealt, dealt, 40).groupBy("table_no", "lead", "part").count()
    assert sizes.agg({"count": "max"}).first()[0] <= 120 < len(codes)
    want = brute_components(list(enumerate(codes)), scheme.radius)
    label = list(range(len(codes)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for r in simhash.links(prints, scheme, 40).collect():
        a, b = root(codes.index(int(r["src"], 16))), root(codes.index(int(r["dst"], 16)))
        label[max(a, b)] = min(a, b)
    assert {i: root(i) for i in range(len(codes))} == want
