"""Jaccard self-join of documents' word n-grams by prefix filters of multiple global orders.

Two sets of similarity t or more share a token among the first few of each, whatever global
order the tokens stand in. Here the orders put tokens of rare buckets first and
break ties by hashes of their own. The first order finds the candidates: its prefix tokens are
dealt out, tokens that stand alone are left behind, and those that meet are compared by size and by parity
bits of the whole sets, whose difference never exceeds that of the sets: first some, then as many as the sets have
tokens. Before what is left is verified it must share prefix tokens in the other orders, too.

Equal sets are one class from the start. First each class is verified with its nearest
candidates only; then all candidates that those links left in different components. So copies of one text never
meet in all pairs as rows, and no link between different texts is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow.llm.common import map_columns, without
from folioflow.llm.components import components
from folioflow.scale import broadcast_if_small, materialise

#: Buckets whose loads tell rare tokens from frequent ones; a byte each goes to the tasks, at any size.
BUCKETS = 1 << 20
#: Parts that the loads travel in.
LOAD_PARTS = 16
#: Orders beyond the first that a pair must pass.
MORE_ORDERS = (1, 2)
#: Parity bits of a set that travel with its tokens; the sieve has as many as the set has tokens, at least these.
PARITY = 512
#: Shared prefix tokens of a set that decide where a pair is reported.
LOWS = 8
#: Rows of a token that are compared by one task; larger groups are dealt out as pairs of blocks.
BLOCK_ROWS = 1024
#: Groups up to this size are compared together, row against row of the same distance.
SMALL_GROUP = 32
#: Rows that a task holds before it compares them; a group is never cut.
SEARCH_ROWS = 1 << 14


# -- sets and orders ------------------------------------------------------------------

_WHITE = np.zeros(256, dtype=bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_MASKS = np.array([0] + [(1 << 8 * k) - 1 for k in range(1, 9)], dtype=np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _joined(phrase: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of phrases with one more word each."""
    h = (phrase ^ (phrase >> np.uint64(31))) * _ODD + word
    return h ^ (h >> np.uint64(29))


def _word_hashes(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hashes of words of ``data``, eight bytes at a time; it ends with eight bytes more than its words."""
    window = np.ndarray((max(len(data) - 7, 0),), dtype="<u8", buffer=data, strides=(1,))
    h = size.astype(np.uint64)
    live, k = np.arange(len(begin)), 0
    while len(live):
        part = window[begin[live] + k] & _MASKS[np.minimum(size[live] - k, 8)]
        h[live] = _joined(h[live], part * _ODD)
        k += 8
        live = live[size[live] > k]
    return h


def token_sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    """The hashes of each text's different shingles, in order; of a text with fewer words, that of all of them."""
    raw = [(t or "").encode() for t in texts]
    data = _LOWER[np.frombuffer(b" ".join([*raw, b" " * 8]), dtype=np.uint8)]
    inside = ~_WHITE[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    edges = np.concatenate(([0], edges)) if inside[:1].any() else edges
    begin, end = edges[::2], edges[1::2]
    own = _word_hashes(data, begin, end - begin)
    grams = own
    for k in range(1, words):
        grams = _joined(grams[: max(len(own) - k, 0)], own[k:])
    cuts = np.searchsorted(begin, np.cumsum([0, *[len(r) + 1 for r in raw]]))
    out = []
    for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if high - low >= words:
            out.append(np.unique(grams[low : high - words + 1]))
        else:
            whole = own[low : low + 1]
            for k in range(low + 1, high):
                whole = _joined(whole, own[k : k + 1])
            out.append(whole[: high - low])
    return out


def _mixed(tokens: np.ndarray, order: int) -> np.ndarray:
    x = tokens + np.uint64((0x9E3779B97F4A7C15 * (order + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix(tokens: np.ndarray, order: int, levels: np.ndarray, percent: int) -> np.ndarray:
    """The first tokens of a sorted set in an order: as many as must meet those of any set that is similar enough."""
    n = len(tokens) - (percent * len(tokens) + 99) // 100 + 1
    if n >= len(tokens):
        return tokens
    level = levels[tokens & np.uint64(len(levels) - 1)].astype(np.uint64)
    key = (level << np.uint64(56)) | (_mixed(tokens, order) >> np.uint64(8))
    return tokens[np.argsort(key, kind="stable")[:n]]  # equal keys stay sorted by token


def parity(tokens: np.ndarray) -> bytes:
    """Whether an odd number of tokens falls on each of the bits: at least as many bits as tokens, a power of two."""
    bits = max(PARITY, 1 << int(len(tokens)).bit_length())
    places = (_mixed(tokens, 99) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(places, minlength=bits) & 1 == 1).tobytes()


def folded(bits: bytes, octets: int) -> np.ndarray:
    """Parity in fewer bits: the halves laid over each other."""
    out = np.frombuffer(bits, dtype=np.uint8)
    while len(out) > octets:
        out = out[: len(out) // 2] ^ out[len(out) // 2 :]
    return out


def token_levels(docs: DataFrame, words: int) -> np.ndarray:
    """Per bucket of tokens, how many bits the number of tokens of all documents in it has."""
    width = BUCKETS // LOAD_PARTS

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loads = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            sets = token_sets(batch.column(0).to_pylist(), words)
            tokens = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            loads += np.bincount((tokens & np.uint64(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS)
        parts = [zstandard.compress(x.tobytes(), 3) for x in loads.reshape(LOAD_PARTS, width)]
        yield pa.RecordBatch.from_arrays([pa.array(range(LOAD_PARTS), pa.int32()), pa.array(parts, pa.binary())], names=["part", "loads"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                loads = np.frombuffer(zstandard.decompress(raw), dtype=np.int64)
                sums[part] = sums.get(part, 0) + loads
        levels = [np.ceil(np.log2(x + 1)).astype(np.uint8).tobytes() for x in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(levels, pa.binary())], names=["part", "levels"])

    loads = docs.select("text").mapInArrow(load, "part int, loads binary")
    # One row per part, of a fixed size together.
    rows = loads.repartition(LOAD_PARTS, "part").mapInArrow(total, "part int, levels binary").collect()
    levels = {r.part: np.frombuffer(r.levels, dtype=np.uint8) for r in rows}
    return np.concatenate([levels.get(k, np.zeros(width, np.uint8)) for k in range(LOAD_PARTS)])


def _key(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def with_prefixes(docs: DataFrame, words: int, percent: int, levels) -> DataFrame:
    """Add set_key, n_shingles, parity (some bits), sieve (all) and the prefix of the first order."""

    def start():
        table = levels.value

        def step(texts):
            sets = token_sets(texts, words)
            sieves = [parity(x) for x in sets]
            firsts = [prefix(x, 0, table, percent).view(np.int64) for x in sets]
            ends = np.concatenate(([0], np.cumsum([len(x) for x in firsts])))
            return [
                pa.array([_key(x) for x in sets], pa.binary()),
                pa.array([len(x) for x in sets], pa.int64()),
                pa.array([folded(x, PARITY // 8).tobytes() for x in sieves], pa.binary()),
                pa.array(sieves, pa.binary()),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(firsts), pa.int64())),
            ]

        return step

    schema = "set_key binary, n_shingles bigint, parity binary, sieve binary, prefix array<bigint>"
    return map_columns(docs, ["text"], schema, start, drop=("text",))


# -- candidates -----------------------------------------------------------------------


def shared_tokens(sets: DataFrame) -> DataFrame:
    """(token, row) of the prefix tokens that several rows have.

    The rows are sorted by token over all tasks, a token of very many rows over several of them; each
    looks at its neighbours. At the ends of a partition the neighbour is not seen: these rows stay.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last row of a batch is judged with the next batch.
        token, row, alike = np.zeros(0, np.int64), np.zeros(0, np.int64), True
        for batch in batches:
            if not batch.num_rows:
                continue
            token = np.concatenate([token, batch.column(0).to_numpy()])
            row = np.concatenate([row, batch.column(1).to_numpy()])
            same = token[1:] == token[:-1]
            keep = np.concatenate(([alike], same[:-1])) | same if len(token) > 1 else np.zeros(0, bool)
            yield pa.RecordBatch.from_arrays([pa.array(token[:-1][keep]), pa.array(row[:-1][keep])], names=["token", "row"])
            alike = bool(same[-1]) if len(same) else alike
            token, row = token[-1:], row[-1:]
        yield pa.RecordBatch.from_arrays([pa.array(token), pa.array(row)], names=["token", "row"])

    rows = sets.select(F.explode("prefix").alias("token"), "row")
    return rows.repartitionByRange("token", "row").sortWithinPartitions("token", "row").mapInArrow(run, "token bigint, row bigint")


def _reported(token: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Is this token the first that both lists of low tokens have, or is there none?"""
    common = (a[:, :, None] == b[:, None, :]).any(axis=2)
    first = np.where(common, a, np.iinfo(np.int64).max).min(axis=1)
    return ~common.any(axis=1) | (first == token)


class _Group:
    """Rows of tokens as arrays, sorted by group and size; finds those that may be similar."""

    def __init__(self, rows: pa.Table, percent: int):
        self.percent = percent
        self.token, self.part, self.block, self.node, self.n, self.label = (
            rows[c].to_numpy() for c in ("token", "part", "block", "node", "n_shingles", "label")
        )
        self.bits = np.frombuffer(b"".join(rows["parity"].to_pylist()), dtype=np.uint64).reshape(-1, PARITY // 64)
        self.rows = rows
        edge = np.ones(len(self.token), dtype=bool)
        edge[1:] = (self.token[1:] != self.token[:-1]) | (self.part[1:] != self.part[:-1])
        self.first = np.flatnonzero(edge)
        self.size = np.diff(np.append(self.first, len(edge)))
        self.group = np.cumsum(edge) - 1

    def _lows(self, at: np.ndarray) -> np.ndarray:
        flat = self.rows["lows"].combine_chunks()
        return flat.take(pa.array(at)).flatten().to_numpy().reshape(-1, LOWS)

    def alike(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Those pairs of places that pass, and the bits that differ; ``b`` is not smaller than ``a``."""
        split = self.part[a] >= 0  # a pair of blocks: only across them, or within the one block
        fits = (100 * self.n[a] >= self.percent * self.n[b]) & (self.label[a] != self.label[b])
        fits &= ~split | (self.block[a] != self.block[b]) | (self.part[a] % (1 << 31) == self.part[a] >> 31)
        a, b = a[fits], b[fits]
        differ = np.bitwise_count(self.bits[a] ^ self.bits[b]).sum(axis=1, dtype=np.int64)
        # |x - y| + |y - x| <= (1 - t) / (1 + t) * (|x| + |y|)
        near = (100 + self.percent) * differ <= (100 - self.percent) * (self.n[a] + self.n[b])
        return a[near], b[near], differ[near]

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        small = self.size[self.group] <= SMALL_GROUP
        for gap in range(1, min(int(self.size.max(initial=0)), SMALL_GROUP)):
            a = np.flatnonzero(small[:-gap] & (self.group[gap:] == self.group[:-gap]))
            yield self.alike(a, a + gap)
        for g in np.flatnonzero(self.size > SMALL_GROUP).tolist():
            start, end = int(self.first[g]), int(self.first[g] + self.size[g])
            most = np.searchsorted(self.n[start:end] * self.percent, 100 * self.n[start:end], "right") + start
            for at in range(start, end, 64):
                own = np.arange(at, min(at + 64, end))
                counts = np.maximum(most[own - start] - own - 1, 0)
                a = np.repeat(own, counts)
                b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(counts) - counts, counts)
                yield self.alike(a, b)


def _nearest(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """For every place the pair with the fewest bits that differ."""
    a, b, differ = (np.concatenate(x) for x in zip(*found, strict=True))
    place = np.concatenate([a, b])
    order = np.lexsort((np.concatenate([b, a]), np.concatenate([differ, differ]), place))
    first = np.ones(len(order), dtype=bool)
    first[1:] = place[order][1:] != place[order][:-1]
    chosen = np.unique(order[first] % len(a))
    return a[chosen], b[chosen]


def candidates(nodes: DataFrame, percent: int, nearest: bool) -> DataFrame:
    """Pairs (src, dst) of nodes with different labels that share a token and may be similar.

    ``nodes`` has (node, n_shingles, parity, tokens, lows, label). With ``nearest`` only the nearest one of each node
    and token, else all.
    """
    rows = nodes.select("node", "n_shingles", "parity", "label", "lows", F.explode("tokens").alias("token"))
    large = nodes.select(F.explode("tokens").alias("hot")).groupBy("hot").agg(F.count(F.lit(1)).alias("rows"))
    large = materialise(large.where(F.col("rows") > BLOCK_ROWS).select("hot", F.ceil(F.col("rows") / BLOCK_ROWS).alias("blocks")), "large-tokens")
    block = F.pmod(F.xxhash64("node"), F.col("blocks"))
    other = F.explode(F.expr("CASE WHEN blocks IS NULL THEN array(-1L) ELSE sequence(0L, blocks - 1) END"))
    dealt = rows.join(broadcast_if_small(large), F.col("token") == F.col("hot"), "left")
    dealt = dealt.withColumn("block", F.coalesce(block, F.lit(-1)).cast("long")).select("*", other.alias("other"))
    part = F.when(F.col("other") < 0, F.lit(-1)).otherwise(
        F.shiftleft(F.least("block", "other"), 31) + F.greatest("block", "other")
    )
    dealt = dealt.select("token", part.cast("long").alias("part"), "block", "n_shingles", "node", "label", "parity", "lows")
    dealt = dealt.repartition("token", "part").sortWithinPartitions("token", "part", "n_shingles", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def searched(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            group = _Group(rows.combine_chunks(), percent)
            found = [x for x in group.pairs() if len(x[0])]
            if not found:
                return
            if nearest:
                a, b = _nearest(found)
            else:
                a, b = (np.concatenate(x) for x in list(zip(*found, strict=True))[:2])
                told = _reported(group.token[a], group._lows(a), group._lows(b))
                a, b = a[told], b[told]
            src, dst = np.minimum(group.node[a], group.node[b]), np.maximum(group.node[a], group.node[b])
            yield pa.RecordBatch.from_arrays([pa.array(src), pa.array(dst)], names=["src", "dst"])

        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(x.num_rows for x in held) >= SEARCH_ROWS:
                whole = pa.Table.from_batches(held).combine_chunks()
                token, part = whole["token"].to_numpy(), whole["part"].to_numpy()
                edges = np.flatnonzero((token[1:] != token[:-1]) | (part[1:] != part[:-1]))
                cut = int(edges[-1]) + 1 if len(edges) else 0  # the last group may go on
                held = whole.slice(cut).to_batches()
                if cut:
                    yield from searched(whole.slice(0, cut))
        if held:
            yield from searched(pa.Table.from_batches(held))

    return dealt.mapInArrow(run, "src bigint, dst bigint").distinct()


# -- verification ---------------------------------------------------------------------


def sieved(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (src, dst) whose parity differs in no more bits than similar sets may differ in tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for m, n, x, y in zip(*(batch.column(k).to_pylist() for k in range(2, 6)), strict=True):
                octets = min(len(x), len(y))
                differ = int(np.bitwise_count(folded(x, octets) ^ folded(y, octets)).sum(dtype=np.int64))
                keep.append((100 + percent) * differ <= (100 - percent) * (m + n))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    sides = {
        k: classes.select(F.col("node").alias(f"node_{k}"), F.col("n_shingles").alias(f"n_{k}"), F.col("sieve").alias(f"sieve_{k}"))
        for k in "ab"
    }
    met = pairs.join(sides["a"], F.col("src") == F.col("node_a")).join(sides["b"], F.col("dst") == F.col("node_b"))
    return met.select("src", "dst", "n_a", "n_b", "sieve_a", "sieve_b").mapInArrow(run, "src bigint, dst bigint")


def verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, words: int, percent: int, levels) -> DataFrame:
    """Those of the pairs (src, dst) that share prefix tokens in the further orders and are similar by their whole sets."""
    pairs = materialise(sieved(pairs, classes, percent), "sieved-candidates")
    nodes = materialise(pairs.select(F.explode(F.array("src", "dst")).alias("wanted")).distinct(), "wanted-sets")
    wanted = materialise(
        classes.join(nodes, F.col("node") == F.col("wanted")).select("node", F.col("set_key").alias("key"), F.col("its_doc").alias("wanted_doc")),
        "wanted-documents",
    )
    ids = broadcast_if_small(wanted.select("wanted_doc").distinct())
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        ids, F.col("doc_id").eqNullSafe(F.col("wanted_doc")), "left_semi"
    )

    def start():
        def step(values):
            sets = token_sets(values, words)
            return [pa.array([_key(x) for x in sets], pa.binary()), pa.array([x.tobytes() for x in sets], pa.binary())]

        return step

    sets = map_columns(texts.select("text"), ["text"], "set_key binary, tokens binary", start, drop=("text",))
    keys = broadcast_if_small(wanted.select("node", "key"))
    met = sets.join(keys, F.col("set_key") == F.col("key")).select("node", "tokens", F.monotonically_increasing_id().alias("copy"))
    met = materialise(met, "wanted-tokens")
    # Rows without an id, or of a repeated one, may bring a set several times: one of them stays.
    one = met.groupBy("node").agg(F.min("copy").alias("first_copy"))
    own = met.join(broadcast_if_small(one.select("first_copy")), F.col("copy") == F.col("first_copy"), "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, held = levels.value, {}

        def read(node: int, raw: bytes) -> tuple[np.ndarray, list[np.ndarray]]:
            if node not in held:
                if len(held) >= 64:
                    held.clear()
                tokens = np.frombuffer(raw, dtype=np.uint64)
                held[node] = tokens, [prefix(tokens, k, table, percent) for k in MORE_ORDERS]
            return held[node]

        for batch in batches:
            keep = []
            for src, dst, x, y in zip(*(batch.column(k) for k in range(4)), strict=True):
                (a, firsts_a), (b, firsts_b) = read(src.as_py(), x.as_py()), read(dst.as_py(), y.as_py())
                meet = all(np.isin(p, q, assume_unique=True).any() for p, q in zip(firsts_a, firsts_b, strict=True))
                both = len(np.intersect1d(a, b, assume_unique=True)) if meet else 0
                keep.append(meet and 100 * both >= percent * (len(a) + len(b) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    left, right = (own.select(F.col("node").alias(f"node_{k}"), F.col("tokens").alias(f"tokens_{k}")) for k in "ab")
    met = pairs.join(left, F.col("src") == F.col("node_a")).join(right, F.col("dst") == F.col("node_b"))
    return met.select("src", "dst", "tokens_a", "tokens_b").mapInArrow(run, "src bigint, dst bigint")


def similar_documents(docs: DataFrame, words: int = 4, percent: int = 85, carry: list[str] | None = None) -> DataFrame:
    """Add ``n_shingles`` and ``component_id`` to documents, replacing columns of these names.

    A document's set holds its distinct shingles of ``words`` words (with fewer words, all of them as one). Two documents are linked
    if the Jaccard similarity of their sets is at least ``percent`` per cent; ``component_id`` is the smallest ``doc_id`` that
    links reach, the own one included, and null where only documents without an id are reached. A-Z are lower-cased and words end at
    ASCII white space; null, empty and blank texts have an empty set and are linked with nothing. Repeated rows and equal sets are linked like
    any others. Keeps every row and the columns named by ``carry`` (default: all). An empty table gives an empty table.
    """
    docs = without(docs, ["n_shingles", "component_id"])
    carry = docs.columns if carry is None else carry
    spark = docs.sparkSession
    levels = spark.sparkContext.broadcast(token_levels(docs, words))
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("own"), F.col("doc_id").cast("long").alias("id"), "text")
    sets = with_prefixes(own, words, percent, levels).withColumn("row", F.monotonically_increasing_id())
    sets = materialise(sets, "document-prefixes")  # the row numbers are stored before anything refers to them

    filled = sets.where("n_shingles > 0")
    classes = filled.groupBy("set_key").agg(
        F.min(F.struct("row", "id")).alias("first"), F.min("id").alias("smallest"),
        F.first("n_shingles").alias("n_shingles"), F.first("parity").alias("parity"), F.first("sieve").alias("sieve"),
    )
    classes = materialise(classes.select("*", F.col("first.row").alias("node"), F.col("first.id").alias("its_doc")), "document-classes")
    shared = materialise(shared_tokens(filled), "shared-tokens")
    nodes = shared.join(classes.select("node", "n_shingles", "parity"), F.col("row") == F.col("node")).groupBy("node").agg(
        F.first("n_shingles").alias("n_shingles"), F.first("parity").alias("parity"), F.sort_array(F.collect_list("token")).alias("tokens")
    )
    # What fills a short list of low tokens is a hash of the node's own: it must not count as shared.
    low = F.slice("tokens", 1, LOWS)
    fill = F.array(*[F.xxhash64("node", F.lit(i)) for i in range(LOWS)])
    nodes = materialise(nodes.withColumn("lows", F.slice(F.concat(low, fill), 1, LOWS)), "token-nodes")

    some = materialise(candidates(nodes.withColumn("label", F.col("node")), percent, True), "nearest-candidates")
    sure = materialise(verified(some, docs, classes, words, percent, levels), "nearest-links")
    linked = components(sure).withColumnRenamed("node", "linked")
    labelled = nodes.join(linked, F.col("node") == F.col("linked"), "left").withColumn("label", F.coalesce("root", "node"))
    rest = candidates(labelled, percent, False).join(some, ["src", "dst"], "left_anti")
    rest = materialise(rest, "other-candidates")
    links = sure.unionByName(materialise(verified(rest, docs, classes, words, percent, levels), "other-links"))

    reached = components(links).withColumnRenamed("node", "linked")
    grouped = materialise(classes.join(reached, F.col("node") == F.col("linked"), "left").select("set_key", "smallest", "root"), "linked-classes")
    lowest = grouped.where("root IS NOT NULL").groupBy(F.col("root").alias("top")).agg(F.min("smallest").alias("lowest"))
    named = grouped.join(lowest, F.col("root") == F.col("top"), "left").select(
        F.col("set_key").alias("key"), F.coalesce("lowest", "smallest").alias("found")
    )
    named = materialise(named, "document-components")
    empty = F.col("n_shingles") == 0
    out = sets.join(named, (F.col("set_key") == F.col("key")) & ~empty, "left")
    return out.select("own.*", "n_shingles", F.when(empty, F.col("id")).otherwise(F.col("found")).alias("component_id"))
