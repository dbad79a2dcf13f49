"""SimHash near-duplicates by a Gray-order hierarchical index.

Fingerprints that differ in few bits agree in some of several fixed choices of bits. For
each choice (a table) a fingerprint's chosen bits are moved to the front and the whole is
read as a Gray code; its rank orders the fingerprints so that neighbours share long masked
patterns, and those with the same chosen bits stand together. Spark deals the tables out by
chosen bits and sorts each part by Gray rank. Over each group a tree is built whose upper
nodes hold the bits all members share; a search adds up the differences on the way
down and leaves a node, with its whole group, when the sum exceeds the radius or when
everything below is linked already. Only links that join something new leave the task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm.common import free_names, map_columns, without
from folioflow.llm.components import components
from folioflow.scale import broadcast_if_small, materialise

#: Shingles voted on at a time; bounds the memory a long text needs.
BLOCK = 1 << 14
#: Rows a task holds at least before it searches; groups, or pairs of a large group's blocks, are never cut.
SEARCH_ROWS = 1 << 15
#: Groups of more rows are dealt out as pairs of blocks of about so many.
BLOCK_ROWS = 1 << 15
#: Groups up to this size are compared neighbour by neighbour, larger ones through a tree.
SMALL_GROUP = 32
#: Pairs of a query and a node looked at together; bounds a search's memory.
FRONTIER = 1 << 14
#: Members of a node.
FAN_OUT = 16


@dataclass(frozen=True)
class Scheme:
    """How fingerprints are made and compared.

    ``tables`` lists the bits (0: the first) that lead in each table. With ``lanes`` of
    64 bits each, a pair within ``radius`` bits is found if it agrees in all bits of a table.
    """

    shingle: int
    lanes: int
    radius: int
    tables: tuple[tuple[int, ...], ...]

    @property
    def bits(self) -> int:
        return 64 * self.lanes


def exact_scheme(shingle: int = 3, radius: int = 2, blocks: int = 4) -> Scheme:
    """64 bits in blocks; pairs within the radius agree in ``blocks - radius`` of them, so none is missed."""
    width = 64 // blocks
    tables = [
        tuple(b for k in chosen for b in range(k * width, (k + 1) * width))
        for chosen in combinations(range(blocks), blocks - radius)
    ]
    return Scheme(shingle, 1, radius, tuple(tables))


def _lane(hashes: np.ndarray, lane: int) -> np.ndarray:
    """Further 64-bit hashes of the same shingles; lane 0 is the hash itself."""
    if not lane:
        return hashes
    x = hashes + np.uint64(0x9E3779B97F4A7C15 * lane & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _shingle_hashes(text: str | None, shingle: int) -> Iterator[np.ndarray]:
    """64-bit hashes of all word shingles, a block at a time."""
    words = text.encode().lower().split() if text else []
    if not words:
        return
    joined, digest = b" ".join(words), xxhash.xxh64_digest
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    first, last = starts[:n].tolist(), ends[len(words) - n :].tolist()
    for at in range(0, n, BLOCK):
        part = zip(first[at : at + BLOCK], last[at : at + BLOCK], strict=True)
        raw = b"".join([digest(joined[a:b], 42) for a, b in part])
        yield np.frombuffer(raw, dtype=">u8").astype(np.uint64)


def _majority(blocks: Iterable[np.ndarray], lanes: int) -> bytes:
    """Majority bits of hashes; zero if there are none."""
    votes, n = np.zeros(64 * lanes, dtype=np.int64), 0
    for hashes in blocks:
        n += len(hashes)
        for lane in range(lanes):
            octets = _lane(hashes, lane).astype(">u8").view(np.uint8).reshape(-1, 8)
            votes[64 * lane : 64 * lane + 64] += np.unpackbits(octets, axis=1).sum(axis=0, dtype=np.uint32)
    return np.packbits(2 * votes > n).tobytes()


def fingerprint(text: str | None, shingle: int, lanes: int = 1) -> bytes:
    """Majority bits of the hashes of all word shingles; zero for a text without words."""
    return _majority(_shingle_hashes(text, shingle), lanes)


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    """The hashes of a text's different shingles, in order."""
    blocks = [np.unique(x) for x in _shingle_hashes(text, shingle)]
    return np.unique(np.concatenate(blocks)) if blocks else np.zeros(0, dtype=np.uint64)


def with_fingerprints(docs: DataFrame, scheme: Scheme, name: str = "fingerprint") -> DataFrame:
    """Add the fingerprint of ``text`` in hexadecimal digits, 16 per lane."""

    def start():
        def step(texts):
            return [pa.array([fingerprint(t, scheme.shingle, scheme.lanes).hex() for t in texts], pa.string())]

        return step

    return map_columns(docs, ["text"], f"{name} string", start)


# -- Gray order ------------------------------------------------------------------


def _permutation(scheme: Scheme, table: int) -> np.ndarray:
    lead = scheme.tables[table]
    rest = sorted(set(range(scheme.bits)) - set(lead))
    return np.array([*lead, *rest])


def gray_ranks(bits: np.ndarray) -> np.ndarray:
    """Rows of bits, read as Gray codes, to rows of the bits of their ranks."""
    return np.bitwise_xor.accumulate(bits, axis=1)


def gray_codes(ranks: np.ndarray) -> np.ndarray:
    """The inverse: the codes of rows of rank bits."""
    codes = ranks.copy()
    codes[:, 1:] ^= ranks[:, :-1]
    return codes


def _dealt(prints: DataFrame, scheme: Scheme) -> DataFrame:
    """A row (table_no, lead, gray) per fingerprint and table."""
    widths = [len(t) for t in scheme.tables]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = b"".join(map(bytes.fromhex, batch.column(0).to_pylist()))
            bits = np.unpackbits(np.frombuffer(raw, dtype=np.uint8).reshape(-1, scheme.bits // 8), axis=1)
            for t, width in enumerate(widths):
                ranks = gray_ranks(bits[:, _permutation(scheme, t)])
                octets = np.packbits(ranks, axis=1)
                lead = np.zeros((len(bits), 64), dtype=np.uint8)
                lead[:, 64 - width :] = ranks[:, :width]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(bits), t, dtype=np.int32)),
                        pa.array(np.packbits(lead, axis=1).view(">u8").ravel().astype(np.int64)),
                        pa.array([x.tobytes() for x in octets], pa.binary()),
                    ],
                    names=["table_no", "lead", "gray"],
                )

    return prints.mapInArrow(run, "table_no int, lead bigint, gray binary")


def _placed(dealt: DataFrame, keys: DataFrame, block_rows: int | None = None) -> DataFrame:
    """Rows (table_no, lead, gray, ...) with a ``part``, dealt out by table, lead and part and sorted by Gray rank.

    A group of more than ``block_rows`` rows, counted over ``keys``, is cut into blocks by hash, and each two blocks
    are a part of their own: any two rows of the group meet in one. Other groups are one part.
    """
    rows = block_rows or BLOCK_ROWS
    counts = keys.groupBy(F.col("table_no").alias("hot_table"), F.col("lead").alias("hot_lead")).count()
    hot = materialise(counts.where(F.col("count") > rows).withColumn("blocks", F.ceil(F.col("count") / rows)), "large-groups")
    if hot.isEmpty():
        split = dealt.withColumn("part", F.lit(0).cast("long"))
    else:
        own = F.pmod(F.xxhash64(*[F.col(c) for c in dealt.columns if c != "label"]), F.col("blocks"))
        other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
        met = dealt.join(
            broadcast_if_small(hot.drop("count")), (F.col("table_no") == F.col("hot_table")) & (F.col("lead") == F.col("hot_lead")), "left"
        )
        single = met.where("blocks IS NULL").select(*dealt.columns, F.lit(0).cast("long").alias("part"))
        parts = met.where("blocks IS NOT NULL").withColumn("own", own).select("*", other.alias("other"))
        # A block alone is met within any of its pairs.
        parts = parts.where("own <> other").select(
            *dealt.columns, (F.least("own", "other") * F.col("blocks") + F.greatest("own", "other")).alias("part")
        )
        split = single.unionByName(parts)
    return split.repartition("table_no", "lead", "part").sortWithinPartitions("table_no", "lead", "part", "gray")


def _begins(table: np.ndarray, lead: np.ndarray, part: np.ndarray) -> np.ndarray:
    """Whether a row begins a part."""
    return np.concatenate(([True], (np.diff(table) != 0) | (np.diff(lead) != 0) | (np.diff(part) != 0)))


# -- search ----------------------------------------------------------------------


def _joined(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Merge the classes that pairs connect; also the pairs that merged two of them."""
    pairs = np.unique(np.sort(np.stack([labels[a], labels[b]], axis=1), axis=1), axis=0, return_index=True)
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.get(x, x) != x:
            parent[x] = parent.get(parent[x], parent[x])
            x = parent[x]
        return x

    used = []
    for (x, y), i in zip(pairs[0].tolist(), pairs[1].tolist(), strict=True):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
            used.append((int(a[i]), int(b[i])))
    if used:
        to = np.arange(len(labels))
        for x in parent:
            to[x] = root(x)
        labels = to[labels]
    return labels, used


def _distance(a: np.ndarray, b: np.ndarray, mask: np.ndarray | None = None) -> np.ndarray:
    x = a ^ b
    return np.bitwise_count(x if mask is None else x & mask).sum(axis=1, dtype=np.int64)


def _tree(codes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Levels from the leaves up: a sample code of each node, its shared bits, and those not shared further up."""
    full = np.full_like(codes, np.uint64(0xFFFFFFFFFFFFFFFF))
    levels = [(codes, full)]
    while len(levels[-1][0]) > FAN_OUT:
        below, mask = levels[-1]
        at = np.arange(0, len(below), FAN_OUT)
        member = np.repeat(below[at], FAN_OUT, axis=0)[: len(below)]
        differs = np.bitwise_or.reduceat((below ^ member) | ~mask, at, axis=0)
        levels.append((below[at], ~differs))
    out = []
    for k, (pattern, mask) in enumerate(levels):
        if k + 1 < len(levels):
            mask = mask & ~np.repeat(levels[k + 1][1], FAN_OUT, axis=0)[: len(mask)]
        out.append((pattern, mask))
    return out


def _near(
    codes: np.ndarray, radius: int, labels: np.ndarray, sizes: np.ndarray | None, least: float, merge: bool
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a Gray-ordered group within the radius whose labels differ, in pieces.

    With ``merge`` labels are joined after each piece and only the pairs that join some come out.
    """
    n, levels = len(codes), _tree(codes)
    top = len(levels) - 1

    def classes() -> tuple[list[np.ndarray], list[np.ndarray]]:
        low, high = [labels], [labels]  # classes below each node
        for _ in levels[1:]:
            at = np.arange(0, len(low[-1]), FAN_OUT)
            low.append(np.minimum.reduceat(low[-1], at))
            high.append(np.maximum.reduceat(high[-1], at))
        return low, high

    low, high = classes()
    for begin in range(0, n, 256):
        queries = np.arange(begin, min(begin + 256, n))
        q = np.repeat(queries, len(levels[top][0]))
        node = np.tile(np.arange(len(levels[top][0])), len(queries))
        stack = [(top, q, node, np.zeros(len(q), dtype=np.int64))]
        while stack:
            k, q, node, gone = stack.pop()
            if len(q) > FRONTIER:
                stack += [(k, *(x[at : at + FRONTIER] for x in (q, node, gone))) for at in range(0, len(q), FRONTIER)][::-1]
                continue
            pattern, mask = levels[k]
            linked = (low[k][node] == labels[q]) & (high[k][node] == labels[q])
            ahead = (node + 1) * FAN_OUT**k > q  # pairs are met from their first member
            keep = ahead & ~linked
            q, node, gone = q[keep], node[keep], gone[keep]
            gone = gone + _distance(codes[q], pattern[node], mask[node])
            keep = gone <= radius
            q, node, gone = q[keep], node[keep], gone[keep]
            if k:
                size = len(levels[k - 1][0])
                child = (node[:, None] * FAN_OUT + np.arange(FAN_OUT)).ravel()
                q, gone = np.repeat(q, FAN_OUT), np.repeat(gone, FAN_OUT)
                inside = child < size
                stack.append((k - 1, q[inside], child[inside], gone[inside]))
                continue
            if sizes is not None:
                keep = _alike(sizes[q], sizes[node], least)
                q, node = q[keep], node[keep]
            if not len(q):
                continue
            if not merge:
                yield q, node
                continue
            labels, used = _joined(labels, q, node)
            if used:
                low, high = classes()
                yield tuple(np.array(used).T)


def _alike(a: np.ndarray, b: np.ndarray, least: float) -> np.ndarray:
    """Whether sets of these sizes can have so high a Jaccard similarity."""
    return np.minimum(a, b) >= least * np.maximum(a, b) - 1e-9


def _search_group(codes: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that join all members of a Gray-ordered group that are connected within it."""
    pieces = _near(codes, radius, np.arange(len(codes)), None, 0.0, True)
    return [pair for a, b in pieces for pair in zip(a.tolist(), b.tolist(), strict=True)]


def _search(
    groups: np.ndarray,
    codes: np.ndarray,
    radius: int,
    labels: np.ndarray | None = None,
    sizes: np.ndarray | None = None,
    least: float = 0.0,
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs within each group of consecutive rows of one number, in pieces: links that join all that are connected.

    With ``labels`` all pairs within the radius whose labels differ; with ``sizes`` only pairs of like sizes.
    """
    starts = np.concatenate(([0], np.flatnonzero(np.diff(groups)) + 1))
    counts = np.diff(np.concatenate((starts, [len(groups)])))
    count = np.repeat(counts, counts)
    small = np.flatnonzero((count > 1) & (count <= SMALL_GROUP))
    for d in range(1, SMALL_GROUP):
        small = small[small + d < len(groups)]
        small = small[groups[small] == groups[small + d]]
        if not len(small):
            break
        near = small[_distance(codes[small], codes[small + d]) <= radius]
        if labels is not None:
            near = near[labels[near] != labels[near + d]]
        if sizes is not None:
            near = near[_alike(sizes[near], sizes[near + d], least)]
        yield near, near + d
    for s, m in zip(starts[counts > SMALL_GROUP].tolist(), counts[counts > SMALL_GROUP].tolist(), strict=True):
        own = np.arange(m) if labels is None else labels[s : s + m]
        own_sizes = None if sizes is None else sizes[s : s + m]
        for a, b in _near(codes[s : s + m], radius, own, own_sizes, least, labels is None):
            yield s + a, s + b


def links(prints: DataFrame, scheme: Scheme, block_rows: int | None = None) -> DataFrame:
    """Links (src, dst) between distinct fingerprints (hexadecimal digits) that connect all within the radius.

    Not every such pair is a row, but any two of them are connected by rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def searched(table: np.ndarray, lead: np.ndarray, part: np.ndarray, gray: np.ndarray) -> pa.RecordBatch:
            ranks = np.unpackbits(gray, axis=1)
            codes = gray_codes(ranks)
            octets = np.packbits(codes, axis=1)
            words = np.ascontiguousarray(octets).view(np.uint64).reshape(len(codes), scheme.lanes)
            pieces = _search(np.cumsum(_begins(table, lead, part)), words, scheme.radius)
            found = [pair for a, b in pieces for pair in zip(a.tolist(), b.tolist(), strict=True)]
            ends = sorted({i for pair in found for i in pair})
            names = {}
            for i in ends:
                bits = np.empty(scheme.bits, dtype=np.uint8)
                bits[_permutation(scheme, int(table[i]))] = codes[i]
                names[i] = np.packbits(bits).tobytes().hex()
            columns = [pa.array([names[p[k]] for p in found], pa.string()) for k in (0, 1)]
            return pa.RecordBatch.from_arrays(columns, names=["src", "dst"])

        def together():
            return [np.concatenate(x) for x in zip(*held, strict=True)]

        for batch in batches:
            if not batch.num_rows:
                continue
            raw = b"".join(batch.column(2).to_pylist())
            held.append(
                (
                    batch.column(0).to_numpy(),
                    batch.column(1).to_numpy(),
                    batch.column(3).to_numpy(),
                    np.frombuffer(raw, dtype=np.uint8).reshape(-1, scheme.bits // 8),
                )
            )
            if sum(len(x[0]) for x in held) >= SEARCH_ROWS:
                table, lead, part, gray = together()
                cut = int(np.flatnonzero(_begins(table, lead, part))[-1])  # the last part may go on
                held = [(table[cut:], lead[cut:], part[cut:], gray[cut:])]
                if cut:
                    yield searched(table[:cut], lead[:cut], part[:cut], gray[:cut])
        if held:
            yield searched(*together())

    dealt = _dealt(prints, scheme)
    return _placed(dealt, dealt, block_rows).mapInArrow(run, "src string, dst string")


def near_duplicates(docs: DataFrame, scheme: Scheme | None = None, carry: list[str] | None = None) -> DataFrame:
    """Add ``fingerprint`` and ``component_id`` to documents, replacing columns of these names.

    ``component_id`` is the smallest ``doc_id`` that links reach, a document's own
    included; it is null where only documents without an id are reached. Every row stays,
    with the columns named by ``carry`` (default: all).
    Words are lower-cased (A-Z) and end at ASCII white space; null, empty and blank texts have fingerprint
    zero and link like any other. Equal texts, and rows that repeat, share fingerprint and
    component. An empty table gives an empty table.
    """
    scheme = scheme or exact_scheme()
    docs = without(docs, ["fingerprint", "component_id"])
    own, key, low = free_names(docs, "own_id", "class_key", "class_lowest")
    columns = [F.col(f"`{c}`") for c in (docs.columns if carry is None else carry)]
    marked = with_fingerprints(docs.withColumn(own, F.col("doc_id").cast("long")), scheme)
    stored = materialise(marked.select(*columns, own, "fingerprint"), "fingerprints")

    distinct = materialise(
        stored.groupBy(F.col("fingerprint").alias("print")).agg(F.min(own).alias("smallest")), "distinct-fingerprints"
    )
    classes = components(materialise(links(distinct.select("print"), scheme), "fingerprint-links"))
    linked = materialise(
        distinct.join(classes, distinct["print"] == classes["node"]).select("print", "root", "smallest"), "linked-fingerprints"
    )
    lowest = linked.groupBy("root").agg(F.min("smallest").alias("lowest"))
    named = linked.join(lowest, "root").select(F.col("print").alias("linked_print"), "lowest")
    final = distinct.join(named, distinct["print"] == named["linked_print"], "left").select(
        F.col("print").alias(key), F.coalesce("lowest", "smallest").alias(low)
    )
    return stored.join(materialise(final, "fingerprint-classes"), stored["fingerprint"] == F.col(key), "left").select(
        *columns, "fingerprint", F.col(low).alias("component_id")
    )


def one_of_each(docs: DataFrame, scheme: Scheme | None = None) -> DataFrame:
    """One row of each group of near-duplicates, the same groups as ``near_duplicates``: that of the smallest ``doc_id``.

    Rows without an id stand behind all others; of rows that repeat the smallest id, or of a group without any, one stays.
    Columns stay as they are. An empty table gives an empty table.
    """
    scheme = scheme or exact_scheme()
    own, row, mark = free_names(docs, "own_id", "row_no", "print_mark")
    numbered = docs.withColumns({own: F.col("doc_id").cast("long"), row: F.monotonically_increasing_id()})
    # The row number is stored with the row before anything refers to it.
    stored = materialise(with_fingerprints(numbered, scheme, mark), "fingerprints")
    first = F.struct(F.col(own).isNull().alias("no_id"), F.col(own).alias("id"), F.col(row).alias("row"))
    distinct = materialise(stored.groupBy(F.col(mark).alias("print")).agg(F.min(first).alias("first")), "distinct-fingerprints")
    classes = components(materialise(links(distinct.select("print"), scheme), "fingerprint-links"))
    grouped = distinct.join(classes, distinct["print"] == classes["node"], "left")
    firsts = grouped.groupBy(F.coalesce("root", "print").alias("group")).agg(F.min("first")["row"].alias(row))
    kept = materialise(firsts.select(row), "kept-rows")
    return stored.join(broadcast_if_small(kept), row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
