"""Benchmark decontamination with an FM-index per shard of the training text.

A shard is what one task gathers up to ``SHARD_BYTES`` of text. Its words become numbers
of the benchmark's vocabulary; a word the benchmark does not have can be in no phrase and
separates. Runs of known words that are long enough for a phrase make up the indexed
string. Its suffixes are sorted (prefix doubling), the Burrows-Wheeler string is held as a
wavelet matrix, phrases are found by backward search through its ranks, and occurrences
are located by walking back to sampled suffix positions. Words covered by occurrences are
merged into removal spans.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow.llm.common import free_names, without
from folioflow.scale import materialise

#: Words of a phrase; an item with fewer is one phrase as a whole.
WINDOW = 10
#: Text gathered for one index, in bytes.
SHARD_BYTES = 8 << 20
#: Benchmark text handed to the tasks in one pass; a larger benchmark takes several passes.
BENCHMARK_BYTES = 2 << 20
#: One suffix position in so many is kept.
SAMPLE = 8

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) words of a text, as UTF-8; null has none."""
    return _WORD.findall(text.encode().lower()) if text else []


class Phrases:
    """Distinct phrases of some benchmark items, as numbers of their vocabulary."""

    def __init__(self, items: list[tuple[int, str]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            codes = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            for i in range(max(1, len(codes) - window + 1) if codes else 0):
                owners.setdefault(tuple(codes[i : i + window]), set()).add(str(item))
        self.owners = [frozenset(x) for x in owners.values()]
        self.lengths = np.array([len(x) for x in owners], dtype=np.int64)
        self.codes = np.full((len(owners), window), -1, dtype=np.int64)
        for row, codes in zip(self.codes, owners, strict=True):
            row[window - len(codes) :] = codes


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Start positions of the suffixes in order; a suffix comes before its extensions."""
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        after = np.zeros(n, dtype=np.int64)
        after[: n - step] = rank[step:] + 1
        key = rank * (n + 2) + after
        order = np.argsort(key, kind="stable")
        new = np.empty(n, dtype=np.int64)
        new[order] = np.concatenate(([0], np.cumsum(np.diff(key[order]) != 0)))
        rank, step = new, 2 * step
        if rank[order[-1]] == n - 1 or step >= n:
            return order


class FmIndex:
    """Backward search over a string of small numbers."""

    def __init__(self, symbols: np.ndarray, sample: int = SAMPLE):
        symbols = np.concatenate((symbols + 1, [0]))  # an end mark, smaller than any symbol
        self.n, self.sample = len(symbols), sample
        order = suffix_array(symbols)
        self.last = symbols[order - 1]
        self.bits = max(1, int(symbols.max(initial=0)).bit_length())
        self.starts = np.concatenate(([0], np.cumsum(np.bincount(symbols, minlength=1 << self.bits))))
        # Wavelet matrix: per level the count of ones before each place; zeros go first on the next level.
        self.ones, self.zeros, level = [], [], self.last
        for b in range(self.bits - 1, -1, -1):
            bit = (level >> b) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(bit))))
            self.zeros.append(int(self.n - self.ones[-1][-1]))
            level = np.concatenate((level[bit == 0], level[bit == 1]))
        self.sampled = order % sample == 0
        self.sample_rank = np.concatenate(([0], np.cumsum(self.sampled)))
        self.positions = order[self.sampled]

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its place in the Burrows-Wheeler string."""
        low = np.zeros_like(place)
        for k, b in enumerate(range(self.bits - 1, -1, -1)):
            one = ((symbol >> b) & 1).astype(bool)
            to, frm = self.ones[k][place], self.ones[k][low]
            place = np.where(one, self.zeros[k] + to, place - to)
            low = np.where(one, self.zeros[k] + frm, low - frm)
        return place - low

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of right-aligned patterns (-1: no symbol); empty ones are equal."""
        low = np.zeros(len(patterns), dtype=np.int64)
        high = np.full(len(patterns), self.n, dtype=np.int64)
        for column in range(patterns.shape[1] - 1, -1, -1):
            symbol = np.where(patterns[:, column] < 0, -1, patterns[:, column] + 1)
            high[symbol >= 1 << self.bits] = 0  # the shard lacks it
            live = np.flatnonzero((symbol >= 0) & (low < high))
            c = symbol[live]
            low[live], high[live] = (self.starts[c] + self.rank(c, x[live]) for x in (low, high))
        return low, np.maximum(low, high)

    def locate(self, places: np.ndarray) -> np.ndarray:
        """Text positions of suffix ranks, walking back to the nearest sampled one."""
        out, steps = np.empty(len(places), dtype=np.int64), np.zeros(len(places), dtype=np.int64)
        open_, at = np.arange(len(places)), places.copy()
        while len(open_):
            hit = self.sampled[at]
            out[open_[hit]] = self.positions[self.sample_rank[at[hit]]] + steps[open_[hit]]
            open_, at = open_[~hit], at[~hit]
            c = self.last[at]
            at = self.starts[c] + self.rank(c, at)
            steps[open_] += 1
        return out


def runs_string(codes: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of known words of at least ``shortest`` words, each behind a separator, and where each symbol stood."""
    known = np.concatenate(([False], codes > 0, [False]))
    edges = np.flatnonzero(known[1:] != known[:-1])
    begin, end = edges[::2], edges[1::2]
    long = end - begin >= shortest
    begin, size = begin[long], (end - begin)[long]
    total = int(size.sum()) + len(size)
    if not total:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    heads = np.cumsum(size + 1) - size - 1
    place = np.arange(total) - np.repeat(heads, size + 1) + np.repeat(begin, size + 1)
    tails = heads + size
    symbols = codes[np.minimum(place, len(codes) - 1)].astype(np.int64)
    symbols[tails] = 0
    return symbols, place


def find_in_shard(texts: list[str | None], phrases: Phrases) -> list[tuple[int, list[tuple[int, int]], list[str]]]:
    """Per text its word count, merged word spans that are hit, and the items found."""
    vocabulary, codes, counts = phrases.vocabulary, [], []
    for text in texts:
        words = words_of(text)
        counts.append(len(words))
        codes.append(np.fromiter((vocabulary.get(w, 0) for w in words), dtype=np.int32, count=len(words)))
        codes.append(np.zeros(1, dtype=np.int32))
    begins = np.concatenate(([0], np.cumsum(np.array(counts, dtype=np.int64) + 1)))
    empty: list = [(n, [], []) for n in counts]
    if not len(phrases.lengths) or not texts:
        return empty
    symbols, place = runs_string(np.concatenate(codes), int(phrases.lengths.min()))
    if not len(symbols):
        return empty
    index = FmIndex(symbols)
    low, high = index.search(phrases.codes)
    found = np.repeat(np.arange(len(low)), high - low)
    if not len(found):
        return empty
    first = np.repeat(low - np.concatenate(([0], np.cumsum(high - low)[:-1])), high - low)
    at = place[index.locate(first + np.arange(len(found)))]
    covered = np.zeros(begins[-1] + 1, dtype=np.int64)
    np.add.at(covered, at, 1)
    np.add.at(covered, at + phrases.lengths[found], -1)
    hit = np.concatenate(([False], np.cumsum(covered)[:-1] > 0, [False]))
    edges = np.flatnonzero(hit[1:] != hit[:-1])
    out = empty
    for b, e in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        d = int(np.searchsorted(begins, b, side="right")) - 1
        out[d][1].append((b - int(begins[d]), e - int(begins[d])))
    where = np.searchsorted(begins, at, side="right") - 1
    pairs = np.unique(where * len(low) + found)
    items: dict[int, set[str]] = {}
    for d, p in zip((pairs // len(low)).tolist(), (pairs % len(low)).tolist(), strict=True):
        items.setdefault(d, set()).update(phrases.owners[p])
    for d, got in items.items():
        out[d][2].extend(got)
    return out


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for b, e in sorted(spans):
        if out and b <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((b, e))
    return out


def _cut(text: str | None, spans: list[tuple[int, int]]) -> tuple[list[tuple[int, int]], str | None]:
    """Code point spans of word spans, and the text without them."""
    if not spans:
        return [], text
    data = text.encode()
    at = [m.span() for m in _WORD.finditer(data.lower())]
    cuts, kept, done = [], [], 0
    for b, e in spans:
        lo, hi = at[b][0], at[e - 1][1]
        kept.append(data[done:lo])
        cuts.append((lo, hi))
        done = hi
    kept.append(data[done:])
    chars, last, n = [], 0, 0
    for lo, hi in cuts:
        n += len(data[last:lo].decode())
        start, n = n, n + len(data[lo:hi].decode())
        last = hi
        chars.append((start, n))
    return chars, b"".join(kept).decode()


RESULTS = (
    "n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean, "
    "spans array<struct<start: bigint, end: bigint>>, clean_text string"
)
_FOUND = {"found_words": "bigint", "found_spans": "array<struct<start: bigint, end: bigint>>", "found_items": "array<string>"}
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _benchmark_parts(benchmark: DataFrame, part_bytes: int) -> Iterator[list[tuple[int, str]]]:
    """The items in parts of a bounded size, so that no pass hands out more than that."""
    items = benchmark.where(F.col("text").isNotNull() & F.col("item_id").isNotNull())
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = int(size // part_bytes) + 1
    for k in range(parts):
        mine = items.where(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == k)
        yield [(r[0], r[1]) for r in mine.select("item_id", "text").toLocalIterator()]


def _shards(batches: Iterator[pa.RecordBatch], shard_bytes: int) -> Iterator[pa.Table]:
    held, size = [], 0
    for batch in batches:
        at = 0
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column("text")), 0).to_pylist()
        for i, x in enumerate(sizes):
            size += x
            if size >= shard_bytes:
                yield pa.Table.from_batches([*held, batch.slice(at, i + 1 - at)])
                held, size, at = [], 0, i + 1
        if at < batch.num_rows:
            held.append(batch.slice(at))
    if held:
        yield pa.Table.from_batches(held)


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    shard_bytes: int = SHARD_BYTES,
    part_bytes: int = BENCHMARK_BYTES,
) -> DataFrame:
    """Find benchmark phrases in whole documents and cut them out.

    Adds ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated``, ``spans``
    (code points to remove, merged, end exclusive) and ``clean_text``, replacing columns
    of these names. A map over the documents, without a shuffle. ``clean_text`` loses the spans and nothing
    else; without a hit it is the text itself, null included.

    Null and empty texts have no words and are clean. Items without text, words or id
    give no phrase; equal phrases of several items count for each. Item ids are
    sorted as strings, repeated ids count once. Repeated documents are treated alike.
    An empty table on either side is fine.
    """
    spark = docs.sparkSession
    docs = without(docs, T._parse_datatype_string(RESULTS).names)
    n_words, spans_so_far, items_so_far = own = free_names(docs, *_FOUND)
    found_schema = ", ".join(f"{name} {kind}" for name, kind in zip(own, _FOUND.values(), strict=True))
    found = docs
    for n, items in enumerate(_benchmark_parts(benchmark, part_bytes)):
        if n:  # each pass ends with a table, so that no task holds the phrases of two parts
            found = materialise(found, "found-phrases")
        phrases = spark.sparkContext.broadcast(Phrases(items, window))
        plain = docs.schema.fields
        schema = T.StructType([*plain, *T._parse_datatype_string(found_schema).fields])
        names, again = schema.names, n > 0

        def run(batches, phrases=phrases, names=names, again=again, keep=len(plain)):
            for shard in _shards(batches, shard_bytes):
                rows = find_in_shard(shard.column("text").to_pylist(), phrases.value)
                if again:
                    spans = [[(s["start"], s["end"]) for s in x] for x in shard.column(spans_so_far).to_pylist()]
                    before = shard.column(items_so_far).to_pylist()
                    rows = [(w, _merged(s + t), i + j) for (w, s, i), t, j in zip(rows, spans, before, strict=True)]
                columns = [
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([[{"start": b, "end": e} for b, e in r[1]] for r in rows], _SPANS),
                    pa.array([r[2] for r in rows], pa.list_(pa.string())),
                ]
                table = pa.Table.from_arrays([*shard.columns[:keep], *columns], names=names)
                yield from table.combine_chunks().to_batches()

        found = found.mapInArrow(run, schema)

    schema = T.StructType([*docs.schema.fields, *T._parse_datatype_string(RESULTS).fields])

    def finish(batches, names=schema.names, keep=len(docs.columns)):
        for batch in batches:
            spans = [[(s["start"], s["end"]) for s in x] for x in batch.column(spans_so_far).to_pylist()]
            items = [sorted(set(x)) for x in batch.column(items_so_far).to_pylist()]
            cuts = [_cut(t, s) for t, s in zip(batch.column("text").to_pylist(), spans, strict=True)]
            hits = [sum(e - b for b, e in s) for s in spans]
            columns = [
                batch.column(n_words),
                pa.array(hits, pa.int64()),
                pa.array([len(x) for x in items], pa.int64()),
                pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items], pa.string()),
                pa.array([h > 0 for h in hits], pa.bool_()),
                pa.array([[{"start": b, "end": e} for b, e in c[0]] for c in cuts], _SPANS),
                pa.array([c[1] for c in cuts], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:keep], *columns], names=names)

    return found.mapInArrow(finish, schema)
