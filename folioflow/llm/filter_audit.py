"""Interactions of document filters: what each one removes in every order of application.

A document is measured in one pass of a byte transducer. Its tables give each byte a class and each
(state, class) the next state and the signs that are put out: word begins, word ends, capital,
symbol, code point. As the next state hangs on the class alone, a whole block of bytes
goes through the tables at once. The word spans put out go into a hash table whose hits are
verified byte by byte, so distinct words are counted exactly. Spark adds up how many documents
fail which filters and unfolds those counts over all orders.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from itertools import permutations
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow.llm.common import without
from folioflow.scale import materialise

#: Text that goes through the tables together; a longer document goes in blocks of it.
BLOCK = 1 << 18
#: Eight-byte windows of a word that its hash covers one by one, before the last one.
WINDOWS = 32

# -- the transducer -----------------------------------------------------------------

_WHITE, _CAPITAL, _SYMBOL, _ASCII, _LEAD, _TRAIL = range(6)
_OUTSIDE, _INSIDE = range(2)
_BEGINS, _ENDS, _IS_CAPITAL, _IS_SYMBOL, _IS_POINT = (np.uint8(1 << k) for k in range(5))


def _classes() -> np.ndarray:
    table = np.full(256, _ASCII, dtype=np.uint8)
    table[0x80:0xC0], table[0xC0:] = _TRAIL, _LEAD
    table[[0x20, *range(0x09, 0x0E)]] = _WHITE
    table[ord("A") : ord("Z") + 1] = _CAPITAL
    table[[ord(c) for c in "#$%&*|"]] = _SYMBOL
    return table


def _signs() -> np.ndarray:
    table = np.zeros((2, 6), dtype=np.uint8)
    table[_OUTSIDE, 1:] |= _BEGINS
    table[_INSIDE, _WHITE] |= _ENDS
    table[:, _CAPITAL] |= _IS_CAPITAL
    table[:, _SYMBOL] |= _IS_SYMBOL
    table[:, :_TRAIL] |= _IS_POINT
    return table


CLASS, SIGNS = _classes(), _signs()
NEXT = np.array([_OUTSIDE] + [_INSIDE] * 5, dtype=np.uint8)  # the state after a class, whatever it was before


def transduce(block: np.ndarray) -> np.ndarray:
    """The signs put out at each byte of a block that begins outside a word."""
    kinds = CLASS[block]
    state = np.empty_like(kinds)
    state[:1] = _OUTSIDE
    state[1:] = NEXT[kinds[:-1]]
    return SIGNS.ravel()[state * np.uint8(6) + kinds]


# -- the word table -----------------------------------------------------------------

_MASKS = np.array([0] + [(1 << 8 * k) - 1 for k in range(1, 9)], dtype=np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)


class WordTable:
    """Distinct words of documents as spans of ``data``, in a table with open addressing.

    ``data`` ends with eight bytes more than its text. Two spans are one word only if the
    document, the length and all bytes agree; the hash merely says where to look.
    """

    def __init__(self, data: np.ndarray):
        self.data = data
        self.window = np.ndarray((max(len(data) - 7, 0),), dtype="<u8", buffer=data, strides=(1,))
        self.doc, self.begin, self.size, self.digest = (np.zeros(0, np.int64) for _ in range(4))
        self.digest = self.digest.astype(np.uint64)
        self.slots = np.full(1 << 10, -1, dtype=np.int64)

    def _eight(self, begin: np.ndarray, left: np.ndarray) -> np.ndarray:
        """The next eight bytes of words that have ``left`` bytes left, zero behind their ends."""
        return self.window[begin] & _MASKS[np.minimum(left, 8)]

    def _digests(self, doc: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        h = (doc.astype(np.uint64) << np.uint64(32)) + size.astype(np.uint64)
        live = np.arange(len(begin))
        for k in range(WINDOWS):
            h[live] = (h[live] ^ self._eight(begin[live] + 8 * k, size[live] - 8 * k)) * _ODD
            h[live] ^= h[live] >> np.uint64(29)
            live = live[size[live] > 8 * (k + 1)]
            if not len(live):
                break
        else:
            h[live] = (h[live] ^ self.window[begin[live] + size[live] - 8]) * _ODD
        return h ^ (h >> np.uint64(32))

    def _same(self, a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...]) -> np.ndarray:
        same = (a[0] == b[0]) & (a[2] == b[2])
        live, k = np.flatnonzero(same), 0
        while len(live):
            if k == WINDOWS:  # few words are so long
                for i in live.tolist():
                    x, y, n = int(a[1][i]), int(b[1][i]), int(a[2][i])
                    same[i] = np.array_equal(self.data[x : x + n], self.data[y : y + n])
                break
            left = a[2][live] - 8 * k
            equal = self._eight(a[1][live] + 8 * k, left) == self._eight(b[1][live] + 8 * k, left)
            same[live[~equal]] = False
            live, k = live[equal & (left > 8)], k + 1
        return same

    def _place(self, digest: np.ndarray, spans: tuple[np.ndarray, ...], known: int) -> tuple[np.ndarray, np.ndarray]:
        """Put words numbered from ``known`` into slots; which of them are new, and where those are."""
        doc, begin, size = (np.concatenate(x) for x in zip((self.doc, self.begin, self.size), spans, strict=True))
        mask = np.uint64(len(self.slots) - 1)
        new, where = np.zeros(len(digest), dtype=bool), np.zeros(len(digest), dtype=np.int64)
        word, slot = np.arange(known, known + len(digest)), (digest & mask).astype(np.int64)
        while len(word):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = word[free]  # of several the last one stays
            there = self.slots[slot]
            mine = there == word
            new[word[mine] - known], where[word[mine] - known] = True, slot[mine]
            word, there, slot = word[~mine], there[~mine], slot[~mine]
            met = self._same((doc[word], begin[word], size[word]), (doc[there], begin[there], size[there]))
            word, slot = word[~met], (slot[~met] + 1) & int(mask)
        return new, where

    def insert(self, doc: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Add words; which of them were met for the first time."""
        known = len(self.doc)
        digest = self._digests(doc, begin, size)
        if 2 * (known + len(doc)) > len(self.slots):
            self.slots = np.full(1 << int(4 * (known + len(doc))).bit_length(), -1, dtype=np.int64)
            held = self.doc, self.begin, self.size
            self.doc = self.begin = self.size = np.zeros(0, np.int64)
            self._place(self.digest, held, 0)
            self.doc, self.begin, self.size = held
        new, where = self._place(digest, (doc, begin, size), known)
        self.slots[where[new]] = known + np.arange(int(new.sum()))
        self.doc, self.begin, self.size = (
            np.concatenate([old, x[new]]) for old, x in zip((self.doc, self.begin, self.size), (doc, begin, size), strict=True)
        )
        self.digest = np.concatenate([self.digest, digest[new]])
        return new


def _measure(texts: list[memoryview]) -> np.ndarray:
    """Words, distinct words, capitals, code points and symbols of each text: one row per text."""
    raw = b" ".join([*texts, b" " * 8])  # every text ends with a white byte of its own
    data = np.frombuffer(raw, dtype=np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    starts = np.concatenate(([0], ends[:-1]))
    out = np.zeros((len(texts), 5), dtype=np.int64)
    table, at, stop = WordTable(data), 0, int(ends[-1])
    while at < stop:
        to = min(at + BLOCK, stop)
        while to < stop and CLASS[data[to - 1]] != _WHITE:  # blocks end with a white byte
            ahead = np.flatnonzero(CLASS[data[to : to + BLOCK]] == _WHITE)
            to = min(to + (int(ahead[0]) + 1 if len(ahead) else BLOCK), stop)
        signs = transduce(data[at:to])
        first = int(np.searchsorted(starts, at, "right")) - 1
        last = int(np.searchsorted(starts, to, "left"))
        cuts = np.maximum(starts[first:last], at) - at
        for column, sign in ((2, _IS_CAPITAL), (3, _IS_POINT), (4, _IS_SYMBOL)):
            out[first:last, column] += np.add.reduceat((signs & sign) > 0, cuts, dtype=np.int64)
        begin, end = np.flatnonzero(signs & _BEGINS), np.flatnonzero(signs & _ENDS)
        doc = np.searchsorted(cuts, begin, "right") - 1 + first
        new = table.insert(doc, begin + at, end - begin)
        out[:, 0] += np.bincount(doc, minlength=len(texts))
        out[:, 1] += np.bincount(doc[new], minlength=len(texts))
        at = to
    out[:, 3] -= 1  # the white byte behind each text
    return out


_MEASURES = ["n_words", "n_distinct", "n_capitals", "n_chars", "n_symbols"]


def measure(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Counts of each text: n_words, n_distinct, n_capitals, n_chars, n_symbols, and ``text_key``.

    Words are what stands between ASCII white space, case matters; capitals are A-Z, symbols any of
    ``#$%&*|``. ``text_key`` is a 128-bit digest of the text. Keeps the columns named by ``carry`` (default: all),
    but for those of the result's names. Null counts as the empty text: zeros. A map without a shuffle.
    """
    docs = without(docs, [*_MEASURES, "text_key"])
    carry = docs.columns if carry is None else carry
    kept = T.StructType([docs.schema[c] for c in carry])
    added = T._parse_datatype_string(", ".join(f"{m} bigint" for m in _MEASURES) + ", text_key binary")
    names = [*carry, *added.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            text = batch.column(batch.schema.get_field_index("text")).cast(pa.large_binary())
            views = [memoryview(v.as_buffer()) if v.is_valid else memoryview(b"") for v in text]
            rows, group, size = [], [], 0
            for view in views:
                group, size = [*group, view], size + len(view)
                if size >= BLOCK:
                    rows, group, size = [*rows, _measure(group)], [], 0
            if group:
                rows.append(_measure(group))
            counts = np.concatenate(rows)
            keys = pa.array([hashlib.blake2b(v, digest_size=16).digest() for v in views], pa.binary())
            old = [batch.column(batch.schema.get_field_index(c)) for c in carry]
            yield pa.RecordBatch.from_arrays([*old, *[pa.array(x) for x in counts.T], keys], names=names)

    columns = [F.col(f"`{c}`") for c in dict.fromkeys([*carry, "text"])]
    return docs.select(*columns).mapInArrow(run, T.StructType([*kept.fields, *added.fields]))


# -- the audit ----------------------------------------------------------------------

#: Filters by letter: when a document of these counts fails. The last filter, for repeated texts, is added by ``audit``.
FILTERS = {
    "A": "n_words < 200",
    "B": "100 * n_distinct < 50 * n_words",
    "C": "100 * n_capitals > 3 * n_chars",
    "D": "n_symbols > 0",
}
REPEATED = "E"


def failures(docs: DataFrame, labels: DataFrame, filters: dict[str, str], part: Column) -> DataFrame:
    """(part, mask, good, toxic, n): documents by the set of filters that they fail, one bit per filter.

    The highest bit is that of a text found under a smaller ``doc_id`` too.
    """
    bits = [F.when(F.expr(cond), 1 << k).otherwise(0) for k, cond in enumerate(filters.values())]
    again = 1 << len(filters)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), part.alias("part"), "text")
    facts = measure(own, ["doc_id", "part"]).select("doc_id", "part", reduce(add, bits).alias("mask"), "text_key")
    facts = materialise(facts, "filter-facts")
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    # Rows without an id have no labels: they need not meet in the join.
    marked = facts.where("doc_id IS NOT NULL").join(marks, "doc_id", "left")
    unknown = facts.where("doc_id IS NULL").withColumns({"good": F.lit(False), "toxic": F.lit(False)})
    marked = marked.unionByName(unknown)
    kind = ["text_key", "part", "mask", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic")]
    # Many copies of one text are added up by their id and kind, then by kind, before they meet by text.
    rows = marked.groupBy(*kind, "doc_id").agg(F.count(F.lit(1)).alias("n"))
    kinds = rows.groupBy("text_key", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("first"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("n_unknown"),
    )
    low = kinds.groupBy(F.col("text_key").alias("key")).agg(F.min("first.doc_id").alias("low"))
    met = kinds.join(low, F.col("text_key") == F.col("key"))
    ahead = F.coalesce(F.when(F.col("first.doc_id") == F.col("low"), F.col("first.n")), F.lit(0)) + F.col("n_unknown")
    split = F.explode(
        F.array(
            F.struct(F.col("mask").alias("mask"), ahead.alias("n")),
            F.struct((F.col("mask") + again).alias("mask"), (F.col("n") - ahead).alias("n")),
        )
    )
    out = met.select("part", "good", "toxic", split.alias("x")).select("part", "good", "toxic", "x.mask", "x.n")
    return out.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))


def audit(docs: DataFrame, labels: DataFrame, filters: dict[str, str] | None = None) -> DataFrame:
    """One row per part (``lang``; null: empty), order of the filters and step in that order.

    Counts of documents of the part: ``kept`` after the step, ``removed`` by it, ``redundant`` (fail its filter, gone
    before), ``unique_fails`` (fail this filter alone), ``good_lost`` and ``toxic_lost`` (removed here, by their labels),
    ``shapley`` (removed by the filter, over all orders). ``filters`` are conditions on what ``measure`` counts,
    by letter; the letter E stands for a text that a smaller ``doc_id`` has too, removed or not.

    Rows that repeat a ``doc_id`` count each and are no copies of each other; rows without an id are copies of none, and none
    of them, and have no labels. Repeated labels count if one of them is set. An empty table gives an empty table.
    """
    filters = FILTERS if filters is None else filters
    letters = "".join(filters) + REPEATED
    orders = ["".join(o) for o in permutations(letters)]
    counts = materialise(failures(docs, labels, filters, F.coalesce("lang", F.lit(""))), "filter-counts")

    def mask_of(text: Column) -> Column:
        return reduce(add, [F.when(F.instr(text, x) > 0, 1 << k).otherwise(0) for k, x in enumerate(letters)])

    steps = F.explode(F.sequence(F.lit(1), F.lit(len(letters))))
    # The kinds of a part are as many as there are sets of filters, whatever the number of documents.
    unfolded = (
        counts.select("*", F.explode(F.array(*[F.lit(o) for o in orders])).alias("filter_order"))
        .select("*", steps.alias("step"))
        .withColumn("own", mask_of(F.expr("substring(filter_order, step, 1)")))
        .withColumn("earlier", mask_of(F.expr("substring(filter_order, 1, step - 1)")))
    )
    fails = F.col("mask").bitwiseAND(F.col("own")) != 0
    gone = F.col("mask").bitwiseAND(F.col("earlier")) != 0
    here = fails & ~gone

    def total(cond: Column, value: Column | None = None) -> Column:
        return F.sum(F.when(cond, F.col("n") if value is None else value).otherwise(0)).cast("long")

    # Each of the filters that a document fails comes first in the same number of orders.
    share = F.when(F.col("mask") != 0, F.expr(f"n * {len(orders)} div bit_count(mask)"))
    return unfolded.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~gone).alias("kept"),
        total(here).alias("removed"),
        total(fails & gone).alias("redundant"),
        total(F.col("mask") == F.col("own")).alias("unique_fails"),
        total(here & F.col("good")).alias("good_lost"),
        total(here & F.col("toxic")).alias("toxic_lost"),
        total(fails, share).alias("shapley"),
    )
