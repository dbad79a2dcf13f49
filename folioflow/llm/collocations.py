"""Phrase collocations by Toivonen's sampling.

A sample of the documents proposes phrases that are frequent at a lowered threshold. One
full pass counts exactly the words, the proposed phrases and their negative border: the
phrases that occur, were not proposed, but whose first and last parts both were. A border phrase that turns out
frequent may have frequent extensions that nobody counted; then an expansion pass counts what the phrases now known newly
allow, together with what that may lead to, so that the border is closed behind it.

Most of the border is rare. So before a pass, phrases that were not proposed are sieved: their occurrences are added up by
44 bits of their hash, a few bytes each instead of their text. Phrases that share these bits only make a sum too large, so one below the
threshold proves that none of them is frequent; the pass then counts the others by their text.

What is proposed goes to the tasks as a bit filter of bounded size. Its false hits only let a task count more;
all counting is by the phrases themselves, so counts are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.llm.common import release_memory
from folioflow.scale import materialise, numbered

#: Share of the documents that proposes phrases, and share of the expected count that suffices there.
SAMPLE_SHARE, LOWERED = 1 / 8, 0.75
#: Text of one language that a task counts together, and text of all languages that it holds.
CHUNK, HELD = 4 << 20, 12 << 20
#: Bits of the largest filter: 8 MB, whatever the corpus.
MOST_BITS = 1 << 26
#: Rows handed to Spark together.
OUT_ROWS = 1 << 16
#: Bits of a hash that the sieve leaves out, and those that tell apart the phrases of one bucket.
LEFT_OUT, IN_BUCKET = np.uint64(20), np.uint64(32)

_WHITE, _BREAK, _WORD = range(3)
_KIND = np.full(256, _WORD, dtype=np.uint8)
_KIND[[0x20, 0x09]] = _WHITE
_KIND[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = _BREAK
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _word_hashes(words: list[bytes], lang: str) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang.encode())
    return np.array([xxhash.xxh64_intdigest(w, seed) for w in words], dtype=np.uint64)


def _longer(phrase: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of phrases with one more word each."""
    h = (phrase ^ (phrase >> np.uint64(31))) * _ODD + word
    return h ^ (h >> np.uint64(29))


def _sieve_key(hashes: np.ndarray) -> np.ndarray:
    """What the filter of a sieve knows of hashes."""
    return (hashes >> LEFT_OUT) * _ODD


class Filter:
    """A set of phrases as bits, two for each; it never misses a member."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @staticmethod
    def slots(hashes: np.ndarray, n_bits: int) -> list[np.ndarray]:
        mask = np.uint64(n_bits - 1)
        return [hashes & mask, (hashes >> np.uint64(32)) & mask]

    def has(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), dtype=bool)
        for slot in self.slots(hashes, 64 * len(self.bits)):
            found &= (self.bits[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1
        return found


class Chunk:
    """The words of texts of one language, numbered, with the pieces they stand in."""

    def __init__(self, texts: list[bytes], lang: str):
        data = _LOWER[np.frombuffer(b"\n".join([*texts, b""]), dtype=np.uint8)]
        kind = _KIND[data]
        inside = kind == _WORD
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        edges = np.concatenate(([0], edges)) if inside[:1].any() else edges
        begin, end = edges[::2], edges[1::2]  # the last byte is a break
        offsets = np.concatenate(([0], np.cumsum(end - begin)))
        words = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(begin), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[inside])]
        )
        coded = words.dictionary_encode()
        self.words = coded.dictionary
        self.ids = coded.indices.to_numpy().astype(np.int64)
        self.own = _word_hashes(self.words.to_pylist(), lang)
        # Places where the next word stands in the same piece.
        piece = np.cumsum(kind == _BREAK, dtype=np.int32)[begin]
        self.goes_on = piece[1:] == piece[:-1]

    def eligible(self, longest: int, filters: list[Filter]) -> dict[int, np.ndarray]:
        """Per size, the places of the phrases that the pass with the last of the filters counts.

        The first pass counts a phrase whose first and last part are in its filter. A later one leaves out what was counted before, and
        there a part that nobody has counted yet may stand for one in the filter: so it leaves nothing to a further pass.
        """
        counted = {size: np.zeros(max(len(self.ids) - size + 1, 0), dtype=bool) for size in range(2, longest + 1)}
        own: dict[int, np.ndarray] = {}
        for k, allowing in enumerate(filters):
            part, hashes = allowing.has(self.own)[self.ids], self.own[self.ids]
            for size in range(2, longest + 1):
                met = part[:-1] & part[1:]
                if size == 2:
                    met &= self.goes_on  # longer ones are within a piece if their parts are
                own[size] = met & ~counted[size] if k else met
                if size < longest:
                    here = np.flatnonzero(met)
                    part, longer = np.zeros(len(met), dtype=bool), np.zeros(len(met), dtype=np.uint64)
                    longer[here] = _longer(hashes[here], self.own[self.ids[here + size - 1]])
                    part[here] = allowing.has(longer[here])
                    if k:
                        part |= own[size]
                    hashes = longer
            counted = {size: counted[size] | own[size] for size in own}
        return own

    def hashes(self, size: int, at: np.ndarray) -> np.ndarray:
        """Hashes of the phrases that begin there."""
        found = self.own[self.ids[at]]
        for k in range(1, size):
            found = _longer(found, self.own[self.ids[at + k]])
        return found

    def count(self, size: int, at: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """Distinct phrases that begin there, and how often each does; of single words, all."""
        if size == 1:
            return self.words.cast(pa.large_string()).cast(pa.string()), np.bincount(self.ids, minlength=len(self.words))
        key = self.ids[at]
        for k in range(1, size):  # exact numbers of ever longer phrases
            if k > 1:
                key = np.unique(key, return_inverse=True)[1]
            key = key * np.int64(len(self.words)) + self.ids[at + k]
        _, first, n = np.unique(key, return_index=True, return_counts=True)
        columns = [self.words.take(pa.array(self.ids[at[first] + k])) for k in range(size)]
        text = pc.binary_join_element_wise(*columns, pa.scalar(b" ", pa.large_binary()))
        return text.cast(pa.large_string()).cast(pa.string()), n


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """Texts gathered by language, all together up to ``HELD``; a longer text is cut behind the ends of pieces."""
    held: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    for batch in batches:
        lang, text = (batch.column(batch.schema.get_field_index(c)) for c in ("lang", "text"))
        for name, value in zip(lang.to_pylist(), text.cast(pa.large_binary()), strict=True):
            rest = value.as_py()
            while len(rest) > CHUNK:
                ends = np.flatnonzero(_KIND[np.frombuffer(rest, dtype=np.uint8)[CHUNK:]] == _BREAK)
                if not len(ends):
                    break
                cut = CHUNK + int(ends[0])
                yield name, [rest[:cut]]
                rest = rest[cut:]
            held.setdefault(name, []).append(rest)
            sizes[name] = sizes.get(name, 0) + len(rest) + 1
            full = name if sizes[name] >= CHUNK else max(sizes, key=sizes.get) if sum(sizes.values()) >= HELD else None
            if full is not None:
                del sizes[full]
                yield full, held.pop(full)
    yield from held.items()


def sieve(docs: DataFrame, sizes: list[int], filters: list[Filter], least: int) -> Filter:
    """Of the phrases of these sizes that the pass counts and its filter lacks, those that may occur ``least`` times.

    Each chunk of text hands on the sums of its phrases as arrays, one for each of 4,096 buckets; a task holds one bucket at a time.
    """
    shared = docs.sparkSession.sparkContext.broadcast([f.bits for f in filters])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = [Filter(bits) for bits in shared.value]
        for lang, texts in _chunks(batches):
            chunk = Chunk(texts, lang)
            places = chunk.eligible(max(sizes), filters)
            hashes = np.concatenate([chunk.hashes(size, np.flatnonzero(places[size])) for size in sizes])
            keys, n = np.unique(hashes[~filters[-1].has(hashes)] >> LEFT_OUT, return_counts=True)
            bucket = keys >> IN_BUCKET
            order = np.lexsort((n, bucket))  # equal numbers side by side take hardly any room
            keys, n, bucket = keys[order], n[order], bucket[order]
            starts = np.flatnonzero(np.diff(bucket, prepend=np.uint64(1 << 63)))
            ends = pa.array(np.append(starts, len(keys)).astype(np.int32))
            columns = [
                pa.array(bucket[starts].astype(np.int32)),
                pa.ListArray.from_arrays(ends, pa.array(keys.astype(np.uint32).view(np.int32))),
                pa.ListArray.from_arrays(ends, pa.array(n.astype(np.int32))),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["bucket", "keys", "n"])
            del chunk, places, hashes
        release_memory()

    def often(keys: list[np.ndarray], n: list[np.ndarray]) -> pa.RecordBatch:
        key, many = np.concatenate(keys), np.concatenate(n).astype(np.int64)
        order = np.argsort(key)
        key = key[order]
        starts = np.flatnonzero(np.diff(key, prepend=np.uint64(1 << 63)))
        sums = np.add.reduceat(many[order], starts) if len(starts) else many
        found = key[starts][sums >= least] * _ODD
        return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], names=["h"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n, last = [], [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            bucket, own = batch.column(0).to_numpy(), batch.column(1)
            each = np.repeat(bucket.astype(np.uint64), own.value_lengths().to_numpy())
            key = each << IN_BUCKET | own.flatten().to_numpy().view(np.uint32)
            many = batch.column(2).flatten().to_numpy()
            if last is not None and bucket[-1] != last:
                done = int(np.searchsorted(each, np.uint64(bucket[-1])))  # buckets come in order
                yield often([*keys, key[:done]], [*n, many[:done]])
                keys, n, key, many = [], [], key[done:], many[done:]
            keys.append(key)
            n.append(many)
            last = bucket[-1]
        if keys:
            yield often(keys, n)
        release_memory()

    sums = docs.select("lang", "text").mapInArrow(run, "bucket int, keys array<int>, n array<int>")
    found = sums.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(total, "h bigint")
    found = materialise(found, "sieved-phrases")
    return _filter_of(found, found.count())


def count_phrases(docs: DataFrame, sizes: list[int], filters: list[Filter], sieved: Filter | None = None) -> DataFrame:
    """(lang, phrase, a): exact counts of phrases of these sizes over (lang, text).

    Longer phrases than words count where the pass with the last of the filters counts them and, after a sieve, only those that this
    filter holds or the sieve has left. Size 0 stands for all words, as the empty phrase.
    """
    shared = docs.sparkSession.sparkContext.broadcast([[f.bits for f in filters], None if sieved is None else sieved.bits])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters, left = [Filter(bits) for bits in shared.value[0]], shared.value[1]
        left = None if left is None else Filter(left)
        for lang, texts in _chunks(batches):
            chunk = Chunk(texts, lang)
            places = chunk.eligible(max(sizes), filters)
            for size in sizes:
                if size == 0:
                    phrases, n = pa.array([""], pa.string()), np.array([len(chunk.ids)])
                else:
                    at = np.flatnonzero(places.get(size, []))
                    if left is not None and size > 1:
                        hashes = chunk.hashes(size, at)
                        at = at[filters[-1].has(hashes) | left.has(_sieve_key(hashes))]
                    phrases, n = chunk.count(size, at)
                for k in range(0, len(n), OUT_ROWS):
                    some, many = phrases[k : k + OUT_ROWS], n[k : k + OUT_ROWS]
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), some, pa.array(many)], names=["lang", "phrase", "a"])
            del chunk, places
        release_memory()

    rows = docs.select("lang", "text").mapInArrow(run, "lang string, phrase string, a bigint")
    # Counts of a chunk hardly repeat within a task: straight to the shuffle.
    return rows.repartition("lang", "phrase").groupBy("lang", "phrase").agg(F.sum("a").alias("a"))


def _size(phrase: str = "phrase") -> Column:
    """Words of a phrase; the empty one has none."""
    return F.when(F.col(phrase) == "", 0).otherwise(F.size(F.split(phrase, " ")))


def _hashes_of(lang: list[str], phrase: list[str]) -> np.ndarray:
    out = np.zeros(len(phrase), dtype=np.uint64)
    for i, (name, text) in enumerate(zip(lang, phrase, strict=True)):
        words = _word_hashes(text.encode().split(b" "), name)
        out[i] = reduce(_longer, [words[k : k + 1] for k in range(1, len(words))], words[:1])[0]
    return out


def _filter_of(hashes: DataFrame, n: int) -> Filter:
    """The filter of ``n`` hashes (h); only its words of 64 bits come to the driver, ``MOST_BITS / 64`` at most."""
    n_bits = min(MOST_BITS, 1 << max(16, (16 * n).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column(0).to_numpy().view(np.uint64)
            for slot in Filter.slots(hashes, n_bits):
                bits = np.uint64(1) << (slot & np.uint64(63))
                columns = [pa.array((slot >> np.uint64(6)).astype(np.int64)), pa.array(bits.view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["slot", "bits"])

    words = hashes.mapInArrow(run, "slot bigint, bits bigint")
    words = words.groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    bits = np.zeros(n_bits // 64, dtype=np.uint64)
    bits[words["slot"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return Filter(bits)


def make_filter(phrases: DataFrame) -> Filter:
    """The filter of phrases (lang, phrase)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = _hashes_of(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64))], names=["h"])

    return _filter_of(phrases.select("lang", "phrase").mapInArrow(run, "h bigint"), phrases.count())


def _outside(phrases: DataFrame, allowing: Filter) -> DataFrame:
    """Those of the phrases that the filter lacks."""
    shared = phrases.sparkSession.sparkContext.broadcast(allowing.bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        allowing = Filter(shared.value)
        for batch in batches:
            hashes = _hashes_of(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            yield batch.filter(pa.array(~allowing.has(hashes)))

    return phrases.select("lang", "phrase").mapInArrow(run, "lang string, phrase string")


def propose(sample: DataFrame, least: int, longest: int) -> Filter:
    """The phrases of a sample that occur ``least`` times there, word by word longer."""
    parts: list[DataFrame] = []
    filters: list[Filter] = []
    for size in range(1, longest):
        left = [sieve(sample, [size], filters, least)] if filters else []
        found = count_phrases(sample, [size], filters, *left).where(F.col("a") >= least)
        parts.append(materialise(found, "sampled-phrases"))
        filters = [make_filter(reduce(DataFrame.unionByName, parts))]
    return filters[0]


def frequent_phrases(docs: DataFrame, min_count: int = 30, longest: int = 4, share: float = SAMPLE_SHARE) -> DataFrame:
    """(lang, size, phrase, a) of all phrases of up to ``longest`` words that occur ``min_count`` times, exactly.

    Rows of size 0 hold the number of all words. ``docs`` has (lang, text) without nulls. ``share`` of
    the rows, by a hash of them, are the sample; it decides whether a second pass is needed and what it costs, never the result.
    """
    part = F.pmod(F.xxhash64(*docs.columns), F.lit(1 << 20)) < int(share * (1 << 20))
    sample = materialise(docs.where(part).select("lang", "text"), "sampled-documents")
    filters = [propose(sample, max(1, int(np.ceil(LOWERED * share * min_count))), longest)]

    sizes, parts = list(range(longest + 1)), []
    left = [sieve(docs, sizes[2:], filters, min_count)] if longest > 1 else []
    while True:
        kept = count_phrases(docs, sizes, filters, *left).where((F.col("a") >= min_count) | (F.col("phrase") == ""))
        parts.append(materialise(kept.withColumn("size", _size()), "counted-phrases"))
        known = reduce(DataFrame.unionByName, parts)
        extendable = known.where(F.col("size").between(1, longest - 1))
        # What an expansion pass finds, it has extended already: the border is closed.
        if len(parts) > 1 or _outside(extendable, filters[-1]).isEmpty():
            return known
        sizes, filters, left = list(range(2, longest + 1)), [*filters, make_filter(extendable)], []


def collocations(
    docs: DataFrame, min_count: int = 30, longest: int = 4, top: int = 2000, cover: int = 80, share: float = SAMPLE_SHARE
) -> DataFrame:
    """The ``top`` phrases of each language by how well their parts stick together.

    Words end at spaces and tabs, A-Z are lower-cased, and no phrase crosses one of ``. , ; : ! ?`` or a line's end. A phrase of 2 to
    ``longest`` words with a = its occurrences (overlaps included) of at least ``min_count`` is cut into a first part, l times
    in the language, and a rest, r times: the cut of the lowest floor(2000000 a / (l + r)) counts, of equal ones the first. A
    phrase inside a longer one that has ``cover`` per cent of its occurrences goes. Returns lang, rank, phrase, a, l, r, n
    (all words of the language) and score, by score, a (largest first) and phrase.

    A null language is ``und``, a null text empty; repeated rows count each. Other columns are not
    looked at. An empty table gives an empty table. A piece of a text may be of any length, but lies in one task.
    """
    own = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    found = materialise(frequent_phrases(own, min_count, longest, share), "frequent-phrases")
    totals = found.where("size = 0").select("lang", F.col("a").alias("n"))
    known = found.where("size > 0")
    long = known.where("size > 1").select("lang", "size", "phrase", "a", F.split("phrase", " ").alias("words"))

    def words(begin: str, length: str):
        return F.array_join(F.expr(f"slice(words, {begin}, {length})"), " ")

    cuts = long.select("*", F.explode(F.expr("sequence(1, size - 1)")).alias("k")).select(
        "lang", "phrase", "a", "k", words("1", "k").alias("head"), words("k + 1", "size - k").alias("tail")
    )
    heads = known.select("lang", F.col("phrase").alias("head"), F.col("a").alias("l"))
    tails = known.select("lang", F.col("phrase").alias("tail"), F.col("a").alias("r"))
    scored = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"])
    # Decimals: the product may pass 64 bits.
    score = F.expr("CAST(a AS DECIMAL(20, 0)) * 2000000 div (CAST(l AS DECIMAL(20, 0)) + r)")
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))

    inner = long.where("size > 2").select(
        "lang", F.col("a").alias("outer_a"), "words", "size", F.explode(F.expr("sequence(2, size - 1)")).alias("m")
    )
    inner = inner.select("*", F.explode(F.expr("sequence(1, size - m + 1)")).alias("at"))
    outer = inner.select("lang", words("at", "m").alias("phrase"), "outer_a").groupBy("lang", "phrase").agg(
        F.max("outer_a").alias("outer_a")
    )
    covered = F.expr(f"CAST(outer_a AS DECIMAL(20, 0)) * 100 >= CAST(a AS DECIMAL(20, 0)) * {cover}")
    kept = best.join(outer, ["lang", "phrase"], "left").where(~F.coalesce(covered, F.lit(False)))
    # Ranked in ranges over all tasks: a language may hold nearly all candidates.
    best_first = F.struct(F.negative("cut.score").alias("score"), F.negative("a").alias("a"), "phrase")
    listed = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score", best_first.alias("best_first"))
    ranked = numbered(listed, ["lang"], "best_first", "rank").where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
