"""SentencePiece encoding and decoding through a relational lattice.

Texts are cut where no piece can cross: before the spaces that begin a word, and between
characters that stand together in no piece. The units between the cuts repeat, so each
distinct one is encoded once: its substrings of at most a piece's length are exploded and
equi-joined to the piece table, the edges found are grouped by unit, and a fold over them
(Spark's ``aggregate``) keeps the best path to each place: Viterbi. The documents, packed
as numbers of their shard's units, stay where they were written; only units and their ids
move, and a shard's dictionary comes to the shard.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow.llm.common import map_columns, release_memory
from folioflow.scale import scratch_path

SPACE = "▁"
#: Text of a shard, in code points.
SHARD_BYTES = 24 << 20
#: Text of the chunks that a shard is made of; what a task holds unpacked.
CHUNK_BYTES = 1 << 20
#: Units of more code points are encoded by themselves, in blocks of so many places.
LONG_UNIT = 512
#: What a character without a piece costs more than the worst piece, as the library has it.
UNKNOWN_PENALTY = 10.0
#: Units that a task packs for their shards at a time.
PACK_ROWS = 1 << 15
#: Units of all shards that a task of the lattice gets, about; bounds what it sorts and hashes.
TASK_UNITS = 1 << 16


@dataclass(frozen=True)
class Model:
    """Pieces of a model with scores, and the ids of the 256 byte pieces."""

    pieces: list[str]
    scores: list[float]
    plain: list[bool]  # whether a piece stands for text
    byte_ids: list[int]
    unknown: int
    joined: frozenset[str] = field(repr=False)  # two characters that stand together in a piece

    @property
    def longest(self) -> int:
        return max(len(p) for p, ok in zip(self.pieces, self.plain, strict=True) if ok)

    @property
    def unknown_score(self) -> float:
        return min(s for s, ok in zip(self.scores, self.plain, strict=True) if ok) - UNKNOWN_PENALTY


def load_model(path: str) -> Model:
    """Read a model file; it must leave texts as they are, mark spaces and begin texts with a mark."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        proto.ParseFromString(file.read())
    spec = proto.normalizer_spec
    if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not (spec.add_dummy_prefix and spec.escape_whitespaces):
        raise ValueError(f"{path}: only models without normalization are supported")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(sp.get_piece_size())
    pieces = [sp.id_to_piece(i) for i in ids]
    plain = [not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)) for i in ids]
    texts = [p for p, ok in zip(pieces, plain, strict=True) if ok]
    if any(SPACE in p.lstrip(SPACE) for p in texts):
        raise ValueError(f"{path}: pieces across words are not supported")
    joined = frozenset(p[i : i + 2] for p in texts for i in range(len(p) - 1))
    if max(map(len, texts)) > 255 or len(pieces) >= _NO_PIECE:
        raise ValueError(f"{path}: the model's pieces are too long or too many")
    by_byte = {int(p[3:5], 16): i for i, p in enumerate(pieces) if sp.is_byte(i)}
    return Model(
        pieces, [sp.get_score(i) for i in ids], plain, [by_byte.get(b, sp.unk_id()) for b in range(256)], sp.unk_id(), joined
    )


class Cuts:
    """Finds the places that no piece crosses: between two characters that stand together in none."""

    def __init__(self, joined: frozenset[str]):
        chars = sorted({ord(c) for pair in joined for c in pair})
        self.number = np.zeros(0x110000, dtype=np.int32)  # 0: a character of no pair
        self.number[chars] = np.arange(1, len(chars) + 1)
        self.base = len(chars) + 1
        pairs = np.array([self._pair(self.number[ord(p[0])], self.number[ord(p[1])]) for p in joined], dtype=np.int64)
        self.bits = np.zeros((self.base * self.base + 7) // 8, dtype=np.uint8)  # one per pair of characters
        np.bitwise_or.at(self.bits, pairs >> 3, (1 << (pairs & 7)).astype(np.uint8))

    def _pair(self, a, b):
        return np.int64(self.base) * a + b

    def units(self, texts: list[str]) -> tuple[pa.Array, np.ndarray]:
        """The units of all texts in order, and how many each text has."""
        text = "".join(texts)
        points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
        number = self.number[points]
        begins = np.ones(len(points), dtype=bool)
        pairs = self._pair(number[:-1], number[1:])
        begins[1:] = (self.bits[pairs >> 3] >> (pairs & 7).astype(np.uint8)) & 1 == 0
        to = np.cumsum([len(t) for t in texts])
        begins[np.append(0, to[:-1])[[len(t) > 0 for t in texts]]] = True
        at = np.flatnonzero(begins)
        widths = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
        octets = np.append(0, np.cumsum(widths))[np.append(at, len(points))]
        units = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(octets.astype(np.int64)), pa.py_buffer(text.encode()))
        return units, np.diff(np.searchsorted(at, np.append(0, to)))


def units_of(text: str, joined: frozenset[str]) -> list[str]:
    """A text in the units that pieces stay within."""
    return Cuts(joined).units([text])[0].to_pylist()


# -- packing ---------------------------------------------------------------------


def _varint(values: np.ndarray) -> bytes:
    """Unsigned numbers in 7-bit groups, the last of each with its high bit unset."""
    v = values.astype(np.uint32)
    sizes = 1 + (v >= 1 << 7) + (v >= 1 << 14) + (v >= 1 << 21) + (v >= 1 << 28)
    ends = np.cumsum(sizes)
    out = np.empty(int(ends[-1]) if len(ends) else 0, dtype=np.uint8)
    for k in range(5):
        has = sizes > k
        more = (sizes[has] > k + 1).astype(np.uint32) << 7
        out[(ends - sizes)[has] + k] = ((v[has] >> np.uint32(7 * k)) & 127) | more
    return out.tobytes()


def _from_varint(data: bytes) -> np.ndarray:
    b = np.frombuffer(data, dtype=np.uint8)
    last = b < 128
    ends = np.flatnonzero(last)
    starts = np.concatenate(([0], ends[:-1] + 1)).astype(np.int64)[: len(ends)]
    place = np.arange(len(b)) - np.repeat(starts, ends - starts + 1)
    return np.add.reduceat((b & 127).astype(np.uint32) << (7 * place).astype(np.uint32), starts) if len(ends) else np.zeros(0, np.uint32)


def _ipc(batch: pa.RecordBatch) -> bytes:
    sink = io.BytesIO()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return zstandard.compress(sink.getvalue(), 1)


class _Shard:
    """Documents as numbers of the units met, until it is full."""

    def __init__(self, cuts: Cuts):
        self.cuts = cuts
        self.units: dict[str, int] = {}
        self.chunks: list[dict[str, bytes]] = []
        self.size = self.open_size = 0
        self.texts: list[str] = []
        self.kept: list[pa.RecordBatch] = []

    def add(self, text: str | None, kept: pa.RecordBatch) -> None:
        # Every text begins with a mark; an empty one has no units.
        self.texts.append(SPACE + text.replace(" ", SPACE) if text else "")
        digest = pa.array([xxhash.xxh64_intdigest((text or "").encode()) >> 1], pa.int64())
        # By number: the carried columns may have any names.
        self.kept.append(pa.RecordBatch.from_arrays([*kept.columns, digest], names=[*map(str, range(kept.num_columns)), "digest"]))
        self.open_size += len(text or "")
        if self.open_size >= CHUNK_BYTES:
            self.close_chunk()

    def close_chunk(self) -> None:
        if not self.texts:
            return
        met, sizes = self.cuts.units(self.texts)
        coded, units = met.dictionary_encode(), self.units
        numbers = [units.setdefault(u, len(units)) for u in coded.dictionary.to_pylist()]
        codes = np.array(numbers, dtype=np.uint32)[coded.indices.to_numpy()]
        docs = pa.Table.from_batches(self.kept).combine_chunks()
        docs = docs.append_column("n_codes", pa.array(sizes, pa.int64())).to_batches()[0]
        self.chunks.append({"docs": _ipc(docs), "codes": zstandard.compress(_varint(codes), 3)})
        self.size += self.open_size
        self.open_size, self.texts, self.kept = 0, [], []

    def row(self, number: int) -> pa.RecordBatch:
        self.close_chunk()
        chunk = pa.struct([("docs", pa.binary()), ("codes", pa.binary())])
        columns = [
            pa.array([number], pa.int64()),
            pa.array([self.chunks], pa.list_(chunk)),
            pa.array([list(self.units)], pa.list_(pa.string())),
            pa.array([len(self.units)], pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["shard", "chunks", "units", "n_units"])


def _spans(first: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Places of the members of the lists ``which``, one list after the other."""
    n = sizes[which]
    to = np.cumsum(n)
    return np.arange(int(to[-1]) if len(to) else 0) + np.repeat(first[which] - (to - n), n)


def _packed(docs: DataFrame, carry: list[str], joined: frozenset[str], shard_bytes: int) -> DataFrame:
    """One row per shard, written once, bucketed by shard so that joins leave it in place."""
    spark = docs.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = Cuts(joined)
        number, shard = TaskContext.get().partitionId() << 32, _Shard(cuts)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            kept = batch.select(carry)
            for at in range(batch.num_rows):
                shard.add(texts[at].as_py(), kept.slice(at, 1))
                if shard.size >= shard_bytes:
                    yield shard.row(number)
                    number, shard = number + 1, _Shard(cuts)
        if shard.texts or shard.chunks:
            yield shard.row(number)
        del cuts, shard
        release_memory()

    columns = [F.col(f"`{c}`") for c in dict.fromkeys([*carry, "text"])]
    packed = docs.select(*columns).mapInArrow(
        run, "shard bigint, chunks array<struct<docs: binary, codes: binary>>, units array<string>, n_units bigint"
    )
    name, buckets = f"packed_{uuid.uuid4().hex}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed.write.bucketBy(buckets, "shard").option("compression", "zstd").option("path", scratch_path(spark, name)).saveAsTable(name)
    return spark.table(name)


# -- lattice ---------------------------------------------------------------------


#: Bits of an edge's place: its end, 255 less its length, its piece. Sorted by it, edges to one place begin with the longest.
_END, _LENGTH, _PIECE = 28, 20, (1 << 20) - 1
#: Stands for the piece of a character that has none.
_NO_PIECE = _PIECE


def _end(place: Column) -> Column:
    return F.shiftright(place, _END).cast("int")


def _begin(place: Column) -> Column:
    return _end(place) - 255 + F.shiftright(place, _LENGTH).cast("int").bitwiseAND(0xFF)


def _edges(texts: DataFrame, key: str, most: int, spark: SparkSession, model: Model) -> DataFrame:
    """(key, edge) for each substring that is a piece, and for each character that is none.

    ``texts`` has (key, base, s): a text and the number of characters before it in its unit; substrings begin
    with one of its first ``most`` characters.
    """
    # The piece table is as large as the vocabulary, whatever the corpus.
    rows = [(p, i, s) for i, (p, s, ok) in enumerate(zip(model.pieces, model.scores, model.plain, strict=True)) if ok]
    table = F.broadcast(spark.createDataFrame(rows, "piece string, piece_id int, score double"))
    last = F.least(F.char_length("s"), F.lit(most))
    begins = texts.select(key, "base", "s", F.explode(F.sequence(F.lit(1), last)).alias("b"))
    sizes = F.sequence(F.lit(1), F.least(F.lit(model.longest), F.char_length("s") - F.col("b") + 1))
    exploded = begins.select(key, "base", "s", "b", F.explode(sizes).alias("n")).select(
        key, "base", "b", "n", F.substring(F.col("s"), F.col("b"), F.col("n")).alias("s")
    )
    known = F.col("piece_id").isNotNull()
    end = (F.col("base") + F.col("b") + F.col("n") - 1).cast("long")
    place = (
        F.shiftleft(end, _END)
        .bitwiseOR(F.shiftleft((255 - F.col("n")).cast("long"), _LENGTH))
        .bitwiseOR(F.coalesce("piece_id", F.lit(_NO_PIECE)).cast("long"))
    )
    return exploded.join(table, F.col("s") == F.col("piece"), "left").where(known | (F.col("n") == 1)).select(
        key,
        F.struct(place.alias("place"), F.coalesce("score", F.lit(model.unknown_score)).alias("score")).alias("edge"),
    )


_NODES = "array<struct<score: double, back: bigint>>"


def _origin() -> Column:
    return F.struct(F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("back"))


def _through(edge: Column, before: Column) -> Column:
    """A path that ends with this edge: its score, and the edge's place negated, so that of equal scores the longest piece is greatest."""
    return F.struct((before + edge["score"]).alias("score"), F.negative(edge["place"]).alias("back"))


def _taken(place: Column) -> Column:
    """The piece of an edge; a character without a piece is the negative of its place."""
    piece = place.bitwiseAND(_PIECE).cast("int")
    return F.when(piece == _NO_PIECE, -_end(place)).otherwise(piece)


def _viterbi(edges: Column) -> Column:
    """Piece ids of the best path over edges sorted by place; of equal paths the one whose last piece is longest.

    The fold keeps, for each place, the score and the last edge of the best path to it. A second fold, from the end, follows the edges back.
    """
    start = F.struct(F.array().cast(_NODES).alias("done"), _origin().alias("best"))

    def step(state: Column, edge: Column) -> Column:
        done, best, begin = state["done"], state["best"], _begin(edge["place"])
        # The first edge to a place settles the place before it.
        first = F.size(done) < _end(edge["place"])
        path = _through(edge, F.when(begin == F.size(done), best["score"]).otherwise(F.get(done, begin)["score"]))
        return F.struct(
            F.when(first, F.array_append(done, best)).otherwise(done).alias("done"),
            F.when(first, path).otherwise(F.greatest(best, path)).alias("best"),
        )

    def follow(state: Column, node: Column) -> Column:
        place = F.negative(node["back"])
        taken = F.struct(_begin(place).alias("at"), F.array_append(state["ids"], _taken(place)).alias("ids"))
        return F.when((_end(place) == state["at"]) & (_end(place) > 0), taken).otherwise(state)

    settled = F.aggregate(edges, start, step, lambda s: F.reverse(F.array_append(s["done"], s["best"])))
    last = F.struct(_end(F.element_at(edges, -1)["place"]).alias("at"), F.array().cast("array<int>").alias("ids"))
    return F.aggregate(settled, last, follow, lambda s: F.reverse(s["ids"]))


def _viterbi_in_blocks(blocks: Column) -> Column:
    """The same for long units, over their edges in blocks of places.

    A fold copies its state at every step. So the fold over a block's edges holds the places of that block and the one before
    (no piece reaches further back), and only the fold over the blocks holds all places.
    """
    start = F.struct(F.array().cast(f"array<{_NODES}>").alias("filed"), F.array().cast(_NODES).alias("done"), _origin().alias("best"))

    def settle(held: Column, block: Column) -> Column:
        before = F.size(held["done"])
        gone = F.size(held["filed"]) * LONG_UNIT - before

        def step(state: Column, edge: Column) -> Column:
            done, best, begin = state["done"], state["best"], _begin(edge["place"]) - gone
            first = F.size(done) + gone < _end(edge["place"])
            path = _through(edge, F.when(begin == F.size(done), best["score"]).otherwise(F.get(done, begin)["score"]))
            return F.struct(
                F.when(first, F.array_append(done, best)).otherwise(done).alias("done"),
                F.when(first, path).otherwise(F.greatest(best, path)).alias("best"),
            )

        def file(state: Column) -> Column:
            own = F.slice(state["done"], before + 1, F.size(state["done"]) - before)
            return F.struct(F.array_append(held["filed"], own).alias("filed"), own.alias("done"), state["best"].alias("best"))

        return F.aggregate(block["edges"], F.struct(held["done"].alias("done"), held["best"].alias("best")), step, file)

    def follow(state: Column, node: Column) -> Column:
        place = F.negative(node["back"])
        taken = F.struct(_begin(place).alias("at"), F.array_append(state["ids"], _taken(place)).alias("ids"))
        return F.when((_end(place) == state["at"]) & (_end(place) > 0), taken).otherwise(state)

    def follow_block(held: Column, nodes: Column) -> Column:
        empty = F.struct(held["at"].alias("at"), F.array().cast("array<int>").alias("ids"))
        return F.aggregate(
            F.reverse(nodes), empty, follow,
            lambda s: F.struct(s["at"].alias("at"), F.array_append(held["parts"], s["ids"]).alias("parts")),
        )

    settled = F.aggregate(blocks, start, settle, lambda s: F.reverse(F.array_append(s["filed"], F.array(s["best"]))))
    end = _end(F.element_at(F.element_at(blocks, -1)["edges"], -1)["place"])
    last = F.struct(end.alias("at"), F.array().cast("array<array<int>>").alias("parts"))
    return F.aggregate(settled, last, follow_block, lambda s: F.reverse(F.flatten(s["parts"])))


def _grouped(edges: DataFrame, key: str) -> DataFrame:
    return edges.groupBy(key).agg(F.sort_array(F.collect_list("edge")).alias("edges"))


def _spelled(ids: Column, char_at, model: Model) -> Column:
    """Piece ids with the pieces of the bytes in place of characters without a piece."""
    octets = F.array(*[F.lit(i) for i in model.byte_ids])

    def in_bytes(place: Column) -> Column:
        char = F.encode(char_at(place), "UTF-8")
        return F.transform(
            F.sequence(F.lit(1), F.octet_length(char)),
            lambda k: F.element_at(octets, F.conv(F.hex(F.substring(char, k, F.lit(1))), 16, 10).cast("int") + 1),
        )

    spelled = F.flatten(F.transform(ids, lambda i: F.when(i < 0, in_bytes(i)).otherwise(F.array(i))))
    return F.when(F.array_min(ids) < 0, spelled).otherwise(ids)


def encode_units(units: DataFrame, model: Model) -> DataFrame:
    """(unit, ids) for distinct units of at most ``LONG_UNIT`` characters; those without a piece become the pieces of their bytes."""
    texts = units.select("unit", F.lit(0).alias("base"), F.col("unit").alias("s"))
    grouped = _grouped(_edges(texts, "unit", LONG_UNIT, units.sparkSession, model), "unit")
    paths = grouped.select("unit", _viterbi(F.col("edges")).alias("ids"))
    return paths.select("unit", _spelled(F.col("ids"), lambda i: F.substring(F.col("unit"), -i, F.lit(1)), model).alias("ids"))


def encode_long_units(units: DataFrame, model: Model) -> DataFrame:
    """The same for longer units, of any length: they go by a digest, their text in blocks that overlap by a piece.

    All edges of a unit lie in one task: what that takes grows with the longest text without any safe cut.
    """
    marked = units.select("unit", F.md5("unit").alias("mark"))
    first = F.sequence(F.lit(0), F.floor((F.char_length("unit") - 1) / LONG_UNIT).cast("int"))
    blocks = F.transform(
        first,
        lambda k: F.struct(
            (k * LONG_UNIT).alias("base"), F.substring(F.col("unit"), k * LONG_UNIT + 1, F.lit(LONG_UNIT + model.longest - 1)).alias("s")
        ),
    )
    texts = marked.select("mark", F.explode(blocks).alias("block")).select("mark", "block.base", "block.s")
    edges = _edges(texts, "mark", LONG_UNIT, units.sparkSession, model)
    block = F.floor((_end(F.col("edge.place")) - 1) / LONG_UNIT).cast("int")
    filed = edges.groupBy("mark", block.alias("block")).agg(F.sort_array(F.collect_list("edge")).alias("edges"))
    grouped = filed.groupBy("mark").agg(F.array_sort(F.collect_list(F.struct("block", "edges")), lambda x, y: x["block"] - y["block"]).alias("blocks"))
    paths = grouped.select(F.col("mark").alias("path"), _viterbi_in_blocks(F.col("blocks")).alias("ids"))
    met = marked.join(paths, F.col("mark") == F.col("path")).withColumn("chars", F.split("unit", ""))
    return met.select("unit", _spelled(F.col("ids"), lambda i: F.element_at("chars", -i), model).alias("ids"))


# -- dictionaries back to their shards --------------------------------------------


def _dictionary_parts(entries: DataFrame) -> DataFrame:
    """(shard, part) with the numbers and ids of many units in each part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def packed() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            order = np.argsort(table.column(0).to_numpy(), kind="stable")
            table = table.take(pa.array(order))
            shard, ids = table.column(0).to_numpy(), table.column(2)
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(shard)) + 1, [len(shard)]))
            parts = [_ipc(pa.RecordBatch.from_arrays([table.column(1)[b:e], ids[b:e]], names=["no", "ids"])) for b, e in zip(cuts[:-1], cuts[1:], strict=True)]
            return pa.RecordBatch.from_arrays(
                [pa.array(shard[cuts[:-1]]), pa.array(parts, pa.binary())], names=["shard", "part"]
            )

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                if sum(b.num_rows for b in held) >= PACK_ROWS:
                    yield packed()
                    held = []
        if held:
            yield packed()

    return entries.select("shard", "no", "ids").mapInArrow(run, "shard bigint, part binary")


def _read_ipc(data: bytes) -> pa.RecordBatch:
    raw = zstandard.ZstdDecompressor().decompress(data)
    return pa.ipc.open_stream(pa.BufferReader(raw)).read_next_batch()


def _dictionary(parts: pa.Scalar) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All ids of a shard's dictionary, and where those of each unit begin and how many they are."""
    got = [_read_ipc(p.as_py()) for p in parts] if parts.is_valid else []
    if not got:
        return np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
    no = np.concatenate([g.column("no").to_numpy() for g in got])
    sizes = np.concatenate([pc.list_value_length(g.column("ids")).to_numpy() for g in got]).astype(np.int64)
    flat = np.concatenate([g.column("ids").flatten().to_numpy() for g in got])
    size, first = np.empty(len(no), dtype=np.int64), np.empty(len(no), dtype=np.int64)
    size[no], first[no] = sizes, np.cumsum(sizes) - sizes
    return flat, first, size


def _pieces_text(ids: list[int], pieces: list[str], byte_of: dict[int, int]) -> str:
    """The text of ids, less the mark that texts begin with; bytes that are no UTF-8 become replacement marks."""
    if byte_of.keys().isdisjoint(ids):
        text = "".join([pieces[i] for i in ids])
    else:
        raw = b"".join(bytes([byte_of[i]]) if i in byte_of else pieces[i].encode() for i in ids)
        text = raw.decode(errors="replace")
    return text.replace(SPACE, " ")[1:]


def encode(docs: DataFrame, model: Model, carry: list[str] | None = None, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Piece ids of whole texts, checked by reading them back.

    Returns the columns ``carry`` (default: doc_id; those of the results' names are replaced) with ``ids``, ``n_ids`` and ``round_trip``: whether decoding
    gives the text again. That is so for every text without the mark U+2581 itself, which reads back as a space.
    Null and empty texts have no ids and read back empty. Each row is encoded, repeated ones alike. An empty table gives an empty table.
    """
    spark, results = docs.sparkSession, {"ids", "n_ids", "round_trip"}
    carry = [c for c in carry or ["doc_id"] if c.lower() not in results]
    packed = _packed(docs, carry, model.joined, shard_bytes)
    entries = packed.select("shard", F.posexplode("units").alias("no", "unit"))
    # One exchange by unit serves the lattice and the way back: both read the same columns of it.
    n_units = packed.agg(F.sum("n_units")).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_units // TASK_UNITS))
    entries = entries.withColumn("unit", F.coalesce("unit", F.lit(""))).repartition(tasks, "unit")
    met = entries.groupBy("unit").agg(F.min("shard").alias("_shard"), F.min("no").alias("_no"))
    units = met.where("_shard >= 0 AND _no >= 0").select("unit")
    long = F.char_length("unit") > LONG_UNIT
    encoded = encode_units(units.where(~long), model).hint("shuffle_hash")
    parts = _dictionary_parts(entries.where(~long).join(encoded, "unit"))
    # Units without a safe cut are rare, and may be of any length: they take a way of their own.
    rare = encode_long_units(entries.where(long).select("unit").distinct(), model)
    parts = parts.unionByName(_dictionary_parts(entries.where(long).join(rare, "unit")))
    dictionary = parts.groupBy(F.col("shard").alias("its_shard")).agg(F.collect_list("part").alias("parts"))
    # Left: a shard of texts without any unit has no dictionary.
    shards = packed.select("shard", "chunks").join(dictionary, F.col("shard") == F.col("its_shard"), "left")
    pieces = spark.sparkContext.broadcast((model.pieces, {i: b for b, i in enumerate(model.byte_ids)}))
    fields = [docs.schema[c] for c in carry]
    added = T._parse_datatype_string("ids array<int>, n_ids bigint, round_trip boolean").fields
    names = [*carry, "ids", "n_ids", "round_trip"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, byte_of = pieces.value
        for batch in batches:
            for row in range(batch.num_rows):
                flat, first, size = _dictionary(batch.column("parts")[row])
                for chunk in batch.column("chunks")[row]:
                    own = _read_ipc(chunk["docs"].as_py())
                    codes = _from_varint(zstandard.ZstdDecompressor().decompress(chunk["codes"].as_py()))
                    ends = np.cumsum(own.column("n_codes").to_numpy())
                    digests = own.column("digest").to_pylist()
                    for at in range(0, own.num_rows, 128):
                        stop = min(at + 128, own.num_rows)
                        low = int(ends[at - 1]) if at else 0
                        mine = codes[low : int(ends[stop - 1])]
                        ids = flat[_spans(first, size, mine)]
                        to = np.concatenate(([0], np.cumsum(size[mine])))
                        marks = to[np.concatenate(([0], ends[at:stop] - low))]
                        lists = pa.ListArray.from_arrays(pa.array(marks, pa.int32()), pa.array(ids, pa.int32()))
                        same = [
                            xxhash.xxh64_intdigest(_pieces_text(ids[b:e].tolist(), texts, byte_of).encode()) >> 1 == d
                            for b, e, d in zip(marks[:-1], marks[1:], digests[at:stop], strict=True)
                        ]
                        kept = own.slice(at, stop - at).columns[: len(carry)]
                        counts = pa.array(np.diff(marks), pa.int64())
                        yield pa.RecordBatch.from_arrays([*kept, lists, counts, pa.array(same, pa.bool_())], names=names)

    return shards.mapInArrow(run, T.StructType([*fields, *added]))


def decode(tokens: DataFrame, model: Model, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """Add the text of piece ids; null ids give null, empty ones an empty text, ids that are no text nothing."""
    byte_of = {i: b for b, i in enumerate(model.byte_ids) if i != model.unknown}
    shown = [p if ok else "" for p, ok in zip(model.pieces, model.plain, strict=True)]
    shared = tokens.sparkSession.sparkContext.broadcast((shown, byte_of))

    def start():
        pieces, bytes_ = shared.value

        def step(lists):
            return [pa.array([None if x is None else _pieces_text(x, pieces, bytes_) for x in lists], pa.string())]

        return step

    return map_columns(tokens, [ids], f"{name} string", start)
