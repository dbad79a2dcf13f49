"""Exact top-k inner products by MaxScore over sharded postings.

Each dimension is a query term with a posting list of the vectors that have it. Within a
shard a list has the smallest and largest weight, so a query bounds what each of its terms
can add. Terms are ordered by bound; the weakest ones that cannot lift a vector to the
k-th best score by themselves are non-essential: the essential lists are traversed, and
the others are probed, strongest first, only for vectors that can still compete. Shards
report their best k per query, which are merged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from folioflow.scale import materialise

#: Vectors of a shard, about.
SHARD_ROWS = 8192
#: Fewest shards, so that small tables keep all cores busy.
MIN_SHARDS = 24
#: Queries that meet a shard at a time.
BLOCK_QUERIES = 4096


class Postings:
    """The posting lists of a shard, one per dimension, with their bounds."""

    def __init__(self, ids: np.ndarray, weights: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.rows = ids[order], weights[order]
        self.lists = []  # per dimension the places that have it and their weights
        for column in self.rows.T:
            places = np.flatnonzero(column)
            self.lists.append((places, column[places].copy()))
        full = np.array([len(p) == len(ids) for p, _ in self.lists], dtype=bool)
        # A vector outside a list adds nothing, so zero bounds every list that is not full.
        self.high = np.where(full, self.rows.max(axis=0), np.maximum(self.rows.max(axis=0), 0))
        self.low = np.where(full, self.rows.min(axis=0), np.minimum(self.rows.min(axis=0), 0))

    def top(self, query: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
        """(score, id) of the best k vectors but ``own``, ties to smaller ids."""
        allowed = self.ids != own
        if not allowed.any():
            return []
        bound = np.maximum(query * self.high, query * self.low)
        terms = np.argsort(bound, kind="stable")  # weakest first
        # A first threshold: exact scores of the vectors strongest in the strongest term.
        places, weights = self.lists[terms[-1]]
        gain = weights * query[terms[-1]]
        seeds = places[np.argpartition(gain, -min(len(gain), 8 * k))[-8 * k :]] if len(gain) else places
        seeds = seeds[allowed[seeds]]
        scores = np.sort(self.rows[seeds] @ query)
        threshold = scores[-k] if len(scores) >= k else None

        reach = np.cumsum(bound[terms])  # what the weakest terms can add together
        weak = int(np.searchsorted(np.maximum.accumulate(reach), threshold)) if threshold is not None else 0
        weak = min(weak, len(terms) - 1)
        total = np.zeros(len(self.ids), dtype=np.int64)
        for t in terms[weak:]:
            places, weights = self.lists[t]
            if len(places) == len(total):
                total += query[t] * weights
            else:
                total[places] += query[t] * weights
        alive = np.flatnonzero(allowed)
        rest = int(reach[weak - 1]) if weak else 0
        if threshold is not None:
            alive = alive[total[alive] + rest >= threshold]
        sums = total[alive]
        for n in range(weak - 1, -1, -1):
            t = terms[n]
            rest -= int(bound[t])
            sums = sums + query[t] * self.rows[alive, t]
            if n % 4 == 0 and n:
                ahead = sums + rest >= threshold
                alive, sums = alive[ahead], sums[ahead]
        best = np.lexsort((self.ids[alive], -sums))[:k]
        return list(zip(sums[best].tolist(), self.ids[alive[best]].tolist(), strict=True))


def _matrix(values: pa.Array, width: int) -> np.ndarray:
    """Lists of integers as rows of one width; missing components are zero."""
    out = np.zeros((len(values), width), dtype=np.int64)
    flat, ends = values.flatten().to_numpy(), np.cumsum(pa.compute.list_value_length(values).to_numpy())
    sizes = np.diff(np.concatenate(([0], ends)))
    row = np.repeat(np.arange(len(values)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(ends - sizes, sizes)] = flat
    return out


def integer_vectors(embedding: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component; null for vectors that are null or hold null, NaN or infinity."""
    values = F.transform(embedding, lambda x: x.cast("double"))
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(finite, F.transform(values, lambda x: F.floor(x * scale).cast("long")))


def top_inner_products(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """The k best inner products of each query: (query_id, rank, vec_id, score).

    Both tables hold ``vec_id`` and ``weights`` (array of bigint). A row with the query's own id is no
    candidate; fewer than k are returned where there are fewer; ties go to smaller ids. Rows with null id or weights
    take no part. Vectors of different lengths meet as if padded with zeros; an empty vector scores
    zero. A ``vec_id`` that repeats among the vectors is several candidates, among the queries it is one
    query if the weights are the same. Empty tables give an empty result.
    """
    valid = F.col("vec_id").isNotNull() & F.col("weights").isNotNull()
    vectors = vectors.where(valid).select(F.col("vec_id").cast("long").alias("vec_id"), "weights")
    queries = queries.where(valid).select(F.col("vec_id").cast("long").alias("vec_id"), "weights").distinct()
    n, wanted = vectors.count(), queries.count()
    shards, blocks = max(MIN_SHARDS, -(-n // SHARD_ROWS)), max(1, -(-wanted // BLOCK_QUERIES))
    number = lambda parts: F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int")
    cell = [F.col("shard"), F.col("block")]
    left = vectors.select("vec_id", "weights", number(shards).alias("shard")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    )
    right = queries.select("vec_id", "weights", number(blocks).alias("block")).withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    )

    def search(found: pa.Table, asked: pa.Table) -> pa.Table:
        query, score, vec = [], [], []
        if found.num_rows and asked.num_rows:
            mine = found.column("weights").combine_chunks()
            theirs = asked.column("weights").combine_chunks()
            width = max(1, *(pa.compute.max(pa.compute.list_value_length(x)).as_py() for x in (mine, theirs)))
            postings = Postings(found.column("vec_id").to_numpy(), _matrix(mine, width))
            for own, weights in zip(asked.column("vec_id").to_pylist(), _matrix(theirs, width), strict=True):
                for s, v in postings.top(weights, own, k):
                    query.append(own)
                    score.append(s)
                    vec.append(v)
        kinds = pa.int64()
        return pa.table({"query_id": pa.array(query, kinds), "vec_id": pa.array(vec, kinds), "score": pa.array(score, kinds)})

    best = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(
        search, "query_id bigint, vec_id bigint, score bigint"
    )
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    merged = materialise(best, "shard-bests")
    return (
        merged.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
