"""Ordinal quality classifier: cumulative links over hashed text features.

A document's grade is ordered: 0 toxic, 1 poor, 2 good. One weight vector over hashed
features gives a score, and ordered thresholds turn it into P(grade > k) =
sigmoid(score - threshold k) for every k: proportional odds. The expected grade is the sum of these
tail probabilities; selection looks at the last one.
"""

from __future__ import annotations

from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.llm.common import map_columns

#: Hash buckets of the features.
BUCKETS = 1 << 18
#: Labelled rows that the classifier is fitted on: those with the smallest id hashes, the same at any size of the table.
TRAIN_ROWS = 6000
GRADES = 3
#: A document is kept if its probability of the best grade is at least this.
KEEP = 0.5
#: A feature is fitted if it is in so many rows and goes with a grade by so many standard deviations.
LEAST_ROWS, LEAST_Z = 4, 4.5
#: Distinct tokens whose features a task remembers.
MEMO = 100_000

#: Marks that are no part of a word at its edges.
_EDGE = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())


def _token_features(token: str) -> tuple[int, ...]:
    """Buckets of a token: its word without case and edge marks, its shape, and the marks after it."""
    front = token.rstrip(_EDGE)
    word = front.lstrip(_EDGE)
    shape = "upper" if word.isupper() and len(word) > 1 else "title" if word[:1].isupper() else "lower" if word else "none"
    names = [word.lower(), "s " + shape, "m " + token[len(front) :][-4:]]
    return tuple([crc32(n.encode()) % BUCKETS for n in names])


def _share(name: str, part: int, whole: int) -> list[int]:
    """Buckets of a share, one for each tenth that it reaches."""
    return [crc32(f"{name} {k}".encode()) % BUCKETS for k in range(1, 11) if 10 * part >= k * whole]


class Features:
    """Distinct buckets of texts; remembers what it worked out for tokens."""

    def __init__(self):
        self.memo: dict[str, tuple[int, ...]] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").split()
        distinct, buckets, memo = set(words), set(), self.memo
        upper = marked = 0
        for w in distinct:
            got = memo.get(w)
            if got is None:
                if len(memo) >= MEMO:
                    memo.clear()
                got = memo[w] = _token_features(w)
            buckets.update(got)
            upper += w.isupper()
            marked += not w[-1].isalnum() and w[-1] not in ".,"
        if words:
            buckets.update(_share("distinct", len(distinct), len(words)))
            buckets.update(_share("upper", upper, len(distinct)))
            buckets.update(_share("marked", marked, len(distinct)))
        buckets.update(crc32(f"length {k}".encode()) % BUCKETS for k in range(len(words).bit_length() + 1))
        return np.sort(np.fromiter(buckets, dtype=np.int64, count=len(buckets)))  # sums never depend on the order met


@dataclass(frozen=True)
class Model:
    """Weights shared by all grades, and thresholds in ascending order."""

    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, buckets: np.ndarray) -> np.ndarray:
        """P(grade > k) for each k but the last grade."""
        return _sigmoid(self.weights[buckets].sum() - self.thresholds)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def telling(rows: list[np.ndarray], grades: np.ndarray) -> np.ndarray:
    """Buckets whose presence goes with some cut of the grades by more than chance (``LEAST_Z`` deviations)."""
    n, flat = len(rows), np.concatenate(rows)
    count, size = np.bincount(flat, minlength=BUCKETS), np.array([len(r) for r in rows])
    strongest = np.zeros(BUCKETS)
    for k in range(GRADES - 1):
        low = (grades <= k).astype(float)
        met = np.bincount(flat, weights=np.repeat(low, size), minlength=BUCKETS)
        variance = count * (1 - count / n) * low.mean() * (1 - low.mean())
        strongest = np.maximum(strongest, np.abs(met - count * low.mean()) / np.sqrt(variance + 1e-9))
    return np.flatnonzero((count >= LEAST_ROWS) & (strongest > LEAST_Z))


def fit(rows: list[np.ndarray], grades: np.ndarray, penalty: float = 1e-4, rounds: int = 150) -> Model:
    """Maximum likelihood with a quadratic penalty over the telling features, by full-batch Adam steps.

    Threshold k is the first plus the exponentials of the steps up to k, so the order always
    holds. Features are centred while fitting. Without rows, or with one grade only, the thresholds carry the (smoothed) shares.
    """
    n = len(rows)
    shares = np.array([(np.sum(grades > k) + 0.5) / (n + 1) for k in range(GRADES - 1)])
    cuts = -np.log(shares / (1 - shares))
    steps = np.concatenate((cuts[:1], np.log(np.maximum(np.diff(cuts), 1e-3))))
    weights = np.zeros(BUCKETS)
    used = telling(rows, grades) if n and len(np.unique(grades)) > 1 else np.zeros(0, dtype=np.int64)
    if not len(used):
        return Model(weights, steps[0] + np.concatenate(([0.0], np.cumsum(np.exp(steps[1:])))))
    column = np.full(BUCKETS, -1)
    column[used] = np.arange(len(used))
    place = column[np.concatenate(rows)]
    row = np.repeat(np.arange(n), [len(r) for r in rows])[place >= 0]
    place = place[place >= 0]
    share = np.bincount(place, minlength=len(used)) / n
    params = np.concatenate((np.zeros(len(used)), steps))
    first, second = np.zeros_like(params), np.zeros_like(params)
    for t in range(1, rounds + 1):
        w, s = params[: len(used)], params[len(used) :]
        theta = s[0] + np.concatenate(([0.0], np.cumsum(np.exp(s[1:]))))
        score = np.bincount(row, weights=w[place], minlength=n) - w @ share
        # P(grade <= k) with bounds 0 and 1 at the ends; likelihood of a grade is a difference of two.
        p_up = _sigmoid(np.concatenate((theta, [np.inf]))[grades] - score)
        p_low = _sigmoid(np.concatenate(([-np.inf], theta))[grades] - score)
        p = np.maximum(p_up - p_low, 1e-12)
        d_up, d_low = p_up * (1 - p_up) / p, p_low * (1 - p_low) / p
        by_score = d_up - d_low  # of the negative log likelihood
        by_theta = np.array([np.sum(d_low[grades == k + 1]) - np.sum(d_up[grades == k]) for k in range(GRADES - 1)])
        gradient = np.empty_like(params)
        met = np.bincount(place, weights=by_score[row], minlength=len(used)) - share * by_score.sum()
        gradient[: len(used)] = met / n + penalty * w
        gradient[len(used)] = by_theta.sum() / n
        for k in range(1, len(s)):
            gradient[len(used) + k] = by_theta[k:].sum() * np.exp(s[k]) / n
        first += 0.1 * (gradient - first)
        second += 0.01 * (gradient**2 - second)
        rate = 0.1 * min(1.0, 4 * (1 - t / (rounds + 1)))
        params -= rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)
    weights[used], s = params[: len(used)], params[len(used) :]
    return Model(weights, weights[used] @ share + s[0] + np.concatenate(([0.0], np.cumsum(np.exp(s[1:])))))


def grade(quality: Column, toxic: Column) -> Column:
    """Graded rating of a label row; null where it has no rating."""
    return F.when(toxic == 1, 0).when(quality == 0, 1).when(quality == 1, 2).cast("int")


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Fit on at most ``rows`` labelled documents, chosen by the hash of their id.

    Only those rows' feature buckets reach the driver. Labels without an id or a rating are left
    out, as are labels without a document; of rows that repeat an id that with the smallest hash of its text is taken.
    """
    rated = labels.select(F.col("doc_id").alias("label_doc"), grade(F.col("quality"), F.col("toxic")).alias("grade"))
    chosen = (
        rated.where("label_doc IS NOT NULL AND grade IS NOT NULL")
        .groupBy("label_doc").agg(F.min("grade").alias("grade"))
        .orderBy(F.xxhash64("label_doc"), "label_doc").limit(rows)
    )

    def start():
        features = Features()

        def step(texts):
            return [pa.array([features(t) for t in texts], pa.list_(pa.int64()))]

        return step

    # The chosen labels are bounded by ``rows``, and so are the documents that meet them: one of each id.
    texts = docs.select(F.col("doc_id").alias("its_doc"), "text")
    own = texts.join(F.broadcast(chosen), F.col("its_doc") == F.col("label_doc")).groupBy("label_doc").agg(
        F.min("grade").alias("grade"), F.min_by("text", F.xxhash64("text")).alias("text")
    )
    got = map_columns(own, ["text"], "buckets array<bigint>", start, drop=("text",)).toPandas().sort_values("label_doc")
    return fit(list(got["buckets"]), got["grade"].to_numpy(dtype=np.int64))


RESULTS = "expected_grade double, p_fair double, p_good double, keep boolean"


def rate(docs: DataFrame, model: Model, least: float = KEEP) -> DataFrame:
    """Add the expected grade, the tail probabilities P(grade > 0) and P(grade > 1), and ``keep``.

    ``keep`` is whether P(grade > 1) is at least ``least``. Columns of these names are replaced. Null and empty
    texts have the features of a text without words. Repeated rows are treated alike. A map without a shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        features, model = Features(), shared.value

        def step(texts):
            tails = [model.tails(features(t)) for t in texts]
            return [
                pa.array([float(t.sum()) for t in tails], pa.float64()),
                pa.array([float(t[0]) for t in tails], pa.float64()),
                pa.array([float(t[1]) for t in tails], pa.float64()),
                pa.array([bool(t[1] >= least) for t in tails], pa.bool_()),
            ]

        return step

    return map_columns(docs, ["text"], RESULTS, start)
