"""Line de-duplication over levelled sorted runs of line hashes.

Documents come in batches. The hashes of all lines met so far lie in sorted runs, each
line in exactly one of them. A new batch is merge-anti-joined with the runs: lines met
for the first time become a run of their own, lines met before go to a small tally.
``FAN_IN`` runs of one level are merged into one of the next, so a batch never meets more
than ``(FAN_IN - 1) * levels`` runs. The runs hold a hash, a count and the largest
document id per line, never text. Built-in Spark functions only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.llm.common import ascii_lower, free_names, without
from folioflow.scale import materialise

#: Runs of one level that are merged into one of the next.
FAN_IN = 2
#: Batches that a whole table is fed in, at any size; batches of a stream come one by one.
BATCHES = 4
#: Shortest key, in code points, that counts as a line worth removing.
MIN_CHARS = 40
#: Documents that must share a line.
MIN_DOCS = 5

_SPACE = " \t\n\x0b\x0c\r"
_ENTRY = ["line", "n_docs", "last_doc"]


def lines_of(text: Column) -> Column:
    """The lines of a text; null and the empty text are one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_id(line: Column, min_chars: int = MIN_CHARS) -> Column:
    """128-bit digest of a line's key; null for lines whose key is too short."""
    key = ascii_lower(F.btrim(line, F.lit(_SPACE)))
    return F.when(F.char_length(key) >= min_chars, F.md5(key))


def line_entries(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row (doc_id, line) per document row and distinct long line of it."""
    ids = F.array_distinct(
        F.filter(F.transform(lines_of(F.col("text")), lambda l: line_id(l, min_chars)), lambda k: k.isNotNull())
    )
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.explode(ids).alias("line"))


def _batch_of(doc_id: str, batches: int) -> Column:
    return F.pmod(F.xxhash64(F.col(doc_id)), F.lit(batches)).cast("int")


class LineRuns:
    """The runs, by level, and the tally of lines that came again.

    All tables lie in the shared folder; losing an executor loses nothing. Batches
    are (line, n_docs, last_doc) frames with one row per line.
    """

    def __init__(self, spark: SparkSession, fan_in: int = FAN_IN):
        self.spark, self.fan_in = spark, fan_in
        self.levels: list[list[DataFrame]] = []
        self.tally: list[DataFrame] = []

    def _write(self, run: DataFrame, name: str) -> DataFrame:
        return materialise(run.sortWithinPartitions("line"), name)

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def add(self, batch: DataFrame) -> None:
        """Take in a batch: new lines become a run, known ones a part of the tally."""
        held = self.runs()
        if held:
            known = reduce(DataFrame.union, [run.select("line") for run in held])
            fresh = batch.join(known, "line", "left_anti")
            self.tally.append(self._write(batch.join(known, "line", "left_semi"), "line-tally"))
        else:
            fresh = batch
        self._push(self._write(fresh.select(*_ENTRY), "line-run"), 0)

    def _push(self, run: DataFrame, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fan_in:
            merged = reduce(DataFrame.union, self.levels[level]).repartition("line")
            self.levels[level] = []
            self._push(self._write(merged, "line-run"), level + 1)

    def repeated(self, min_docs: int = MIN_DOCS) -> DataFrame:
        """(line, last_doc) of the lines in at least ``min_docs`` documents."""
        parts = [*self.runs(), *self.tally]
        if not parts:
            return self.spark.createDataFrame([], "line string, last_doc bigint")
        return (
            reduce(DataFrame.union, [p.select(*_ENTRY) for p in parts])
            .groupBy("line")
            .agg(F.sum("n_docs").alias("n_docs"), F.max("last_doc").alias("last_doc"))
            .where(F.col("n_docs") >= min_docs)
            .select("line", "last_doc")
        )


def dedup_lines(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES
) -> DataFrame:
    """Documents without the lines that many documents share.

    A long line found in at least ``min_docs`` documents stays only in the largest
    ``doc_id`` that holds it. Adds ``n_lines`` (before), ``n_dropped`` and ``kept_text``
    (replacing columns of these names); every other column and every row stays.

    Null and empty texts are one empty line, kept as an empty text. Each row counts as a
    document; rows that repeat a ``doc_id`` are treated alike, rows whose ``doc_id`` is
    null count but are never the largest, unless all that hold the line are. If all lines go, the text is
    empty. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    entries = materialise(line_entries(docs, min_chars), "line-entries")
    incoming = materialise(
        entries.groupBy(_batch_of("doc_id", batches).alias("batch"), "line").agg(
            F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("last_doc")
        ),
        "line-batches",
    )
    runs = LineRuns(spark)
    for b in range(batches):
        runs.add(incoming.where(F.col("batch") == b).select(*_ENTRY))
    repeated = materialise(runs.repeated(min_docs), "line-repeated")

    doc, gone = free_names(docs, "line_doc", "line_gone")
    drops = materialise(
        entries.join(repeated, "line")
        .where(~F.col("doc_id").eqNullSafe(F.col("last_doc")))
        .groupBy(F.col("doc_id").alias(doc))
        .agg(F.collect_set("line").alias(gone)),
        "line-drops",
    )
    lines = lines_of(F.col("text"))
    kept = F.when(F.col(gone).isNull(), lines).otherwise(
        F.filter(lines, lambda l: ~F.coalesce(F.array_contains(F.col(gone), line_id(l, min_chars)), F.lit(False)))
    )
    # The same plan at every size: a shuffle of both sides by document.
    joined = docs.join(drops.hint("merge"), F.col("doc_id").cast("long").eqNullSafe(F.col(doc)), "left")
    results = {
        "n_lines": F.size(lines).cast("long"),
        "n_dropped": (F.size(lines) - F.size(kept)).cast("long"),
        "kept_text": F.array_join(kept, "\n"),
    }
    old = without(docs, list(results)).columns
    return joined.select(*[F.col(f"`{c}`") for c in old], *[v.alias(k) for k, v in results.items()])
