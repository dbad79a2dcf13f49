"""From raw documents to piece ids, one stage after the other.

Each stage works on all that the one before kept: the classifier's rejects go, lines that many
documents share go, one document of each group of near-duplicates stays, benchmark
passages are cut out, and what is left is encoded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.llm import decontaminate, line_dedup, pieces, quality, simhash
from folioflow.llm.queries import PIECE_MODEL
from folioflow.scale import materialise, tune


def _with_text(docs: DataFrame, like: DataFrame, text: str) -> DataFrame:
    """Documents with a new text and its length, in the columns of ``like``."""
    new = {"text": F.col(text), "n_chars": F.char_length(text).cast("long")}
    return docs.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in like.columns])


def rate_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of the best grade is high enough."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    tune(spark)
    rated = quality.rate(docs, quality.train(docs, labels))
    return rated.where("keep").select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the long lines that many share; documents of nothing else go."""
    tune(spark)
    done = line_dedup.dedup_lines(docs).where("n_dropped = 0 OR trim(kept_text) <> ''")
    return _with_text(done, docs, "kept_text")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that fingerprints of three-word shingles with two differing bits or fewer connect."""
    tune(spark)
    return simhash.one_of_each(docs, simhash.exact_scheme(shingle=3, radius=2))


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less the passages of the benchmark; documents of nothing else go."""
    tune(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    done = decontaminate.decontaminate(docs, benchmark).where("NOT contaminated OR n_hit < n_words")
    return _with_text(done, docs, "clean_text")


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each document: doc_id, lang, source, ids, n_ids, round_trip."""
    tune(spark)
    return pieces.encode(docs, pieces.load_model(PIECE_MODEL), carry=["doc_id", "lang", "source"])


STAGES = [
    ("quality classifier", rate_quality),
    ("line dedup", drop_lines),
    ("simhash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", cut_benchmark),
    ("sentencepiece", encode_pieces),
]

#: A fitted classifier and majority fingerprints are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each one returns is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
