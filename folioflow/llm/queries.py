"""One query per operator over its whole table, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.llm import (
    chat,
    collocations,
    decontaminate,
    filter_audit,
    html_text,
    line_dedup,
    ngram_join,
    pieces,
    quality,
    secret_scan,
    simhash,
    surrogates,
    topk,
)
from folioflow.llm.common import sha256_hex

#: Vocabulary of the piece encoder.
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Key of the surrogates; a deployment passes its own.
SURROGATE_KEY = "folioflow example key"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.decontaminate(docs, _table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"
    )


def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract_text(pages).select("page_id", "url", F.col("main_text").alias("text"), "n_chars")


def sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.encode(docs, pieces.load_model(PIECE_MODEL))


def chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text"
    )
    probe = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-1, 0, "user", probe), (-1, 1, "assistant", probe)], "conv_id bigint, turn bigint, role string, text string"
    )
    parts = turns.unionByName(extra).select("conv_id", "turn", "role", chat.text_parts(F.col("text")).alias("parts"))
    chats = chat.format_chats(parts)
    read = F.transform(chat.read_turns(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join(chat.read_loss(F.col("formatted"), F.col("loss_spans")), "")
    return chats.select("conv_id", read.alias("read"), loss.alias("loss"), F.char_length("formatted").cast("long").alias("formatted_chars")).select(
        "conv_id",
        F.size("read").cast("long").alias("n_turns"),
        sha256_hex(F.array_join("read", "")).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        sha256_hex(F.col("loss")).alias("loss_sha256"),
        "formatted_chars",
    )


def exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", topk.integer_vectors(F.col("embedding")).alias("weights"))
    return topk.top_inner_products(vectors, vectors.where("vec_id % 50 = 0"), 5)


def pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = surrogates.replace_entities(docs, SURROGATE_KEY)
    return found.select(
        "doc_id",
        F.size("entities").cast("long").alias("n_entities"),
        F.transform("entities", lambda e: F.concat_ws(":", e["kind"], e["start"], e["end"])).alias("spans"),
        F.col("surrogate_text").alias("text"),
    )


def secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    base = [r.kind for r in secret_scan.BASE]

    def listed(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
        )

    def of(kind):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")

    return secret_scan.scan_secrets(docs).select(
        "doc_id",
        *[of(k).alias(f"n_{k}") for k in base],
        sha256_hex(listed(F.filter("secrets", lambda s: s["kind"].isin(*base)))).alias("base_sha256"),
        listed(F.col("secrets")).alias("spans"),
    )


def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, _table(spark, sf_dir, "labels"))
    return quality.rate(docs, model).select("doc_id", "expected_grade", "p_fair", "p_good", "keep")


def line_deduplication(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", sha256_hex(F.col("kept_text")).alias("kept_sha256")
    )


def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs, simhash.exact_scheme(), carry=["doc_id"])


def filter_interaction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return filter_audit.audit(docs, _table(spark, sf_dir, "labels"))


def phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents").select("lang", "text"))


def ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return ngram_join.similar_documents(docs, carry=["doc_id"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_benchmark_decontamination": benchmark_decontamination,
    "op2_html_extraction": html_extraction,
    "op3_sentencepiece": sentencepiece,
    "op4_chat_formatting": chat_formatting,
    "op5_exact_topk": exact_topk,
    "op6_pii_surrogates": pii_surrogates,
    "op7_secret_scans": secret_scans,
    "op8_quality_classifier": quality_classifier,
    "op9_line_dedup": line_deduplication,
    "op10_simhash_near_dedup": simhash_near_dedup,
    "op11_filter_audit": filter_interaction_audit,
    "op12_phrase_collocations": phrase_collocations,
    "op13_ngram_jaccard_join": ngram_jaccard_join,
}
