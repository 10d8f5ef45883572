"""The package's operators applied to whole tables, with the columns their contracts name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covaria.llm import (
    exact, language, licenses, lm, mixing, negatives, packing, paragraphs, quality, secrets, simhash, spelling, topk, vectors,
)
from covaria.llm.text import documents, id_remainder


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scanned(documents(spark, sf_dir))
    return found.select(
        "doc_id",
        secrets.counted(F.col("base"), "assign").alias("n_assign"),
        secrets.counted(F.col("base"), "access").alias("n_access"),
        secrets.counted(F.col("base"), "hex").alias("n_hex"),
        F.sha2(secrets.written(F.col("base")), 256).alias("base_sha256"),
        secrets.written(F.col("spans")).alias("spans"),
    )


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = simhash.grouped(documents(spark, sf_dir), words_each=3, max_bits=3)
    return marks.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    """Where an installed public tokenizer lies; it is installed at the same place everywhere."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Packing alone has its workers' memory to itself.
    return packing.packed(documents(spark, sf_dir), tokenizer_file(), most_tokens=4096, remembered=1_000_000)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = exact.grouped(documents(spark, sf_dir))
    return marks.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mixed(documents(spark, sf_dir), mixing.cycled(1, 2, 3), max_epochs=3)
    return mix.select("doc_id", "size", "source_size", "target", "taken")


def language_model(docs: DataFrame) -> language.Model | None:
    """Fitted on documents whose id falls into four of five classes; the fifth is held out."""
    return language.learned(docs, id_remainder(F.col("doc_id"), 5) != 0)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = language.predicted(docs, language_model(docs))
    return found.select(
        "doc_id",
        (id_remainder(F.col("doc_id"), 5) == 0).alias("held_out"),
        "lang_pred",
        "score",
        "rejected",
    )


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = paragraphs.repeated(documents(spark, sf_dir))
    return marks.select("doc_id", "start", "n_words", "class_id", "keep_id", "n_docs", "removed")


def op8_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scanned(documents(spark, sf_dir))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    trains = id_remainder(F.col("doc_id"), 5) != 1
    found = lm.scored(documents(spark, sf_dir), trains, tokenizer_file())
    return found.select(
        "doc_id", (~F.col("trained")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(documents(spark, sf_dir))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.grouped(documents(spark, sf_dir), shortest=5, least=3, ratio=2)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mined(vectors.embeddings(spark, sf_dir), every=100, shift_every=7, positives=5, negatives=10)


def op13_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.searched(vectors.embeddings(spark, sf_dir), every=50, k=5)


QUERIES = {f.__name__: f for f in (
    op1_secret_scans, op2_simhash_near_dedup, op3_best_fit_packing, op4_exact_dedup, op5_source_mixing, op6_language_id,
    op7_substring_dedup, op8_license_scans, op9_lm_scoring, op10_quality_rules, op11_spelling_variants,
    op12_hard_negatives, op13_exact_topk,
)}
