"""The registered queries: each operator with production parameters over its
whole table, reduced to the columns of its contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticktale.llm import (decontaminate, exact, language, minhash, mixing, quality, secrets, sentencepieces, spelling, sql,
                          substrings, suffixes, tokens, whitening)
from ticktale.llm.common import documents
from ticktale.sources.tables import table


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file (an installed package)."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffixes.dedup_bytes(documents(spark, sf_dir, "doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    carry = [F.col("doc_id"), F.coalesce(fold == 2, F.lit(False)).alias("held_out")]
    return language.language_id(docs, fold != 2, carry)


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    return sentencepieces.digest(sentencepieces.encode(docs, tokenizer_path("piece_bpe_32k.model")))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(documents(spark, sf_dir, "doc_id", "text"))

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(secrets.spans_text(F.col("base")), 256).alias("base_sha256"),
                        secrets.spans_text(F.sort_array(F.concat("base", "added"))).alias("spans"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = quality.quality(documents(spark, sf_dir, "doc_id", "text"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return q.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    failed.alias("base_failed"), (F.col("kept") & ~failed).alias("kept"))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_dedup(documents(spark, sf_dir, "doc_id", "text"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = mixing.mix(documents(spark, sf_dir, "doc_id", "text", "source"))
    return m.select("doc_id", "size", "source_size", "target", "taken")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_dedup(documents(spark, sf_dir, "doc_id", "text"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substrings.dedup_windows(documents(spark, sf_dir, "doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(documents(spark, sf_dir, "doc_id", "text"), tokenizer_path("byte_bpe_50k.json"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(documents(spark, sf_dir, "doc_id", "text"))


def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find(documents(spark, sf_dir, "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                        (hit > 0).alias("contaminated"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_language": op2_language,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_secrets": op4_secrets,
    "op5_quality": op5_quality,
    "op6_minhash": op6_minhash,
    "op7_mixing": op7_mixing,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_token_counts": op10_token_counts,
    "op11_spelling": op11_spelling,
    "op12_decontaminate": op12_decontaminate,
    "op13_whitening": op13_whitening,
}

ORACLES = sql.ORACLES
