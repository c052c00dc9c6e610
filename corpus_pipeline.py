"""Training-corpus pipeline over ``documents``: quality rules, exact dedup,
near-duplicate removal, mixing to target weights, SentencePiece encoding.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, which is written as Parquet and read again as the next
stage's ``docs``. All but the last return the columns of ``documents``.

Rows that repeat another row entirely (same id, same text) leave with the
exact duplicates. Rows with a null id are documents like any other. Documents that the mix takes twice leave that stage twice.
"""

from __future__ import annotations

import os
import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import ticktale  # noqa: E402
from ticktale.llm import exact, minhash, mixing, quality, sentencepieces  # noqa: E402
from ticktale.llm.common import stored, text_of  # noqa: E402
from ticktale.llm.queries import tokenizer_path  # noqa: E402

cloudpickle.register_pickle_by_value(ticktale)

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
NEAR_PERCENT = 80           # op6_minhash alone has 85 in its contract


def _numbered(docs: DataFrame, label: str) -> DataFrame:
    """``docs`` written with a row key ``_row``: ids can be null or repeat, so
    decisions come back by row."""
    return stored(docs.select(*COLUMNS).withColumn("_row", F.monotonically_increasing_id()), label)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs.select(*COLUMNS))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each set of equal texts (null counts as empty), one with the largest id."""
    kept = (exact.exact_dedup(docs.select("doc_id", "text")).where("kept")
            .select(_text_id("doc_id"), F.col("text_sha256").alias("_digest")).distinct())
    rows = docs.select(*COLUMNS, _text_id("doc_id"), F.sha2(text_of("text").cast("binary"), 256).alias("_digest"))
    return rows.dropDuplicates(["_id", "_digest"]).join(kept, ["_id", "_digest"]).select(*COLUMNS)


def _text_id(column: str) -> Column:
    """The id as a string that is never null, so that a join can use plain equality."""
    return F.coalesce(F.col(column).cast("string"), F.lit("")).alias("_id")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest
    id (a null id is larger than any other). Links are similarities of
    ``NEAR_PERCENT`` or more; 30 bands of 5 miss one of exactly 0.80 with a
    probability of 7e-6."""
    rows = _numbered(docs, "near-rows")
    groups = minhash.near_dedup(rows.select("_row", "text"), id_col="_row", percent=NEAR_PERCENT)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "_digest", "_row")
    ids = rows.select("_row", "doc_id", F.xxhash64("text").alias("_digest"))
    kept = (ids.join(groups.select("_row", "component_id"), "_row").groupBy("component_id")
            .agg(F.min(order).alias("first")).select(F.col("first._row").alias("_row")))
    return rows.join(kept, "_row").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it (not at all, once or twice)."""
    rows = _numbered(docs, "mix-input")
    taken = mixing.mix(rows, carry=("_row",)).where("copies > 0").select("_row", "copies")
    return (rows.join(taken, "_row").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
            .select(*COLUMNS))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document, their number, and whether they decode to the text."""
    e = sentencepieces.encode(docs, tokenizer_path("piece_bpe_32k.model"), ("doc_id", "lang", "source"))
    return e.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_pieces"), "ids", "round_trip")


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_copies),
    ("near-duplicate removal", near_copies),
    ("mixing", mix_sources),
    ("sentencepiece", encode_pieces),
]

#: The near-duplicate and sampling stages use hashes and a tokenizer file that SQL lacks.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
