"""Keyword extraction by graph ranking (G2) and keyword counts.

Definition (fixed here; the study called an external library):

* tokens: lower-cased word tokens of the summary without stop words;
* graph: undirected, unweighted edges between adjacent kept tokens
  (co-occurrence window 2), no self loops; nodes are the distinct kept words;
* rank: ``STEPS`` damped steps from ``1/N``:
  ``r'(v) = 0.15/N + 0.85 * sum_{u ~ v} r(u) / deg(u)``;
* keywords: the top ``floor(0.2 * N)`` words per document by rank (rank
  compared at 1e-12, then word);
* phrases: maximal runs (two or more) of adjacent keywords in the full token
  sequence (stop words break a run), joined by a blank;
* counts: case-sensitive, non-overlapping substring counts in the summary.

Everything is keyed by ``doc_id``. Tokens come from Spark expressions; the
rank steps and the runs of a document are found where its row lies
(``word_rows``: Arrow batches, numpy), because one document's graph never meets
another's: a join-per-step formulation would sort the corpus-wide edge table
ten times. Keywords and summaries meet once per document, as an array beside
the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import r6
from ..functions.text import STOP_WORDS, word_tokens
from ..session import written
from .word_rows import count_in_rows, rank_tokens, runs_of_words

DAMPING = 0.85
TELEPORT = 0.15
STEPS = 10
RATIO = 0.2


def kept_tokens(summary_col: str = "summary"):
    return F.filter(word_tokens(summary_col), lambda x: ~x.isin(STOP_WORDS))


def rank_words(summ: DataFrame, key: str = "doc_id", steps: int = STEPS, ratio: float | None = None) -> DataFrame:
    """Rank every document's word graph: (doc_id, word, n_nodes, rank,
    kw_rank). ``kw_rank`` is the word's place in rank order (rank compared at
    1e-12, then word). With ``ratio`` only the words that
    :func:`top_keywords` keeps leave the task."""
    rows = summ.select(F.col(key).cast("long").alias("doc_id"), "summary")
    return rank_tokens(rows, "doc_id", kept_tokens(), steps, DAMPING, TELEPORT, ratio)


def top_keywords(ranks: DataFrame, ratio: float = RATIO) -> DataFrame:
    """Top ``floor(ratio * N)`` words of each document."""
    return ranks.filter(F.col("kw_rank") <= F.floor(F.col("n_nodes") * ratio))


def keyword_phrases(summ: DataFrame, keywords: DataFrame, key: str = "doc_id") -> DataFrame:
    """Runs of two or more adjacent keywords: (key, phrase, n_words), distinct."""
    per_doc = keywords.groupBy(key).agg(F.collect_list("word").alias("_kws"))
    return runs_of_words(summ.select(key, "summary").join(per_doc, key), key, word_tokens("summary"), "_kws")


def extract_keywords(summ: DataFrame, key: str = "doc_id", steps: int = STEPS) -> DataFrame:
    """Keywords with rank: (doc_id, word, n_nodes, rank, kw_rank)."""
    return top_keywords(rank_words(summ, key, steps, RATIO))


def keyword_counts(summ: DataFrame, keywords: DataFrame, phrases: DataFrame,
                   key: str = "doc_id", keep_empty_keyword: bool = False) -> DataFrame:
    """The article's keyword map as rows: (key, keyword, cnt), cnt = X8 count
    of the keyword (single word or phrase) in the summary. Keywords are
    gathered per document first (bounded by its vocabulary), so the summary
    text is joined once per document, not once per keyword. With
    ``keep_empty_keyword`` a document without keywords gets the key '' with
    ``length + 1``, as the study's library output did."""
    kws = keywords.select(key, F.col("word").alias("keyword")).unionByName(
        phrases.select(key, F.col("phrase").alias("keyword")))
    per_doc = kws.groupBy(key).agg(F.collect_list("keyword").alias("_kws"))
    j = summ.select(key, "summary").join(per_doc, key, "left" if keep_empty_keyword else "inner")
    if keep_empty_keyword:
        j = j.withColumn("_kws", F.coalesce(F.col("_kws"), F.array(F.lit(""))))
    return count_in_rows(j, key, "summary", "_kws")


# ---------------------------------------------------------------- query views
def q_textrank_keywords(summ: DataFrame) -> DataFrame:
    kw = extract_keywords(summ)
    return kw.select("doc_id", "word", r6("rank").alias("rank"), F.col("kw_rank").cast("long").alias("kw_rank"))


def q_keyword_phrases(summ: DataFrame) -> DataFrame:
    return keyword_phrases(summ, extract_keywords(summ))


def q_keyword_substring_count(summ: DataFrame) -> DataFrame:
    kw = written(extract_keywords(summ), "keywords")
    return keyword_counts(summ, kw, keyword_phrases(summ, kw))
