"""Extractive summary (G1) and its parts: X3-X9, U4, A14, A15, O9.

Two forms of each step. The row form (``local_*``) keeps a document's
sentences and tokens in arrays of its row and counts where the row lies
(``word_rows``): no token is exchanged or sorted. The table form has sentence and token
rows and brings the rows of a key together; documents that share a key with
others take it, so both give the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import is_stop, sanitize, split_sentences, word_tokens
from .word_rows import count_words, once_per_key, score_sentences


def by_doc(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    return docs.repartition(key)


def sentences(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, sent_no, sentence) from sanitised text; sent_no from 0."""
    return docs.select(key, F.posexplode(split_sentences(sanitize(text))).alias("sent_no", "sentence"))


def sentence_tokens(sents: DataFrame, key: str = "doc_id", keep_markers: bool = False) -> DataFrame:
    """Kept (non-stop) word tokens per sentence: (key, sent_no, word).

    With ``keep_markers`` every sentence also keeps its first token row (or
    one empty row when it has no token), carrying the sentence text in
    ``sentence`` (NULL on all other rows) and ``kept`` telling real tokens
    from markers. This lets the summary be built without joining the token
    rows back to the sentences: the text travels once per sentence."""
    if not keep_markers:
        t = sents.select(key, "sent_no", F.explode(word_tokens("sentence")).alias("word"))
        return t.filter(~is_stop("word"))
    t = sents.select(key, "sent_no", "sentence",
                     F.posexplode_outer(word_tokens("sentence")).alias("_pos", "word"))
    kept = F.col("word").isNotNull() & ~is_stop("word")
    first = F.coalesce(F.col("_pos"), F.lit(0)) == 0
    return (t.filter(kept | first)
             .select(key, "sent_no", "word", kept.alias("kept"),
                     F.when(first, F.col("sentence")).alias("sentence")))


def word_freq(tokens: DataFrame, key: str = "doc_id") -> DataFrame:
    """Frequency of each kept word in its document."""
    return tokens.groupBy(key, "word").agg(F.count("*").alias("freq"))


def sentence_scores(tokens: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per sentence, the sum over its kept tokens of the token's
    document frequency (one add per occurrence). The frequency is a window
    count over (doc, word), so no join back is needed. Accepts the marker
    form of :func:`sentence_tokens` and then also returns the sentence text
    (score 0 for sentences without a kept word)."""
    w = Window.partitionBy(key, "word")
    if "kept" not in tokens.columns:
        f = tokens.withColumn("freq", F.count("*").over(w))
        return f.groupBy(key, "sent_no").agg(F.sum("freq").alias("score"))
    f = tokens.withColumn("freq", F.count(F.when(F.col("kept"), 1)).over(w))
    return f.groupBy(key, "sent_no").agg(
        F.coalesce(F.sum(F.when(F.col("kept"), F.col("freq"))), F.lit(0)).alias("score"),
        # one non-null text per sentence; collect_list keeps this a hash
        # aggregate (a string 'first' would force a sort-based aggregate)
        F.element_at(F.collect_list("sentence"), 1).alias("sentence"))


def summarize(scored: DataFrame, key: str = "doc_id", n: int | None = None) -> DataFrame:
    """Keep the ``n`` best-scored sentences (all scored ones when
    ``n`` is None, as in the study), put them back in text order and join
    them with a blank. Input: one row per sentence with score and text.
    Documents without a scored sentence get ''."""
    keep = F.col("score") > 0
    s = scored
    if n is not None:
        rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("score"), "sent_no"))
        s = s.withColumn("_rank", rank)
        keep = keep & (F.col("_rank") <= n)
    agg = s.groupBy(key).agg(
        F.sort_array(F.collect_list(F.when(keep, F.struct("sent_no", "sentence")))).alias("_kept"))
    return agg.select(key, F.array_join(F.transform("_kept", lambda x: x["sentence"]), " ").alias("summary"),
                      F.size("_kept").cast("long").alias("n_sentences"))


def kept_words(text):
    """X4, X6, X7 as one array: the word tokens that are no stop words."""
    return F.filter(word_tokens(text), lambda w: ~is_stop(w))


def local_sentences(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, sents, toks): the sentences and, for each, its kept tokens."""
    s = docs.filter(F.col(text).isNotNull()).select(key, split_sentences(sanitize(text)).alias("sents"))
    return s.select(key, "sents", F.transform("sents", kept_words).alias("toks"))


def local_summary(scored: DataFrame, key: str = "doc_id", n: int | None = None) -> DataFrame:
    """:func:`summarize` on (key, sents, scores)."""
    s = scored.select(key, F.filter(F.transform(F.arrays_zip("sents", "scores"), lambda x, i: F.struct(
        (-x["scores"]).alias("neg"), i.alias("sent_no"), x["sents"].alias("sentence"))), lambda x: x["neg"] < 0).alias("_kept"))
    if n is not None:
        s = s.withColumn("_kept", F.array_sort(F.transform(F.slice(F.array_sort("_kept"), 1, n), lambda x: F.struct(
            x["sent_no"].alias("sent_no"), x["sentence"].alias("sentence")))))
    return s.select(key, F.array_join(F.transform("_kept", lambda x: x["sentence"]), " ").alias("summary"),
                    F.size("_kept").cast("long").alias("n_sentences"))


def _grouped_summaries(docs: DataFrame, key: str, text: str, n: int | None) -> DataFrame:
    sents = sentences(by_doc(docs, key), key, text)
    return summarize(sentence_scores(sentence_tokens(sents, key, keep_markers=True), key), key, n)


def summaries(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int | None = None) -> DataFrame:
    """G1 end to end: (key, summary, n_sentences) for every document."""
    return once_per_key(docs.select(key, text), key,
                        lambda d: local_summary(score_sentences(local_sentences(d, key, text), key), key, n),
                        lambda d: _grouped_summaries(d, key, text, n))


# ---------------------------------------------------------------- query views
def q_sanitized_text(docs: DataFrame) -> DataFrame:
    c = sanitize("text")
    return docs.select("doc_id", c.alias("clean"), F.length(c).cast("long").alias("n_clean"))


def q_word_freq(docs: DataFrame) -> DataFrame:
    return once_per_key(docs, "doc_id",
                        lambda d: count_words(local_sentences(d), ["doc_id"], F.flatten("toks"), "freq"),
                        lambda d: word_freq(sentence_tokens(sentences(by_doc(d)))))


def q_sentence_scores(docs: DataFrame) -> DataFrame:
    def local(d):
        s = score_sentences(local_sentences(d), "doc_id")
        return s.select("doc_id", F.posexplode("scores").alias("sent_no", "score")).filter("score > 0")
    s = once_per_key(docs, "doc_id", local, lambda d: sentence_scores(sentence_tokens(sentences(by_doc(d)))))
    return s.select("doc_id", F.col("sent_no").cast("long").alias("sent_no"), "score")


def q_extractive_summary(docs: DataFrame) -> DataFrame:
    return summaries(docs)
