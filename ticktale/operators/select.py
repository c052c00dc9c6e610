"""Chi-square word scores and the five selection modes.

Input: labelled examples ``ex(key.., example_id, label)`` and their word
counts ``terms(key.., example_id, word, cnt)``, long format.

Statistic (the count-sum form used by the study's selector, not MLlib's
contingency test): per class c and word w, observed ``O = sum of counts``,
expected ``E = P(c) * T(w)`` with ``P(c)`` the class share over *examples*
and ``T(w)`` the word's total; ``chi2 = sum_c (O - E)^2 / E``. Since
``sum_c E = T`` this equals ``(1/T) * sum_c O^2 / P(c) - T``, where cells
with ``O = 0`` add nothing, so the word x class grid is never completed.

Selections follow the study's five modes: k best (200), top percentile (10,
ties at the threshold filled in word order), fpr / fdr (Benjamini-Hochberg)
/ fwe at 0.005. Two classes give one degree of freedom, so each p-value test
is a chi2 threshold from :mod:`ticktale.functions.stats`, computed per row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import r6
from ..functions.stats import chi2_critical_1df
from ..functions.text import is_stop, word_tokens
from ..session import written
from ..sources.fixtures import ARTICLE_SYMBOLS

# The study's selection parameters.
K_BEST = 200
PERCENTILE = 10
ALPHA = 0.005
WIDE_VOCAB = 700          # F20: symbols with more words go through selection


def label_counts(terms: DataFrame, keys=("symbol",)) -> DataFrame:
    """(keys.., word, label, o): the words' counts by class, from terms that
    carry the label of their example."""
    return terms.groupBy(*keys, "word", "label").agg(F.sum("cnt").alias("o"))


def scores_of_counts(ex: DataFrame, counts: DataFrame, keys=("symbol",)) -> DataFrame:
    """(keys.., word, total, chi2) from :func:`label_counts`. The class-share
    table has one row per (key, class); it is written, as its size is then
    known before the join."""
    keys = list(keys)
    n_c = ex.groupBy(*keys, "label").agg(F.count("*").alias("n_c"))
    n = ex.groupBy(*keys).agg(F.count("*").alias("n"))
    shares = written(n_c.join(n, keys).select(*keys, "label", (F.col("n_c") / F.col("n")).alias("share")), "shares")
    s = counts.join(shares, keys + ["label"]).groupBy(*keys, "word").agg(
        F.sum(F.col("o") * F.col("o") / F.col("share")).alias("_s"), F.sum("o").alias("total"))
    return s.select(*keys, "word", F.col("total").cast("long").alias("total"),
                    (F.col("_s") / F.col("total") - F.col("total")).alias("chi2"))


def chi2_scores(ex: DataFrame, terms: DataFrame, keys=("symbol",), example: str = "example_id") -> DataFrame:
    """(keys.., word, total, chi2) of the terms of labelled examples."""
    keys = list(keys)
    t = terms.select(*keys, example, "word", "cnt").join(ex.select(*keys, example, "label"), keys + [example])
    return scores_of_counts(ex, label_counts(t, keys), keys)


def _desc_rank(keys):
    return Window.partitionBy(*keys).orderBy(F.desc("chi2"), "word")


def select_k_best(scores: DataFrame, k: int = K_BEST, keys=("symbol",)) -> DataFrame:
    """O4."""
    return scores.withColumn("_r", F.row_number().over(_desc_rank(keys))).filter(F.col("_r") <= k).drop("_r")


def select_percentile(scores: DataFrame, pct: int = PERCENTILE, keys=("symbol",)) -> DataFrame:
    """Scores above the (100 - pct)th percentile (linear interpolation),
    plus ties at that value in word order up to ``floor(n * pct / 100)``.
    Ranks come from a distributed sort; the per-key values (threshold, count
    above it, first tie rank) are small aggregates joined back."""
    from .ranking import rank_within
    keys = list(keys)
    q = (100 - pct) / 100.0
    d = rank_within(scores, keys, ["chi2", "word"], rank="_rn", size="_n")
    h = (F.col("_n") - 1) * F.lit(q)
    lo = F.floor(h) + 1
    ends = d.filter((F.col("_rn") == lo) | (F.col("_rn") == F.least(lo + 1, F.col("_n")))).groupBy(*keys).agg(
        F.max(F.when(F.col("_rn") == F.floor((F.col("_n") - 1) * F.lit(q)) + 1, F.col("chi2"))).alias("_a"),
        F.max(F.when(F.col("_rn") == F.least(F.floor((F.col("_n") - 1) * F.lit(q)) + 2, F.col("_n")),
                     F.col("chi2"))).alias("_b"),
        F.first("_n").alias("_nn"))
    hh = (F.col("_nn") - 1) * F.lit(q)
    thr = written(ends.select(*keys, (F.col("_a") + (hh - F.floor(hh)) * (F.col("_b") - F.col("_a"))).alias("_thr")), "threshold")
    d = d.join(thr, keys)
    stats = written(d.groupBy(*keys).agg(F.count(F.when(F.col("chi2") > F.col("_thr"), 1)).alias("_above"),
                                         F.count(F.when(F.col("chi2") < F.col("_thr"), 1)).alias("_below")), "sides")
    d = d.join(stats, keys)
    tie = F.when(F.col("chi2") == F.col("_thr"), F.col("_rn") - F.col("_below"))   # ties are contiguous, by word
    max_feats = F.floor(F.col("_n") * pct / 100)
    keep = (F.col("chi2") > F.col("_thr")) | (tie <= max_feats - F.col("_above"))
    return d.filter(keep).select(*scores.columns)


def select_fpr(scores: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """P < alpha."""
    return scores.filter(F.col("chi2") > chi2_critical_1df(F.lit(alpha)))


def select_fwe(scores: DataFrame, alpha: float = ALPHA, keys=("symbol",)) -> DataFrame:
    """P < alpha / m, m = words of the key (an aggregate joined back)."""
    m = scores.groupBy(*keys).agg(F.count("*").alias("_m"))
    # as in fdr: c(alpha / m) >= c(alpha), so only a significant prefix meets m
    cand = scores.filter(F.col("chi2") >= chi2_critical_1df(F.lit(alpha)) * F.lit(1 - 1e-9))
    return (cand.join(m, list(keys))
                .filter(F.col("chi2") > chi2_critical_1df(F.lit(alpha) / F.col("_m"))).drop("_m"))


def select_fdr(scores: DataFrame, alpha: float = ALPHA, keys=("symbol",)) -> DataFrame:
    """Benjamini-Hochberg. With words ranked i = 1.. by chi2 descending,
    i* = max{i : chi2_(i) >= c(alpha * i / m)}; keep chi2 >= chi2_(i*).
    Since c(alpha * i / m) >= c(alpha), only words with chi2 >= c(alpha) can
    pass, and they are exactly the top of the ranking: ranks are computed on
    that significant prefix only, never over the whole vocabulary."""
    keys = list(keys)
    m = scores.groupBy(*keys).agg(F.count("*").alias("_m"))
    # relaxed by 1e-9 so rounding in alpha * i / m cannot drop a passing word;
    # the candidates stay a top prefix of the ranking either way
    from .ranking import rank_within
    cand = scores.filter(F.col("chi2") >= chi2_critical_1df(F.lit(alpha)) * F.lit(1 - 1e-9)).join(m, keys)
    d = rank_within(cand, keys, [F.desc("chi2"), "word"], rank="_i", size="_nc")
    ok = F.col("chi2") >= chi2_critical_1df(F.lit(alpha) * F.col("_i") / F.col("_m"))
    istar = d.filter(ok).groupBy(*keys).agg(F.max("_i").alias("_istar"))
    cut = d.join(istar, keys).filter(F.col("_i") == F.col("_istar")).select(*keys, F.col("chi2").alias("_cut"))
    return d.join(cut, keys).filter(F.col("chi2") >= F.col("_cut")).select(*scores.columns)


SELECTORS = {"k_best": select_k_best, "fpr": select_fpr, "fdr": select_fdr,
             "fwe": select_fwe, "percentile": select_percentile}


# ---------------------------------------------------------------- test inputs
def labelled_docs(docs: DataFrame, labels: DataFrame, label: str = "quality") -> tuple[DataFrame, DataFrame]:
    """documents x labels as examples (symbol by doc_id % 5) and word terms."""
    sym = F.element_at(F.array(*[F.lit(s) for s in ARTICLE_SYMBOLS]), (F.col("doc_id") % 5 + 1).cast("int"))
    ex = labels.select(sym.alias("symbol"), F.col("doc_id").alias("example_id"), F.col(label).alias("label"))
    toks = (docs.join(labels.select("doc_id"), "doc_id", "left_semi")
                .select(sym.alias("symbol"), F.col("doc_id").alias("example_id"),
                        F.explode(word_tokens("text")).alias("word"))
                .filter(~is_stop("word")))
    terms = toks.groupBy("symbol", "example_id", "word").agg(F.count("*").alias("cnt"))
    return ex, terms


def _out(df: DataFrame) -> DataFrame:
    return df.select("symbol", "word", "total", r6("chi2").alias("chi2"))


def q_chi2_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return _out(chi2_scores(*labelled_docs(docs, labels)))


def q_select(mode: str):
    def run(docs: DataFrame, labels: DataFrame) -> DataFrame:
        return _out(SELECTORS[mode](chi2_scores(*labelled_docs(docs, labels))))
    return run
