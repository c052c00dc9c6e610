"""News features for daily bars.

Tables: ``article_words(symbol, pub_date, article_no, word, cnt)`` (keyword
counts per article), ``bars(symbol, bar_date, open, close, ...)`` (a trading
calendar with gaps). Word data stay long; nothing is widened into a
document-term matrix. Per-symbol facts (first article date, label variety)
are small aggregates joined back, so a symbol with a third of all articles
does not land in one window task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import r6
from ..functions.text import is_stop, word_tokens
from .text import kept_words
from .word_rows import count_words, once_per_key

# Look-ahead offsets in days for labelling and for scoring,
# and the minimum number of present trading days (Q3, Q4).
LABEL_OFFSETS = (0, 1, 3, 5)
SCORE_OFFSETS = (0, 3, 5)
MIN_PRESENT = 3


def article_words(articles: DataFrame) -> DataFrame:
    """Keyword counts per article (stand-in: kept word tokens of the text),
    counted in the article's row; articles that share a number are added up."""
    def local(a):
        return count_words(a.filter(F.col("text").isNotNull()), ["symbol", "pub_date", "article_no"], kept_words("text"))

    def grouped(a):
        return local(a).groupBy("symbol", "pub_date", "article_no", "word").agg(F.sum("cnt").alias("cnt"))
    return once_per_key(articles.select("symbol", "pub_date", "article_no", "text"), "article_no", local, grouped)


def day_words(articles: DataFrame) -> DataFrame:
    """A3 straight from the texts: (symbol, pub_date, word, cnt) in one
    aggregate (partial before the shuffle), without the per-article level."""
    t = articles.select("symbol", "pub_date", F.explode(word_tokens("text")).alias("word")).filter(~is_stop("word"))
    return t.groupBy("symbol", "pub_date", "word").agg(F.count("*").alias("cnt"))


def symbol_word_totals(aw: DataFrame, overall: bool = False) -> DataFrame:
    """A1 per symbol, or A2 over all symbols (``overall``)."""
    keys = ["word"] if overall else ["symbol", "word"]
    return aw.groupBy(*keys).agg(F.sum("cnt").alias("total"))


def day_word_counts(aw: DataFrame) -> DataFrame:
    """A3: all articles of a (symbol, date) merged into one count map."""
    return aw.groupBy("symbol", "pub_date", "word").agg(F.sum("cnt").alias("cnt"))


def _spread(days: DataFrame, offsets) -> DataFrame:
    return days.select("*", F.explode(F.array(*[F.lit(o) for o in offsets])).alias("offset")) \
               .withColumn("bar_date", F.date_add("pub_date", F.col("offset")))


def label_examples(articles: DataFrame, bars: DataFrame, offsets=LABEL_OFFSETS,
                   min_present: int = MIN_PRESENT) -> DataFrame:
    """J2 then F13; label +1 when a later present day's close >= the open
    of the first present day (Q2), one example per later present day (Q4);
    F18 drops symbols whose labels are all equal. ``articles`` needs only
    (symbol, pub_date): the dates that have articles."""
    days = articles.select("symbol", "pub_date").distinct()
    present = _spread(days, offsets).join(bars.select("symbol", "bar_date", "open", "close"),
                                          ["symbol", "bar_date"])
    w = Window.partitionBy("symbol", "pub_date")  # at most len(offsets) rows each
    p = (present.withColumn("n_present", F.count("*").over(w))
                .withColumn("first_offset", F.min("offset").over(w))
                .withColumn("open0", F.min_by("open", "offset").over(w)))
    ex = (p.filter((F.col("n_present") >= min_present) & (F.col("offset") > F.col("first_offset")))
           .withColumn("label", F.when(F.col("close") - F.col("open0") >= 0, 1).otherwise(-1)))
    varied = ex.groupBy("symbol").agg(F.min("label").alias("lo"), F.max("label").alias("hi")) \
               .filter(F.col("lo") != F.col("hi")).select("symbol")
    return ex.join(varied, "symbol", "left_semi")


def example_terms(examples: DataFrame, dwc: DataFrame) -> DataFrame:
    """A4: each example carries its date's merged word counts."""
    return examples.select("symbol", "pub_date", "offset", "label").join(dwc, ["symbol", "pub_date"])


def top_quarter_vocab(totals: DataFrame, keys=("symbol",)) -> DataFrame:
    """O3: the most frequent quarter (n // 4) of each vocabulary, ties by
    word. Ranks come from a distributed sort (a pooled vocabulary can be too
    large for one window task)."""
    from .ranking import rank_within
    r = rank_within(totals, list(keys), [F.desc("total"), "word"], rank="pos", size="n")
    return r.filter(F.col("pos") <= F.floor(F.col("n") / 4)).drop("n")


def daily_news_vector(dwc: DataFrame, bars: DataFrame, vocab: DataFrame, offsets=SCORE_OFFSETS) -> DataFrame:
    """J3 spreads each date's counts to days 0, +3, +5 that are trading
    days, J8 sums per (day, word), F14 keeps vocabulary words, F15 drops
    zero cells. The vocabulary filter comes before the copies, and the dates
    are mapped to trading days on the table of distinct dates."""
    words = dwc.join(vocab.select("symbol", "word"), ["symbol", "word"], "left_semi")
    days = dwc.select("symbol", "pub_date").distinct()
    days = _spread(days, offsets).join(bars.select("symbol", "bar_date"), ["symbol", "bar_date"], "left_semi")
    hits = words.join(days.select("symbol", "pub_date", "bar_date"), ["symbol", "pub_date"])
    v = hits.groupBy("symbol", "bar_date", "word").agg(F.sum("cnt").alias("cnt"))
    return v.select("symbol", "word", "bar_date", "cnt").filter(F.col("cnt") != 0)


def log_ratio_weights(terms: DataFrame) -> DataFrame:
    """A simple deterministic news model (stand-in for the SVM probability):
    w = ln((up + 1) / (down + 1)) from the labelled example terms."""
    return terms.groupBy("symbol", "word").agg(
        F.sum(F.when(F.col("label") == 1, F.col("cnt")).otherwise(0)).alias("up"),
        F.sum(F.when(F.col("label") == -1, F.col("cnt")).otherwise(0)).alias("down"),
    ).withColumn("w", F.ln((F.col("up") + 1.0) / (F.col("down") + 1.0)))


def news_scores(vec: DataFrame, weights: DataFrame) -> DataFrame:
    """Per (symbol, day): p_up = sigmoid(sum cnt * w), p_down = 1 - p_up."""
    z = vec.join(weights.select("symbol", "word", "w"), ["symbol", "word"]).groupBy("symbol", "bar_date").agg(
        F.sum(F.col("cnt") * F.col("w")).alias("z"))
    p_up = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("z")))
    return z.select("symbol", "bar_date", (F.lit(1.0) - p_up).alias("p_down"), p_up.alias("p_up"))


def attach_news(bars: DataFrame, scores: DataFrame, only_scored_symbols: bool = False) -> DataFrame:
    """Left join; days without news get 0, 0 (Q18). With
    ``only_scored_symbols`` the series are first restricted to symbols that
    have news scores at all (J6, semi join)."""
    if only_scored_symbols:
        bars = bars.join(scores.select("symbol").distinct(), "symbol", "left_semi")
    return bars.join(scores, ["symbol", "bar_date"], "left").fillna(0.0, ["p_down", "p_up"])


def cut_at_first_article(bars: DataFrame, aw: DataFrame) -> DataFrame:
    """Drop bars before a symbol's first article date, only when
    that date is itself a trading day; otherwise keep the series whole."""
    first = aw.groupBy("symbol").agg(F.min("pub_date").alias("first_date"))
    tradable = first.join(bars.select("symbol", F.col("bar_date").alias("first_date")),
                          ["symbol", "first_date"], "left_semi")
    b = bars.join(tradable, "symbol", "left")
    return b.filter(F.col("first_date").isNull() | (F.col("bar_date") >= F.col("first_date"))).drop("first_date")


# ---------------------------------------------------------------- query views
def news_inputs(articles: DataFrame, bars: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The stored tables every news step reads: day word counts (A3, the
    study's article keyword store folded by date) and the trading bars, each
    materialised once (reliable checkpoint) so that the documents are
    tokenised and the events aggregated once per job, not once per branch."""
    return day_words(articles).checkpoint(), bars.checkpoint()


def q_news_label_examples(articles: DataFrame, bars: DataFrame) -> DataFrame:
    ex = label_examples(articles, bars)
    return ex.select("symbol", "pub_date", "offset", "bar_date", "label",
                     r6("open0").alias("open0"), r6("close").alias("close"))


def q_day_word_counts(articles: DataFrame) -> DataFrame:
    return day_word_counts(article_words(articles))


def q_daily_news_vector(articles: DataFrame, bars: DataFrame) -> DataFrame:
    dwc, bars = news_inputs(articles, bars)
    vocab = top_quarter_vocab(symbol_word_totals(dwc))
    return daily_news_vector(dwc, bars, vocab)


def bars_with_news(articles: DataFrame, bars: DataFrame) -> DataFrame:
    """The bars with the day's news probabilities ``p_down`` and ``p_up``."""
    dwc, bars = news_inputs(articles, bars)
    terms = example_terms(label_examples(articles, bars), dwc)
    vec = daily_news_vector(dwc, bars, top_quarter_vocab(symbol_word_totals(dwc)))
    return attach_news(bars, news_scores(vec, log_ratio_weights(terms)))


def rounded_news(articles: DataFrame, bars: DataFrame) -> DataFrame:
    """The same with probabilities rounded, as fitted models and exports use them."""
    b = bars_with_news(articles, bars)
    return b.withColumns({c: r6(c) for c in ("p_down", "p_up")}).checkpoint()


def q_attach_news_scores(articles: DataFrame, bars: DataFrame) -> DataFrame:
    return bars_with_news(articles, bars).select("symbol", "bar_date", r6("close").alias("close"), r6("p_down").alias("p_down"),
                      r6("p_up").alias("p_up"))


def q_cut_at_first_article(articles: DataFrame, bars: DataFrame) -> DataFrame:
    c = cut_at_first_article(bars, articles.select("symbol", "pub_date"))
    return c.select("symbol", "bar_date", r6("open").alias("open"), r6("close").alias("close"))


def q_top_quarter_vocab(articles: DataFrame) -> DataFrame:
    v = top_quarter_vocab(symbol_word_totals(day_word_counts(article_words(articles))))
    return v.select("symbol", "word", "total", F.col("pos").cast("long").alias("pos"))
