"""The news classifier (M2): a kernel SVM per symbol with calibrated
probabilities.

Examples (G4) become count vectors over the symbol's selected words (M14). The
dual solver of ``kernel_svm`` fits each symbol; the sigmoid is fitted by Newton
steps on margins of models that saw neither the example nor another one of the
same article date, whose words are the same. Daily news vectors (G5) are then
scored through the support-vector table.

Words sit at their rank within the symbol, so that a vector has ``k`` places
whatever the size of the vocabulary, and no position leaves the symbol's rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import r6
from ..session import written
from . import news as nw
from .kernel_svm import Config, fit_svm, optimality, score_svm
from .newton import calibrate, gradients, out_of_fold, probability
from .select import K_BEST, chi2_scores, select_k_best

TOLERANCE = 1e-5        # fixed value


def word_places(vocab: DataFrame) -> DataFrame:
    """``symbol, word, place`` from 0; a symbol's list holds at most ``k`` words."""
    w = Window.partitionBy("symbol").orderBy("word")
    return vocab.select("symbol", "word", (F.row_number().over(w) - 1).alias("place"))


def count_vectors(keys: DataFrame, counts: DataFrame, places: DataFrame, k: int) -> DataFrame:
    """Every row of ``keys`` (distinct, with ``symbol``) with columns ``w0`` to
    ``w<k-1>``: its counts, 0 for absent words."""
    on = [c for c in keys.columns if c in counts.columns]
    cells = counts.join(places, ["symbol", "word"]).groupBy(*on).agg(
        F.map_from_entries(F.collect_list(F.struct("place", "cnt"))).alias("_c"))
    got = keys.join(cells, on, "left")
    return got.select(*keys.columns, *[F.coalesce(F.col("_c")[i], F.lit(0)).cast("double").alias(f"w{i}") for i in range(k)])


def folds_of(examples: DataFrame, folds: int) -> DataFrame:
    """``symbol, pub_date, example_id`` with ``fold``: a symbol's article dates
    go round the folds, so that no fold holds all of them; with a single date
    its examples do."""
    w = Window.partitionBy("symbol").orderBy("pub_date")        # dates, bounded by the calendar
    dates = examples.select("symbol", "pub_date").distinct().withColumn("_no", F.row_number().over(w))
    n = dates.groupBy("symbol").agg(F.count("*").alias("_n"))
    e = examples.select("symbol", "pub_date", "example_id", "offset").join(dates, ["symbol", "pub_date"]).join(n, "symbol")
    own = F.array_position(F.array(*[F.lit(o) for o in nw.LABEL_OFFSETS]), F.col("offset"))
    return e.select("symbol", "pub_date", "example_id", F.pmod(F.when(F.col("_n") > 1, F.col("_no")).otherwise(own), F.lit(folds)).alias("fold"))


def fit_news(articles: DataFrame, bars: DataFrame, k: int = K_BEST, c: float = 1.0, folds: int = 5) -> dict[str, DataFrame]:
    """All tables of the fit: ``examples`` (vectors and labels), ``vectors``
    (support vectors), ``margins`` (out of fold), ``sigmoid_rows`` and
    ``sigmoid``, ``days`` (p_down, p_up of every day with news)."""
    dwc, bars = nw.news_inputs(articles, bars)
    ex = nw.label_examples(articles, bars).select(
        "symbol", "pub_date", "offset", "label", F.concat_ws("/", "pub_date", "offset").alias("example_id")).checkpoint()
    terms = ex.join(dwc, ["symbol", "pub_date"])
    vocab = select_k_best(chi2_scores(ex, terms), k).checkpoint()
    places, feats = word_places(vocab).checkpoint(), [f"w{i}" for i in range(k)]
    cfg = Config("news", "rbf", c, 1.0 / k)
    keys = ex.select("symbol", "pub_date", "example_id", "label", F.lit(True).alias("is_train")).join(
        folds_of(ex, folds), ["symbol", "pub_date", "example_id"])
    dates = ex.select("symbol", "pub_date").distinct()
    rows = count_vectors(dates, dwc, places, k).join(keys, ["symbol", "pub_date"])
    rows = written(rows, "news-examples")
    margins = written(out_of_fold(rows, feats, cfg, folds, "example_id", TOLERANCE, fold="fold")
                      .select("symbol", "example_id", "label", "score"), "news-margins")
    sigmoid_rows, sigmoid = calibrate(margins)
    vectors = written(fit_svm(rows, feats, (cfg,), "example_id", tol=TOLERANCE), "news-vectors")
    vec = nw.daily_news_vector(dwc, bars, vocab).checkpoint()
    days = count_vectors(vec.select("symbol", "bar_date").distinct(), vec, places, k)
    days = score_svm(days, vectors, feats, (cfg,)).where("score IS NOT NULL").select(
        "symbol", "bar_date", F.col("symbol").alias("key"), F.array("score").alias("x"))
    days = probability(days, sigmoid).select("symbol", "bar_date", (1 - F.col("p")).alias("p_down"), F.col("p").alias("p_up"))
    conditions = optimality(score_svm(rows, vectors, feats, (cfg,)), vectors, (cfg,), "example_id", tol=TOLERANCE)
    return {"bars": bars, "examples": rows, "vectors": vectors, "margins": margins, "sigmoid_rows": sigmoid_rows,
            "sigmoid": sigmoid, "days": written(days, "news-days"), "conditions": conditions}


def q_svm_news_proba(articles: DataFrame, bars: DataFrame) -> DataFrame:
    """M2 attached to the trading days."""
    fit = fit_news(articles, bars)
    out = nw.attach_news(fit["bars"], fit["days"], only_scored_symbols=True)
    return out.select("symbol", "bar_date", r6("p_down").alias("p_down"), r6("p_up").alias("p_up"))


def q_news_svm_fit(articles: DataFrame, bars: DataFrame) -> DataFrame:
    """Per symbol: the examples, the conditions that only the solution of the
    dual meets, one out-of-fold margin for every example, a sigmoid whose
    gradient vanishes, and day probabilities that sum to one."""
    fit = fit_news(articles, bars)
    held = fit["margins"].groupBy("symbol").agg(F.count_distinct("example_id").alias("n_margins"))
    newton = gradients(fit["sigmoid_rows"], fit["sigmoid"]).select(F.col("key").alias("symbol"), (F.col("gradient") < 1e-6).alias("sigmoid_solved"))
    days = fit["days"].groupBy("symbol").agg(F.min(F.abs(F.col("p_up") + F.col("p_down") - 1) < 1e-12).alias("sums_to_one"))
    return fit["conditions"].drop("config").withColumnRenamed("n_train", "n_examples").join(held, "symbol").join(newton, "symbol").join(days, "symbol")
