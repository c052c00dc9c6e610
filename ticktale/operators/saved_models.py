"""Fitted models as versioned coefficient tables.

A store holds rows ``symbol, term, value`` below ``version=<n>`` folders. Saving
a version again replaces that version only; loading takes the newest version of
each symbol, or of those up to a given one, so a retrained symbol moves on while
the others keep the model they have. A model scores any rows in long form
(``term, amount``) by a join, and the anti join names the symbols without one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import r6

COEFFICIENTS = "symbol string, term string, value double, version int"
INTERCEPT = ""          # the term of a model's constant


def save_coefficients(coefficients: DataFrame, path: str, version: int) -> None:
    """K8: one version of some symbols' models; a term occurs once a symbol."""
    (coefficients.select("symbol", "term", F.col("value").cast("double").alias("value"), F.lit(version).cast("int").alias("version"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("version").parquet(path))


def load_coefficients(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """``symbol, term, value, version``, the newest version of each symbol
    (not beyond ``version``)."""
    every = spark.read.schema(COEFFICIENTS).parquet(path)
    if version is not None:
        every = every.where(F.col("version") <= version)
    newest = every.groupBy("symbol").agg(F.max("version").alias("version"))
    return every.join(newest, ["symbol", "version"]).select("symbol", "term", "value", "version")


def without_model(wanted: DataFrame, coefficients: DataFrame) -> DataFrame:
    """The wanted symbols that no saved model covers."""
    return wanted.select("symbol").distinct().join(coefficients.select("symbol").distinct(), "symbol", "left_anti")


def terms_of(theta: DataFrame, feats: list[str]) -> DataFrame:
    """The rows of a logistic fit (``key, theta``, intercept first)."""
    names = F.array(*[F.lit(n) for n in (INTERCEPT, *feats)])
    return theta.select(F.col("key").alias("symbol"), F.explode(F.arrays_zip(names.alias("term"), F.col("theta").alias("value"))).alias("t")) \
                .select("symbol", "t.term", "t.value")


def long_features(rows: DataFrame, feats: list[str], keys: list[str]) -> DataFrame:
    """``keys, term, amount``: the features of a row and the constant."""
    pairs = [F.struct(F.lit(n).alias("term"), F.col(n).cast("double").alias("amount")) for n in feats]
    pairs.append(F.struct(F.lit(INTERCEPT).alias("term"), F.lit(1.0).alias("amount")))
    return rows.select(*keys, F.explode(F.array(*pairs)).alias("p")).select(*keys, "p.term", "p.amount")


def score(amounts: DataFrame, coefficients: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, version, p_up``: the logistic of ``sum(amount * value)`` over the
    terms that the symbol's model knows; ``keys`` include ``symbol``."""
    hits = amounts.join(coefficients, ["symbol", "term"])
    z = hits.groupBy(*keys, "version").agg(F.sum(F.col("amount") * F.col("value")).alias("z"))
    return z.select(*keys, "version", (1 / (1 + F.exp(-F.col("z")))).alias("p_up"))


# ---------------------------------------------------------------- jobs
RETRAIN_FROM = "2024-01-16"


def q_saved_news_models(articles: DataFrame, bars: DataFrame, other_bars: DataFrame, path: str) -> DataFrame:
    """News models of the first half of the month saved as version 1, those of
    symbols with half of their examples or more after it trained again as version 2; all
    bars scored by what the store holds. ``other_bars`` bring symbols without a
    model: one row each with ``has_model`` false."""
    from . import news as nw
    dwc, bars = nw.news_inputs(articles, bars)
    ex = nw.label_examples(articles, bars)
    late = F.col("pub_date") >= F.lit(RETRAIN_FROM).cast("date")
    weights = lambda e: nw.log_ratio_weights(nw.example_terms(e, dwc)).select("symbol", F.col("word").alias("term"), F.col("w").alias("value"))
    save_coefficients(weights(ex.where(~late)), path, 1)
    grown = ex.groupBy("symbol").agg(F.sum(F.when(late, 1).otherwise(-1)).alias("d")).where("d >= 0")
    save_coefficients(weights(ex.join(grown, "symbol", "left_semi")), path, 2)

    model = load_coefficients(articles.sparkSession, path)
    vec = nw.daily_news_vector(dwc, bars, nw.top_quarter_vocab(nw.symbol_word_totals(dwc)))
    amounts = vec.select("symbol", "bar_date", F.col("word").alias("term"), F.col("cnt").alias("amount"))
    scored = bars.select("symbol", "bar_date").join(score(amounts, model, ["symbol", "bar_date"]), ["symbol", "bar_date"], "left")
    covered = scored.join(model.select("symbol").distinct(), "symbol", "left_semi").select(
        "symbol", "bar_date", "version", r6("p_up").alias("p_up"), F.lit(True).alias("has_model"))
    wanted = bars.select("symbol").unionByName(other_bars.select("symbol"))
    missing = without_model(wanted, model).select("symbol", F.lit(None).cast("date").alias("bar_date"), F.lit(None).cast("int").alias("version"),
                                                  F.lit(None).cast("double").alias("p_up"), F.lit(False).alias("has_model"))
    return covered.unionByName(missing)
