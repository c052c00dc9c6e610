"""File sources and sinks of the study's stores.

Layouts
-------
* article store (K5/S4): the study kept one JSON document per company,
  ``[ {date: [ {keyword: count}, ...]}, [seen urls] ]``. Writing that means
  funnelling a company's whole history through one row, so the writer emits
  JSON lines, one per article with its keyword map and its place in the date,
  under ``company=`` directories; the reader accepts that, lines with all maps
  of a date and the legacy per-company documents (``legacy=True``).
* links (K6/S5) and model vocabularies (K7/S6): ``{key: [value, ...]}``;
  written as JSON lines ``{key, pos, value}``, legacy documents readable.
* feature matrices (K2-K4/S8): headerless CSV of 7 or 9 numbers, ``%f``.
* models (K8/S7): MLlib persistence per model + a manifest of the symbols
  each covers; loading reports symbols without a model (anti join).
* result lines (K10): CSV.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import written

# ---------------------------------------------------------------- article store
ARTICLE_LINE_SCHEMA = "date string, start bigint, articles array<map<string,bigint>>"
LEGACY_STORE = "map<string,array<map<string,bigint>>>"


def article_store_lines(aw: DataFrame) -> DataFrame:
    """(company, date, start, articles): a line holds one article's
    keyword map and the article's place among those of its date, so that no row
    grows with a date's articles. Places come from a range-partitioned sort."""
    from ..operators.ranking import rank_within
    per_article = written(aw.groupBy("symbol", "pub_date", "article_no").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("word", "cnt")))).alias("kw")), "article-maps")
    keys = ["symbol", "pub_date"]
    place = rank_within(per_article.select(*keys, "article_no"), keys, ["article_no"], rank="pos")
    return per_article.join(place, [*keys, "article_no"]).select(
        F.col("symbol").alias("company"), F.date_format("pub_date", "yyyy-MM-dd").alias("date"),
        (F.col("pos") - 1).cast("long").alias("start"), F.array("kw").alias("articles"))


def write_article_store(lines: DataFrame, path: str, mode: str = "overwrite") -> None:
    lines.write.mode(mode).partitionBy("company").json(path)


def read_article_store(spark: SparkSession, path: str, legacy: bool = False) -> DataFrame:
    """(company, pub_date, article_pos, word, cnt) from either layout.
    Legacy: one file per company, the company taken from the file name."""
    if legacy:
        t = spark.read.text(path, wholetext=True).withColumn("_f", F.input_file_name())
        m = t.select(F.regexp_extract("_f", r"([^/]+)\.json$", 1).alias("company"),
                     F.from_json(F.get_json_object("value", "$[0]"), LEGACY_STORE).alias("m"))
        d = m.select("company", F.explode("m").alias("date", "articles"))
    else:
        d = spark.read.schema(ARTICLE_LINE_SCHEMA).json(path)
        d = d.withColumn("company", F.regexp_extract(F.input_file_name(), r"company=([^/]+)/", 1))
    start = F.coalesce("start", F.lit(0)) if "start" in d.columns else F.lit(0)      # a line with all of a date has none
    a = d.select("company", F.to_date("date").alias("pub_date"), start.alias("_start"),
                 F.posexplode("articles").alias("article_pos", "kw"))
    return a.select("company", "pub_date", (F.col("_start") + F.col("article_pos")).cast("long").alias("article_pos"),
                    F.explode("kw").alias("word", "cnt"))


def read_seen_links(spark: SparkSession, path: str) -> DataFrame:
    """S4 (second half of the legacy document): (company, url)."""
    t = spark.read.text(path, wholetext=True).withColumn("_f", F.input_file_name())
    return t.select(F.regexp_extract("_f", r"([^/]+)\.json$", 1).alias("company"),
                    F.explode(F.from_json(F.get_json_object("value", "$[1]"), "array<string>")).alias("url"))


# ---------------------------------------------------------------- links and vocabularies
def keyed_lists(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """K6/K7 content: rows {key, pos, value}, pos from ``order``. Positions come
    from a range-partitioned sort, so a key may hold any share of the rows."""
    from ..operators.ranking import rank_within
    rows = df.select(F.col(key).alias("key"), F.col(order).alias("_order"), F.col(value).alias("value"))
    return rank_within(rows, ["key"], ["_order", "value"], rank="pos").select("key", F.col("pos").cast("long").alias("pos"), "value")


def write_keyed_lists(lists: DataFrame, path: str) -> None:
    """K6: JSON lines."""
    lists.write.mode("overwrite").json(path)


def read_keyed_lists(spark: SparkSession, path: str, legacy: bool = False) -> DataFrame:
    """(key, pos, value) from JSON lines or a legacy {key: [values]}."""
    if not legacy:
        return spark.read.schema("key string, pos long, value string").json(path)
    t = spark.read.text(path)          # one single-line JSON document per line
    m = t.select(F.explode(F.from_json("value", "map<string,array<string>>")).alias("key", "vals"))
    return m.select("key", F.posexplode("vals").alias("pos", "value")).withColumn(
        "pos", (F.col("pos") + 1).cast("long"))


def legacy_documents(lists: DataFrame) -> DataFrame:
    """X19/K7 legacy layout: one {key: [values in pos order]} document per
    key (the study wrote all keys into one file)."""
    g = lists.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("pos", "value"))).alias("_v"))
    vals = F.transform("_v", lambda x: x["value"])
    return g.select(F.to_json(F.map_from_arrays(F.array(F.col("key")), F.array(vals))).alias("value"))


# ---------------------------------------------------------------- feature matrices
def _f6(c: Column) -> Column:
    """%f of the value rounded half-up at 6 decimals (tie-free digits)."""
    return F.format_string("%.6f", F.floor(c * F.lit(1e6) + F.lit(0.5)) / F.lit(1e6))


def feature_lines(bars: DataFrame, label_coding: str = "pm", with_news: bool = False,
                  keep: list[str] | None = None) -> DataFrame:
    """K2/K3/K4: 'close,open,high,low,open-close,high-low,y[,p_down,p_up]' per
    bar; y coded 1/2 ('class', intraday export) or -1/+1 ('pm', daily)."""
    y = F.when(F.col("label") == -1, 1).otherwise(2) if label_coding == "class" else F.col("label")
    parts = [_f6(F.col(c)) for c in ("close", "open", "high", "low", "open_close", "high_low")]
    parts.append(y.cast("string"))
    if with_news:
        parts += [_f6(F.col("p_down")), _f6(F.col("p_up"))]
    return bars.select("symbol", *(keep or []), F.concat_ws(",", *parts).alias("line"))


def write_feature_matrix(lines: DataFrame, path: str) -> None:
    lines.write.mode("overwrite").partitionBy("symbol").text(path)


FEATURE_SCHEMA_7 = ("close double, open double, high double, low double, open_close double, high_low double, "
                    "y int")
FEATURE_SCHEMA_9 = FEATURE_SCHEMA_7 + ", p_down double, p_up double"


def read_feature_matrix(spark: SparkSession, path: str, with_news: bool = False) -> DataFrame:
    """Headerless numeric matrix with an explicit schema; columns 1-6 = X."""
    return spark.read.schema(FEATURE_SCHEMA_9 if with_news else FEATURE_SCHEMA_7).csv(path, header=False)


# ---------------------------------------------------------------- models and results
def save_model(model, symbols: DataFrame, path: str) -> None:
    """K8: MLlib persistence plus a manifest of the symbols the model covers."""
    model.write().overwrite().save(f"{path}/model")
    symbols.select("symbol").distinct().write.mode("overwrite").parquet(f"{path}/manifest")


def missing_models(spark: SparkSession, wanted: DataFrame, path: str) -> DataFrame:
    """Requested symbols that no saved model covers."""
    have = spark.read.parquet(f"{path}/manifest")
    return wanted.select("symbol").distinct().join(have, "symbol", "left_anti")


def write_results_csv(results: DataFrame, path: str) -> None:
    """Result rows as CSV (name, train, test, sharpe)."""
    results.select("name", "train", "test", "sharpe").write.mode("overwrite").csv(path)


RESULT_SCHEMA = "name string, train double, test double, sharpe double"


def read_results_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RESULT_SCHEMA).csv(path, header=False)
