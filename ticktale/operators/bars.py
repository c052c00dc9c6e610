"""Price bars: ingest, save/scan, features, direction labels, returns, splits.

All per-symbol window work runs on bars, whose count per symbol is fixed by
the calendar and the bar width (not by the raw data volume: the raw rows are
already folded into bars by a partial+final aggregate). The windows partition
by ``symbol`` and order by the bar time.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.numeric import r6

# The bar intervals the study requests, finest last.
INTERVALS = ("daily", "60min", "30min", "15min", "5min", "1min")
VENDOR_COLUMNS = {"1. open": "open", "2. high": "high", "3. low": "low",
                  "4. close": "close", "5. volume": "volume"}


def by_symbol(time_col: str = "bar_date", key: str = "symbol"):
    return Window.partitionBy(key).orderBy(time_col)


# ---------------------------------------------------------------- S1, K1, S2
def ingest_vendor_bars(raw: DataFrame) -> DataFrame:
    """Rename the vendor's numbered columns and drop rows with a null."""
    present = {k: v for k, v in VENDOR_COLUMNS.items() if k in raw.columns}
    return raw.withColumnsRenamed(present).dropna("any")


def save_bars(bars: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K1: one directory per interval and symbol (partition pruning on read)."""
    bars.write.mode(mode).partitionBy("interval", "symbol").parquet(path)


def read_bars(spark: SparkSession, path: str, interval: str | None = None) -> DataFrame:
    """Scan saved series; ``interval`` prunes to one partition directory."""
    df = spark.read.parquet(path)
    return df.filter(F.col("interval") == interval) if interval else df


def tag_interval(bars: DataFrame, interval: str) -> DataFrame:
    return bars.withColumn("interval", F.lit(interval))


def missing_series(stored: DataFrame, intervals=INTERVALS) -> DataFrame:
    """S3 re-aimed: the request grid (every interval for every known symbol)
    minus the stored (symbol, interval) pairs. The grid is generated per symbol
    with ``explode`` of a literal array, so it stays partitioned by symbol."""
    syms = stored.select("symbol").distinct()
    grid = syms.select("symbol", F.explode(F.array(*[F.lit(i) for i in intervals])).alias("interval"))
    have = stored.select("symbol", "interval").distinct()
    return grid.join(have, ["symbol", "interval"], "left_anti")


def after_date(bars: DataFrame, start: str | None, time_col: str = "bar_date") -> DataFrame:
    """optional date floor (e.g. start after a crash); a plain filter
    that reaches the scan when the bars come straight from storage."""
    return bars if start is None else bars.filter(F.col(time_col) >= F.lit(start).cast("date"))


# ---------------------------------------------------------------- F1-F6
def price_features(bars: DataFrame) -> DataFrame:
    """Open-Close and High-Low."""
    return bars.withColumns({
        "open_close": F.col("open") - F.col("close"),
        "high_low": F.col("high") - F.col("low"),
    })


def feature_columns(with_news: bool) -> list[str]:
    """the two price features, plus the news probabilities."""
    return ["open_close", "high_low"] + (["p_down", "p_up"] if with_news else [])


def direction_label(bars: DataFrame, time_col: str = "bar_date") -> DataFrame:
    """+1 when the next close is strictly higher, else -1 (last row -1)."""
    nxt = F.lead("close").over(by_symbol(time_col))
    return (bars.withColumn("next_close", nxt)
                .withColumn("label", F.when(F.col("next_close") > F.col("close"), 1).otherwise(-1)))


def class_index(label: Column) -> Column:
    """-1 -> 1, +1 -> 2."""
    return F.when(label == -1, F.lit(1)).otherwise(F.lit(2))


def to_plus_minus(df: DataFrame, label: str = "label", key: str = "symbol") -> DataFrame:
    """map any two classes to -1/+1 by min/max over the group."""
    w = Window.partitionBy(key)
    lo, hi = F.min(label).over(w), F.max(label).over(w)
    pm = F.try_divide(F.lit(2.0) * (F.col(label) - lo), (hi - lo).cast("double")) - 1
    return df.withColumn("label_pm", pm.cast("int"))


def log_return(bars: DataFrame, time_col: str = "bar_date") -> DataFrame:
    """ln(close[t+1] / close[t]) * 100, NULL on the last row."""
    nxt = F.lead("close").over(by_symbol(time_col))
    return bars.withColumn("ret", F.ln(F.try_divide(nxt, F.col("close"))) * 100)


def positional_split(bars: DataFrame, frac: float = 0.8, time_col: str = "bar_date",
                     overlap: bool = False) -> DataFrame:
    """W5 (default): first ``floor(frac*n)`` rows train, rest test.
    W6 (``overlap=True``): train rows ``<= round(frac*n)``, test rows
    ``>= round(frac*n)``; the boundary row is in both."""
    w = by_symbol(time_col)
    n = F.count(F.lit(1)).over(Window.partitionBy("symbol"))
    df = bars.withColumn("rn", F.row_number().over(w)).withColumn("n", n)
    if overlap:
        cut = F.round(F.col("n") * frac).cast("long")
        return df.withColumns({"is_train": F.col("rn") <= cut, "is_test": F.col("rn") >= cut})
    cut = F.floor(F.col("n") * frac)
    return df.withColumns({"is_train": F.col("rn") <= cut, "is_test": F.col("rn") > cut})


# ---------------------------------------------------------------- query views
def q_daily_bars(bars: DataFrame) -> DataFrame:
    b = ingest_vendor_bars(tag_interval(bars, "daily"))
    return b.select("symbol", "interval", "bar_date", r6("open").alias("open"), r6("high").alias("high"),
                    r6("low").alias("low"), r6("close").alias("close"), r6("volume").alias("volume"))


def q_price_features(bars: DataFrame) -> DataFrame:
    f = price_features(bars)
    return f.select("symbol", "bar_date", r6("open_close").alias("open_close"), r6("high_low").alias("high_low"))


def q_direction_label(bars: DataFrame) -> DataFrame:
    d = direction_label(bars)
    return d.select("symbol", "bar_date", r6("close").alias("close"), r6("next_close").alias("next_close"), "label")


def q_label_recode(bars: DataFrame) -> DataFrame:
    d = to_plus_minus(direction_label(bars).withColumn("class_idx", class_index(F.col("label"))),
                      label="class_idx")
    return d.select("symbol", "bar_date", "label", "class_idx", "label_pm")


def q_log_return(bars: DataFrame) -> DataFrame:
    return log_return(bars).select("symbol", "bar_date", r6("ret").alias("ret"))


def q_positional_split(bars: DataFrame) -> DataFrame:
    d = positional_split(bars)
    ov_cut = F.round(F.col("n") * 0.8).cast("long")
    return d.select("symbol", "bar_date", F.col("rn").cast("long").alias("rn"), F.col("n").cast("long").alias("n"),
                    "is_train", "is_test", (F.col("rn") <= ov_cut).alias("ov_train"),
                    (F.col("rn") >= ov_cut).alias("ov_test"))


def q_missing_series(daily: DataFrame, hourly: DataFrame, six_hour: DataFrame) -> DataFrame:
    stored = reduce(DataFrame.unionByName, [
        daily.select("symbol").distinct().withColumn("interval", F.lit("daily")),
        hourly.select("symbol").distinct().withColumn("interval", F.lit("60min")),
        six_hour.select("symbol").distinct().withColumn("interval", F.lit("360min")),
    ])
    return missing_series(stored)
