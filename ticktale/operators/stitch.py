"""Stitching a coarse and a finer bar series.

Rule per symbol: take the first stamp of the finer series (in time order)
that also exists in the coarse series; keep the coarse rows up to and
including it, then append the finer series without its first row. Symbols
with no shared stamp keep the coarse series only. A list of intervals is
folded left to right (e.g. 60min, then 30min, then 15min).

The cut and the first fine stamp are one row per symbol each (aggregates);
the coarse and fine series are filtered against them, never sorted whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import r6


def stitch(coarse: DataFrame, fine: DataFrame, fine_interval: str, time_col: str = "ts",
           coarse_interval: str | None = None) -> DataFrame:
    """Stitch two series; both carry (symbol, time_col, ...same columns).
    The result carries ``source_interval``."""
    if "source_interval" not in coarse.columns:
        coarse = coarse.withColumn("source_interval", F.lit(coarse_interval or "coarse"))
    fine = fine.withColumn("source_interval", F.lit(fine_interval))
    shared = fine.join(coarse.select("symbol", time_col), ["symbol", time_col], "left_semi")
    cut = shared.groupBy("symbol").agg(F.min(time_col).alias("_cut"))
    first = fine.groupBy("symbol").agg(F.min(time_col).alias("_first"))
    keep_coarse = (coarse.join(cut, "symbol", "left")
                         .filter(F.col("_cut").isNull() | (F.col(time_col) <= F.col("_cut")))
                         .drop("_cut"))
    keep_fine = (fine.join(cut, "symbol", "left_semi")
                     .join(first, "symbol")
                     .filter(F.col(time_col) > F.col("_first"))
                     .drop("_first"))
    return keep_coarse.unionByName(keep_fine)


def stitch_all(series: list[tuple[str, DataFrame]], time_col: str = "ts") -> DataFrame:
    """Fold :func:`stitch` over (interval, bars) pairs, coarsest first."""
    (i0, s0), rest = series[0], series[1:]
    start = s0.withColumn("source_interval", F.lit(i0))
    return reduce(lambda acc, nxt: stitch(acc, nxt[1], nxt[0], time_col), rest, start)


def q_stitch_intervals(six_hour: DataFrame, hourly: DataFrame) -> DataFrame:
    s = stitch_all([("360min", six_hour), ("60min", hourly)])
    return s.select("symbol", "ts", "source_interval", r6("open").alias("open"), r6("high").alias("high"),
                    r6("low").alias("low"), r6("close").alias("close"), F.col("volume").cast("long").alias("volume"))
