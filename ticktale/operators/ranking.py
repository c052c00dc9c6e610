"""Exact ranks inside key groups without a window over a whole group.

A window ``row_number() OVER (PARTITION BY key ORDER BY ...)`` sends every
row of a key to one task; a key may hold a third of all rows (one class,
one pooled vocabulary). Here the rows are sorted once with Spark's
range-partitioned sort, each row's position inside its sorted partition comes
from ``monotonically_increasing_id`` (partition id in the high bits), and the
partition offsets come from a table with one row per partition. The sorted
frame is written first, so partition ids and positions are fixed. The
rank of a row inside its key is its global position minus the key's first
position (an aggregate joined back).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written


def rank_within(df: DataFrame, keys: list[str], order: list[Column | str], rank: str = "_rank",
                size: str = "_n") -> DataFrame:
    """Add ``rank`` (1-based, by ``order`` inside ``keys``) and ``size`` (rows
    of the key). ``order`` must be a total order inside a key (end it with a
    unique column)."""
    s = _sorted(df, keys, order)
    pos = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    sizes = s.groupBy("_pid").agg(F.count("*").alias("_c"))                 # one row per partition
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    # written, so that their size is known and the sorted rows need not move to meet them
    offs = written(sizes.select("_pid", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off")), "offsets")
    g = s.join(offs, "_pid").withColumn("_g", F.col("_off") + pos + 1)
    if keys:
        first = written(g.groupBy(*keys).agg(F.min("_g").alias("_first"), F.count("*").alias(size)), "first-places")
        g = g.join(first, keys).withColumn(rank, F.col("_g") - F.col("_first") + 1).drop("_first")
    else:
        total = sizes.agg(F.coalesce(F.sum("_c"), F.lit(0))).first()[0]
        g = g.withColumn(rank, F.col("_g")).withColumn(size, F.lit(total).cast("long"))
    return g.drop("_pid", "_mid", "_off", "_g")


def _sorted(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """Rows written in order with their partition and place; what is written
    stays as it is, whoever reads it."""
    return written(df.orderBy(*keys, *order).withColumn("_pid", F.spark_partition_id())
                   .withColumn("_mid", F.monotonically_increasing_id()), "sorted")


def running_totals(df: DataFrame, keys: list[str], order: list[Column | str], **values: Column) -> DataFrame:
    """Add running sums (inclusive, by ``order`` inside ``keys``) of columns
    that are never null: a window inside each sorted partition, which the
    sort keeps to a task's size, plus the sums of the partitions before."""
    s = _sorted(df.withColumns({f"_v_{k}": v for k, v in values.items()}), keys, order)
    sums = s.groupBy("_pid", *keys).agg(*[F.sum(f"_v_{k}").alias(f"_s_{k}") for k in values])
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = sums.select("_pid", *keys, *[F.coalesce(F.sum(f"_s_{k}").over(before), F.lit(0)).alias(f"_o_{k}") for k in values])
    here = Window.partitionBy("_pid", *keys).orderBy("_mid").rowsBetween(Window.unboundedPreceding, 0)
    out = s.join(offs, ["_pid", *keys]).select("*", *[
        (F.col(f"_o_{k}") + F.sum(f"_v_{k}").over(here)).alias(k) for k in values])
    return out.drop("_pid", "_mid", *[f"_{p}_{k}" for k in values for p in "vo"])
