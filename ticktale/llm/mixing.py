"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each source gets a word budget. A document's exponential key is
``-ln(u) / w`` with ``u`` from a seeded hash of its id and ``w`` its quality
weight; ascending keys inside a source are a weighted sample without
replacement. Complete epochs of a source come first; what is left of the
budget is filled by the sorted documents whose running word sum (half of the
document counted) still fits.

No task sees a whole source: keys are counted in narrow geometric steps, each
step is cut evenly into ranges of about ``rows_per_range`` documents whatever
the weights, range sums are added up per source on the small range table, and
only the rows of one range meet in a window.

SQL functions only. Defined results: a null text has size 0; null sources are
one source, last in order; a source without words has target 0 and takes
nothing; rows that repeat a doc_id have equal keys and are ordered by size; rows
with a null id are told apart by their text. Reruns agree, the hash has a fixed seed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticktale.llm.common import WORD, stored, text_of

#: The weight of the first, second, third source, repeating.
SOURCE_WEIGHTS = (3, 1, 2)
TOTAL_SHARE = 1.5
MAX_EPOCHS = 2
STEPS = 64                  # of a doubling of the key


def quality_weight(text: Column, size: Column) -> Column:
    """Between 0.1 and 1: the share of words left after one is taken off for
    every symbol character of junk text."""
    symbols = F.regexp_count(text, F.lit(r"[#*$%&|<>]"))
    return F.greatest(F.lit(0.1), F.coalesce(F.lit(1.0) - F.try_divide(symbols, size), F.lit(0.1)))


def targets(sources: DataFrame, weights: tuple[int, ...] = SOURCE_WEIGHTS, share: float = TOTAL_SHARE,
            max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Budgets of a table (source, source_size, n_rows), one row per source.

    With a bound of ``max_epochs`` times its size, sharing the excess again by
    weight until none is above ends at ``target = min(bound, level * weight)``
    for the one level at which the targets sum to the total."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    t = (sources.withColumn("ord", F.row_number().over(order)).withColumn("w", w)
         .withColumn("bound", F.col("source_size") * float(max_epochs)))
    by_ratio = Window.orderBy(F.col("bound") / F.col("w"), "ord")
    before = F.coalesce(F.sum("bound").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest_w = F.sum("w").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    everything = Window.partitionBy()
    t = t.withColumn("try_level", (F.sum("source_size").over(everything) * share - before) / rest_w)
    ok = F.when(F.col("try_level") <= F.col("bound") / F.col("w"), F.col("try_level"))
    t = t.withColumn("level", F.max(ok).over(everything))
    return t.select("source", "ord", "source_size", "n_rows",
                    F.least(F.col("bound"), F.coalesce(F.col("level"), F.lit(0.0)) * F.col("w")).alias("target"))


def _steps(rows: DataFrame, plan: DataFrame, rows_per_range: int) -> DataFrame:
    """(ord, step, first_range, ranges): how many ranges each step of keys is
    cut into; a step is about one percent of the key wide, so keys lie evenly
    in it. At most some thousand steps for a source."""
    counts = (rows.groupBy("source", "step").agg(F.count("*").alias("in_step"))
              .join(plan.select("_s", "ord"), F.col("source").eqNullSafe(F.col("_s")))
              .select("ord", "step", F.ceil(F.col("in_step") / F.lit(rows_per_range)).alias("ranges")))
    over = Window.partitionBy("ord").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("ord", "step", "ranges", F.coalesce(F.sum("ranges").over(over), F.lit(0)).alias("first_range"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        seed: int = 17, rows_per_range: int = 512, weights: tuple[int, ...] = SOURCE_WEIGHTS,
        share: float = TOTAL_SHARE, max_epochs: int = MAX_EPOCHS, carry: tuple[str, ...] = ()) -> DataFrame:
    """Per document: ``id_col, source, size, weight, source_size, target,
    copies`` (whole times the mix takes it) and ``taken`` (words); then the
    ``carry`` columns, which also order rows of equal key, id and size."""
    carried = [f"_carry{i}" for i in range(len(carry))]
    size = F.regexp_count(text_of("_t"), F.lit(WORD)).cast("long")
    sized = docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("source"),
                        F.col(text_col).alias("_t"), *(F.col(c).alias(x) for c, x in zip(carry, carried)))
    told_apart = F.when(F.col("_id").isNull(), F.xxhash64(F.lit(seed), F.col("_t"))).otherwise(F.xxhash64("_id", F.lit(seed)))
    sized = sized.select("_id", "source", size.alias("size"), told_apart.alias("h"),
                         quality_weight(text_of("_t"), size.cast("double")).alias("weight"), *carried)
    u = (F.pmod(F.col("h"), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))
    rows = stored(sized.withColumn("k", -F.log(u) / F.col("weight")).drop("h")
                  .withColumn("step_at", F.log2(F.greatest(F.col("k"), F.lit(1e-300))) * STEPS)
                  .withColumn("step", F.floor("step_at")), "mix-rows")
    plan = stored(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size"),
                                                    F.count("*").alias("n_rows")),
                          weights, share, max_epochs), "mix-targets")
    plan = plan.withColumnRenamed("source", "_s")
    r = rows.join(plan, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    epochs = F.least(F.floor(F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0))),
                     F.lit(max_epochs))
    r = (r.withColumn("epochs", epochs.cast("long"))
          .withColumn("left_over", F.col("target") - F.col("epochs") * F.col("source_size"))
          .join(_steps(rows, plan, rows_per_range), ["ord", "step"])
          .withColumn("rng", F.col("first_range") + F.floor((F.col("step_at") - F.col("step")) * F.col("ranges"))))
    sums = r.groupBy("ord", "rng").agg(F.sum("size").alias("range_size"))
    over = Window.partitionBy("ord").orderBy("rng").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("ord", "rng", F.coalesce(F.sum("range_size").over(over), F.lit(0)).alias("range_before"))
    inside = Window.partitionBy("ord", "rng").orderBy("k", "_id", "size", *carried).rowsBetween(Window.unboundedPreceding, -1)
    r = r.join(sums, ["ord", "rng"])
    before = F.col("range_before") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    extra = (before + F.col("size") / F.lit(2.0) <= F.col("left_over")) & (F.col("epochs") < max_epochs)
    r = r.withColumn("copies", F.col("epochs") + F.when(extra, 1).otherwise(0).cast("long"))
    return r.select(F.col("_id").alias(id_col), "source", "size", "weight", "source_size", "target", "copies",
                    (F.col("copies") * F.col("size")).alias("taken"), *(F.col(x).alias(c) for c, x in zip(carry, carried)))
