"""Run logs and reports.

A run log is a table of lines ``(file, sec, blk, pos, line)``; the line key
``(sec, blk, pos)`` orders a file. Blocks have the study's shape: a config
line, ``Avg test accuracy: x``, a spread line, a time line (or
``Time:  t``), then one line per symbol ``%6s   %.4f   %.4f   %.3f`` sorted by
test accuracy; a ``###`` line starts the next section.

Parsing works per file (a file is one experiment's output): section =
running count of ``###`` lines, config = previous line of an accuracy line,
spread/time = the next one or two lines (a ``Time`` line means no spread). No
task sees a whole file: positions and section numbers are running sums over a
range-partitioned sort, neighbours come by a join on the position.
Numbers are rounded before ``format_string`` so that the printed digits do
not depend on the formatter's tie rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import r6
from ..session import written
from .ranking import running_totals

#: Columns that order the lines of a file.
ORDER = ("sec", "blk", "pos")


def fixed(x: Column, d: int) -> Column:
    """``%.{d}f`` of x rounded half-up at d decimals first."""
    scale = float(10 ** d)
    return F.format_string(f"%.{d}f", F.floor(x * F.lit(scale) + F.lit(0.5)) / F.lit(scale))


def to_log(metrics: DataFrame, sections: list[str], file: str = "run") -> DataFrame:
    """K9: metrics(section, config, symbol, name, train_acc, test_acc, sharpe)
    -> log lines. Section i > 0 starts with a '<title>###' line."""
    per_cfg = metrics.groupBy("section", "config").agg(
        F.avg("test_acc").alias("avg_acc"), F.stddev_samp("test_acc").alias("spread"),
        F.count("*").alias("n_sym"))
    blk = F.dense_rank().over(Window.partitionBy("section").orderBy("config"))
    heads = per_cfg.withColumn("blk", blk).select(
        "section", "config", "blk", F.posexplode(F.array(
            F.col("config"),
            F.concat(F.lit("Avg test accuracy: "), r6("avg_acc").cast("string")),
            r6(F.coalesce("spread", F.lit(0.0))).cast("string"),
            (F.col("n_sym") / F.lit(1000.0)).cast("string"))).alias("pos", "line"))
    sym_line = F.format_string("%6s   %s   %s   %s", F.concat(F.col("name"), F.lit(" ("), F.col("symbol"), F.lit(")")),
                               fixed(F.col("train_acc"), 4), fixed(F.col("test_acc"), 4), fixed(F.col("sharpe"), 3))
    rank = F.row_number().over(Window.partitionBy("section", "config").orderBy("test_acc", "symbol"))
    body = metrics.withColumn("pos", rank + 3).select("section", "config", "pos", sym_line.alias("line")) \
                  .join(heads.select("section", "config", "blk").distinct(), ["section", "config"])
    blank = heads.select("section", "config", "blk").distinct().join(
        metrics.groupBy("section", "config").agg(F.count("*").alias("_n")), ["section", "config"]) \
        .select("section", "config", "blk", (F.col("_n") + 4).alias("pos"), F.lit("").alias("line"))
    lines = heads.unionByName(body.select("section", "config", "blk", "pos", "line")).unionByName(blank)
    idx = F.array_position(F.array(*[F.lit(s) for s in sections]), F.col("section")).cast("int") - 1
    out = lines.select(F.lit(file).alias("file"), idx.alias("sec"), F.col("blk").cast("int").alias("blk"),
                       F.col("pos").cast("int").alias("pos"), "line")
    marks = metrics.select("section").distinct().select(
        F.lit(file).alias("file"), idx.alias("sec"), F.lit(0).alias("blk"), F.lit(0).alias("pos"),
        F.concat(F.col("section"), F.lit("###")).alias("line")).filter(F.col("sec") > 0)
    return out.unionByName(marks)


def numbered_lines(lines: DataFrame, marks: Column, order: tuple[str, ...] = ORDER) -> DataFrame:
    """(file, position, section, line): position from 1 inside the file, section
    the running sum of ``marks``."""
    text = lines.select("file", *order, F.coalesce("line", F.lit("")).alias("line"))
    return written(running_totals(text, ["file"], list(order), position=F.lit(1), section=marks.cast("int")).select(
        "file", "position", "section", "line"), "log-lines")


def parse_run_log(lines: DataFrame, order: tuple[str, ...] = ORDER) -> DataFrame:
    """(file, section, config, accuracy, spread, time)."""
    d = numbered_lines(lines, F.col("line").contains("###"), order).withColumn("t", F.trim("line"))
    acc = d.filter(F.col("t").contains("accuracy") & ~F.col("t").contains("###"))

    def neighbour(name: str, step: int) -> DataFrame:
        return d.select("file", (F.col("position") - step).alias("position"), F.col("t").alias(name))
    for name, step in (("prev", -1), ("n1", 1), ("n2", 2)):
        acc = acc.join(neighbour(name, step), ["file", "position"], "left")
    last_tok = lambda c: F.element_at(F.split(c, " "), -1)
    timed = F.col("n1").contains("Time")
    return acc.select(
        "file", F.col("section").cast("int").alias("section"), F.col("prev").alias("config"),
        F.element_at(F.split("t", ": "), -1).cast("double").alias("accuracy"),
        F.when(timed, F.lit(0.0)).otherwise(F.col("n1").cast("double")).alias("spread"),
        F.when(timed, last_tok("n1")).otherwise(last_tok("n2")).cast("double").alias("time"))


def gain_report(parsed: DataFrame, min_acc: float = 51.0, max_time: float = 50.0) -> DataFrame:
    """Gain of the news half over the base half per
    config, filtered (diff >= 0, base accuracy >= min_acc, base time <
    max_time) and ordered by gain; ``line`` is the fixed-width report row."""
    base = parsed.filter("section = 0").select("config", F.col("accuracy").alias("acc_base"),
                                               F.col("spread").alias("std_base"), F.col("time").alias("time_base"))
    news = parsed.filter("section = 1").select("config", F.col("accuracy").alias("acc_news"),
                                               F.col("spread").alias("std_news"), F.col("time").alias("time_news"))
    j = base.join(news, "config").withColumn("diff", F.col("acc_news") - F.col("acc_base")) \
            .withColumn("percent", F.try_divide(100 * F.col("diff"), F.col("acc_base")))
    keep = (F.col("diff") >= 0) & (F.col("acc_base") >= min_acc) & (F.col("time_base") < max_time)
    line = F.format_string("%28s:  %s  %s  %s  %6s  %6s  %6s  %6s  %s", "config", fixed(F.col("diff"), 3),
                           fixed(F.col("percent"), 2), fixed(F.col("acc_base"), 2), fixed(F.col("acc_news"), 2),
                           fixed(F.col("std_base"), 2), fixed(F.col("std_news"), 2), fixed(F.col("time_base"), 2),
                           fixed(F.col("time_news"), 2))
    return j.filter(keep).withColumn("line", line).orderBy("diff")


RESULT_RE = r"^(?:###)?[ ]*(.*[^ ])[ ]+(-?[0-9.]+)[ ]+(-?[0-9.]+)[ ]+(-?[0-9.]+)$"
SYM_RE = r"\(([^)]*)\)$"


def parse_result_sections(lines: DataFrame, order: tuple[str, ...] = ORDER) -> DataFrame:
    """Per-symbol result lines '<name> (<SYM>)  train  test  sharpe' (or
    a bare symbol) in '###' sections -> (section, name, symbol, train, test,
    sharpe)."""
    marks = F.col("line").startswith("###").cast("int") + F.col("line").endswith("###").cast("int")
    d = numbered_lines(lines, marks, order)
    m = d.filter(F.col("line").rlike(RESULT_RE))
    g = lambda i: F.regexp_extract("line", RESULT_RE, i)
    label = g(1)
    sym = F.regexp_extract(label, SYM_RE, 1)
    return m.select("file", F.col("section").cast("int").alias("section"),
                    F.trim(F.regexp_replace(label, SYM_RE, "")).alias("name"),
                    F.when(sym == "", label).otherwise(sym).alias("symbol"),
                    g(2).cast("double").alias("train"), g(3).cast("double").alias("test"),
                    g(4).cast("double").alias("sharpe"))


#: What orders the lines of :func:`read_log`.
READ_ORDER = ("part", "start", "at")


def read_log(spark, path: str) -> DataFrame:
    """A log (one text file or a folder of part files) line by line. Large
    files are read in splits: a split's first byte orders the splits of a
    file, the running id the lines that one task reads from a split."""
    return spark.read.text(path).select(
        F.lit(path).alias("file"), F.col("_metadata.file_name").alias("part"),
        F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"),
        F.col("value").alias("line"))


def write_log(lines: DataFrame, path: str, order: tuple[str, ...] = ORDER) -> None:
    """K9: the lines of one log as text; part files follow the order."""
    lines.orderBy(*order).select("line").write.mode("overwrite").text(path)


# ---------------------------------------------------------------- derived run metrics
def display_name():
    """J5 stand-in registry: the display name of a symbol."""
    return F.regexp_replace("symbol", "#", " ")


def run_metrics(brand_bars: DataFrame, day_bars: DataFrame) -> DataFrame:
    """Two halves of an experiment on the test tables: rule strategies on the
    daily brand bars (prices only) and on the weekday event bars (second
    feature set)."""
    from .backtest import backtest, labelled_bars, rule_signals, summary, with_strategies

    def half(b, section):
        s = summary(backtest(with_strategies(labelled_bars(b), rule_signals())))
        return s.select(
            F.lit(section).alias("section"), F.col("strategy").alias("config"), "symbol", display_name().alias("name"), "train_acc",
            "test_acc", F.coalesce("sharpe", F.lit(0.0)).alias("sharpe"))
    # a row per section, strategy and symbol; the report's branches all read it
    return half(brand_bars, "Daily").unionByName(half(day_bars, "Daily w/ news")).checkpoint()


SECTIONS = ["Daily", "Daily w/ news"]


def q_report_lines(brand_bars: DataFrame, day_bars: DataFrame) -> DataFrame:
    return to_log(run_metrics(brand_bars, day_bars), SECTIONS)


def q_parse_run_log(brand_bars: DataFrame, day_bars: DataFrame) -> DataFrame:
    p = parse_run_log(to_log(run_metrics(brand_bars, day_bars), SECTIONS))
    return p.select("section", "config", r6("accuracy").alias("accuracy"), r6("spread").alias("spread"),
                    r6("time").alias("time"))


def q_read_run_log(brand_bars: DataFrame, day_bars: DataFrame) -> DataFrame:
    """The log written as text, read line by line and parsed."""
    import uuid

    from ..session import ensure_checkpoint_dir
    spark = brand_bars.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/run-log-{uuid.uuid4().hex}"
    write_log(to_log(run_metrics(brand_bars, day_bars), SECTIONS), path)
    p = parse_run_log(read_log(spark, path), READ_ORDER)
    return p.select("section", "config", r6("accuracy").alias("accuracy"), r6("spread").alias("spread"),
                    r6("time").alias("time"))


def q_news_gain_report(brand_bars: DataFrame, day_bars: DataFrame) -> DataFrame:
    g = gain_report(parse_run_log(to_log(run_metrics(brand_bars, day_bars), SECTIONS)))
    return g.select("config", r6("diff").alias("diff"), r6("percent").alias("percent"), "line")


def q_parse_result_sections(brand_bars: DataFrame, day_bars: DataFrame) -> DataFrame:
    return parse_result_sections(to_log(run_metrics(brand_bars, day_bars), SECTIONS))
