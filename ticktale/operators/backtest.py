"""Back-test of direction signals.

A *prediction* row is (symbol, strategy, bar time, signal in {-1,+1}). The
back-test accumulates the market's log return and the strategy return
``signal * ret`` over the test rows of each (symbol, strategy) series, and
summarises accuracy and the study's "sharpe" (mean scaled excess of the
cumulative strategy return over the market, std with n-1).

Labels, returns and split flags are properties of the bars; they are computed
once per symbol and carried with every strategy's signal, so one window sort
per (symbol, strategy) serves all cumulative columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import r6
from .bars import by_symbol, direction_label, log_return, positional_split

UNBOUNDED = Window.unboundedPreceding


def labelled_bars(bars: DataFrame, frac: float = 0.8, time_col: str = "bar_date",
                  start: str | None = None) -> DataFrame:
    """Bars with label (F4), ret (W2), rn/n, the positional split (W5) and
    the previous direction; ``start`` is the optional date floor (F22)."""
    from .bars import after_date
    bars = after_date(bars, start, time_col)
    lb = positional_split(log_return(direction_label(bars, time_col), time_col), frac, time_col)
    return with_prev_direction(lb, time_col)


def with_prev_direction(lb: DataFrame, time_col: str = "bar_date") -> DataFrame:
    """``prev``: the previous bar's direction (+1 on the first bar)."""
    return lb.withColumn("prev", F.coalesce(F.lag("label").over(by_symbol(time_col)), F.lit(1)))


def rule_signals() -> dict[str, Column]:
    """Model-free signals used as stand-ins until a model is plugged in:
    ``long`` always +1 (the market itself, sharpe 0), ``prev_dir`` the
    previous bar's direction, ``contrarian`` its opposite. They read the
    ``prev`` column of :func:`with_prev_direction`."""
    return {"long": F.lit(1), "prev_dir": F.col("prev"), "contrarian": -F.col("prev")}


def with_strategies(lb: DataFrame, signals: dict[str, Column]) -> DataFrame:
    """Long form: one row per bar and strategy (explode of a literal-sized
    array of structs, no join)."""
    arr = F.array(*[F.struct(F.lit(k).alias("strategy"), v.cast("int").alias("signal"))
                    for k, v in signals.items()])
    return lb.withColumn("_s", F.explode(arr)).select("*", "_s.strategy", "_s.signal").drop("_s")


def backtest(pred: DataFrame, keys=("symbol", "strategy"), time_col: str = "bar_date") -> DataFrame:
    """cum_ret and cum_strat_ret accumulate from the first test row
    (test rows are a suffix, so train rows add NULL) and are NULL where the
    return is NULL (pandas keeps NaN there). Train rows stay in the frame so
    that accuracy and sharpe come from one aggregate over one sort."""
    w = Window.partitionBy(*keys).orderBy(time_col).rowsBetween(UNBOUNDED, 0)
    ret = F.col("ret")
    on_test = F.col("is_test") & ret.isNotNull()
    return (pred.withColumn("strat_ret", F.col("signal") * ret)
                .withColumn("cum_ret", F.when(on_test, F.sum(F.when(F.col("is_test"), ret)).over(w)))
                .withColumn("cum_strat_ret",
                            F.when(on_test, F.sum(F.when(F.col("is_test"), F.col("strat_ret"))).over(w))))


def summary(curves: DataFrame, keys=("symbol", "strategy")) -> DataFrame:
    """A5 train/test accuracy and A9 sharpe per series, one aggregate."""
    hit = (F.col("signal") == F.col("label")).cast("double")
    return curves.groupBy(*keys).agg(
        F.count(F.when(F.col("is_train"), 1)).alias("n_train"),
        F.count(F.when(F.col("is_test"), 1)).alias("n_test"),
        (F.avg(F.when(F.col("is_train"), hit)) * 100).alias("train_acc"),
        (F.avg(F.when(F.col("is_test"), hit)) * 100).alias("test_acc"),
        F.try_divide(F.avg(F.col("cum_strat_ret") - F.col("cum_ret")),
                     F.stddev_samp("cum_strat_ret")).alias("sharpe"))


def overall(summ: DataFrame, by=("strategy",)) -> DataFrame:
    """Mean and sample stdev of test accuracy over symbols."""
    return summ.groupBy(*by).agg(
        F.count("*").alias("n_symbols"),
        F.avg("test_acc").alias("mean_test_acc"),
        F.stddev_samp("test_acc").alias("std_test_acc"))


def wide_curves(curves: DataFrame, strategies: list[str], time_col: str = "bar_date") -> DataFrame:
    """Per (symbol, time) the market curve and one column per strategy,
    from one pivot (values given, so no extra pass to find them)."""
    piv = (curves.filter("is_test").groupBy("symbol", time_col).pivot("strategy", strategies)
                 .agg(F.first("cum_strat_ret", ignorenulls=True).alias("c"),
                      F.first("cum_ret", ignorenulls=True).alias("m")))
    return piv.select("symbol", time_col, F.col(f"{strategies[0]}_m").alias("market"),
                      *[F.col(f"{s}_c").alias(s) for s in strategies])


# ---------------------------------------------------------------- query views
def _prev_dir_pred(bars: DataFrame) -> DataFrame:
    return with_strategies(labelled_bars(bars), {"prev_dir": rule_signals()["prev_dir"]})


def q_backtest_cum_return(bars: DataFrame) -> DataFrame:
    c = backtest(_prev_dir_pred(bars), keys=("symbol",)).filter("is_test")
    return c.select("symbol", "bar_date", "signal", "label", r6("ret").alias("ret"),
                    r6("cum_ret").alias("cum_ret"), r6("strat_ret").alias("strat_ret"),
                    r6("cum_strat_ret").alias("cum_strat_ret"))


def q_backtest_sharpe(bars: DataFrame) -> DataFrame:
    s = summary(backtest(_prev_dir_pred(bars), keys=("symbol",)), keys=("symbol",))
    return s.select("symbol", "n_train", "n_test", r6("train_acc").alias("train_acc"),
                    r6("test_acc").alias("test_acc"), r6("sharpe").alias("sharpe")).orderBy("test_acc", "symbol")


def q_backtest_overall(bars: DataFrame) -> DataFrame:
    s = summary(backtest(with_strategies(labelled_bars(bars), rule_signals())))
    o = overall(s)
    return o.select("strategy", "n_symbols", r6("mean_test_acc").alias("mean_test_acc"),
                    r6("std_test_acc").alias("std_test_acc"))


def q_strategy_curves_wide(bars: DataFrame) -> DataFrame:
    sig = rule_signals()
    strategies = list(sig)
    wide = wide_curves(backtest(with_strategies(labelled_bars(bars), sig)), strategies)
    return wide.select("symbol", "bar_date", r6("market").alias("market"),
                       *[r6(s).alias(s) for s in strategies])
