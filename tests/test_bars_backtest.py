import datetime as dt
import math

from pyspark.sql import functions as F

from ticktale.operators import backtest as bt
from ticktale.operators import bars


def _bars(spark, closes, symbol="S"):
    d0 = dt.date(2024, 1, 1)
    rows = [(symbol, d0 + dt.timedelta(days=i), float(c), float(c) + 1, float(c) - 1, float(c), 1.0)
            for i, c in enumerate(closes)]
    return spark.createDataFrame(rows, "symbol string, bar_date date, open double, high double, low double, "
                                       "close double, volume double")


def test_direction_label_last_row_minus_one(spark):
    out = bars.direction_label(_bars(spark, [10, 11, 11, 9])).orderBy("bar_date").collect()
    assert [r.label for r in out] == [1, -1, -1, -1]


def test_log_return(spark):
    out = bars.log_return(_bars(spark, [10, 11])).orderBy("bar_date").collect()
    assert math.isclose(out[0].ret, math.log(1.1) * 100)
    assert out[1].ret is None


def test_positional_split_floor_and_overlap(spark):
    b = _bars(spark, range(1, 11))
    plain = bars.positional_split(b).orderBy("bar_date").collect()
    assert sum(r.is_train for r in plain) == 8 and sum(r.is_test for r in plain) == 2
    ov = bars.positional_split(b, overlap=True).orderBy("bar_date").collect()
    assert [r.rn for r in ov if r.is_train] == list(range(1, 9))
    assert [r.rn for r in ov if r.is_test] == [8, 9, 10]


def test_vendor_ingest_renames_and_drops_nulls(spark):
    raw = spark.createDataFrame([(1.0, 2.0, 0.5, 1.5, 10.0), (None, 2.0, 0.5, 1.5, 10.0)],
                                "`1. open` double, `2. high` double, `3. low` double, `4. close` double, "
                                "`5. volume` double")
    out = bars.ingest_vendor_bars(raw)
    assert out.columns == ["open", "high", "low", "close", "volume"] and out.count() == 1


def test_constant_long_signal_is_the_market(spark):
    lb = bt.labelled_bars(_bars(spark, [10, 11, 10.5, 12, 13, 12.5, 12, 14, 15, 14.5] * 3))
    cur = bt.backtest(bt.with_strategies(lb, {"long": F.lit(1)}))
    for r in cur.filter("is_test").collect():
        assert r.cum_ret == r.cum_strat_ret
    s = bt.summary(cur).collect()[0]
    assert s.sharpe == 0.0


def test_cum_return_starts_at_first_test_row(spark):
    lb = bt.labelled_bars(_bars(spark, [10, 11, 12, 13, 14, 15, 16, 17, 18, 19]))
    cur = bt.backtest(bt.with_strategies(lb, {"long": F.lit(1)})).orderBy("bar_date").collect()
    test = [r for r in cur if r.is_test]
    assert len(test) == 2
    assert math.isclose(test[0].cum_ret, test[0].ret)
    assert test[1].ret is None and test[1].cum_ret is None
    assert all(r.cum_ret is None for r in cur if r.is_train)


def test_missing_series_grid(spark):
    stored = spark.createDataFrame([("A", "daily"), ("A", "60min"), ("B", "daily")], "symbol string, interval string")
    out = {(r.symbol, r.interval) for r in bars.missing_series(stored, ("daily", "60min")).collect()}
    assert out == {("B", "60min")}
