"""AdaBoost as one grouped job: the keyed rounds, its conditions, odd inputs."""

import math

from pyspark.sql import functions as F

from ticktale.operators import boost

SCHEMA = "symbol string, rid long, y int, is_train boolean, is_test boolean, xs array<double>"


def examples(spark, n=60, symbols=("S", "T")):
    rows = [(s, i, 1 if (i * 37 + j) % 7 < 3 else -1, i % 5 != 0, i % 5 == 0,
             [float((i * 13) % 11), float(i % 5), 2.0, float((i * (j + 3)) % 17)])
            for j, s in enumerate(symbols) for i in range(1, n + 1)]
    return spark.createDataFrame(rows, SCHEMA)


def test_grouped_rounds_equal_keyed_rounds(spark):
    rows = examples(spark)
    train = rows.where("is_train").select("symbol", "rid", "y", "xs")
    w, want = boost.initial_weights(train), {}
    for r in range(1, 5):
        s, w = boost.boost_round(train, w, r)
        want.update({(x.symbol, r): x for x in s.collect()})
    got = boost.adaboost(rows, 4).collect()
    assert len(got) == 8
    for g in got:
        x = want[(g.symbol, g["round"])]
        assert (g.fno, g.thresh, g.polarity) == (x.fno, x.thresh, x.polarity)
        assert all(math.isclose(g[c], x[c], rel_tol=1e-9) for c in ("perf", "error", "alpha", "z"))


def test_default_rounds_are_half_of_all_rows_and_meet_the_conditions(spark):
    rows = examples(spark, 61)
    stumps = boost.adaboost(rows)
    assert {r.symbol: r.n for r in stumps.groupBy("symbol").agg(F.count("*").alias("n")).collect()} == {"S": 31, "T": 31}
    flags = ("weights_sum", "error_holds", "is_least", "bound_holds")
    right = boost.boost_conditions(rows, stumps)
    assert right.count() == 62 and right.where(" AND ".join(flags)).count() == 62
    moved = boost.boost_conditions(rows, stumps.withColumn("thresh", F.col("thresh") + F.when(F.col("round") == 3, 2.0).otherwise(0.0)))
    assert moved.where("NOT error_holds").count() > 0
    assert moved.where("round < 3").where(" AND ".join(flags)).count() == 4
    worse = boost.boost_conditions(rows, stumps.withColumns({"polarity": -F.col("polarity"), "error": 1 - F.col("error"), "alpha": -F.col("alpha")}))
    assert worse.where("NOT is_least").count() > 0


def test_curves_equal_the_vote_counted_by_hand(spark):
    rows = examples(spark, 30, ("S",))
    stumps = boost.adaboost(rows, 3)
    model = sorted(stumps.collect(), key=lambda s: s["round"])
    data = rows.collect()
    for got in boost.boosted_errors(rows, stumps).collect():
        def wrong(r):
            vote = sum(m.alpha * (m.polarity if r.xs[m.fno - 1] < m.thresh else -m.polarity) for m in model[:got["round"]])
            return (1 if vote > 0 else -1) != r.y
        for flag, value in ((True, got.train_err), (False, got.test_err)):
            part = [wrong(r) for r in data if r.is_train == flag]
            assert math.isclose(value, sum(part) / len(part))
        assert math.isclose(got.err_bound, math.prod(m.z for m in model[:got["round"]]))


def test_one_row_one_label_no_training_rows_and_no_rows(spark):
    rows = spark.createDataFrame([("one", 1, 1, True, False, [3.0, 4.0]), ("none", 1, -1, False, True, [3.0, 4.0]),
                                  *[("same", i, -1, True, False, [1.0, 1.0]) for i in range(4)]], SCHEMA)
    stumps = boost.adaboost(rows)
    assert {(s.symbol, s["round"], s.fno) for s in stumps.collect()} == {("one", 1, 1), ("same", 1, 1), ("same", 2, 1)}
    errors = boost.boosted_errors(rows, stumps).collect()
    assert len(errors) == 3 and all(e.train_err == 0 and e.test_err is None for e in errors)
    assert boost.adaboost(rows.limit(0)).count() == 0


def test_updated_weights_equal_those_of_a_round(spark):
    train = examples(spark).where("is_train").select("symbol", "rid", "y", "xs")
    w = boost.initial_weights(train)
    s, want = boost.boost_round(train, w, 1)
    p = boost.stump_predict(train.join(w, ["symbol", "rid"]), s)
    both = boost.update_weights(p).select("symbol", "rid", "w").join(want.withColumnRenamed("w", "v"), ["symbol", "rid"])
    assert both.count() == 96 and both.where("abs(w - v) > 1e-12").count() == 0
