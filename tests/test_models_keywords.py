import datetime as dt
import math
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from ticktale.operators import keywords, report, stitch

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@needs_data
@pytest.mark.parametrize("name", ["svm_linear", "svm_rbf_rff", "tree", "mlp"])
def test_model_accuracies_in_range(spark, name):
    rows = E.queries()[name](spark, SF).collect()
    assert rows
    for r in rows:
        assert 0 <= r.train_acc <= 100 and 0 <= r.test_acc <= 100
        assert r.n_train > r.n_test > 0


@needs_data
def test_logreg_ovr_classes_and_accuracy(spark):
    rows = {r.split: r for r in E.queries()["logreg_ovr"](spark, SF).collect()}
    assert set(rows) == {"train", "test"} and rows["train"].n_classes == 10
    assert 0 <= rows["test"].accuracy <= 100


@needs_data
def test_news_probabilities_sum_to_one_or_zero(spark):
    for r in E.queries()["svm_news_proba"](spark, SF).collect():
        s = r.p_down + r.p_up
        assert math.isclose(s, 1.0, abs_tol=1e-5) or s == 0.0


def test_keyword_ranks_conserve_mass_on_a_connected_graph(spark):
    summ = spark.createDataFrame([(1, "alpha beta gamma alpha delta beta")], "doc_id long, summary string")
    ranks = keywords.rank_words(summ).collect()
    assert math.isclose(sum(r.rank for r in ranks), 1.0, rel_tol=1e-9)
    assert sorted(r.kw_rank for r in ranks) == [1, 2, 3, 4]
    top = keywords.top_keywords(keywords.rank_words(summ)).collect()
    assert len(top) == 0            # floor(0.2 * 4) = 0 keywords
    summ5 = spark.createDataFrame([(1, "alpha beta gamma alpha delta beta epsilon alpha")],
                                  "doc_id long, summary string")
    assert [r.word for r in keywords.top_keywords(keywords.rank_words(summ5)).collect()] == ["alpha"]


def test_phrases_are_runs_of_adjacent_keywords(spark):
    summ = spark.createDataFrame([(1, "x y")], "doc_id long, summary string")
    kw = spark.createDataFrame([(1, "x"), (1, "y")], "doc_id long, word string")
    assert [r.phrase for r in keywords.keyword_phrases(summ, kw).collect()] == ["x y"]
    summ2 = spark.createDataFrame([(1, "x the y")], "doc_id long, summary string")
    assert keywords.keyword_phrases(summ2, kw).count() == 0


def test_stitch_fold_over_three_intervals(spark):
    def s(stamps, tag):
        return spark.createDataFrame([("S", dt.datetime(2024, 1, 2, h, m), tag) for h, m in stamps],
                                     "symbol string, ts timestamp_ntz, tag string")
    out = stitch.stitch_all([("60min", s([(9, 0), (10, 0), (11, 0)], "h")),
                             ("30min", s([(10, 0), (10, 30), (11, 0)], "m")),
                             ("15min", s([(10, 30), (10, 45)], "q"))]).orderBy("ts").collect()
    assert [(r.ts.strftime("%H:%M"), r.source_interval) for r in out] == [
        ("09:00", "60min"), ("10:00", "60min"), ("10:30", "30min"), ("10:45", "15min")]


def test_log_writer_and_parser_roundtrip(spark):
    m = spark.createDataFrame([
        ("Daily", "cfg", "A", "Alpha", 60.0, 50.0, 1.0), ("Daily", "cfg", "B", "Beta", 70.0, 54.0, -0.5),
        ("Daily w/ news", "cfg", "A", "Alpha", 61.0, 52.0, 0.2), ("Daily w/ news", "cfg", "B", "Beta", 71.0, 56.0, 0.1)],
        "section string, config string, symbol string, name string, train_acc double, test_acc double, sharpe double")
    lines = report.to_log(m, ["Daily", "Daily w/ news"])
    parsed = {(r.section, r.config): r for r in report.parse_run_log(lines).collect()}
    assert math.isclose(parsed[(0, "cfg")].accuracy, 52.0) and math.isclose(parsed[(1, "cfg")].accuracy, 54.0)
    res = report.parse_result_sections(lines).collect()
    assert {(r.section, r.symbol, r.test) for r in res} == {(0, "A", 50.0), (0, "B", 54.0), (1, "A", 52.0),
                                                           (1, "B", 56.0)}
    g = report.gain_report(report.parse_run_log(lines)).collect()
    assert [r.config for r in g] == ["cfg"] and math.isclose(g[0].diff, 2.0)


def test_block_diagonal_fit_splits_per_symbol(spark):
    """The joint objective splits per symbol: with regParam = lam/N on
    one-hot(symbol) x features, a symbol's model does not depend on which
    other symbols share the fit. (A single-symbol fit is not a valid
    reference: MLlib zeroes constant nonzero columns without an intercept.)"""
    import random

    from pyspark.ml.classification import LogisticRegression

    from ticktale.operators import models as md
    rnd = random.Random(1)
    rows = []
    for sym, n, w in (("A", 300, (1.5, -2.0)), ("B", 500, (-1.0, 0.5)), ("C", 200, (0.3, 2.0))):
        for i in range(n):
            x1, x2 = rnd.gauss(0, 1), rnd.gauss(0, 1)
            y = 1.0 if w[0] * x1 + w[1] * x2 + rnd.gauss(0, 0.5) > 0 else 0.0
            rows.append((sym, i, x1, x2, y))
    df = spark.createDataFrame(rows, "symbol string, i long, x1 double, x2 double, label01 double")
    lam = 5.0

    def fit(symbols):
        part = df.filter(F.col("symbol").isin(*symbols))
        blk, _ = md.with_block_features(part, [F.col("x1"), F.col("x2")])
        n = part.count()
        m = LogisticRegression(labelCol="label01", fitIntercept=False, standardization=False, regParam=lam / n,
                               maxIter=300, tol=1e-12).fit(blk)
        return {r.i: r.probability[1] for r in m.transform(blk.filter("symbol = 'A'")).collect()}

    with_b, with_c = fit(["A", "B"]), fit(["A", "C"])
    assert max(abs(with_b[i] - with_c[i]) for i in with_b) < 1e-4
