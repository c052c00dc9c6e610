"""Saved coefficient tables, the kernel news classifier and the fixtures whose
rows the operators must change."""

import datetime as dt
import math
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from ticktale.operators import news_svm, saved_models as sm
from ticktale.operators.newton import fit_logistic, probability
from ticktale.sources import stores as st

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
COEF = "symbol string, term string, value double"


def test_newest_version_of_each_symbol_is_loaded(spark, tmp_path):
    path = str(tmp_path / "models")
    sm.save_coefficients(spark.createDataFrame([("A", "x", 1.0), ("A", "old", 5.0), ("B", "x", 2.0)], COEF), path, 1)
    sm.save_coefficients(spark.createDataFrame([("A", "x", 3.0)], COEF), path, 2)
    got = {(r.symbol, r.term, r.value, r.version) for r in sm.load_coefficients(spark, path).collect()}
    assert got == {("A", "x", 3.0, 2), ("B", "x", 2.0, 1)}          # no term of A's old model is left
    assert sm.load_coefficients(spark, path, 1).count() == 3
    sm.save_coefficients(spark.createDataFrame([("A", "x", 4.0)], COEF), path, 2)       # the same version again
    assert {r.value for r in sm.load_coefficients(spark, path).where("symbol = 'A'").collect()} == {4.0}
    wanted = spark.createDataFrame([("A",), ("C",), ("C",)], "symbol string")
    assert [r.symbol for r in sm.without_model(wanted, sm.load_coefficients(spark, path)).collect()] == ["C"]


def test_saved_logistic_fit_scores_as_the_fit_itself(spark, tmp_path):
    rows = spark.createDataFrame([(s, float(i), float((i * 7) % 5), float((i * 3 + len(s)) % 2)) for s in ("A", "BB") for i in range(20)],
                                 "key string, u double, v double, t double").withColumn("x", F.array("u", "v"))
    theta = fit_logistic(rows.select("key", "x", "t"), (0.1,))
    path = str(tmp_path / "fit")
    sm.save_coefficients(sm.terms_of(theta, ["u", "v"]), path, 1)
    new = rows.withColumn("symbol", F.col("key"))
    got = sm.score(sm.long_features(new, ["u", "v"], ["symbol", "u"]), sm.load_coefficients(spark, path), ["symbol", "u"])
    want = {(r.key, r.u): r.p for r in probability(rows, theta).collect()}
    out = {(r.symbol, r.u): r.p_up for r in got.collect()}
    assert out.keys() == want.keys() and all(math.isclose(out[k], want[k], rel_tol=1e-12) for k in want)


def test_no_fold_holds_all_dates_of_a_symbol(spark):
    days = [dt.date(2024, 1, d) for d in (2, 9, 16)]
    ex = spark.createDataFrame([("A", d, f"{d}/{o}", o) for d in days for o in (1, 3)] + [("B", days[0], f"b/{o}", o) for o in (1, 3, 5)],
                               "symbol string, pub_date date, example_id string, offset int")
    got = news_svm.folds_of(ex, 5).collect()
    by_date = {(r.symbol, r.pub_date): set() for r in got}
    for r in got:
        by_date[(r.symbol, r.pub_date)].add(r.fold)
    a = [by_date[("A", d)] for d in days]
    assert all(len(f) == 1 for f in a) and len(set().union(*a)) == 3      # a date's examples stay together
    assert len(by_date[("B", days[0])]) == 3                              # a single date: its examples part


def test_count_vectors_hold_counts_at_the_words_places(spark):
    places = news_svm.word_places(spark.createDataFrame([("A", "chip"), ("A", "bank"), ("B", "oil")], "symbol string, word string"))
    keys = spark.createDataFrame([("A", 1), ("A", 2), ("B", 1)], "symbol string, day int")
    counts = spark.createDataFrame([("A", 1, "chip", 4), ("A", 1, "other", 9), ("B", 1, "oil", 2)], "symbol string, day int, word string, cnt long")
    got = {(r.symbol, r.day): (r.w0, r.w1) for r in news_svm.count_vectors(keys, counts, places, 2).collect()}
    assert got == {("A", 1): (0.0, 4.0), ("A", 2): (0.0, 0.0), ("B", 1): (2.0, 0.0)}


def test_keyed_lists_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", "x2", 2), ("a", "x1", 1), ("b", "y", 7), ("a", "x0", 2)], "k string, v string, o int")
    path = str(tmp_path / "lists")
    st.write_keyed_lists(st.keyed_lists(df, "k", "v", "o"), path)
    assert sorted(tuple(r) for r in st.read_keyed_lists(spark, path).collect()) == [("a", 1, "x1"), ("a", 2, "x0"), ("a", 3, "x2"), ("b", 1, "y")]


@needs_data
def test_fixtures_hold_rows_that_the_operators_change(spark):
    q = {n: E.queries()[n](spark, SF) for n in ("stitch_intervals", "link_sections", "publish_date", "vendor_bars_store")}
    per = {(r.symbol, r.source_interval): r["count"] for r in q["stitch_intervals"].groupBy("symbol", "source_interval").count().collect()}
    assert all(per[(s, "360min")] > 1 and per[(s, "60min")] > 1 for s in {s for s, _ in per})
    wanted = {r.wanted: r["count"] for r in q["link_sections"].groupBy("wanted").count().collect()}
    assert wanted[True] > 0 and wanted[False] > 0
    dates = q["publish_date"].collect()
    assert dates and all(r.pub_date for r in dates)
    assert {len(r.raw_date) > 20 for r in dates} == {True, False} and any("." in r.raw_date for r in dates)
    assert q["vendor_bars_store"].where("hour(ts) = 3").count() == 0


@needs_data
def test_saved_models_of_both_versions_score(spark):
    rows = E.queries()["saved_news_models"](spark, "/root/testdata/sf0.01").collect()
    assert {r.version for r in rows if r.p_up is not None} == {1, 2}
    assert any(not r.has_model for r in rows)
