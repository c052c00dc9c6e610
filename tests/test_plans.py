"""Plan-shape guards: the scale properties the design relies on."""

import os

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def _plan(spark, name):
    df = E.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_aqe(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_summary_job_has_one_exchange_and_hash_aggregates(no_aqe):
    p = _plan(no_aqe, "extractive_summary")
    assert p.count("Exchange") == 1
    assert "SortAggregate" not in p


def test_lineitem_bars_hash_aggregate_and_pruned_scan(no_aqe):
    p = _plan(no_aqe, "daily_bars")
    assert "SortAggregate" not in p
    scan = [line for line in p.splitlines() if "lineitem.parquet" in line][0]
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint" in scan
    assert not any(c in scan for c in ("l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_suppkey"))


def test_keyword_ranking_does_not_shuffle(no_aqe):
    p = _plan(no_aqe, "textrank_keywords")
    assert "MapInPandas" in p and p.count("Exchange") == 0


def test_top_k_windows_limit_before_the_shuffle(no_aqe):
    p = _plan(no_aqe, "knn_classify")
    assert "WindowGroupLimit" in p


def test_weekday_filter_reaches_the_events_scan(no_aqe):
    p = _plan(no_aqe, "cut_at_first_article")
    scans = [line for line in p.splitlines() if "events.parquet" in line]
    assert scans and all("weekday" in s for s in scans)


@pytest.mark.parametrize("name", [n for n in sorted(E.queries())
                                  if n not in ("incremental_articles", "classifier_comparison", "network_comparison")])
def test_no_cartesian_product(spark, name):
    assert "CartesianProduct" not in _plan(spark, name)
