import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from ticktale.functions.text import sanitize, substring_count
from ticktale.operators import stitch, text
from ticktale.sources import fixtures as fx

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def _series(spark, stamps, tag):
    rows = [("S", dt.datetime(2024, 1, 2, int(s[:2]), int(s[3:])), float(i), tag) for i, s in enumerate(stamps)]
    return spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, close double, tag string")


def test_stitch_rule(spark):
    coarse = _series(spark, ["09:00", "09:30", "10:00", "10:30"], "c")
    fine = _series(spark, ["10:00", "10:15", "10:30"], "f")
    out = stitch.stitch(coarse, fine, "15min", coarse_interval="30min").orderBy("ts").collect()
    assert [(r.ts.strftime("%H:%M"), r.tag) for r in out] == [
        ("09:00", "c"), ("09:30", "c"), ("10:00", "c"), ("10:15", "f"), ("10:30", "f")]


def test_stitch_without_shared_stamp_keeps_coarse(spark):
    out = stitch.stitch(_series(spark, ["09:00"], "c"), _series(spark, ["09:10"], "f"), "5min").collect()
    assert [r.tag for r in out] == ["c"]


@needs_data
def test_stitched_query_holds_the_whole_fine_series(spark):
    fine = fx.event_bars_h(spark, SF)
    out = E.queries()["stitch_intervals"](spark, SF).filter("source_interval = '60min'").select("symbol", "ts")
    left = {(r.symbol, r.ts) for r in fine.select("symbol", "ts").subtract(out).collect()}
    assert left == {(r.symbol, r.ts) for r in fine.groupBy("symbol").agg(F.min("ts").alias("ts")).collect()}


def test_sanitize_and_substring_count(spark):
    df = spark.createDataFrame([("a\tb\nc\rd\fe",)], "t string")
    assert df.select(sanitize("t").alias("x")).collect()[0].x == "a b cd e"
    df = spark.createDataFrame([("Nvidia chip chips chipset", "nvidia"), ("Nvidia chip chips chipset", "chip"),
                                ("Nvidia chip chips chipset", ""), ("aaaa", "aa")], "t string, w string")
    assert [r.c for r in df.select(substring_count("t", "w").alias("c")).collect()] == [0, 3, 26, 2]


def test_summary_drops_stop_word_sentence_and_keeps_order(spark):
    docs = spark.createDataFrame([(1, "Markets rallied today. It was what it is. Markets fell later.")],
                                 "doc_id long, text string")
    out = text.summaries(docs).collect()[0]
    assert out.summary == "Markets rallied today. Markets fell later."
    assert out.n_sentences == 2
    top1 = text.summaries(docs, n=1).collect()[0]
    assert top1.n_sentences == 1


def test_word_freq_counts_kept_words(spark):
    docs = spark.createDataFrame([(1, "The chip. The chip and the board.")], "doc_id long, text string")
    wf = {r.word: r.freq for r in text.word_freq(text.sentence_tokens(text.sentences(docs))).collect()}
    assert wf == {"chip": 2, "board": 1}
