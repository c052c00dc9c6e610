"""The candidate vocabularies of a news model are scored in one pass over the
terms."""

import math

import pytest
from pyspark.sql import functions as F

from ticktale.operators import compare

SCHEMA_EX = "symbol string, example_id long, label int"
SCHEMA_TERMS = "symbol string, example_id long, word string, cnt long"


def _examples(spark, n=40):
    ex = [("S", i, i % 2) for i in range(n)]
    terms = [("S", i, w, 1 + i % 3) for i in range(n) for w in (f"c{i % 2}", f"x{i % 5}", "all")]
    return ex, terms, spark.createDataFrame(terms, SCHEMA_TERMS)


def test_log_ratio_accuracies_scores_each_vocabulary(spark):
    ex, rows, terms = _examples(spark)
    test = {i for _, i, _ in ex if i < 11}
    label = {i: y for _, i, y in ex}
    split = spark.createDataFrame([(s, i, y, i in test) for s, i, y in ex], SCHEMA_EX + ", is_test boolean")
    vocabs = {"one": {"c0", "x3"}, "two": {"x0", "x1", "all"}, "empty": set()}
    words = sorted({w for _, _, w, _ in rows})
    ups = {w: [sum(c for _, i, v, c in rows if v == w and i not in test and (label[i] == 1) == up) for up in (True, False)] for w in words}
    table = spark.createDataFrame([("S", w, *ups[w], sum(1 << k for k, v in enumerate(vocabs.values()) if w in v)) for w in words],
                                  "symbol string, word string, up long, down long, in_vocab int")
    got = {r.candidate: (r.cand_no, r.n_test, r.test_acc) for r in compare.log_ratio_accuracies(
        split, terms.filter(F.col("example_id") < 11), table, ["symbol"], "example_id", tuple(vocabs)).collect()}
    for k, (name, vocab) in enumerate(vocabs.items()):
        z = {i: sum(c * math.log((ups[w][0] + 1) / (ups[w][1] + 1)) for _, j, w, c in rows if j == i and w in vocab) for i in test}
        acc = 100 * sum((z[i] > 0) == (label[i] == 1) for i in test) / len(test)
        assert got[name][:2] == (k, len(test)) and got[name][2] == pytest.approx(acc)
