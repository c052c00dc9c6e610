"""Ranked rows stay where the sort has put them."""

from ticktale.operators import ranking


def test_ranked_rows_are_not_moved_again(spark):
    scores = spark.createDataFrame([("S", f"w{i:03d}", float(i % 7)) for i in range(300)], "symbol string, word string, chi2 double")
    r = ranking.rank_within(scores, ["symbol"], ["chi2", "word"])
    plan = r._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan          # both joins exchanged the rows before
    got = {x.word: (x._rank, x._n) for x in r.collect()}
    want = sorted((float(i % 7), f"w{i:03d}") for i in range(300))
    assert got == {w: (k + 1, 300) for k, (_, w) in enumerate(want)}
