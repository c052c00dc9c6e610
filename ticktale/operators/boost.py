"""Weighted decision stumps and AdaBoost.

Rows: training examples ``(symbol, rid, y in {-1,+1}, xs array<double>)``;
every symbol is boosted at once in one grouped job that sorts each feature once
(``adaboost``). ``best_stumps`` and ``boost_round`` are the same search and
round as keyed DataFrame jobs, for one stump over keys of any size.

Stump search per (symbol, feature), rows ordered by value: ``cc`` running
weight of class +1 up to the row, ``after0`` weight of class -1 above it,
``correct = cc + after0``; only the last row of a run of equal values may
hold the threshold; pick the row farthest from half the total weight (first
on ties; distances compared at 1e-12); threshold between the value and the
next one (or value + 1e-4 at the end); polarity = sign(correct - half);
performance = distance + 0.5. The best feature has the highest performance
(first feature on ties). The study's "all one class" branches never fire
(Q24) and are left out; error is clamped to [1e-10, 1 - 1e-10] (Q25); the
vote uses the weighted total of all rounds (Q23), ties -> -1.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import r6
from ..session import written
from .backtest import labelled_bars
from .bars import feature_columns, price_features
from .trees import dealt

FEATURES = ("close", "open", "high", "low", "open_close", "high_low")
QUANT = 1e12
ROUNDS = 10                 # of the queries whose every round the SQL unrolls
STUMPS = ("symbol string, round int, fno int, thresh double, polarity int, perf double, error double, alpha double, "
          "z double")


def stump_rows(bars: DataFrame) -> DataFrame:
    """(symbol, rid, y, is_train, is_test, xs) from labelled bars."""
    lb = price_features(labelled_bars(bars))
    return lb.select("symbol", F.col("rn").cast("long").alias("rid"), F.col("label").alias("y"), "is_train",
                     "is_test", F.array(*[F.col(f) for f in FEATURES]).alias("xs"))


def initial_weights(train: DataFrame) -> DataFrame:
    n = train.groupBy("symbol").agg(F.count("*").alias("_n"))
    return train.join(n, "symbol").select("symbol", "rid", (F.lit(1.0) / F.col("_n")).alias("w"))


def best_stumps(train: DataFrame, weights: DataFrame) -> DataFrame:
    """One stump per symbol: (symbol, fno, thresh, polarity, perf)."""
    long = train.select("symbol", "rid", "y", F.posexplode("xs").alias("fpos", "x")) \
                .withColumn("fno", F.col("fpos") + 1).join(weights, ["symbol", "rid"])
    lab = (F.col("y") == 1).cast("double")
    o = Window.partitionBy("symbol", "fno").orderBy("x", "rid")
    run = o.rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("symbol", "fno")
    d = (long.withColumn("cc", F.sum(lab * F.col("w")).over(run))
             .withColumn("c0", F.sum((1 - lab) * F.col("w")).over(run))
             .withColumn("t1", F.sum(lab * F.col("w")).over(whole))
             .withColumn("t0", F.sum((1 - lab) * F.col("w")).over(whole))
             .withColumn("nx", F.lead("x").over(o))
             .withColumn("pos", F.row_number().over(o)))
    correct = F.col("cc") + (F.col("t0") - F.col("c0"))
    half = (F.col("t1") + F.col("t0")) / 2
    ends_run = F.col("nx").isNull() | (F.col("nx") > F.col("x"))
    d = d.withColumn("nc", F.when(ends_run, F.abs(correct - half)).otherwise(F.lit(0.0))) \
         .withColumn("flag", F.signum(correct - half).cast("int")) \
         .withColumn("thresh", F.when(F.col("nx").isNull(), F.col("x") + F.lit(0.0001))
                     .otherwise(F.lit(0.5) * (F.col("x") + F.col("nx"))))
    # largest quantised distance first, then the earliest position (feature)
    # among equals: the maximum comes from the window that is there already
    q = F.floor(F.col("nc") * F.lit(QUANT) + F.lit(0.5))
    best = d.withColumn("q", q).withColumn("qmax", F.max("q").over(whole)).filter("q = qmax")
    per_feature = best.groupBy("symbol", "fno").agg(
        F.min_by("thresh", "pos").alias("thresh"), F.min_by("flag", "pos").alias("polarity"),
        (F.min_by("nc", "pos") + F.lit(0.5)).alias("perf"))
    pq = F.floor(F.col("perf") * F.lit(QUANT) + F.lit(0.5))
    top = per_feature.withColumn("q", pq).withColumn("qmax", F.max("q").over(Window.partitionBy("symbol")))
    return top.filter("q = qmax").groupBy("symbol").agg(
        F.min("fno").alias("fno"), F.min_by("thresh", "fno").alias("thresh"),
        F.min_by("polarity", "fno").alias("polarity"), F.min_by("perf", "fno").alias("perf"))


def stump_predict(rows: DataFrame, stumps: DataFrame) -> DataFrame:
    """(2 * (x_f < thresh) - 1) * polarity."""
    j = rows.join(stumps, "symbol")
    below = (F.element_at("xs", F.col("fno")) < F.col("thresh")).cast("int")
    return j.withColumn("pred", (2 * below - 1) * F.col("polarity"))


def boost_round(train: DataFrame, weights: DataFrame, rnd: int, cut: bool = True) -> tuple[DataFrame, DataFrame]:
    """One round for all symbols: (stump row with error/alpha/z, new weights).
    With ``cut`` the stump table (the expensive sort) and the new weights are
    checkpointed, so the stump search runs once per round."""
    s = best_stumps(train, weights)
    if cut:
        s = s.checkpoint()
    p = stump_predict(train.join(weights, ["symbol", "rid"]), s)
    wrong = (F.col("pred") != F.col("y")).cast("double")
    e = p.groupBy("symbol").agg((F.sum(wrong * F.col("w")) / F.sum("w")).alias("error"))
    ec = F.least(F.greatest(F.col("error"), F.lit(1e-10)), F.lit(1 - 1e-10))
    e = e.withColumn("alpha", F.lit(0.5) * F.ln((F.lit(1.0) - ec) / ec))
    upd = p.join(e.select("symbol", "alpha"), "symbol").withColumn(
        "w2", F.col("w") * F.exp(-F.col("alpha") * F.col("pred") * F.col("y")))
    z = upd.groupBy("symbol").agg(F.sum("w2").alias("z"))
    new_w = upd.join(z, "symbol").select("symbol", "rid", (F.col("w2") / F.col("z")).alias("w"), "z")
    if cut:
        new_w = new_w.checkpoint()
    zs = new_w.groupBy("symbol").agg(F.first("z").alias("z"))
    out = s.join(e, "symbol").join(zs, "symbol").withColumn("round", F.lit(rnd))
    return out, new_w.drop("z")


def _example_arrays(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Features (rows x features) and labels of the rows of one symbol."""
    xs = t.column("xs").combine_chunks()
    return xs.flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, -1), t.column("y").to_numpy().astype(np.float64)


def _boost_table(t: pa.Table, rounds: int | None) -> pa.Table:
    """All rounds of one symbol. Each feature is sorted once; a round is one
    running sum of ``w * y`` per feature in that order, because ``correct - half``
    of the module's text is that sum plus half the difference of the classes."""
    symbol, every = t.column("symbol")[0].as_py(), t.num_rows
    t = t.filter(t.column("is_train")).sort_by("rid")
    if not t.num_rows:
        return _stump_table(symbol, [])
    x, y = _example_arrays(t)
    n, ix = len(y), np.arange(x.shape[1])
    order = np.argsort(x, axis=0, kind="stable").T
    value = np.take_along_axis(x.T, order, axis=1)
    last = np.concatenate([value[:, 1:] > value[:, :-1], np.ones((len(ix), 1), bool)], axis=1)
    after = np.concatenate([0.5 * (value[:, :-1] + value[:, 1:]), value[:, -1:] + 0.0001], axis=1)
    w, out = np.full(n, 1.0 / n), []
    for r in range(1, (half_of(every) if rounds is None else rounds) + 1):
        wy = w * y
        side = np.cumsum(wy[order], axis=1) - wy.sum() / 2
        far = np.where(last, np.abs(side), 0.0)
        at = np.argmax(np.floor(far * QUANT + 0.5), axis=1)
        perf = far[ix, at] + 0.5
        f = int(np.argmax(np.floor(perf * QUANT + 0.5)))
        thresh, polarity = float(after[f, at[f]]), int(np.sign(side[f, at[f]]))
        pred = np.where(x[:, f] < thresh, polarity, -polarity)
        error = float(w[pred != y].sum() / w.sum())
        clamped = min(max(error, 1e-10), 1 - 1e-10)
        alpha = 0.5 * math.log((1.0 - clamped) / clamped)
        w = w * np.exp(-alpha * pred * y)
        z = float(w.sum())
        w /= z
        out.append((r, f + 1, thresh, polarity, float(perf[f]), error, alpha, z))
    return _stump_table(symbol, out)


def _stump_table(symbol: str, rounds: list[tuple]) -> pa.Table:
    names = [c.split()[0] for c in STUMPS.split(", ")]
    types = [pa.string()] + [pa.int32(), pa.int32(), pa.float64(), pa.int32()] + [pa.float64()] * 4
    columns = zip(*((symbol, *r) for r in rounds)) if rounds else [()] * len(names)
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, types)], names=names)


def half_of(n: int) -> int:
    """The study's number of rounds for n rows (of training and test): n/2, halves away from zero."""
    return (n + 1) // 2


def adaboost(rows: DataFrame, rounds: int | None = None) -> DataFrame:
    """The stump table, one row per (symbol, round), from one grouped job
    over all symbols; ``rounds`` None means half the symbol's rows. A symbol
    without training rows has no stumps. A group holds the bars of one symbol,
    bounded by the calendar."""
    every = dealt(rows.select("symbol", "rid", "y", "is_train", "xs"), "symbol")
    return written(every.groupBy("symbol").applyInArrow(lambda t: _boost_table(t, rounds), STUMPS), "stumps")


def _per_round(rows: DataFrame, stumps: DataFrame, each, more: str) -> DataFrame:
    """``each(x, y, train, stumps of the symbol by round)`` yields the columns
    ``more`` of every round; a symbol's rows meet its stumps once, whatever
    the number of rounds."""
    schema = pa.schema([(c.split()[0], pa.float64() if c.endswith("double") else pa.bool_()) for c in more.split(", ")])

    def run(t: pa.Table, model: pa.Table) -> pa.Table:
        model = model.sort_by("round")
        if not t.num_rows or not model.num_rows:
            return pa.schema([("symbol", pa.string()), ("round", pa.int32()), *schema]).empty_table()
        x, y = _example_arrays(t)
        cols = zip(*each(x, y, t.column("is_train").to_numpy(zero_copy_only=False).astype(bool), model.to_pylist()))
        return pa.Table.from_arrays([model.column("symbol").cast(pa.string()), model.column("round"),
                                     *(pa.array(c, f.type) for c, f in zip(cols, schema))],
                                    names=["symbol", "round", *schema.names])
    left = rows.select("symbol", "y", "is_train", "xs").groupBy("symbol")
    return left.cogroup(stumps.groupBy("symbol")).applyInArrow(run, "symbol string, round int, " + more)


def _curve(x: np.ndarray, y: np.ndarray, train: np.ndarray, stumps: list[dict]):
    score, bound = np.zeros(len(y)), 0.0
    for s in stumps:
        score += s["alpha"] * np.where(x[:, s["fno"] - 1] < s["thresh"], s["polarity"], -s["polarity"])
        bound += math.log(s["z"])
        wrong = np.where(score > 0, 1, -1) != y
        yield tuple(float(wrong[m].mean()) if m.any() else None for m in (train, ~train)) + (math.exp(bound),)


def boosted_errors(rows: DataFrame, stumps: DataFrame) -> DataFrame:
    """Per (symbol, round) train and test error of the vote of
    rounds 1..r (running sum over rounds), and the error bound prod z. ``rows``
    that are not training rows are test rows."""
    return _per_round(rows, stumps, _curve, "train_err double, test_err double, err_bound double")


def _conditions(x: np.ndarray, y: np.ndarray, train: np.ndarray, stumps: list[dict]):
    x, y = x[train], y[train]
    codes = [np.unique(c, return_inverse=True)[1] for c in x.T]
    margin, log_z = np.zeros(len(y)), math.log(len(y))
    for s in stumps:
        w = np.exp(-margin - log_z)
        pred = np.where(x[:, s["fno"] - 1] < s["thresh"], s["polarity"], -s["polarity"])
        error = float(w[pred != y].sum())
        # every cut of every feature, from the weights of its distinct values
        cuts = [np.cumsum(np.bincount(c, w * y)) - (w * y).sum() / 2 for c in codes]
        least = 0.5 - max(float(np.abs(c).max()) for c in cuts)
        margin += s["alpha"] * pred * y
        log_z += math.log(s["z"])
        yield (abs(w.sum() - 1) < 1e-9, abs(error - s["error"]) < 1e-9, error <= least + 1e-9,
               float((margin <= 0).mean()) <= math.exp(log_z - math.log(len(y))) + 1e-9)


def boost_conditions(rows: DataFrame, stumps: DataFrame) -> DataFrame:
    """What holds for every round of a right boosting run, with the weights
    found again from the stump table alone: weights sum to one, the reported
    error is the stump's, no cut of any feature has a smaller one, and the
    product of the z bounds the share of training rows without a positive margin."""
    return _per_round(rows, stumps, _conditions,
                      "weights_sum boolean, error_holds boolean, is_least boolean, bound_holds boolean")


def update_weights(weights: DataFrame, alpha_col: str = "alpha") -> DataFrame:
    """X16/A18 on a frame with w, pred, y, alpha: w exp(-alpha pred y) / Z."""
    w2 = F.col("w") * F.exp(-F.col(alpha_col) * F.col("pred") * F.col("y"))
    return weights.withColumn("w", w2 / F.sum(w2).over(Window.partitionBy("symbol")))


# ---------------------------------------------------------------- query views
def stump_news_gain(bars: DataFrame) -> DataFrame:
    """The experiment on one deterministic model: the best stump per symbol on
    the price features alone and on price plus news, same rows and split.
    ``bars`` carry ``p_down`` and ``p_up``."""
    lb = price_features(labelled_bars(bars))

    def half(name: str, with_news: bool) -> DataFrame:
        xs = F.array(*[F.col(f) for f in feature_columns(with_news)])
        return lb.select(F.concat("symbol", F.lit("|" + name)).alias("symbol"), F.col("rn").cast("long").alias("rid"),
                         F.col("label").alias("y"), "is_train", "is_test", xs.alias("xs"))
    rows = half("price", False).unionByName(half("news", True))
    train = rows.filter("is_train")
    stumps = best_stumps(train, initial_weights(train))
    hit = (F.col("pred") == F.col("y")).cast("double") * 100
    acc = stump_predict(rows.filter("is_test"), stumps).groupBy("symbol").agg(
        F.avg(hit).alias("acc"), F.count("*").alias("n_test"), F.first("fno").alias("fno"), F.first("perf").alias("perf"))
    part = F.split("symbol", r"\|")
    acc = acc.withColumn("half", part[1]).withColumn("symbol", part[0])

    def of(name: str, c: str):
        return F.max(F.when(F.col("half") == name, F.col(c)))
    return acc.groupBy("symbol").agg(
        F.max("n_test").alias("n_test"), of("price", "fno").alias("fno_base"), of("news", "fno").alias("fno_news"),
        of("price", "perf").alias("perf_base"), of("news", "perf").alias("perf_news"),
        of("price", "acc").alias("acc_base"), of("news", "acc").alias("acc_news"))


def q_model_with_news(bars: DataFrame) -> DataFrame:
    g = stump_news_gain(bars)
    return g.select("symbol", "n_test", F.col("fno_base").cast("int").alias("fno_base"),
                    F.col("fno_news").cast("int").alias("fno_news"),
                    *[r6(c).alias(c) for c in ("perf_base", "perf_news", "acc_base", "acc_news")])


def q_best_stump(bars: DataFrame) -> DataFrame:
    train = stump_rows(bars).filter("is_train")
    s = best_stumps(train, initial_weights(train))
    return s.select("symbol", F.col("fno").cast("int").alias("fno"), r6("thresh").alias("thresh"),
                    F.col("polarity").cast("int").alias("polarity"), r6("perf").alias("perf"))


def q_adaboost_round(bars: DataFrame, rounds: int = 2) -> DataFrame:
    s = adaboost(stump_rows(bars), rounds)
    return s.select("symbol", F.col("round").cast("int").alias("round"), F.col("fno").cast("int").alias("fno"),
                    r6("thresh").alias("thresh"), F.col("polarity").cast("int").alias("polarity"),
                    r6("perf").alias("perf"), r6("error").alias("error"), r6("alpha").alias("alpha"),
                    r6("z").alias("z"))


def q_adaboost_full(bars: DataFrame) -> DataFrame:
    """M13 with the study's number of rounds, as the conditions of every round."""
    rows = written(stump_rows(bars), "stump-rows")
    c = boost_conditions(rows, adaboost(rows))
    n = rows.groupBy("symbol").agg(F.count("*").alias("n_rows"))
    return c.join(n, "symbol").select("symbol", "round", "n_rows", "weights_sum", "error_holds", "is_least", "bound_holds")


def q_adaboost(bars: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    rows = written(stump_rows(bars), "stump-rows")
    e = boosted_errors(rows, adaboost(rows, rounds))
    return e.select("symbol", F.col("round").cast("int").alias("round"), r6("train_err").alias("train_err"),
                    r6("test_err").alias("test_err"), r6("err_bound").alias("err_bound"))


def fold_rows(rows: DataFrame, k: int = 5) -> DataFrame:
    """Stratified k folds per symbol (row number within (symbol, label)
    in an arithmetic pseudo-random order, mod k); each (symbol, fold) becomes
    its own boosting key whose test rows are that fold."""
    w = Window.partitionBy("symbol", "y").orderBy((F.col("rid") * 7919) % 1000003, "rid")
    r = rows.withColumn("fold", ((F.row_number().over(w) - 1) % k).cast("int"))
    x = r.select("*", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("f"))
    return x.select(F.concat_ws("|", "symbol", F.col("f").cast("string")).alias("symbol"), "rid", "y",
                    (F.col("fold") != F.col("f")).alias("is_train"), (F.col("fold") == F.col("f")).alias("is_test"),
                    "xs")


def adaboost_cv(rows: DataFrame, k: int = 5, rounds: int | None = None) -> DataFrame:
    """Per symbol and round, the error curves averaged over the k folds;
    ``rounds`` as in ``adaboost``."""
    fr = written(fold_rows(rows, k), "fold-rows")
    e = boosted_errors(fr, adaboost(fr, rounds))
    base = F.element_at(F.split("symbol", r"\|"), 1)
    return e.groupBy(base.alias("symbol"), "round").agg(
        F.avg("train_err").alias("train_err"), F.avg("test_err").alias("test_err"), F.count("*").alias("n_folds"))


def q_adaboost_cv(bars: DataFrame) -> DataFrame:
    e = adaboost_cv(stump_rows(bars), rounds=5)
    return e.select("symbol", F.col("round").cast("int").alias("round"), r6("train_err").alias("train_err"),
                    r6("test_err").alias("test_err"), "n_folds")


def q_adaboost_cv_full(bars: DataFrame, k: int = 5) -> DataFrame:
    """A20 with the study's number of rounds in every fold: per symbol the
    folds, all their rounds, and whether each round meets its conditions."""
    fr = written(fold_rows(stump_rows(bars), k), "fold-rows")
    c = boost_conditions(fr, adaboost(fr))
    part = F.split("symbol", r"\|")
    return c.groupBy(part[0].alias("symbol")).agg(
        F.count_distinct(part[1]).alias("n_folds"), F.count("*").alias("n_rounds"),
        F.min(F.col("weights_sum") & F.col("error_holds") & F.col("is_least") & F.col("bound_holds")).alias("all_hold"))
