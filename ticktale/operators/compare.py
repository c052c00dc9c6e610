"""Classifier comparison and experiment bookkeeping.

* ``kfold``: stratified K-fold ids (row number within the class in a
  seeded/arithmetic order, modulo K);
* ``confusion``: label x prediction counts (pivot) and accuracy = trace/sum;
* ``classifier_summary``: per classifier the best accuracy, the first symbol
  reaching it and the average over symbols;
* ``k_sweep``: one neighbour search serves every k of the sweep;
* ``overall_news_model``: the study's all-symbol model: candidate
  vocabularies (all words, most frequent quarter, five chi-square
  selections), one model each, best test accuracy wins (first candidate on
  ties).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import r6
from ..session import written
from . import knn as kn
from . import select as sl
from .backtest import labelled_bars, rule_signals, summary, backtest, with_strategies
from .news import top_quarter_vocab

K_FOLDS = 5
# Candidate order for ties (O2): the five selections, then the
# most frequent quarter, then all words.
CANDIDATES = ("k_best", "fpr", "fdr", "fwe", "percentile", "chopped", "all")


def kfold(df: DataFrame, order: Column, k: int = K_FOLDS, label: str = "label", id_col: str = "id") -> DataFrame:
    """fold = (rank within the class) mod k; the rank comes from a
    distributed sort, not from one window per class."""
    from .ranking import rank_within
    r = rank_within(df.withColumn("_o", order), [label], ["_o", id_col])
    return r.withColumn("fold", ((F.col("_rank") - 1) % k).cast("int")).drop("_o", "_rank", "_n")


def confusion(pred: DataFrame, classes: list[int], label: str = "label", p: str = "pred") -> DataFrame:
    """One row per true label, one column per predicted class."""
    return pred.groupBy(label).pivot(p, classes).agg(F.count(F.lit(1))).fillna(0)


def confusion_pairs(pred: DataFrame, label: str = "label", p: str = "pred") -> DataFrame:
    """A6 in long form, for any classes: (label, pred, n)."""
    return pred.groupBy(label, p).agg(F.count("*").alias("n"))


def classifier_summary(metrics: DataFrame, acc: str = "test_acc") -> DataFrame:
    """A10: best accuracy, first symbol (by name) reaching it, average."""
    return metrics.groupBy("strategy").agg(
        F.max(acc).alias("best_acc"),
        F.min_by("symbol", F.struct(-F.col(acc), F.col("symbol"))).alias("best_symbol"),
        F.avg(acc).alias("avg_acc"))


def shuffle_key(id_col: str, draw: int) -> Column:
    """Seeded pseudo-random order of integer ids, in plain arithmetic so any
    engine reproduces it: (id * 7919 + draw * 104729) mod 1000003."""
    return (F.col(id_col).cast("long") * 7919 + F.lit(draw * 104729)) % 1000003


SPLIT_BUCKETS = 1024
SHUFFLE_MOD = 1000003


def smallest_fraction(df: DataFrame, keys: list[str], order_key: Column, id_col: str, frac: float,
                      flag: str = "is_test") -> DataFrame:
    """Flag the ceil(frac * n) rows with the smallest (order_key, id) per key
    without one window over a whole key (a key may hold most rows): rows are
    bucketed by order_key (uniform on [0, SHUFFLE_MOD)), bucket counts give
    the boundary bucket per key, and only that bucket is ranked exactly."""
    b = df.withColumn("_ok", order_key).withColumn("_b", (F.col("_ok") * SPLIT_BUCKETS / SHUFFLE_MOD).cast("int"))
    counts = b.groupBy(*keys, "_b").agg(F.count("*").alias("_c"))      # <= SPLIT_BUCKETS rows per key
    w = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    n = counts.groupBy(*keys).agg(F.sum("_c").alias("_n"))
    cum = (counts.withColumn("_before", F.coalesce(F.sum("_c").over(w), F.lit(0)))
                 .join(n, keys).withColumn("_k", F.ceil(F.col("_n") * frac)))
    bnd = cum.filter((F.col("_before") < F.col("_k")) & (F.col("_before") + F.col("_c") >= F.col("_k"))) \
             .select(*keys, F.col("_b").alias("_bb"), (F.col("_k") - F.col("_before")).alias("_need"))
    j = b.join(bnd, keys, "left")
    in_bnd = F.col("_b") == F.col("_bb")
    r = F.row_number().over(Window.partitionBy(*keys, "_b").orderBy("_ok", id_col))   # one bucket per window
    j = j.withColumn("_r", F.when(in_bnd, r))
    is_small = (F.col("_b") < F.col("_bb")) | (in_bnd & (F.col("_r") <= F.col("_need")))
    return j.withColumn(flag, F.coalesce(is_small, F.lit(False))).drop("_ok", "_b", "_bb", "_need", "_r")


def mixed_key(id_col: str, draw: int) -> Column:
    """A seeded order of integer ids that is unrelated from draw to draw
    (the draws of ``shuffle_key`` are rotations of one order)."""
    return F.pmod(F.xxhash64(F.col(id_col).cast("long"), F.lit(draw)), F.lit(SHUFFLE_MOD))


def split_reasons(ex: DataFrame, keys: list[str], test_frac: float = 0.2) -> DataFrame:
    """Per key why no draw can leave two labels in training; null if one can."""
    n_train = F.count("*") - F.ceil(F.count("*") * F.lit(test_frac))
    return ex.groupBy(*keys).agg(F.when(F.count_distinct("label") < 2, "one label")
                                 .when(n_train < 2, "too few rows").alias("reason"))


def random_split(ex: DataFrame, keys: list[str], id_col: str, test_frac: float = 0.2, seed: int = 42,
                 rotations: int = 5) -> DataFrame:
    """Per key, the ceil(test_frac * n) rows first in a seeded order go
    to test. Keys whose training labels would all be equal are drawn again
    with the next draw number until every key that can be split is; draws
    from number ``rotations`` on mix the number into the order. Keys that no
    draw can split (``split_reasons``) are left out. ``id_col`` is unique."""
    can = split_reasons(ex, keys, test_frac).filter("reason is null").select(*keys)
    rows, done, attempt = ex.join(can, keys, "left_semi").checkpoint(), [], 0
    while True:
        order = (shuffle_key if attempt < rotations else mixed_key)(id_col, seed + attempt)
        draw = smallest_fraction(rows, keys, order, id_col, test_frac).withColumn("attempt", F.lit(attempt)).checkpoint()
        failed = (draw.groupBy(*keys).agg(F.count_distinct(F.when(~F.col("is_test"), F.col("label"))).alias("_k"))
                      .filter("_k < 2").select(*keys).checkpoint())
        if failed.isEmpty():
            return reduce(DataFrame.unionByName, [*done, draw])
        done.append(draw.join(failed, keys, "left_anti"))
        rows, attempt = rows.join(failed, keys, "left_semi"), attempt + 1


def log_ratio_accuracies(split_ex: DataFrame, test_terms: DataFrame, words: DataFrame, keys: list[str], id_col: str,
                         candidates: tuple[str, ...] = CANDIDATES) -> DataFrame:
    """Score a log count ratio model on every candidate vocabulary at once.
    ``words`` has the training counts ``up`` and ``down`` of a word and the bits
    ``in_vocab`` of the candidates that hold it (a word weighs the same in all of
    them), so that the test terms meet the words once. Per key and candidate:
    test accuracy (deterministic, used to rank candidates) and rows."""
    names = [f"_z{i}" for i in range(len(candidates))]
    wts = words.select(*keys, "word", "in_vocab", F.ln((F.col("up") + 1.0) / (F.col("down") + 1.0)).alias("wt"))
    z = test_terms.join(wts, keys + ["word"]).groupBy(*keys, id_col).agg(*[
        F.sum(F.when(F.col("in_vocab").bitwiseAND(1 << i) != 0, F.col("cnt") * F.col("wt"))).alias(c) for i, c in enumerate(names)])
    test = split_ex.filter("is_test").join(z, keys + [id_col], "left").fillna(0.0, names)
    acc = test.groupBy(*keys).agg(F.count("*").alias("n_test"), F.array(*[F.struct(
        F.lit(n).alias("candidate"), F.lit(i).alias("cand_no"),
        (F.avg(((F.col(c) > 0) == (F.col("label") == 1)).cast("double")) * 100).alias("test_acc"))
        for i, (n, c) in enumerate(zip(candidates, names))]).alias("_a"))
    return acc.select(*keys, "n_test", F.explode("_a").alias("_a")).select(*keys, "n_test", "_a.*")


def candidate_accuracies(ex: DataFrame, terms: DataFrame, keys: list[str]) -> DataFrame:
    """Per key, the test accuracy of a model on each candidate
    vocabulary (five chi-square selections, most frequent quarter, all words),
    all from one seeded split; empty selections drop out (Q33). Columns:
    keys.., candidate, cand_no, n_words, n_test, test_acc, width.

    The terms are tokenised and meet the split once, training terms are added up
    per word once, and the candidates choose among these words."""
    split = written(random_split(ex, keys, "example_id").select(*keys, "example_id", "label", "is_test"), "split")
    terms = written(terms.join(split, keys + ["example_id"]), "terms")
    counts = written(sl.label_counts(terms.filter(~F.col("is_test")), keys), "label-counts")
    scores = written(sl.scores_of_counts(split.filter(~F.col("is_test")), counts, keys), "scores")
    totals = written(counts.groupBy(*keys, "word").agg(
        F.sum("o").alias("total"), F.sum(F.when(F.col("label") == 1, F.col("o")).otherwise(0)).alias("up"),
        F.sum(F.when(F.col("label") != 1, F.col("o")).otherwise(0)).alias("down")), "totals")
    vocabs = {m: (sl.select_fpr(scores) if m == "fpr" else sl.SELECTORS[m](scores, keys=keys))
              for m in ("k_best", "fpr", "fdr", "fwe", "percentile")}
    vocabs["chopped"] = top_quarter_vocab(totals.select(*keys, "word", "total"), keys=tuple(keys))
    vocabs["all"] = totals
    chosen = reduce(DataFrame.unionByName, [vocabs[name].select(*keys, "word", F.lit(1 << i).alias("in_vocab"))
                                            for i, name in enumerate(CANDIDATES)])
    bits = chosen.groupBy(*keys, "word").agg(F.bit_or("in_vocab").alias("in_vocab"))
    words = written(totals.select(*keys, "word", "up", "down").join(bits, keys + ["word"]), "words")
    acc = log_ratio_accuracies(split, terms.filter("is_test"), words, keys, "example_id")
    held = words.groupBy(*keys).agg(F.count("*").alias("width"), F.array(*[
        F.count(F.when(F.col("in_vocab").bitwiseAND(1 << i) != 0, 1)) for i in range(len(CANDIDATES))]).alias("_n"))
    res = acc.join(held, keys).withColumn("n_words", F.element_at("_n", F.col("cand_no") + 1)).filter("n_words > 0")
    return written(res.select(*keys, "candidate", "cand_no", "n_words", "n_test", "test_acc", "width"), "candidates")


def not_split(ex: DataFrame, keys: list[str]) -> DataFrame:
    """A row for every key that no draw can split; the reason is the candidate."""
    return split_reasons(ex, keys).filter("reason is not null").select(
        *keys, F.concat(F.lit("none: "), "reason").alias("candidate"), F.lit(0).cast("long").alias("n_words"),
        F.lit(0).cast("long").alias("n_test"))


def overall_news_model(ex: DataFrame, terms: DataFrame) -> DataFrame:
    """Every candidate vocabulary without the symbol key, ranked
    (accuracy desc, candidate order). If no draw can split the examples: one
    row whose candidate is ``none:`` and the reason."""
    keys = ["scope"]
    ex = ex.withColumn("scope", F.lit("overall"))
    res = candidate_accuracies(ex, terms.withColumn("scope", F.lit("overall")), keys)
    w = Window.partitionBy("scope").orderBy(F.desc("test_acc"), "cand_no")
    res = res.withColumn("rank", F.row_number().over(w).cast("long"))
    return res.unionByName(not_split(ex, keys), allowMissingColumns=True)


def symbol_news_models(ex: DataFrame, terms: DataFrame, wide: int = sl.WIDE_VOCAB, min_acc: float = 30.0) -> DataFrame:
    """Per symbol (M14, F19, F20, O2): a vocabulary wider than ``wide`` words
    goes through selection and the best selection is kept; a narrow one is
    fitted on all words. A wide symbol whose best selection scores below
    ``min_acc`` gets a second try on all words; a model still below it is
    rejected. One row per symbol; one that no draw can split has the candidate
    ``none:`` and the reason, and is not accepted."""
    keys = ["symbol"]
    res = candidate_accuracies(ex, terms, keys)
    sel = res.filter(F.col("candidate").isin("k_best", "fpr", "fdr", "fwe", "percentile"))
    w = Window.partitionBy(*keys).orderBy(F.desc("test_acc"), "cand_no")
    best_sel = sel.withColumn("_r", F.row_number().over(w)).filter("_r = 1").select(
        *keys, F.col("candidate").alias("sel_candidate"), F.col("test_acc").alias("sel_acc"),
        F.col("n_words").alias("sel_words"))
    all_words = res.filter(F.col("candidate") == "all").select(
        *keys, "width", "n_test", F.col("test_acc").alias("all_acc"))
    j = all_words.join(best_sel, keys, "left")
    is_wide = F.col("width") > wide
    use_sel = is_wide & F.col("sel_acc").isNotNull() & (F.col("sel_acc") >= min_acc)
    out = j.select(*keys, "width", "n_test",
                   F.when(use_sel, F.col("sel_candidate")).otherwise(F.lit("all")).alias("candidate"),
                   F.when(use_sel, F.col("sel_words")).otherwise(F.col("width")).alias("n_words"),
                   F.when(use_sel, F.col("sel_acc")).otherwise(F.col("all_acc")).alias("test_acc"),
                   (is_wide & ~use_sel).alias("second_try"))
    out = out.withColumn("accepted", F.col("test_acc") >= min_acc)
    none = not_split(ex, keys).withColumn("second_try", F.lit(False)).withColumn("accepted", F.lit(False))
    return out.unionByName(none, allowMissingColumns=True)


# ---------------------------------------------------------------- query views
def q_kfold_assignment(emb: DataFrame) -> DataFrame:
    e = emb.select(F.col("vec_id").alias("id"), "label")
    f = kfold(e, (F.col("id") * 7919) % 1000)
    return f.select(F.col("id").alias("vec_id"), "label", "fold")


def _knn_pred(emb: DataFrame, k: int = kn.K) -> DataFrame:
    train, test = kn.split_embeddings(emb)
    v = kn.vote(kn.knn_neighbours(train, test, k))
    return test.select(F.col("id").alias("test_id"), "label").join(v, "test_id")


def q_confusion_matrix(emb: DataFrame) -> DataFrame:
    return confusion_pairs(_knn_pred(emb))


def q_classifier_summary(bars: DataFrame) -> DataFrame:
    s = summary(backtest(with_strategies(labelled_bars(bars), rule_signals())))
    c = classifier_summary(s)
    return c.select("strategy", r6("best_acc").alias("best_acc"), "best_symbol", r6("avg_acc").alias("avg_acc"))


def q_config_sweep(emb: DataFrame, ks=(1, 3, 5, 7)) -> DataFrame:
    """Accuracy of KNN for each k, from one search for max(k)."""
    train, test = kn.split_embeddings(emb)
    nb = kn.knn_neighbours(train, test, max(ks))
    nb = nb.withColumn("_r", F.row_number().over(Window.partitionBy("test_id").orderBy("sqd", "train_id")))
    per_k = nb.select("*", F.explode(F.array(*[F.lit(k) for k in ks])).alias("k")).filter(F.col("_r") <= F.col("k"))
    votes = per_k.groupBy("k", "test_id", "label").agg(F.count("*").alias("votes"))
    w = Window.partitionBy("k", "test_id").orderBy(F.desc("votes"), "label")
    pred = votes.withColumn("_x", F.row_number().over(w)).filter("_x = 1").select("k", "test_id",
                                                                                  F.col("label").alias("pred"))
    truth = test.select(F.col("id").alias("test_id"), "label")
    j = pred.join(truth, "test_id")
    return j.groupBy("k").agg(F.count("*").alias("n_test"),
                              r6(F.avg((F.col("pred") == F.col("label")).cast("double")) * 100).alias("accuracy"))


def q_symbol_news_models(docs: DataFrame, labels: DataFrame) -> DataFrame:
    ex, terms = sl.labelled_docs(docs, labels)
    r = symbol_news_models(ex, terms)
    return r.select("symbol", "width", "n_test", "candidate", "n_words", r6("test_acc").alias("test_acc"),
                    "second_try", "accepted")


def q_overall_news_model(docs: DataFrame, labels: DataFrame) -> DataFrame:
    ex, terms = sl.labelled_docs(docs, labels)
    r = overall_news_model(ex.drop("symbol"), terms.drop("symbol"))
    return r.select("candidate", "cand_no", "n_words", "n_test", r6("test_acc").alias("test_acc"), "rank")
