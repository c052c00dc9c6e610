"""Training and scoring jobs.

Two fitting strategies:

* **Linear family** (logistic regression, linear SVM, and kernel SVMs as
  linear SVMs on explicit feature maps): one MLlib fit for *all* symbols.
  Each symbol gets its own coefficient block (``Interaction`` of the one-hot
  symbol with the feature vector, plus a per-symbol bias column). The study's
  objectives are sums over rows plus an L2 term (C-SVC ``C*sum hinge +
  |w|^2/2``; regularised LR ``sum loss + lambda/2 |theta|^2``), so the joint
  objective splits exactly into the per-symbol ones with
  ``regParam = 1 / (C * N)`` resp. ``lambda / N`` on the mean loss. The
  per-symbol bias is a column (scaled by ``BIAS``), hence lightly
  regularised, unlike the study's free intercept.
* **Trees, networks, kernel machines** (``trees.py``, ``networks.py``,
  ``kernel_svm.py``): one job for all symbols, models as tables.

The labelled frame is checkpointed once (reliable checkpoint in the session's
checkpoint directory) so fits never recompute the bar pipeline.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.classification import LinearSVC, LogisticRegression, OneVsRest
from pyspark.ml.feature import Interaction, OneHotEncoder, StringIndexer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import kernels as K
from ..functions.numeric import r6
from ..session import written
from . import trees as T
from .backtest import labelled_bars, summary
from .bars import feature_columns, price_features

BIAS = 10.0
EPS = 1e-7
SEED = 11


ROWS_PER_PARTITION = 200_000


def right_size(df: DataFrame, rows: int) -> DataFrame:
    """Iterative fits launch one task per partition per iteration: keep about
    ROWS_PER_PARTITION rows per partition (never more partitions than now)."""
    import math
    want = max(1, math.ceil(rows / ROWS_PER_PARTITION))
    return df.coalesce(want) if want < df.rdd.getNumPartitions() else df


# ---------------------------------------------------------------- frames
def model_frame(bars: DataFrame, with_news: bool = False) -> DataFrame:
    """Labelled bars with price features (F1-F4, W5), label01 for MLlib."""
    lb = price_features(labelled_bars(bars))
    cols = ["symbol", "bar_date", "close", "ret", "label", "is_train", "is_test"] + feature_columns(with_news)
    return lb.select(*cols).withColumn("label01", ((F.col("label") + 1) / 2).cast("double"))


def normalize(df: DataFrame, feats: list[str], keys=("symbol",)) -> DataFrame:
    """(x - mean) / (std + 1e-7) with mean/std of the training rows
    of the key; the statistics are one row per key, joined back."""
    stats = df.filter("is_train").groupBy(*keys).agg(
        *[F.avg(f).alias(f"_mu_{f}") for f in feats], *[F.stddev_samp(f).alias(f"_sd_{f}") for f in feats])
    out = df.join(stats, list(keys), "left")
    for f in feats:
        out = out.withColumn(f, (F.col(f) - F.col(f"_mu_{f}")) / (F.coalesce(F.col(f"_sd_{f}"), F.lit(0.0)) + EPS))
    return out.drop(*[c for c in out.columns if c.startswith("_mu_") or c.startswith("_sd_")])


def _vector_with_attrs(arr: Column, size: int, name: str) -> Column:
    """array<double> -> ML vector carrying numeric attribute metadata (which
    ``Interaction`` needs), without one column per element."""
    meta = {"ml_attr": {"attrs": {"numeric": [{"idx": i, "name": f"{name}{i}"} for i in range(size)]},
                        "num_attrs": size}}
    return array_to_vector(arr).alias(name, metadata=meta)


def with_block_features(df: DataFrame, mapped, out: str = "features", fitted=None, size: int | None = None):
    """Per-symbol coefficient blocks: one-hot(symbol) x [mapped..., BIAS].
    ``mapped`` is a list of columns or one array column of length ``size``.
    Returns (frame, fitted stages); pass ``fitted`` to encode other rows with
    the same symbol indices."""
    if isinstance(mapped, Column):
        arr, n = F.concat(mapped, F.array(F.lit(BIAS))), size + 1
    else:
        arr, n = F.array(*mapped, F.lit(BIAS)), len(mapped) + 1
    vec = df.select("*", _vector_with_attrs(arr, n, "_m"))
    if fitted is None:
        fitted = Pipeline(stages=[
            StringIndexer(inputCol="symbol", outputCol="_sym_idx", stringOrderType="alphabetAsc"),
            OneHotEncoder(inputCol="_sym_idx", outputCol="_sym_vec", dropLast=False),
            Interaction(inputCols=["_sym_vec", "_m"], outputCol=out),
        ]).fit(vec)
    return fitted.transform(vec).drop("_m", "_sym_idx", "_sym_vec"), fitted


def signal_from_prediction(df: DataFrame, pred: str = "prediction") -> DataFrame:
    return df.withColumn("signal", (F.col(pred) * 2 - 1).cast("int"))


def backtest_summary(pred: DataFrame, model: str) -> DataFrame:
    """Per symbol train/test accuracy and sharpe of the model's signals."""
    from .backtest import backtest
    s = summary(backtest(pred.withColumn("strategy", F.lit(model))))
    return s.select("symbol", "strategy", "n_train", "n_test", r6("train_acc").alias("train_acc"),
                    r6("test_acc").alias("test_acc"), r6("sharpe").alias("sharpe"))


# ---------------------------------------------------------------- linear family
def fit_linear_svm(df: DataFrame, c: float, features: str = "features", max_iter: int = 50):
    """C-SVC objective on all symbols at once (see module doc)."""
    train = df.filter("is_train")
    n = train.count()
    svc = LinearSVC(featuresCol=features, labelCol="label01", fitIntercept=False, standardization=False,
                    regParam=1.0 / (c * max(n, 1)), maxIter=max_iter)
    return svc.fit(right_size(train, n))


def svm_on_map(bars: DataFrame, kind: str, c: float = 20.0, gamma: float = 0.2, with_news: bool = False,
               n_components: int = 300, n_landmarks: int = 50) -> DataFrame:
    """Linear / polynomial / RBF (random features) / sigmoid (landmarks) SVM
    per symbol on normalised price features; predictions for every row."""
    feats = feature_columns(with_news)
    df = normalize(model_frame(bars, with_news), feats).checkpoint()
    xs = [F.col(f) for f in feats]
    if kind == "linear":
        mapped = xs
    elif kind == "poly":
        mapped = K.poly3_features(xs, gamma)
    elif kind == "rbf":
        mapped = K.rff_features(xs, gamma, n_components)
    elif kind == "sigmoid":
        # bounded landmark set: the n_landmarks training rows of smallest hash
        lm = (df.filter("is_train").orderBy(F.xxhash64("symbol", "bar_date"))
                .limit(n_landmarks).select(*feats).collect())
        mapped = K.sigmoid_landmark_features(xs, [[float(v) for v in r] for r in lm], gamma)
    else:
        raise ValueError(kind)
    size = n_components if kind == "rbf" else None
    blk = with_block_features(df, mapped, size=size)[0].checkpoint()
    model = fit_linear_svm(blk, c)
    return signal_from_prediction(model.transform(blk))


def logreg_bars(bars: DataFrame, lam: float, max_iter: int = 50) -> DataFrame:
    """M5 per symbol: regularised logistic regression (sum loss + lambda/2
    |theta|^2 per symbol) as one block-diagonal fit, regParam = lambda / N;
    raw price features (Q28)."""
    feats = feature_columns(False)
    df = model_frame(bars)
    blk = with_block_features(df, [F.col(f) for f in feats])[0].checkpoint()
    n = blk.filter("is_train").count()
    lr = LogisticRegression(labelCol="label01", fitIntercept=False, standardization=False,
                            regParam=lam / max(n, 1), elasticNetParam=0.0, maxIter=max_iter)
    return signal_from_prediction(lr.fit(right_size(blk.filter("is_train"), n)).transform(blk))


# The comparison's classifier configurations.
COMPARISON = (("LR_lambda=0", "lr", 0.0), ("LR_lambda=1", "lr", 1.0), ("LR_lambda=0.1", "lr", 0.1),
              ("LR_lambda=0.01", "lr", 0.01), ("SVM-Linear", "svm_linear", 1.0), ("SVM-Poly", "svm_poly", 1.0),
              ("ClassificationTree", "tree", None))


def classifier_comparison(bars: DataFrame, configs=COMPARISON) -> DataFrame:
    """Every configuration on every symbol; the per-symbol run metrics
    of all configurations appended into one table (strategy = config name).
    Each configuration is one fit for all symbols."""
    runs = []
    for name, kind, p in configs:
        if kind == "lr":
            pred = logreg_bars(bars, p)
        elif kind == "svm_linear":
            pred = svm_on_map(bars, "linear", c=p)
        elif kind == "svm_poly":
            pred = svm_on_map(bars, "poly", c=p, gamma=0.5)
        else:
            pred = tree_model(bars, max_depth=p)
        runs.append(backtest_summary(pred, name))
    return reduce(DataFrame.unionByName, runs)


def logreg_embeddings(emb: DataFrame, lam: float = 0.1, max_iter: int = 50, test_mod: int = 5) -> DataFrame:
    """One-vs-rest regularised logistic regression on the embedding
    matrix (10 classes), ``regParam = lambda / n``; the split is by a hash of
    the id (arithmetic, so it is reproducible anywhere)."""
    df = emb.select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"),
                    F.col("label").cast("double").alias("label"),
                    ((F.col("vec_id") * 7919) % 1000 >= 1000 // test_mod).alias("is_train")).checkpoint()
    train = df.filter("is_train")
    n = train.count()
    lr = LogisticRegression(regParam=lam / max(n, 1), elasticNetParam=0.0, standardization=False,
                            maxIter=max_iter)
    model = OneVsRest(classifier=lr, parallelism=4).fit(train)
    return model.transform(df)


def class_count(df: DataFrame, label: str = "label", keys=()) -> DataFrame:
    """The classes and their number (per key)."""
    return df.groupBy(*keys).agg(F.sort_array(F.collect_set(label)).alias("classes"),
                                 F.count_distinct(label).alias("n_classes"))


def one_hot_targets(df: DataFrame, label: str = "label", out: str = "target") -> DataFrame:
    """F8: one-hot target vectors over all classes (no dropped last)."""
    idx = StringIndexer(inputCol=label, outputCol="_lab_idx", stringOrderType="alphabetAsc").fit(df)
    enc = OneHotEncoder(inputCol="_lab_idx", outputCol=out, dropLast=False)
    t = idx.transform(df)
    return enc.fit(t).transform(t).drop("_lab_idx")


# ---------------------------------------------------------------- trees
def tree_model(bars: DataFrame, max_depth: int | None = None) -> DataFrame:
    """One classification tree per symbol, grown fully by default."""
    feats = feature_columns(False)
    df = written(model_frame(bars), "tree-rows")
    return T.sign_of_score(T.score_trees(df, T.fit_trees(df, feats, max_depth=max_depth), feats))


def bagged_trees(bars: DataFrame, n_trees: int = 10, max_depth: int | None = None) -> DataFrame:
    """Bagging of full-feature trees, min leaf 1; the trees' mean labels
    in a row's leaves are added up."""
    feats = feature_columns(False)
    df = written(model_frame(bars), "tree-rows")
    drawn = (df.where("is_train").withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(n_trees - 1))))
             .withColumn("weight", T.bootstrap_weight(F.col("tree"), "symbol", "bar_date")).where("weight > 0"))
    nodes = T.fit_trees(drawn, feats, weight="weight", max_depth=max_depth)
    return T.sign_of_score(T.score_trees(df, nodes, feats))


def ls_boost(bars: DataFrame, n_trees: int = 10, rate: float = 0.0245, max_depth: int | None = None) -> DataFrame:
    """Least-squares boosting on the -1/+1 label; sign of the fit."""
    feats = feature_columns(False)
    df = written(model_frame(bars), "tree-rows")
    return T.sign_of_score(T.score_trees(df, T.fit_boosted(df, feats, n_trees=n_trees, rate=rate, max_depth=max_depth), feats))


# ---------------------------------------------------------------- literal-weight scorers
# Illustrative weights for the literal-weight scorers (no
# trained weights exist in the study's tree).
SIGMOID_THETA = (0.1, -0.05, 0.02)
THETA1 = ((0.5, -0.02, 0.01), (-0.3, 0.015, -0.02), (0.1, 0.01, 0.03))
THETA2 = ((0.2, -0.4, 0.3, 0.1), (-0.1, 0.5, -0.2, 0.2))


def sigmoid_score(bars: DataFrame, theta=SIGMOID_THETA) -> DataFrame:
    """p = sigmoid(theta . [1, open_close, high_low])."""
    f = price_features(bars)
    z = F.lit(theta[0]) + F.lit(theta[1]) * F.col("open_close") + F.lit(theta[2]) * F.col("high_low")
    p = K.sigmoid(z)
    return f.select("symbol", "bar_date", r6(p).alias("p"), F.when(p >= 0.5, 1).otherwise(-1).alias("pred"))


def mlp_forward(bars: DataFrame, theta1=THETA1, theta2=THETA2) -> DataFrame:
    """Forward pass of a 2-layer sigmoid network with bias units;
    predicted class = position of the largest output (1-based)."""
    f = price_features(bars)
    a1 = [F.lit(1.0), F.col("open_close"), F.col("high_low")]
    hid = [K.sigmoid(K.dot(a1, row)) for row in theta1]
    a2 = [F.lit(1.0)] + hid
    outs = [K.sigmoid(K.dot(a2, row)) for row in theta2]
    o = f.select("symbol", "bar_date", F.array(*outs).alias("_o"))
    return o.select("symbol", "bar_date", r6(F.col("_o")[0]).alias("h1"), r6(F.col("_o")[1]).alias("h2"),
                    F.array_position("_o", F.array_max("_o")).alias("pred_class"))


# ---------------------------------------------------------------- query views
def q_svm(kind: str, **kw):
    return lambda bars: backtest_summary(svm_on_map(bars, kind, **kw), f"svm_{kind}")


def q_logreg_ovr(emb: DataFrame) -> DataFrame:
    p = logreg_embeddings(emb)
    hit = (F.col("prediction") == F.col("label")).cast("double")
    return p.groupBy(F.when(F.col("is_train"), "train").otherwise("test").alias("split")).agg(
        F.count("*").alias("n"), F.count_distinct("label").alias("n_classes"),
        r6(F.avg(hit) * 100).alias("accuracy"))


def q_classifier_comparison(bars: DataFrame) -> DataFrame:
    from .compare import classifier_summary
    metrics = classifier_comparison(bars).checkpoint()
    c = classifier_summary(metrics)
    return c.select(F.col("strategy").alias("classifier"), r6("best_acc").alias("best_acc"), "best_symbol",
                    r6("avg_acc").alias("avg_acc"))


def q_tree(bars: DataFrame) -> DataFrame:
    return backtest_summary(tree_model(bars), "tree")


def q_bagged_trees(bars: DataFrame) -> DataFrame:
    return backtest_summary(bagged_trees(bars), "bagged_trees")


def q_ls_boost(bars: DataFrame) -> DataFrame:
    return backtest_summary(ls_boost(bars), "ls_boost")


def q_sigmoid_score(bars: DataFrame) -> DataFrame:
    return sigmoid_score(bars)


def q_mlp_forward(bars: DataFrame) -> DataFrame:
    return mlp_forward(bars)
