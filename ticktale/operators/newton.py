"""Logistic regression by Newton steps for all keys at once (M5, Platt of M2).

A step is one pass over the rows: every task adds up, per key, the gradient
and the Hessian of its rows (map-side; a key may hold any share of the rows),
and the sums of each key give its next coefficients. The intercept is free, the
other coefficients carry ``lam / (2 n) * |theta|**2`` beside the mean loss. The
driver sees one number a step, the largest gradient entry left.

Keys are (key, lam) pairs, so that several penalties are one fit. Rows are
``key, x`` (array of doubles, no intercept) and ``t``, a target between 0 and 1.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from .kernel_svm import Config, STUDY, fit_svm, score_svm
from .models import feature_columns, model_frame, normalize

THETA = "key string, lam double, n long, theta array<double>, gradient double"
SUMS = "key string, lam double, theta array<double>, n long, g array<double>, h array<double>"


def _sums(batches):
    """Per key and task: rows, gradient and Hessian of the summed loss."""
    total: dict[tuple[str, float], list] = {}
    for b in batches:
        if not b.num_rows:
            continue
        keys = [(k, lam) for k, lam in zip(b.column("key").to_pylist(), b.column("lam").to_pylist())]
        number = {k: i for i, k in enumerate(dict.fromkeys(keys))}
        of = np.fromiter((number[k] for k in keys), np.int64, len(keys))
        x = np.column_stack([np.ones(len(keys)), b.column("x").flatten().to_numpy().reshape(len(keys), -1)])
        t = b.column("t").to_numpy()
        for k, i in number.items():
            at = np.flatnonzero(of == i)
            theta = np.array(b.column("theta")[int(at[0])].as_py())
            xs = x[at]
            p = 1.0 / (1.0 + np.exp(-np.clip(xs @ theta, -500, 500)))
            part = total.setdefault(k, [theta, 0, 0.0, 0.0])
            part[1] += len(at)
            part[2] = part[2] + xs.T @ (p - t[at])
            part[3] = part[3] + (xs * (p * (1 - p))[:, None]).T @ xs
    yield pa.RecordBatch.from_arrays(
        [pa.array([k for k, _ in total], pa.string()), pa.array([lam for _, lam in total], pa.float64()),
         pa.array([v[0] for v in total.values()], pa.list_(pa.float64())), pa.array([v[1] for v in total.values()], pa.int64()),
         pa.array([v[2] for v in total.values()], pa.list_(pa.float64())),
         pa.array([v[3].ravel() for v in total.values()], pa.list_(pa.float64()))],
        names=[c.split()[0] for c in SUMS.split(", ")])


def _step(t: pa.Table) -> pa.Table:
    """The next coefficients of a key from the sums of its tasks; long steps
    are damped. ``gradient`` is that at the coefficients the sums are for."""
    theta = np.array(t.column("theta")[0].as_py())
    lam, n = t.column("lam")[0].as_py(), sum(t.column("n").to_pylist())
    ridge = np.full(len(theta), lam)
    ridge[0] = 0.0
    g = (np.sum(t.column("g").to_pylist(), axis=0) + ridge * theta) / n
    h = np.sum(t.column("h").to_pylist(), axis=0).reshape(len(theta), -1) / n + np.diag(ridge / n)
    step = np.linalg.lstsq(h, g, rcond=1e-13)[0]
    length = float(np.sqrt(max(g @ step, 0.0)))
    theta = theta - step * (1.0 if length < 0.5 else 1.0 / (1.0 + length))
    return pa.Table.from_arrays(
        [t.column("key").slice(0, 1), t.column("lam").slice(0, 1), pa.chunked_array([pa.array([n], pa.int64())]),
         pa.chunked_array([pa.array([theta], pa.list_(pa.float64()))]), pa.chunked_array([pa.array([float(np.abs(g).max())])])],
        names=[c.split()[0] for c in THETA.split(", ")])


def fit_logistic(rows: DataFrame, lambdas: tuple[float, ...] = (0.0,), tol: float = 1e-9, max_iter: int = 50) -> DataFrame:
    """Coefficient table ``key, lam, n, theta`` (intercept first) of stored
    ``rows``."""
    penalty = F.explode(F.array(*[F.lit(float(v)) for v in lambdas])).alias("lam")
    theta = rows.groupBy("key").agg(F.first(F.size("x")).alias("d")).select(
        "key", penalty, F.array_repeat(F.lit(0.0), F.col("d") + 1).alias("theta"))
    for _ in range(max_iter):
        sums = rows.join(theta.select("key", "lam", "theta"), "key").select("key", "lam", "theta", "x", "t").mapInArrow(_sums, SUMS)
        theta = written(sums.groupBy("key", "lam").applyInArrow(_step, THETA), "newton-theta")
        left = theta.agg(F.max("gradient")).first()[0]
        if left is None or left <= tol:
            break
    return theta.select("key", "lam", "n", "theta")


def probability(rows: DataFrame, theta: DataFrame) -> DataFrame:
    """Rows with ``lam`` and ``p``, SQL functions only."""
    z = F.aggregate(F.zip_with("x", F.slice("theta", 2, F.size("x")), lambda a, b: a * b), F.get("theta", F.lit(0)), lambda s, v: s + v)
    return rows.join(theta, "key").withColumn("p", 1 / (1 + F.exp(-z)))


def gradients(rows: DataFrame, theta: DataFrame) -> DataFrame:
    """``key, lam, n, gradient``: the largest entry of the gradient at the
    coefficients, by plain aggregates."""
    p = probability(rows, theta)
    part = p.select("key", "lam", "theta", (F.col("p") - F.col("t")).alias("r"),
                    F.posexplode(F.concat(F.array(F.lit(1.0)), "x")).alias("i", "xi"))
    g = part.groupBy("key", "lam", "i").agg(
        F.count("*").alias("n"), F.sum(F.col("r") * F.col("xi")).alias("g"), F.first(F.get("theta", F.col("i"))).alias("th"))
    g = g.withColumn("g", (F.col("g") + F.when(F.col("i") > 0, F.col("lam") * F.col("th")).otherwise(0.0)) / F.col("n"))
    return g.groupBy("key", "lam").agg(F.max("n").alias("n"), F.max(F.abs("g")).alias("gradient"))


# ---------------------------------------------------------------- jobs
#: The comparison's penalties.
LAMBDAS = (0.0, 1.0, 0.1, 0.01)


def ovr_rows(df: DataFrame, x, label: str, classes: list, prefix: str = "") -> DataFrame:
    """One-vs-rest: a row for each class, target 1 for its own."""
    c = F.explode(F.array(*[F.lit(v) for v in classes])).alias("_c")
    key = F.concat_ws("/", *([F.col(prefix)] if prefix else []), F.col("_c").cast("string"))
    return df.select("*", x.alias("x"), c).withColumn("t", (F.col(label) == F.col("_c")).cast("double")).withColumn("key", key)


def logreg_bars(bars: DataFrame, lambdas: tuple[float, ...] = LAMBDAS):
    """M5 on price features, all symbols and penalties in one fit: (training
    rows, coefficients, all rows)."""
    feats = feature_columns(False)
    df = written(model_frame(bars), "logistic-bars")
    rows = df.withColumn("x", F.array(*[F.col(f).cast("double") for f in feats])).withColumn(
        "t", F.col("label01")).withColumn("key", F.col("symbol"))
    train = written(rows.where("is_train").select("key", "x", "t"), "logistic-rows")
    return train, fit_logistic(train, lambdas), rows


def q_logreg_lambdas(bars: DataFrame) -> DataFrame:
    """M5: the four penalties of the comparison; the gradient at the solution
    must vanish."""
    train, theta, _ = logreg_bars(bars)
    n_up = train.groupBy("key").agg(F.sum("t").cast("long").alias("n_up"))
    return gradients(train, theta).join(n_up, "key").select(
        F.col("key").alias("symbol"), F.col("lam").alias("penalty"), F.col("n").alias("n_train"), "n_up",
        (F.col("gradient") < 1e-7).alias("solved"))


def q_logreg_classes(emb: DataFrame, lam: float = 0.1) -> DataFrame:
    """One-vs-rest on the embedding matrix with a free intercept."""
    df = emb.where("embedding IS NOT NULL AND label IS NOT NULL").select(
        F.col("embedding").cast("array<double>").alias("e"), "label",
        ((F.col("vec_id") * 7919) % 1000 >= 200).alias("is_train"))
    classes = [r["label"] for r in df.select("label").distinct().orderBy("label").collect()]      # a few classes
    train = written(ovr_rows(df.where("is_train"), F.col("e"), "label", classes).select("key", "x", "t"), "logistic-rows")
    theta = fit_logistic(train, (lam,))
    n_own = train.groupBy("key").agg(F.sum("t").cast("long").alias("n_own"))
    return gradients(train, theta).join(n_own, "key").select(
        F.col("key").cast("int").alias("label"), F.col("n").alias("n_train"), "n_own", (F.col("gradient") < 1e-7).alias("solved"))


def out_of_fold(rows: DataFrame, feats: list[str], cfg: Config, folds: int = 5, id_col: str = "bar_date",
                tol: float = 1e-3, fold: str | None = None) -> DataFrame:
    """Training rows with ``score``, the margin of a model that has not seen
    them: fold k's model is trained on the other folds. Column ``fold`` (0 to folds
    - 1) names the row's fold; without it a hash of its id does."""
    configs = tuple(cfg._replace(name=str(k)) for k in range(folds))
    placed = written(rows.where("is_train").withColumn("_fold", (F.col(fold) if fold else F.pmod(F.xxhash64("symbol", id_col), F.lit(folds))).cast("string")),
                     "fold-rows")
    # for fold k's model the rows of fold k are not training rows
    each = placed.drop("is_train").withColumn("_k", F.explode(F.array(*[F.lit(str(k)) for k in range(folds)])))
    each = each.withColumn("symbol", F.concat_ws("\x01", "symbol", "_k")).withColumn("is_train", F.col("_fold") != F.col("_k"))
    one = (cfg._replace(name="fold"),)
    vectors = written(fit_svm(each, feats, one, id_col=id_col, tol=tol), "fold-vectors")
    held = score_svm(each.where("NOT is_train"), vectors, feats, one)
    return held.withColumn("symbol", F.split("symbol", "\x01")[0]).drop("_k", "_fold", "config", "is_train")


def calibrate(margins: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Platt's sigmoid per symbol by Newton steps on (margin, label): smoothed
    targets keep it finite. Returns the fit's rows and its coefficients."""
    n = margins.groupBy("symbol").agg(F.sum((F.col("label") > 0).cast("int")).alias("up"), F.sum((F.col("label") < 0).cast("int")).alias("down"))
    target = F.when(F.col("label") > 0, (F.col("up") + 1) / (F.col("up") + 2)).otherwise(1 / (F.col("down") + 2))
    rows = written(margins.join(n, "symbol").select(F.col("symbol").alias("key"), F.array("score").alias("x"), target.alias("t")),
                   "platt-rows")
    return rows, fit_logistic(rows)


def svm_probability(bars: DataFrame, cfg: Config = STUDY, folds: int = 5):
    """M1 with probabilities: an SVM on all training rows, a sigmoid on
    out-of-fold margins; (rows with p_down, p_up, the sigmoid's rows and fit)."""
    feats = feature_columns(False)
    df = written(normalize(model_frame(bars), feats), "svm-rows")
    rows, theta = calibrate(out_of_fold(df, feats, cfg, folds))
    scored = score_svm(df, written(fit_svm(df, feats, (cfg,)), "svm-vectors"), feats, (cfg,))
    out = probability(scored.withColumn("x", F.array("score")).withColumn("key", F.col("symbol")), theta)
    return out.select("symbol", "bar_date", "label", "is_train", (1 - F.col("p")).alias("p_down"), F.col("p").alias("p_up")), rows, theta


def q_svm_probability(bars: DataFrame) -> DataFrame:
    """Per symbol: the sigmoid's gradient vanishes, every bar has two
    probabilities that sum to one."""
    probs, rows, theta = svm_probability(bars)
    fit = gradients(rows, theta).select(F.col("key").alias("symbol"), F.col("n").alias("n_train"),
                                        (F.col("gradient") < 1e-7).alias("solved"))
    each = probs.groupBy("symbol").agg(
        F.count("*").alias("n"), F.min((F.col("p_up") > 0) & (F.col("p_down") > 0) & (F.abs(F.col("p_up") + F.col("p_down") - 1) < 1e-12)).alias("sums_to_one"))
    return fit.join(each, "symbol")
