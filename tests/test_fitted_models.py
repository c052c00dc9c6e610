"""Trees, kernel SVMs, logistic regression and networks on small data against
plain versions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticktale.operators import kernel_svm as ks
from ticktale.operators import newton as nt
from ticktale.operators import trees as tr


def plain_tree(x, y, w, rows, min_parent, depth=None):
    """Leaf of each row as a path, by recursion."""
    total, s = w[rows].sum(), (w * y)[rows].sum()
    best = (0.0, None, None)
    if total >= min_parent and (depth is None or depth > 0):
        for f in range(x.shape[1]):
            values = np.unique(x[rows][w[rows] > 0, f])
            for a, b in zip(values, values[1:]):
                left = rows[x[rows, f] <= a]
                wl, sl = w[left].sum(), (w * y)[left].sum()
                gain = (sl * (total - wl) - (s - sl) * wl) ** 2 / (wl * (total - wl) * total)
                if gain > best[0]:
                    best = (gain, f, (a + b) / 2)
    if best[1] is None:
        return {int(r): (s / total) for r in rows}
    left = x[rows, best[1]] < best[2]
    down = None if depth is None else depth - 1
    return {**plain_tree(x, y, w, rows[left], min_parent, down), **plain_tree(x, y, w, rows[~left], min_parent, down)}


@pytest.mark.parametrize("weights,depth,values", [(False, None, 40), (True, None, 7), (True, 3, 1000)])
def test_grown_tree_equals_plain_recursion(weights, depth, values):
    r = np.random.default_rng(values)
    n = 200
    x = r.integers(0, values, (n, 3)).astype(float)
    y = np.where(r.random(n) < 0.3 + 0.4 * (x[:, 0] > values / 2), 1.0, -1.0)
    w = r.integers(1, 4, n).astype(float) if weights else np.ones(n)
    nodes, at = tr.grow(x, y, w, 10, depth)
    want = plain_tree(x, y, w, np.arange(n), 10, depth)
    assert all(abs(nodes[a].sum / nodes[a].weight - want[i]) < 1e-12 for i, a in enumerate(at))
    assert depth is None or max(m.depth for m in nodes) == depth


def test_rows_of_weight_zero_and_neighbouring_values():
    low = 1.0
    high = np.nextafter(low, 2.0)
    x = np.array([[low], [high]] * 6)
    nodes, at = tr.grow(x, np.array([-1.0, 1.0] * 6), np.ones(12), 10)
    assert len(nodes) == 3 and len(set(at[::2])) == 1 and at[0] != at[1]
    nodes, _ = tr.grow(x, np.array([-1.0, 1.0] * 6), np.array([1.0, 0.0] * 6), 2)
    assert len(nodes) == 1


def bars(spark, symbols=("a", "b"), n=120, seed=1):
    r = np.random.default_rng(seed)
    rows = []
    for s in symbols:
        for i in range(n):
            x1, x2 = r.normal(size=2)
            rows.append((s, i, float(x1), float(x2), 1 if x1 * x2 + 0.3 * r.normal() > 0 else -1, i < 0.8 * n))
    rows += [("one", i, float(i), 1.0, 1, i < 10) for i in range(12)]
    return spark.createDataFrame(rows, "symbol string, bar_date int, x1 double, x2 double, label int, is_train boolean")


FEATS = ["x1", "x2"]


def test_tree_models_are_tables_that_score(spark, tmp_path):
    df = bars(spark)
    nodes = tr.fit_trees(df, FEATS, min_parent=2)
    nodes.write.parquet(str(tmp_path / "model"))
    got = tr.sign_of_score(tr.score_trees(df, spark.read.parquet(str(tmp_path / "model")), FEATS))
    train = got.where("is_train")
    assert train.where("signal != label").count() == 0          # grown until every leaf is pure
    assert got.where("not is_train and signal = label").count() > 0.7 * got.where("not is_train").count()
    other = bars(spark, ("unknown",)).where("symbol = 'unknown'")
    assert tr.score_trees(other, nodes, FEATS).where("score IS NOT NULL").count() == 0
    assert nodes.where("symbol = 'one'").count() == 1


def test_boosting_follows_the_residual(spark):
    df = bars(spark)
    one, ten = (tr.score_trees(df, tr.fit_boosted(df, FEATS, n_trees=k, rate=0.5), FEATS).where("is_train").agg(
        F.avg((F.col("score") - F.col("label")) ** 2)).first()[0] for k in (1, 10))
    assert ten < one < 1


def test_bootstrap_weights_have_mean_one(spark):
    w = spark.range(20000).select(tr.bootstrap_weight(F.lit(3), "id").alias("w")).agg(F.avg("w"), F.variance("w"), F.max("w")).first()
    assert abs(w[0] - 1) < 0.03 and abs(w[1] - 1) < 0.05 and w[2] >= 5


@pytest.mark.parametrize("kind,c,gamma", [("rbf", 20.0, 2.0), ("linear", 1.0, 1.0), ("poly", 1.0, 0.5), ("rbf", 0.2, 20.0)])
def test_svm_meets_the_conditions_and_saves(spark, tmp_path, kind, c, gamma):
    df, cfg = bars(spark), (ks.Config("m", kind, c, gamma),)
    ks.fit_svm(df, FEATS, cfg).write.parquet(str(tmp_path / "sv"))
    sv = spark.read.parquet(str(tmp_path / "sv"))
    scored = ks.score_svm(df, sv, FEATS, cfg)
    ok = {r["symbol"]: r for r in ks.optimality(scored.where("symbol != 'one'"), sv, cfg).collect()}
    assert set(ok) == {"a", "b"} and all(r["alpha_in_box"] and r["alpha_balanced"] and r["margins_hold"] and r["gap_closed"]
                                         for r in ok.values())
    assert scored.where("symbol = 'one' and score <= 0").count() == 0
    assert sv.where("alpha > 0").groupBy("symbol").agg(F.sum("coef").alias("s")).where("abs(s) > 1e-9").count() == 0


def test_conditions_fail_for_another_model(spark):
    """The check has teeth: a model for another C does not pass."""
    df, right = bars(spark), (ks.Config("m", "rbf", 20.0, 2.0),)
    sv = ks.fit_svm(df, FEATS, (ks.Config("m", "rbf", 1.0, 2.0),))
    ok = ks.optimality(ks.score_svm(df, sv, FEATS, right).where("symbol = 'a'"), sv, right).first()
    assert not ok["margins_hold"] and not ok["gap_closed"]


def test_small_kernel_cache_gives_the_same_solution(monkeypatch):
    r = np.random.default_rng(4)
    x, y = r.normal(size=(80, 2)), np.where(r.random(80) < 0.5, 1.0, -1.0)
    cfg = ks.Config("m", "rbf", 5.0, 1.0)
    whole = ks.solve(x, y, cfg, 1e-6)
    monkeypatch.setattr(ks, "CACHE_BYTES", 1)
    assert np.allclose(ks.solve(x, y, cfg, 1e-6)[0], whole[0])


def test_newton_gradient_vanishes_for_every_key_and_penalty(spark):
    r = np.random.default_rng(5)
    data = []
    for k, n in (("big", 3000), ("small", 40)):
        x = r.normal(size=(n, 3)) * (1, 30, 0.01) + (0, 100, 0)
        t = (r.random(n) < 1 / (1 + np.exp(-(x[:, 0] + 0.02 * (x[:, 1] - 100))))).astype(float)
        data += [(k, v.tolist(), float(c)) for v, c in zip(x, t)]
    rows = spark.createDataFrame(data, "key string, x array<double>, t double").repartition(5).checkpoint()
    theta = nt.fit_logistic(rows, (0.0, 0.5))
    got = nt.gradients(rows, theta).collect()
    assert len(got) == 4 and all(g["gradient"] < 1e-8 for g in got)
    norm = {(r["key"], r["lam"]): sum(v * v for v in r["theta"][1:]) for r in theta.collect()}
    assert all(norm[k, 0.5] < norm[k, 0.0] for k in ("big", "small"))
    moved = theta.withColumn("theta", F.transform("theta", lambda v: v + 0.01))
    assert all(g["gradient"] > 1e-6 for g in nt.gradients(rows, moved).collect())


def test_sigmoid_on_margins_no_model_has_seen(spark):
    df = bars(spark, n=200)
    held = nt.out_of_fold(df.where("symbol != 'one'"), FEATS, ks.Config("m", "rbf", 1.0, 2.0))
    assert held.count() == 320 and held.select("symbol").distinct().count() == 2
    rows, theta = nt.calibrate(held)
    assert all(g["gradient"] < 1e-8 for g in nt.gradients(rows, theta).collect())
    p = nt.probability(rows, theta).collect()
    assert all(0 < r["p"] < 1 for r in p) and all(r["theta"][1] > 0 for r in p)


def test_networks_train_save_and_score(spark, tmp_path):
    from ticktale.operators import networks as nn
    df = bars(spark, n=150).where("symbol != 'one'")
    nets = (nn.Net("deep", ("n/2", "n/5"), steps=60), nn.Net("flat", ("d", "d/2"), "linear", steps=60),
            nn.Net("relu", ("12",), activation="relu", alpha=1e-3, steps=60))
    nn.fit_networks(df, FEATS, nets).write.parquet(str(tmp_path / "units"))
    units = spark.read.parquet(str(tmp_path / "units"))
    scored = nn.score_networks(df, units, FEATS, nets)
    got = {(r["symbol"], r["network"]): r for r in nn.losses(scored, units, nets).collect()}
    assert len(got) == 6 and all(r["loss_found"] and r["loss_falls"] for r in got.values())
    assert got["a", "deep"]["hidden"] == "75 30" and got["a", "flat"]["hidden"] == "2 1"
    hit = scored.where("network = 'deep' AND is_train").agg(F.avg((F.col("signal") == F.col("label")).cast("double"))).first()[0]
    assert hit > 0.75
    worse = units.withColumn("weights", F.transform("weights", lambda w: w + 0.05))
    assert not any(r["loss_found"] for r in nn.losses(nn.score_networks(df, worse, FEATS, nets), units, nets).collect())


def test_network_gradient_is_that_of_the_loss():
    from ticktale.operators import networks as nn
    r = np.random.default_rng(3)
    x, t = r.normal(size=(40, 2)), np.eye(2)[r.integers(0, 2, 40)]
    for net in (nn.Net("a", ("6",), steps=400, rate=0.01), nn.Net("b", ("6", "4"), "linear", "relu", steps=400, rate=0.01)):
        layers, start, loss = nn.train(net, x, t, [6] if net.name == "a" else [6, 4], 1)
        assert loss < 0.8 * start and loss == nn.loss_of(net, nn.forward(net, layers, x)[-1], t)
    assert [nn.width(s, 151, 2) for s in ("n/2", "n/5", "d", "d/2", "25")] == [76, 30, 2, 1, 25]
