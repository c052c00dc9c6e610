"""Perceptron networks for all symbols and configurations in one job (M6-M8).

A fit groups the rows by (symbol, network) and trains on the whole batch with
Adam steps; the weights with the least loss seen are kept. The model is a table
with one row per unit (symbol, network, layer, unit, weights with the bias
first) that can be saved, read and scored; hidden widths may depend on the
symbol's rows (``n/2``, ``n/5``) or the features (``d``, ``d/2``) and are not
capped.

Pattern networks end in a softmax and minimise the cross-entropy; feed-forward
networks end in linear outputs and minimise the squared error against one-hot
targets. A group holds the bars of one symbol, which the calendar and the bar
width bound (see README); a batch's activations take rows x units numbers.
"""

from __future__ import annotations

import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import r6
from ..session import written
from .bars import feature_columns
from .trees import dealt, with_column


class Net(NamedTuple):
    name: str
    hidden: tuple[str, ...]             # widths: numbers or n/2, n/5, d, d/2
    output: str = "softmax"             # or linear
    activation: str = "tanh"            # or relu, logistic
    alpha: float = 0.0                  # weight of half the squared weights, per row
    steps: int = 50
    rate: float = 0.02


#: The networks of the comparison.
NETWORKS = (
    Net("nnet 25", ("25",)), Net("nnet 25 10", ("25", "10")), Net("nnet n/2", ("n/2",)), Net("nnet n/2 n/5", ("n/2", "n/5")),
    Net("ff 25", ("25",), "linear"), Net("ff 25 10", ("25", "10"), "linear"), Net("ff 25 10 4", ("25", "10", "4"), "linear"),
    Net("ff n/2", ("n/2",), "linear"), Net("ff n/2 n/5", ("n/2", "n/5"), "linear"), Net("ff d d/2", ("d", "d/2"), "linear"),
)
#: The study's classifier (one hidden layer of 100, relu, Adam).
MLP = Net("mlp", ("100",), activation="relu", alpha=1e-4, steps=200)

UNITS = "symbol string, network string, layer int, unit int, weights array<double>, start_loss double, loss double"


def width(spec: str, n: int, d: int) -> int:
    """A hidden width, halves rounded up, at least one."""
    base = {"n": n, "d": d}.get(spec[0])
    return int(spec) if base is None else max(1, int(base / float(spec[2:] or 1) + 0.5))


def _activate(kind: str, z: np.ndarray) -> np.ndarray:
    if kind == "relu":
        return np.maximum(z, 0)
    return np.tanh(z) if kind == "tanh" else 1 / (1 + np.exp(-z))


def _slope(kind: str, a: np.ndarray) -> np.ndarray:
    if kind == "relu":
        return (a > 0).astype(a.dtype)
    return 1 - a * a if kind == "tanh" else a * (1 - a)


def forward(net: Net, layers: list[np.ndarray], x: np.ndarray) -> list[np.ndarray]:
    """The inputs, the activations of the hidden layers, and the outputs."""
    out = [x]
    for i, w in enumerate(layers):
        z = out[-1] @ w[:, 1:].T + w[:, 0]
        if i + 1 < len(layers):
            z = _activate(net.activation, z)
        elif net.output == "softmax":
            z = np.exp(z - z.max(axis=1, keepdims=True))
            z = z / z.sum(axis=1, keepdims=True)
        out.append(z)
    return out


def loss_of(net: Net, out: np.ndarray, target: np.ndarray) -> float:
    if net.output == "softmax":
        return float(-np.log(np.maximum((out * target).sum(axis=1), 1e-300)).mean())
    return float(((out - target) ** 2).sum(axis=1).mean())


def train(net: Net, x: np.ndarray, target: np.ndarray, hidden: list[int], seed: int) -> tuple[list[np.ndarray], float, float]:
    """Weights with the least loss, the loss at the start and theirs. Steps run
    in 32-bit floats, losses of the returned weights in 64."""
    r = np.random.default_rng(seed)
    sizes = [x.shape[1], *hidden, target.shape[1]]
    layers = [np.column_stack([np.zeros(b), r.normal(0, np.sqrt(1.0 / a), (b, a))]).astype(np.float32)
              for a, b in zip(sizes, sizes[1:])]
    first = [np.zeros_like(w) for w in layers]
    second = [np.zeros_like(w) for w in layers]
    x32, t32, n = x.astype(np.float32), target.astype(np.float32), len(x)
    best, best_loss, start = [w.copy() for w in layers], np.inf, loss_of(net, forward(net, layers, x)[-1], target)
    for k in range(1, net.steps + 2):
        acts = forward(net, layers, x32)
        now = loss_of(net, acts[-1], t32)
        if now < best_loss:
            best, best_loss = [w.copy() for w in layers], now
        delta = (acts[-1] - t32) * (1.0 if net.output == "softmax" else 2.0) / n
        for i in range(len(layers) - 1, -1, -1):
            w = layers[i]
            g = np.column_stack([delta.sum(axis=0), delta.T @ acts[i]])
            if net.alpha:
                g[:, 1:] += net.alpha / n * w[:, 1:]
            if i:
                delta = (delta @ w[:, 1:]) * _slope(net.activation, acts[i])
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            step = net.rate * (first[i] / (1 - 0.9 ** k)) / (np.sqrt(second[i] / (1 - 0.999 ** k)) + 1e-8)
            layers[i] = (w - step).astype(np.float32)
    best = [w.astype(np.float64) for w in best]
    return best, start, loss_of(net, forward(net, best, x)[-1], target)


def _inputs(t: pa.Table, feats: list[str]) -> np.ndarray:
    return np.column_stack([t.column(f).to_numpy() for f in feats]).astype(np.float64)


def _each(rows: DataFrame, nets: tuple[Net, ...]) -> DataFrame:
    return rows.withColumn("network", F.explode(F.array(*[F.lit(n.name) for n in nets])))


def fit_networks(rows: DataFrame, feats: list[str], nets: tuple[Net, ...], label: str = "label",
                 id_col: str = "bar_date") -> DataFrame:
    """The units of every (symbol, network); widths count all rows of the
    symbol, training uses those of ``is_train``."""
    by_name = {n.name: n for n in nets}
    given = _each(rows.select("symbol", id_col, "is_train", F.col(label).alias("_y"), *feats), nets)

    def fit(t: pa.Table) -> pa.Table:
        symbol, name = t.column("symbol")[0].as_py(), t.column("network")[0].as_py()
        net = by_name[name]
        hidden = [width(s, t.num_rows, len(feats)) for s in net.hidden]
        t = t.filter(t.column("is_train")).sort_by(id_col)
        y = t.column("_y").to_numpy()
        layers, start, loss = train(net, _inputs(t, feats), np.column_stack([y < 0, y > 0]).astype(float), hidden,
                                    zlib.crc32(f"{symbol}|{name}".encode()))
        units = [(i, j, w[j]) for i, w in enumerate(layers) for j in range(len(w))]
        n = len(units)
        return pa.Table.from_arrays(
            [pa.array([symbol] * n), pa.array([name] * n), pa.array([u[0] for u in units], pa.int32()),
             pa.array([u[1] for u in units], pa.int32()), pa.array([u[2] for u in units], pa.list_(pa.float64())),
             pa.array([start] * n), pa.array([loss] * n)], names=[c.split()[0] for c in UNITS.split(", ")])
    keys = ("symbol", "network")
    return dealt(given, *keys).groupBy(*keys).applyInArrow(fit, UNITS)


def score_networks(rows: DataFrame, units: DataFrame, feats: list[str], nets: tuple[Net, ...]) -> DataFrame:
    """Every row with ``network``, the outputs ``out_down`` and ``out_up`` and
    ``signal``; null without a model."""
    by_name = {n.name: n for n in nets}
    given = _each(rows, nets)

    def score(t: pa.Table, model: pa.Table) -> pa.Table:
        out = np.full((t.num_rows, 2), np.nan)
        if model.num_rows and t.num_rows:
            model = model.sort_by([("layer", "ascending"), ("unit", "ascending")])
            layer, weights = model.column("layer").to_numpy(), model.column("weights").combine_chunks()
            layers = [np.array(weights.take(pa.array(np.flatnonzero(layer == i))).to_pylist()) for i in range(layer.max() + 1)]
            net, x = by_name[model.column("network")[0].as_py()], _inputs(t, feats)
            for at in range(0, len(x), 4096):
                out[at:at + 4096] = forward(net, layers, x[at:at + 4096])[-1]
        for i, name in enumerate(("out_down", "out_up")):
            t = t.append_column(name, pa.array(out[:, i], from_pandas=True))
        return t
    keys = ("symbol", "network")
    scored = dealt(given, *keys).groupBy(*keys).cogroup(dealt(units, *keys).groupBy(*keys)).applyInArrow(
        score, with_column(given, "out_down double, out_up double"))
    return scored.withColumn("signal", F.when(F.col("out_up") > F.col("out_down"), 1).otherwise(-1))


def row_loss(nets: tuple[Net, ...], label: str = "label") -> Column:
    """A scored row's loss by its network's kind."""
    linear = F.col("network").isin(*[n.name for n in nets if n.output == "linear"] or [""])
    up = F.when(F.col(label) > 0, 1.0).otherwise(0.0)
    entropy = -F.ln(F.when(F.col(label) > 0, F.col("out_up")).otherwise(F.col("out_down")))
    square = (F.col("out_up") - up) ** 2 + (F.col("out_down") - (1 - up)) ** 2
    return F.when(linear, square).otherwise(entropy)


def network_bars(bars: DataFrame, nets: tuple[Net, ...]) -> tuple[DataFrame, DataFrame]:
    """(scored rows, units) on normalised price features, both written once."""
    from .models import model_frame, normalize
    feats = feature_columns(False)
    df = written(normalize(model_frame(bars), feats), "network-rows")
    units = written(fit_networks(df, feats, nets), "network-units")
    return written(score_networks(df, units, feats, nets), "network-scores"), units


def losses(scored: DataFrame, units: DataFrame, nets: tuple[Net, ...]) -> DataFrame:
    """Per symbol and network: rows, hidden widths as found in the weight
    table, and whether the loss that plain aggregates find from its outputs is
    the reported one and below that of the start."""
    found = scored.groupBy("symbol", "network").agg(
        F.count("*").alias("n"), F.avg(F.when(F.col("is_train"), row_loss(nets))).alias("found"))
    model = units.groupBy("symbol", "network").agg(
        F.max("start_loss").alias("start"), F.max("loss").alias("loss"), F.max("layer").alias("top"))
    widths = units.groupBy("symbol", "network", "layer").agg(F.count("*").alias("w")).join(
        model.select("symbol", "network", "top"), ["symbol", "network"]).where("layer < top").groupBy("symbol", "network").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("layer", "w"))), lambda s: s["w"].cast("string")), " ").alias("hidden"))
    return found.join(model, ["symbol", "network"]).join(widths, ["symbol", "network"]).select(
        "symbol", "network", "n", "hidden", (F.abs(F.col("found") - F.col("loss")) < 1e-9).alias("loss_found"),
        (F.col("loss") < F.col("start")).alias("loss_falls"))


def q_network_losses(bars: DataFrame) -> DataFrame:
    return losses(*network_bars(bars, NETWORKS), NETWORKS)


def q_mlp_loss(bars: DataFrame) -> DataFrame:
    return losses(*network_bars(bars, (MLP,)), (MLP,))


def network_signals(bars: DataFrame, nets: tuple[Net, ...]) -> DataFrame:
    return network_bars(bars, nets)[0].withColumnRenamed("network", "strategy")


def q_network_comparison(bars: DataFrame) -> DataFrame:
    """Best symbol and mean accuracy of every network."""
    from .backtest import backtest, summary
    from .compare import classifier_summary
    c = classifier_summary(written(summary(backtest(network_signals(bars, NETWORKS))), "network-metrics"))
    return c.select(F.col("strategy").alias("network"), r6("best_acc").alias("best_acc"), "best_symbol",
                    r6("avg_acc").alias("avg_acc"))


def q_mlp(bars: DataFrame) -> DataFrame:
    """M6."""
    from .models import backtest_summary
    return backtest_summary(network_signals(bars, (MLP,)).drop("strategy"), "mlp")
