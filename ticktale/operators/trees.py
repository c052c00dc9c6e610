"""Trees for all symbols in one job.

A fit groups the rows by (symbol, tree) and grows each tree level by level to
full depth; a model is a table with one row per node, and scoring brings each
symbol's rows and nodes together once. The driver sees neither symbols nor
rows.

* Classification: labels -1/+1, Gini impurity. For two classes the decrease
  of the weighted Gini impurity is half of
  ``(s_l * w_r - s_r * w_l)**2 / (w_l * w_r * w)`` with weights ``w`` and label
  sums ``s`` of the two sides, which is exact for whole numbers, so that
  equally good splits tie in any engine.
* Regression (boosting): the same expression is the decrease of the squared
  error. Residuals are whole multiples of ``UNIT`` so that sums are exact too.

Ties go to the first feature, then to the lowest threshold. A threshold lies
midway between two neighbouring values; smaller values go left. A node is a
leaf if its weight is below ``min_parent``, if no split decreases the impurity
or at ``max_depth`` (None: never).

A group holds the bars of one symbol, which the calendar and the bar width
bound (see README), times one tree.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNIT = 2.0 ** -30
MIN_PARENT = 10             # fixed value: the study's toolbox splits nodes of ten and more
NODES = ("symbol string, tree int, node int, feature int, threshold double, left_node int, right_node int, "
         "value double, weight double, depth int")
#: Cumulative Poisson(1) probabilities, for bootstrap weights.
POISSON_STEPS = tuple(sum(math.exp(-1) / math.factorial(j) for j in range(k + 1)) for k in range(12))


class _Node:
    __slots__ = ("depth", "feature", "left", "right", "sum", "threshold", "weight")

    def __init__(self, depth: int):
        self.depth, self.feature, self.threshold, self.left, self.right = depth, -1, None, -1, -1
        self.sum = self.weight = 0.0


def grow(x: np.ndarray, y: np.ndarray, w: np.ndarray, min_parent: float = MIN_PARENT,
         max_depth: int | None = None) -> tuple[list[_Node], np.ndarray]:
    """Nodes and the leaf of each row. All nodes of a level are searched at
    once: per feature one sort by (node, value) and running sums."""
    nodes, at = [_Node(0)], np.zeros(len(y), np.int64)
    used = w > 0
    presorted = [np.flatnonzero(used)[np.argsort(x[used, f], kind="stable")] for f in range(x.shape[1])]
    open_ids = [0]
    while open_ids:
        size = len(nodes)
        weight = np.bincount(at[used], w[used], size)
        total = np.bincount(at[used], w[used] * y[used], size)
        for i in open_ids:
            nodes[i].weight, nodes[i].sum = float(weight[i]), float(total[i])
        is_open = np.zeros(size, bool)
        is_open[[i for i in open_ids if weight[i] >= min_parent and (max_depth is None or nodes[i].depth < max_depth)]] = True
        best: dict[int, tuple[float, int, float]] = {}
        for f, order in enumerate(presorted):
            rows = order[is_open[at[order]]]
            rows = rows[np.argsort(at[rows], kind="stable")]
            node, v = at[rows], x[rows, f]
            edge = np.flatnonzero((node[:-1] == node[1:]) & (v[:-1] < v[1:]))
            if not len(edge):
                continue
            first = np.flatnonzero(np.r_[True, node[:-1] != node[1:]])
            cw, cs = np.cumsum(w[rows]), np.cumsum(w[rows] * y[rows])
            lead = np.repeat(first, np.diff(np.r_[first, len(rows)]))
            wl = (cw - cw[lead] + w[rows][lead])[edge]
            sl = (cs - cs[lead] + (w[rows] * y[rows])[lead])[edge]
            n = node[edge]
            wr, sr = weight[n] - wl, total[n] - sl
            cross = sl * wr - sr * wl
            gain = cross * cross / (wl * wr * weight[n])
            pick = np.lexsort((edge, -gain, n))
            pick = pick[np.r_[True, n[pick][1:] != n[pick][:-1]]]
            for p in pick:
                if gain[p] > 0 and gain[p] > best.get(int(n[p]), (0.0,))[0]:
                    low, high = v[edge[p]], v[edge[p] + 1]
                    middle = (low + high) / 2
                    best[int(n[p])] = (gain[p], f, float(high if middle <= low else middle))
        open_ids = []
        for i, (_, f, threshold) in sorted(best.items()):
            parent = nodes[i]
            parent.feature, parent.threshold, parent.left, parent.right = f, threshold, len(nodes), len(nodes) + 1
            nodes += [_Node(parent.depth + 1), _Node(parent.depth + 1)]
            here = np.flatnonzero(at == i)
            at[here] = np.where(x[here, f] < threshold, parent.left, parent.right)
            open_ids += [parent.left, parent.right]
    return nodes, at


def _table(symbol: str, trees: list[tuple[int, list[_Node], list[float]]]) -> pa.Table:
    cols: list[list] = [[] for _ in range(10)]
    for tree, nodes, values in trees:
        for i, (n, value) in enumerate(zip(nodes, values)):
            for col, v in zip(cols, (symbol, tree, i, n.feature, n.threshold, n.left, n.right, value, n.weight, n.depth)):
                col.append(v)
    types = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.int32(), pa.float64(),
             pa.float64(), pa.int32()]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                names=[part.split()[0] for part in NODES.split(", ")])


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt by key for work that is heavy for its few bytes: a stated
    number of partitions, which adaptive execution does not join again."""
    return df.repartition(4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def _matrix(t: pa.Table, feats: list[str]) -> np.ndarray:
    return np.column_stack([t.column(f).to_numpy() for f in feats]).astype(np.float64)


def fixed_point(v: np.ndarray) -> np.ndarray:
    """Values in whole units."""
    return np.floor(v / UNIT + 0.5)


# ---------------------------------------------------------------- fits
def bootstrap_weight(tree: Column, *keys: str) -> Column:
    """Poisson(1) weight from a hash of the row's keys and the tree: how often a
    sample with replacement of the same size takes the row."""
    digest = F.md5(F.concat_ws("|", *keys, tree.cast("string")).cast("binary"))
    u = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / float(1 << 32)
    return sum((F.when(u >= p, 1).otherwise(0) for p in POISSON_STEPS), F.lit(0)).cast("double")


def fit_trees(rows: DataFrame, feats: list[str], label: str = "label", weight: str | None = None,
              min_parent: float = MIN_PARENT, max_depth: int | None = None) -> DataFrame:
    """One classification tree for each (symbol, tree) of the training rows;
    ``rows`` has ``symbol, is_train``, the features, the label and, for more
    than one tree, ``tree`` and ``weight``. A node's value is its mean label in
    whole units."""
    train = rows.where("is_train").select(
        "symbol", F.col("tree") if "tree" in rows.columns else F.lit(0).alias("tree"),
        *[F.col(f).cast("double").alias(f) for f in feats], F.col(label).cast("double").alias("_y"),
        (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("_w"))

    def fit(t: pa.Table) -> pa.Table:
        nodes, _ = grow(_matrix(t, feats), t.column("_y").to_numpy(), t.column("_w").to_numpy(), min_parent, max_depth)
        values = [float(fixed_point(np.float64(n.sum) / n.weight)) * UNIT if n.weight else 0.0 for n in nodes]
        return _table(t.column("symbol")[0].as_py(), [(t.column("tree")[0].as_py(), nodes, values)])
    return dealt(train, "symbol", "tree").groupBy("symbol", "tree").applyInArrow(fit, NODES)


def fit_boosted(rows: DataFrame, feats: list[str], label: str = "label", n_trees: int = 10, rate: float = 0.0245,
                min_parent: float = MIN_PARENT, max_depth: int | None = None) -> DataFrame:
    """Least-squares boosting: each tree fits the residual of the ones before;
    a leaf adds ``rate`` times its mean residual. The residual stays on the rows
    from round to round."""
    train = rows.where("is_train").select("symbol", *[F.col(f).cast("double").alias(f) for f in feats],
                                          F.col(label).cast("double").alias("_y"))

    def fit(t: pa.Table) -> pa.Table:
        x, residual, trees = _matrix(t, feats), fixed_point(t.column("_y").to_numpy()), []
        ones = np.ones(len(residual))
        for k in range(n_trees):
            nodes, at = grow(x, residual, ones, min_parent, max_depth)
            steps = np.array([np.floor(rate * (n.sum / n.weight) + 0.5) for n in nodes])
            residual = residual - steps[at]
            trees.append((k, nodes, (steps * UNIT).tolist()))
        return _table(t.column("symbol")[0].as_py(), trees)
    return dealt(train, "symbol").groupBy("symbol").applyInArrow(fit, NODES)


# ---------------------------------------------------------------- scoring
def score_trees(rows: DataFrame, nodes: DataFrame, feats: list[str], vote: bool = False) -> DataFrame:
    """``score``: sum over the symbol's trees of the value of a row's leaf
    (``vote``: of its sign). Rows of a symbol without a model have none."""
    def score(t: pa.Table, model: pa.Table) -> pa.Table:
        x = _matrix(t, feats)
        total = np.zeros(len(x)) if model.num_rows else np.full(len(x), np.nan)
        model = model.sort_by([("tree", "ascending"), ("node", "ascending")])
        tree = model.column("tree").to_numpy()
        col = {c: model.column(c).to_numpy(zero_copy_only=False) for c in
               ("feature", "threshold", "left_node", "right_node", "value")}
        for start in np.flatnonzero(np.r_[True, tree[1:] != tree[:-1]]) if len(tree) else ():
            at = np.zeros(len(x), np.int64)
            while True:
                f = col["feature"][start + at]
                go = np.flatnonzero(f >= 0)
                if not len(go):
                    break
                here = start + at[go]
                left = x[go, f[go]] < col["threshold"][here]
                at[go] = np.where(left, col["left_node"][here], col["right_node"][here])
            leaf = col["value"][start + at]
            total += np.where(leaf > 0, 1.0, -1.0) if vote else leaf
        return t.append_column("score", pa.array(total, from_pandas=True))
    return rows.groupBy("symbol").cogroup(nodes.groupBy("symbol")).applyInArrow(score, with_column(rows, "score double"))


def with_column(rows: DataFrame, more: str) -> str:
    """The schema of ``rows`` and more columns, for functions that add them."""
    return ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema] + [more])


def sign_of_score(df: DataFrame) -> DataFrame:
    """Signals; ties and rows without a model go to the first class, -1."""
    return df.withColumn("signal", F.when(F.col("score") > 0, 1).otherwise(-1))
