"""Explicit kernel feature maps as column expressions.

Kernel SVMs become linear SVMs on mapped features:

* polynomial ``(gamma * u.v)^3``: exact map, one column per degree-3
  monomial ``sqrt(gamma^3 * 3!/alpha!) * x^alpha``;
* RBF ``exp(-gamma |u - v|^2)``: random Fourier features (Rahimi & Recht
  2007) ``sqrt(2/D) cos(w.x + b)``, ``w ~ N(0, 2 gamma I)``, ``b ~ U[0, 2pi)``
  drawn once from a seed and written into the plan as literals;
* sigmoid ``tanh(gamma * u.v + c0)``: landmark features
  ``tanh(gamma * x.l_j + c0)`` for a bounded set of landmark rows.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(xs: list[Column], ws) -> Column:
    acc = None
    for x, w in zip(xs, ws):
        term = x * F.lit(float(w))
        acc = term if acc is None else acc + term
    return acc


def poly3_features(xs: list[Column], gamma: float) -> list[Column]:
    d = len(xs)
    out = []
    for combo in itertools.combinations_with_replacement(range(d), 3):
        counts = [combo.count(i) for i in range(d)]
        coef = math.sqrt(gamma ** 3 * math.factorial(3) / math.prod(math.factorial(c) for c in counts))
        term = F.lit(coef)
        for i in combo:
            term = term * xs[i]
        out.append(term)
    return out


def rff_params(d: int, n_components: int, gamma: float, seed: int = 7):
    rng = np.random.default_rng(seed)
    w = rng.normal(0.0, math.sqrt(2.0 * gamma), size=(n_components, d))
    b = rng.uniform(0.0, 2.0 * math.pi, size=n_components)
    return w, b


def rff_features(xs: list[Column], gamma: float, n_components: int = 300, seed: int = 7) -> Column:
    """One array expression (a lambda over component index with literal
    weight arrays), so the plan stays small for hundreds of components."""
    w, b = rff_params(len(xs), n_components, gamma, seed)
    s = math.sqrt(2.0 / n_components)
    ws = [F.array(*[F.lit(float(v)) for v in w[:, j]]) for j in range(len(xs))]
    bs = F.array(*[F.lit(float(v)) for v in b])

    def comp(k):
        acc = None
        for j, x in enumerate(xs):
            t = x * ws[j][k]
            acc = t if acc is None else acc + t
        return F.lit(s) * F.cos(acc + bs[k])
    return F.transform(F.sequence(F.lit(0), F.lit(n_components - 1)), comp)


def sigmoid_landmark_features(xs: list[Column], landmarks: list[list[float]], gamma: float,
                              coef0: float = 0.0) -> list[Column]:
    return [F.tanh(F.lit(gamma) * dot(xs, l) + F.lit(coef0)) for l in landmarks]


def sigmoid(z: Column) -> Column:
    """X14."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
