"""Gradient-boosted depth-two trees for small labelled samples, applied as SQL expressions.

Fitting happens on the driver over a bounded sample (the caller's documented parameter);
scoring is a sum of CASE expressions, so rows never leave the JVM.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Tree:
    feature: int
    threshold: float
    low: tuple[int, float, float, float]  # feature, threshold, value up to it, value beyond
    high: tuple[int, float, float, float]


@dataclass(frozen=True)
class Model:
    bias: float
    trees: tuple[Tree, ...]
    threshold: float  # on the probability

    def probability(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.bias)
        for t in self.trees:
            for side, (f, c, a, b) in ((x[:, t.feature] <= t.threshold, t.low), (x[:, t.feature] > t.threshold, t.high)):
                z += np.where(side, np.where(x[:, f] <= c, a, b), 0.0)
        return 1 / (1 + np.exp(-z))

    def sql(self, names: list[str]) -> str:
        """The probability as an expression over columns or struct fields."""

        def leaf(f, c, a, b):
            return f"CASE WHEN {names[f]} <= {c!r}D THEN {a!r}D ELSE {b!r}D END"

        trees = [f"CASE WHEN {names[t.feature]} <= {t.threshold!r}D THEN {leaf(*t.low)} ELSE {leaf(*t.high)} END" for t in self.trees]
        return f"(1D / (1D + exp(-({' + '.join([f'{self.bias!r}D', *trees])}))))"


def _cuts(x: np.ndarray) -> list[np.ndarray]:
    out = []
    for column in x.T:
        levels = np.unique(np.quantile(column, np.linspace(0, 1, 17)[:-1]))
        out.append(levels[levels < column.max()])
    return out


def _best(x, gradient, hessian, cuts, rows) -> tuple[float, int, float, float, float]:
    """(gain, feature, threshold, value low, value high) of the best split of the rows."""
    g, h = gradient[rows].sum(), hessian[rows].sum()
    whole = g * g / (h + 1)
    best = (0.0, 0, float(np.inf), g / (h + 1), 0.0)
    for f, levels in enumerate(cuts):
        column = x[rows, f]
        for c in levels:
            low = column <= c
            gl, hl = gradient[rows][low].sum(), hessian[rows][low].sum()
            gr, hr = g - gl, h - hl
            gain = gl * gl / (hl + 1) + gr * gr / (hr + 1) - whole
            if gain > best[0] + 1e-9 and hl > 1e-3 and hr > 1e-3:
                best = (gain, f, float(c), gl / (hl + 1), gr / (hr + 1))
    return best


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 16, rate: float = 0.4, precision: float = 0.99) -> Model:
    """Fit on the even rows; calibrate the threshold on the odd ones.

    The threshold is the lowest probability from which on at least `precision` of the
    calibration rows are positive, but at least a half (beyond 1, if there is none).
    """
    fit_x, fit_y, held_x, held_y = x[::2], y[::2], x[1::2], y[1::2]
    base = float(np.clip(fit_y.mean(), 0.01, 0.99))
    bias = float(np.log(base / (1 - base)))
    z, cuts, trees = np.full(len(fit_x), bias), _cuts(fit_x), []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-z))
        gradient, hessian = fit_y - p, p * (1 - p)
        gain, f, c, _, _ = _best(fit_x, gradient, hessian, cuts, np.arange(len(fit_x)))
        if gain <= 0:
            break
        low = fit_x[:, f] <= c
        halves = []
        for side in (low, ~low):
            _, g, d, a, b = _best(fit_x, gradient, hessian, cuts, np.flatnonzero(side))
            d = min(d, 1e300)
            halves.append((int(g), float(d), float(rate * a), float(rate * b)))
            z[side] += np.where(fit_x[side, g] <= d, rate * a, rate * b)
        trees.append(Tree(int(f), float(c), *halves))
    model = Model(bias, tuple(trees), 1.1)
    p = model.probability(held_x)
    order = np.argsort(-p, kind="stable")
    share = np.cumsum(held_y[order]) / np.arange(1, len(order) + 1)
    good = np.flatnonzero(share >= precision)
    return Model(bias, tuple(trees), max(0.5, float(p[order[good[-1]]])) if len(good) else 1.1)
