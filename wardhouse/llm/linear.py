"""Hashed n-grams and logistic regression in numpy."""

from __future__ import annotations

import zlib

import numpy as np

_STEP = np.uint32(0x9E3779B1)
_MIX = np.uint32(0x85EBCA6B)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def char_ngrams(text: str, orders: tuple[int, ...], bits: int, lower: bool = True) -> np.ndarray:
    """Bucket of every character n-gram of the text, with a blank at either end."""
    codes = code_points(f" {text.lower() if lower else text} ")
    shift = np.uint32(32 - bits)
    out, rolled = [], None
    for order in range(1, max(orders) + 1):
        if len(codes) < order:
            break
        step = codes[order - 1 :] * _MIX
        rolled = step if rolled is None else rolled[: len(step)] * _STEP + step
        if order in orders:
            mixed = rolled ^ (rolled >> np.uint32(15))
            out.append(((mixed + np.uint32(order)) * _STEP) >> shift)
    return np.concatenate(out) if out else np.empty(0, np.uint32)


def word_ngrams(words: list[bytes], bits: int) -> np.ndarray:
    """Bucket of every word and every pair of neighbouring words."""
    if not words:
        return np.empty(0, np.uint32)
    codes = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
    pairs = codes[:-1] * _STEP + codes[1:] * _MIX + np.uint32(1)
    both = np.concatenate([codes, pairs])
    return ((both ^ (both >> np.uint32(15))) * _STEP) >> np.uint32(32 - bits)


def distinct(buckets: np.ndarray, scratch: np.ndarray) -> np.ndarray:
    """Each bucket once. ``scratch`` has an int32 for every possible bucket."""
    order = np.arange(len(buckets), dtype=np.int32)
    scratch[buckets] = order
    return buckets[scratch[buckets] == order]


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def platt(z: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and offset of the logistic curve that gives the label's probability from a score.

    Newton's method on smoothed targets, with a little ridge; a slope below zero
    is not accepted, so that a higher score never means a lower probability.
    """
    z, y = np.asarray(z, float), np.asarray(y, float)
    pos, neg = y.sum(), len(y) - y.sum()
    if not pos or not neg:
        rate = (pos + 1) / (len(y) + 2)
        return 0.0, float(np.log(rate / (1 - rate)))
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    scale = z.std() or 1.0
    x = np.stack([(z - z.mean()) / scale, np.ones_like(z)], 1)
    beta = np.zeros(2)
    for _ in range(steps):
        p = sigmoid(x @ beta)
        grad = x.T @ (p - target) + 1e-3 * beta
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        move = np.linalg.solve(hess, grad)
        beta -= np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-9:
            break
    slope = max(beta[0], 0.0) / scale
    return float(slope), float(beta[1] - slope * z.mean())


def isotonic(z: np.ndarray, y: np.ndarray) -> tuple[list[float], list[float]]:
    """Knots of the rising curve of the label's rate over a score (pool adjacent violators).

    Between knots it is read by linear interpolation. Each rate is drawn a
    little towards one half, so that none is exactly 0 or 1.
    """
    pools: list[list[float]] = []
    order = np.lexsort((y, z))
    for at, label in zip(np.asarray(z, float)[order], np.asarray(y, float)[order], strict=True):
        pools.append([label, 1.0, at, at])
        while len(pools) > 1 and (
            pools[-2][0] / pools[-2][1] >= pools[-1][0] / pools[-1][1] or pools[-2][3] == pools[-1][2]
        ):
            hits, rows, _, high = pools.pop()
            last = pools[-1]
            last[0], last[1], last[3] = last[0] + hits, last[1] + rows, high
    if not pools:
        return [0.0], [0.5]
    rates = np.maximum.accumulate([(hits + 0.5) / (rows + 1) for hits, rows, _, _ in pools])
    return [(low + high) / 2 for _, _, low, high in pools], [float(r) for r in rates]


def adam(gradient, size: int, steps: int, rate: float) -> np.ndarray:
    """Minimise a smooth function, given its gradient, from zero."""
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for t in range(1, steps + 1):
        g = gradient(w)
        m += 0.1 * (g - m)
        v += 0.01 * (g * g - v)
        w -= rate * (1 - t / (steps + 1)) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
    return w


def fit_sparse(
    rows: list[np.ndarray], y: np.ndarray, scale: np.ndarray, ridge: float, steps: int = 250
) -> tuple[np.ndarray, float]:
    """Logistic regression on rows of present features, each counting as its scale.

    Returns the weight of each feature's presence (its scale included) and the offset.
    """
    size, n = len(scale), max(len(rows), 1)
    where = np.concatenate(rows) if rows else np.empty(0, np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    value = scale[where]

    def gradient(w: np.ndarray) -> np.ndarray:
        z = np.bincount(owner, value * w[where], len(rows)) + w[size]
        miss = (sigmoid(z) - y) / n
        g = np.bincount(where, value * miss[owner], size) + ridge * w[:size]
        return np.append(g, miss.sum())

    w = adam(gradient, size + 1, steps, 0.05)
    return w[:size] * scale, float(w[size])


def fit_dense(x: np.ndarray, y: np.ndarray, ridge: float, steps: int = 250) -> tuple[np.ndarray, float]:
    """Logistic regression on dense rows (float32)."""
    size, n = x.shape[1], max(len(x), 1)

    def gradient(w: np.ndarray) -> np.ndarray:
        miss = ((sigmoid(x @ w[:size].astype(np.float32) + w[size]) - y) / n).astype(np.float32)
        return np.append(x.T @ miss + ridge * w[:size], miss.sum())

    w = adam(gradient, size + 1, steps, 0.3)
    return w[:size], float(w[size])
