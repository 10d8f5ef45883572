"""Textbook formulations in numpy, to compare with."""

import numpy as np


def standardized(x):
    s = x.std(axis=0)
    return (x - x.mean(axis=0)) / np.where(s > 0, s, 1)


def dummies(y):
    classes = sorted(set(y))
    return np.array([[float(v == c) for c in classes] for v in y]), classes


def nipals(x, y, components, scale):
    """PLS2 by the iteration over rows, run to tight convergence."""
    x, y = x - x.mean(axis=0), y - y.mean(axis=0)
    y_scale = np.ones(y.shape[1])
    if scale:
        sx, sy = x.std(axis=0, ddof=1), y.std(axis=0, ddof=1)
        x = x / np.where(sx > 0, sx, 1)
        y_scale = np.where(sy > 0, sy, 1)
        y = y / y_scale
    x0, ws, ps, qs, ts = x.copy(), [], [], [], []
    for _ in range(components):
        u = y[:, np.argmax(y.var(axis=0))]
        w = np.zeros(x.shape[1])
        for _ in range(20000):
            new = x.T @ u
            new /= np.linalg.norm(new)
            t = x @ new
            q = y.T @ t / (t @ t)
            u = y @ q / (q @ q)
            if np.linalg.norm(new - w) < 1e-15:
                break
            w = new
        w = new if new[np.argmax(np.abs(new))] > 0 else -new
        t = x @ w
        p, q = x.T @ t / (t @ t), y.T @ t / (t @ t)
        x, y = x - np.outer(t, p), y - np.outer(t, q)
        for store, value in ((ws, w), (ps, p), (qs, q), (ts, t)):
            store.append(value)
    w, p, q, t = (np.array(a).T for a in (ws, ps, qs, ts))
    coefficients = w @ np.linalg.inv(p.T @ w) @ q.T * y_scale
    return w, t, x0 @ coefficients


def predictions(x, y, components, scale=False):
    d, classes = dummies(y)
    _, _, fitted = nipals(x, d, components, scale)
    return [classes[i] for i in np.argmax(fitted + d.mean(axis=0), axis=1)]


def hits(x, y, components=2):
    keep = x.std(axis=0) > 0
    if keep.sum() < components:
        return None
    return sum(a == b for a, b in zip(y, predictions(standardized(x[:, keep]), y, components)))


def macro_f1(y, predicted):
    values = []
    for c in set(y) | set(predicted):
        tp = sum(a == c and b == c for a, b in zip(y, predicted))
        fp = sum(a != c and b == c for a, b in zip(y, predicted))
        fn = sum(a == c and b != c for a, b in zip(y, predicted))
        values.append(2 * tp / (2 * tp + fp + fn))
    return float(np.mean(values))


def silhouette(x, y, labels):
    d = np.hypot(x[:, None] - x, y[:, None] - y)
    codes = np.unique(labels, return_inverse=True)[1]
    n = np.bincount(codes)
    sums = np.stack([d[:, codes == c].sum(axis=1) for c in range(len(n))], axis=1)
    own = np.arange(len(x)), codes
    a = sums[own] / np.maximum(n[codes] - 1, 1)
    means = sums / n
    means[own] = np.inf
    b = means.min(axis=1)
    larger = np.maximum(a, b)
    return np.where((n[codes] > 1) & (larger > 0), (b - a) / np.where(larger > 0, larger, 1), 0).mean()


def samples(n=300, p=6, classes=3, seed=1):
    """Rows of ``classes`` shifted clouds; the first features tell them apart best."""
    rng = np.random.default_rng(seed)
    y = rng.integers(0, classes, n)
    x = rng.normal(size=(n, p)) * rng.uniform(0.5, 20, p) + rng.normal(size=p) * 50
    for j in range(p):
        x[:, j] += y * (p - j) * x[:, j].std() * (0.25 if j % 2 else -0.2) + (y == 1) * j * 0.3
    return x, [f"class {v}" for v in y]
