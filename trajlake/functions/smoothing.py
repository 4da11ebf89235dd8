"""Smoothing of whole series with numpy: median filters, local polynomials, filling, unwrapping.

Series are [frames, dimensions] of one episode. Windows shrink to what a series allows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

import numpy as np


def odd_window(wanted: int, length: int, least: int = 3) -> int | None:
    """The largest odd window that is neither wider than wanted nor than the series; None below `least`."""
    w = min(wanted, length)
    w -= 1 - w % 2
    return w if w >= least else None


def fill(x: np.ndarray) -> np.ndarray:
    """Values that are not finite become the line between their finite neighbours, or the nearest one; 0 without any."""
    out, t = np.array(x, float), np.arange(len(x))
    for d in range(out.shape[1]):
        ok = np.isfinite(out[:, d])
        if not ok.all():
            out[~ok, d] = np.interp(t[~ok], t[ok], out[ok, d]) if ok.any() else 0.0
    return out


def running_median(x: np.ndarray, window: int) -> np.ndarray:
    """Median of the window around each frame; beyond the ends the end values go on."""
    h = window // 2
    longer = np.concatenate([np.repeat(x[:1], h, axis=0), x, np.repeat(x[-1:], h, axis=0)])
    return np.partition(np.lib.stride_tricks.sliding_window_view(longer, window, axis=0), h, axis=-1)[..., h]


@lru_cache(maxsize=64)
def polynomial_weights(window: int, order: int) -> np.ndarray:
    """[window, window]: row i gives the fitted polynomial's value at place i of a window from its values."""
    powers = np.vander(np.arange(window) - window // 2, order + 1, increasing=True).astype(float)
    return powers @ np.linalg.pinv(powers)


def local_polynomial(x: np.ndarray, window: int, order: int) -> np.ndarray:
    """The local polynomial fit at each frame; the first and last half windows come from the first and last whole ones.

    Weights act on differences to the frame itself, so that a series at rest stays exactly at rest.
    """
    w, h = polynomial_weights(window, order), window // 2
    views = np.lib.stride_tricks.sliding_window_view(x, window, axis=0)
    fit = lambda view, own, weights: own + (view - own[..., None]) @ weights
    inner = fit(views, x[h : len(x) - h], w[h])
    head = [fit(views[0], x[i], w[i])[None] for i in range(h)]
    tail = [fit(views[-1], x[len(x) - window + i], w[i])[None] for i in range(h + 1, window)]
    return np.concatenate([*head, inner, *tail])


def smooth(x: np.ndarray, medians: Sequence[int] = (5, 5), window: int = 11, degree: int = 3) -> np.ndarray:
    out = fill(x)
    for k in medians:
        if n := odd_window(k, len(out)):
            out = running_median(out, n)
    n = odd_window(window, len(out), degree + 2)
    return local_polynomial(out, n, degree) if n else out


def unwrap(x: np.ndarray, places: Sequence[int]) -> np.ndarray:
    out = np.array(x, float)
    for d in places:
        out[:, d] = np.unwrap(out[:, d])
    return out


def steady_quaternions(x: np.ndarray, groups: Sequence[Sequence[int]]) -> np.ndarray:
    """Flips quaternions so that neighbours lie in one half: the sign is the parity of the flips since the last place
    where neighbours are at right angles or not numbers."""
    out = np.array(x, float)
    for g in groups:
        q = out[:, list(g)]
        with np.errstate(invalid="ignore"):
            d = np.einsum("ij,ij->i", q[1:], q[:-1])
        flips = np.r_[0, np.cumsum(d < 0)]
        reset = np.r_[True, ~(np.abs(d) > 0)]
        base = flips[np.maximum.accumulate(np.where(reset, np.arange(len(q)), 0))]
        out[:, list(g)] = q * np.where((flips - base) % 2, -1.0, 1.0)[:, None]
    return out


def change_metrics(x: np.ndarray, **how: object) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distance to the smooth series, second differences, third differences), absolute; before the begin stands its value."""
    raw = fill(x)
    before = np.concatenate([np.repeat(raw[:1], 3, axis=0), raw])
    return np.abs(raw - smooth(raw, **how)), np.abs(np.diff(before[1:], 2, axis=0)), np.abs(np.diff(before, 3, axis=0))
