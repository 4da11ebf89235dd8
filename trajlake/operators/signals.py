"""Signals of an episode in frame order: differences, gradients, unwrapping, filling, smoothing, sudden changes."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trajlake.functions import smoothing
from trajlake.functions.vectors import above, absolute, finite, minus, only_finite, plus, times
from trajlake.plans.episodes import per_episode, series


def _w(keys: Sequence[str], order: Sequence[str]):
    return Window.partitionBy(*keys).orderBy(*order)


def differences(frames: DataFrame, keys: Sequence[str], order: Sequence[str], vector: str) -> DataFrame:
    """Add absolute second and third differences of a vector; before an episode's begin stands its first frame.

    Whole vectors are lagged in one window, so nothing is exploded.
    """
    w = _w(keys, order)
    first = F.first(vector).over(w.rowsBetween(Window.unboundedPreceding, 0))
    l1, l2, l3 = (F.coalesce(F.lag(vector, k).over(w), first) for k in (1, 2, 3))
    x = F.col(vector)
    return frames.withColumn("acceleration", absolute(plus(minus(x, times(l1, 2)), l2))).withColumn("jerk", absolute(minus(plus(minus(x, times(l1, 3)), times(l2, 3)), l3)))


def gradients(frames: DataFrame, keys: Sequence[str], order: Sequence[str], vector: str) -> DataFrame:
    """Add central differences (one-sided at the ends) and their central differences."""
    w = _w(keys, order)

    def gradient(df: DataFrame, of: str, out: str) -> DataFrame:
        before, after = F.lag(of).over(w), F.lead(of).over(w)
        inner, head, tail = times(minus(after, before), 0.5), minus(after, F.col(of)), minus(F.col(of), before)
        return df.withColumn(out, F.when(before.isNotNull() & after.isNotNull(), inner).when(after.isNotNull(), head).when(before.isNotNull(), tail))

    return gradient(gradient(frames, vector, "gradient"), "gradient", "gradient2")


def unwrapped(frames: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str) -> DataFrame:
    """Add an angle without jumps: steps of pi or more lose whole turns. A step of exactly pi keeps its direction."""
    w = _w(keys, order)
    pi = F.lit(float(np.pi))
    step = F.col(value) - F.lag(value).over(w)
    wrapped = F.pmod(step + pi, 2 * pi) - pi
    wrapped = F.when((wrapped == -pi) & (step > 0), pi).otherwise(wrapped)
    fix = F.when(F.abs(step) >= pi, wrapped - step).otherwise(F.lit(0.0))
    rows = frames.withColumn("__fix", F.coalesce(fix, F.lit(0.0)))
    return rows.withColumn(out, F.col(value) + F.sum("__fix").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__fix")


def steady_quaternions(frames: DataFrame, keys: Sequence[str], order: Sequence[str], vector: str, places: Sequence[int], out: str) -> DataFrame:
    """Add the quaternion at `places` with signs such that neighbours agree: parity of flips since the last reset."""
    w = _w(keys, order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    q = F.array(*(F.get(vector, F.lit(i)) for i in places))
    d = F.aggregate(F.zip_with(q, F.lag(q).over(w), lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    rows = frames.withColumn("__d", d)
    ok = ~F.isnan("__d") & (F.col("__d") != 0)
    rows = rows.withColumn("__flip", F.coalesce((ok & (F.col("__d") < 0)).cast("int"), F.lit(0))).withColumn("__reset", F.coalesce((~ok).cast("int"), F.lit(1)))
    rows = rows.withColumn("__island", F.sum("__reset").over(upto))
    parity = F.sum("__flip").over(Window.partitionBy(*keys, "__island").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)) % 2
    return rows.withColumn(out, F.transform(q, lambda x: x * F.when(parity == 1, -1.0).otherwise(1.0))).drop("__d", "__flip", "__reset", "__island")


def filled(frames: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str) -> DataFrame:
    """Add the value with gaps (null, NaN, infinite) filled along the line between neighbours by position; 0 without any."""
    w = _w(keys, order)
    back, ahead = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    rows = frames.withColumn("__t", F.row_number().over(w)).withColumn("__v", only_finite(F.col(value)))
    at = F.when(F.col("__v").isNotNull(), F.col("__t"))
    rows = rows.withColumn("__a", F.last("__v", True).over(back)).withColumn("__ta", F.last(at, True).over(back)).withColumn("__b", F.first("__v", True).over(ahead)).withColumn("__tb", F.first(at, True).over(ahead))
    line = F.col("__a") + (F.col("__b") - F.col("__a")) * (F.col("__t") - F.col("__ta")) / F.nullif(F.col("__tb") - F.col("__ta"), F.lit(0))
    return rows.withColumn(out, F.coalesce("__v", line, "__a", "__b", F.lit(0.0))).drop("__t", "__v", "__a", "__ta", "__b", "__tb")


def odd_window(wanted: int, length: Column, least: int = 3) -> Column:
    """The largest odd window up to `wanted` and the length; null below `least`."""
    w = F.least(F.lit(wanted), length)
    w = w - (1 - w % 2)
    return F.when(w >= least, w)


def change_metrics(frames: DataFrame, keys: Sequence[str], order: Sequence[str], vectors: dict[str, str], carry: Sequence[str] = (), angular: dict[str, Sequence[int]] | None = None, quaternions: dict[str, Sequence[Sequence[int]]] | None = None, **how: object) -> DataFrame:
    """For each vector `name`: name_residual, name_acceleration, name_jerk and name_bad (not finite), as arrays.

    Smoothing windows are shorter in short episodes and need the whole episode, so this is a numpy kernel over one
    shuffle. `how` holds the smoothing's parameters (medians, window, degree).
    """
    angular, quaternions = angular or {}, quaternions or {}
    names = list(dict.fromkeys([*keys, *order, *carry]))

    def kernel(table: pa.Table) -> dict:
        out = {n: table[n] for n in names}
        for name, column in vectors.items():
            raw = series(table[column])
            x = smoothing.steady_quaternions(smoothing.unwrap(raw, angular.get(name, ())), quaternions.get(name, ()))
            metrics = smoothing.change_metrics(x, **how) if x.shape[1] else (x, x, x)
            out |= dict(zip((f"{name}_residual", f"{name}_acceleration", f"{name}_jerk"), metrics))
            out[f"{name}_bad"] = ~np.isfinite(raw)
        return out

    schema = ", ".join([*(f"`{f}` {frames.schema[f].dataType.simpleString()}" for f in names), *(f"`{n}_{m}` array<{'boolean' if m == 'bad' else 'double'}>" for n in vectors for m in ("residual", "acceleration", "jerk", "bad"))])
    return per_episode(frames, keys, order, [*carry, *vectors.values()], kernel, schema)


def _sudden(name: str):
    column = lambda metric, i: F.get(f"{name}_{metric}", i)

    def flag(residual: Column, i: Column) -> Column:
        quick = above(column("acceleration", i), column("acceleration_limit", i)) | above(column("jerk", i), column("jerk_limit", i))
        return (above(residual, column("residual_limit", i)) & quick) | column("bad", i)

    return flag


def sudden_changes(metrics: DataFrame, thresholds: DataFrame, group: str, names: Sequence[str]) -> DataFrame:
    """Flags of each vector's places, and the largest ratios of the metrics to their thresholds.

    A place is flagged if its residual and one of acceleration and jerk exceed their thresholds, or if it is not finite.
    thresholds: group and arrays name_residual_limit, name_acceleration_limit, name_jerk_limit by place.
    """
    out = metrics.join(thresholds, group, "left")
    tiny = F.lit(float(np.finfo(float).tiny))
    for n in names:
        out = out.withColumn(f"{n}_flags", F.transform(f"{n}_residual", _sudden(n)))
    for m in ("residual", "acceleration", "jerk"):
        ratio = [F.array_max(F.zip_with(F.col(f"{n}_{m}"), F.col(f"{n}_{m}_limit"), lambda x, y: F.when(finite(x), x / F.greatest(y, tiny)))) for n in names]
        out = out.withColumn(f"max_{m}_ratio", F.greatest(*ratio) if len(ratio) > 1 else ratio[0])
    return out


def interpolate_flagged(table_frames: DataFrame, keys: Sequence[str], order: Sequence[str], vector: str, flag: str, out: str) -> DataFrame:
    """Flagged frames' vectors become the line between unflagged neighbours in every place; unchanged with fewer than two."""
    def kernel(table: pa.Table) -> dict:
        x = series(table[vector])
        bad = np.asarray(pa.compute.fill_null(table[flag], False)).astype(bool)
        t = np.arange(len(x))
        fixed = x.copy()
        if (~bad).sum() >= 2:
            for d in range(x.shape[1]):
                fixed[bad, d] = np.interp(t[bad], t[~bad], x[~bad, d])
        return {n: table[n] for n in [*keys, *order, flag]} | {out: fixed}

    names = list(dict.fromkeys([*keys, *order, flag]))
    schema = ", ".join([*(f"`{f}` {table_frames.schema[f].dataType.simpleString()}" for f in names), f"`{out}` array<double>"])
    return per_episode(table_frames, keys, order, [vector, flag], kernel, schema)


def robust_limits(sample: DataFrame, group: str, vectors: Sequence[str], scale: float, floor: float) -> DataFrame:
    """`stats.robust_thresholds` for whole vectors of a bounded sample: group, feature, dimension, threshold.

    Selecting a few order statistics of arrays with numpy is many times faster than exact percentiles of exploded rows.
    """
    def kernel(table: pa.Table) -> dict:
        out: dict = {group: [], "feature": [], "dimension": [], "threshold": []}
        for name in vectors:
            x = series(table[name])
            x[~np.isfinite(x)] = np.nan
            for d in range(x.shape[1]):
                v = x[~np.isnan(x[:, d]), d]
                limit = None
                if len(v):
                    mid, top = np.quantile(v, [0.5, floor])
                    limit = max(mid + scale * 1.4826 * np.median(np.abs(v - mid)), top, max(float(np.quantile(np.abs(v), 0.99)), 1.0) * 1e-10)
                for k, y in zip(out, (table[group][0].as_py(), name, d, limit)):
                    out[k].append(y)
        return out

    return per_episode(sample, [group], [], vectors, kernel, f"`{group}` {sample.schema[group].dataType.simpleString()}, feature string, dimension int, threshold double")
