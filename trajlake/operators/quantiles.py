"""Exact quantiles of the places of vectors over all rows, without bringing a group's rows together.

Doubles become whole numbers in the same order. A first pass counts their upper bits by group and place, the next ones
further bits below the upper bits that hold a wanted rank, the last all bits. So the counts of a place are at most 2**16 in
the first pass, 2**24 for each rank in the second, and few in the last. Counts are summed in shuffles; the driver gets one
row for each group, place and rank.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trajlake.plans.ordered import previous
from trajlake.plans.storage import cut

#: Bits left out by each pass; the first counts sign, exponent and 4 bits of the mantissa.
SHIFTS = (48, 24, 0)
#: Counts that a task holds before it merges them.
HELD = 1 << 20
_KEY = ["view", "grp", "feature", "dimension"]
_COUNTS = "view int, grp string, feature string, dimension int, part bigint, n bigint"
Key = tuple[str | None, str, int]


def _ladder(v: np.ndarray) -> np.ndarray:
    """Doubles as whole numbers in the same order; both zeros are one."""
    b = (v + 0.0).view(np.int64)
    return b ^ ((b >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))


def _value(u: int) -> float:
    b = np.array([u], np.int64)
    return float((b ^ ((b >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))).view(np.float64)[0])


def _counter(names: Sequence[str], views: Sequence[Callable | dict], open_: dict | None, above: int, shift: int) -> Callable:
    """Counts of the parts of a split; views are functions of the values, or {key: centre} for distances to a centre."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: dict[tuple, int] = {}
        held: list[np.ndarray] = []
        size = 0

        def merged() -> np.ndarray:
            a = np.concatenate(held)
            order = np.lexsort((a[:, 1], a[:, 0]))
            a = a[order]
            first = np.flatnonzero(np.r_[True, (a[1:, 0] != a[:-1, 0]) | (a[1:, 1] != a[:-1, 1])])
            return np.column_stack([a[first, :2], np.add.reduceat(a[:, 2], first)])

        def batch_of(a: np.ndarray) -> pa.RecordBatch:
            view, grp, feature, dimension = zip(*keys)
            own = pa.array(a[:, 0])
            named = [pa.array(c, k).take(own) for c, k in ((view, pa.int32()), (grp, pa.string()), (feature, pa.string()), (dimension, pa.int32()))]
            return pa.RecordBatch.from_arrays([*named, pa.array(a[:, 1]), pa.array(a[:, 2])], [*_KEY, "part", "n"])

        for b in batches:
            if not b.num_rows:
                continue
            coded = b.column(0).dictionary_encode("encode")
            groups = coded.dictionary.to_pylist()
            of_row = np.asarray(coded.indices)
            for f, name in enumerate(names):
                column = b.column(f + 1)
                row = np.asarray(pc.list_parent_indices(column))
                if not len(row):
                    continue
                v = np.asarray(pc.fill_null(pc.list_flatten(column), float("nan")))
                first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
                dim = np.arange(len(row)) - np.repeat(first, np.diff(np.r_[first, len(row)]))
                width = int(dim.max()) + 1
                local = of_row[row] * width + dim
                for i, view in enumerate(views):
                    if isinstance(view, dict):
                        centre = np.array([np.nan if (c := view.get((g, name, d))) is None else c for g in groups for d in range(width)])
                        x = np.abs(v - centre[local])
                    else:
                        x = view(v)
                    ok = np.isfinite(x)
                    u, at = _ladder(x[ok]), local[ok]
                    if open_ is None:
                        # place and upper bits as one number, counted at once
                        bits = 64 - shift
                        pair, n = np.unique((at << bits) | ((u >> shift) + (1 << (bits - 1))), return_counts=True)
                        seen = np.unique(local)  # a place without finite values is known as well
                        u, at, n = np.r_[(pair & ((1 << bits) - 1)) - (1 << (bits - 1)), np.zeros(len(seen), np.int64)], np.r_[pair >> bits, seen], np.r_[n, np.zeros(len(seen), np.int64)]
                    else:
                        wanted = [open_.get((i, g, name, d), ()) for g in groups for d in range(width)]
                        most = max(map(len, wanted))
                        if not most:
                            continue
                        none = np.iinfo(np.int64).min
                        table = np.array([[*w, *[none] * (most - len(w))] for w in wanted], np.int64)
                        hit = np.zeros(len(u), bool)
                        for r in range(most):
                            hit |= (u >> above) == table[at, r]
                        u, at = u[hit] >> shift, at[hit]
                        n = np.ones(len(u), np.int64)
                    if not len(u):
                        continue
                    code = np.array([keys.setdefault((i, g, name, d), len(keys)) for g in groups for d in range(width)], np.int64)
                    held.append(np.column_stack([code[at], u, n]))
                    size += len(u)
            if size > HELD:
                held = [merged()]
                size = len(held[0])
                if size > HELD // 2:
                    yield batch_of(held[0])
                    held, size = [], 0
        if held:
            yield batch_of(merged())

    return run


def exact_quantiles(rows: DataFrame, group: str, vectors: Sequence[str], views: Sequence[tuple[Callable | dict, Sequence[float]]]) -> list[dict[Key, list[float] | None]]:
    """For each view, {(group, vector, place): its quantiles}, exact and interpolated, over the finite values of all rows.

    A view is what to make of the values, with its probabilities: a numpy function, or {key: centre} for distances to a
    centre. Places without finite values have None; null vectors have no places. `rows` is read once for each pass.
    """
    source = rows.select(F.col(group).cast("string"), *(F.col(v).cast("array<double>") for v in vectors))
    made = [v for v, _ in views]
    count = lambda open_, above, shift: cut(source.mapInArrow(_counter(vectors, made, open_, above, shift), _COUNTS).groupBy(*_KEY, "part").agg(F.sum("n").alias("n")))
    counts = count(None, 64, SHIFTS[0])
    totals = {tuple(r[k] for k in _KEY): r["n"] for r in counts.groupBy(*_KEY).agg(F.sum("n").alias("n")).collect()}  # a row for each place
    place = lambda k, n: [float(p) * (n - 1) for p in views[k[0]][1]]
    wanted = [(*k, 0, r, r) for k, n in totals.items() if n for r in sorted({i for x in place(k, n) for i in (int(np.floor(x)), int(np.ceil(x)))})]
    by_rank: dict[tuple, int] = {}
    spark = rows.sparkSession
    same = lambda a, b, names: [a[c].eqNullSafe(b[c]) for c in names]
    for level, shift in enumerate(SHIFTS if wanted else ()):
        if level:
            open_: dict = defaultdict(set)
            for r in wanted:
                open_[r[:4]].add(r[4])
            counts = count({k: sorted(p) for k, p in open_.items()}, SHIFTS[level - 1], shift)
        # ranks are looked for within the part that holds them
        upper = F.shiftright("part", SHIFTS[level - 1] - shift) if level else F.lit(0).cast("bigint")
        parts = counts.filter("n > 0").withColumn("upper", upper).withColumn("upto", F.sum("n").over(Window.partitionBy(*_KEY, "upper").orderBy("part")))
        seek = F.broadcast(spark.createDataFrame(wanted, "view int, grp string, feature string, dimension int, upper bigint, rank bigint, inside bigint"))  # a row for each place and rank
        hit = parts.join(seek, same(parts, seek, [*_KEY, "upper"])).filter("upto > inside and upto - n <= inside").select(*(parts[c] for c in _KEY), "part", "rank", (F.col("inside") - (F.col("upto") - F.col("n"))).alias("inside")).collect()
        wanted = [(*(r[k] for k in _KEY), r["part"], r["rank"], r["inside"]) for r in hit]
    by_rank = {(*r[:4], r[5]): _value(r[4]) for r in wanted}
    out: list[dict[Key, list[float] | None]] = [{} for _ in views]
    for k, n in totals.items():
        out[k[0]][k[1:]] = [_between(by_rank, k, x) for x in place(k, n)] if n else None
    return out


def _between(by_rank: dict[tuple, float], key: tuple, x: float) -> float:
    a, b = by_rank[*key, int(np.floor(x))], by_rank[*key, int(np.ceil(x))]
    return a if a == b else (np.ceil(x) - x) * a + (x - np.floor(x)) * b


def quantile_bounds(rows: DataFrame, group: str, vectors: Sequence[str], low: float = 0.01, high: float = 0.99, alpha: float = 0.0) -> DataFrame:
    """group, feature, dimension, q_low and q_high of the finite values of all rows, and both widened by `alpha` of their distance."""
    (q,) = exact_quantiles(rows, group, vectors, [(_plain, (low, high))])
    found = [(g, f, d, *((float(x[0]), float(x[1]), float(x[0] - alpha * (x[1] - x[0])), float(x[1] + alpha * (x[1] - x[0]))) if x else (None,) * 4)) for (g, f, d), x in q.items()]
    return rows.sparkSession.createDataFrame(found, f"`{group}` string, feature string, dimension int, q_low double, q_high double, lower double, upper double")


def robust_limits(rows: DataFrame, group: str, vectors: Sequence[str], scale: float = 8.0, floor: float = 0.999, positive: bool = False) -> DataFrame:
    """`stats.robust_thresholds` of the places of whole vectors over all rows: group, feature, dimension, threshold.

    Values that are `positive` are their own sizes and need to be counted once only.
    """
    if positive:
        (q,) = exact_quantiles(rows, group, vectors, [(_plain, (0.5, floor, 0.99))])
        size = {k: x and x[2:] for k, x in q.items()}
    else:
        q, size = exact_quantiles(rows, group, vectors, [(_plain, (0.5, floor)), (np.abs, (0.99,))])
    (mad,) = exact_quantiles(rows, group, vectors, [({k: x[0] for k, x in q.items() if x}, (0.5,))])
    found = [(*k, float(max(x[0] + scale * 1.4826 * mad[k][0], x[1], max(size[k][0], 1.0) * 1e-10)) if x else None) for k, x in q.items()]
    return rows.sparkSession.createDataFrame(found, f"`{group}` string, feature string, dimension int, threshold double")


def offset_statistics(rows: DataFrame, group: str, vector: str) -> DataFrame:
    """group, medians m0, m1, m2 of a vector's three finite places, their length, and the summed variance, over all rows."""
    (mid,) = exact_quantiles(rows, group, [vector], [(_plain, (0.5,))])
    by_group = defaultdict(lambda: [None] * 3)
    for (g, _, d), x in mid.items():
        by_group[g][d] = float(x[0]) if x else None
    found = rows.sparkSession.createDataFrame([(g, *m) for g, m in by_group.items()], f"`{group}` string, m0 double, m1 double, m2 double")
    spread = rows.groupBy(group).agg(sum((F.var_pop(F.get(vector, F.lit(d))) for d in range(3)), F.lit(0.0)).alias("variance"))
    return found.join(spread, group).select(group, "m0", "m1", "m2", F.sqrt(F.col("m0") ** 2 + F.col("m1") ** 2 + F.col("m2") ** 2).alias("length"), "variance")


#: Stands for infinity where infinite values count; results beyond LARGE are infinite.
_HUGE, LARGE = float(np.finfo(float).max), 1e300


def with_infinities(v: np.ndarray) -> np.ndarray:
    """A view that counts infinite values."""
    return np.clip(v, -_HUGE, _HUGE)


def infinite(x: float | None) -> float | None:
    """A quantile of that view."""
    return None if x is None else float(x) if abs(x) < LARGE else float(np.copysign(np.inf, x))


def fps_from_timestamps(rows: DataFrame, group: str, time: str, order: str) -> DataFrame:
    """Frames a second from rising times in s, ms, us or ns: the unit in which the median step gives 1 to 240 of them.

    fps is null, and `problem` says why, for fewer than two times, times that do not rise, an implausible step, or steps
    whose 95th percentile differs from the median by more than a tenth. `order` is a whole number without ties; steps are
    taken within blocks of it and quantiles over all rows, so a group may hold any part of them.
    """
    named = rows.select(F.col(group).cast("string").alias("g"), F.col(order).cast("bigint").alias("o"), F.col(time).cast("double").alias("t"))
    steps = cut(previous(named, ["g"], ["o"], F.shiftright("o", 12), "t", "before").select("g", F.array(F.col("t") - F.col("before")).alias("d")).filter("d[0] is not null"))
    (mid,) = exact_quantiles(steps, "g", ["d"], [(_plain, (0.5,))])
    (late,) = exact_quantiles(steps, "g", ["d"], [({k: x[0] for k, x in mid.items() if x}, (0.95,))]) if mid else ({},)
    found = rows.sparkSession.createDataFrame([(k[0], float(x[0]), float(late[k][0])) for k, x in mid.items() if x], "g string, mid double, jitter double")
    each = steps.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min(F.col("d")[0]).alias("least"))
    s = named.select("g").distinct().join(each, "g", "left").join(found, "g", "left")
    unit = F.lit(None).cast("double")
    for u in (1.0, 1e3, 1e6, 1e9):
        unit = F.coalesce(unit, F.when(F.try_divide(F.lit(u), F.col("mid")).between(1, 240), F.lit(u)))
    s = s.withColumn("unit", F.when(F.col("mid") > 0, unit))
    problem = F.when(F.coalesce("n", F.lit(0)) < 1, "too_few").when(F.col("least") <= 0, "not_rising").when(F.col("unit").isNull(), "implausible").when(F.col("jitter") > 0.1 * F.col("mid"), "jitter")
    return s.select(F.col("g").cast(rows.schema[group].dataType).alias(group), F.when(problem.isNull(), F.col("unit") / F.col("mid")).alias("fps"), problem.alias("problem"))


def fps_consensus(rates: DataFrame, group: str, fps: str) -> DataFrame:
    """group and the whole number of frames a second that all its cameras agree on within 2 percent; null where they do not.

    The median is exact over all rows, without a task that holds a group.
    """
    rows = rates.select(group, F.array(F.col(fps).cast("double")).alias("fps"))
    (mid,) = exact_quantiles(rows, group, ["fps"], [(_plain, (0.5,))])
    found = rates.sparkSession.createDataFrame([(g, float(x[0])) for (g, _, _), x in mid.items() if x], f"`{group}` string, mid double")
    span = rates.groupBy(group).agg(F.min(fps).alias("least"), F.max(fps).alias("most")).join(found, group)
    whole = F.rint("mid")
    agree = (F.col("most") <= F.col("mid") * 1.02) & (F.col("least") >= F.col("mid") * 0.98) & (whole > 0) & (F.abs(F.col("mid") - whole) <= 0.02 * whole)
    return span.select(group, F.when(agree, whole.cast("int")).alias("fps"))


def _plain(v: np.ndarray) -> np.ndarray:
    return v
