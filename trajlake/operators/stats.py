"""Statistics of signals: robust thresholds, bounds, mergeable summaries, correlation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trajlake.functions.vectors import above, finite, only_finite
from trajlake.plans.prefix import cumulative
from trajlake.plans.storage import cut

#: Frames of one group that a calibration looks at, spread evenly over its frames; so an exact quantile stays bounded.
SAMPLES = 200_000


def _places(name: str, column: str) -> Column:
    def place(x: Column, i: Column) -> Column:
        return F.struct(F.lit(name).alias("feature"), i.cast("int").alias("dimension"), x.alias("value"))

    return F.coalesce(F.transform(F.col(column).cast("array<double>"), place), F.array().cast("array<struct<feature:string,dimension:int,value:double>>"))


def explode_places(frames: DataFrame, keep: Sequence[str], features: dict[str, str]) -> DataFrame:
    """Long form: feature, dimension (0-based) and value, for each place of the named vectors; null vectors have none.

    All vectors of a row are exploded at once, so the input is read once.
    """
    every = [_places(n, c) for n, c in features.items()]
    return frames.select(*keep, F.inline(F.concat(*every) if len(every) > 1 else every[0]))


def stride_sample(frames: DataFrame, group: str, episode: str, order: Sequence[str], capacity: int = SAMPLES, counted: DataFrame | None = None) -> DataFrame:
    """Every n-th frame of a group in the order of episodes and frames, with n the least that keeps `capacity` at most.

    Positions come from running sums over the counts of episodes, never from one ordering of all frames. A group of up
    to `capacity` frames is kept whole. `counted` is a cheaper table with the same rows to count.
    """
    counts = cut((frames if counted is None else counted).groupBy(group, episode).agg(F.count(F.lit(1)).alias("__n")))
    upto = cumulative(counts, [group], episode, "__n", "__upto")
    total = counts.groupBy(group).agg(F.sum("__n").alias("__total"))
    place = upto.join(total, group).select(group, episode, (F.col("__upto") - F.col("__n")).alias("__off"), F.greatest(F.lit(1), F.ceil(F.col("__total") / capacity)).alias("__stride"))
    rank = F.row_number().over(Window.partitionBy(group, episode).orderBy(*order)) - 1
    rows = frames.withColumn("__r", rank).join(place, [group, episode])
    return rows.filter((F.col("__off") + F.col("__r")) % F.col("__stride") == 0).drop("__r", "__off", "__stride")


def robust_thresholds(values: DataFrame, keys: Sequence[str], value: str, scale: float = 8.0, floor: float = 0.999) -> DataFrame:
    """For each key the largest of median + scale * 1.4826 * MAD, the `floor` quantile and 1e-10 of the usual size.

    NaN, infinite and null values are left out; a key without others has a null threshold. Quantiles are exact and
    interpolated, so `values` should be a sample of bounded size.
    """
    rows = values.select(*keys, only_finite(F.col(value)).alias("v"))
    # medians ignore NaN only; an infinite value is bad input here and left out as well
    mid = rows.groupBy(*keys).agg(F.percentile("v", F.lit(0.5)).alias("mid"), F.percentile("v", F.lit(floor)).alias("top"), F.percentile(F.abs("v"), F.lit(0.99)).alias("size"))
    spread = rows.join(mid.select(*keys, "mid"), [*keys]).groupBy(*keys).agg(F.percentile(F.abs(F.col("v") - F.col("mid")), F.lit(0.5)).alias("mad"))
    return mid.join(spread, [*keys], "left").select(*keys, F.when(F.col("mid").isNotNull(), F.greatest(F.col("mid") + scale * 1.4826 * F.col("mad"), "top", F.greatest(F.col("size"), F.lit(1.0)) * 1e-10)).alias("threshold"))


def quantile_bounds(values: DataFrame, keys: Sequence[str], value: str, low: float = 0.01, high: float = 0.99, alpha: float = 0.0) -> DataFrame:
    """q_low and q_high of the finite values, and both widened by `alpha` of their distance."""
    q = F.percentile(only_finite(F.col(value)), F.array(F.lit(low), F.lit(high)))
    out = values.groupBy(*keys).agg(q.alias("q"))
    width = F.col("q")[1] - F.col("q")[0]
    return out.select(*keys, F.col("q")[0].alias("q_low"), F.col("q")[1].alias("q_high"), (F.col("q")[0] - alpha * width).alias("lower"), (F.col("q")[1] + alpha * width).alias("upper"))


def component_statistics(values: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Least and largest finite value, and the numbers of values, NaN and infinities."""
    v = F.col(value)
    inf = float("inf")
    return values.groupBy(*keys).agg(
        F.min(only_finite(v)).alias("least"), F.max(only_finite(v)).alias("most"), F.count(F.lit(1)).alias("values"), F.count_if(finite(v)).alias("finite"), F.count_if(F.isnan(v)).alias("nan"), F.count_if(v == F.lit(inf)).alias("plus_inf"), F.count_if(v == F.lit(-inf)).alias("minus_inf")
    )


def merge_component_statistics(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sum of partial `component_statistics`; a part without finite values adds no bounds."""
    return parts.groupBy(*keys).agg(F.min("least").alias("least"), F.max("most").alias("most"), *(F.sum(c).alias(c) for c in ("values", "finite", "nan", "plus_inf", "minus_inf")))


def episode_statistics(values: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Count, bounds, mean, population deviation and quantiles of finite values, for each episode and dimension."""
    v = only_finite(F.col(value))
    q = F.percentile(v, F.array(*(F.lit(x) for x in (0.01, 0.5, 0.99))))
    return values.groupBy(*keys).agg(F.count(v).alias("n"), F.min(v).alias("least"), F.max(v).alias("most"), F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"), q.alias("q")).select(*keys, "n", "least", "most", "mean", "std", F.col("q")[0].alias("q01"), F.col("q")[1].alias("q50"), F.col("q")[2].alias("q99"))


def pool_statistics(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Count, bounds, mean and deviation of the union of parts (n, least, most, mean, std); empty parts count nothing."""
    some = parts.filter("n > 0")
    total = some.groupBy(*keys).agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("mean"))
    # about the mean of all, as squares of large readings would cancel
    apart = some.select(*keys, F.col("n").alias("__n"), F.col("mean").alias("__mean"), F.col("std").alias("__std")).join(total.select(*keys, "mean"), [*keys])
    std = apart.groupBy(*keys).agg(F.sqrt(F.sum(F.col("__n") * (F.pow("__std", F.lit(2)) + F.pow(F.col("__mean") - F.col("mean"), F.lit(2)))) / F.sum("__n")).alias("std"))
    return total.join(std, [*keys])


def guarded_correlation(pairs: DataFrame, keys: Sequence[str], a: str, b: str) -> DataFrame:
    """Pearson's correlation over pairs of finite values, centred first; minus infinity for fewer than 3 or no spread."""
    ok = pairs.filter(finite(F.col(a)) & finite(F.col(b)))
    mean = ok.groupBy(*keys).agg(F.avg(a).alias("__ma"), F.avg(b).alias("__mb"), F.count(F.lit(1)).alias("__n"))
    x, y = F.col(a) - F.col("__ma"), F.col(b) - F.col("__mb")
    sums = ok.join(mean, [*keys]).groupBy(*keys).agg(F.first("__n").alias("pairs"), F.sum(x * y).alias("__xy"), F.sqrt(F.sum(x * x)).alias("__xx"), F.sqrt(F.sum(y * y)).alias("__yy"))
    fine = (F.col("pairs") >= 3) & (F.col("__xx") * F.col("__yy") > 1e-15)
    every = pairs.select(*keys).distinct()
    value = F.when(fine, F.try_divide(F.col("__xy"), F.col("__xx") * F.col("__yy"))).otherwise(F.lit(float("-inf")))
    return every.join(sums, [*keys], "left").select(*keys, F.coalesce("pairs", F.lit(0)).alias("pairs"), F.coalesce(value, F.lit(float("-inf"))).alias("correlation"))


def offset_statistics(offsets: DataFrame, keys: Sequence[str], x: str = "x", y: str = "y", z: str = "z") -> DataFrame:
    """Median offset on each axis, its length, and the summed variance of the offsets about it."""
    mid = offsets.groupBy(*keys).agg(*(F.percentile(c, F.lit(0.5)).alias(f"m{n}") for n, c in enumerate((x, y, z))), *(F.var_pop(c).alias(f"v{n}") for n, c in enumerate((x, y, z))))
    return mid.select(*keys, "m0", "m1", "m2", F.sqrt(F.col("m0") ** 2 + F.col("m1") ** 2 + F.col("m2") ** 2).alias("length"), (F.col("v0") + F.col("v1") + F.col("v2")).alias("variance"))


def range_violations(rows: DataFrame, bounds: dict[str, tuple[float, float]], position: str) -> DataFrame:
    """For each column with a value that is not finite or outside its bounds: how many, and the first by position."""
    out = None
    for name, (low, high) in bounds.items():
        v = F.col(f"`{name}`").cast("double")
        bad = ~finite(v) | above(v, F.lit(float(high))) | above(F.lit(float(low)), v)
        part = rows.filter(bad & v.isNotNull()).agg(F.count(F.lit(1)).alias("violations"), F.min(position).alias("first"), F.min_by(v, position).alias("value")).withColumn("field", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out.filter("violations > 0")
