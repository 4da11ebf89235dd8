"""Joins that stay balanced when a few keys hold most rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key counts as hot when it has more than this part of all rows, so there are at most 1/HOT_PART of them.
HOT_PART = 1 / 512


def hot_keys(rows: DataFrame, keys: list[str], part: float = HOT_PART) -> DataFrame:
    """The keys with more than `part` of all rows: at most 1/part rows, whatever the input."""
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.join(F.broadcast(total), F.col("n") > F.col("total") * part).select(*keys)


def skew_join(rows: DataFrame, side: DataFrame, keys: list[str], part: float = HOT_PART, hot: DataFrame | None = None) -> DataFrame:
    """Left join of `rows` with `side`, which has at most one row for each key.

    Rows of hot keys meet a broadcast copy of the few side rows of these keys (at most 1/part of them); all other
    rows are shuffled by key, so no task holds more than about `part` of the rows by a single key. Null keys match
    nothing and stay where they are instead of meeting in one task. `rows` is read once for the counts and once for each
    of the three parts, so it should be cheap to read. Where the hot keys are known (`hot`, at most 1/part of them) it is
    not counted.
    """
    cols = [c for c in side.columns if c not in keys]
    hot = (hot_keys(rows.dropna(subset=keys), keys, part) if hot is None else hot.select(*keys)).withColumn("__hot", F.lit(True))
    marked = rows.join(F.broadcast(hot), keys, "left")
    hot_side = side.join(F.broadcast(hot.select(*keys)), keys, "left_semi")
    is_null = F.lit(False)
    for k in keys:
        is_null = is_null | F.col(k).isNull()
    none = marked.filter(is_null).drop("__hot").select("*", *(F.lit(None).cast(side.schema[c].dataType).alias(c) for c in cols))
    rest = marked.filter(~is_null)
    hot_rows = rest.filter("__hot").drop("__hot").join(F.broadcast(hot_side), keys, "left")
    cold = rest.filter("__hot is null").drop("__hot").join(side, keys, "left")
    order = [*rows.columns, *cols]
    return cold.select(*order).unionByName(hot_rows.select(*order)).unionByName(none.select(*order))
