"""Predecessors in an order without a task that holds a whole entity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def previous(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column, payload: str, out: str) -> DataFrame:
    """Add `out`: the `payload` of the row before, among rows of the same keys sorted by `order`; null for the first.

    `bucket` must not fall along the order. Rows are sorted within (keys, bucket) only; the first row of a bucket gets
    the last row of the bucket before, of which there is one row for each bucket.
    """
    keys = list(keys)
    rows = df.withColumn("__b", bucket)
    last = rows.groupBy(*keys, "__b").agg(F.max_by(payload, F.struct(*order)).alias("__l"))
    before = last.withColumn("__p", F.lag("__l").over(Window.partitionBy(*keys).orderBy("__b"))).drop("__l")
    w = Window.partitionBy(*keys, "__b").orderBy(*order)
    rows = rows.withColumn("__n", F.row_number().over(w)).withColumn("__w", F.lag(payload).over(w))
    return rows.join(before, [*keys, "__b"], "left").withColumn(out, F.when(F.col("__n") == 1, F.col("__p")).otherwise(F.col("__w"))).drop("__b", "__n", "__w", "__p")
