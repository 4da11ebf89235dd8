"""Positions and running sums in an order over all rows, without a task that holds them all."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trajlake.plans.skew import skew_join
from trajlake.plans.storage import cut


def numbered(df: DataFrame, order: Sequence[Column | str], out: str, keys: Sequence[str] = (), sums: dict[str, str] | None = None) -> DataFrame:
    """Add `out`, each row's 0-based position in an order, and for each name in `sums` the sum of a column over the rows before.

    With keys both begin anew for each of them; equal keys may lie in many partitions, null equals null. Rows are sorted
    by range over all tasks, the driver gets one row for each partition, and offsets come back by broadcast. The order
    should have no ties, or tied rows are numbered in any order.
    """
    sums = sums or {}
    by = [*(F.col(k) for k in keys), *(F.col(c) if isinstance(c, str) else c for c in order)]
    rows = cut(df.repartitionByRange(*by).sortWithinPartitions(*by)).withColumn("__p", F.spark_partition_id()).withColumn("__r", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    parts = rows.groupBy("__p").agg(F.count(F.lit(1)).alias("n"), *(F.coalesce(F.sum(c), F.lit(0)).alias(name) for name, c in sums.items())).orderBy("__p").collect()
    before = [[0, *accumulate(r[c] for r in parts)] for c in ("n", *sums)]
    kinds = ["bigint", *("double" if any(isinstance(r[c], float) for r in parts) else "bigint" for c in sums)]
    offsets = df.sparkSession.createDataFrame([(r["__p"], *(b[i] for b in before)) for i, r in enumerate(parts)], ", ".join(["__p int", *(f"__b{i} {k}" for i, k in enumerate(kinds))]))
    placed = rows.join(F.broadcast(offsets), "__p").withColumn(out, F.col("__r") + F.col("__b0"))
    if sums:
        w = Window.partitionBy("__p").orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)
        placed = placed.withColumns({name: F.coalesce(F.sum(c).over(w), F.lit(0)) + F.col(f"__b{i}") for i, (name, c) in enumerate(sums.items(), 1)})
    placed = placed.select(*df.columns, out, *sums)
    if not keys:
        return placed
    placed = placed.withColumn("__k", F.struct(*keys))
    first = placed.groupBy("__k").agg(F.min(out).alias("__first"), *(F.min_by(name, out).alias(f"__s{i}") for i, name in enumerate(sums)))
    inside = skew_join(placed, first, ["__k"])
    return inside.select(*df.columns, (F.col(out) - F.col("__first")).alias(out), *((F.col(name) - F.col(f"__s{i}")).alias(name) for i, name in enumerate(sums)))
