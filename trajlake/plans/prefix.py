"""Running sums and ranks over positions without a task that holds a whole entity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Bits of the position that one level of the tree covers: a window partition has at most 2**12 rows a level.
BITS = 12


def cumulative(df: DataFrame, keys: Sequence[str], pos: str, value: str, out: str, *, levels: int = 2, bits: int = BITS) -> DataFrame:
    """Add `out`, the sum of `value` over all rows of the same keys whose `pos` is not larger.

    df has one row for each (keys, pos); pos is an integer. Positions form a tree: sums within blocks of 2**bits
    positions, then over the blocks of a wider block, and so on for `levels` levels, the last of which runs over what
    is left of an entity. So the largest window partition has 2**bits rows as long as an entity's positions span less
    than 2**(bits * (levels + 1)); beyond that only the last level grows.
    """
    keys = list(keys)
    block = lambda n: F.shiftright(F.col(pos).cast("bigint"), bits * n)
    base = df.withColumn("__b1", block(1))
    inner = Window.partitionBy(*keys, "__b1").orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    base = base.withColumn("__c0", F.sum(value).over(inner))
    sums = base.groupBy(*keys, "__b1").agg(F.sum(value).alias("__s"))
    before = None
    for level in range(1, levels + 1):
        this, wider = f"__b{level}", f"__b{level + 1}"
        last = level == levels
        frame = sums if last else sums.withColumn(wider, F.shiftright(F.col(this), bits))
        part = keys if last else [*keys, wider]
        w = Window.partitionBy(*part).orderBy(this).rowsBetween(Window.unboundedPreceding, -1)
        frame = frame.withColumn(f"__o{level}", F.coalesce(F.sum("__s").over(w), F.lit(0)))
        nxt = None if last else frame.groupBy(*part).agg(F.sum("__s").alias("__s"))
        frame = frame.drop("__s")
        before = frame if before is None else before.join(frame, [*keys, this])
        sums = nxt
    offset = sum((F.col(f"__o{n}") for n in range(1, levels + 1)), F.lit(0))
    before = before.select(*keys, "__b1", offset.alias("__off"))
    return base.join(before, [*keys, "__b1"]).withColumn(out, F.col("__c0") + F.col("__off")).drop("__b1", "__c0", "__off")
