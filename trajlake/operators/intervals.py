"""Continuous periods and the gaps between them (problem 5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trajlake.plans.prefix import cumulative
from trajlake.plans.skew import HOT_PART
from trajlake.plans.storage import cut


#: An entity is hot with more than HOT_PART of all rows (so at most 1/HOT_PART are), and more than so many.
HOT_ROWS = 1 << 16


def periods_and_gaps(rows: DataFrame, keys: Sequence[str], start: str, end: str, levels: int = 2, hot_rows: int = HOT_ROWS) -> DataFrame:
    """One row for each period and each gap between two: keys, kind (`period` or `gap`), start and end, inclusive.

    Starts and ends are sorted independently for each entity. Where the start that is next in rank exceeds the end of
    the current rank by more than 1, nothing covers what is between: a gap. The i-th period runs from the i-th start
    that follows a gap (or is the first) to the i-th end that precedes one (or is the last).

    Entities are ranked within one shuffle by entity, but for the hot ones, which may hold any part of all rows: there
    equal positions count as one row with a number, and ranks are running sums over a tree of position blocks. Rows with
    a null bound or with start after end are left out; keys are compared exactly, null keys form an entity of their own;
    repeated rows change nothing.
    """
    keys = list(keys)
    names = [f"__k{n}" for n in range(len(keys))]
    fine = rows.filter(f"`{start}` <= `{end}`").select(*(F.struct(F.col(f"`{k}`")).alias(n) for k, n in zip(keys, names)), F.col(f"`{start}`").cast("bigint").alias("s"), F.col(f"`{end}`").cast("bigint").alias("e"))
    counts = fine.groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
    total = F.broadcast(counts.agg(F.sum("n").alias("total")))
    hot = cut(counts.filter(F.col("n") > hot_rows).join(total, F.col("n") > F.col("total") * HOT_PART).select(*names))
    out = _within_entities(fine, names)
    if hot.limit(1).count():
        hot = F.broadcast(hot)
        out = _within_entities(fine.join(hot, names, "left_anti"), names).unionByName(_over_blocks(fine.join(hot, names, "left_semi"), names, levels))
    return out.select(*(F.col(n)[k].alias(k) for k, n in zip(keys, names)), "kind", F.col("s").alias(start), F.col("e").alias(end))


def _within_entities(fine: DataFrame, names: list[str]) -> DataFrame:
    """names, kind, s, e; everything after one shuffle by entity, of which a task holds whole ones."""
    sides = fine.select(*names, F.inline(F.array(F.struct(F.lit(1).alias("side"), F.col("s").alias("pos")), F.struct(F.lit(0).alias("side"), F.col("e").alias("pos"))))).repartition(*names)
    # a start stands beside the end of the rank before; before the first start and behind the last end is nothing
    ranked = sides.withColumn("rank", F.row_number().over(Window.partitionBy(*names, "side").orderBy("pos")) - F.col("side"))
    pairs = ranked.groupBy(*names, "rank").agg(F.max(F.when(F.col("side") == 1, F.col("pos"))).alias("next_start"), F.max(F.when(F.col("side") == 0, F.col("pos"))).alias("last_end"))
    edges = pairs.filter("next_start is null or last_end is null or next_start > last_end + 1")
    until = F.lead("last_end").over(Window.partitionBy(*names).orderBy("rank"))
    period = F.when(F.col("next_start").isNotNull(), F.struct(F.lit("period").alias("kind"), F.col("next_start").alias("s"), F.col("until").alias("e")))
    gap = F.when(F.col("next_start").isNotNull() & F.col("last_end").isNotNull(), F.struct(F.lit("gap").alias("kind"), (F.col("last_end") + 1).alias("s"), (F.col("next_start") - 1).alias("e")))
    both = F.filter(F.array(period, gap), lambda x: x.isNotNull())
    return edges.withColumn("until", until).select(*names, F.inline(both))


def _over_blocks(fine: DataFrame, names: list[str], levels: int) -> DataFrame:
    """The same for entities of any size: positions with their numbers, ranked over a tree of blocks."""
    def ranked(side: str) -> DataFrame:
        """Each distinct position with the rank of its last copy."""
        n = cut(fine.groupBy(*names, F.col(side).alias("pos")).agg(F.count(F.lit(1)).alias("n")))  # read for each level of the tree
        return cumulative(n, names, "pos", "n", "rank", levels=levels)

    # a position's first copy follows rank `rank - n`; only the last copy of an end can be followed by a gap
    starts = ranked("s").select(*names, F.col("pos").alias("next_start"), (F.col("rank") - F.col("n")).alias("rank"))
    ends = ranked("e").select(*names, F.col("pos").alias("last_end"), "rank")
    # behind an entity's last end stands an open place instead of a start, before its first start (rank 0) no end
    behind = fine.groupBy(*names).agg(F.count(F.lit(1)).alias("rank")).select(*names, F.lit(None).cast("bigint").alias("next_start"), "rank")
    edges = starts.unionByName(behind).join(ends, [*names, "rank"], "left")
    edges = edges.filter("rank = 0 or last_end is not null and (next_start is null or next_start > last_end + 1)")
    edges = cut(edges)
    numbered = cumulative(edges.withColumn("one", F.lit(1)), names, "rank", "one", "nth", levels=levels)
    begins = numbered.filter("next_start is not null").select(*names, "nth", F.col("next_start").alias("s"))
    stops = numbered.filter("last_end is not null").select(*names, (F.col("nth") - 1).alias("nth"), F.col("last_end").alias("e"))
    periods = begins.join(stops, [*names, "nth"]).select(*names, F.lit("period").alias("kind"), "s", "e")
    gaps = numbered.filter("next_start is not null and last_end is not null").select(*names, F.lit("gap").alias("kind"), (F.col("last_end") + 1).alias("s"), (F.col("next_start") - 1).alias("e"))
    return periods.unionByName(gaps)
