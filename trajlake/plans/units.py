"""Planning of conversion work: units, order, offsets, resumption."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajlake.plans.ranks import numbered


def pack(sizes: Sequence[int], groups: Sequence[object], most_items: int, most_size: int) -> list[int]:
    """Unit of each item when neighbours of one group are packed greedily up to both limits; a larger item goes alone."""
    out, unit, items, size = [], -1, 0, 0
    for i, (s, g) in enumerate(zip(sizes, groups)):
        if i == 0 or g != groups[i - 1] or items + 1 > most_items or size + s > most_size:
            unit, items, size = unit + 1, 0, 0
        out.append(unit)
        items, size = items + 1, size + s
    return out


def _packed(plan: DataFrame, partition: str, order: str, group: str | None, most_items: float, most_size: int) -> DataFrame:
    """Add `unit` by `pack` within each partition, as rows arrive in order: a task holds a batch and where it is."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at = kind = None
        unit = items = size = 0
        for pdf in batches:
            out = []
            for p, g, s in zip(pdf[partition].tolist(), pdf[group].tolist() if group else [0] * len(pdf), pdf["frames"].tolist()):
                if p != at or at is None:
                    at, kind, unit, items, size = p, g, 0, 0, 0
                elif g != kind or items + 1 > most_items or size + s > most_size:
                    kind, unit, items, size = g, unit + 1, 0, 0
                out.append(unit)
                items, size = items + 1, size + s
            yield pdf.assign(unit=pd.array(out, "int32"))

    rows = plan.repartition(partition).sortWithinPartitions(partition, order)
    return rows.mapInPandas(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plan.schema) + ", unit int")


def units(episodes: DataFrame, partition: str, group: str, most_episodes: int, most_frames: int) -> DataFrame:
    """Add `unit` to a plan's episodes (partition, episode_index, group, frames): greedy packing in the order of episodes.

    Packing follows one order within a partition, as a stream; partitions are planned side by side.
    """
    return _packed(episodes, partition, "episode_index", group, most_episodes, most_frames)


def whole_groups(groups: DataFrame, partition: str, most_frames: int) -> DataFrame:
    """Add `unit` to phase groups (partition, group_index, frames): whole groups are packed up to a limit."""
    return _packed(groups, partition, "group_index", None, float("inf"), most_frames)


def dispatch_order(work: DataFrame) -> DataFrame:
    """Heaviest first, then by number and key: the order in which workers should take units."""
    return numbered(work, [F.desc("weight"), "unit", "key"], "place").withColumn("place", F.col("place") + 1)


def in_flight(work: DataFrame, workers: int) -> DataFrame:
    """Most memory and disk that so many workers can need at once: the sums of the largest units."""
    top = lambda c: work.select(F.col(c)).orderBy(F.desc(c)).limit(workers).agg(F.coalesce(F.sum(c), F.lit(0)).alias(c))
    return top("memory").crossJoin(top("disk"))


def global_offsets(parts: DataFrame) -> DataFrame:
    """Add the first episode and frame number of each unit, given its episodes and frames."""
    return numbered(parts, ["unit"], "__n", sums={f"first_{c}": c for c in ("episodes", "frames")}).drop("__n")


def first_seen_tasks(episodes: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Tasks numbered in the order in which episodes first name them."""
    first = episodes.filter("task is not null").groupBy(*keys, "task").agg(F.min("episode_index").alias("first_episode"))
    return numbered(first, ["first_episode", "task"], "task_index", keys)


def plan_summary(plan: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Episodes, frames and the sorted distinct tasks of a plan (episode_index, frames, task), for each of the keys."""
    return plan.groupBy(*keys).agg(F.count(F.lit(1)).alias("episodes"), F.coalesce(F.sum("frames"), F.lit(0)).alias("frames"), F.array_sort(F.collect_set("task")).alias("tasks"))


def remaining(plan: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Units whose verified result is not there or belongs to another fingerprint."""
    good = done.filter("status = 'verified'").select(*keys, "fingerprint").distinct()
    return plan.join(good, [*keys, "fingerprint"], "left_anti")


def first_units(plan: DataFrame, unit: str, n: int) -> DataFrame:
    """Episodes of the first n units in the order in which they appear."""
    first = plan.groupBy(unit).agg(F.min("episode_index").alias("__f")).orderBy("__f").limit(n).select(unit)
    return plan.join(F.broadcast(first), unit, "left_semi")


def prefix_sums(values: Iterator[int]) -> list[int]:
    return [0, *accumulate(values)]
