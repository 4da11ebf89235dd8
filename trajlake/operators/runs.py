"""Runs of frames: islands, ranges, masks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trajlake.plans.ranks import numbered


def ordered(keys: Sequence[str], order: Sequence[str]):
    return Window.partitionBy(*keys).orderBy(*order)


def merge_ranges(frames: DataFrame, keys: Sequence[str], frame: str = "frame_index") -> DataFrame:
    """Inclusive ranges of neighbouring frames; repeated frames count once, nulls are left out."""
    once = frames.filter(F.col(frame).isNotNull()).select(*keys, frame).distinct()
    islands = once.withColumn("__g", F.col(frame) - F.row_number().over(ordered(keys, [frame])))
    return islands.groupBy(*keys, "__g").agg(F.min(frame).alias("frame_start"), F.max(frame).alias("frame_end"), F.count(F.lit(1)).alias("frames")).drop("__g")


def valid_runs(frames: DataFrame, keys: Sequence[str], order: Sequence[str], valid: str, least: int = 1) -> DataFrame:
    """Runs of valid rows: keys, run number, first and last position (0-based, by order) and length of at least `least`."""
    w = ordered(keys, order)
    rows = frames.withColumn("__p", F.row_number().over(w) - 1).filter(F.coalesce(F.col(valid), F.lit(False)))
    rows = rows.withColumn("__g", F.col("__p") - F.row_number().over(Window.partitionBy(*keys).orderBy("__p")))
    out = rows.groupBy(*keys, "__g").agg(F.min("__p").alias("start"), F.max("__p").alias("stop"), F.count(F.lit(1)).alias("length"))
    return out.filter(F.col("length") >= least).withColumn("run", F.row_number().over(Window.partitionBy(*keys).orderBy("start")) - 1).drop("__g")


def long_runs(frames: DataFrame, keys: Sequence[str], order: Sequence[str], flag: str, least: int, out: str) -> DataFrame:
    """Add `out`: the flag where its run of equal flags has at least `least` rows."""
    w = ordered(keys, order)
    on = F.coalesce(F.col(flag), F.lit(False))
    change = F.when(on == F.coalesce(F.lag(on).over(w), ~on), 0).otherwise(1)
    rows = frames.withColumn("__c", change).withColumn("__g", F.sum("__c").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    size = F.count(F.lit(1)).over(Window.partitionBy(*keys, "__g"))
    return rows.withColumn(out, on & (size >= least)).drop("__c", "__g")


def still_frames(frames: DataFrame, keys: Sequence[str], order: Sequence[str], unchanged: str, least: int, protected: str, out: str) -> DataFrame:
    """Frames of a standstill: `least` - 1 unchanged steps in a row and the frame before them, except protected ones."""
    runs = long_runs(frames, keys, order, unchanged, max(1, least - 1), "__run")
    w = ordered(keys, order)
    return runs.withColumn(out, (F.col("__run") | F.coalesce(F.lead("__run").over(w), F.lit(False))) & ~F.coalesce(F.col(protected), F.lit(False))).drop("__run")


def gripper_moves(frames: DataFrame, keys: Sequence[str], order: Sequence[str], action: str, places: Sequence[int], out: str, least: float = 1e-6) -> DataFrame:
    """Frames on both sides of a change of a gripper's place."""
    w = ordered(keys, order)
    moved = F.lit(False)
    for d in places:
        moved = moved | F.coalesce(F.abs(F.get(action, F.lit(d)) - F.lag(F.get(action, F.lit(d))).over(w)) > least, F.lit(False))
    rows = frames.withColumn("__m", moved)
    return rows.withColumn(out, F.col("__m") | F.coalesce(F.lead("__m").over(w), F.lit(False))).drop("__m")


def causal_validity(keys: Sequence[str], order: Sequence[str], valid: Column) -> Column:
    """Whether this and all earlier rows are valid; null counts as invalid."""
    return F.min(F.coalesce(valid, F.lit(False))).over(ordered(keys, order).rowsBetween(Window.unboundedPreceding, 0))


def loss_mask(causal: Column, slots: Column) -> Column:
    """The slots of a row that may be learned from."""
    return F.transform(slots, lambda s: s & causal)


def encode_runs(frames: DataFrame, keys: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """Run-length encoding: run, value, start and end (exclusive) position, in order; null equals null."""
    w = ordered(keys, order)
    rows = frames.select(*keys, *order, value).withColumn("__p", F.row_number().over(w) - 1)
    same = F.col(value).eqNullSafe(F.lag(value).over(w)) & (F.col("__p") > 0)
    rows = rows.withColumn("__s", F.when(same, 0).otherwise(1)).withColumn("run", F.sum("__s").over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1)
    return rows.groupBy(*keys, "run").agg(F.first(value).alias(value), F.min("__p").alias("start"), (F.max("__p") + 1).alias("stop"))


def survivor_ranks(episodes: DataFrame, keys: Sequence[str], episode: str, accepted: str) -> DataFrame:
    """The number that each accepted episode gets when the others are gone."""
    kept = episodes.filter(F.coalesce(F.col(accepted), F.lit(False)))
    return numbered(kept.select(*keys, episode), [episode], "final_index", keys)


def clamp_intervals(records: DataFrame, frames: str, fps: Column) -> DataFrame:
    """Ranges of mixed records on a timeline of `frames` frames: `frame_start`/`frame_end`, else seconds `time_start`/`time_end`.

    A range without an end is its start, one without a start, or without a timeline, is left out. Ends are drawn to the
    timeline, so that a range beside it becomes its first or last frame, and one that is reversed its start. `offset`,
    where the records have it, is the timeline's first frame in their numbers.
    """
    last = F.greatest(F.col(frames) - 1, F.lit(0))
    offset = F.coalesce("offset", F.lit(0)) if "offset" in records.columns else F.lit(0)
    start = F.coalesce(F.col("frame_start"), F.floor(F.col("time_start") * fps))
    end = F.coalesce(F.col("frame_end"), F.col("frame_start"), F.ceil(F.col("time_end") * fps), start)
    rows = records.filter(start.isNotNull() & F.col(frames).isNotNull())
    rows = rows.withColumns({"frame_start": (start - offset).cast("bigint"), "frame_end": (end - offset).cast("bigint")})
    rows = rows.withColumn("frame_start", F.least(F.greatest("frame_start", F.lit(0)), last).cast("bigint"))
    return rows.withColumn("frame_end", F.least(F.greatest("frame_end", "frame_start"), last).cast("bigint"))


def stage_intervals(records: DataFrame, keys: Sequence[str], frames: str, fps: Column) -> DataFrame:
    """The records' ranges on their timelines, overlapping and neighbouring ones merged: keys, frame_start, frame_end."""
    from trajlake.operators.intervals import periods_and_gaps

    merged = periods_and_gaps(clamp_intervals(records, frames, fps), keys, "frame_start", "frame_end")
    return merged.filter("kind = 'period'").drop("kind")
