"""Mask-based curation: three stages that label frames and episodes and never change data."""

from __future__ import annotations

import json
import os
import shutil
import time
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field, replace
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trajlake.functions.scalars import canonical_json_text, merge_layers
from trajlake.functions.vectors import any_of, beyond, failed_places, masked
from trajlake.operators import quantiles, signals, stats, trend
from trajlake.operators.intervals import periods_and_gaps
from trajlake.plans.ordered import previous
from trajlake.plans.storage import cut, exists, read_text, write_text

VECTORS = ("state", "action")
REASONS = {1: "stage1_sudden_change", 2: "state_action_trend_mismatch", 3: "stage3_extreme_value"}


@dataclass(frozen=True)
class Config:
    """Parameters of the three stages; `exempt` are 0-based places of grippers by vector, None for the last place.

    `pairs` are comparable places of state and action, the same for all; `positional` allows equal places where neither
    they nor names tell. `samples` has no effect: thresholds come from all frames.
    """

    exclusion: str = "frame"
    medians: tuple[int, ...] = (5, 5)
    window: int = 11
    degree: int = 3
    mad_scale: float = 8.0
    quantile_floor: float = 0.999
    agreement: float = 0.65
    lag_seconds: float = 0.5
    least_active: int = 10
    alpha: float = 0.1
    samples: int = stats.SAMPLES
    fps: float = 30.0
    action_mode: str = "absolute"
    pairs: tuple[tuple[int, int], ...] | None = None
    positional: bool = False
    exempt: dict[str, tuple[int, ...]] | None = None
    angular: dict[str, tuple[int, ...]] = field(default_factory=dict)
    quaternions: dict[str, tuple[tuple[int, ...], ...]] = field(default_factory=dict)

    @classmethod
    def layered(cls, *layers: dict) -> Config:
        """Defaults under each layer in turn; unknown names are an error."""
        merged = merge_layers(*layers)
        unknown = merged.keys() - cls.__dataclass_fields__.keys()
        if unknown:
            raise ValueError(f"unknown settings: {sorted(unknown)}")
        return replace(cls(), **merged)


KEYS, ORDER = ["dataset_uid", "episode_index"], ["frame_index"]
STEP = [*KEYS, *ORDER]


def _exempt(cfg: Config, name: str) -> Column:
    if cfg.exempt is None:
        return F.array(F.size(name) - 1)
    return F.array(*(F.lit(int(i)) for i in cfg.exempt.get(name, ()))).cast("array<int>")


def _limits(values: DataFrame, group: str, columns: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Long (group, feature, dimension, columns) to one row for each group with arrays feature_column by place."""
    arrays = values.groupBy(group, "feature").agg(F.sort_array(F.collect_list(F.struct("dimension", *columns))).alias("b"))
    wide = arrays.groupBy(group).pivot("feature", list(names)).agg(F.first("b"))
    return wide.select(group, *(F.col(f"`{n}`.`{c}`").alias(f"{n}_{c}" if len(columns) > 1 else n) for n in names for c in columns))


def stage1(frames: DataFrame, cfg: Config = Config()) -> dict[str, DataFrame]:
    """Sudden changes: thresholds, frame_flags, episode_summary, episode_filter, step_validity.

    frames: dataset_uid, episode_index, frame_index, index, state, action. Frames without either vector are kept out of
    the metrics and are invalid. Thresholds come from all other frames of each dataset.
    """
    both = frames.filter("state is not null and action is not null")
    metrics = signals.change_metrics(both, KEYS, ORDER, {v: v for v in VECTORS}, carry=["index"], angular=cfg.angular, quaternions=cfg.quaternions, medians=cfg.medians, window=cfg.window, degree=cfg.degree)
    names = [f"{v}_{m}" for v in VECTORS for m in ("residual", "acceleration", "jerk")]
    metrics = cut(metrics)
    thresholds = quantiles.robust_limits(metrics, "dataset_uid", names, cfg.mad_scale, cfg.quantile_floor, positive=True)
    limits = _limits(thresholds, "dataset_uid", ["threshold"], names).select("dataset_uid", *(F.col(n).alias(f"{n}_limit") for n in names))
    flags = signals.sudden_changes(metrics, limits, "dataset_uid", VECTORS)
    flagged = flags.withColumn("flagged_frame", any_of(F.col("state_flags")) | any_of(F.col("action_flags")))
    labelled = frames.select(*STEP, "index").join(flagged.select(*STEP, "flagged_frame", *(failed_places(F.col(f"{v}_flags")).alias(f"failed_{v}_dimensions") for v in VECTORS), *(f"max_{m}_ratio" for m in ("residual", "acceleration", "jerk"))), STEP, "left")
    labelled = cut(labelled.withColumn("flagged_frame", F.coalesce("flagged_frame", F.lit(True))))
    whole = cfg.exclusion == "episode"
    summary = labelled.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("num_frames"), F.count_if("flagged_frame").alias("flagged_frames"))
    reject = (F.col("flagged_frames") > 0) & F.lit(whole)
    summary = summary.withColumn("valid_frames", F.when(reject, 0).otherwise(F.col("num_frames") - F.col("flagged_frames"))).withColumn("flag_fraction", F.col("flagged_frames") / F.greatest("num_frames", F.lit(1))).withColumn("exclusion_policy", F.lit(cfg.exclusion)).withColumn("reject_episode", reject)
    rejected = summary.select(*KEYS, "reject_episode")
    steps = labelled.join(rejected, KEYS)
    valid = ~F.col("flagged_frame") & ~F.col("reject_episode")
    reasons = F.filter(F.array(F.when(F.col("flagged_frame"), REASONS[1]), F.when(F.col("reject_episode"), "stage1_episode_rejected")), lambda r: r.isNotNull())
    validity = steps.select(*STEP, "index", valid.alias("stage1_valid"), F.lit(True).alias("stage2_valid"), F.lit(True).alias("stage3_valid"), valid.alias("valid"), reasons.alias("reason_codes"))
    filter_ = summary.select(*KEYS, "num_frames", (~F.col("reject_episode")).alias("accepted"), F.when(F.col("reject_episode"), REASONS[1]).alias("reason_code"))
    return {"thresholds": thresholds, "frame_flags": labelled.filter("flagged_frame"), "episode_summary": summary, "episode_filter": filter_, "step_validity": validity}


def _pairs_of(frames: DataFrame, cfg: Config, mapping: DataFrame | None) -> DataFrame | list[tuple[int, int]] | None:
    """The pairs of stage 2 without grippers; an error where there are none to trust."""
    gripper = lambda side: [int(i) for i in (cfg.exempt or {}).get(side, ())]
    if cfg.pairs is not None:
        wide = frames.agg(F.max(F.size("state")), F.max(F.size("action"))).first()
        if any(not 0 <= i < (n or 0) for p in cfg.pairs for i, n in zip(p, wide)):
            raise ValueError("pairs of places lie outside the vectors")
        trend.fixed_pairs(cfg.pairs)
        return [(s, a) for s, a in cfg.pairs if s not in gripper("state") and a not in gripper("action")]
    named = None
    if mapping is not None:
        fine = mapping.filter(~F.col("state_dimension").isin(*gripper("state"), -1) & ~F.col("action_dimension").isin(*gripper("action"), -1))
        named = trend.mapped_pairs(fine, ["dataset_uid"])
    if not cfg.positional:
        every = frames.select("dataset_uid").distinct()
        bare = (every if named is None else every.join(named, "dataset_uid", "left_anti")).limit(5).collect()
        if bare:
            raise ValueError(f"no comparable places of state and action in {[r[0] for r in bare]}: give pairs or names, or allow equal places")
    return named


def stage2(frames: DataFrame, cfg: Config = Config(), mapping: DataFrame | None = None) -> dict[str, DataFrame]:
    """Trends of state and action over the frames that are valid so far (`valid`): dimension_metrics, episode_flags, episode_filter.

    Pairs of places are `cfg.pairs`, else those of `mapping` (dataset_uid, state_dimension, action_dimension, as
    `trend.match_joints` finds them by name); datasets without any compare equal places if `cfg.positional` allows it,
    and are an error otherwise, as are pairs outside the vectors or not one-to-one. Grippers (`cfg.exempt`) are left out.
    """
    pairs = _pairs_of(frames, cfg, mapping)
    metrics = trend.trends(frames, KEYS, ORDER, "state", "action", pairs, "valid", cfg.fps, cfg.lag_seconds, cfg.least_active, cfg.agreement, cfg.action_mode == "delta", medians=cfg.medians, window=cfg.window, degree=cfg.degree)
    metrics = cut(metrics)
    flags = trend.trend_verdicts(metrics, KEYS)
    counts = frames.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("num_frames"))
    filter_ = counts.join(flags, KEYS, "left").select(*KEYS, "num_frames", (~F.coalesce("reject_episode", F.lit(False))).alias("accepted"), F.when(F.coalesce("reject_episode", F.lit(False)), REASONS[2]).alias("reason_code"))
    return {"dimension_metrics": metrics, "episode_flags": flags, "episode_filter": filter_}


def stage3(frames: DataFrame, embodiments: DataFrame | None = None, cfg: Config = Config()) -> dict[str, DataFrame]:
    """Extreme values: thresholds, frame_flags, episode_summary, episode_filter, step_validity.

    Bounds belong to an embodiment, over all datasets that have it (dataset_uid, embodiment; each its own without).
    They come from valid frames only; a gripper's places only count when not finite. No episode is rejected.
    """
    e = frames.withColumn("embodiment", F.col("dataset_uid")) if embodiments is None else frames.join(embodiments, "dataset_uid", "left").withColumn("embodiment", F.coalesce("embodiment", "dataset_uid"))
    good = e.filter("valid")
    bounds = quantiles.quantile_bounds(good, "embodiment", VECTORS, alpha=cfg.alpha)
    limits = _limits(bounds, "embodiment", ["lower", "upper"], VECTORS)
    flags = e.join(limits, "embodiment", "left")
    for v in VECTORS:
        flags = flags.withColumn(f"{v}_flags", beyond(F.col(v), F.col(f"{v}_lower"), F.col(f"{v}_upper"), _exempt(cfg, v)))
    extreme = F.col("valid") & (any_of(F.col("state_flags")) | any_of(F.col("action_flags")))
    flags = cut(flags.select(*STEP, "index", "valid", extreme.alias("flagged_frame"), *(failed_places(F.col(f"{v}_flags")).alias(f"failed_{v}_dimensions") for v in VECTORS)))
    final = F.col("valid") & ~F.col("flagged_frame")
    summary = flags.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("input_frames"), F.count_if("flagged_frame").alias("flagged_frames"), F.count_if(final).alias("output_frames"))
    reasons = F.filter(F.array(F.when(~F.col("valid"), "stage1_invalid"), F.when(F.col("flagged_frame"), REASONS[3])), lambda r: r.isNotNull())
    validity = flags.select(*STEP, "index", F.col("valid").alias("stage1_valid"), F.lit(True).alias("stage2_valid"), (~F.col("flagged_frame")).alias("stage3_valid"), final.alias("valid"), reasons.alias("reason_codes"))
    filter_ = summary.select(*KEYS, F.col("input_frames").alias("num_frames"), F.lit(True).alias("accepted"), F.lit(None).cast("string").alias("reason_code"))
    return {"thresholds": bounds, "frame_flags": flags.filter("flagged_frame").drop("valid"), "episode_summary": summary, "episode_filter": filter_, "step_validity": validity}


# --- views over immutable data

def accepted_only(frames: DataFrame, filters: Sequence[DataFrame]) -> DataFrame:
    """Frames of the episodes that every filter accepts; no filter accepts all."""
    return reduce(lambda d, f: d.join(f.filter("accepted").select(*KEYS).distinct(), KEYS, "left_semi"), filters, frames)


def invalid_frames(validities: Sequence[DataFrame]) -> DataFrame:
    """The union of the frames that any label table calls invalid."""
    return reduce(DataFrame.unionByName, [v.filter(~F.col("valid")).select(*STEP) for v in validities]).distinct()


def with_step_validity(frames: DataFrame, validities: Sequence[DataFrame]) -> DataFrame:
    """Add `valid`: no label table calls the frame invalid; a frame without a label is valid."""
    if not validities:
        return frames.withColumn("valid", F.lit(True))
    bad = invalid_frames(validities).withColumn("__bad", F.lit(True))
    return frames.join(bad, STEP, "left").withColumn("valid", F.col("__bad").isNull()).drop("__bad")


def covered(frames: DataFrame, ranges: DataFrame, out: str = "covered") -> DataFrame:
    """Add whether any range (keys, frame_start, frame_end, both inclusive) covers the frame.

    Ranges are merged to periods first, so that of an episode's periods only the last one that began can cover a frame:
    one ordered pass over both instead of a row for each covered frame. Ranges without a bound or reversed cover nothing.
    """
    periods = periods_and_gaps(ranges, KEYS, "frame_start", "frame_end").filter("kind = 'period'")
    marks = periods.select(*KEYS, F.col("frame_start").alias("frame_index"), F.col("frame_end").alias("__end"), F.lit(0).alias("__frame"))
    w = Window.partitionBy(*KEYS).orderBy("frame_index", "__frame").rowsBetween(Window.unboundedPreceding, 0)
    both = frames.withColumn("__frame", F.lit(1)).unionByName(marks, allowMissingColumns=True).withColumn("__until", F.last("__end", True).over(w))
    return both.filter("__frame = 1").withColumn(out, F.coalesce(F.col("__until") >= F.col("frame_index"), F.lit(False))).drop("__frame", "__end", "__until")


def chain_validity(validities: Sequence[DataFrame]) -> DataFrame:
    """All label tables of a chain as one: a frame is valid if each that has it says so."""
    union = reduce(DataFrame.unionByName, [v.select(*STEP, "valid") for v in validities])
    return union.groupBy(*STEP).agg(F.bool_and("valid").alias("valid"))


def overlay_repairs(layers: Sequence[DataFrame], columns: Sequence[str]) -> DataFrame:
    """Repaired vectors of a chain, child after parent: the last layer that has a value for a column wins."""
    union = reduce(DataFrame.unionByName, [d.select(*STEP, *columns).withColumn("__depth", F.lit(n)) for n, d in enumerate(layers)])
    return union.groupBy(*STEP).agg(*(F.max_by(c, F.when(F.col(c).isNotNull(), F.col("__depth"))).alias(c) for c in columns))


def series_view(frames: DataFrame, column: str, view: str, validity: DataFrame | None = None, repairs: DataFrame | None = None) -> DataFrame:
    """A vector as it is (`raw`), with nulls where invalid (`valid`), repaired (`repaired`), or what repair changed (`diff`)."""
    out = frames.select(*STEP, F.col(column).cast("array<double>").alias("value"))
    if view == "valid":
        return out.join(validity.select(*STEP, "valid"), STEP, "left").select(*STEP, masked(F.col("value"), F.coalesce("valid", F.lit(True))).alias("value"))
    if view in ("repaired", "diff"):
        fixed = out.join(repairs.select(*STEP, F.col(column).alias("fixed")), STEP, "left").withColumn("fixed", F.coalesce("fixed", "value"))
        return fixed.select(*STEP, (F.col("fixed") if view == "repaired" else F.zip_with("fixed", "value", lambda a, b: a - b)).alias("value"))
    if view != "raw":
        raise ValueError(f"unknown view {view!r}")
    return out


def episode_series(frames: DataFrame, columns: Sequence[str], fps: float, view: str = "raw", validity: DataFrame | None = None, repairs: DataFrame | None = None, episode: tuple[str, int] | None = None, limit: int | None = None) -> DataFrame:
    """Vectors of episodes in a view, with `episode_time` in seconds: by frame number, or by position where there is none.

    The filter on one episode reaches the scans of all tables, so that files and row groups without it are not read;
    `limit` takes the first frames in order.
    """
    only = (lambda d: d) if episode is None else (lambda d: d.filter((F.col("dataset_uid") == episode[0]) & (F.col("episode_index") == episode[1])))
    f = only(frames)
    out = f.select(*STEP, (F.coalesce("frame_index", F.row_number().over(Window.partitionBy(*KEYS).orderBy(*ORDER)) - 1) / float(fps)).alias("episode_time"))
    for c in columns:
        part = series_view(f, c, view, None if validity is None else only(validity), None if repairs is None else only(repairs))
        out = out.join(part.withColumnRenamed("value", c), STEP)
    return out if limit is None else out.orderBy(*STEP).limit(limit)


def order_violations(frames: DataFrame) -> DataFrame:
    """Frames whose global number does not rise with episode and frame, by dataset."""
    w = Window.partitionBy(*KEYS).orderBy(*ORDER)
    inside = frames.withColumn("__p", F.lag("index").over(w)).filter(F.col("__p") >= F.col("index")).select(*STEP, "index")
    edges = frames.groupBy(*KEYS).agg(F.min("index").alias("a"), F.max("index").alias("b"))
    edges = previous(edges, ["dataset_uid"], ["episode_index"], F.shiftright(F.col("episode_index").cast("bigint"), 12), "b", "__p")
    between = edges.filter(F.col("__p") >= F.col("a")).select(*KEYS, F.lit(0).cast("bigint").alias("frame_index"), F.col("a").alias("index"))
    return inside.unionByName(between)


# --- runs with manifests

def write_json(path: str | Path, value: object) -> None:
    write_text(path, json.dumps(value, sort_keys=True, indent=1, ensure_ascii=False))


def publish(staged: str | Path, target: str | Path, overwrite: bool = False) -> None:
    """Move a finished folder into place; an existing one is only replaced if told so."""
    if os.path.exists(target):
        if not overwrite:
            raise FileExistsError(target)
        shutil.rmtree(target)
    Path(target).parent.mkdir(parents=True, exist_ok=True)
    os.replace(staged, target)


def read_chain(manifest: str | Path) -> list[dict]:
    """Manifests from the first to the given one; a circle or a manifest of rewritten data is an error."""
    chain, seen, at = [], set(), str(manifest)
    while at:
        if at in seen:
            raise ValueError(f"circle of manifests at {at}")
        seen.add(at)
        m = json.loads(read_text(at))
        if m.get("format") == "overlay":
            raise ValueError(f"{at} rewrites data: rerun the preceding stages")
        chain.insert(0, m | {"path": at})
        at = m.get("parent_manifest")
    return chain


def view_of(spark: SparkSession, frames: DataFrame, manifest: str | Path | None) -> DataFrame:
    """Frames as a chain of manifests sees them: accepted episodes only, with `valid`."""
    chain = read_chain(manifest) if manifest else []
    filters = [spark.read.parquet(m["episode_filter"]) for m in chain]
    validities = [spark.read.parquet(m["step_validity"]) for m in chain if m.get("step_validity")]
    return with_step_validity(accepted_only(frames, filters), validities)


def previous_manifest(out: str | Path, stages: Sequence[int]) -> str | None:
    """The manifest to go on from: of the highest finished stage below the first one to run; None if there is none."""
    found = [f"{out}/stage{n}/manifest.json" for n in range(min(stages) - 1, 0, -1)]
    return next((p for p in found if exists(p)), None)


def readiness(shapes: DataFrame, mapping: DataFrame) -> DataFrame:
    """dataset_uid, state_places, action_places, mapped_places and status: ready, stage2_mapping_required or unsupported.

    shapes: dataset_uid, state_places and action_places (null without the vector); mapping as stage 2 takes it.
    """
    n = mapping.groupBy("dataset_uid").agg(F.count(F.lit(1)).alias("mapped_places"))
    out = shapes.join(n, "dataset_uid", "left").withColumn("mapped_places", F.coalesce("mapped_places", F.lit(0)))
    lacks = F.coalesce(F.least("state_places", "action_places"), F.lit(0)) < 1
    lacks = lacks | F.col("state_places").isNull() | F.col("action_places").isNull()
    return out.withColumn("status", F.when(lacks, "unsupported").when(F.col("mapped_places") == 0, "stage2_mapping_required").otherwise("ready"))


def run(spark: SparkSession, frames: DataFrame, out: str, stages: Sequence[int] = (1, 2, 3), cfg: Config = Config(), embodiments: DataFrame | None = None, parent: str | None = None, overwrite: bool = False, mapping: DataFrame | None = None) -> str:
    """Run stages in turn, each over the view of those before; the last manifest's path.

    Label tables are written first, the manifest that names them last, so a manifest is only seen when it is true.
    """
    for n in sorted(stages):
        view = view_of(spark, frames, parent)
        labels = stage1(view.drop("valid"), cfg) if n == 1 else stage2(view, cfg, mapping) if n == 2 else stage3(view, embodiments, cfg)
        base = f"{out}/stage{n}"
        for name, df in labels.items():
            df.write.mode("overwrite" if overwrite else "errorifexists").option("compression", "zstd").parquet(f"{base}/labels/{name}")
        done = spark.read.parquet(f"{base}/labels/episode_filter").agg(F.count(F.lit(1)).alias("episodes"), F.count_if("accepted").alias("accepted")).first()
        manifest = {"manifest_version": 2, "format": "filter", "stage": n, "parent_manifest": parent, "episode_filter": f"{base}/labels/episode_filter", "labels": sorted(labels), "config": json.loads(canonical_json_text(asdict(cfg))), "result": done.asDict(), "finished_at": time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime())}
        if n in (1, 3):
            manifest["step_validity"] = f"{base}/labels/step_validity"
        parent = f"{base}/manifest.json"
        write_json(parent, manifest)
    if parent:
        write_json(f"{out}/latest_run.json", {"manifest": parent})
    return parent
