"""The older pipeline, which rewrites data: sudden changes, alignment, bounds, chain checks, pictures, outcomes.

Its rules are not those of the masks in `curation`; the two must not be mixed.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trajlake.functions import geometry, smoothing
from trajlake.functions.vectors import above, finite
from trajlake.operators import quantiles, runs, stats, trend
from trajlake.plans.episodes import per_episode, series
from trajlake.plans.storage import cut

KEYS, ORDER = ["dataset_uid", "episode_index"], ["frame_index"]
STEP = [*KEYS, *ORDER]
#: Stages in the order in which they run.
STAGES = ("stage1_sudden_change", "stage2_trend_alignment", "stage3_extreme_value", "stage4_fk_consistency", "stage5_orientation_alignment", "check1_instruction_consistency", "check2_video_state_consistency", "check3_video_quality", "run_pipeline", "unify_representation", "unify_representation_action")


@dataclass(frozen=True)
class Config:
    window: int = 11
    degree: int = 3
    residual: float = 0.05
    acceleration: float = 0.5
    jerk: float = 5.0
    reject_fraction: float = 0.3
    agreement: float = 0.65
    most_lag: int = 5
    low: float = 0.01
    high: float = 0.99
    gripper: dict[str, tuple[int, ...]] = field(default_factory=dict)
    absolute: bool = True
    black: float = 10.0
    blur: float = 100.0
    still: float = 1.0
    still_run: int = 30
    dof: int = 6
    arms: int = 1
    gripper_type: str = "unknown"
    space: str = "joint_position"
    robot: bool = True
    urdf: str | None = None
    chain_feasible: bool = False
    chain_for_pictures: bool = False
    tcp_tolerance: float = 0.02
    base_to_world: tuple[float, ...] = ()
    vlm_url: str | None = None
    sam_model: str | None = None
    has_instruction: bool = False
    has_calibration: bool = False
    gripper_radius: float | None = None
    overlap: float = 0.5


# Outcomes of checks that did not really take place.
UNVERIFIED = ("vlm_service_not_configured", "vlm_call_failed", "no_frames_available", "sam3_service_not_configured", "urdf_not_available", "camera_calibration_not_available", "camera_calibration_missing_for_view", "gripper_radius_not_configured", "fk_check_not_feasible", "fk_projection_behind_camera")


def warnings(cfg: Config) -> list[str]:
    """Settings that contradict each other, so that a check is skipped, or never verifies anything, for every episode."""
    rules = [
        (cfg.urdf and not cfg.chain_feasible, "a chain (urdf) is given but chain_feasible is off: stage 4 is skipped"),
        (cfg.chain_feasible and not cfg.urdf, "chain_feasible is on but no chain (urdf) is given: stage 4 is skipped"),
        (cfg.urdf and not cfg.chain_for_pictures, "a chain (urdf) is given but chain_for_pictures is off: check 2 is skipped"),
        (cfg.chain_for_pictures and not cfg.urdf, "chain_for_pictures is on but no chain (urdf) is given: check 2 is skipped"),
        (cfg.has_instruction and not cfg.vlm_url, "there are instructions but no service (vlm_url): check 1 verifies nothing"),
        (cfg.chain_for_pictures and cfg.has_calibration and not cfg.sam_model, "chain and cameras are known but no model (sam_model): check 2 verifies nothing"),
    ]
    return [text for wrong, text in rules if wrong]


def sudden_changes(frames: DataFrame, cfg: Config = Config()) -> tuple[DataFrame, DataFrame]:
    """(frames with `state` repaired and `flagged`, outcome of each episode).

    A frame is flagged if the distance to the local polynomial, the central difference or its central difference
    exceeds its limit in any place. Episodes with too many flagged frames are rejected, in others flagged frames become
    the line between unflagged ones, if there are two. Episodes too short for the polynomial pass unchanged.
    """
    def kernel(table: pa.Table) -> dict:
        x = series(table["state"])
        n = smoothing.odd_window(cfg.window, len(x), 1)
        flagged = np.zeros(len(x), bool)
        short = len(x) < 2 or n is None or n <= cfg.degree
        if not short:
            with np.errstate(invalid="ignore"):
                first = np.gradient(x, axis=0)
                parts = (np.abs(x - smoothing.local_polynomial(x, n, cfg.degree)) > cfg.residual, np.abs(first) > cfg.acceleration, np.abs(np.gradient(first, axis=0)) > cfg.jerk)
            flagged = reduce(np.logical_or, parts).any(axis=1)
        share = float(flagged.mean()) if len(x) else 0.0
        reject = share > cfg.reject_fraction
        fixed, t = x.copy(), np.arange(len(x))
        if not reject and flagged.any() and (~flagged).sum() >= 2:
            for d in range(x.shape[1]):
                fixed[flagged, d] = np.interp(t[flagged], t[~flagged], x[~flagged, d])
        return {k: table[k] for k in STEP} | {"state": fixed, "flagged": flagged, "rejected": np.full(len(x), reject), "short": np.full(len(x), short)}

    kinds = ", ".join(f"`{k}` {frames.schema[k].dataType.simpleString()}" for k in STEP)
    out = cut(per_episode(frames, KEYS, ORDER, ["state"], kernel, f"{kinds}, state array<double>, flagged boolean, rejected boolean, short boolean"))
    reason = F.when(F.bool_or("short"), "episode_too_short_for_savgol")
    log = out.groupBy(*KEYS).agg(F.lit("stage1_sudden_change").alias("stage"), reason.alias("reason"), F.bool_or("rejected").alias("rejected"))
    kept = frames.drop("state").join(out.filter(~F.col("rejected")).drop("rejected", "short"), STEP)
    return kept, log


def trim(frames: DataFrame, alignment: DataFrame) -> DataFrame:
    """Episodes that were not rejected, with the action moved by the lag: frame t has the action of frame t - lag."""
    a = alignment.filter(~F.col("rejected")).select(*KEYS, F.coalesce("lag", F.lit(0)).alias("lag"))
    w = runs.ordered(KEYS, ORDER)
    f = frames.join(a, KEYS).withColumn("__p", F.row_number().over(w))
    moved = f.select(*KEYS, (F.col("__p") + F.col("lag")).alias("__p"), F.col("action").alias("__action"))
    out = f.join(moved, [*KEYS, "__p"]).withColumn("action", F.col("__action"))
    return out.drop("__p", "__action", "lag")


def bounds(frames: DataFrame, cfg: Config = Config()) -> DataFrame:
    """q_low and q_high of each dataset's places; gripper places have none, and NaN makes a place's bounds NaN.

    Quantiles are exact over all frames and infinite values, without a task that holds a dataset.
    """
    (found,) = quantiles.exact_quantiles(frames, "dataset_uid", ["state", "action"], [(quantiles.with_infinities, (cfg.low, cfg.high))])
    rows = [(*k, *(quantiles.infinite(x) for x in q or (None, None))) for k, q in found.items()]
    q = frames.sparkSession.createDataFrame(rows, "dataset_uid string, feature string, dimension int, q_low double, q_high double")
    for name, places in cfg.gripper.items():
        q = q.filter(~((F.col("feature") == name) & F.col("dimension").isin(*map(int, places), -1)))
    long = stats.explode_places(frames, ["dataset_uid"], {"state": "state", "action": "action"})
    bad = long.filter(F.isnan("value")).select("dataset_uid", "feature", "dimension").distinct().withColumn("bad", F.lit(True))
    limit = lambda c: F.when(F.col("bad"), F.lit(float("nan"))).otherwise(F.col(c)).alias(c)
    return q.join(bad, ["dataset_uid", "feature", "dimension"], "left").select("dataset_uid", "feature", "dimension", limit("q_low"), limit("q_high"))


def drop_extremes(frames: DataFrame, limits: DataFrame) -> DataFrame:
    """Frames whose places all lie within their bounds; a place without bounds, and NaN, are not checked."""
    arrays = limits.groupBy("dataset_uid").agg(F.collect_list(F.struct("feature", "dimension", "q_low", "q_high")).alias("__b"))
    f = frames.join(arrays, "dataset_uid", "left")

    def outside(b: Column) -> Column:
        v = F.when(b["feature"] == "state", F.get("state", b["dimension"])).otherwise(F.get("action", b["dimension"]))
        return above(v, b["q_high"]) | above(b["q_low"], v)

    return f.filter(~F.coalesce(F.exists("__b", outside), F.lit(False))).drop("__b")


def tip_check(poses: DataFrame, keys: Sequence[str], tolerance: float) -> DataFrame:
    """Reported tips against those of the chain: the median offset to subtract where it is long, or a flag for review.

    poses: keys, reported and computed positions as arrays. A wide spread without an offset asks for manual review.
    """
    d = poses.select(*keys, *(((F.get("reported", F.lit(i)) - F.get("computed", F.lit(i))).alias(n)) for i, n in enumerate("xyz")))
    s = stats.offset_statistics(d, keys)
    # spread is measured about the median
    about = d.join(s.select(*keys, "m0", "m1", "m2"), [*keys])
    spread = about.groupBy(*keys).agg(sum((F.var_pop(F.col(c) - F.col(f"m{i}")) for i, c in enumerate("xyz")), F.lit(0.0)).alias("variance"))
    s = s.drop("variance").join(spread, [*keys])
    fix = F.col("length") > tolerance
    return s.select(*keys, F.array("m0", "m1", "m2").alias("offset"), "variance", fix.alias("corrected"), (~fix & (F.col("variance") > tolerance**2)).alias("manual_review"))


def _chain(cfg: Config) -> geometry.Chain | None:
    """The chain, if it is one of as many active joints as an arm has."""
    try:
        chain = geometry.Chain(cfg.urdf) if cfg.urdf and cfg.dof > 0 else None
    except ValueError:
        return None
    return chain if chain is not None and len(chain.active) == cfg.dof else None


def _outcome(episodes: DataFrame, stage: str, reason: Column | str | None = None, rejected: Column | None = None) -> DataFrame:
    reason = reason if isinstance(reason, Column) else F.lit(reason).cast("string")
    return episodes.select(*KEYS, F.lit(stage).alias("stage"), reason.alias("reason"), (F.lit(False) if rejected is None else rejected).alias("rejected"))


def _wide_enough(frames: DataFrame, places: int) -> DataFrame:
    return frames.groupBy(*KEYS).agg((F.max(F.size("state")) >= places).alias("fits"))


def correct_tips(frames: DataFrame, cfg: Config) -> tuple[DataFrame, DataFrame]:
    """Stage 4: (frames whose reported tips lose a steady offset to the chain's, outcomes with `manual_review`).

    The tip's position follows the joints in the state. Not feasible without a chain that fits the joints, or where
    states are too narrow; nothing is rejected.
    """
    name, chain = "stage4_fk_consistency", _chain(cfg) if cfg.chain_feasible else None
    width = _wide_enough(frames, cfg.dof + 3)
    review = F.lit(False).alias("manual_review")
    if chain is None:
        return frames, _outcome(width, name, "fk_check_not_feasible").select("*", review)
    computed = F.slice(geometry.forward_pose(cfg.urdf, F.slice("state", 1, cfg.dof)), 1, 3)
    poses = frames.join(width.filter("fits"), KEYS, "left_semi").select(*KEYS, F.slice("state", cfg.dof + 1, 3).alias("reported"), computed.alias("computed"))
    found = cut(tip_check(poses, KEYS, cfg.tcp_tolerance))
    moved = F.concat(F.slice("state", 1, cfg.dof), F.zip_with(F.slice("state", cfg.dof + 1, 3), "offset", lambda x, y: x - y), F.slice("state", cfg.dof + 4, geometry.WIDTH))
    out = frames.join(found.filter("corrected").select(*KEYS, "offset"), KEYS, "left").withColumn("state", F.when(F.col("offset").isNotNull(), moved).otherwise(F.col("state"))).drop("offset")
    log = width.join(found.select(*KEYS, "manual_review"), KEYS, "left")
    return out, _outcome(log, name, F.when(~F.col("fits"), "fk_check_not_feasible")).join(log.select(*KEYS, F.coalesce("manual_review", F.lit(False)).alias("manual_review")), KEYS)


def align_orientation(frames: DataFrame, cfg: Config) -> tuple[DataFrame, DataFrame]:
    """Stage 5: (frames whose tips' poses are seen from the world, outcomes).

    Positions always move; orientations turn only in episodes all of whose quaternions have a direction.
    """
    name, m = "stage5_orientation_alignment", np.asarray(cfg.base_to_world, float)
    width = _wide_enough(frames, cfg.dof + 3)
    if not m.size:
        return frames, _outcome(width, name, "no_base_to_world_transform_configured")
    if m.size != 16 or not np.isfinite(m).all() or abs(np.linalg.det(m.reshape(4, 4)[:3, :3])) < 1e-12:
        return frames, _outcome(width, name, "invalid_base_to_world_transform")
    m, at = m.reshape(4, 4), max(cfg.dof, 0)
    q = F.slice("state", at + 4, 4)
    direction = (F.size(q) == 4) & F.forall(q, finite) & (geometry.length(q) > 1e-8)
    whole = frames.groupBy(*KEYS).agg((F.max(F.size("state")) >= at + 3).alias("__fits"), F.bool_and(F.coalesce(direction, F.lit(False))).alias("__turn"))
    world = F.array(*(F.lit(float(x)) for x in geometry.quaternion_of(geometry.rotation_matrix(m[:3, :3]))))
    position = geometry.transform_point(F.slice("state", at + 1, 3), m[:3, :3], m[:3, 3])
    rest = F.when(F.col("__turn"), F.concat(geometry.multiply(world, geometry.unit(q)), F.slice("state", at + 8, geometry.WIDTH))).otherwise(F.slice("state", at + 4, geometry.WIDTH))
    moved = F.concat(F.slice("state", 1, at), position, rest) if at else F.concat(position, rest)
    out = frames.join(whole, KEYS).withColumn("state", F.when(F.col("__fits"), moved).otherwise(F.col("state"))).drop("__fits", "__turn")
    return out, _outcome(width, name, F.when(~F.col("fits"), "state_too_narrow_for_eef_slice"))


def sampled_places(frames: Column, most: int = 5) -> Column:
    """0-based places of at most `most` of an episode's frames: all of few, else the first, the last and even steps between."""
    even = F.transform(F.sequence(F.lit(0), F.lit(most - 1)), lambda i: F.rint(i * (frames - 1) / float(most - 1)).cast("int"))
    return F.when(frames <= 0, F.array().cast("array<int>")).when(frames <= most, F.sequence(F.lit(0), F.greatest(frames - 1, F.lit(0)).cast("int"))).otherwise(even)


#: A segmenter gets gray, height, width and the box (u0, v0, u1, v1), and gives the mask as a boolean array.
Segmenter = Callable[[np.ndarray, tuple[float, float, float, float]], np.ndarray]


def check_pictures(frames: DataFrame, pictures: DataFrame | None, cameras: DataFrame | None, cfg: Config, segmenter: Segmenter | None) -> DataFrame:
    """Check 2: outcomes of comparing where the chain expects the gripper with where a segmenter finds it.

    pictures: keys, frame_index, view, height, width, gray; of each episode the first view by name is compared, in at most
    five frames. cameras: keys, view, intrinsics (fx, fy, cx, cy), extrinsics (16 numbers). An episode is inconsistent,
    which rejects nothing, where the mean overlap of the expected disk and the mask is below the limit.
    """
    name, episodes = "check2_video_state_consistency", frames.groupBy(*KEYS).agg((F.max(F.size("state")) >= cfg.dof).alias("fits"))
    if not cfg.chain_for_pictures:
        return _outcome(episodes, name, "urdf_not_available")
    if not cfg.has_calibration or cameras is None:
        return _outcome(episodes, name, "camera_calibration_not_available")
    known = cameras.select(*KEYS).distinct().withColumn("calibrated", F.lit(True))
    episodes = episodes.join(known, KEYS, "left")
    if segmenter is None:
        return _outcome(episodes, name, F.when(F.col("calibrated").isNull(), "camera_calibration_not_available").otherwise("sam3_service_not_configured"))
    if pictures is None:
        return _outcome(episodes, name, F.when(F.col("calibrated").isNull(), "camera_calibration_not_available").otherwise("no_frames_available"))
    first = pictures.groupBy(*KEYS).agg(F.min("view").alias("view"))
    lens = first.join(cameras.select(*KEYS, "view", "intrinsics", "extrinsics"), [*KEYS, "view"], "left")
    episodes = episodes.join(lens, KEYS, "left")
    chain = _chain(cfg)
    reason = F.when(F.col("calibrated").isNull(), "camera_calibration_not_available").when(F.col("view").isNull(), "no_frames_available").when(F.col("intrinsics").isNull(), "camera_calibration_missing_for_view")
    if not cfg.gripper_radius:
        return _outcome(episodes, name, F.coalesce(reason, F.lit("gripper_radius_not_configured")))
    if chain is None:
        return _outcome(episodes, name, F.coalesce(reason, F.lit("fk_check_not_feasible")))
    reason = reason.when(~F.col("fits"), "fk_check_not_feasible")
    w = runs.ordered(KEYS, ORDER)
    total = F.count(F.lit(1)).over(Window.partitionBy(*KEYS))
    picked = frames.join(episodes.filter(F.isnull(reason)).select(*KEYS, "view", "intrinsics", "extrinsics"), KEYS).withColumn("__p", F.row_number().over(w) - 1).withColumn("__n", total).filter(F.array_contains(sampled_places(F.col("__n")), F.col("__p")))
    rows = picked.join(pictures, [*STEP, "view"]).select(*KEYS, "height", "width", "gray", "intrinsics", "extrinsics", F.slice(geometry.forward_pose(cfg.urdf, F.slice("state", 1, cfg.dof)), 1, 3).alias("tip"))
    radius = float(cfg.gripper_radius)

    def overlap(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            values = []
            for r in pdf.itertuples(index=False):
                at = np.asarray(r.extrinsics, float).reshape(4, 4) @ [*r.tip, 1.0]
                if at[2] <= 0:
                    values.append(None)
                    continue
                fx, fy, cx, cy = map(float, r.intrinsics)
                u, v, size = fx * at[0] / at[2] + cx, fy * at[1] / at[2] + cy, fx * radius / at[2]
                want = geometry.disk(u, v, size, r.height, r.width)
                got = segmenter(np.asarray(r.gray, float).reshape(r.height, r.width), (u - size, v - size, u + size, v + size))
                either = (want | got).sum()
                values.append(float((want & got).sum() / either) if either else 0.0)
            yield pdf[KEYS].assign(iou=pd.array(values, dtype="Float64"))

    kinds = ", ".join(f"`{k}` {frames.schema[k].dataType.simpleString()}" for k in KEYS)
    means = rows.mapInPandas(overlap, f"{kinds}, iou double").groupBy(*KEYS).agg(F.avg("iou").alias("iou"))
    scored = episodes.join(means, KEYS, "left")
    late = F.when(F.col("iou").isNull(), "fk_projection_behind_camera").when(F.col("iou") < cfg.overlap, "video_state_inconsistent")
    return _outcome(scored, name, F.coalesce(reason, late))


def picture_scores(frames: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """brightness, blur (variance of the Laplacian) and difference to the frame before (infinite for the first).

    frames: keys, order, height, width and `gray`, an array of height * width numbers. The Laplacian mirrors the rows
    next to the border.
    """
    def kernel(table: pa.Table) -> dict:
        h, w = np.asarray(table["height"]), np.asarray(table["width"])
        x, out, before = series(table["gray"]), {"brightness": [], "blur": [], "difference": []}, None
        for i in range(len(x)):
            g = x[i, : h[i] * w[i]].reshape(h[i], w[i])
            p = np.pad(g, 1, mode="reflect") if min(g.shape) > 1 else np.pad(g, 1, mode="edge")
            out["brightness"].append(float(g.mean()))
            out["blur"].append(float((p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * g).var()))
            out["difference"].append(float(np.abs(g - before).mean()) if before is not None and before.shape == g.shape else float("inf"))
            before = g
        return {k: table[k] for k in [*keys, *order]} | out

    kinds = ", ".join(f"`{k}` {frames.schema[k].dataType.simpleString()}" for k in [*keys, *order])
    return per_episode(frames, keys, order, ["height", "width", "gray"], kernel, f"{kinds}, brightness double, blur double, difference double")


def picture_flags(scores: DataFrame, keys: Sequence[str], order: Sequence[str], protected: Column, cfg: Config = Config()) -> DataFrame:
    """Add `reason`: black, else blurry, else part of a standstill; protected frames are never still."""
    s = scores.withColumn("__same", F.col("difference") < cfg.still).withColumn("__safe", protected)
    s = runs.still_frames(s, keys, order, "__same", cfg.still_run, "__safe", "__still")
    reason = F.when(F.col("brightness") < cfg.black, "black").when(F.col("blur") < cfg.blur, "blurry").when(F.col("__still"), "still")
    return s.withColumn("reason", reason).drop("__same", "__safe", "__still")


#: A client judges (key, text or picture) and returns (fine, reason); the null client verifies nothing.
Client = Callable[[pd.DataFrame], pd.DataFrame]


def null_client(reason: str) -> Client:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.assign(fine=True, reason=reason)

    return run


def service_key(service: str | None, variable: str | None) -> str | None:
    """The key of a configured service, from the environment variable that is named for it; None without a service.

    A service that is configured without a key is an error: it must not silently become the null client.
    """
    if not service:
        return None
    if not variable or not os.environ.get(variable):
        raise RuntimeError(f"{service!r} is configured, but its key's variable {variable!r} is not set")
    return os.environ[variable]


def retrying(client: Client, attempts: int = 3, wait: float = 1.0) -> Client:
    """Tries again after 1, 2, 4 seconds; then passes everything as unverified."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        import time

        for n in range(attempts):
            try:
                return client(pdf)
            except Exception:  # any failure of an outside service
                if n + 1 < attempts:
                    time.sleep(wait * 2**n)
        return pdf.assign(fine=True, reason="vlm_call_failed")

    return run


def check_instructions(episodes: DataFrame, client: Client | None) -> DataFrame:
    """Outcome of each episode's instruction: skipped without one, unverified without a client, never rejected."""
    judge = retrying(client) if client else null_client("vlm_service_not_configured")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            has = pdf["instruction"].fillna("").str.strip() != ""
            out = judge(pdf[has]) if has.any() else pdf[has].assign(fine=[], reason=[])
            rest = pdf[~has].assign(fine=True, reason="no_language_instruction")
            both = pd.concat([out, rest]) if len(out) else rest
            yield both[[*KEYS, "reason"]].assign(stage="check1_instruction_consistency", rejected=False)[[*KEYS, "stage", "reason", "rejected"]]

    kinds = ", ".join(f"`{k}` {episodes.schema[k].dataType.simpleString()}" for k in KEYS)
    return episodes.select(*KEYS, "instruction").mapInPandas(run, f"{kinds}, stage string, reason string, rejected boolean")


def check_quality(frames: DataFrame, pictures: DataFrame | None, cfg: Config) -> tuple[DataFrame, DataFrame]:
    """Check 3: (frames that no view shows black, blurry or still, outcomes); frames at a move of the gripper are never still."""
    name, episodes = "check3_video_quality", frames.select(*KEYS).distinct()
    if pictures is None:
        return frames, _outcome(episodes, name, "no_video_frames")
    view = [*KEYS, "view"]
    moves = runs.gripper_moves(frames.select(*STEP, "action"), KEYS, ORDER, "action", cfg.gripper.get("action", ()), "safe").select(*STEP, "safe")
    scores = picture_scores(pictures, view, ORDER).join(moves, STEP)
    bad = picture_flags(scores, view, ORDER, F.col("safe"), cfg).filter("reason is not null").select(*STEP).distinct()
    seen = pictures.select(*KEYS).distinct().withColumn("seen", F.lit(True))
    return frames.join(bad, STEP, "left_anti"), _outcome(episodes.join(seen, KEYS, "left"), name, F.when(F.col("seen").isNull(), "no_video_frames"))


def dropped_frames(before: DataFrame, after: DataFrame) -> DataFrame:
    """For each episode the numbers, by position, of the frames that a step dropped, and how many are left."""
    rows = before.select(*STEP, (F.row_number().over(runs.ordered(KEYS, ORDER)) - 1).alias("p")).join(after.select(*STEP).withColumn("in", F.lit(True)), STEP, "left")
    return rows.groupBy(*KEYS).agg(F.array_sort(F.collect_list(F.when(F.col("in").isNull(), F.col("p")))).alias("dropped_frame_indices"), F.count("in").alias("output_frame_count"))


def _none_left(before: DataFrame, after: DataFrame) -> DataFrame:
    gone = before.select(*KEYS).distinct().join(after.select(*KEYS).distinct(), KEYS, "left_anti")
    return _outcome(gone, "run_pipeline", "all_frames_dropped", F.lit(True))


def run(frames: DataFrame, cfg: Config = Config(), episodes: DataFrame | None = None, pictures: DataFrame | None = None, cameras: DataFrame | None = None, instruction_client: Client | None = None, segmenter: Segmenter | None = None) -> tuple[DataFrame, DataFrame]:
    """(frames of the surviving episodes with canonical states and actions, outcomes of every stage an episode reached).

    frames: dataset_uid, episode_index, frame_index, state, action; episodes: keys and instruction; pictures and cameras
    as `check_pictures` wants them. Bounds are those of the episodes that survive the first two stages, the barrier of
    the pipeline; an episode that loses all frames, there or by its pictures, is dropped. Skipping is not rejecting.
    """
    kept, log = sudden_changes(frames.select(*STEP, "state", "action"), cfg)
    kept = cut(kept.drop("flagged"))
    alignment = cut(trend.legacy_alignment(kept, KEYS, ORDER, "state", "action", cfg.absolute, cfg.most_lag, cfg.agreement))
    log = log.unionByName(_outcome(alignment, "stage2_trend_alignment", F.col("skip_reason"), F.col("rejected")))
    aligned = cut(trim(kept, alignment))
    inside = cut(drop_extremes(aligned, bounds(aligned, cfg)))
    log = log.unionByName(_outcome(aligned.select(*KEYS).distinct(), "stage3_extreme_value")).unionByName(_none_left(aligned, inside))
    moved, log4 = correct_tips(inside, cfg)
    moved, log5 = align_orientation(moved, cfg)
    moved = cut(moved)
    texts = moved.select(*KEYS).distinct()
    texts = texts.withColumn("instruction", F.lit(None).cast("string")) if episodes is None or not cfg.has_instruction else texts.join(episodes.select(*KEYS, "instruction"), KEYS, "left")
    clear, check3 = check_quality(moved, pictures, cfg)
    clear = cut(clear)
    parts = [log4.drop("manual_review"), log5, check_instructions(texts, instruction_client), check_pictures(moved, pictures, cameras, cfg, segmenter), check3, _none_left(moved, clear)]
    log = reduce(DataFrame.unionByName, parts, log)
    left = clear.select(*KEYS).distinct()
    wide = clear.agg(F.max(F.size("state")).alias("s"), F.max(F.size("action")).alias("a")).first()
    if not cfg.robot or wide["s"] is None:
        reason = None if cfg.robot else "embodiment_not_robot_collected"
        return clear, log.unionByName(_outcome(left, "unify_representation", reason)).unionByName(_outcome(left, "unify_representation_action", reason))
    # the action first: it needs the state as it was
    action, _, why = geometry.pack_action(F.col("action"), F.col("state"), wide["a"], wide["s"], cfg.dof, cfg.arms, cfg.gripper_type, cfg.space, "absolute" if cfg.absolute else "delta")
    state, _ = geometry.pack_state(F.col("state"), wide["s"], cfg.dof, cfg.arms, cfg.gripper_type)
    out = clear.withColumn("canonical_action", F.lit(None).cast("array<double>") if action is None else action).withColumn("canonical_state", state)
    return out, log.unionByName(_outcome(left, "unify_representation")).unionByName(_outcome(left, "unify_representation_action", why))


def run_totals(frames: DataFrame, out: DataFrame) -> DataFrame:
    """One row: input_episodes, output_episodes and output_frames of a run."""
    count = lambda df, name: df.agg(F.count_distinct(F.struct(*KEYS)).alias(name))
    return count(frames, "input_episodes").crossJoin(F.broadcast(out.agg(F.count_distinct(F.struct(*KEYS)).alias("output_episodes"), F.count(F.lit(1)).alias("output_frames"))))


def episode_status(log: DataFrame) -> DataFrame:
    """keys and status: the first stage, in the order of the pipeline, that rejects the episode, else kept."""
    order = F.array_position(F.array(*map(F.lit, STAGES)), F.col("stage"))
    first = log.filter("rejected").groupBy(*KEYS).agg(F.min_by("stage", order).alias("stage"))
    return log.select(*KEYS).distinct().join(first, KEYS, "left").select(*KEYS, F.coalesce(F.concat(F.lit("rejected: "), "stage"), F.lit("kept")).alias("status"))
