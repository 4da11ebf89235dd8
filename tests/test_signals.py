"""Signals, runs, statistics and the stages against numpy and hand-computed cases."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trajlake.functions import geometry, smoothing
from trajlake.operators import quantiles, runs, signals, stats, trend
from trajlake.plans import curation, legacy

KEYS, ORDER = ["dataset_uid", "episode_index"], ["frame_index"]
SCHEMA = "dataset_uid string, episode_index bigint, frame_index bigint, index bigint, state array<double>, action array<double>"
NAN = float("nan")


def make(spark, state, action=None, uid="a", episode=0):
    action = state if action is None else action
    return spark.createDataFrame([(uid, episode, t, t, None if s is None else [float(x) for x in s], None if a is None else [float(x) for x in a]) for t, (s, a) in enumerate(zip(state, action))], SCHEMA)


def by_frame(df, column):
    return [r[column] for r in df.orderBy("frame_index").collect()]


def test_polynomial_reproduces_a_cubic_up_to_the_ends():
    t = np.arange(40.0)
    x = np.stack([t**3 - 2 * t, 5 - t], axis=1)
    assert np.allclose(smoothing.local_polynomial(x, 11, 3), x)
    assert np.allclose(smoothing.polynomial_weights(5, 2)[2], [-3 / 35, 12 / 35, 17 / 35, 12 / 35, -3 / 35])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.floats(-100, 100), min_size=1, max_size=30), st.sampled_from([3, 5, 7]))
def test_median_with_ends_that_go_on(x, k):
    h = k // 2
    want = [np.median([x[min(max(j, 0), len(x) - 1)] for j in range(i - h, i + h + 1)]) for i in range(len(x))]
    assert np.allclose(smoothing.running_median(np.array(x)[:, None], k)[:, 0], want)


def test_windows_shrink():
    assert [smoothing.odd_window(11, n, 5) for n in (3, 5, 6, 11, 40)] == [None, 5, 5, 11, 11]
    assert smoothing.smooth(np.ones((2, 1)))[:, 0].tolist() == [1, 1]


def test_differences_gradients_and_gaps(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(30, 2))
    d = signals.differences(make(spark, x), KEYS, ORDER, "state")
    before = np.concatenate([np.repeat(x[:1], 3, axis=0), x])
    assert np.allclose(by_frame(d, "acceleration"), np.abs(np.diff(before[1:], 2, axis=0)))
    assert np.allclose(by_frame(d, "jerk"), np.abs(np.diff(before, 3, axis=0)))
    g = signals.gradients(make(spark, x), KEYS, ORDER, "state")
    assert np.allclose(by_frame(g, "gradient2"), np.gradient(np.gradient(x, axis=0), axis=0))
    y = x.copy()
    y[[0, 5, 6, 29], 0] = [NAN, np.inf, NAN, -np.inf]
    f = make(spark, y).withColumn("v", F.get("state", F.lit(0)))
    assert np.allclose(by_frame(signals.filled(f, KEYS, ORDER, "v", "w"), "w"), smoothing.fill(y)[:, 0])
    none = make(spark, [[NAN, 0]] * 3).withColumn("v", F.get("state", F.lit(0)))
    assert by_frame(signals.filled(none, KEYS, ORDER, "v", "w"), "w") == [0, 0, 0]


def test_angles_and_quaternions(spark):
    rng = np.random.default_rng(1)
    a = np.cumsum(rng.normal(0, 2, 200))
    a = (a + np.pi) % (2 * np.pi) - np.pi
    a[50:53] = [0, np.pi, 0]
    f = make(spark, a[:, None]).withColumn("v", F.get("state", F.lit(0)))
    assert np.allclose(by_frame(signals.unwrapped(f, KEYS, ORDER, "v", "w"), "w"), np.unwrap(a))
    q = rng.normal(size=(60, 4))
    q[20] = 0
    q[40, 1] = NAN
    want = q.copy()
    for t in range(1, len(q)):
        if np.dot(want[t - 1], want[t]) < 0:
            want[t] *= -1
    got = signals.steady_quaternions(make(spark, q), KEYS, ORDER, "state", [0, 1, 2, 3], "steady")
    assert np.allclose(np.array(by_frame(got, "steady"), float), want, equal_nan=True)
    assert np.allclose(smoothing.steady_quaternions(q, [[0, 1, 2, 3]]), want, equal_nan=True)


def test_a_spike_is_a_sudden_change(spark):
    x = np.linspace(0, 1, 101)
    x[50] += 10
    r, a, j = smoothing.change_metrics(np.stack([x, np.zeros(101)], axis=1))
    assert r[50, 0] > 1 and (a[50, 0] > 1 or j[50, 0] > 1)
    labels = curation.stage1(make(spark, np.stack([x, np.zeros(101)], axis=1)), curation.Config(quantile_floor=0.9))
    assert 50 in by_frame(labels["frame_flags"], "frame_index")
    step = {r["frame_index"]: r for r in labels["step_validity"].collect()}
    assert len(step) == 101 and not step[50]["valid"] and step[50]["reason_codes"] == ["stage1_sudden_change"] and step[3]["valid"]
    whole = curation.stage1(make(spark, np.stack([x, np.zeros(101)], axis=1)), curation.Config(quantile_floor=0.9, exclusion="episode"))
    assert [(r["accepted"], r["reason_code"]) for r in whole["episode_filter"].collect()] == [(False, "stage1_sudden_change")]
    assert not any(by_frame(whole["step_validity"], "valid"))
    assert curation.stage1(make(spark, np.zeros((1, 2))).limit(0))["episode_summary"].count() == 0


def test_stage3_cases(spark):
    f = make(spark, [[1, 0], [999, 0], [3, 0]]).withColumn("valid", F.col("frame_index") != 1)
    b = {(r["feature"], r["dimension"]): r for r in curation.stage3(f)["thresholds"].collect()}
    assert (b["state", 0]["q_low"], b["state", 0]["q_high"]) == pytest.approx((1.02, 2.98))
    low, high = F.array(F.lit(0.0), F.lit(0.0)), F.array(F.lit(10.0), F.lit(10.0))
    from trajlake.functions.vectors import beyond

    g = make(spark, [[5, 999], [5, NAN], [5, 500]]).withColumn("bad", F.exists(beyond(F.col("state"), low, high, F.array(F.lit(1))), lambda x: x))
    assert by_frame(g, "bad") == [False, True, False]


def test_runs_and_masks(spark):
    v = make(spark, [[int(c == "T")] for c in "TTTFTTTFFT"]).withColumn("ok", F.get("state", F.lit(0)) == 1)
    assert [(r["start"], r["stop"]) for r in runs.valid_runs(v, KEYS, ORDER, "ok", 3).orderBy("start").collect()] == [(0, 2), (4, 6)]
    assert by_frame(v.withColumn("c", runs.causal_validity(KEYS, ORDER, F.col("ok"))), "c") == [True] * 3 + [False] * 7
    mask = v.limit(1).select(runs.loss_mask(F.lit(True), F.array(F.lit(True), F.lit(False), F.lit(True))).alias("m")).first()["m"]
    assert mask == [True, False, True]
    got = runs.merge_ranges(spark.createDataFrame([("a", x) for x in (3, 1, 2, 2, 7, 9, 8, None)], "k string, frame_index bigint"), ["k"])
    assert sorted((r["frame_start"], r["frame_end"]) for r in got.collect()) == [(1, 3), (7, 9)]
    clamp = spark.createDataFrame([(5, None, None, 1.0, 2.0), (5, -3, 2, None, None), (5, 9, 12, None, None)], "n bigint, frame_start bigint, frame_end bigint, time_start double, time_end double")
    assert [(r["frame_start"], r["frame_end"]) for r in runs.clamp_intervals(clamp, "n", F.lit(2.0)).collect()] == [(2, 4), (0, 2), (4, 4)]
    more = spark.createDataFrame([("e", 10, 3, 5, None, None, 0), ("e", 10, 6, 6, None, None, 0), ("e", 10, None, None, 0.0, 0.5, 0), ("e", 10, 108, 200, None, None, 100), ("e", 10, None, None, None, None, 0), ("e", 10, 5, 1, None, None, 0)], "k string, n bigint, frame_start bigint, frame_end bigint, time_start double, time_end double, offset bigint")
    assert sorted((r["frame_start"], r["frame_end"]) for r in runs.stage_intervals(more, ["k"], "n", F.lit(2.0)).collect()) == [(0, 1), (3, 6), (8, 9)]


def test_delta_actions_are_added_up_before_the_mask():
    runs_ = []
    ok = np.array([c == "T" for c in "TTTFTTT"])
    a = np.cumsum(smoothing.fill(np.ones((7, 1))), axis=0)
    edge = np.flatnonzero(np.diff(np.r_[0, ok.astype(np.int8), 0]))
    for b, e in zip(edge[::2], edge[1::2]):
        runs_.append(a[b:e, 0].tolist())
    assert runs_ == [[1, 2, 3], [5, 6, 7]]


def one_run(spark, s, a, longest, least_active=10):
    f = make(spark, np.c_[s], np.c_[a])
    r = trend.smoothed_runs(f, KEYS, ORDER, "state", "action", medians=(), window=1).withColumn("pairs", trend.fixed_pairs([(0, 0)]))
    return trend.pool_runs(trend.run_scores(trend.lag_tables(r, KEYS, longest), KEYS, longest), KEYS, least_active).first()


def test_trend_finds_lag_and_rejects(spark):
    rng = np.random.default_rng(2)
    a = np.cumsum(rng.normal(size=300))
    s = np.r_[np.zeros(4), a[:-4]]
    m = one_run(spark, s, a, 10)
    assert m["lag"] == 4 and m["agreement"] == 1.0 and m["correlation"] == pytest.approx(1)
    still = one_run(spark, np.zeros(20), np.zeros(20), 3)  # nothing is active, so no run counts
    assert (still["lag"], still["correlation"], still["active"], still["agreement"]) == (0, None, 0, None)
    runs_ = [("a", 0, 0, 0, 0, 1, 0.5, 1, 5, 1), ("a", 0, 0, 0, 0, 2, None, 2, 5, 2)]
    pooled = trend.pool_runs(spark.createDataFrame(runs_, "dataset_uid string, episode_index int, pair int, state_dimension int, action_dimension int, lag int, correlation double, free_lag int, active bigint, alike bigint"), KEYS, 10).first()
    assert (pooled["lag"], pooled["free_lag"], pooled["correlation"], pooled["active"], pooled["agreement"]) == (2, 2, 0.5, 10, pytest.approx(0.3))  # 1.5 goes to the even 2
    noise = np.stack([s, np.zeros(300)], axis=1), np.stack([-s, np.zeros(300)], axis=1)
    f = make(spark, *noise).withColumn("valid", F.lit(True))
    out = curation.stage2(f, curation.Config(positional=True))
    assert [(r["accepted"], r["reason_code"]) for r in out["episode_filter"].collect()] == [(False, "state_action_trend_mismatch")]
    assert out["episode_flags"].first()["failed_dimensions"] == [0]


def test_pairs_of_places_must_be_known(spark):
    x = np.cumsum(np.random.default_rng(3).normal(size=(60, 3)), axis=0)
    f = make(spark, x, x[:, ::-1]).withColumn("valid", F.lit(True))
    with pytest.raises(ValueError, match="no comparable places"):
        curation.stage2(f)
    with pytest.raises(ValueError, match="outside"):
        curation.stage2(f, curation.Config(pairs=((0, 3),)))
    with pytest.raises(ValueError, match="one-to-one"):
        curation.stage2(f, curation.Config(pairs=((0, 1), (1, 1))))
    named = spark.createDataFrame([("a", 0, 2), ("a", 1, 1), ("a", 9, 0)], "dataset_uid string, state_dimension int, action_dimension int")
    got = curation.stage2(f, curation.Config(exempt={"state": (1,)}), named)["dimension_metrics"].collect()
    assert [(r["state_dimension"], r["action_dimension"], r["lag_frames"], r["directional_agreement"]) for r in got] == [(0, 2, 0, 1.0)]
    with pytest.raises(ValueError):
        curation.stage2(f.withColumn("dataset_uid", F.lit("other")), mapping=named)
    assert curation.stage2(f.limit(0), curation.Config(positional=True))["episode_filter"].count() == 0
    short = make(spark, x[:2]).withColumn("valid", F.lit(True))  # no run: listed without a score
    assert [(r["lag_frames"], r["directional_agreement"], r["failed"]) for r in curation.stage2(short, curation.Config(positional=True))["dimension_metrics"].collect()] == [(0, None, False)] * 2


def test_older_alignment_against_direct_sums(spark):
    rng = np.random.default_rng(8)
    s, a = np.cumsum(rng.normal(size=(2, 40, 3)), axis=1)
    a[:, 1] = np.r_[s[3:, 1], np.zeros(3)]
    f = make(spark, s, a).unionByName(make(spark, s[:1], episode=1)).unionByName(make(spark, np.zeros((5, 0)), episode=2))
    got = {r["episode_index"]: r for r in trend.legacy_alignment(f, KEYS, ORDER, "state", "action").collect()}
    lags, signs = [], []
    for d in range(3):
        ds, da = (np.r_[0.0, x[1:, d] - x[:-1, d]] for x in (s, a))
        sums = {k: sum((ds[t] - ds.mean()) * (da[t - k] - da.mean()) for t in range(40) if 0 <= t - k < 40) for k in range(-39, 40)}
        lags.append(max(sums, key=lambda k: (sums[k], -k)))
        signs.append(np.mean([np.sign(da[(t - lags[-1]) % 40]) == np.sign(ds[t]) for t in range(40)]))
    assert lags[1] == 3 and got[0]["lag"] == int(np.median(lags)) and got[0]["directional_agreement"] == pytest.approx(np.mean(signs))
    assert got[1]["skip_reason"] == "insufficient_frames_for_trend_alignment" and not got[1]["rejected"]
    assert got[2]["skip_reason"] == "no_common_state_action_dims" and got[2]["kept_frames"] == 5


def test_statistics(spark):
    v = spark.createDataFrame([("a", x) for x in [1.0, 2.0, 3.0, 4.0, 100.0, NAN, float("inf"), None]] + [("b", NAN)], "k string, v double")
    t = {r["k"]: r["threshold"] for r in stats.robust_thresholds(v, ["k"], "v", 8.0, 0.5).collect()}
    assert t["a"] == pytest.approx(3 + 8 * 1.4826 * 1) and t["b"] is None
    c = {r["k"]: r for r in stats.component_statistics(v, ["k"], "v").collect()}
    assert (c["a"]["least"], c["a"]["most"], c["a"]["nan"], c["a"]["plus_inf"], c["a"]["values"]) == (1, 100, 1, 1, 8)
    p = stats.pool_statistics(stats.episode_statistics(v, ["k"], "v").withColumn("all", F.lit(1)), ["all"]).first()
    assert p["n"] == 5 and p["mean"] == pytest.approx(22) and p["std"] == pytest.approx(np.std([1, 2, 3, 4, 100]))
    f = make(spark, np.zeros((100, 1))).unionByName(make(spark, np.zeros((50, 1)), episode=7))
    assert sorted((r["episode_index"], r["frame_index"]) for r in stats.stride_sample(f, "dataset_uid", "episode_index", ORDER, 10).collect()) == [(0, x) for x in range(0, 100, 15)] + [(7, 5), (7, 20), (7, 35)]
    times = spark.createDataFrame([("s", i, i / 30) for i in range(20)] + [("ms", i, i * 20.0) for i in range(20)] + [("back", 0, 1.0), ("back", 1, 0.5), ("one", 0, 0.0)], "k string, i int, t double")
    got = {r["k"]: (r["fps"], r["problem"]) for r in quantiles.fps_from_timestamps(times, "k", "t", "i").collect()}
    assert got["s"][0] == pytest.approx(30) and got["ms"][0] == pytest.approx(50) and got["back"][1] == "not_rising" and got["one"][1] == "too_few"


def test_layouts_and_poses(spark):
    s = [float(x) for x in range(1, 9)]
    df = spark.createDataFrame([(s,)], "v array<double>")
    packed, mask = geometry.pack_state(F.col("v"), 8, 7, gripper="parallel_jaw")
    got = df.select(packed.alias("p")).first()["p"]
    assert len(got) == 128 and got[:7] == s[:7] and got[14] == 8.0 and sum(map(abs, got)) == sum(s) and [i for i, m in enumerate(mask) if m] == [*range(7), 14]
    two = [float(x) for x in range(1, 31)]  # two arms: 7 joints, a pose, a gripper
    packed, mask = geometry.pack_state(F.col("v"), 30, 7, 2, "parallel_jaw")
    got = spark.createDataFrame([(two,)], "v array<double>").select(packed.alias("p")).first()["p"]
    assert got[:15] == two[:15] and got[35:50] == two[15:] and sum(mask) == 30
    act, mask, why = geometry.pack_action(F.col("v"), F.col("v"), 8, 8, 7, gripper="parallel_jaw", frame="absolute")
    got = df.select(act.alias("p")).first()["p"]
    assert got[:7] == [0.0] * 7 and got[13] == 8.0 and why is None and not mask[68]
    assert geometry.pack_action(F.col("v"), F.col("v"), 8, 8, 7, space="other")[2] == "action_space_not_supported"
    half = 0.5**0.5
    q = spark.createDataFrame([([0.0, 0.0, half, half], [1.0, 2.0, 3.0, 0.0, 0.0, 0.0, 1.0], [0.0] * 7)], "q array<double>, pose array<double>, bad array<double>")
    turn = geometry.rotation_matrix([[0, -1, 0], [1, 0, 0], [0, 0, 1]])
    r = q.select(geometry.rotation_vector(F.col("q")).alias("v"), geometry.align_pose(F.col("pose"), turn, (1, 1, 1)).alias("p"), geometry.align_pose(F.col("bad"), turn, (0, 0, 0)).alias("n"), geometry.pixel(F.array(F.lit(0.5), F.lit(0.0), F.lit(2.0)), np.eye(4), (100, 100, 50, 40)).alias("x"), geometry.pixel(F.array(F.lit(0.5), F.lit(0.0), F.lit(-2.0)), np.eye(4), (100, 100, 50, 40)).alias("y")).first()
    assert r["v"] == pytest.approx([0, 0, np.pi / 2]) and r["p"][:3] == pytest.approx([-1, 2, 4]) and r["p"][3:] == pytest.approx([0, 0, half, half]) and r["n"] is None and r["x"] == [75, 40] and r["y"] is None
    assert geometry.disk(2, 2, 0.1, 5, 5).sum() == 5


URDF = """<robot><link name="a"/><link name="b"/><link name="c"/><joint name="j" type="revolute"><parent link="a"/><child link="b"/><axis xyz="0 0 1"/></joint>
<joint name="k" type="prismatic"><parent link="b"/><child link="c"/><origin xyz="1 0 0"/><axis xyz="1 0 0"/></joint></robot>"""


def test_kinematic_chain(spark):
    p, _ = geometry.Chain(URDF).forward(np.array([[np.pi / 2, 0.5], [0, 0]]))
    assert np.allclose(p, [[0, 1.5, 0], [1, 0, 0]])
    df = spark.createDataFrame([([np.pi / 2, 0.5],), ([1.0],), (None,)], "q array<double>")
    got = [r["p"] for r in df.select(geometry.forward_pose(URDF, F.col("q")).alias("p")).collect()]
    assert got[0][:3] == pytest.approx([0, 1.5, 0]) and got[1:] == [None, None]


def test_views_and_manifests(spark, tmp_path):
    x = np.cumsum(np.random.default_rng(3).normal(size=(40, 3)), axis=0)
    f = make(spark, x[:20]).unionByName(make(spark, x[20:], episode=1))
    last = curation.run(spark, f, str(tmp_path / "run"), (1, 3))
    chain = curation.read_chain(last)
    assert [m["stage"] for m in chain] == [1, 3] and chain[1]["parent_manifest"] == chain[0]["path"]
    assert spark.read.parquet(chain[1]["step_validity"]).count() == 40
    assert curation.view_of(spark, f, last).filter("valid").count() == spark.read.parquet(chain[1]["episode_summary"] if "episode_summary" in chain[1] else f"{tmp_path}/run/stage3/labels/episode_summary").agg(F.sum("output_frames")).first()[0]
    loop = tmp_path / "loop.json"
    curation.write_json(loop, {"parent_manifest": str(loop)})
    with pytest.raises(ValueError, match="circle"):
        curation.read_chain(loop)
    curation.write_json(tmp_path / "old.json", {"format": "overlay"})
    with pytest.raises(ValueError, match="rerun the preceding stages"):
        curation.read_chain(tmp_path / "old.json")
    with pytest.raises(ValueError):
        curation.Config.layered({"nonsense": 1})
    one, two = f.select(*KEYS, *ORDER, "state"), f.filter("frame_index = 1").select(*KEYS, *ORDER, F.array(F.lit(9.0)).alias("state"))
    fixed = {(r["episode_index"], r["frame_index"]): r["state"] for r in curation.overlay_repairs([one, two, two.withColumn("state", F.lit(None).cast("array<double>"))], ["state"]).collect()}
    assert fixed[0, 1] == [9.0] and len(fixed[0, 2]) == 3
    assert curation.order_violations(f).count() == 1  # the second episode's numbers begin anew


def test_legacy_pipeline(spark):
    t = np.linspace(0, 6, 120)
    s = np.stack([np.sin(t), np.cos(t), 0 * t], axis=1)
    bad = s.copy()
    bad[60, 0] += 5
    f = make(spark, s).unionByName(make(spark, bad, s, episode=1)).unionByName(make(spark, s[:1], episode=2)).unionByName(make(spark, np.random.default_rng(0).normal(size=(80, 3)) * 50, episode=3))
    out, log = legacy.run(f, legacy.Config(gripper={"state": (2,), "action": (2,)}, dof=2))
    got = {(r["episode_index"], r["stage"]): (r["reason"], r["rejected"]) for r in log.collect()}
    assert got[2, "stage1_sudden_change"] == ("episode_too_short_for_savgol", False) and got[3, "stage1_sudden_change"] == (None, True)
    assert got[2, "stage2_trend_alignment"][0] == "insufficient_frames_for_trend_alignment" and (3, "stage2_trend_alignment") not in got
    one = {r["frame_index"]: r for r in out.filter("episode_index = 1").collect()}
    assert abs(one[60]["state"][0] - s[60, 0]) < 0.2 and len(one[60]["canonical_state"]) == 128
    assert got[0, "stage4_fk_consistency"][0] == "fk_check_not_feasible" and got[0, "check3_video_quality"][0] == "no_video_frames"
    assert got[0, "stage5_orientation_alignment"][0] == "no_base_to_world_transform_configured" and got[0, "check2_video_state_consistency"][0] == "urdf_not_available"
    assert got[0, "check1_instruction_consistency"][0] == "no_language_instruction" and got[0, "unify_representation_action"] == (None, False)
    status = {r["episode_index"]: r["status"] for r in legacy.episode_status(log).collect()}
    assert status[3] == "rejected: stage1_sudden_change" and status[0] == "kept"
    assert legacy.run_totals(f, out).first()["input_episodes"] == 4


def test_contradicting_settings():
    count = lambda **how: len(legacy.warnings(legacy.Config(**how)))
    assert count() == 0 and count(urdf="u") == 2 and count(urdf="u", chain_feasible=True, chain_for_pictures=True) == 0
    assert count(chain_feasible=True) == count(chain_for_pictures=True) == count(has_instruction=True) == 1
    assert count(urdf="u", chain_feasible=True, chain_for_pictures=True, has_calibration=True) == 1


SLIDE = """<robot name="r"><link name="base"/><link name="arm"/><link name="tip"/>
<joint name="j" type="prismatic"><parent link="base"/><child link="arm"/><axis xyz="1 0 0"/></joint>
<joint name="e" type="fixed"><parent link="arm"/><child link="tip"/><origin xyz="0 0 1"/></joint></robot>"""


def test_chain_stages(spark):
    x = np.linspace(0, 1, 20)
    pose = np.stack([x, x, 0 * x, 0 * x + 1, 0 * x, 0 * x, 0 * x, 0 * x + 1], axis=1)  # joint, position, quaternion
    off = pose.copy()
    off[:, 2] += 0.5
    rough = pose.copy()
    rough[::2, 3] += 0.2
    rough[1::2, 3] -= 0.2
    f = make(spark, pose).unionByName(make(spark, off, episode=1)).unionByName(make(spark, rough, episode=2)).unionByName(make(spark, x[:, None], episode=3))
    cfg = legacy.Config(dof=1, urdf=SLIDE, chain_feasible=True)
    out, log = legacy.correct_tips(f, cfg)
    got = {r["episode_index"]: r for r in log.collect()}
    assert [got[n]["reason"] for n in range(4)] == [None, None, None, "fk_check_not_feasible"] and [got[n]["manual_review"] for n in range(4)] == [False, False, True, False]
    assert np.allclose(by_frame(out.filter("episode_index = 1"), "state"), pose)
    assert legacy.correct_tips(f, legacy.Config(dof=2, urdf=SLIDE, chain_feasible=True))[1].filter("reason is null").count() == 0
    turn = (0.0, -1.0, 0.0, 1.0, 1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 1.0)
    out, log = legacy.align_orientation(f, legacy.Config(dof=1, base_to_world=turn))
    assert {r["episode_index"]: r["reason"] for r in log.collect()} == {0: None, 1: None, 2: None, 3: "state_too_narrow_for_eef_slice"}
    assert np.allclose(by_frame(out.filter("episode_index = 0"), "state")[3], [x[3], 1.0, x[3], 1.0, 0, 0, 0.5**0.5, 0.5**0.5])
    assert legacy.align_orientation(f, legacy.Config(base_to_world=(1.0,)))[1].first()["reason"] == "invalid_base_to_world_transform"


def test_pictures_against_the_chain(spark):
    pose = np.stack([np.linspace(0, 1, 20)], axis=1)
    f = make(spark, pose).unionByName(make(spark, pose, episode=1)).unionByName(make(spark, pose, episode=2)).unionByName(make(spark, pose, episode=3))
    looks = [float(x) for x in (1, 0, 0, 0, 0, 1, 0, 0, 0, 0, 1, 1, 0, 0, 0, 1)]
    away = [float(x) for x in (1, 0, 0, 0, 0, 1, 0, 0, 0, 0, 1, -9, 0, 0, 0, 1)]
    cams = spark.createDataFrame([("a", 0, "front", [10.0, 10.0, 5.0, 5.0], looks), ("a", 1, "front", [10.0, 10.0, 5.0, 5.0], away), ("a", 2, "side", [10.0, 10.0, 5.0, 5.0], looks)], "dataset_uid string, episode_index bigint, view string, intrinsics array<double>, extrinsics array<double>")
    pics = spark.createDataFrame([("a", e, t, "front", 12, 16, [0.0] * 192) for e in range(4) for t in range(20)], "dataset_uid string, episode_index bigint, frame_index bigint, view string, height int, width int, gray array<double>")
    cfg = legacy.Config(dof=1, urdf=SLIDE, chain_for_pictures=True, has_calibration=True, gripper_radius=0.4)
    see = lambda seg, cfg=cfg: {r["episode_index"]: r["reason"] for r in legacy.check_pictures(f, pics, cams, cfg, seg).collect()}
    box = lambda gray, b: geometry.disk((b[0] + b[2]) / 2, (b[1] + b[3]) / 2, (b[2] - b[0]) / 2, *gray.shape)
    assert see(box) == {0: None, 1: "fk_projection_behind_camera", 2: "camera_calibration_missing_for_view", 3: "camera_calibration_not_available"}
    assert see(lambda gray, b: np.zeros(gray.shape, bool))[0] == "video_state_inconsistent"
    assert see(None)[0] == "sam3_service_not_configured"
    from dataclasses import replace

    assert see(box, replace(cfg, gripper_radius=None))[0] == "gripper_radius_not_configured" and see(box, replace(cfg, dof=2))[0] == "fk_check_not_feasible"
    assert see(box, replace(cfg, chain_for_pictures=False))[0] == "urdf_not_available" and see(box, replace(cfg, has_calibration=False))[0] == "camera_calibration_not_available"
    assert spark.range(1).select(legacy.sampled_places(F.lit(20)).alias("p"), legacy.sampled_places(F.lit(3)).alias("q"), legacy.sampled_places(F.lit(0)).alias("r")).first() == ([0, 5, 10, 14, 19], [0, 1, 2], [])


def test_all_frames_lost_by_pictures(spark):
    t = np.linspace(0, 6, 40)
    f = make(spark, np.stack([np.sin(t), np.cos(t)], axis=1)).unionByName(make(spark, np.stack([np.sin(t), np.cos(t)], axis=1), episode=1))
    pics = spark.createDataFrame([("a", 0, i, v, 4, 4, [0.0 if v == "x" else 100.0] * 16) for i in range(40) for v in "xy"], "dataset_uid string, episode_index bigint, frame_index bigint, view string, height int, width int, gray array<double>")
    out, log = legacy.run(f, legacy.Config(dof=1, low=0.0, high=1.0), pictures=pics)
    got = {(r["episode_index"], r["stage"]): (r["reason"], r["rejected"]) for r in log.collect()}
    assert got[0, "run_pipeline"] == ("all_frames_dropped", True) and got[1, "check3_video_quality"] == ("no_video_frames", False)
    assert {r[0] for r in out.select("episode_index").distinct().collect()} == {1}
    d = legacy.dropped_frames(f, f.filter("episode_index = 1 and frame_index > 1")).orderBy("episode_index").collect()
    assert [(len(r["dropped_frame_indices"]), r["output_frame_count"]) for r in d] == [(40, 0), (2, 38)]


def test_pictures(spark):
    rng = np.random.default_rng(4)
    busy = rng.uniform(0, 255, (6, 8))
    pics = [np.zeros((6, 8)), np.full((6, 8), 100.0), busy, busy, busy, busy, rng.uniform(0, 255, (6, 8))]
    df = spark.createDataFrame([("a", 0, t, 6, 8, p.ravel().tolist()) for t, p in enumerate(pics)], "dataset_uid string, episode_index bigint, frame_index bigint, height int, width int, gray array<double>")
    s = legacy.picture_scores(df, KEYS, ORDER)
    got = by_frame(legacy.picture_flags(s, KEYS, ORDER, F.lit(False), legacy.Config(still_run=3)), "reason")
    assert got == ["black", "blurry", "still", "still", "still", "still", None]
    got = by_frame(legacy.picture_flags(s, KEYS, ORDER, F.col("frame_index") == 3, legacy.Config(still_run=3)), "reason")
    assert got[3] is None


def test_instruction_client(spark):
    df = spark.createDataFrame([("a", 0, "pick"), ("a", 1, None), ("a", 2, " ")], "dataset_uid string, episode_index bigint, instruction string")
    none = {r["episode_index"]: r["reason"] for r in legacy.check_instructions(df, None).collect()}
    assert none == {0: "vlm_service_not_configured", 1: "no_language_instruction", 2: "no_language_instruction"}

    def fails(pdf):
        raise OSError

    assert legacy.retrying(fails, wait=0)(df.toPandas())["reason"].tolist() == ["vlm_call_failed"] * 3


def test_packing_of_both_widths(spark, tmp_path):
    from trajlake.queries import planning

    rows = [("a", 0, t, t, [float(x) for x in range(1, n + 1)], [2.0 * x for x in range(1, n + 1)], None) for t, n in enumerate((7, 8))]
    spark.createDataFrame(rows, "dataset_uid string, episode_index bigint, frame_index bigint, index bigint, `observation.state` array<double>, action array<double>, `observation.tcp_force` array<double>").write.parquet(str(tmp_path / "frames.parquet"))
    got = {r["frame_index"]: r[3:] for r in planning.canonical_pack(spark, str(tmp_path)).collect()}
    assert got == {0: (1.0, 6.0, 0.0, 7.0, 128), 1: (1.0, 6.0, 7.0, 8.0, 128)}
    got = {r["frame_index"]: r[3:] for r in planning.canonical_action(spark, str(tmp_path)).collect()}
    assert got == {0: (1.0, 0.0, 0.0, 14.0), 1: (1.0, 7.0, 0.0, 16.0)}


def test_calibration_counts_all_frames(spark):
    rng = np.random.default_rng(5)
    x = np.column_stack([2246 + rng.normal(size=200_200), rng.choice([-1.5, -0.0, 0.0, 3.0], 200_200), np.where(rng.random(200_200) < 0.1, np.nan, rng.normal(size=200_200) * 1e-3)])
    x[:3, 0], x[1::2, 0] = [np.inf, -np.inf, 1e9], x[1::2, 0] + 5  # every second frame differs
    f = spark.createDataFrame(__import__("pandas").DataFrame({"g": "a", "t": range(len(x)), "v": x.tolist()}), "g string, t bigint, v array<double>").unionByName(spark.createDataFrame([(None, 0, [1.0, None]), ("b", 1, None)], "g string, t bigint, v array<double>"))
    got = {(r["g"], r["dimension"]): r for r in quantiles.quantile_bounds(f, "g", ["v"], alpha=0.1).collect()}
    limits = {(r["g"], r["dimension"]): r["threshold"] for r in quantiles.robust_limits(f, "g", ["v"]).collect()}
    assert set(got) == set(limits) == {("a", 0), ("a", 1), ("a", 2), (None, 0), (None, 1)}
    for d in range(3):
        v = x[np.isfinite(x[:, d]), d]
        low, high, mid, top = np.quantile(v, [0.01, 0.99, 0.5, 0.999])
        assert [got["a", d][c] for c in ("q_low", "q_high", "lower", "upper")] == pytest.approx([low, high, low - 0.1 * (high - low), high + 0.1 * (high - low)], rel=1e-12)
        assert limits["a", d] == pytest.approx(max(mid + 8 * 1.4826 * np.median(np.abs(v - mid)), top, max(np.quantile(np.abs(v), 0.99), 1) * 1e-10), rel=1e-12)
    assert got[None, 0]["q_low"] == 1.0 and got[None, 1]["q_low"] is None and limits[None, 1] is None


def test_stages_take_all_frames(spark):
    x = np.tile([[0.0], [1.0], [2.0], [100.0]], (10, 1))
    f = make(spark, x).withColumn("valid", F.lit(True))
    (r,) = curation.stage3(f, cfg=curation.Config(samples=10))["thresholds"].filter("feature = 'state'").collect()
    assert (r["q_low"], r["q_high"]) == (0.0, 100.0)
    y = np.random.default_rng(1).normal(size=(80, 1))
    every, few = (curation.stage1(make(spark, y), curation.Config(samples=n))["thresholds"].orderBy("feature").collect() for n in (1000, 10))
    assert every == few


FRAMES_SCHEMA = "dataset_uid string, episode_index bigint, frame_index bigint, index bigint, `observation.state` array<double>, action array<double>, `observation.tcp_force` array<double>"


def test_large_readings_count(spark, tmp_path):
    from trajlake.queries import catalog, planning
    from trajlake.queries import signals as queries

    rows = [("a", t // 2, t, t, [1e6 + t], [1e6], [-2000.0 - t, 5.0, -1.0]) for t in range(4)] + [("a", 2, 9, 9, [NAN], [1e6], [NAN, 0.0, 0.0])]
    spark.createDataFrame(rows, FRAMES_SCHEMA).write.parquet(str(tmp_path / "frames.parquet"))
    assert queries.offset_stats(spark, str(tmp_path)).first()["m0"] == -2001.5
    p = queries.pooled_stats(spark, str(tmp_path)).filter("feature = 'state'").first()
    assert (p["n"], p["mean"]) == (4, 1000001.5) and p["std"] == pytest.approx(1.25**0.5)
    assert planning.psnr(spark, str(tmp_path)).first()["psnr"] == pytest.approx(20 * np.log10(255 / np.sqrt(14 / 4)), abs=1e-6)
    assert catalog.overlay_repairs(spark, str(tmp_path)).first()["total"] == pytest.approx(-(2000 + 2001 + 2002 + 2003))


def test_gradients_of_any_place(spark, tmp_path):
    from trajlake.queries import signals as queries

    rows = [("a", 0, t, t, [0.0, 3.0 * (t == 3)], None, None) for t in range(7)]
    spark.createDataFrame(rows, FRAMES_SCHEMA).write.parquet(str(tmp_path / "frames.parquet"))
    assert queries.gradient_flags(spark, str(tmp_path)).first()["flagged_frames"] == 2


def best_lags_one_by_one(rows, longest, digits):
    """Each pair of frames at each lag, for non-null keys; repeated frames once, null frames last."""
    episodes = {}
    for uid, episode, frame, _, state, action, _ in rows:
        if uid is not None and episode is not None:
            episodes.setdefault((uid, episode), {}).setdefault((frame is None, frame or 0), (state, action))
    out = {}
    for key, frames in episodes.items():
        vectors = [frames[f] for f in sorted(frames)]
        wide = [min((len(v) for v in pair if v is not None), default=0) for pair in vectors]
        for d in range(max(wide)):
            place = lambda v, d=d: NAN if v is None or v[d] is None else v[d]
            best = None
            for lag in range(-longest, longest + 1):
                pairs = [(place(vectors[p][1]), place(vectors[p + lag][0])) for p in range(len(vectors)) if 0 <= p + lag < len(vectors) and d < min(wide[p], wide[p + lag])]
                if not pairs:
                    continue
                z = np.array([p for p in pairs if np.isfinite(p).all()]).reshape(-1, 2)
                value = -np.inf
                if len(z) >= 3 and (np.ptp(z, axis=0) > 0).all():
                    x, y = (z - z.mean(axis=0)).T
                    value = round(float(x @ y / np.sqrt((x @ x) * (y @ y))), digits)
                best = (value, lag) if best is None else max(best, (value, lag))
            out[(*key, d)] = (best[1], None if best[0] == -np.inf else pytest.approx(best[0], abs=2e-6))
    return out


def test_best_lags_of_odd_episodes_in_many_tasks(spark):
    r = np.random.default_rng(5)
    walk = (np.round(r.normal(size=(330, 2)).cumsum(axis=0) * 8) / 8).tolist()
    rows = [("a", 0, 3 * t, t, [*walk[t], 1.0], [*walk[t + 7], 0.1], None) for t in range(320)]  # seven frames late, the last place at rest
    rows += rows[30:60] + [("a", 0, None, 0, [1e9, 2.0, 3.0], [1e9, 0.0, 0.1], None)]
    rows += [("a", 1, t, t, [0.1 + 5.2 * (t == 0), 1.0], [float(t % 5), 2.0], None) for t in range(20)]  # at rest without its first frame
    rows += [("b", n, t, t, [float(x) for x in r.integers(0, 3, n % 3 + 1)], [float(x) for x in r.integers(0, 3, 2)], None) for n in range(1, 25) for t in range(n)]
    odd = [None, [], [NAN, 1.0], [None, 2.0], [float("inf"), 3.0], [4.0], [1.0, 2.0, 3.0], [-1e9, 0.5]]
    rows += [("c", 0, t, t, odd[r.integers(8)], odd[r.integers(8)], None) for t in range(60)] + [("c", 1, t, t, None, None, None) for t in range(3)]
    rows += [(None, 0, t, t, [float(t)], [float(t)], None) for t in range(9)] + [("c", None, t, t, [float(t)], [float(t)], None) for t in range(9)]
    frames = spark.createDataFrame([rows[i] for i in r.permutation(len(rows))], FRAMES_SCHEMA.replace("`observation.state`", "state"))
    want = best_lags_one_by_one(rows, 15, 6)
    assert (want["a", 0, 0][0], want["a", 0, 1][0], want["a", 0, 2]) == (0, 7, (15, None))  # the last frame's 1e9 outweighs the first place
    for tasks, batch, adaptive in ((40, 7, "false"), (3, 10000, "false"), (4, 100, "true")):
        old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.adaptive.enabled")}
        try:
            for k, v in zip(old, (tasks, batch, adaptive)):
                spark.conf.set(k, v)
            got = {tuple(x)[:3]: tuple(x)[3:] for x in trend.best_lags(frames, KEYS, ORDER, "state", "action", 15, 6).collect()}
        finally:
            for k, v in old.items():
                spark.conf.set(k, v)
        assert got == want


def test_best_lag_shuffles_frames_and_not_their_pairs(spark, tmp_path):
    from trajlake.queries import signals as queries

    r = np.random.default_rng(2)
    rows = [("a", e, t, t, r.normal(size=7).tolist(), r.normal(size=7).tolist(), None) for e in range(20) for t in range(100)]
    spark.createDataFrame(rows, FRAMES_SCHEMA).coalesce(1).write.parquet(str(tmp_path / "frames.parquet"))
    size = sum(p.stat().st_size for p in (tmp_path / "frames.parquet").glob("*.parquet"))
    context = spark.sparkContext._jsc.sc()

    def shuffled():
        context.listenerBus().waitUntilEmpty(30_000)
        return context.statusStore().executorSummary("driver").totalShuffleWrite()

    before = shuffled()
    assert len(queries.best_lag_correlation(spark, str(tmp_path)).collect()) == 140
    assert 0 < shuffled() - before < 4 * size
