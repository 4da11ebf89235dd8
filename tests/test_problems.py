"""Edge cases of the general data problems, against small brute-force versions."""

import random
from functools import reduce

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from trajlake.functions.types import promote, promote_all
from trajlake.operators import intervals, spikes
from trajlake.operators.dense_totals import dense_totals
from trajlake.operators.intervals import periods_and_gaps
from trajlake.operators.references import Reference, Table, find_orphans
from trajlake.operators.schema_drift import compare, parse_schema, schema_changes, union_fields
from trajlake.operators.spikes import find_spikes
from trajlake.plans.ordered import previous
from trajlake.plans.prefix import cumulative
from trajlake.plans.ranks import numbered
from trajlake.plans.skew import skew_join
from trajlake.sources.drifting import loses, promote_types, read_drifting

FRAMES = "dataset_uid string, episode_index bigint, frame_index bigint, `observation.state` array<double>, action array<double>, `observation.tcp_force` array<double>, extra string, src string"


def frames(spark, series, name="observation.state", episode=0, start=0, uid="a"):
    """Frames with one moving place and a gripper."""
    rows = []
    for t, v in enumerate(series):
        vec = None if v is None else [v, 0.0]
        rows.append((uid, episode, start + t, vec if name == "observation.state" else None, vec if name == "action" else None, None, "x", "clash"))
    return spark.createDataFrame(rows, FRAMES)


def found(df):
    return sorted((r["episode_index"], r["frame_index"], r["feature"], r["dimension"], r["kinds"]) for r in df.collect())


def wave(n, seed=0):
    rng = np.random.default_rng(seed)
    return [float(x) for x in np.sin(np.arange(n) / 9) + rng.normal(0, 0.02, n)]


def test_spikes_of_each_kind(spark):
    x = wave(400)
    x[50] = float("nan")
    x[90] = 1e6
    x[150:153] = [6.0, 6.5, 6.1]
    x[200:212] = [x[200]] * 12
    x[300:311] = [x[300]] * 11  # one too few
    x[350] = None
    got = found(find_spikes(frames(spark, x)))
    assert {(f, k) for _, f, _, _, k in got if k & 1} == {(50, 1)}
    assert {f for _, f, _, _, k in got if k & 2} == {90}
    assert {f for _, f, _, _, k in got if k & 4} >= {90, 150, 151, 152}
    assert {f for _, f, _, _, k in got if k & 8} == set(range(200, 212))
    assert {f for _, f, _, _, _ in got} == {50, 90, 150, 151, 152, *range(200, 212)}


def test_spikes_do_not_depend_on_blocks(spark, monkeypatch):
    x = wave(600, 1)
    x[100:130] = [x[100]] * 30
    x[255:258] = [9.0, 9.1, 9.2]
    whole = found(find_spikes(frames(spark, x)))
    assert len(whole) == 33
    low = (1 << 40) + spikes.BLOCK - 110  # the same frames across the edge of two blocks
    moved = found(find_spikes(frames(spark, x, start=low)))
    assert [(e, f - low, *r) for e, f, *r in moved] == whole


def test_spikes_edges(spark):
    empty = find_spikes(spark.createDataFrame([], FRAMES))
    assert empty.count() == 0 and "kinds" in empty.columns
    # a place that never moves is never stuck; the gripper never counts; null keys and vectors are left out
    still = frames(spark, [1.0] * 50)
    assert found(find_spikes(still)) == []
    grip = spark.createDataFrame([("a", 0, t, [0.1 * (t % 7), float("inf")], None, [None, 1.0, float(t)], "", "") for t in range(40)], FRAMES)
    assert found(find_spikes(grip)) == []
    nulls = spark.createDataFrame([(None, 0, 1, [float("nan"), 0.0], None, None, "", ""), ("a", None, 1, [float("nan"), 0.0], None, None, "", ""), ("a", 0, None, [float("nan"), 0.0], None, None, "", "")], FRAMES)
    assert found(find_spikes(nulls)) == []
    # repeated and late rows count once; widths may differ
    x = wave(100, 2)
    x[40] = float("inf")
    twice = frames(spark, x).unionAll(frames(spark, x)).orderBy("frame_index", ascending=False)
    assert found(find_spikes(twice)) == [(0, 40, "observation.state", 0, 1)]
    ragged = spark.createDataFrame([("a", 0, t, [float(t % 5)] * (2 + t % 3), None, None, "", "") for t in range(60)] + [("a", 0, 60, [float("nan"), 1.0, 2.0, 3.0], None, None, "", "")], FRAMES)
    assert (0, 60, "observation.state", 0, 1) in found(find_spikes(ragged))


def test_summary_merges_within_its_bound():
    rng = np.random.default_rng(0)
    parts = [rng.lognormal(size=n) for n in (10, 5000, 70_000, 1)]
    v, w = spikes.merged([spikes.summary(p) for p in parts])
    every = np.sort(np.concatenate(parts))
    for q in (0.01, 0.25, 0.5, 0.75, 0.99):
        rank = np.searchsorted(every, spikes.quantile(v, w, q)) / len(every)
        assert abs(rank - q) < 3 / spikes.POINTS


@pytest.mark.parametrize("drift", [0.0, 1e-4])
def test_summary_keeps_its_bound_over_many_merges(monkeypatch, drift):
    monkeypatch.setattr(spikes, "RAW", 2048)
    rng = np.random.default_rng(1)
    every = rng.normal(size=3_000_000) + drift * np.arange(3_000_000)
    s = spikes._Summary()
    for part in np.array_split(every, 1500):
        s.add(part)
    assert len(s.levels) == 3 and sum(map(len, s.levels)) < 48  # log_16 of 1465 pressings
    v, w = spikes._unpack([s.bytes()])
    every.sort()
    for q in (0.01, 0.1, 0.25, 0.5, 0.75, 0.99):
        rank = np.searchsorted(every, spikes.quantile(v, w, q)) / len(every)
        assert abs(rank - q) <= (2 + 3) / (2 * spikes.POINTS)


def test_spike_in_a_dimension_at_rest(spark):
    x = [5.0] * 300
    x[40], x[200] = 5.4, 5.0000001  # the second is what a sensor may show
    assert {f for _, f, *_ in found(find_spikes(frames(spark, x)))} == {40}
    step = [0.0] * 150 + [1.0] * 150  # a change of level is no spike
    assert found(find_spikes(frames(spark, step))) == []


def test_spikes_by_context(spark):
    from pyspark.sql import functions as F

    day, night = wave(300, 3), [60 + v for v in wave(300, 4)]
    day[100] = 60.0  # usual at night only
    df = frames(spark, day).withColumn("hour", F.lit(12)).unionByName(frames(spark, night, episode=1).withColumn("hour", F.lit(2)))
    assert (0, 100) not in {(e, f) for e, f, _, _, k in found(find_spikes(df)) if k & 2}
    assert {(e, f) for e, f, _, _, k in found(find_spikes(df, context=F.col("hour"))) if k & 2} == {(0, 100)}


def test_schema_layouts_and_changes():
    a = parse_schema('{"x": {"dtype": "FLOAT32", "shape": [2], "names": null}, "y": {"shape": [1], "dtype": "bool"}}')
    assert a == parse_schema('[{"name": "y", "dtype": "bool", "shape": [1]}, {"name": "x", "shape": [2], "dtype": "float32", "names": ["p", "q"]}]')
    assert a == parse_schema('{"features": {"y": {"shape": [1], "dtype": "bool"}, "x": {"dtype": "float32", "shape": [2]}}}')
    for bad in ("{}", "", None, '{"x": ', "3", "[]", '"x"'):
        assert parse_schema(bad) is None
    was = [("a", "f", "1"), ("b", "f", "2"), ("c", "i", ""), ("obs.q", "f", "3"), ("obs.r", "f", "3")]
    now = [("a", "g", "1"), ("b2", "f", "2"), ("d", "j", ""), ("obs.q_raw", "f", "3")]
    assert [x[:2] for x in compare(was, now)] == [("a", "retyped"), ("b", "renamed"), ("c", "removed"), ("d", "added"), ("obs.q", "renamed"), ("obs.r", "removed")]


SCANS = "table_name string, entity string, snapshot_id bigint, at double, fields array<struct<name:string,dtype:string,shape:string>>"


def test_schema_changes_without_a_broadcast(spark, monkeypatch):
    from trajlake.operators import schema_drift

    rng = random.Random(6)
    rows = [("t", f"e{i % 20}", i, float(i * 7000), sorted((f"f{k}", rng.choice(["i", "f"]), "") for k in rng.sample(range(8), 4))) for i in range(400)]
    scans = spark.createDataFrame(rows, SCANS)
    want = sorted(map(str, schema_changes(scans).collect()))
    monkeypatch.setattr(schema_drift, "BROADCAST_BYTES", -1)
    assert sorted(map(str, schema_changes(scans).collect())) == want and len(want) > 400
    direct = [(e, c[0], c[1]) for i, (_, e, _, _, now) in enumerate(rows) if i >= 20 for c in compare(rows[i - 20][4], now)]
    assert sorted(direct) == sorted((r["entity"], r["field_name"], r["change"]) for r in schema_changes(scans).collect())


def test_schema_changes_follow_time(spark):
    f = lambda *names: [(n, "f", n) for n in names]
    rows = [("t", "e", 9, 100.0, f("a")), ("t", "e", 3, 1e6, f("a", "b")), ("t", "e", 4, 2e6, None), ("t", "e", 5, 3e6, f("b")), ("t", "e", 5, 3e6, f("b")), ("t", None, 1, 1.0, f("z")), ("t", "one", 1, None, f("z"))]
    scans = spark.createDataFrame(rows, SCANS)
    got = sorted((r["snapshot_id"], r["field_name"], r["change"]) for r in schema_changes(scans).collect())
    assert got == [(3, "b", "added"), (5, "a", "removed")]
    assert schema_changes(spark.createDataFrame([], SCANS)).count() == 0
    union = {(r["entity"], r["field_name"]): r["in_all"] for r in union_fields(scans).collect()}
    assert union == {("e", "a"): False, ("e", "b"): False, ("one", "z"): True}


@settings(max_examples=40, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from(["", "bool", "uint8", "uint16", "int8", "int16", "int32", "int64", "uint64", "float16", "float32", "float64", "str"]), min_size=1, max_size=5))
def test_promotion_does_not_depend_on_order(kinds):
    assert promote_all(kinds) == promote_all(reversed(kinds))
    assert promote(kinds[0], kinds[0]) == promote_all(kinds[:1])
    assert reduce(promote, kinds) == promote_all(kinds) == reduce(lambda x, y: promote(y, x), kinds[::-1])
    half = len(kinds) // 2
    assert promote(promote_all(kinds[:half]), promote_all(kinds[half:])) == promote_all(kinds)


SPARK_TYPES = [T.NullType(), T.BooleanType(), T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(), T.DecimalType(10, 2), T.DecimalType(38, 0), T.StringType(), T.DateType(), T.ArrayType(T.IntegerType()), T.ArrayType(T.DoubleType()), T.MapType(T.StringType(), T.IntegerType()), T.MapType(T.StringType(), T.FloatType()), T.StructType([T.StructField("a", T.IntegerType())]), T.StructType([T.StructField("b", T.LongType()), T.StructField("a", T.DoubleType())])]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(SPARK_TYPES), min_size=1, max_size=5), st.randoms())
def test_promotion_of_columns_does_not_depend_on_order(kinds, rng):
    want = reduce(promote_types, kinds)
    mixed = kinds[:]
    rng.shuffle(mixed)
    assert reduce(promote_types, mixed) == want
    half = len(kinds) // 2
    assert promote_types(reduce(promote_types, kinds[:half], T.NullType()), reduce(promote_types, kinds[half:], T.NullType())) == want


def test_promotion_of_decimals_and_maps():
    assert promote_types(T.DecimalType(10, 2), T.IntegerType()) == T.DecimalType(12, 2)
    assert promote_types(T.DecimalType(10, 2), T.DecimalType(6, 4)) == T.DecimalType(12, 4)
    assert promote_types(T.MapType(T.StringType(), T.IntegerType()), T.MapType(T.StringType(), T.LongType())) == T.MapType(T.StringType(), T.LongType())
    assert loses(T.LongType(), promote_types(T.LongType(), T.FloatType())) and not loses(T.IntegerType(), T.DoubleType())


def test_drifting_files(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "x int, y string").coalesce(1).write.parquet(str(tmp_path / "d/1"))
    spark.createDataFrame([(2.5, True)], "x double, z boolean").coalesce(1).write.parquet(str(tmp_path / "d/2"))
    (tmp_path / "d/3").mkdir()
    (tmp_path / "d/3/broken.parquet").write_text("no")
    rows, log = read_drifting(spark, str(tmp_path / "d"))
    assert sorted(map(tuple, rows.collect()), key=str) == sorted([(1.0, "a", None), (2.5, None, True)], key=str)
    assert {(r["field_name"], r["change"]) for r in log.collect()} == {("x", "retyped"), ("y", "removed"), ("z", "added"), (None, "unreadable")}
    (tmp_path / "none").mkdir()
    assert read_drifting(spark, str(tmp_path / "none"))[0].count() == 0


def test_totals_of_hot_keys_without_a_dictionary(spark, monkeypatch):
    from trajlake.operators import dense_totals as module

    rng = np.random.default_rng(4)
    keys = np.where(rng.random(20_000) < 0.4, 0, rng.integers(0, 3000, 20_000))
    rows = [(f"k{k}", None if v % 17 == 0 else int(v)) for k, v in zip(keys, rng.integers(-(2**40), 2**40, 20_000))]
    df = spark.createDataFrame(rows, "uid string, n bigint")
    plain = {r["uid"]: tuple(r)[1:] for r in dense_totals(df, "uid", "n").collect()}
    monkeypatch.setattr(module, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(module, "PARTS", 64)
    apart = {r["uid"]: tuple(r)[1:] for r in dense_totals(df, "uid", "n").collect()}
    assert plain == apart
    for k in ("k0", "k7", "k2999"):
        v = [n for u, n in rows if u == k and n is not None]
        assert apart[k][:3] == (sum(u == k for u, _ in rows), sum(v), float(np.median(v)))


def test_dense_totals(spark):
    rng = random.Random(0)
    rows = [(rng.choice(["hot"] * 8 + [f"k{i}" for i in range(40)]), rng.choice([None, rng.randint(-5, 5), rng.randint(0, 10**12), 2**62, -(2**62)])) for _ in range(3000)] + [(None, 1), ("only_null", None), ("", 7), ("one", 3)]
    df = spark.createDataFrame([(k, v, "x") for k, v in rows], "uid string, n bigint, key string")
    got = {r["uid"]: r for r in dense_totals(df, "uid", "n").collect()}
    assert set(got) == {k for k, _ in rows if k is not None}
    for k in got:
        v = sorted(x for u, x in rows if u == k and x is not None)
        assert got[k]["rows"] == sum(u == k for u, _ in rows)
        assert got[k]["median"] == (float(np.median(np.array(v, object).astype(float))) if v else None)
        assert got[k]["least"] == (v[0] if v else None)
        total = sum(v) if v else None
        assert got[k]["total"] == (total if total is None else (total + 2**63) % 2**64 - 2**63)
    assert dense_totals(df.limit(0), "uid", "n").count() == 0


def brute_periods(rows):
    out = set()
    by = {}
    for k, e, s, t in rows:
        if s is not None and t is not None and s <= t:
            by.setdefault((k, e), []).append((s, t))
    for key, spans in by.items():
        spans.sort()
        merged = [list(spans[0])]
        for s, t in spans[1:]:
            if s <= merged[-1][1] + 1:
                merged[-1][1] = max(merged[-1][1], t)
            else:
                merged.append([s, t])
        out |= {(*key, "period", s, t) for s, t in merged}
        out |= {(*key, "gap", a[1] + 1, b[0] - 1) for a, b in zip(merged, merged[1:])}
    return out


def test_periods_and_gaps(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None, "A"]), rng.choice([0, 1, None]), rng.choice([None, rng.randint(-50, 9000)]), 0) for _ in range(400)]
    rows = [(k, e, s, None if s is None or rng.random() < 0.05 else s + rng.choice([0, 0, 1, 3, 40, -2])) for k, e, s, _ in rows]
    rows += [("hot", 0, i * 5, i * 5 + 2) for i in range(2000)] + [("hot", 0, 10, 12)] * 50 + [("hot", 0, 2**40, 2**40)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "uid string, ep bigint, a bigint, b bigint, pos int")
    for hot_rows in (intervals.HOT_ROWS, 1000, 0):  # no hot entity, one, and many
        got = [tuple(r) for r in periods_and_gaps(df, ["uid", "ep"], "a", "b", hot_rows=hot_rows).collect()]
        assert len(got) == len(set(got)) and set(got) == brute_periods(rows)
    assert periods_and_gaps(df.limit(0), ["uid", "ep"], "a", "b").count() == 0


def test_cumulative_and_previous(spark):
    rng = random.Random(2)
    rows = [("k" if i % 3 else "l", p, rng.randint(0, 9)) for i, p in enumerate(rng.sample(range(-10**6, 10**7), 500))]
    df = spark.createDataFrame(rows, "k string, p bigint, v bigint")
    for r in cumulative(df, ["k"], "p", "v", "c").collect():
        assert r["c"] == sum(v for k, p, v in rows if k == r["k"] and p <= r["p"])
    from pyspark.sql import functions as F

    for r in previous(df, ["k"], ["p"], F.floor(F.col("p") / 1000), "v", "w").collect():
        before = [(p, v) for k, p, v in rows if k == r["k"] and p < r["p"]]
        assert r["w"] == (max(before)[1] if before else None)


def test_positions_in_an_order(spark):
    rng = random.Random(7)
    rows = [(rng.choice(["hot"] * 6 + ["a", None]), i, rng.randint(-5, 5)) for i in rng.sample(range(10**6), 700)]
    df = spark.createDataFrame(rows, "k string, p bigint, v bigint").repartition(5)
    for keys in ((), ("k",)):
        got = numbered(df, ["p"], "n", keys, sums={"upto": "v"}).collect()
        assert len(got) == len(rows)
        for r in got:
            before = [v for k, p, v in rows if p < r["p"] and (not keys or k == r["k"])]
            assert (r["n"], r["upto"]) == (len(before), sum(before))
    assert [r["p"] for r in numbered(df, ["p"], "n").orderBy("n").collect()] == sorted(p for _, p, _ in rows)
    assert numbered(df.limit(0), ["p"], "n", ("k",), {"s": "v"}).count() == 0


def test_a_cluster_must_name_its_shared_folder():
    from types import SimpleNamespace

    from trajlake.plans import storage

    context = SimpleNamespace(_jsc=SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: SimpleNamespace(isDefined=lambda: False))), master="spark://host:7077")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        storage.checkpoint_dir(SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda name, default: default)))


def test_skew_join_keeps_all_rows(spark):
    rows = [("hot",)] * 3000 + [(f"k{i % 50}",) for i in range(500)] + [(None,)] * 200
    left = spark.createDataFrame([(k, i) for i, (k,) in enumerate(rows)], "k string, i int")
    side = spark.createDataFrame([("hot", 1), ("k1", 2), ("never", 3)], "k string, v int")
    got = skew_join(left, side, ["k"], part=1 / 10).collect()
    assert len(got) == len(rows)
    assert all(r["v"] == {"hot": 1, "k1": 2}.get(r["k"]) for r in got)


def test_orphans_cascade(spark):
    make = lambda rows, schema: spark.createDataFrame(rows, schema)
    a = make([("a1", None, "m1"), ("a2", "a1", "m1"), ("a3", "gone", "m2"), ("a4", "a3", "m2"), ("a5", "a4", "m3"), ("a5", "a4", "m3"), (None, "gone", "m3"), ("c1", "c2", "m4"), ("c2", "c1", "m4")], "id string, up string, month string")
    tables = {"a": Table(a, "id", "month")}
    got = {(r["record_key"], r["kind"], r["distance"]) for r in find_orphans(tables, [Reference("a", "up", ("up",), "a", ("id",))]).collect()}
    assert got == {("a3", "direct", 0), ("a4", "inherited", 1), ("a5", "inherited", 2)}
    assert find_orphans({"a": Table(a.limit(0), "id", "month")}, [Reference("a", "up", ("up",), "a", ("id",))]).count() == 0
    with pytest.raises(ValueError):
        find_orphans(tables, [])
