"""Containers of arrays, calibrations, probes, and checks of written datasets."""

import io
import json
import pickle
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from trajlake.sources import containers as X
from trajlake.sources import sinks


def write(path, arrays):
    path.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w") as z:
        for name, x in arrays.items():
            b = io.BytesIO()
            np.save(b, np.asarray(x), allow_pickle=False)
            z.writestr(f"{name}.npy", b.getvalue())


def demo(n, start=0.0):
    return {"obs/q": np.arange(2.0 * n).reshape(n, 2) + start, "actions": np.ones((n, 3))}


def test_many_episodes_in_a_container(spark, tmp_path):
    fields = {"state": "obs/q", "action": "actions"}
    two = {f"data/{g}/{k}": v for g, n in (("demo_2", 2), ("demo_10", 1)) for k, v in demo(n).items()}
    write(tmp_path / "c/b2.npz", two | {"data/other/obs/q": np.zeros((1, 2))})
    write(tmp_path / "c/b10.npz", {f"data/demo_0/{k}": v for k, v in demo(3, 100.0).items()} | {"data/demo_1/obs/q": [[1.0, np.nan]], "data/demo_1/actions": np.ones((1, 3)), "data/demo_3/obs/q": np.ones((2, 2)), "data/demo_3/actions": np.ones((1, 3))})
    (tmp_path / "c/bad.npz").write_text("no container")
    r = X.read_containers(spark, str(tmp_path / "c/*.npz"), fields, root="data")
    bad = {(x["path"].rsplit("/", 1)[1], x["episode"]): x["error"] for x in r.filter("error is not null").collect()}
    assert "finite" in bad["b10.npz", "data/demo_1"] and "length" in bad["b10.npz", "data/demo_3"] and ("bad.npz", None) in bad and len(bad) == 3
    got = X.with_episode_numbers(r).groupBy("episode_index").agg(F.first("episode").alias("g"), F.count(F.lit(1)).alias("n")).orderBy("episode_index").collect()
    assert [tuple(x) for x in got] == [(0, "data/demo_2", 2), (1, "data/demo_10", 1), (2, "data/demo_0", 3)]
    assert X.with_episode_numbers(r).filter("episode_index = 2 and frame_index = 1").first()["state"] == [102.0, 103.0]


def test_one_episode_in_a_container(spark, tmp_path):
    write(tmp_path / "p/one.npz", {"cloud": np.zeros((4, 10, 6)), "q": np.zeros((4, 2)), "top": np.zeros((4, 8, 8, 3), np.uint8), "depth": np.zeros((4, 8, 8, 3), np.float32)})
    r = X.read_containers(spark, str(tmp_path / "p/one.npz"), {"cloud": "cloud", "state": "q"}, shapes={"cloud": (10, 6)})
    assert r.count() == 4 and len(r.first()["cloud"]) == 60
    wrong = X.read_containers(spark, str(tmp_path / "p/one.npz"), {"cloud": "cloud"}, shapes={"cloud": (10000, 6)}).collect()
    assert len(wrong) == 1 and "shape" in wrong[0]["error"]
    assert "missing" in X.read_containers(spark, str(tmp_path / "p/one.npz"), {"a": "missing"}).first()["error"]
    with open(tmp_path / "p/one.npz", "rb") as f:
        c = X.Container(f)
        assert c.cameras("") == ["top"]
    assert X.read_containers(spark, str(tmp_path / "p/none*"), {"a": "a"}).count() == 0


def test_names_of_a_model():
    xml = '<mujoco><worldbody><freejoint name="base"/><body><joint name="hip"/><joint name="ball" type="ball"/><joint type="slide"/></body></worldbody></mujoco>'
    q, v = X.model_joint_names(xml)
    assert q == [f"base_{i}" for i in range(7)] + ["hip"] + [f"ball_{i}" for i in range(4)] and len(v) == 10


def test_targets_links_segments_and_types(spark):
    f = spark.createDataFrame([("e", 0, [0.0], [1.0]), ("e", 1, [1.0], [3.0]), ("e", 2, [2.0], [9.0]), ("d", 0, [0.0], [1.0, 2.0]), ("d", 1, [0.0], None)], "e string, frame_index bigint, state array<double>, action array<double>")
    assert {(r["e"], r["frame_index"]): r["difference"] for r in X.next_frame_targets(f, ["e"]).collect()} == {("e", 1): 1.0, ("d", 0): float("inf")}
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "id string")
    assert {tuple(r) for r in X.linked_parts(ids("a", "a", "b"), ids("a", "c", "b"), "id").collect()} == {("a", 2, 1, False), ("b", 1, 1, True), ("c", 0, 1, False)}
    seg = spark.createDataFrame([("s", i, v) for i, v in enumerate([5, 5, 7, 5])], "shard string, p int, segment int")
    assert [tuple(r) for r in X.episodes_of_segments(seg, ["shard"], "p", "segment").orderBy("episode_index").collect()] == [("s", 0, 5, 0, 1, 2), ("s", 1, 7, 2, 2, 1), ("s", 2, 5, 3, 3, 1)]
    kinds = spark.createDataFrame([("x", 0, "f4"), ("x", 1, "f4"), ("x", 2, "f8")], "c string, at int, dtype string")
    assert [(r["dtype"], r["start"], r["stop"]) for r in X.dtype_runs(kinds, ["c"], ["at"]).orderBy("run").collect()] == [("f4", 0, 2), ("f8", 2, 3)]


def test_outline_of_a_pickle_calls_nothing(tmp_path):
    class Evil:
        def __reduce__(self):
            return (open, (str(tmp_path / "made"), "w"))

    o = X.pickle_outline(pickle.dumps({"obs": b"x" * (2 << 20), "act": b"yy", "evil": Evil()}))
    assert {"obs", "act", "evil"} <= set(o["texts"]) and sorted(o["payloads"]) == [2, 2 << 20] and o["skipped_bytes"] == 2 << 20 and o["calls"] >= 1
    assert not (tmp_path / "made").exists()


def test_catalog_of_tasks_and_episode_files(spark, tmp_path):
    for n, (dtype, keys) in enumerate((("float32", "ab"), ("float64", "ba"), ("int64", "ab"))):
        (tmp_path / f"t{n}/meta").mkdir(parents=True)
        (tmp_path / f"t{n}/meta/info.json").write_text(json.dumps({"codebase_version": "v2.1", "total_episodes": n, "features": {k: {"dtype": dtype, "shape": [2]} for k in keys}}))
    (tmp_path / "t9/meta").mkdir(parents=True)
    (tmp_path / "t9/meta/info.json").write_text("{")
    c = {r["folder"].rsplit("/", 1)[1]: r for r in X.task_catalog(spark, str(tmp_path)).collect()}
    assert c["t0"]["fingerprint"] == c["t1"]["fingerprint"] != c["t2"]["fingerprint"] and c["t9"]["fingerprint"] is None and c["t2"]["episodes"] == 2
    (tmp_path / "t0/meta/episodes.jsonl").write_text('{"episode_index": 0, "length": 3, "tasks": ["a"]}\nbroken\n{"episode_index": 1001, "length": 2, "tasks": []}\n')
    (tmp_path / "t0/data/chunk-000").mkdir(parents=True)
    spark.range(3).coalesce(1).toPandas().to_parquet(tmp_path / "t0/data/chunk-000/episode_000000.parquet")
    e = {r["episode_index"]: (r["path"], r["there"]) for r in X.read_episode_files(spark, str(tmp_path / "t0")).collect()}
    assert e == {0: ("data/chunk-000/episode_000000.parquet", True), 1001: ("data/chunk-001/episode_001001.parquet", False)}


def test_calibrations_and_probes(spark):
    k, m = [1.0, 1.0, 0.0, 0.0], [float(i) for i in range(16)]
    rows = [("ok", k, m), ("ok", k, m), ("half", k, None), ("moves", k, m), ("moves", k, m[::-1]), ("short", k[:3], m), ("none", None, None)]
    d = spark.createDataFrame([(e, "front", i, x) for e, i, x in rows], "e string, view string, intrinsics array<double>, extrinsics array<double>")
    got = {r["e"]: (r["problem"], r["extrinsics"]) for r in X.load_calibration(d, ["e"]).collect()}
    assert {e: p for e, (p, _) in got.items()} == {"ok": None, "half": "half", "moves": "changes", "short": "malformed", "none": "none"} and got["ok"][1] == m and got["short"][1] is None
    files = spark.createDataFrame([("a",), ("b",), ("c",)], "path string")

    def probe(path, deep):
        if path == "c":
            raise OSError("gone")
        return {"codec": "h264", "width": 4, "height": 4, "fps": 30.0 if path == "a" else None, "frames": 9}

    status = lambda p, deep=False: {r["path"]: r["status"] for r in X.probe_videos(files, p, deep).collect()}
    assert status(probe) == {"a": "header_ok", "b": "fail", "c": "error"} and status(probe, True)["a"] == "pass" and set(status(None).values()) == {"metadata_unavailable"}


def test_verification_of_a_written_dataset(spark, tmp_path):
    f = spark.createDataFrame([(e, t, [float(t), 1.0], [0.5], "fold") for e in range(3) for t in range(3 + e)], "episode_index bigint, frame_index bigint, state array<double>, action array<double>, task string")
    out = tmp_path / "set"
    sinks.write_dataset(f, str(out), 10.0)
    assert X.verify_dataset(spark, str(out)).collect() == []
    info = json.loads((out / "meta/info.json").read_text())
    info["total_frames"] = 13
    info["features"]["action"]["shape"] = [2]
    (out / "meta/info.json").write_text(json.dumps(info))
    assert {r["check"] for r in X.verify_dataset(spark, str(out)).collect()} == {"totals", "width of action"}
    data = spark.read.option("recursiveFileLookup", "true").parquet(str(out / "data")).filter("not (episode_index = 1 and frame_index = 1)").withColumn("task_index", F.lit(7)).toPandas()
    for p in (out / "data").rglob("*.parquet"):
        p.unlink()
    spark.createDataFrame(data).withColumn("observation.state", F.transform("`observation.state`", lambda x: F.when(F.col("index") == 0, F.lit(float("nan"))).otherwise(x).cast("float"))).coalesce(1).write.mode("overwrite").parquet(str(out / "data/chunk-000"))
    found = {r["check"] for r in X.verify_dataset(spark, str(out)).collect()}
    assert {"frame numbers", "global numbers", "episode lengths", "tasks", "finite observation.state"} <= found
    info["features"]["more"] = {"dtype": "float32", "shape": [1]}
    (out / "meta/info.json").write_text(json.dumps(info))
    assert [r["check"] for r in X.verify_dataset(spark, str(out)).collect()] == ["columns"]


def test_hdf5_says_what_it_needs(tmp_path):
    pytest.importorskip("numpy")
    try:
        import h5py  # noqa: F401
    except ImportError:
        (tmp_path / "x.h5").write_bytes(b"\x89HDF\r\n\x1a\n")
        with open(tmp_path / "x.h5", "rb") as f, pytest.raises(RuntimeError, match="h5py"):
            X.Container(f)
