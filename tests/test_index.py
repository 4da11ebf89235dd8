"""Rows of artefacts, refreshing, identifiers, and the stateful stream."""

import json

import pytest
from pyspark.sql import functions as F

from trajlake.plans import index
from trajlake.streaming import ingest


def test_rows_of_artefacts(spark):
    s = spark.createDataFrame([("d", 0, 20, 2, False), ("d", 1, 30, 0, False), ("d", 2, 10, 0, True)], "dataset_uid string, episode_index bigint, num_frames bigint, flagged_frames bigint, reject_episode boolean")
    flags = spark.createDataFrame([("d", 0, 3), ("d", 0, 4)], "dataset_uid string, episode_index bigint, frame_index bigint")
    got = {r["episode_index"]: r for r in index.label_rows(s, flags, 1, "stage1_sudden_change").collect()}
    assert [got[i]["verdict"] for i in range(3)] == ["anomaly", "pass", "filtered"] and got[2]["severity"] == "critical"
    assert [tuple(x) for x in got[0]["ranges"]] == [(3, 4, "stage1_sudden_change")] and got[0]["score"] == 0.1
    p = [(6, {"status": "complete", "quality": {"uncertainties": ["a"]}}), (7, {"decision": "fail", "median_iou": 0.2, "failed_frames": [5, 2]}), (8, {"disposition": "exclude_episode_from_training", "invalid_ranges": [{"start": 1, "end": 4, "reason": "x"}, {"start": 4, "end": 4}]})]
    df = spark.createDataFrame([("d", 0, s, json.dumps(x)) for s, x in p] + [("d", 1, 6, "{")], "dataset_uid string, episode_index bigint, stage_id int, payload_json string")
    got = {(r["episode_index"], r["stage_id"]): r for r in index.payload_rows(df).collect()}
    assert got[0, 6]["verdict"] == "complete" and got[0, 6]["anomaly_count"] == 1
    assert got[0, 7]["score"] == 0.2 and [x["frame_start"] for x in got[0, 7]["ranges"]] == [2, 5]
    assert [tuple(x) for x in got[0, 8]["ranges"]] == [(1, 3, "x")] and got[0, 8]["severity"] == "critical" and got[1, 6]["verdict"] == "unreadable"


def test_refresh(spark):
    found = spark.createDataFrame([("a", 1), ("b", 2), ("c", 1)], "path string, size int")
    known = spark.createDataFrame([("a", 1), ("b", 1), ("x", 1)], "path string, size int")
    changes = index.source_changes(found, known, ["path"], ["size"])
    assert {tuple(r) for r in changes.collect()} == {("a", "unchanged"), ("b", "changed"), ("c", "new"), ("x", "gone")}
    old, new = (spark.createDataFrame([(p, v) for p in "abcx"], "path string, v string") for v in ("old", "new"))
    assert {tuple(r) for r in index.refresh(old, new, changes, "path").collect()} == {("a", "old"), ("b", "new"), ("c", "new")}
    m = {"schema_version": 1, "stage_id": 1, "generation": "g", "shards": []}
    assert [index.refresh_decision(*x) for x in ((None, None), (m, None), (m, {"stage_id": 1, "generation": "g"}), (m, {"stage_id": 1, "generation": "h"}))] == ["files", "all", "nothing", "shards"]
    with pytest.raises(ValueError):
        index.refresh_decision({"schema_version": 2}, None)


def test_identifiers_stay(spark):
    c = spark.createDataFrame([("/x", "u"), ("/y", "u"), ("/z", "v")], "root string, candidate string")
    one = {r["root"]: r["uid"] for r in index.unique_uids(c).collect()}
    assert one["/z"] == "v" and one["/x"] == "u" and one["/y"].startswith("u--") and len(one["/y"]) == 11
    more = c.unionAll(spark.createDataFrame([("/w", "v")], c.schema))
    two = {r["root"]: r["uid"] for r in index.unique_uids(more, spark.createDataFrame(list(one.items()), "root string, uid string")).collect()}
    assert {k: two[k] for k in one} == one and two["/w"].startswith("v--")
    import hashlib

    h = hashlib.sha256(b"/n").hexdigest()  # the short end is taken by another root
    taken = spark.createDataFrame([("/a", "w"), ("/b", f"w--{h[:8]}")], "root string, uid string")
    three = {r["root"]: r["uid"] for r in index.unique_uids(spark.createDataFrame([("/n", "w")], c.schema), taken).collect()}
    assert three == {"/n": f"w--{h[:12]}"}


def test_snapshots_are_trusted_with_their_source(tmp_path):
    import hashlib

    (tmp_path / "m.json").write_text("{}")
    m = {"schema_version": 1, "stage_id": 1, "generation": "g", "shards": [], "source_manifest": {"path": "m.json", "fingerprint": hashlib.sha256(b"{}").hexdigest()}}
    assert index.refresh_decision(m, None, str(tmp_path)) == "all"
    (tmp_path / "m.json").write_text("{ }")
    assert index.refresh_decision(m, None, str(tmp_path)) == "files"
    with pytest.raises(ValueError):
        index.refresh_decision(m | {"source_manifest": {"path": "../x", "fingerprint": ""}}, None, str(tmp_path))


def test_jobs(spark):
    from trajlake.plans import jobs

    tries = []

    def work(s, n):
        tries.append(n)
        if len(tries) < 2:
            raise OSError("once")
        return s.range(n).count()

    job = jobs.Job(spark, "count", work, 5, retries=2).start().wait(60)
    assert (job.state, job.result, job.attempts, tries) == ("done", 5, 2, [5, 5]) and job.progress()["state"] == "done"
    failed = jobs.Job(spark, "fails", lambda s: 1 / 0).start().wait(60)
    assert failed.state == "failed" and isinstance(failed.error, ZeroDivisionError)
    import time

    slow = jobs.Job(spark, "slow", lambda s: s.range(0, 10**12, 1, 4).selectExpr("sum(id * id % 7)").collect()).start()
    time.sleep(3)
    slow.cancel()
    assert slow.wait(60).state == "cancelled" and not slow._thread.is_alive()

    class Even:
        def validate(self, frames):
            if "frame_index" not in frames.columns:
                raise ValueError("no frames")

        def process(self, frames):
            return frames.withColumn("label", F.col("frame_index") % 2 == 0)

        def aggregate(self, labels):
            return labels.agg(F.count_if("label").alias("even"))

    assert jobs.run_stage(Even(), spark.range(5).withColumnRenamed("id", "frame_index"))[1].first()["even"] == 3
    with pytest.raises(ValueError):
        jobs.run_stage(Even(), spark.range(5))


def test_keys_of_services(monkeypatch):
    from trajlake.plans import legacy

    assert legacy.service_key(None, None) is None
    for variable in (None, "TRAJLAKE_NO_SUCH_KEY"):
        with pytest.raises(RuntimeError, match="not set"):
            legacy.service_key("http://x", variable)
    monkeypatch.setenv("TRAJLAKE_KEY", "k")
    assert legacy.service_key("http://x", "TRAJLAKE_KEY") == "k"


def test_annotations_are_added_and_reviewed(spark):
    from trajlake.plans import catalog as C

    kind = "annotation_id string, dataset_uid string, episode_index bigint, review_status string, reviewer string, created_at double"
    a = spark.createDataFrame([("1", "d", 0, "pending", None, 2.0), ("2", "d", 1, "pending", None, 1.0)], kind)
    a = C.add_annotation(a, spark.createDataFrame([("3", "d", 0, "pending", 0.5)], "annotation_id string, dataset_uid string, episode_index bigint, review_status string, created_at double"))
    assert [r["annotation_id"] for r in C.list_annotations(a, "d").collect()] == ["3", "2", "1"] and [r["annotation_id"] for r in C.list_annotations(a, "d", 0).collect()] == ["3", "1"]
    b = C.review(a, "1", "accepted", "me", 9.0)
    assert b.count() == 4 and {r["annotation_id"]: r["review_status"] for r in C.list_annotations(b, "d").collect()} == {"1": "accepted", "2": "pending", "3": "pending"}


def test_series_of_episodes(spark):
    from trajlake.plans import curation

    f = spark.createDataFrame([("d", e, t, [float(t)], [0.0]) for e in range(2) for t in range(5)], "dataset_uid string, episode_index bigint, frame_index bigint, state array<double>, action array<double>")
    s = curation.episode_series(f, ["state"], 10.0, episode=("d", 1), limit=3).collect()
    assert [(r["frame_index"], r["episode_time"], r["state"]) for r in s] == [(0, 0.0, [0.0]), (1, 0.1, [1.0]), (2, 0.2, [2.0])]
    bad = f.filter("frame_index = 1").select("dataset_uid", "episode_index", "frame_index", F.lit(False).alias("valid"))
    assert [r["state"] for r in curation.episode_series(f, ["state"], 10.0, "valid", validity=bad, episode=("d", 0), limit=2).collect()] == [[0.0], [None]]


def test_discovery_at_the_staging_root(tmp_path):
    from trajlake.sources import datasets

    for d in ("a", "b/c", "d/e/f/g/h"):
        (tmp_path / d / "meta").mkdir(parents=True)
        (tmp_path / d / "meta/info.json").write_text("{}")
    assert [p.name for p in datasets.discover(tmp_path)] == ["a", "c"] and [p.name for p in datasets.discover(tmp_path, staging=tmp_path)] == ["a"]
    import numpy as np

    assert datasets.picture_bytes(np.array([[[0.0, 1.2]], [[0.5, -1.0]]])).tolist() == [[[0, 128], [255, 0]]]


def test_values_of_any_type_are_close(spark):
    from trajlake.functions.scalars import close_values

    kind = "a struct<x:array<double>,n:int>, b struct<x:array<double>,n:int>"
    cases = [((([1.0, float("nan")], 1), ([1.0 + 1e-9, float("nan")], 1)), True), ((([1.0], 1), ([1.0, 2.0], 1)), False), ((([1.0], 1), ([1.0], 2)), False), ((None, None), True), ((([1.0], 1), None), False), (((None, 1), (None, 1)), True), ((([], 1), (None, 1)), False), ((([1.0, None], None), ([1.0, None], None)), True)]
    df = spark.createDataFrame([c for c, _ in cases], kind)
    assert [r["c"] for r in df.select(close_values(F.col("a"), F.col("b"), df.schema["a"].dataType).alias("c")).collect()] == [w for _, w in cases]


def test_small_parts(spark):
    got = [r["p"] for r in spark.createDataFrame([(0,), (1,), (3,), (10,)], "n bigint").select(index.sample_places(F.col("n")).alias("p")).collect()]
    assert got == [[], [0], [0, 1, 2], [0, 2, 4, 7, 9]]
    f = spark.createDataFrame([("a", "1"), ("a.gz", "1"), ("b.gz", "2")], "path string, sha string")
    assert {(r["path"], r["alias_of"]) for r in index.drop_aliases(f).collect()} == {("a", None), ("a.gz", "a"), ("b.gz", None)}
    with pytest.raises(ValueError):
        index.drop_aliases(f.withColumn("sha", F.col("path")))
    with pytest.raises(ValueError, match="not in the plan"):
        index.select_tasks(spark.createDataFrame([("t",)], "task string"), ["t", "u"])
    rows = spark.createDataFrame([("d", 0, 1, "pass", 2)], "dataset_uid string, episode_index bigint, stage_id int, verdict string, anomaly_count bigint")
    e = spark.createDataFrame([("d", 0), ("d", 1)], "dataset_uid string, episode_index bigint")
    got = {r["episode_index"]: r for r in index.previews(e, rows).collect()}
    assert len(got[1]["stages"]) == 8 and got[0]["stages"][0]["badge"] == "pass" and got[0]["anomalies"] == 2
    ranges = spark.createDataFrame([("d", 0, 1, 3, 4)], "dataset_uid string, episode_index bigint, stage_id int, frame_start bigint, frame_end bigint")
    d = index.stage_detail(rows, ranges, ranges.limit(0), "d", 0, 1).first()
    assert len(d["summary"]) == 1 and d["ranges"][0]["frame_end"] == 4 and d["annotations"] == []


def test_episodes_are_folded_across_batches(spark, tmp_path):
    src = str(tmp_path / "src")
    schema = "dataset_uid string, episode_index bigint, frame_index bigint, time double"
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        for part in ([("d", 0, t, float(t)) for t in range(3)], [("d", 0, 3, 3.0), ("d", 1, 0, 9.0)], [("d", 2, 0, 10.0), ("e", 0, 0, 1.0)]):
            spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(src)
            out = ingest.fold_episodes(spark.readStream.schema(schema).parquet(src))
            out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    got = sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect()))
    assert got == [("d", 0, 4, 0.0, 3.0), ("d", 1, 1, 9.0, 9.0)]
