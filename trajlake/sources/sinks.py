"""What leaves the engine: snapshots, exports, dataset folders."""

from __future__ import annotations

import json
import os
import time
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trajlake.functions.scalars import fingerprint
from trajlake.plans import catalog
from trajlake.plans.curation import publish, write_json
from trajlake.plans.storage import exists, read_text

SHARD = 1000


def publish_snapshot(spark: SparkSession, payloads: DataFrame, out: str, stage: int, size: int = SHARD) -> dict:
    """Write (episode_index, payload_json) in shards of `size` episodes; only shards that changed are written again.

    The manifest comes last and names the shards, the ones removed, and the episodes that are gone. A repeated call with
    equal payloads writes nothing and keeps the generation.
    """
    path = f"{out}/manifest.json"
    old = json.loads(read_text(path)) if exists(path) else {"shards": [], "generation": None}
    now = {r["shard"]: r.asDict() for r in catalog.shard_fingerprints(payloads, size).collect()}  # a row for each shard
    was = {s["shard"]: s for s in old["shards"]}
    write = sorted(k for k, s in now.items() if k not in was or was[k]["fingerprint"] != s["fingerprint"])
    removed = sorted(was.keys() - now.keys())
    name = lambda k: f"{out}/shards/shard={k}-{now[k]['fingerprint'][:12]}"
    gone: list[int] = []
    touched = [was[k]["path"] for k in [*write, *removed] if k in was]
    if touched:
        before = spark.read.parquet(*touched)
        gone = [r[0] for r in catalog.tombstones(before, payloads, ["episode_index"]).orderBy("episode_index").collect()]  # of changed shards only
    if write:  # one job for all changed shards; a name has the content's fingerprint, so a repetition writes the same
        marks = F.broadcast(spark.createDataFrame([(k, name(k).rsplit("=", 1)[1]) for k in write], "__k bigint, shard string"))
        rows = payloads.withColumn("__k", F.floor(F.col("episode_index") / size)).join(marks, "__k").select("shard", "episode_index", "payload_json")
        rows = rows.repartition("shard").sortWithinPartitions("shard", "episode_index")
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("shard").parquet(f"{out}/shards")
    shards = [{k2: s[k2] for k2 in ("shard", "rows", "min_episode", "max_episode", "fingerprint")} | {"path": name(k) if k in write else was[k]["path"]} for k, s in sorted(now.items())]
    manifest = {"schema_version": 1, "stage_id": stage, "shard_size": size, "shards": shards, "generation": fingerprint([[s["shard"], s["fingerprint"]] for s in shards]), "changes": {"upsert_shards": write, "removed_shards": removed, "tombstones": gone}}
    if manifest["generation"] != old["generation"]:
        write_json(path, manifest)
    return manifest


def publish_catalog(spark: SparkSession, rows: DataFrame, out: str, stage: int, expected: int, complete: bool) -> dict:
    """Backfill a stage's snapshot from catalog rows (episode_index and what is to be the payload), if their run is complete
    and there are exactly as many as expected."""
    if not complete:
        raise ValueError("the run of this stage is not complete")
    payloads = rows.select("episode_index", F.to_json(F.struct(*sorted(c for c in rows.columns if c != "episode_index"))).alias("payload_json"))
    have = payloads.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("episode_index").alias("d")).first()
    if have["n"] != expected or have["d"] != expected:
        raise ValueError(f"{have['n']} rows of {have['d']} episodes, not {expected}")
    return publish_snapshot(spark, payloads, out, stage)


# Files that say how far an output is.
INCOMPLETE, SUCCESS = "_INCOMPLETE", "_SUCCESS"


def begin_output(out: str | Path) -> Path:
    """A new folder that is marked as incomplete; one with content is an error."""
    at = Path(out)
    if at.exists() and any(at.iterdir()):
        raise FileExistsError(out)
    at.mkdir(parents=True, exist_ok=True)
    (at / INCOMPLETE).write_text(json.dumps({"started_at": time.time()}))
    return at


def finish_output(out: str | Path) -> None:
    """Mark a folder as finished: the mark of success comes before the other one goes."""
    at = Path(out)
    if not (at / INCOMPLETE).is_file():
        raise FileNotFoundError(f"{out} was not begun")
    (at / SUCCESS).write_text(json.dumps({"finished_at": time.time()}))
    (at / INCOMPLETE).unlink()


def evidence(path: str | Path, span: int = 1 << 16) -> dict:
    """Size of a file and digests of its begin, middle and end; for Parquet also its rows."""
    import hashlib

    import pyarrow.parquet as pq

    size = os.path.getsize(path)
    with open(path, "rb") as f:
        digests = []
        for at in (0, max(0, size // 2 - span // 2), max(0, size - span)):
            f.seek(at)
            digests.append(hashlib.sha256(f.read(span)).hexdigest())
    return {"bytes": size, "sha256": digests, "rows": pq.read_metadata(path).num_rows if str(path).endswith(".parquet") else None}


def commit_unit(staged: str | Path, target: str | Path, unit: str) -> dict:
    """Publish a unit's files in two steps: the intent with evidence of every file is written first, the files are moved one by
    one, then the commit. A repetition after a break goes on where it ended; a file that does not match is an error."""
    staged, target = Path(staged), Path(target)
    intent, done = target / f"commits/{unit}.intent.json", target / f"commits/{unit}.json"
    if done.is_file():
        return json.loads(done.read_text())
    if intent.is_file():
        want = json.loads(intent.read_text())
    else:
        want = {"unit": unit, "files": {str(p.relative_to(staged)): evidence(p) for p in sorted(staged.rglob("*")) if p.is_file()}}
        write_json(intent, want)
    for name, proof in want["files"].items():
        at = target / name
        if not at.is_file():
            at.parent.mkdir(parents=True, exist_ok=True)
            os.replace(staged / name, at)
        if evidence(at) != proof:
            raise ValueError(f"{at} is not what was to be published")
    os.replace(intent, done)
    return want


def snapshot_from_folders(spark: SparkSession, folders: Sequence[str], out: str, stage: int) -> dict:
    """Backfill from JSON files named by episode; of equal episodes the last folder's holds."""
    parts = None
    for n, f in enumerate(folders):
        d = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(f).select(F.try_parse_json(F.decode("content", "UTF-8")).alias("v"), F.lit(n).alias("n"))
        parts = d if parts is None else parts.unionByName(d)
    rows = parts.select(F.try_variant_get("v", "$.episode_index", "bigint").alias("episode_index"), F.to_json("v").alias("payload_json"), "n").filter("episode_index is not null")
    last = rows.groupBy("episode_index").agg(F.max_by("payload_json", F.struct("n", "payload_json")).alias("payload_json"))
    return publish_snapshot(spark, last, out, stage)


def export_subset(frames: DataFrame, episodes: DataFrame, expression: str, out: str, keys: Sequence[str]) -> dict:
    """Write the frames of the listed episodes for which an expression holds, and a manifest; both are applied."""
    rows = frames.join(episodes.select(*keys).distinct(), [*keys], "left_semi").filter(expression)
    rows.write.mode("errorifexists").option("compression", "zstd").parquet(f"{out}/data")
    done = frames.sparkSession.read.parquet(f"{out}/data").agg(F.count(F.lit(1)).alias("frames"), F.count_distinct(F.struct(*keys)).alias("episodes")).first().asDict()
    write_json(f"{out}/manifest.json", {"expression": expression, **done})
    return done


def write_dataset(frames: DataFrame, out: str, fps: float, version: str = "v3.0", overwrite: bool = False) -> None:
    """One dataset's frames (episode_index, frame_index, state, action, task) as a folder with metadata, atomically.

    Vectors become single precision. Vectors of different widths, and a task that changes within an episode, are errors.
    """
    from trajlake.plans.units import first_seen_tasks
    from trajlake.sources.datasets import constant_per_episode

    widths = frames.agg(*(f(F.size(c)).alias(f"{n}_{c}") for c in ("state", "action") for n, f in (("least", F.min), ("most", F.max)))).first()
    if any(widths[f"least_{c}"] != widths[f"most_{c}"] for c in ("state", "action")):
        raise ValueError("vectors differ in width")
    if constant_per_episode(frames, ["episode_index"], ["task"]).limit(1).count():
        raise ValueError("an episode's task changes")
    staged = f"{out}.incomplete-{int(time.time() * 1e6)}"
    tasks = first_seen_tasks(frames.select("episode_index", "task"))
    n = frames.groupBy("episode_index").agg(F.count(F.lit(1)).alias("length"), F.first("task").alias("task"))
    from trajlake.plans.prefix import cumulative

    offset = cumulative(n.withColumn("k", F.lit(0)), ["k"], "episode_index", "length", "upto").select("episode_index", (F.col("upto") - F.col("length")).alias("first"))
    rows = frames.join(offset, "episode_index").join(tasks.select("task", "task_index"), "task", "left")
    rows = rows.select("episode_index", "frame_index", (F.col("first") + F.row_number().over(_frame_order()) - 1).alias("index"), F.col("state").cast("array<float>").alias("observation.state"), F.col("action").cast("array<float>").alias("action"), "task_index")
    rows.repartitionByRange("episode_index").sortWithinPartitions("episode_index", "frame_index").write.option("compression", "zstd").parquet(f"{staged}/data/chunk-000")
    n.select("episode_index", "length", F.array("task").alias("tasks")).coalesce(1).write.parquet(f"{staged}/meta/episodes")
    tasks.select("task_index", "task").coalesce(1).write.parquet(f"{staged}/meta/tasks.parquet")
    total = n.agg(F.count(F.lit(1)).alias("e"), F.coalesce(F.sum("length"), F.lit(0)).alias("f")).first()
    feature = lambda c: {"dtype": "float32", "shape": [widths[f"most_{c}"]], "names": None}
    write_json(f"{staged}/meta/info.json", {"codebase_version": version, "fps": fps, "total_episodes": total["e"], "total_frames": total["f"], "features": {"observation.state": feature("state"), "action": feature("action")}})
    publish(staged, out, overwrite)


def _frame_order():
    from pyspark.sql import Window

    return Window.partitionBy("episode_index").orderBy("frame_index")
