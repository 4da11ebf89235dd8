"""Datasets as folders: discovery, metadata, frames, episodes, tasks, file inventories."""

from __future__ import annotations

import fnmatch
import json
import os
from collections.abc import Iterator, Sequence
from functools import reduce
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trajlake.functions.scalars import GRIPPER_PARTS, video_path

# What the layout calls things.
INFO, VERSION = "meta/info.json", "v3.0"
SKIPPED = ("data", "videos", "images", "meta")
VIDEO_SUFFIXES = (".mp4", ".mkv", ".avi", ".mov", ".webm")
TASK_NAMES = ("__index_level_0__", "task", "instruction")


def discover(root: str | Path, depth: int | None = None, staging: str | Path | None = None) -> list[Path]:
    """Folders with dataset metadata, by path: at most four levels down, or one at the staging root. Hidden, unfinished and payload folders are not entered, nor datasets."""
    out: list[Path] = []

    def visit(at: Path, left: int) -> None:
        if (at / INFO).is_file():
            out.append(at)
            return
        if left > 0:
            for d in sorted(p for p in at.iterdir() if p.is_dir() and not p.name.startswith(".") and not p.name.endswith(".incomplete") and p.name not in SKIPPED):
                visit(d, left - 1)

    if depth is None:
        depth = 1 if staging is not None and Path(root).resolve() == Path(staging).resolve() else 4
    if Path(root).is_dir():
        visit(Path(root), depth)
    return sorted({p.resolve(): p for p in out}.values())


def select(names: Sequence[str], patterns: Sequence[str]) -> list[str]:
    """Names that match any glob pattern (all without patterns); a pattern that matches nothing is an error."""
    useless = [p for p in patterns if not any(fnmatch.fnmatchcase(n, p) for n in names)]
    if useless:
        raise ValueError(f"patterns without a match: {useless}")
    return [n for n in names if not patterns or any(fnmatch.fnmatchcase(n, p) for p in patterns)]


def load_info(path: str | Path, version: str = VERSION) -> dict:
    info = json.loads((Path(path) / INFO).read_text())
    if info.get("codebase_version") != version:
        raise ValueError(f"{path}: version {info.get('codebase_version')!r}, not {version}")
    return info


def dimensions(feature: dict | None) -> int:
    """Places of a feature: the product of its shape."""
    return reduce(lambda a, b: a * int(b), (feature or {}).get("shape") or [1], 1)


def names(feature: dict | None) -> list[str | None]:
    """A name for each place; names may be a list, lists in a mapping, or missing."""
    got = (feature or {}).get("names")
    if isinstance(got, dict):
        got = [x for v in got.values() for x in (v if isinstance(v, list) else [v])]
    n = dimensions(feature)
    return ([str(x) for x in got or []] + [None] * n)[:n]


def gripper_places(feature: dict | None, told: Sequence[int] = ()) -> list[int]:
    found = {i for i, n in enumerate(names(feature)) if n and any(p in n.lower() for p in GRIPPER_PARTS)}
    return sorted(found | {int(i) for i in told})


def cameras(info: dict) -> list[str]:
    return sorted({k for k, f in info.get("features", {}).items() if k.startswith("observation.images") or (f or {}).get("dtype") == "video"})


def available(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns that are there."""
    return df.select(*(F.col(f"`{c}`") for c in wanted if c in df.columns))


def as_vector(df: DataFrame, column: str) -> Column:
    """ARRAY<DOUBLE> of a vector, also where a feature of one place is stored as a scalar."""
    kind = df.schema[column].dataType
    return F.col(f"`{column}`").cast("array<double>") if isinstance(kind, T.ArrayType) else F.array(F.col(f"`{column}`").cast("double"))


def read_frames(spark: SparkSession, path: str | Path, columns: Sequence[str]) -> DataFrame:
    """Frames of a dataset, only the given vectors; `data/chunk-*/*.parquet`, else any file below `data`."""
    base = Path(path) / "data"
    files = sorted(base.glob("chunk-*/*.parquet")) or sorted(base.rglob("*.parquet"))
    if not files:
        raise FileNotFoundError(f"no frames below {base}")
    df = spark.read.parquet(*map(str, files))
    missing = {"episode_index", "frame_index", "index", *columns} - set(df.columns)
    if missing:
        raise ValueError(f"{path}: columns missing: {sorted(missing)}")
    return df.select("episode_index", "frame_index", "index", *(as_vector(df, c).alias(c) for c in columns))


def first_episodes(frames: DataFrame, n: int) -> DataFrame:
    """The first n episodes in order: a sampling operator."""
    first = frames.select("episode_index").distinct().orderBy("episode_index").limit(n)
    return frames.join(F.broadcast(first), "episode_index", "left_semi")


def read_tasks(spark: SparkSession, path: str | Path) -> DataFrame:
    """task_index and task, whatever the name's column is called; empty without the file or a name."""
    file = Path(path) / "meta/tasks.parquet"
    empty = spark.createDataFrame([], "task_index bigint, task string")
    if not file.exists():
        return empty
    df = spark.read.parquet(str(file))
    have = [F.nullif(F.col(f"`{c}`").cast("string"), F.lit("")) for c in TASK_NAMES if c in df.columns]
    return df.select(F.col("task_index").cast("bigint").alias("task_index"), F.coalesce(*have).alias("task")).filter("task is not null") if have else empty


def read_episodes(spark: SparkSession, path: str | Path) -> DataFrame:
    """Episodes with frames, duration, instruction, task_index and the cameras' windows in their files."""
    info, files = load_info(path), sorted((Path(path) / "meta").glob("episodes*.parquet")) + sorted((Path(path) / "meta/episodes").rglob("*.parquet"))
    df = spark.read.option("mergeSchema", "true").parquet(*map(str, files))
    has = set(df.columns)
    count = F.coalesce(*(F.col(c).cast("bigint") for c in ("frame_count", "frames", "length") if c in has), F.lit(0).cast("bigint"))
    first_task = F.get("tasks", F.lit(0)) if "tasks" in has else F.lit(None).cast("string")
    instruction = F.coalesce(F.nullif(F.col("instruction"), F.lit("")), first_task) if "instruction" in has else first_task
    views = []
    for cam in sorted({c.split("/")[1] for c in has if c.startswith("videos/") and c.count("/") == 2}):
        at = lambda k, cam=cam: F.col(f"`videos/{cam}/{k}`") if f"videos/{cam}/{k}" in has else F.lit(None)
        views.append(F.struct(F.lit(cam).alias("camera"), video_path(F.lit(cam), at("chunk_index").cast("int"), at("file_index").cast("int")).alias("path"), at("from_timestamp").cast("double").alias("from_timestamp"), at("to_timestamp").cast("double").alias("to_timestamp")))
    shown = F.array(*views) if views else F.array().cast("array<struct<camera:string,path:string,from_timestamp:double,to_timestamp:double>>")
    tasks = read_tasks(spark, path).groupBy("task").agg(F.min("task_index").alias("task_index"))
    out = df.select(F.col("episode_index").cast("bigint").alias("episode_index"), count.alias("frames"), instruction.alias("instruction"), shown.alias("cameras"))
    fps = F.lit(float(info.get("fps") or 0))
    return out.join(tasks, out["instruction"] == tasks["task"], "left").select("episode_index", "frames", F.try_divide("frames", fps).alias("duration"), "instruction", "task_index", "cameras", fps.alias("fps"))


def _footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import pyarrow.parquet as pq
    from pyarrow import fs

    for pdf in batches:
        rows = []
        for path in pdf["path"]:
            try:
                system, at = fs.FileSystem.from_uri(path)
                with system.open_input_file(at) as f:
                    m = pq.ParquetFile(f)
                    rows.append((path, m.metadata.num_rows, json.dumps({f.name: str(f.type) for f in m.schema_arrow}), "pass", None))
            except Exception as e:  # a broken file is a row, not a failure
                rows.append((path, None, None, "fail", str(e)[:200]))
        yield pd.DataFrame(rows, columns=["path", "rows", "schema_json", "status", "error"])


def inventory(spark: SparkSession, folder: str, known: DataFrame | None = None, pattern: str = "*.parquet") -> DataFrame:
    """path, size, mtime, rows, schema_json, status and error of each file, from footers read in parallel.

    A known row is taken over where size and time are unchanged and it passed; files that are gone drop out.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    files = files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("mtime"))
    todo = files
    if known is not None:
        todo = files.join(known.filter("status = 'pass'").select("path", "size", "mtime"), ["path", "size", "mtime"], "left_anti")
    read = todo.select("path").repartition(spark.sparkContext.defaultParallelism).mapInPandas(_footers, "path string, rows bigint, schema_json string, status string, error string")
    out = todo.join(read, "path")
    if known is not None:
        out = out.unionByName(known.filter("status = 'pass'").join(files, ["path", "size", "mtime"], "left_semi").select(*out.columns))
    return out


def media_files(spark: SparkSession, root: str | Path) -> DataFrame:
    """Videos below `videos` or `video`, else at the top: path, size, mtime; never their content."""
    deep = [d for d in ("videos", "video") if (Path(root) / d).is_dir()]
    places = [(Path(root) / d, True) for d in deep] or [(Path(root), False)]
    rows = [(str(p), p.stat().st_size, p.stat().st_mtime) for at, down in places for p in sorted(at.rglob("*") if down else at.iterdir()) if p.suffix.lower() in VIDEO_SUFFIXES and p.is_file()]
    return spark.createDataFrame(rows, "path string, size bigint, mtime double")


def marker(files: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A cheap sign of change: latest time and total size."""
    return files.groupBy(*keys).agg(F.max("mtime").alias("mtime"), F.sum("size").alias("size"))


def detect_format(files: Sequence[str]) -> str:
    """rlds before hdf5 before image_json; `lerobot` where its metadata is."""
    low = [f.lower() for f in files]
    if any(f.endswith(INFO) for f in low):
        return "lerobot"
    if any(".tfrecord" in f for f in low) and any(f.endswith(("features.json", "dataset_info.json")) for f in low):
        return "rlds"
    if any(f.endswith((".h5", ".hdf5")) for f in low):
        return "hdf5"
    if any(f.endswith("metadata.json") for f in low):
        return "image_json"
    return "tfrecord" if any(".tfrecord" in f for f in low) else "unknown"


def inside(root: str | Path, path: str | Path) -> Path:
    """The path below the root; anything that leads out of it is an error."""
    at = Path(os.path.realpath(Path(root) / path))
    if not at.is_relative_to(os.path.realpath(root)):
        raise ValueError(f"{path} leads out of {root}")
    return at


def picture_bytes(picture: np.ndarray) -> np.ndarray:
    """[channels, height, width] of 0 to 1 as [height, width, channels] of bytes, rounded and cut."""
    return np.clip(np.rint(np.moveaxis(np.asarray(picture, float), 0, -1) * 255), 0, 255).astype(np.uint8)


def constant_per_episode(frames: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Episodes in which a column that must not change does, or is only partly there."""
    out = None
    for c in columns:
        part = frames.groupBy(*keys).agg(F.count_distinct(F.to_json(F.struct(c))).alias("n"), F.count(c).alias("have"), F.count(F.lit(1)).alias("rows"))
        part = part.filter("n > 1 or (have > 0 and have < rows)").select(*keys, F.lit(c).alias("field"))
        out = part if out is None else out.unionByName(part)
    return out
