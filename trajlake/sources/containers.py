"""Containers of named arrays (HDF5, or zip files of .npy members) with one or many episodes, and what their readers share.

A container is a tree of arrays by slashed paths. HDF5 needs h5py; zip files of .npy members (also .npz) need nothing, so
every reader runs on either kind.
"""

from __future__ import annotations

import io
import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trajlake.functions.scalars import canonical_json_text, natural_key
from trajlake.functions.vectors import finite
from trajlake.plans.ranks import numbered
from trajlake.sources.formats import _files, _open


class Container:
    """Arrays of an open file by path."""

    def __init__(self, f: io.IOBase) -> None:
        self.zip = zipfile.ZipFile(f) if zipfile.is_zipfile(f) else None
        if self.zip is None:
            try:
                import h5py
            except ImportError as e:
                raise RuntimeError("HDF5 containers need h5py, which is not installed") from e
            f.seek(0)
            self.tree, self.names = h5py.File(f, "r"), []
            self.tree.visititems(lambda name, x: self.names.append(name) if hasattr(x, "shape") else None)
        else:
            self.names = [n.removesuffix(".npy") for n in self.zip.namelist() if n.endswith(".npy")]

    def array(self, path: str) -> np.ndarray:
        if self.zip is None:
            return np.asarray(self.tree[path])
        with self.zip.open(f"{path}.npy") as f:
            return np.load(io.BytesIO(f.read()), allow_pickle=False)

    def groups(self, root: str, pattern: str) -> list[str]:
        """Groups directly below a root whose names match, in the order in which people count."""
        at = f"{root}/" if root else ""
        found = {n[len(at) :].split("/", 1)[0] for n in self.names if n.startswith(at) and "/" in n[len(at) :]}
        key = lambda s: [int(x) if x.isdigit() else x for x in re.split(r"(\d+)", s)]
        return [at + g for g in sorted((g for g in found if re.fullmatch(pattern, g)), key=key)]

    def cameras(self, group: str) -> list[str]:
        """Arrays of pictures below a group: frames, height, width and one, three or four channels of bytes."""
        at = f"{group}/" if group else ""
        looks = lambda x: x.ndim == 4 and x.shape[-1] in (1, 3, 4) and x.dtype == np.uint8
        return sorted(n for n in self.names if n.startswith(at) and looks(self.array(n)))


def _episode(c: Container, group: str, fields: dict[str, str], shapes: dict[str, tuple[int, ...]]) -> dict[str, np.ndarray]:
    """Fields of an episode as [frames, places]; different lengths, other shapes, and values that are not finite are errors."""
    out = {}
    for name, path in fields.items():
        x = c.array(f"{group}/{path}" if group else path)
        if name in shapes and x.shape[1:] != tuple(shapes[name]):
            raise ValueError(f"{group}/{path}: shape {x.shape[1:]}, not {tuple(shapes[name])}")
        out[name] = x.reshape(len(x), -1).astype(float)
        if not np.isfinite(out[name]).all():
            raise ValueError(f"{group}/{path}: values that are not finite")
    if len({len(x) for x in out.values()}) > 1:
        raise ValueError(f"{group}: fields differ in length")
    return out


def read_containers(spark: SparkSession, path: str, fields: dict[str, str], root: str | None = None, pattern: str = r"demo_\d+", shapes: dict[str, tuple[int, ...]] | None = None) -> DataFrame:
    """Frames of containers: path, episode, place (of the episode in its file), frame_index, a vector for each field, error.

    With a `root` its groups are the episodes, naturally sorted, else the file is one. `shapes` are those that frames of a
    field must have, such as (10000, 6) for point clouds. An episode that breaks a rule, and a file that can't be read, is
    a row with an error and no frames. One task opens one file.
    """
    names = list(fields)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for p in pdf["path"]:
                bad = lambda episode, place, e: pd.DataFrame([(p, episode, place, None, *[None] * len(names), str(e)[:300])], columns=["path", "episode", "place", "frame_index", *names, "error"])
                try:
                    with _open(p) as f:
                        c = Container(f)
                        for place, g in enumerate([""] if root is None else c.groups(root, pattern)):
                            try:
                                x = _episode(c, g, fields, shapes or {})
                            except (KeyError, ValueError) as e:
                                yield bad(g, place, e)
                                continue
                            n = len(next(iter(x.values())))
                            for a in range(0, n, 1000):
                                yield pd.DataFrame({"path": p, "episode": g, "place": place, "frame_index": np.arange(a, min(a + 1000, n)), **{k: list(v[a : a + 1000]) for k, v in x.items()}, "error": None})
                except (OSError, RuntimeError, ValueError, zipfile.BadZipFile) as e:  # a damaged file is a row
                    yield bad(None, None, e)

    kind = "path string, episode string, place bigint, frame_index bigint, " + ", ".join(f"`{n}` array<double>" for n in names) + ", error string"
    return _files(spark, path).select("path").repartition("path").mapInPandas(run, kind)


def with_episode_numbers(frames: DataFrame) -> DataFrame:
    """Add `episode_index`: episodes numbered by file in natural order, then by their place in it."""
    each = frames.filter("error is null").select("path", "place").distinct().withColumn("__n", natural_key(F.col("path")))
    number = numbered(each, ["__n", "path", "place"], "episode_index").drop("__n")
    return frames.filter("error is null").join(number, ["path", "place"])


def model_joint_names(xml: str) -> tuple[list[str], list[str]]:
    """Names of the places of positions and of velocities of a robot model: free joints have 7 and 6, balls 4 and 3, others one."""
    q, v = [], []
    for j in ET.fromstring(xml).iter():
        if j.tag not in ("joint", "freejoint") or j.get("name") is None:
            continue
        kind = "free" if j.tag == "freejoint" else j.get("type", "hinge")
        n, m = {"free": (7, 6), "ball": (4, 3)}.get(kind, (1, 1))
        q += [j.get("name")] if n == 1 else [f"{j.get('name')}_{i}" for i in range(n)]
        v += [j.get("name")] if m == 1 else [f"{j.get('name')}_{i}" for i in range(m)]
    return q, v


def next_frame_targets(frames: DataFrame, keys: Sequence[str], state: str = "state", action: str = "action", tolerance: float = 1e-6) -> DataFrame:
    """Frames whose action is not the state of the next frame: keys, frame_index and the largest difference; an episode's last
    frame has none. Vectors of different widths differ infinitely."""
    w = Window.partitionBy(*keys).orderBy("frame_index")
    rows = frames.select(*keys, "frame_index", F.col(action).alias("__a"), F.lead(state).over(w).alias("__s")).filter("__s is not null")
    gap = F.when(F.size("__a") == F.size("__s"), F.array_max(F.zip_with("__a", "__s", lambda x, y: F.abs(x - y)))).otherwise(F.lit(float("inf")))
    return rows.select(*keys, "frame_index", gap.alias("difference")).filter(~(F.coalesce("difference", F.lit(float("inf"))) <= tolerance))


def linked_parts(states: DataFrame, actions: DataFrame, source: str) -> DataFrame:
    """Streams of unequal length stay apart and are linked by their source: source, its states, its actions, and whether they pair."""
    n = lambda d, name: d.groupBy(source).agg(F.count(F.lit(1)).alias(name))
    both = n(states, "states").join(n(actions, "actions"), source, "full")
    return both.select(source, *(F.coalesce(c, F.lit(0)).alias(c) for c in ("states", "actions"))).withColumn("paired", F.col("states") == F.col("actions"))


def episodes_of_segments(frames: DataFrame, keys: Sequence[str], order: str, segment: str) -> DataFrame:
    """Runs of equal segment numbers as episodes: keys, episode_index (by order), segment, first and last position, frames."""
    from trajlake.operators.runs import encode_runs

    r = encode_runs(frames, keys, [order], segment)
    return r.select(*keys, F.col("run").alias("episode_index"), segment, F.col("start").alias("first"), (F.col("stop") - 1).alias("last"), (F.col("stop") - F.col("start")).alias("frames"))


def dtype_runs(scans: DataFrame, keys: Sequence[str], order: Sequence[str], dtype: str = "dtype") -> DataFrame:
    """Stretches of scans in which a component has one dtype: keys, run, dtype, start and stop."""
    from trajlake.operators.runs import encode_runs

    return encode_runs(scans, keys, order, dtype)


def pickle_outline(content: bytes, most: int = 1 << 20) -> dict:
    """Texts and sizes of byte payloads in a pickle, read from its opcodes: nothing is loaded or called. Payloads beyond `most`
    bytes are only counted."""
    import pickletools

    out: dict = {"texts": [], "payloads": [], "skipped_bytes": 0, "calls": 0}
    for op, arg, _ in pickletools.genops(content):
        if isinstance(arg, str) and "UNICODE" in op.name:
            out["texts"].append(arg)
        elif isinstance(arg, (bytes, bytearray)):
            out["payloads"].append(len(arg))
            out["skipped_bytes"] += len(arg) if len(arg) > most else 0
        elif op.name in ("REDUCE", "BUILD", "INST", "OBJ", "NEWOBJ", "NEWOBJ_EX"):
            out["calls"] += 1
    return out


def task_catalog(spark: SparkSession, root: str) -> DataFrame:
    """Task folders with meta/info.json: folder, version, episodes, frames, fps, features' fingerprint; unreadable ones have none.

    The fingerprint covers names, dtypes (a scalar float counts like any float) and shapes in whatever order of keys, so
    tasks with one can be joined.
    """
    docs = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "info.json").load(root)

    @F.pandas_udf("string")
    def policy(features: pd.Series) -> pd.Series:
        import hashlib
        import json

        def one(text: str | None) -> str | None:
            if text is None:
                return None
            f = {k: [re.sub(r"^float\d*$", "float", str((v or {}).get("dtype", "")).lower()), list((v or {}).get("shape") or [1])] for k, v in json.loads(text).items()}
            return hashlib.sha256(canonical_json_text(f).encode()).hexdigest()

        return features.map(one)

    v = docs.select(F.regexp_extract("path", r"^(?:file:)?(.*)/meta/info\.json$", 1).alias("folder"), F.try_parse_json(F.decode("content", "UTF-8")).alias("v")).filter("folder <> ''")
    get = lambda path, kind: F.try_variant_get("v", path, kind)
    return v.select("folder", get("$.codebase_version", "string").alias("version"), get("$.total_episodes", "bigint").alias("episodes"), get("$.total_frames", "bigint").alias("frames"), get("$.fps", "double").alias("fps"), policy(F.to_json(get("$.features", "variant"))).alias("fingerprint"))


def read_episode_files(spark: SparkSession, root: str) -> DataFrame:
    """Episodes of a folder with meta/episodes.jsonl and one Parquet file for each: number, length, tasks, path, and whether it is there."""
    e = spark.read.schema("episode_index bigint, length bigint, tasks array<string>").json(f"{root}/meta/episodes.jsonl").filter("episode_index is not null")
    path = F.format_string("data/chunk-%03d/episode_%06d.parquet", F.expr("episode_index div 1000"), F.col("episode_index"))
    have = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "episode_*.parquet").load(f"{root}/data").select(F.regexp_extract("path", r"(data/chunk-\d+/episode_\d+\.parquet)$", 1).alias("path"), F.lit(True).alias("there"))
    return e.withColumn("path", path).join(have, "path", "left").withColumn("there", F.coalesce("there", F.lit(False)))


# --- cameras and videos

def load_calibration(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, view, intrinsics (4), extrinsics (16), problem: one calibration for each episode and view.

    Either both matrices or neither must be there, of 4 and 16 finite numbers, and the same in all rows of an episode.
    """
    one = rows.groupBy(*keys, "view").agg(F.collect_set("intrinsics").alias("__i"), F.collect_set("extrinsics").alias("__e"), F.bool_or(F.col("intrinsics").isNull() != F.col("extrinsics").isNull()).alias("__half"))
    first = lambda c: F.get(c, F.lit(0))
    fine = lambda c, n: (F.size(first(c)) == n) & F.forall(first(c), finite)
    problem = F.when(F.col("__half"), "half").when((F.size("__i") > 1) | (F.size("__e") > 1), "changes").when(F.size("__i") == 0, "none").when(~(fine("__i", 4) & fine("__e", 16)), "malformed")
    keep = lambda c: F.when(problem.isNull(), first(c))
    return one.select(*keys, "view", keep("__i").alias("intrinsics"), keep("__e").alias("extrinsics"), problem.alias("problem"))


#: A probe gets a path and whether to decode a frame, and gives codec, width, height, fps and frames; it may raise.
Probe = Callable[[str, bool], dict]


def probe_videos(files: DataFrame, probe: Probe | None, deep: bool = False) -> DataFrame:
    """path, status, codec, width, height, fps, frames, error: header_ok, pass (a frame was decoded), fail, metadata_unavailable
    (no probe) or error, for each file of a listing with `path`."""
    columns = ["codec", "width", "height", "fps", "frames"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for p in pdf["path"]:
                got, status, error = {}, "metadata_unavailable", None
                if probe is not None:
                    try:
                        got = probe(p, deep)
                        whole = all(got.get(c) for c in ("width", "height", "fps"))
                        status = ("pass" if deep else "header_ok") if whole else "fail"
                    except Exception as e:  # an outside program may fail in any way
                        status, error = "error", str(e)[:200]
                rows.append((p, status, *(got.get(c) for c in columns), error))
            yield pd.DataFrame(rows, columns=["path", "status", *columns, "error"]).astype({"width": "Int32", "height": "Int32", "frames": "Int64", "fps": "Float64"})

    return files.select("path").mapInPandas(run, "path string, status string, codec string, width int, height int, fps double, frames bigint, error string")


# --- what a written dataset must be

def verify_dataset(spark: SparkSession, path: str) -> DataFrame:
    """Problems of a dataset folder (check, detail), none for a sound one: totals, vector types and widths, numbering, lengths, tasks.

    All checks read the data once or twice as plans; nothing is collected but their outcomes.
    """
    from trajlake.sources import datasets

    info = datasets.load_info(path)
    files = spark.read.option("recursiveFileLookup", "true").parquet(f"{path}/data")
    episodes, tasks = datasets.read_episodes(spark, path), datasets.read_tasks(spark, path)
    parts = []

    def problem(check: str, rows: DataFrame, detail) -> None:
        parts.append(rows.select(F.lit(check).alias("check"), detail.cast("string").alias("detail")))

    missing = sorted({*info.get("features", {}), "episode_index", "frame_index", "index"} - set(files.columns))
    if missing:
        return spark.createDataFrame([("columns", f"missing: {missing}")], "check string, detail string")
    total = files.agg(F.count(F.lit(1)).alias("frames"), F.count_distinct("episode_index").alias("episodes"))
    wrong = total.filter((F.col("frames") != info.get("total_frames")) | (F.col("episodes") != info.get("total_episodes")))
    problem("totals", wrong, F.concat_ws(" frames, ", "frames", F.concat("episodes", F.lit(" episodes"))))
    for name, f in info.get("features", {}).items():
        if str(f.get("dtype", "")).startswith("float") and f.get("shape"):
            v, n = F.col(f"`{name}`").cast("array<double>"), reduce(lambda a, b: a * b, f["shape"], 1)
            problem(f"width of {name}", files.filter(F.coalesce(F.size(v) != n, F.lit(True))).limit(1), F.col("index"))
            problem(f"finite {name}", files.filter(~F.coalesce(F.forall(v, finite), F.lit(True))).limit(1), F.col("index"))
            stored = dict(files.dtypes)[name]
            if stored not in ("array<float>", "float") and f["dtype"] == "float32":
                parts.append(spark.createDataFrame([(f"type of {name}", stored)], "check string, detail string"))
    each = files.groupBy("episode_index").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("frame_index").alias("d"), F.min("frame_index").alias("a"), F.max("frame_index").alias("b"), F.min("index").alias("first"), F.max("index").alias("last"))
    problem("frame numbers", each.filter("a <> 0 or b <> n - 1 or d <> n or last - first <> n - 1"), F.col("episode_index"))
    upto = numbered(each.select("episode_index", "n", "first"), ["episode_index"], "__i", sums={"before": "n"})
    problem("global numbers", upto.filter("first <> before"), F.col("episode_index"))
    listed = each.join(episodes.select("episode_index", "frames"), "episode_index", "full").filter("not (n <=> frames)")
    problem("episode lengths", listed, F.col("episode_index"))
    if "task_index" in files.columns:
        problem("tasks", files.filter("task_index is not null").select("task_index").distinct().join(tasks, "task_index", "left_anti"), F.col("task_index"))
    return reduce(DataFrame.unionByName, parts)
