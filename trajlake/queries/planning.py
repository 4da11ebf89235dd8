"""Queries of layouts, scalars, planning, file inventories and windows of events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trajlake.functions import geometry, scalars
from trajlake.functions.vectors import finite
from trajlake.operators.intervals import periods_and_gaps
from trajlake.plans import catalog, legacy, units
from trajlake.queries.problems import latest_episodes
from trajlake.queries.registry import FRAMES, KEYS, ORDER, Registry, frame_rows, table
from trajlake.sources.datasets import inventory
from trajlake.streaming.ingest import windowed_counts

R = Registry()
QUERIES, SQL = R.queries, R.sql

_ROTATION = geometry.rotation_matrix([[0.36, 0.48, -0.8], [-0.8, 0.6, 0.0], [0.48, 0.64, 0.6]])
_SHIFT = (0.5, -1.0, 2.0)


def packed_states(f: DataFrame) -> DataFrame:
    """Some places of packed states; a state of 7 places has six joints, one of 8 has seven, then the gripper."""
    packed = {n: geometry.pack_state(F.col("state"), n, n - 1, gripper="parallel_jaw") for n in (7, 8)}
    assert all(sum(mask) == n for n, (_, mask) in packed.items())
    f = f.withColumn("c", F.when(F.size("state") == 7, packed[7][0]).when(F.size("state") == 8, packed[8][0]))
    b = geometry.bands(F.col("c"))
    at = lambda v, i: (F.get(v, F.lit(i)) + 0.0).cast("float")
    return f.select(*KEYS, *ORDER, at(b["arm1_joint"], 0).alias("joint_0"), at(b["arm1_joint"], 5).alias("joint_5"), at(b["arm1_joint"], 6).alias("joint_6"), at(b["arm1_gripper"], 0).alias("gripper"), F.size("c").alias("places"))


def packed_actions(f: DataFrame) -> DataFrame:
    """Some places of packed absolute actions; state and action have the same width."""
    packed = {n: geometry.pack_action(F.col("action"), F.col("state"), n, n, n - 1, gripper="parallel_jaw", frame="absolute")[0] for n in (7, 8)}
    f = f.withColumn("c", F.when(F.size("action") == 7, packed[7]).when(F.size("action") == 8, packed[8]))
    b = geometry.bands(F.col("c"), action=True)
    at = lambda k, i=0: (F.get(b[k], F.lit(i)) + 0.0).cast("float")
    return f.select(*KEYS, *ORDER, at("arm1_joint").alias("joint_0"), at("arm1_joint", 6).alias("joint_6"), at("arm1_position").alias("position_0"), at("arm1_gripper").alias("gripper"))


@R.add(f"""with {FRAMES} select dataset_uid, episode_index, frame_index, (state[1] + 0)::float as joint_0, (state[6] + 0)::float as joint_5, (case when len(state) = 8 then state[7] + 0 else 0 end)::float as joint_6, (state[len(state)] + 0)::float as gripper, 128 as places from f where len(state) in (7, 8)""")
def canonical_pack(spark: SparkSession, folder: str) -> DataFrame:
    """States of six or seven joints and a gripper in the fixed layout of 128 places."""
    return packed_states(frame_rows(spark, folder).filter("size(state) in (7, 8)"))


@R.add(f"""with {FRAMES} select dataset_uid, episode_index, frame_index, (action[1] - state[1])::float as joint_0, (case when len(action) = 8 then action[7] - state[7] else 0 end)::float as joint_6, 0::float as position_0, action[len(action)]::float as gripper from f where len(state) in (7, 8) and len(action) = len(state)""")
def canonical_action(spark: SparkSession, folder: str) -> DataFrame:
    """Absolute joint actions of six or seven joints as differences to the state."""
    return packed_actions(frame_rows(spark, folder).filter("size(state) in (7, 8) and size(action) = size(state)"))


@R.add(f"select vec_id, {', '.join('round(' + ' + '.join(f'embedding[{j + 1}]::double * ({float(_ROTATION[i][j])})' for j in range(3)) + f' + ({_SHIFT[i]}), 6) as p{i}' for i in range(3))} from embeddings")
def rigid_transform(spark: SparkSession, folder: str) -> DataFrame:
    """The first three places of vectors as points, turned and shifted."""
    p = geometry.transform_point(F.col("embedding").cast("array<double>"), _ROTATION, _SHIFT)
    return table(spark, folder, "embeddings").select("vec_id", *(F.round(F.get(p, F.lit(i)), 6).alias(f"p{i}") for i in range(3)))


@R.add(f"""with {FRAMES}, x as (select dataset_uid, unnest(state[1:least(len(state), len(action))]) as s, unnest(action[1:least(len(state), len(action))]) as a from f),
  m as (select dataset_uid, avg((s - a) * (s - a)) as mse from x where isfinite(s) and isfinite(a) group by all)
  select dataset_uid, round(case when mse = 0 then 100 else 20 * log10(255 / sqrt(mse)) end, 6) as psnr from m""")
def psnr(spark: SparkSession, folder: str) -> DataFrame:
    """How near states are to their actions over all finite readings, in decibels."""
    n = F.least(F.size("state"), F.size("action"))
    f = frame_rows(spark, folder).filter("state is not null and action is not null").select("dataset_uid", F.inline(F.arrays_zip(F.slice("state", 1, n).alias("s"), F.slice("action", 1, n).alias("a")))).filter(finite(F.col("s")) & finite(F.col("a")))
    return f.groupBy("dataset_uid").agg(F.avg(F.pow(F.col("s") - F.col("a"), 2)).alias("m")).select("dataset_uid", F.round(scalars.psnr(F.col("m")), 6).alias("psnr"))


_COVER = "(select distinct dataset_uid, episode_index, unnest(range(frame_start, frame_end + 1)) as t from annotations where frame_start <= frame_end and label_type = '{}')"


@R.add(f"""with a as {_COVER.format('anomaly')}, b as {_COVER.format('contact')} select dataset_uid, count(*) filter (a.t is not null and b.t is not null) / count(*) as iou
  from a full join b using (dataset_uid, episode_index, t) group by all""")
def iou(spark: SparkSession, folder: str) -> DataFrame:
    """Overlap of the frames under two labels."""
    a = table(spark, folder, "annotations")

    def frames(name: str, *labels: str) -> DataFrame:
        p = periods_and_gaps(a.filter(F.col("label_type").isin(*labels)), KEYS, "frame_start", "frame_end").filter("kind = 'period'")
        return p.groupBy("dataset_uid").agg(F.sum(F.col("frame_end") - F.col("frame_start") + 1).alias(name))

    n = frames("either", "anomaly", "contact").join(frames("one", "anomaly"), "dataset_uid", "left").join(frames("two", "contact"), "dataset_uid", "left")
    both = F.coalesce("one", F.lit(0)) + F.coalesce("two", F.lit(0)) - F.col("either")
    return n.select("dataset_uid", scalars.iou(both, F.col("either")).alias("iou"))


@R.add("select event_id, case when value = trunc(value) then cast(value as int) end as whole from events")
def lossless_cast(spark: SparkSession, folder: str) -> DataFrame:
    """Values as whole numbers where nothing is lost."""
    return table(spark, folder, "events").select("event_id", scalars.lossless(F.col("value"), "int", "double").alias("whole"))


@R.add("""select e.dataset_uid, e.episode_index, round(abs(frames - duration * 30) / greatest(abs(frames), abs(duration * 30), 1e-12), 6) as difference, abs(frames - duration * 30) <= 1e-8 + 0.01 * abs(duration * 30) as close
  from (select distinct dataset_uid, episode_index, frames, duration from episodes) e""")
def numbers_close(spark: SparkSession, folder: str) -> DataFrame:
    """Whether frames and duration agree at 30 frames a second."""
    e = table(spark, folder, "episodes").select(*KEYS, "frames", "duration").distinct()
    a, b = F.col("frames").cast("double"), F.col("duration") * 30
    return e.select(*KEYS, F.round(scalars.relative_difference(a, b), 6).alias("difference"), scalars.close(a, b, rtol=0.01).alias("close"))


@R.add(r"""with s as (select distinct component, source_file from roboomni_records) select component, source_file, row_number() over (partition by component order by regexp_replace(source_file, '\d+\.tfrecord$', ''), cast(regexp_extract(source_file, '(\d+)\.tfrecord$', 1) as bigint), source_file) as place from s""")
def natural_order(spark: SparkSession, folder: str) -> DataFrame:
    """Files of each component in the order in which people count."""
    s = table(spark, folder, "roboomni_records").select("component", "source_file").distinct()
    return s.select("component", "source_file", F.row_number().over(Window.partitionBy("component").orderBy(scalars.natural_key(F.col("source_file")), "source_file")).alias("place"))


_WORK = "w as (select name as key, min(snapshot_id) as unit, max(record_count) as weight from roboomni_partitions group by all)"


def work(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "roboomni_partitions").groupBy(F.col("name").alias("key")).agg(F.min("snapshot_id").alias("unit"), F.max("record_count").alias("weight"))


@R.add(f"with {_WORK} select key, unit, weight, row_number() over (order by weight desc, unit, key) as place from w")
def dispatch_order(spark: SparkSession, folder: str) -> DataFrame:
    return units.dispatch_order(work(spark, folder))


@R.add(f"with {_WORK} select cast((select sum(weight) from (select weight from w order by weight desc limit 4)) as bigint) as memory, cast((select sum(weight * 2) from (select weight from w order by weight desc limit 4)) as bigint) as disk")
def top_k_inflight(spark: SparkSession, folder: str) -> DataFrame:
    """What four workers may hold at once: a top-k."""
    return units.in_flight(work(spark, folder).select(F.col("weight").alias("memory"), (F.col("weight") * 2).alias("disk")), 4)


@R.add("""with e as (select dataset_uid as unit, count(*) as episodes, sum(frames) as frames from (select distinct dataset_uid, episode_index, frames from episodes) group by all)
  select unit, episodes, cast(frames as bigint) as frames, cast(coalesce(sum(episodes) over w, 0) as bigint) as first_episodes, cast(coalesce(sum(frames) over w, 0) as bigint) as first_frames from e window w as (order by unit rows between unbounded preceding and 1 preceding)""")
def global_offsets(spark: SparkSession, folder: str) -> DataFrame:
    """Where each dataset's episodes and frames begin when all are joined."""
    e = table(spark, folder, "episodes").select(*KEYS, "frames").distinct().groupBy(F.col("dataset_uid").alias("unit")).agg(F.count(F.lit(1)).alias("episodes"), F.sum("frames").alias("frames"))
    return units.global_offsets(e)


@R.add("""with f as (select dataset_uid, instruction as task, min(episode_index) as first_episode from episodes where instruction is not null group by all) select *, row_number() over (partition by dataset_uid order by first_episode, task) - 1 as task_index from f""")
def first_seen_tasks(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "episodes")
    return units.first_seen_tasks(e.select("dataset_uid", "episode_index", F.col("instruction").alias("task")), ["dataset_uid"])


@R.add()
def work_units(spark: SparkSession, folder: str) -> DataFrame:
    """Episodes packed into units of at most 20 episodes and 5,000 frames (greedy, so not for SQL; tested against a loop)."""
    e = latest_episodes(spark, folder).select("dataset_uid", "episode_index", F.coalesce("task_index", F.lit(-1)).alias("task"), F.coalesce("frames", F.lit(0)).alias("frames"))
    return units.units(e, "dataset_uid", "task", 20, 5000)


_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "datasets", "tasks", "episodes", "frames", "annotations", "roboomni_records", "roboomni_partitions", "dexcap_partitions", "eval_items", "mix_targets", "subject_examples")


@R.add(" union all ".join(f"select '{t}' as name, count(*) as rows, 'pass' as status from {t}" for t in _TABLES))
def file_inventory(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of all files of a folder by their footers."""
    i = inventory(spark, folder).withColumn("name", F.regexp_extract("path", r"/(\w+)\.parquet", 1))
    return i.groupBy("name").agg(F.sum("rows").alias("rows"), F.max("status").alias("status"))


@R.add("select date_trunc('hour', ts) as window_start, event_type, count(*) as events, round(sum(value), 6) as total from events group by all")
def hourly_events(spark: SparkSession, folder: str) -> DataFrame:
    """The windows of the stream of events, as a batch."""
    w = windowed_counts(table(spark, folder, "events"))
    return w.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "events", F.round("total", 6).alias("total"))


@R.add(f"""with {FRAMES}, v as (select dataset_uid, 'state' as feature, cast(unnest(range(len(state))) as int) as dimension, unnest(state) as value from f union all select dataset_uid, 'action', cast(unnest(range(len(action))) as int), unnest(action) from f)
  select dataset_uid, feature, dimension, case when bool_or(isnan(value)) then 'nan'::float else quantile_cont(value, 0.01)::float end as q_low, case when bool_or(isnan(value)) then 'nan'::float else quantile_cont(value, 0.99)::float end as q_high from v group by all""")
def legacy_bounds(spark: SparkSession, folder: str) -> DataFrame:
    """Bounds of the older rule; a place with NaN has none."""
    return legacy.bounds(frame_rows(spark, folder)).select("dataset_uid", "feature", "dimension", F.col("q_low").cast("float").alias("q_low"), F.col("q_high").cast("float").alias("q_high"))


@R.add()
def legacy_pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """Outcomes of the older pipeline by stage and reason (whole episodes in numpy; tested by cases)."""
    f = frame_rows(spark, folder).filter("state is not null and action is not null")
    return catalog.outcome_counts(legacy.run(f, legacy.Config(residual=20.0, acceleration=200.0, jerk=200.0, agreement=0.85))[1])
