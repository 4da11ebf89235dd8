"""Queries of labels, the index, planning and small functions, each over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trajlake.functions import geometry, scalars
from trajlake.operators import runs
from trajlake.plans import catalog as C
from trajlake.plans import curation, index, legacy, units
from trajlake.queries import stages
from trajlake.queries.catalog import _BAD, _EP, _S, episode_search, last_scans, stage_rows
from trajlake.queries.registry import FRAMES, KEYS, ORDER, Registry, frame_rows, table
from trajlake.queries.signals import _FLAGS, W, stage3
from trajlake.sources import containers

R = Registry()
QUERIES, SQL = R.queries, R.sql


# --- labels and the index

@R.add(stages._STAGE1 + """ select dataset_uid, episode_index, count(*) as num_frames, count(g.frame_index) as flagged_frames, count(*) - count(g.frame_index) as valid_frames, round(count(g.frame_index) / count(*), 6) as flag_fraction, false as reject_episode
  from f left join flagged g using (dataset_uid, episode_index, frame_index) group by all""")
def stage1_summary(spark: SparkSession, folder: str) -> DataFrame:
    s = curation.stage1(frame_rows(spark, folder))["episode_summary"]
    return s.select(*KEYS, "num_frames", "flagged_frames", "valid_frames", F.round("flag_fraction", 6).alias("flag_fraction"), "reject_episode")


@R.add(_FLAGS + f""", isl as (select *, frame_index - row_number() over {W} as island from g), rg as (select dataset_uid, episode_index, min(frame_index) as a, max(frame_index) as b from isl group by dataset_uid, episode_index, island),
  rt as (select dataset_uid, episode_index, string_agg(concat(a, '-', b), ',' order by a) as ranges from rg group by all), cn as (select dataset_uid, episode_index, count(*) as frames, count(g.frame_index) as flagged from f left join g using (dataset_uid, episode_index, frame_index) group by all)
  select dataset_uid, episode_index, 3 as stage_id, case when flagged > 0 then 'anomaly' else 'pass' end as verdict, flagged as anomaly_count, case when flagged > 0 then 'warning' end as severity, round(flagged / frames, 6) as score, coalesce(ranges, '') as ranges from cn left join rt using (dataset_uid, episode_index)""")
def label_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Index rows of stage 3 from its label tables."""
    three = stage3(spark, folder)
    s = three["episode_summary"].select(*KEYS, F.col("input_frames").alias("num_frames"), "flagged_frames", F.lit(False).alias("reject_episode"))
    r = index.label_rows(s, three["frame_flags"], 3, "stage3_extreme_value")
    text = F.array_join(F.transform("ranges", lambda x: F.concat_ws("-", x["frame_start"], x["frame_end"])), ",")
    return r.withColumn("ranges", text).withColumn("score", F.round("score", 6))


_PAYLOADS = """p as (select annotation_id, dataset_uid, episode_index, 6 + abs(coalesce(frame_start, 0)) % 3 as stage_id, status, score, frame_start, frame_end, reason_code from annotations where annotation_id is not null and dataset_uid is not null and episode_index is not null)"""


@R.add(f"""with {_PAYLOADS} select dataset_uid, episode_index, cast(stage_id as int) as stage_id, status as verdict, cast(case when stage_id = 6 then 1 when stage_id = 7 then case when frame_start is null then 0 else 1 end else 1 end as bigint) as anomaly_count,
    case when not (stage_id = 7 and frame_start is null) then 'warning' end as severity, case when stage_id = 7 then round(score, 6) end as score,
    case when stage_id = 7 and frame_start is not null then concat(frame_start, '-', frame_start) when stage_id = 8 and frame_start < frame_end then concat(frame_start, '-', frame_end - 1) else '' end as ranges from p""")
def payload_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Index rows of stages 6 to 8 from JSON documents, made here from annotations."""
    a = table(spark, folder, "annotations").filter("annotation_id is not null and dataset_uid is not null and episode_index is not null")
    a = a.withColumn("stage_id", (6 + F.abs(F.coalesce("frame_start", F.lit(0))) % 3).cast("int"))
    doc = F.struct(F.when(F.col("stage_id") == 6, F.col("status")).alias("status"), F.when(F.col("stage_id") == 7, F.col("status")).alias("decision"), F.when(F.col("stage_id") == 8, F.col("status")).alias("disposition"), F.struct(F.array(F.lit("one")).alias("uncertainties")).alias("quality"), F.col("score").alias("median_iou"), F.array_compact(F.array("frame_start")).alias("failed_frames"), F.array(F.struct(F.col("frame_start").alias("start"), F.col("frame_end").alias("end"), F.col("reason_code").alias("reason"))).alias("invalid_ranges"))
    r = index.payload_rows(a.select(*KEYS, "stage_id", F.to_json(doc).alias("payload_json")))
    return r.withColumn("ranges", F.array_join(F.transform("ranges", lambda x: F.concat_ws("-", x["frame_start"], x["frame_end"])), ",")).withColumn("score", F.round("score", 6))


_SIDES = """a as (select uid, max(scanned_at) as at, arg_max(frames, (scanned_at, frames)) as frames from datasets where scanned_at >= 1752068590 group by all), b as (select uid, max(scanned_at) as at, arg_max(frames, (scanned_at, frames)) as frames from datasets where scanned_at < 1752068590 group by all),
  c as (select uid, case when b.at is null then 'new' when a.at is null then 'gone' when a.frames is not distinct from b.frames then 'unchanged' else 'changed' end as state from a full join b using (uid))"""


def scan_sides(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    d = table(spark, folder, "datasets")
    side = lambda when: d.filter(when).groupBy("uid").agg(F.max_by("frames", F.struct("scanned_at", "frames")).alias("frames"))
    return side("scanned_at >= 1752068590"), side("scanned_at < 1752068590")


@R.add(f"with {_SIDES} select * from c")
def source_changes(spark: SparkSession, folder: str) -> DataFrame:
    """What later scans changed against earlier ones."""
    return index.source_changes(*scan_sides(spark, folder), ["uid"], ["frames"])


@R.add(f"with {_SIDES} select uid, b.frames from b join c using (uid) where state = 'unchanged' union all select uid, a.frames from a join c using (uid) where state in ('new', 'changed')")
def refreshed_index(spark: SparkSession, folder: str) -> DataFrame:
    """The index after a scan: what is unchanged stays, what is new or changed is read anew, what is gone goes."""
    new, old = scan_sides(spark, folder)
    return index.refresh(old, new, index.source_changes(new, old, ["uid"], ["frames"]), "uid")


@R.add("""with r as (select distinct root, split_part(uid, '/', 1) as candidate from datasets), n as (select *, min(root) over (partition by candidate) as keeper from r)
  select root, case when root = keeper then candidate else concat(candidate, '--', left(sha256(root), 8)) end as uid from n""")
def unique_uids(spark: SparkSession, folder: str) -> DataFrame:
    """Identifiers of roots whose names collide."""
    d = table(spark, folder, "datasets").select("root", F.split_part("uid", F.lit("/"), F.lit(1)).alias("candidate")).distinct()
    return index.unique_uids(d)


@R.add("""with p as (select distinct dataset_uid, episode_index, frames from episodes where dataset_uid is not null), o as (select floor(episode_index / 100)::bigint as shard, sha256(string_agg(x, chr(10) order by episode_index, x)) as f from (select episode_index, concat(dataset_uid, ':', coalesce(frames, -1)) as x from p where coalesce(frames, 0) < 400) group by all),
  n as (select floor(episode_index / 100)::bigint as shard, sha256(string_agg(x, chr(10) order by episode_index, x)) as f from (select episode_index, concat(dataset_uid, ':', coalesce(frames, -1)) as x from p where episode_index % 1000 >= 100) group by all)
  select shard, case when n.f is null then 'remove' else 'upsert' end as change from o full join n using (shard) where o.f is distinct from n.f""")
def changed_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Shards to write and to remove between two states of a snapshot."""
    p = table(spark, folder, "episodes").filter("dataset_uid is not null").select("dataset_uid", "episode_index", "frames").distinct().withColumn("payload_json", F.concat("dataset_uid", F.lit(":"), F.coalesce("frames", F.lit(-1))))
    one = lambda when: C.shard_fingerprints(p.filter(when), 100)
    return C.changed_shards(one("coalesce(frames, 0) < 400"), one("episode_index % 1000 >= 100"))


@R.add("""select component, cast(sum(n) as bigint) as records, cast(sum(b) as bigint) as bytes from (select component, count(*) as n, sum(payload_length) as b from roboomni_records group by component, recorded_at < '2025-06-01') group by all""")
def merged_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of two periods added up."""
    r = table(spark, folder, "roboomni_records")
    part = lambda when: r.filter(when).groupBy("component").agg(F.count(F.lit(1)).alias("records"), F.sum("payload_length").alias("bytes"))
    return C.merge_counts(part("recorded_at < '2025-06-01'"), part("coalesce(recorded_at >= '2025-06-01', true)"), ["component"], ["records", "bytes"])


@R.add(f"""with {_S}, g as (select dataset_uid, episode_index, stage_id, case when verdict = 'pass' then 'episode_pending' else 'available' end as artifact_status, verdict from r)
  select dataset_uid, episode_index, stage_id, case when artifact_status <> 'available' and exists (select 1 from g p where p.dataset_uid = g.dataset_uid and p.episode_index = g.episode_index and p.stage_id < g.stage_id and p.verdict in {_BAD}) then 'upstream_filtered' else artifact_status end as artifact_status from g""")
def filled_missing(spark: SparkSession, folder: str) -> DataFrame:
    """Pending stages behind a rejecting one become inherited."""
    rows = stage_rows(spark, folder).withColumn("artifact_status", F.when(F.col("verdict") == "pass", "episode_pending").otherwise("available"))
    return C.fill_missing(rows).select(*KEYS, "stage_id", "artifact_status")


@R.add(f"""with {_EP}, {_S}, g as (select e.dataset_uid, e.episode_index, unnest(range(1, 9)) as stage_id from e), j as (select g.dataset_uid, g.episode_index, g.stage_id, r.verdict from g left join r using (dataset_uid, episode_index, stage_id)),
  b as (select *, last_value(case when verdict is not null then verdict in {_BAD} end ignore nulls) over (partition by dataset_uid, episode_index order by stage_id rows between unbounded preceding and 1 preceding) as bad from j),
  n as (select dataset_uid, episode_index, cast(sum(flagged) as bigint) as anomalies from r group by all)
  select dataset_uid, episode_index, string_agg(coalesce(verdict, case when bad then 'upstream_filtered' else 'not_generated' end), ',' order by stage_id) as stages, any_value(anomalies) as anomalies from b left join n using (dataset_uid, episode_index) group by all""")
def previews(spark: SparkSession, folder: str) -> DataFrame:
    """Each episode with its eight badges and its anomalies."""
    p = index.previews(episode_search(spark, folder), stage_rows(spark, folder).withColumn("anomaly_count", F.col("flagged")))
    return p.select(*KEYS, F.array_join(F.transform("stages", lambda s: s["badge"]), ",").alias("stages"), "anomalies")


# --- videos, timelines, ranges

_VIDEO = f"""{_EP}, k as (select dataset_uid, episode_index, frames, duration, coalesce(sum(duration) over (partition by dataset_uid order by episode_index rows between unbounded preceding and 1 preceding), 0) as a from e where frames is not null and duration is not null),
  z as (select k.*, concat('videos/', dataset_uid) as path, t.n is null as missing from k left join (select dataset_uid, count(*) as n from tasks group by all) t using (dataset_uid)),
  tl as (select dataset_uid, episode_index, path, case when missing then 'missing' when abs(a + duration - a - frames / 30) > greatest(1 / 30, 1e-6) then 'duration_mismatch' else 'pass' end as integrity from z)"""


def timeline(spark: SparkSession, folder: str) -> DataFrame:
    """One camera of each dataset, whose file holds its episodes one behind the other."""
    e = episode_search(spark, folder).filter("frames is not null and duration is not null")
    before = F.coalesce(F.sum("duration").over(Window.partitionBy("dataset_uid").orderBy("episode_index").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    camera = F.struct(F.lit("front").alias("camera"), F.concat(F.lit("videos/"), "dataset_uid").alias("path"), before.alias("from_timestamp"), (before + F.col("duration")).alias("to_timestamp"))
    files = table(spark, folder, "tasks").select(F.concat(F.lit("videos/"), "dataset_uid").alias("path"), F.lit(0.0).alias("duration")).distinct()
    return C.video_timeline(e.select(*KEYS, "frames", F.lit(30.0).alias("fps"), F.array(camera).alias("cameras")), files)


@R.add(f"with {_VIDEO} select integrity, count(*) as videos from tl group by all")
def video_timeline(spark: SparkSession, folder: str) -> DataFrame:
    """States of episodes' windows in their files."""
    return timeline(spark, folder).groupBy("integrity").agg(F.count(F.lit(1)).alias("videos"))


@R.add(f"with {_VIDEO} select dataset_uid, episode_index, path from tl where integrity = 'duration_mismatch'")
def list_videos(spark: SparkSession, folder: str) -> DataFrame:
    return C.list_videos(timeline(spark, folder), "duration_mismatch").select(*KEYS, "path")


_CLAMP = f"""{_EP}, c as (select a.*, least(greatest(coalesce(frame_start, 0), 0), greatest(frames - 1, 0)) as s, greatest(frames - 1, 0) as last from annotations a join e using (dataset_uid, episode_index) where frames is not null),
  cl as (select dataset_uid, episode_index, annotation_id, created_at, s as frame_start, least(greatest(coalesce(frame_end, frame_start, s), s), last) as frame_end from c)"""


def on_timelines(spark: SparkSession, folder: str) -> DataFrame:
    a = table(spark, folder, "annotations").select("annotation_id", "created_at", *KEYS, "frame_start", "frame_end").withColumn("time_start", F.lit(0.0)).withColumn("time_end", F.lit(None).cast("double"))
    return a.join(episode_search(spark, folder).select(*KEYS, "frames"), KEYS)


@R.add(f"with {_CLAMP} select annotation_id, created_at, frame_start, frame_end from cl")
def clamp_intervals(spark: SparkSession, folder: str) -> DataFrame:
    """Ranges of annotations on their episodes' timelines; without a begin they start at second 0."""
    return runs.clamp_intervals(on_timelines(spark, folder), "frames", F.lit(30.0)).select("annotation_id", "created_at", "frame_start", "frame_end")


@R.add(f"""with {_CLAMP}, o as (select *, max(frame_end) over (partition by dataset_uid, episode_index order by frame_start, frame_end rows between unbounded preceding and 1 preceding) as before from cl),
  n as (select *, sum(case when before is null or frame_start > before + 1 then 1 else 0 end) over (partition by dataset_uid, episode_index order by frame_start, frame_end rows unbounded preceding) as island from o)
  select dataset_uid, episode_index, min(frame_start) as frame_start, max(frame_end) as frame_end from n group by dataset_uid, episode_index, island""")
def stage_intervals(spark: SparkSession, folder: str) -> DataFrame:
    """The same, merged."""
    return runs.stage_intervals(on_timelines(spark, folder), KEYS, "frames", F.lit(30.0))


@R.add("""select dataset_uid, episode_index, array_to_string(case when frames <= 0 then [] when frames <= 5 then range(frames) else list_transform(range(5), lambda i: cast(round_even(i * (frames - 1) / 4, 0) as bigint)) end, ',') as places from (select distinct dataset_uid, episode_index, frames from episodes where frames is not null)""")
def sampled_places(spark: SparkSession, folder: str) -> DataFrame:
    """The five frames of each episode that a check would look at."""
    e = table(spark, folder, "episodes").filter("frames is not null").select(*KEYS, "frames").distinct()
    return e.select(*KEYS, F.array_join(legacy.sampled_places(F.col("frames")), ",").alias("places"))


@R.add(f"""with {FRAMES}, h as (select dataset_uid, episode_index, frame_index, "index" % 1000 as "index" from f), i as (select *, lag("index") over {W} as p from h), m as (select dataset_uid, episode_index, min("index") as a, max("index") as b from h group by all),
  x as (select *, lag(b) over (partition by dataset_uid order by episode_index) as p from m)
  select dataset_uid, episode_index, frame_index, "index" from i where p >= "index" union all select dataset_uid, episode_index, 0, a from x where p >= a""")
def order_violations(spark: SparkSession, folder: str) -> DataFrame:
    """Frames whose number does not rise, where numbers begin anew after a thousand."""
    return curation.order_violations(frame_rows(spark, folder).withColumn("index", F.col("index") % 1000))


# --- outcomes

_STAGE_NAME = "['" + "','".join(legacy.STAGES) + "'][stage_id]"


@R.add(f"with {_S} select dataset_uid, episode_index, coalesce('rejected: ' || min_by(case when rejected then {_STAGE_NAME} end, case when rejected then stage_id end), 'kept') as status from r group by all")
def episode_status(spark: SparkSession, folder: str) -> DataFrame:
    """The first stage that rejects each episode."""
    log = stage_rows(spark, folder).select(*KEYS, F.get(F.array(*map(F.lit, legacy.STAGES)), F.col("stage_id") - 1).alias("stage"), "rejected")
    return legacy.episode_status(log)


@R.add(_FLAGS + f""", od as (select f.*, row_number() over {W} - 1 as p from f), lost as (select od.dataset_uid, od.episode_index, od.p, g.frame_index is not null as gone from od left join g using (dataset_uid, episode_index, frame_index))
  select dataset_uid, episode_index, coalesce(string_agg(case when gone then p end, ',' order by p), '') as dropped, count(*) filter (not gone) as output_frame_count from lost group by all""")
def dropped_frames(spark: SparkSession, folder: str) -> DataFrame:
    """Positions of the frames that stage 3 takes out of each episode."""
    before = frame_rows(spark, folder).select(*KEYS, *ORDER)
    gone = stage3(spark, folder)["frame_flags"].select(*KEYS, *ORDER)
    return legacy.dropped_frames(before, before.join(gone, [*KEYS, *ORDER], "left_anti")).select(*KEYS, F.array_join("dropped_frame_indices", ",").alias("dropped"), "output_frame_count")


@R.add(_FLAGS + """ select (select count(*) from (select distinct dataset_uid, episode_index from f)) as input_episodes, count(distinct (dataset_uid, episode_index)) as output_episodes, count(*) as output_frames from f where (dataset_uid, episode_index) not in (select dataset_uid, episode_index from g)""")
def run_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Episodes and frames before and after leaving out all episodes with an extreme frame."""
    f = frame_rows(spark, folder)
    return legacy.run_totals(f, f.join(stage3(spark, folder)["frame_flags"].select(*KEYS).distinct(), KEYS, "left_anti"))


# --- planning

@R.add("""with p as (select dataset_uid, instruction as task, frames from episodes where dataset_uid is not null) select dataset_uid, count(*) as episodes, cast(coalesce(sum(frames), 0) as bigint) as frames, count(distinct task) as tasks, min(task) as first_task from p group by all""")
def plan_summary(spark: SparkSession, folder: str) -> DataFrame:
    """What a plan of each dataset holds."""
    p = table(spark, folder, "episodes").filter("dataset_uid is not null").select("dataset_uid", "episode_index", "frames", F.col("instruction").alias("task"))
    return units.plan_summary(p, ["dataset_uid"]).select("dataset_uid", "episodes", "frames", F.size("tasks").cast("bigint").alias("tasks"), F.get("tasks", F.lit(0)).alias("first_task"))


@R.add("""with plan as (select distinct name as unit, coalesce(schema_fingerprint, '') as fingerprint from dexcap_partitions), done as (select distinct name as unit, coalesce(schema_fingerprint, '') as fingerprint from dexcap_partitions where snapshot_id % 2 = 0)
  select * from plan except select * from done""")
def remaining_units(spark: SparkSession, folder: str) -> DataFrame:
    """Partitions whose verified result belongs to another fingerprint or is missing."""
    d = table(spark, folder, "dexcap_partitions").select(F.col("name").alias("unit"), F.coalesce("schema_fingerprint", F.lit("")).alias("fingerprint"), "snapshot_id")
    done = d.filter("snapshot_id % 2 = 0").withColumn("status", F.lit("verified"))
    return units.remaining(d.select("unit", "fingerprint").distinct(), done, ["unit"])


@R.add(f"""with {stages._NAMES}, d as (select * from datasets qualify row_number() over (partition by uid order by scanned_at desc, snapshot_id desc) = 1),
  s as (select uid, case when json_valid(schema_json) then try_cast(json_extract_string(schema_json, '$."observation.state".shape[0]') as int) end as state_places, case when json_valid(schema_json) then try_cast(json_extract_string(schema_json, '$."action".shape[0]') as int) end as action_places from d),
  m as (select uid, count(*) as n from named group by all)
  select uid as dataset_uid, state_places, action_places, coalesce(n, 0) as mapped_places, case when state_places is null or action_places is null or least(state_places, action_places) < 1 then 'unsupported' when n is null then 'stage2_mapping_required' else 'ready' end as status from s left join m using (uid)""")
def readiness(spark: SparkSession, folder: str) -> DataFrame:
    """Which datasets can go through the stages."""
    v = last_scans(spark, folder).withColumn("v", F.try_parse_json("schema_json"))
    places = lambda k: F.try_variant_get("v", f"$['{k}'].shape[0]", "int")
    shapes = v.select(F.col("uid").alias("dataset_uid"), places("observation.state").alias("state_places"), places("action").alias("action_places"))
    return curation.readiness(shapes, stages.name_map(spark, folder))


# --- lists and names

@R.add("select distinct uid, codebase_version from datasets where contains(lower(uid), 'pick') and codebase_version = 'v3.0'")
def list_datasets(spark: SparkSession, folder: str) -> DataFrame:
    return C.list_datasets(table(spark, folder, "datasets"), "PICK", "v3.0").select("uid", "codebase_version").distinct()


@R.add(r"""select distinct root, case when length(made) <= 40 then made else concat(left(made, 40), '-', left(sha256(root), 8)) end as uid
  from (select root, array_to_string(list_transform(list_filter(string_split(root, '/'), lambda p: p <> ''), lambda p: coalesce(nullif(regexp_replace(regexp_replace(p, '[^A-Za-z0-9._-]+', '-', 'g'), '^[-._]+|[-._]+$', '', 'g'), ''), 'dataset')), '--') as made from datasets)""")
def dataset_uids(spark: SparkSession, folder: str) -> DataFrame:
    """Identifiers made from paths, long ones with a digest."""
    return table(spark, folder, "datasets").select("root", scalars.dataset_uid(F.col("root"), longest=40).alias("uid")).distinct()


@R.add("""select distinct dataset_uid, episode_index, case when json_valid(metadata_json) then json_extract_string(metadata_json, '$.calib.board') end as board, case when json_valid(metadata_json) then json_extract_string(metadata_json, '$.take') end as take from episodes""")
def nested_values(spark: SparkSession, folder: str) -> DataFrame:
    """Values inside JSON documents by their paths; unreadable ones have none."""
    m = F.col("metadata_json")
    return table(spark, folder, "episodes").select(*KEYS, scalars.nested(m, "calib.board").alias("board"), scalars.nested(m, "take").alias("take")).distinct()


@R.add("""select dataset_uid, episode_index, printf('videos/front/chunk-%03d/file-%03d.mp4', episode_index // 1000, episode_index % 1000) as path from (select distinct dataset_uid, episode_index from episodes where episode_index >= 0)""")
def video_paths(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "episodes").filter("episode_index >= 0").select(*KEYS).distinct()
    return e.select(*KEYS, scalars.video_path(F.lit("front"), F.expr("episode_index div 1000"), F.col("episode_index") % 1000).alias("path"))


@R.add("""with d as (select * from datasets where json_valid(schema_json) and json_type(schema_json) = 'OBJECT' qualify row_number() over (partition by uid order by scanned_at desc, snapshot_id desc) = 1), k as (select uid, unnest(json_keys(schema_json)) as n from d),
  s as (select uid, n, 0 as side, case when n = 'observation.state' then 0 else 2 end as rank from k where n = 'observation.state' or starts_with(n, 'observation.state.') union all select uid, n, 1, case n when 'action' then 0 when 'actions' then 1 else 2 end from k where n in ('action', 'actions') or starts_with(n, 'action.') or starts_with(n, 'actions.'))
  select uid, string_agg(n, ',' order by side, rank, n) as fields from s group by all""")
def series_fields(spark: SparkSession, folder: str) -> DataFrame:
    """Fields to plot in the last readable scan of each dataset."""
    d = table(spark, folder, "datasets").withColumn("v", F.try_parse_json("schema_json")).filter(F.schema_of_variant("v").startswith("OBJECT"))
    last = d.groupBy("uid").agg(F.max_by("schema_json", F.struct("scanned_at", "snapshot_id")).alias("schema_json"))
    fields = scalars.series_fields(F.json_object_keys("schema_json"))
    return last.select("uid", F.array_join(fields, ",").alias("fields")).filter("fields <> ''")


@R.add("""select event_id, left(sha256(concat('["', event_type, '","', user_id, '"]')), 16) as etag from events""")
def etags(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select("event_id", scalars.etag([F.col("event_type"), F.col("user_id")]).alias("etag"))


@R.add(f"""with {FRAMES}, a as (select dataset_uid, episode_index, frame_index, list_concat(state, action)[1:16] as v, action[len(action) - 1:len(action)] as b from f where state is not null and action is not null and len(state) = len(action))
  select dataset_uid, case when len(v) = 14 then 'arms' when len(v) = 16 then case when isfinite(v[15]) and isfinite(b[1]) and isfinite(v[16]) and isfinite(b[2]) and abs(v[15] - b[1]) <= 1e-6 + 1e-5 * abs(b[1]) and abs(v[16] - b[2]) <= 1e-6 + 1e-5 * abs(b[2]) then 'arms_and_base' when v[15] is not distinct from b[1] and v[16] is not distinct from b[2] then 'arms_and_base' else 'base_differs' end else 'unknown' end as layout, count(*) as frames from a group by all""")
def action_layouts(spark: SparkSession, folder: str) -> DataFrame:
    """Layouts of vectors of 14 and 16 places, made here from states and actions."""
    f = frame_rows(spark, folder).filter("state is not null and action is not null and size(state) = size(action)")
    v, b = F.slice(F.concat("state", "action"), 1, 16), F.slice("action", F.size("action") - 1, 2)
    return f.select("dataset_uid", scalars.action_layout(v, b).alias("layout")).groupBy("dataset_uid", "layout").agg(F.count(F.lit(1)).alias("frames"))


# --- geometry

_POSE = "e as (select vec_id, embedding[1]::double as x, embedding[2]::double as y, embedding[3]::double as z, embedding[4]::double as a, embedding[5]::double as b, embedding[6]::double as c, embedding[7]::double as d from embeddings), u as (select *, sqrt(a * a + b * b + c * c + d * d) as n from e)"


def poses(spark: SparkSession, folder: str) -> DataFrame:
    """The first places of vectors as points and quaternions."""
    v = F.col("embedding").cast("array<double>")
    return table(spark, folder, "embeddings").select("vec_id", F.slice(v, 1, 3).alias("point"), F.slice(v, 4, 4).alias("q"))


@R.add(f"with {_POSE} select vec_id, case when z + 1 > 0 then round(500 * x / (z + 1) + 320, 4) end as u, case when z + 1 > 0 then round(510 * y / (z + 1) + 240, 4) end as v from u")
def pixels(spark: SparkSession, folder: str) -> DataFrame:
    """Points through a pinhole camera one unit behind the origin; none behind the camera."""
    at = geometry.pixel(F.col("point"), [[1, 0, 0, 0], [0, 1, 0, 0], [0, 0, 1, 1], [0, 0, 0, 1]], (500, 510, 320, 240))
    return poses(spark, folder).select("vec_id", *(F.round(F.get(at, F.lit(i)), 4).alias(n) for i, n in enumerate("uv")))


@R.add(f"""with {_POSE}, r as (select *, case when d < 0 then -1 else 1 end as flip, sqrt(a * a + b * b + c * c) / n as s from u)
  select vec_id, round(a / n * flip * k, 6) as rx, round(b / n * flip * k, 6) as ry, round(c / n * flip * k, 6) as rz from (select *, case when s < 1e-7 then 2 else 2 * atan2(s, d / n * flip) / s end as k from r)""")
def rotation_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Quaternions as axis times angle."""
    v = geometry.rotation_vector(F.col("q"))
    return poses(spark, folder).select("vec_id", *(F.round(F.get(v, F.lit(i)), 6).alias(n) for i, n in enumerate(("rx", "ry", "rz"))))


@R.add(f"with {_POSE} select vec_id, round(-y + 1, 6) as px, round(x + 2, 6) as py, round(z + 3, 6) as pz, round(h * a - h * b, 6) as qx, round(h * b + h * a, 6) as qy, round(h * c + h * d, 6) as qz, round(h * d - h * c, 6) as qw from (select *, sqrt(0.5) as h from u where n > 1e-8)")
def aligned_poses(spark: SparkSession, folder: str) -> DataFrame:
    """Poses turned by a quarter about the third axis, and shifted."""
    pose = geometry.align_pose(F.concat("point", "q"), geometry.rotation_matrix([[0, -1, 0], [1, 0, 0], [0, 0, 1]]), (1.0, 2.0, 3.0))
    p = poses(spark, folder).withColumn("p", pose).filter("p is not null")
    return p.select("vec_id", *(F.round(F.get("p", F.lit(i)), 6).alias(n) for i, n in enumerate(("px", "py", "pz", "qx", "qy", "qz", "qw"))))


# --- what readers share

@R.add("""with s as (select distinct name, scanned_at, snapshot_id, unnest(source_schema) as f from dexcap_partitions), c as (select distinct name, f.path as component, scanned_at, snapshot_id, lower(f.dtype) as dtype from s),
  o as (select name, component, scanned_at, snapshot_id, min(dtype) as dtype from c group by all), p as (select *, row_number() over w - 1 as p, case when dtype is not distinct from lag(dtype) over w and row_number() over w > 1 then 0 else 1 end as s from o window w as (partition by name, component order by scanned_at, snapshot_id)),
  r as (select *, sum(s) over (partition by name, component order by p rows unbounded preceding) - 1 as run from p) select name, component, cast(run as bigint) as run, any_value(dtype) as dtype, min(p) as start, max(p) + 1 as stop from r group by name, component, run""")
def dtype_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Stretches of scans in which a field of a partition keeps its type."""
    d = table(spark, folder, "dexcap_partitions").select("name", "scanned_at", "snapshot_id", F.inline("source_schema"))
    one = d.groupBy("name", F.col("path").alias("component"), "scanned_at", "snapshot_id").agg(F.min(F.lower("dtype")).alias("dtype"))
    return containers.dtype_runs(one, ["name", "component"], ["scanned_at", "snapshot_id"])


@R.add("""with r as (select source_file, byte_offset, max(task_index) as task_index from roboomni_records where byte_offset is not null group by all), p as (select *, row_number() over w - 1 as p, case when row_number() over w > 1 and task_index is not distinct from lag(task_index) over w then 0 else 1 end as s from r window w as (partition by source_file order by byte_offset)),
  i as (select *, sum(s) over (partition by source_file order by p rows unbounded preceding) - 1 as e from p) select source_file, cast(e as bigint) as episode_index, any_value(task_index) as task_index, min(p) as first, max(p) as last, count(*) as frames from i group by source_file, e""")
def episodes_of_segments(spark: SparkSession, folder: str) -> DataFrame:
    """Records of a file with one task in a row as episodes."""
    r = table(spark, folder, "roboomni_records").filter("byte_offset is not null").groupBy("source_file", "byte_offset").agg(F.max("task_index").alias("task_index"))
    return containers.episodes_of_segments(r, ["source_file"], "byte_offset", "task_index")


@R.add(f"""with {FRAMES}, n as (select dataset_uid, episode_index, frame_index, action as a, lead(state) over {W} as s from f), d as (select *, case when len(a) = len(s) then list_max(list_transform(range(1, len(a) + 1), lambda i: abs(a[i] - s[i]))) else 'inf'::double end as difference from n where s is not null)
  select dataset_uid, count(*) as frames from d where not (coalesce(difference, 'inf'::double) <= 0.5) group by all""")
def next_frame_targets(spark: SparkSession, folder: str) -> DataFrame:
    """Frames whose action is not what the next frame's state shows."""
    return containers.next_frame_targets(frame_rows(spark, folder), KEYS, tolerance=0.5).groupBy("dataset_uid").agg(F.count(F.lit(1)).alias("frames"))


@R.add("""with r as (select component, count(*) as states from roboomni_records where task_index is not null group by all), p as (select component, count(*) as actions from (select unnest(components) as component from roboomni_partitions) group by all)
  select component, coalesce(states, 0) as states, coalesce(actions, 0) as actions, coalesce(states, 0) = coalesce(actions, 0) as paired from r full join p using (component)""")
def linked_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Records and partitions of each component, which need not be as many."""
    r = table(spark, folder, "roboomni_records").filter("task_index is not null").select("component")
    return containers.linked_parts(r, table(spark, folder, "roboomni_partitions").select(F.explode("components").alias("component")), "component")


@R.add(f"with {FRAMES} select dataset_uid, episode_index, frame_index, round(frame_index / 30, 6) as episode_time, len(state) as state_places, len(action) as action_places from f")
def episode_series(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors with their times, as a plot reads them."""
    s = curation.episode_series(frame_rows(spark, folder), ["state", "action"], 30.0)
    return s.select(*KEYS, *ORDER, F.round("episode_time", 6).alias("episode_time"), F.size("state").alias("state_places"), F.size("action").alias("action_places"))


@R.add(f"""with {FRAMES} select dataset_uid, count(*) as frames, count(*) filter (state is null and action is null or coalesce(len(state) = len(action), false) and len(list_filter(range(1, len(state) + 1), lambda i: case when isnan(state[i]) or isnan(action[i]) then isnan(state[i]) and isnan(action[i]) else state[i] = action[i] or abs(state[i] - action[i]) <= 1e-8 + 0.01 * abs(action[i]) end)) = len(state)) as alike from f group by all""")
def vectors_close(spark: SparkSession, folder: str) -> DataFrame:
    """Frames whose action equals the state within a hundredth, in every place."""
    f = frame_rows(spark, folder)
    alike = scalars.close_values(F.col("state"), F.col("action"), f.schema["state"].dataType, rtol=0.01)
    return f.groupBy("dataset_uid").agg(F.count(F.lit(1)).alias("frames"), F.count_if(alike).alias("alike"))
