"""Queries of the catalog, search, views and upkeep."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trajlake.functions import scalars
from trajlake.functions.vectors import finite
from trajlake.plans import catalog as C
from trajlake.plans import curation
from trajlake.queries.problems import LATEST, latest_episodes
from trajlake.queries.registry import FRAMES, KEYS, ORDER, Registry, frame_rows, table

R = Registry()
QUERIES, SQL = R.queries, R.sql

_TASKS = "t as (select dataset_uid, task_index, min(task) as task_name from tasks group by all)"
_I = """i as (select dataset_uid, episode_index, arg_max(coalesce(instruction, ''), (indexed_at, coalesce(instruction, ''))) as instruction, arg_max(duration, (indexed_at, duration)) as duration
  from episodes where dataset_uid is not null and episode_index is not null group by all)"""
_EP = f"""{_TASKS}, {_I}, e as (select l.dataset_uid, l.episode_index, split_part(l.dataset_uid, '/', 1) as collection, l.frames, l.task_index, t.task_name, nullif(i.instruction, '') as instruction, i.duration
  from ({LATEST}) l join i using (dataset_uid, episode_index) left join t using (dataset_uid, task_index) where l.deleted_at is null)"""


def episode_search(spark: SparkSession, folder: str) -> DataFrame:
    """Episodes that are there, as a search sees them."""
    rows = table(spark, folder, "episodes").filter("dataset_uid is not null and episode_index is not null")
    text = rows.groupBy(*KEYS).agg(F.max_by(F.coalesce("instruction", F.lit("")), F.struct("indexed_at", F.coalesce("instruction", F.lit("")))).alias("instruction"), F.max_by("duration", F.struct("indexed_at", "duration")).alias("duration"))
    tasks = table(spark, folder, "tasks").groupBy("dataset_uid", "task_index").agg(F.min("task").alias("task_name"))
    e = latest_episodes(spark, folder).filter("deleted_at is null").join(text, KEYS).join(tasks, ["dataset_uid", "task_index"], "left")
    e = e.select(*KEYS, F.split_part("dataset_uid", F.lit("/"), F.lit(1)).alias("collection"), "frames", "task_index", "task_name", F.nullif("instruction", F.lit("")).alias("instruction"), "duration")
    return e.withColumn("normalized_text", scalars.search_text(F.col("collection"), F.col("dataset_uid"), F.col("task_name"), F.col("instruction"), F.col("episode_index")))


_S = """s as (select dataset_uid, episode_index, stage_id, 'available' as artifact_status, count(*) filter (status = 'open') as flagged, bool_or(status = 'failed' and coalesce(severity = 'high', false)) as rejected,
    count(score) as scored, min(score) as score from annotations where stage_id is not null group by all),
  r as (select *, case when stage_id in (1, 3) then case when rejected then 'filtered' when flagged > 0 then 'anomaly' else 'pass' end
    when stage_id = 2 then case when rejected then 'fail' when scored = 0 then 'unscored' else 'pass' end
    else case when rejected then 'fail' when flagged > 0 then 'anomaly' else 'pass' end end as verdict from s)"""


def stage_rows(spark: SparkSession, folder: str) -> DataFrame:
    """A row for each episode and stage with annotations."""
    a = table(spark, folder, "annotations").filter("stage_id is not null")
    s = a.groupBy(*KEYS, "stage_id").agg(F.count_if(F.col("status") == "open").alias("flagged"), F.bool_or((F.col("status") == "failed") & F.coalesce(F.col("severity") == "high", F.lit(False))).alias("rejected"), F.count("score").alias("scored"), F.min("score").alias("score"))
    return s.withColumn("artifact_status", F.lit("available")).withColumn("verdict", C.stage_verdict(F.col("stage_id"), F.col("rejected"), F.col("flagged"), F.col("scored")))


@R.add(f"with {_S} select dataset_uid, episode_index, stage_id, verdict, case when verdict in ('filtered', 'fail') then 'critical' when verdict in ('anomaly', 'unscored') then 'warning' end as severity from r")
def stage_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    r = stage_rows(spark, folder)
    return r.select(*KEYS, "stage_id", "verdict", C.stage_severity(F.col("stage_id"), F.col("verdict")).alias("severity"))


for _n in (1, 2):
    def _one(spark: SparkSession, folder: str, n: int = _n) -> DataFrame:
        return stage_verdicts(spark, folder).filter(F.col("stage_id") == n)

    _one.__name__ = f"verdict_stage{_n}"
    R.add(f"select * from ({SQL['stage_verdicts']}) where stage_id = {_n}")(_one)

_BAD = "('filtered', 'fail', 'not_candidate', 'upstream_filtered')"


@R.add(f"""with {_S} select dataset_uid, episode_index, stage_id, exists (select 1 from r p where p.dataset_uid = r.dataset_uid and p.episode_index = r.episode_index and p.stage_id < r.stage_id and p.verdict in {_BAD}) as inherits_any from r""")
def upstream_inheritance_any(spark: SparkSession, folder: str) -> DataFrame:
    return C.rejected_before(stage_rows(spark, folder)).select(*KEYS, "stage_id", "inherits_any")


@R.add(f"""with {_EP}, {_S}, g as (select dataset_uid, episode_index, unnest(range(1, 9)) as stage_id from e), j as (select g.dataset_uid, g.episode_index, cast(g.stage_id as int) as stage_id, r.verdict from g left join r using (dataset_uid, episode_index, stage_id)),
  b as (select *, last_value(case when verdict is not null then verdict in {_BAD} end ignore nulls) over (partition by dataset_uid, episode_index order by stage_id rows between unbounded preceding and 1 preceding) as bad from j)
  select dataset_uid, episode_index, stage_id, coalesce(verdict, case when bad then 'upstream_filtered' else 'not_generated' end) as badge from b""")
def upstream_inheritance_prev(spark: SparkSession, folder: str) -> DataFrame:
    return C.badges(episode_search(spark, folder), stage_rows(spark, folder))


@R.add(f"""with {_EP}, {_S}, n as (select stage_id, verdict, count(*) as episodes from r group by all), h as (select stage_id, sum(episodes) as have from n group by all),
  z as (select cast(unnest(range(1, 9)) as int) as stage_id) select stage_id, verdict, episodes from n union all
  select * from (select z.stage_id, 'not_generated' as verdict, cast(greatest(0, (select count(*) from e) - coalesce(have, 0)) as bigint) as episodes from z left join h using (stage_id)) where episodes > 0""")
def stage_facets(spark: SparkSession, folder: str) -> DataFrame:
    return C.stage_facets(episode_search(spark, folder), stage_rows(spark, folder))


@R.add(f"with {_EP} select dataset_uid, count(*) as episodes, cast(sum(frames) as bigint) as frames, count(distinct coalesce(task_name, cast(task_index as varchar))) as tasks from e group by all")
def dataset_summary(spark: SparkSession, folder: str) -> DataFrame:
    return C.dataset_summary(episode_search(spark, folder))


@R.add(f"with {_EP} select count(*) as episodes, count(distinct dataset_uid) as datasets, count(distinct collection) as collections, count(distinct concat(collection, ':', coalesce(task_name, cast(task_index as varchar), '-1'))) as tasks from e")
def distinct_task_count(spark: SparkSession, folder: str) -> DataFrame:
    e = episode_search(spark, folder)
    t = C.totals(e).select(F.col("total").alias("episodes"), F.col("datasets").alias("collections"), "tasks")
    return t.crossJoin(F.broadcast(e.agg(F.count_distinct("dataset_uid").alias("datasets"))))


@R.add("""with d as (select * from datasets qualify row_number() over (partition by uid order by scanned_at desc, snapshot_id desc) = 1)
  select split_part(uid, '/', 1) as collection, count(*) as datasets, cast(sum(episodes) as bigint) as episodes, cast(sum(frames) as bigint) as frames, round(sum(duration), 3) as duration, cast(sum(bytes) as bigint) as bytes from d group by all""")
def collection_rollup(spark: SparkSession, folder: str) -> DataFrame:
    d = last_scans(spark, folder)
    return d.groupBy(F.split_part("uid", F.lit("/"), F.lit(1)).alias("collection")).agg(F.count(F.lit(1)).alias("datasets"), F.sum("episodes").alias("episodes"), F.sum("frames").alias("frames"), F.round(F.sum("duration"), 3).alias("duration"), F.sum("bytes").alias("bytes"))


def last_scans(spark: SparkSession, folder: str) -> DataFrame:
    d = table(spark, folder, "datasets")
    return d.groupBy("uid").agg(F.max_by(F.struct(*(c for c in d.columns if c != "uid")), F.struct("scanned_at", "snapshot_id")).alias("r")).select("uid", "r.*")


@R.add(f"""with {_TASKS}, {_I}, l as ({LATEST}), k as (select dataset_uid, task_index, count(*) as n from l where deleted_at is null and task_index is not null group by all)
  select t.dataset_uid, t.task_index, t.task_name, coalesce(n, 0) as episodes from t left join k using (dataset_uid, task_index)""")
def tasks_with_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Every task, also those of no episode."""
    n = latest_episodes(spark, folder).filter("deleted_at is null and task_index is not null").groupBy("dataset_uid", "task_index").agg(F.count(F.lit(1)).alias("n"))
    t = table(spark, folder, "tasks").groupBy("dataset_uid", "task_index").agg(F.min("task").alias("task_name"))
    return t.join(n, ["dataset_uid", "task_index"], "left").select("dataset_uid", "task_index", "task_name", F.coalesce("n", F.lit(0)).alias("episodes"))


_TEXT = "lower(concat_ws(' ', collection, dataset_uid, task_name, instruction, concat('episode ', episode_index)))"
_PHRASES = f"concat(' ', array_to_string(regexp_extract_all(replace(strip_accents({_TEXT}), 'ß', 'ss'), '[\\p{{L}}\\p{{N}}]+'), ' '), ' ')"


@R.add(f"with {_EP} select dataset_uid, episode_index from e where contains({_PHRASES}, ' red ') and contains({_PHRASES}, ' place it ')")
def search_tokens_and(spark: SparkSession, folder: str) -> DataFrame:
    """Every part of the query as a phrase of whole words, the joined one as two words in a row."""
    e = episode_search(spark, folder)
    return e.filter(C.text_filter(F.col("normalized_text"), "RED place-it")).select(*KEYS)


@R.add(f"with {_EP}, {_S} select dataset_uid, episode_index from e where exists (select 1 from r where r.dataset_uid = e.dataset_uid and r.episode_index = e.episode_index and stage_id = 1 and verdict in ('anomaly', 'pass') and score >= 0.2) and (exists (select 1 from r where r.dataset_uid = e.dataset_uid and r.episode_index = e.episode_index and stage_id = 3 and verdict <> 'filtered') or not exists (select 1 from r where r.dataset_uid = e.dataset_uid and r.episode_index = e.episode_index and stage_id = 3))")
def search_stage_filter(spark: SparkSession, folder: str) -> DataFrame:
    """A filter that only excludes lets episodes through that lack the stage."""
    s = C.Search(stages=(C.StageFilter(1, ("anomaly", "pass"), low=0.2), C.StageFilter(3, exclude=("filtered",))))
    return C.matching(episode_search(spark, folder), stage_rows(spark, folder), s).select(*KEYS)


_LACKS = "not exists (select 1 from r where r.dataset_uid = e.dataset_uid and r.episode_index = e.episode_index and stage_id = {0})"
_UPSTREAM = f"exists (select 1 from r where r.dataset_uid = e.dataset_uid and r.episode_index = e.episode_index and stage_id < {{0}} and verdict in {_BAD})"
_IS = "exists (select 1 from r where r.dataset_uid = e.dataset_uid and r.episode_index = e.episode_index and stage_id = {0} and verdict = '{1}')"


def searched(spark: SparkSession, folder: str, s: C.Search) -> DataFrame:
    return C.matching(episode_search(spark, folder), stage_rows(spark, folder), s)


@R.add(f"with {_EP}, {_S} select dataset_uid, episode_index from e where {_IS.format(4, 'fail')} or {_LACKS.format(4)} and not {_UPSTREAM.format(4)}")
def search_not_generated(spark: SparkSession, folder: str) -> DataFrame:
    """Episodes that fail a stage, or lack it though nothing before rejects them."""
    return searched(spark, folder, C.Search(stages=(C.StageFilter(4, ("fail", "not_generated")),))).select(*KEYS)


@R.add(f"with {_EP}, {_S} select dataset_uid, episode_index from e where {_LACKS.format(5)} and {_UPSTREAM.format(5)}")
def search_upstream(spark: SparkSession, folder: str) -> DataFrame:
    """Episodes that lack a stage because one before rejects them."""
    return searched(spark, folder, C.Search(stages=(C.StageFilter(5, states=("upstream_filtered",)),))).select(*KEYS)


@R.add(f"with {_EP}, {_S} select dataset_uid, episode_index from e where {_IS.format(1, 'pass')}")
def search_excluding_missing(spark: SparkSession, folder: str) -> DataFrame:
    """Excluding what is missing keeps episodes with the stage only."""
    return searched(spark, folder, C.Search(stages=(C.StageFilter(1, exclude=("filtered", "anomaly", "not_generated")),))).select(*KEYS)


@R.add(f"with {_EP} select dataset_uid, episode_index from e where contains({_PHRASES}, ' numero ')")
def search_diacritics(spark: SparkSession, folder: str) -> DataFrame:
    """Marks on letters are ignored, in the query and in the texts."""
    return searched(spark, folder, C.Search("NUMËRO")).select(*KEYS)


@R.add(f"with {_EP}, {_S} select count(*) as total, count(distinct collection) as datasets, count(distinct concat(collection, ':', coalesce(task_name, cast(task_index as varchar), '-1'))) as tasks from e where contains({_PHRASES}, ' cube ') and {_IS.format(1, 'pass')}")
def search_totals(spark: SparkSession, folder: str) -> DataFrame:
    """What a search's heading says."""
    return C.totals(searched(spark, folder, C.Search("cube", stages=(C.StageFilter(1, ("pass",)),))))


@R.add(f"""with {_EP}, {_S}, p as (select * from e where contains({_PHRASES}, ' peg ') order by case when lower(instruction) = 'peg' then 0 when lower(task_name) = 'peg' then 1 when lower(collection) = 'peg' or lower(dataset_uid) = 'peg' then 2 else 3 end, collection nulls first, task_name nulls first, dataset_uid nulls first, episode_index limit 30),
  g as (select p.*, unnest(range(1, 9)) as stage_id from p), j as (select g.*, r.verdict, r.score, r.artifact_status from g left join r using (dataset_uid, episode_index, stage_id)),
  b as (select *, last_value(case when verdict is not null then verdict in {_BAD} end ignore nulls) over (partition by dataset_uid, episode_index order by stage_id rows between unbounded preceding and 1 preceding) as bad from j)
  select dataset_uid, episode_index, concat('【', collection, '】', coalesce(instruction, task_name, printf('Episode %04d', episode_index))) as title, cast(stage_id as int) as stage_id, coalesce(verdict, case when bad then 'upstream_filtered' else 'not_generated' end) as verdict,
    coalesce(artifact_status, verdict, case when bad then 'upstream_filtered' else 'not_generated' end) as status, score, array_to_string(list_filter([case when contains(lower(collection), 'peg') then 'collection' end, case when contains(lower(dataset_uid), 'peg') then 'dataset' end, case when contains(lower(task_name), 'peg') then 'task' end, case when contains(lower(instruction), 'peg') then 'instruction' end], lambda x: x is not null), ',') as reasons from b""")
def search_badges(spark: SparkSession, folder: str) -> DataFrame:
    """The first page of a search with titles, badges of all stages, and why each episode was found."""
    items = C.search(episode_search(spark, folder), stage_rows(spark, folder), C.Search("Peg"))["items"]
    return items.select(*KEYS, "title", F.array_join("match_reasons", ",").alias("reasons"), F.inline("stage_badges")).drop("range_count")


@R.add(f"with {_EP}, {_S} select dataset_uid, episode_index from e where not exists (select 1 from r where r.dataset_uid = e.dataset_uid and r.episode_index = e.episode_index and stage_id = 8) and exists (select 1 from r where r.dataset_uid = e.dataset_uid and r.episode_index = e.episode_index and stage_id < 8 and verdict in {_BAD})")
def search_missing_stage(spark: SparkSession, folder: str) -> DataFrame:
    return searched(spark, folder, C.Search(stages=(C.StageFilter(8, ("upstream_filtered",)),))).select(*KEYS).join(stage_rows(spark, folder).filter("stage_id = 8").select(*KEYS), KEYS, "left_anti")


@R.add(f"""with {_EP} select dataset_uid, episode_index from (select *, case when lower(instruction) = 'cube' then 0 when lower(task_name) = 'cube' then 1 when lower(collection) = 'cube' or lower(dataset_uid) = 'cube' then 2 else 3 end as rank from e where contains({_PHRASES}, ' cube '))
  order by rank nulls first, collection nulls first, task_name nulls first, dataset_uid nulls first, episode_index limit 30 offset 30""")
def search_relevance_page(spark: SparkSession, folder: str) -> DataFrame:
    """The second page of a search: a page is the feature."""
    return C.search_page(episode_search(spark, folder), stage_rows(spark, folder), C.Search("cube", page=2))[0].select(*KEYS)


@R.add(f"with {_EP}, o as (select *, row_number() over (order by duration desc nulls last, dataset_uid nulls first, episode_index) as n from e) select dataset_uid, episode_index, duration from o where n between 31 and 60")
def keyset_duration_desc(spark: SparkSession, folder: str) -> DataFrame:
    """The page behind the first one's cursor, by falling duration and rising names."""
    e, r = episode_search(spark, folder), stage_rows(spark, folder)
    _, cursor = C.search_page(e, r, C.Search(sort="duration_desc"))
    return C.search_page(e, r, C.Search(sort="duration_desc", cursor=cursor))[0].select(*KEYS, "duration")


@R.add("""with d as (select * from datasets qualify row_number() over (partition by uid order by scanned_at desc, snapshot_id desc) = 1),
  c as (select uid, unnest(from_json(cameras, '["varchar"]')) as camera, unnest(range(len(from_json(cameras, '["varchar"]')))) as place from d where json_valid(cameras)),
  k as (select *, case lower(camera) when 'observation.images.front' then -4 when 'front' then -3 when 'external_camera' then -2 when 'cam_high' then -1
    else case when regexp_matches(lower(camera), 'front|external|cam_high') then 1 when not contains(lower(camera), 'wrist') and regexp_matches(lower(camera), 'rgb|image') and not contains(lower(camera), 'depth') then 2
    when not contains(lower(camera), 'wrist') then 3 else 4 end end as rank from c)
  select uid, arg_min(camera, (rank, case when rank < 0 then -place else place end)) as primary_camera from k group by all""")
def primary_camera(spark: SparkSession, folder: str) -> DataFrame:
    d = last_scans(spark, folder).select("uid", F.from_json("cameras", "array<string>").alias("c")).filter(F.size("c") > 0)
    return d.select("uid", scalars.primary_camera(F.col("c")).alias("primary_camera"))


@R.add(r"""select distinct uid, coalesce(nullif(regexp_replace(regexp_replace(uid, '[^A-Za-z0-9._-]+', '-', 'g'), '^[-._]+|[-._]+$', '', 'g'), ''), 'dataset') as slug, left(sha256(root), 8) as hash, replace(uid, '/', '__') as safe_id from datasets""")
def uid_slug(spark: SparkSession, folder: str) -> DataFrame:
    d = table(spark, folder, "datasets").select("uid", "root").distinct()
    return d.select("uid", scalars.uid_part(F.col("uid")).alias("slug"), scalars.identity_hash(F.col("root"), 8).alias("hash"), scalars.safe_id(F.col("uid")).alias("safe_id"))


@R.add("""with x as (select root, uid, scanned_at from datasets) select distinct uid, first_value(uid) over (partition by root order by scanned_at desc, uid rows between unbounded preceding and unbounded following) as kept_uid from x""")
def merge_duplicate_roots(spark: SparkSession, folder: str) -> DataFrame:
    return C.merge_duplicate_roots(table(spark, folder, "datasets"))


@R.add("""with m as (select distinct uid, concat('new/', uid) as kept_uid from datasets) select coalesce(kept_uid, dataset_uid) as dataset_uid, count(*) as episodes from episodes left join m on uid = dataset_uid group by all""")
def rekeyed_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Episodes under new names of their datasets."""
    m = table(spark, folder, "datasets").select("uid", F.concat(F.lit("new/"), "uid").alias("kept_uid")).distinct()
    return C.rekey(table(spark, folder, "episodes"), m).groupBy("dataset_uid").agg(F.count(F.lit(1)).alias("episodes"))


# --- views

@R.add(f"with {FRAMES}, l as ({LATEST}) select f.dataset_uid, count(*) as frames from f where exists (select 1 from l where l.dataset_uid = f.dataset_uid and l.episode_index = f.episode_index and l.deleted_at is null) group by all")
def accepted_semi_join(spark: SparkSession, folder: str) -> DataFrame:
    ok = latest_episodes(spark, folder).select(*KEYS, F.col("deleted_at").isNull().alias("accepted"))
    return curation.accepted_only(frame_rows(spark, folder), [ok]).groupBy("dataset_uid").agg(F.count(F.lit(1)).alias("frames"))


_MARKS = "b as (select distinct dataset_uid, episode_index, unnest(range(frame_start, frame_end + 1)) as frame_index from annotations where frame_start <= frame_end and status = 'failed')"


def labelled(spark: SparkSession, folder: str, status: str) -> DataFrame:
    """Frames under annotations of a status, as a label table."""
    a = table(spark, folder, "annotations").filter(F.col("status") == status)
    f = curation.covered(frame_rows(spark, folder).select(*KEYS, *ORDER), a)
    return f.filter("covered").select(*KEYS, *ORDER, F.lit(False).alias("valid"))


@R.add(f"with {FRAMES}, {_MARKS} select dataset_uid, episode_index, count(*) as frames, count(*) filter (b.frame_index is null) as valid_frames from f left join b using (dataset_uid, episode_index, frame_index) group by all")
def invalid_anti_join(spark: SparkSession, folder: str) -> DataFrame:
    """Frames that no failed annotation covers."""
    f = curation.with_step_validity(frame_rows(spark, folder).select(*KEYS, *ORDER), [labelled(spark, folder, "failed")])
    return f.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("frames"), F.count_if("valid").alias("valid_frames"))


@R.add(f"""with {FRAMES}, x as (select distinct dataset_uid, episode_index, unnest(range(frame_start, frame_end + 1)) as frame_index, status <> 'failed' as valid from annotations where frame_start <= frame_end and status in ('failed', 'fixed')),
  y as (select x.* from x semi join f using (dataset_uid, episode_index, frame_index))
  select dataset_uid, count(*) as frames, count(*) filter (ok) as valid_frames from (select dataset_uid, episode_index, frame_index, bool_and(valid) as ok from y group by all) group by all""")
def validity_chain_and(spark: SparkSession, folder: str) -> DataFrame:
    """Frames under failed or fixed annotations, of which any failed one makes a frame invalid."""
    v = curation.chain_validity([labelled(spark, folder, "failed"), labelled(spark, folder, "fixed").withColumn("valid", F.lit(True))])
    return v.groupBy("dataset_uid").agg(F.count(F.lit(1)).alias("frames"), F.count_if("valid").alias("valid_frames"))


def repairs(spark: SparkSession, folder: str) -> DataFrame:
    """Two layers of repairs: the first replaces forces that push down, the second, above it, those that push back."""
    f = frame_rows(spark, folder).filter("force is not null")
    one = f.filter("force[2] < 0").withColumn("force", F.transform("force", lambda x: F.when(finite(x), x).otherwise(0.0)))
    two = f.filter("force[1] < 0").withColumn("force", F.transform("force", lambda x: F.when(finite(x), x * 2).otherwise(1.0)))
    return curation.overlay_repairs([one, two], ["force"])


_REPAIRS = f"""{FRAMES}, o as (select dataset_uid, episode_index, frame_index, force, case when force[2] < 0 then list_transform(force, lambda x: case when isfinite(x) then x * 2 else 1 end)
  when force[3] < 0 then list_transform(force, lambda x: case when isfinite(x) then x else 0 end) end as fixed from f where force is not null)"""


@R.add(f"with {_REPAIRS} select dataset_uid, count(*) as frames, (sum(fixed[1]) filter (isfinite(fixed[1])))::float as total from o where fixed is not null group by all")
def overlay_repairs(spark: SparkSession, folder: str) -> DataFrame:
    """Repaired frames of two layers, with the sum of their finite forces."""
    x = F.get("force", F.lit(0))
    return repairs(spark, folder).groupBy("dataset_uid").agg(F.count(F.lit(1)).alias("frames"), F.sum(F.when(finite(x), x)).cast("float").alias("total"))


@R.add(f"""with {_REPAIRS}, d as (select dataset_uid, episode_index, frame_index, cast(unnest(range(len(force))) as int) as dimension, unnest(force) as x, unnest(coalesce(fixed, force)) as y from o)
  select dataset_uid, episode_index, frame_index, dimension, y - x as difference from d where isfinite(x) and y - x <> 0""")
def series_diff_view(spark: SparkSession, folder: str) -> DataFrame:
    """What the repairs change, in every place of the force."""
    f = frame_rows(spark, folder).filter("force is not null")
    d = curation.series_view(f, "force", "diff", repairs=repairs(spark, folder)).select(*KEYS, *ORDER, F.posexplode("value").alias("dimension", "difference"))
    return d.filter(finite(F.col("difference")) & (F.col("difference") != 0))


@R.add(f"with {FRAMES}, {_MARKS} select dataset_uid, count(*) as frames, coalesce(cast(sum(case when b.frame_index is null then len(list_filter(state, lambda x: x is not null)) end) as bigint), 0) as readings from f left join b using (dataset_uid, episode_index, frame_index) group by all")
def series_valid_view(spark: SparkSession, folder: str) -> DataFrame:
    """States with nulls where a failed annotation covers the frame."""
    v = curation.series_view(frame_rows(spark, folder), "state", "valid", validity=labelled(spark, folder, "failed"))
    return v.groupBy("dataset_uid").agg(F.count(F.lit(1)).alias("frames"), F.coalesce(F.sum(F.size(F.array_compact("value"))), F.lit(0)).cast("bigint").alias("readings"))


# --- upkeep

@R.add("""select dataset_uid, episode_index from (select distinct dataset_uid, episode_index from episodes) where (dataset_uid, episode_index) not in (select dataset_uid, episode_index from episodes where indexed_at > 1750000000)""")
def tombstone_diff(spark: SparkSession, folder: str) -> DataFrame:
    """Episodes of an older listing that a newer one lacks."""
    e = table(spark, folder, "episodes")
    return C.tombstones(e, e.filter("indexed_at > 1750000000"), KEYS)


@R.add("""with p as (select distinct dataset_uid, episode_index, concat('{"frames":', frames, '}') as payload_json from episodes)
  select dataset_uid, cast(floor(episode_index / 100) as bigint) as shard, count(*) as rows, min(episode_index) as min_episode, max(episode_index) as max_episode, sha256(string_agg(payload_json, chr(10) order by episode_index, payload_json)) as fingerprint from p group by all""")
def shard_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    """Shards of each dataset's stage snapshot."""
    p = table(spark, folder, "episodes").select("dataset_uid", "episode_index", F.concat(F.lit('{"frames":'), "frames", F.lit("}")).alias("payload_json")).distinct()
    return C.shard_fingerprints(p, 100, ["dataset_uid"])


@R.add("""with o as (select distinct dataset_uid, episode_index, frames from episodes qualify row_number() over (partition by dataset_uid, episode_index order by indexed_at, frames) = 1),
  n as (select distinct dataset_uid, episode_index, frames + 1 as frames from o where frames > 100)
  select * from n union all select * from o where frames <= 100 or frames is null""")
def upsert_latest(spark: SparkSession, folder: str) -> DataFrame:
    """First deliveries, those of long episodes replaced."""
    o = table(spark, folder, "episodes").groupBy(*KEYS).agg(F.min_by("frames", F.struct("indexed_at", "frames")).alias("frames"))
    return C.upsert(o, o.filter("frames > 100").withColumn("frames", F.col("frames") + 1), KEYS)


@R.add("""with a as (select uid, max(frames) as v from datasets where scanned_at < 1748000000 group by all), b as (select uid, max(frames) as v from datasets where scanned_at > 1740000000 group by all)
  select uid, case when b.uid is null then 'missing' when a.uid is null then 'extra' else 'changed' end as difference from a full join b using (uid) where a.v is distinct from b.v""")
def key_differences(spark: SparkSession, folder: str) -> DataFrame:
    """Datasets that earlier and later scans list differently."""
    d = table(spark, folder, "datasets")
    part = lambda when: d.filter(when).groupBy("uid").agg(F.max("frames").alias("v"))
    return C.key_differences(part("scanned_at < 1748000000"), part("scanned_at > 1740000000"), "uid", "v")


@R.add("""select dataset_uid, episode_index, 'left' as side from (select dataset_uid, episode_index from episodes except all select distinct dataset_uid, episode_index from episodes)""")
def table_equivalence(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of episodes that its distinct rows lack."""
    e = table(spark, folder, "episodes").select(*KEYS)
    return C.table_differences(e, e.distinct())


@R.add(f"""with {_S}, l as (select cast(stage_id as varchar) as stage, verdict as reason, rejected from r)
  select stage, null as reason, count(*) as episodes, false as unverified from l where rejected group by stage union all
  select stage, reason, count(*), reason = 'unscored' from l group by stage, reason""")
def stage_reason_counts(spark: SparkSession, folder: str) -> DataFrame:
    log = stage_rows(spark, folder).select(F.col("stage_id").cast("string").alias("stage"), F.col("verdict").alias("reason"), "rejected")
    return C.outcome_counts(log, ["unscored"])


@R.add("""with f as (select concat(source_file, '#', byte_offset) as path, max(payload_length) as size, max(epoch_us(recorded_at)) as mtime from roboomni_records group by all),
  u as (select *, sum(size) over (order by mtime desc, path rows unbounded preceding) as upto from f) select path, size from u where upto > 100000000""")
def lru_prune(spark: SparkSession, folder: str) -> DataFrame:
    """Payloads to drop so that the newest 100 MB remain."""
    f = table(spark, folder, "roboomni_records").groupBy(F.concat_ws("#", "source_file", "byte_offset").alias("path")).agg(F.max("payload_length").alias("size"), F.max(F.unix_micros(F.col("recorded_at").cast("timestamp"))).alias("mtime"))
    return C.least_recent(f, 100_000_000).select("path", "size")


@R.add("select dataset_uid, arg_max(path, (stage, f, mtime)) as path from (select dataset_uid, annotation_id as path, stage_id as stage, case when source = 'auto' then 1 else 0 end as f, created_at as mtime from annotations where stage_id is not null) group by all")
def latest_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The artefact to use of each dataset: highest stage, automatic before manual, newest."""
    a = table(spark, folder, "annotations").filter("stage_id is not null").select("dataset_uid", F.col("annotation_id").alias("path"), F.col("stage_id").alias("stage"), F.when(F.col("source") == "auto", "filter").otherwise("overlay").alias("format"), F.col("created_at").alias("mtime"))
    return C.latest_manifest(a)


@R.add("select annotation_id, arg_max(review_status, (review_status <> 'pending', created_at, review_status)) as review_status from annotations group by all")
def latest_reviews(spark: SparkSession, folder: str) -> DataFrame:
    return C.latest_reviews(table(spark, folder, "annotations")).select("annotation_id", "review_status")


@R.add("""select dataset_uid, episode_index from (select distinct dataset_uid, episode_index, instruction from episodes) where case when true then contains(lower(coalesce(instruction, '')), 'peg') end group by all""")
def instruction_search(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "episodes").filter(C.episode_query(F.col("instruction"), F.col("episode_index"), "Peg")).select(*KEYS).distinct()


@R.add("select distinct dataset_uid, episode_index from episodes where episode_index = 12")
def episode_number_search(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "episodes").filter(C.episode_query(F.col("instruction"), F.col("episode_index"), "Episode 12")).select(*KEYS).distinct()
