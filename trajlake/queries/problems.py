"""Queries of the general data problems, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trajlake.operators.dense_totals import dense_totals
from trajlake.operators.intervals import periods_and_gaps
from trajlake.operators.references import Reference, Table, find_orphans
from trajlake.operators.schema_drift import FIELDS, schema_changes, schema_fields, struct_fields, union_fields
from trajlake.operators.spikes import find_spikes
from trajlake.plans.storage import cut
from trajlake.sources.drifting import read_drifting

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return find_spikes(table(spark, folder, "frames")).drop("value", "kinds")


@query
def p1_report(spark: SparkSession, folder: str) -> DataFrame:
    """Cases by dataset, feature, dimension and kind."""
    found = find_spikes(table(spark, folder, "frames"))
    bit = lambda n, name: F.count_if(F.col("kinds").bitwiseAND(n) > 0).alias(name)
    return found.groupBy("dataset_uid", "feature", "dimension").agg(F.count(F.lit(1)).alias("cases"), bit(1, "not_finite"), bit(2, "beyond_fences"), bit(4, "excursions"), bit(8, "stuck"))


def all_scans(spark: SparkSession, folder: str) -> DataFrame:
    """The scans of the three tables with schemas, under one layout."""
    kinds = (("datasets", "uid", lambda: schema_fields("schema_json")), ("roboomni_partitions", "name", lambda: struct_fields(F.col("fields"), "source_key")), ("dexcap_partitions", "name", lambda: struct_fields(F.col("source_schema"), "path")))
    parts = [table(spark, folder, t).select(F.lit(t).alias("table_name"), F.col(entity).alias("entity"), "snapshot_id", F.col("scanned_at").alias("at"), fields().cast(FIELDS).alias("fields")) for t, entity, fields in kinds]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return schema_changes(all_scans(spark, folder)).select("table_name", "entity", "snapshot_id", "field_name", "change")


@query
def p2_changes(spark: SparkSession, folder: str) -> DataFrame:
    """The changes with new names and types."""
    return schema_changes(all_scans(spark, folder))


@query
def p2_moves(spark: SparkSession, folder: str) -> DataFrame:
    """Fields that vanish, come or change type from scan to scan, before renamings are paired."""
    c = schema_changes(all_scans(spark, folder))
    old = F.when(F.col("change").isin("renamed", "removed"), F.struct(F.col("field_name").alias("field"), F.lit("gone").alias("move")))
    new = F.when(F.col("change") == "renamed", F.struct(F.col("new_name").alias("field"), F.lit("come").alias("move"))).when(F.col("change") == "added", F.struct(F.col("field_name").alias("field"), F.lit("come").alias("move")))
    kept = F.when(F.col("change") == "retyped", F.struct(F.col("field_name").alias("field"), F.lit("retyped").alias("move")))
    return c.select("table_name", "entity", "snapshot_id", F.inline(F.array_compact(F.array(old, new, kept))))


SQL["p2_moves"] = r"""with j as (select 'datasets' as t, uid as entity, snapshot_id, scanned_at as tm, case when json_valid(schema_json) then schema_json::json end as d from datasets),
  k as (select *, case when json_type(d) = 'OBJECT' and len(json_keys(d)) = 1 then json_keys(d)[1] end as one_key from j where d is not null),
  b as (select t, entity, snapshot_id, tm, case when one_key in ('features', 'fields') and json_type(d, '$.' || one_key) in ('OBJECT', 'ARRAY') then json_extract(d, '$.' || one_key) else d end as s from k),
  e as (select b.t, b.entity, b.snapshot_id, b.tm, case when json_type(b.s) = 'OBJECT' then je.key else coalesce(json_extract_string(je.value, '$.name'), json_extract_string(je.value, '$.source_key'), json_extract_string(je.value, '$.path')) end as name, je.value as spec from b, json_each(b.s) je where json_type(b.s) in ('OBJECT', 'ARRAY')),
  n as (select t, entity, snapshot_id, tm, name, regexp_replace(lower(coalesce(case when json_type(spec) = 'OBJECT' then json_extract_string(spec, '$.dtype') else json_extract_string(spec, '$') end, '')), '\s+', '', 'g') as dtype,
      case when json_type(spec) = 'OBJECT' and json_type(spec, '$.shape') = 'ARRAY' then array_to_string(json_extract_string(spec, '$.shape[*]'), ',') when json_type(spec) = 'OBJECT' then coalesce(json_extract_string(spec, '$.shape'), '') else '' end as shape from e where name is not null
    union all select 'roboomni_partitions', name, snapshot_id, scanned_at, f.source_key, regexp_replace(lower(coalesce(f.dtype, '')), '\s+', '', 'g'), coalesce(array_to_string(f.shape, ','), '') from (select name, snapshot_id, scanned_at, unnest(fields) as f from roboomni_partitions) where f.source_key is not null
    union all select 'dexcap_partitions', name, snapshot_id, scanned_at, f.path, regexp_replace(lower(coalesce(f.dtype, '')), '\s+', '', 'g'), coalesce(array_to_string(f.shape, ','), '') from (select name, snapshot_id, scanned_at, unnest(source_schema) as f from dexcap_partitions) where f.path is not null),
  u as (select distinct * from n where entity is not null), o as (select *, dense_rank() over (partition by t, entity order by tm, snapshot_id) as r from u),
  f as (select t as table_name, entity, r, snapshot_id, name as field, dtype, shape from o), sn as (select distinct table_name, entity, r, snapshot_id from f)
select f.table_name, f.entity, sn.snapshot_id, f.field, 'gone' as move from f join sn on sn.table_name = f.table_name and sn.entity = f.entity and sn.r = f.r + 1 where not exists (select 1 from f g where g.table_name = f.table_name and g.entity = f.entity and g.r = f.r + 1 and g.field = f.field)
union all select table_name, entity, f.snapshot_id, f.field, 'come' from f where r > 1 and not exists (select 1 from f g where g.table_name = f.table_name and g.entity = f.entity and g.r = f.r - 1 and g.field = f.field)
union all select f.table_name, f.entity, f.snapshot_id, f.field, 'retyped' from f join f g on g.table_name = f.table_name and g.entity = f.entity and g.r = f.r - 1 and g.field = f.field where f.dtype <> g.dtype or f.shape <> g.shape"""


@query
def p2_fields(spark: SparkSession, folder: str) -> DataFrame:
    """One consistent list of fields for each dataset and partition."""
    return union_fields(all_scans(spark, folder))


@query
def p2_files(spark: SparkSession, folder: str) -> DataFrame:
    """All files of partitions as one table, whatever their columns: rows of each file's kind, and how many columns each fills."""
    rows, _ = read_drifting(spark, folder, "*_partitions.parquet")
    kind = F.when(F.col("filename").isNotNull(), "dexcap").otherwise("roboomni")
    return rows.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("rows"), *(F.count(c).alias(c) for c in ("name", "components", "fields", "record_count", "release", "all_frame_count", "source_schema", "instruction", "scanned_at")))


SQL["p2_files"] = """select case when filename is not null then 'dexcap' else 'roboomni' end as kind, count(*) as rows, count(name) as name, count(components) as components, count(fields) as fields, count(record_count) as record_count, count(release) as release,
    count(all_frame_count) as all_frame_count, count(source_schema) as source_schema, count(instruction) as instruction, count(scanned_at) as scanned_at from (select * from roboomni_partitions union all by name select * from dexcap_partitions) group by all"""


@query
def p2_file_log(spark: SparkSession, folder: str) -> DataFrame:
    """How columns change from one of these files to the next."""
    return read_drifting(spark, folder, "*_partitions.parquet")[1].filter("change <> 'may_lose_digits'").select("field_name", "change")


def latest_episodes(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each episode: its latest delivery, and when it was first indexed.

    Of rows with the same time the one with the larger frames, task and deletion holds, so that ties have one outcome.
    """
    e = table(spark, folder, "episodes").filter("dataset_uid is not null and episode_index is not null")
    row = F.struct("frames", "task_index", "deleted_at")
    out = e.groupBy("dataset_uid", "episode_index").agg(F.max_by(row, F.struct("indexed_at", "frames", "task_index", "deleted_at")).alias("r"), F.min("indexed_at").alias("first_indexed"))
    return out.select("dataset_uid", "episode_index", "r.*", "first_indexed")


@query
def p4_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Episodes, total and median frames of each dataset."""
    return dense_totals(latest_episodes(spark, folder), "dataset_uid", "frames").select("dataset_uid", F.col("rows").alias("episodes"), F.col("total").alias("total_frames"), F.col("median").alias("median_frames"))


LATEST = """select * from (select *, min(indexed_at) over (partition by dataset_uid, episode_index) as first_indexed,
    row_number() over (partition by dataset_uid, episode_index order by indexed_at desc nulls last, frames desc nulls last, task_index desc nulls last, deleted_at desc nulls last) as n
    from episodes where dataset_uid is not null and episode_index is not null) where n = 1"""
SQL["p4_totals"] = f"""select dataset_uid, count(*) as episodes, cast(sum(frames) as bigint) as total_frames, median(frames) as median_frames
    from ({LATEST}) group by dataset_uid"""


@query
def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """Datasets with more than 3 percent of all episodes."""
    totals = p4_totals(spark, folder)
    return totals.join(F.broadcast(totals.agg(F.sum("episodes").alias("every"))), F.col("episodes") > 0.03 * F.col("every")).select("dataset_uid")


SQL["p4_found"] = f"""with e as ({LATEST}) select dataset_uid from e group by dataset_uid having count(*) > 0.03 * (select count(*) from e)"""


@query
def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return periods_and_gaps(table(spark, folder, "annotations"), ["dataset_uid", "episode_index"], "frame_start", "frame_end")


SQL["p5_found"] = """with a as (select dataset_uid, episode_index, frame_start, frame_end,
        max(frame_end) over (partition by dataset_uid, episode_index order by frame_start, frame_end rows between unbounded preceding and 1 preceding) as before
    from annotations where frame_start <= frame_end),
  n as (select *, sum(case when before is null or frame_start > before + 1 then 1 else 0 end)
        over (partition by dataset_uid, episode_index order by frame_start, frame_end rows unbounded preceding) as island from a),
  p as (select dataset_uid, episode_index, island, min(frame_start) as frame_start, max(frame_end) as frame_end from n group by all),
  g as (select dataset_uid, episode_index, lag(frame_end) over (partition by dataset_uid, episode_index order by island) + 1 as frame_start, frame_start - 1 as frame_end from p)
select dataset_uid, episode_index, 'period' as kind, frame_start, frame_end from p
union all select dataset_uid, episode_index, 'gap', frame_start, frame_end from g where frame_start is not null"""


def orphans(spark: SparkSession, folder: str) -> DataFrame:
    # the month in UTC, whatever the session's zone
    month = lambda c: F.date_format(F.to_utc_timestamp(F.timestamp_seconds(F.col(c)), F.current_timezone()), "yyyy-MM")
    episodes = latest_episodes(spark, folder).withColumn("record_key", F.concat_ws("/", "dataset_uid", "episode_index")).withColumn("period", month("first_indexed"))
    episodes = cut(episodes.drop("frames"))  # read as a parent and as a child
    annotations = table(spark, folder, "annotations").select("annotation_id", "dataset_uid", "episode_index", "created_at", month("created_at").alias("period"))
    tables = {
        "datasets": Table(table(spark, folder, "datasets").filter("uid is not null").select("uid", F.lit("").alias("period")).distinct(), "uid", "period"),
        "tasks": Table(table(spark, folder, "tasks").select("dataset_uid", "task_index", F.concat_ws("/", "dataset_uid", "task_index").alias("record_key"), F.lit("").alias("period")).dropna().distinct(), "record_key", "period"),
        "episodes": Table(episodes, "record_key", "period"),
        "annotations": Table(annotations, "annotation_id", "period"),
    }
    there = F.col("parent__deleted_at").isNull() & ~F.coalesce(F.col("parent__first_indexed") > F.col("created_at"), F.lit(False))
    references = [
        Reference("annotations", "dataset_uid", ("dataset_uid",), "datasets", ("uid",)),
        Reference("annotations", "episode_index", ("dataset_uid", "episode_index"), "episodes", ("dataset_uid", "episode_index"), carry=("deleted_at", "first_indexed"), holds=there, unless="dataset_uid"),
        Reference("episodes", "task_index", ("dataset_uid", "task_index"), "tasks", ("dataset_uid", "task_index")),
    ]
    return find_orphans(tables, references)


@query
def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return orphans(spark, folder).filter("kind = 'direct'").select("table_name", "record_key", "field_name")


SQL["p6_found"] = f"""with e as ({LATEST}), a as (select distinct annotation_id, dataset_uid, episode_index, created_at from annotations where annotation_id is not null)
select distinct 'annotations' as table_name, annotation_id as record_key, 'dataset_uid' as field_name from a
    where dataset_uid is not null and dataset_uid not in (select uid from datasets where uid is not null)
union all select distinct 'annotations', a.annotation_id, 'episode_index' from a left join e using (dataset_uid, episode_index)
    where a.dataset_uid in (select uid from datasets) and a.episode_index is not null and (e.first_indexed is null or e.deleted_at is not null or e.first_indexed > a.created_at)
union all select 'episodes', concat(dataset_uid, '/', episode_index), 'task_index' from e
    where task_index is not null and not exists (select 1 from tasks t where t.dataset_uid = e.dataset_uid and t.task_index = e.task_index)"""


@query
def p6_report(spark: SparkSession, folder: str) -> DataFrame:
    """Direct and inherited orphans of each table, field and month."""
    return orphans(spark, folder).groupBy("table_name", "field_name", "period").agg(F.count_if(F.col("kind") == "direct").alias("direct"), F.count_if(F.col("kind") == "inherited").alias("inherited"))


SQL["p6_report"] = f"""with e as ({LATEST}), d as ({SQL["p6_found"]}),
  m as (select 'annotations' as table_name, annotation_id as record_key, min(strftime(make_timestamp(cast(created_at * 1000000 as bigint)), '%Y-%m')) as period from annotations group by all
    union all select 'episodes', concat(dataset_uid, '/', episode_index), strftime(make_timestamp(cast(first_indexed * 1000000 as bigint)), '%Y-%m') from e),
  i as (select distinct 'annotations' as table_name, annotation_id as record_key, 'episode_index' as field_name from annotations a
    where concat(dataset_uid, '/', episode_index) in (select record_key from d where table_name = 'episodes')
      and not exists (select 1 from d where d.table_name = 'annotations' and d.record_key = a.annotation_id and d.field_name = 'episode_index')),
  x as (select *, 1 as direct from d union all select *, 0 from i)
select table_name, field_name, period, cast(sum(direct) as bigint) as direct, cast(sum(1 - direct) as bigint) as inherited from x join m using (table_name, record_key) group by all"""
