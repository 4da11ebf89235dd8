"""Queries of the problems on texts, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trajlake.llm.copies import collapse_copies
from trajlake.llm.leaks import find_leaks
from trajlake.llm.mix import mix_sources
from trajlake.llm.subjects import fit_subjects, score_subjects, tokens

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def all_copies(spark: SparkSession, folder: str) -> DataFrame:
    r, e = table(spark, folder, "roboomni_records"), table(spark, folder, "episodes")
    of_records = collapse_copies(r, F.col("record_id"), [F.col("component")], F.col("instruction"), F.col("context"), F.col("component"))
    of_episodes = collapse_copies(e, F.col("episode_index"), [F.col("dataset_uid"), F.col("frames"), F.col("task_index")], F.col("instruction"), F.col("metadata_json"), F.col("dataset_uid"))
    return of_records.select(F.lit("roboomni_records").alias("table_name"), "*").unionByName(of_episodes.select(F.lit("episodes").alias("table_name"), "*"))


@query
def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """The copies of a kept record; the kept one is not a copy of itself."""
    return all_copies(spark, folder).filter("copies > 1 and record_id <> keep_id").select("table_name", "group_key", "keep_id", F.col("record_id").alias("copy_id"))


_FORM = """case when json_valid({0}) then (select string_agg(fullkey || '=' || type || '=' || coalesce(cast(atom as varchar), ''), '|' order by fullkey) from json_tree(case when json_valid({0}) then {0} end))
    else trim({0}) end"""
_COPIES = rf"""with r as (select 'roboomni_records' as table_name, component as group_key, record_id as id, '' as more,
        array_to_string(regexp_extract_all(replace(lower(instruction), 'ß', 'ss'), '[\p{{L}}\p{{N}}]+'), ' ') as w, {_FORM.format("context")} as form from roboomni_records),
  e as (select 'episodes' as table_name, dataset_uid as group_key, episode_index as id, concat(frames, '/', coalesce(cast(task_index as varchar), '-')) as more,
        array_to_string(regexp_extract_all(replace(lower(instruction), 'ß', 'ss'), '[\p{{L}}\p{{N}}]+'), ' ') as w, {_FORM.format("metadata_json")} as form from episodes),
  a as (select distinct * from (from r union all from e) where w <> ''),
  k as (select *, min(id) over g as keep_id from a window g as (partition by table_name, group_key, more, w, coalesce(form, chr(1))))"""
SQL["p3_found"] = f"{_COPIES} select table_name, group_key, keep_id, id as copy_id from k where id <> keep_id"


_EVERY = _COPIES.split(",\n  a as")[0]
SQL["p3_kept"] = f"""{_EVERY}, a as (select distinct table_name, group_key, id, more, coalesce(w, '') as w, coalesce(form, chr(1)) as form from (from r union all from e))
select table_name, group_key, min(id) as keep_id, count(*) as copies from a group by table_name, group_key, more, w, form, case when w = '' then id end"""


@query
def p3_kept(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each record that is kept, with the number of its copies."""
    return all_copies(spark, folder).filter("record_id = keep_id").select("table_name", "group_key", "keep_id", "copies")


@query
def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return find_leaks(table(spark, folder, "documents"), table(spark, folder, "eval_items")).filter("edits = 0").select("doc_id", "item_id")


SQL["p7_found"] = r"""with w as (select doc_id, regexp_extract_all(replace(lower(text), 'ß', 'ss'), '[\p{L}\p{N}]+') as w from documents),
  v as (select item_id, regexp_extract_all(replace(lower(text), 'ß', 'ss'), '[\p{L}\p{N}]+') as w from eval_items),
  d as (select doc_id, array_to_string(w[i:i+11], ' ') as g from (select doc_id, w, unnest(range(1, len(w) - 10)) as i from w)),
  e as (select distinct item_id, array_to_string(w[i:i+11], ' ') as g from (select item_id, w, unnest(range(1, len(w) - 10)) as i from v))
select distinct doc_id, item_id from d join e using (g)"""


@query
def p7_near(spark: SparkSession, folder: str) -> DataFrame:
    """Also passages with one word changed, added or lost."""
    return find_leaks(table(spark, folder, "documents"), table(spark, folder, "eval_items"))


@query
def p7_near_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Documents and items of the same, with the edits of the nearest passage."""
    return p7_near(spark, folder).select("doc_id", "item_id", "edits")


# a word changed: equal but for one place; a word lost: eleven words are left; a word added: thirteen without one
SQL["p7_near_pairs"] = r"""with w as (select doc_id, regexp_extract_all(replace(lower(text), 'ß', 'ss'), '[\p{L}\p{N}]+') as w from documents),
  v as (select item_id, regexp_extract_all(replace(lower(text), 'ß', 'ss'), '[\p{L}\p{N}]+') as w from eval_items),
  d as (select distinct doc_id, w[i:i+11] as g from (select doc_id, w, unnest(range(1, len(w) - 10)) as i from w)),
  l as (select distinct doc_id, w[i:i+10] as g from (select doc_id, w, unnest(range(1, len(w) - 9)) as i from w)),
  m as (select distinct doc_id, w[i:i+12] as g from (select doc_id, w, unnest(range(1, len(w) - 11)) as i from w)),
  e as (select distinct item_id, w[i:i+11] as g from (select item_id, w, unnest(range(1, len(w) - 10)) as i from v)),
  k as (select unnest(range(1, 14)) as k),
  x as (select doc_id, item_id, 0 as edits from d join e using (g)
    union all select doc_id, item_id, 1 from (select doc_id, k, list_concat(g[1:k-1], ['*'], g[k+1:12]) as h from d, k where k <= 12) join (select item_id, k, list_concat(g[1:k-1], ['*'], g[k+1:12]) as h from e, k where k <= 12) using (k, h)
    union all select doc_id, item_id, 1 from l join (select item_id, list_concat(g[1:k-1], g[k+1:12]) as g from e, k where k <= 12) using (g)
    union all select doc_id, item_id, 1 from (select doc_id, list_concat(g[1:k-1], g[k+1:13]) as g from m, k) join e using (g))
select doc_id, item_id, cast(min(edits) as int) as edits from x group by all"""


@query
def p7_items(spark: SparkSession, folder: str) -> DataFrame:
    """Which items leaked, and into how many documents."""
    return p7_found(spark, folder).groupBy("item_id").agg(F.count(F.lit(1)).alias("documents"))


SQL["p7_items"] = f"select item_id, count(*) as documents from ({SQL['p7_found']}) group by item_id"


@query
def p8_mix(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of the mix and how often each is taken."""
    return mix_sources(table(spark, folder, "documents"), table(spark, folder, "mix_targets"))[0]


@query
def p8_shares(spark: SparkSession, folder: str) -> DataFrame:
    """Shares asked for and reached."""
    return mix_sources(table(spark, folder, "documents"), table(spark, folder, "mix_targets"))[1]


#: Part of a document's sentences with a subject from which it is about that subject.
QUARTER = 0.25


def document_subjects(spark: SparkSession, folder: str) -> DataFrame:
    words = tokens(table(spark, folder, "documents"), "doc_id", "text")
    return score_subjects(words, fit_subjects(words, table(spark, folder, "subject_examples")))


@query
def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return document_subjects(spark, folder).filter(F.col("share") >= QUARTER).select("doc_id", "subject")


@query
def p9_composition(spark: SparkSession, folder: str) -> DataFrame:
    """Documents and sentences of the corpus by subject."""
    return document_subjects(spark, folder).groupBy("subject").agg(F.count_if(F.col("share") >= QUARTER).alias("documents"), F.sum("sentences").alias("sentences"))
