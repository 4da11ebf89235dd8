"""The catalog: stage verdicts, inheritance, summaries, search, paging, upkeep."""

from __future__ import annotations

import base64
import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trajlake.functions.text import without_marks, word_array
from trajlake.plans.ranks import numbered

KEYS = ["dataset_uid", "episode_index"]
STAGES = tuple(range(1, 9))
# Verdicts that reject an episode for all later stages.
REJECTING = ("filtered", "fail", "not_candidate", "upstream_filtered")


def stage_verdict(stage: Column, rejected: Column, flagged: Column, scored: Column) -> Column:
    """Stages 1 and 3: filtered, anomaly or pass; stage 2: fail, unscored or pass; others: fail, anomaly or pass."""
    two = F.when(rejected, "fail").when(scored == 0, "unscored").otherwise("pass")
    return F.when(stage.isin(1, 3), F.when(rejected, "filtered").when(flagged > 0, "anomaly").otherwise("pass")).when(stage == 2, two).otherwise(F.when(rejected, "fail").when(flagged > 0, "anomaly").otherwise("pass"))


def stage_severity(stage: Column, verdict: Column) -> Column:
    return F.when(verdict.isin("filtered", "fail"), "critical").when(verdict.isin("anomaly", "unscored"), "warning")


def is_real(status: Column, source: Column) -> Column:
    """Whether a stage row stands for an artefact and is no placeholder."""
    return ~((status == "not_generated") & source.isNull())


def rejected_before(rows: DataFrame) -> DataFrame:
    """Add `inherits_any`: some earlier stage of the episode rejects it. One window instead of a join on inequality."""
    w = Window.partitionBy(*KEYS).orderBy("stage_id").rangeBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("inherits_any", F.coalesce(F.max(F.col("verdict").isin(*REJECTING)).over(w), F.lit(False)))


def badges(episodes: DataFrame, rows: DataFrame) -> DataFrame:
    """Stages 1 to 8 of each episode: what a missing one shows is upstream_filtered if the badge before it rejects.

    This is not the rule of `rejected_before`: a stage that passed in between ends the inheritance.
    """
    grid = episodes.select(*KEYS).withColumn("stage_id", F.explode(F.array(*(F.lit(s) for s in STAGES))))
    w = Window.partitionBy(*KEYS).orderBy("stage_id").rowsBetween(Window.unboundedPreceding, -1)
    out = grid.join(rows.select(*KEYS, "stage_id", "verdict"), [*KEYS, "stage_id"], "left")
    before = F.last(F.when(F.col("verdict").isNotNull(), F.col("verdict").isin(*REJECTING)), True).over(w)
    return out.select(*KEYS, "stage_id", F.coalesce("verdict", F.when(before, "upstream_filtered").otherwise("not_generated")).alias("badge"))


def fill_missing(grid: DataFrame) -> DataFrame:
    """Rows of stages that are not available become upstream_filtered where an earlier stage rejects."""
    return rejected_before(grid).withColumn("artifact_status", F.when((F.col("artifact_status") != "available") & F.col("inherits_any"), "upstream_filtered").otherwise(F.col("artifact_status")))


def dataset_summary(episodes: DataFrame) -> DataFrame:
    """Episodes, frames and distinct tasks of each dataset; a task without a name counts by its number."""
    task = F.coalesce("task_name", F.col("task_index").cast("string"))
    return episodes.groupBy("dataset_uid").agg(F.count(F.lit(1)).alias("episodes"), F.sum("frames").alias("frames"), F.count_distinct(task).alias("tasks"))


def stage_facets(episodes: DataFrame, rows: DataFrame) -> DataFrame:
    """Episodes by stage and verdict; those without a row are not_generated (or nothing, if there are more rows)."""
    n = rows.groupBy("stage_id", "verdict").agg(F.count(F.lit(1)).alias("episodes"))
    every = n.groupBy("stage_id").agg(F.sum("episodes").alias("__have"))
    total = episodes.agg(F.count(F.lit(1)).alias("__all"))
    stages = total.withColumn("stage_id", F.explode(F.array(*(F.lit(s) for s in STAGES))))
    rest = stages.join(every, "stage_id", "left").select("stage_id", F.lit("not_generated").alias("verdict"), F.greatest(F.lit(0), F.col("__all") - F.coalesce("__have", F.lit(0))).cast("bigint").alias("episodes"))
    return n.withColumn("stage_id", F.col("stage_id").cast("int")).unionByName(rest.filter("episodes > 0"))


def merge_counts(old: DataFrame, new: DataFrame, keys: Sequence[str], counts: Sequence[str]) -> DataFrame:
    """Accumulate: rows of equal keys add up."""
    return old.unionByName(new).groupBy(*keys).agg(*(F.sum(c).alias(c) for c in counts))


# --- search

@dataclass(frozen=True)
class StageFilter:
    """Episodes with a real row of a stage that has one of the verdicts or states, none of the excluded verdicts, and a score
    in range; or, where that is asked for, without one.

    A missing row is asked for by the verdict or state `upstream_filtered` (an earlier stage rejects) or `not_generated`
    (none does), and by a filter with neither verdicts, states nor scores, unless `not_generated` is excluded.
    """

    stage: int
    verdicts: Sequence[str] = ()
    exclude: Sequence[str] = ()
    low: float | None = None
    high: float | None = None
    states: Sequence[str] = ()


@dataclass(frozen=True)
class Search:
    text: str = ""
    datasets: Sequence[str] = ()
    collections: Sequence[str] = ()
    stages: Sequence[StageFilter] = field(default_factory=tuple)
    sort: str = "relevance"
    page: int = 1
    size: int = 30
    cursor: str | None = None


def text_filter(text: Column, query: str) -> Column:
    """Every blank-separated part of the query occurs as a phrase of whole words; an empty query holds always.

    Letter case and diacritical marks are ignored. A part without any letter or digit is looked for as it is.
    """
    plain = lambda x: F.concat(F.lit(" "), F.array_join(word_array(without_marks(x)), " "), F.lit(" "))
    out, have = F.lit(True), plain(text)
    for part in query.split():
        want = plain(F.lit(part))
        out = out & F.when(want == "  ", F.coalesce(F.contains(F.lower(text), F.lit(part.lower())), F.lit(False))).otherwise(F.contains(have, want))
    return out


def episode_query(instruction: Column, number: Column, query: str) -> Column:
    """A number, alone or after the word episode, is an episode's; other text is looked for in the instruction."""
    words = query.strip().lower().removeprefix("episode").strip()
    if words.isdigit():
        return number == int(words)
    return F.coalesce(F.contains(F.lower(instruction), F.lit(query.strip().lower())), F.lit(False))


def with_stages(episodes: DataFrame, rows: DataFrame, filters: Sequence[StageFilter]) -> DataFrame:
    """Episodes that all filters let through: one aggregation of the stage rows, one join."""
    if not filters:
        return episodes
    source = F.col("source_path") if "source_path" in rows.columns else F.lit("")
    real = rows.filter(is_real(F.col("artifact_status"), source))
    needs, found = [], F.lit(True)
    for n, f in enumerate(filters):
        own, hit = F.col("stage_id") == f.stage, F.lit(True)
        if f.verdicts or f.states:
            hit = hit & (F.col("verdict").isin(*f.verdicts, "") | F.col("artifact_status").isin(*f.states, ""))
        if f.exclude:
            hit = hit & ~F.col("verdict").isin(*f.exclude)
        if f.low is not None:
            hit = hit & (F.col("score") >= f.low)
        if f.high is not None:
            hit = hit & (F.col("score") <= f.high)
        some = lambda c, name: F.bool_or(F.coalesce(c, F.lit(False))).alias(name)
        needs += [some(own & hit, f"__hit{n}"), some(own, f"__has{n}"), some((F.col("stage_id") < f.stage) & F.col("verdict").isin(*REJECTING), f"__bad{n}")]
        asked = {*f.verdicts, *f.states}
        every = not asked and f.low is None and f.high is None
        has, bad = (F.coalesce(f"__{x}{n}", F.lit(False)) for x in ("has", "bad"))
        missing = F.lit(every) | (F.lit("upstream_filtered" in asked) & bad) | (F.lit("not_generated" in asked) & ~bad)
        found = found & (F.coalesce(f"__hit{n}", F.lit(False)) | (~has & missing & F.lit("not_generated" not in f.exclude)))
    by_episode = real.groupBy(*KEYS).agg(*needs)
    return episodes.join(by_episode, KEYS, "left").filter(found).select(*episodes.columns)


def missing_stage(episodes: DataFrame, rows: DataFrame, stage: int, upstream: bool | None = None) -> DataFrame:
    """Episodes without a row of a stage; of these those that an earlier stage rejects, or only the others."""
    out = episodes.join(rows.filter(F.col("stage_id") == stage).select(*KEYS).distinct(), KEYS, "left_anti")
    if upstream is None:
        return out
    bad = rows.filter((F.col("stage_id") < stage) & F.col("verdict").isin(*REJECTING)).select(*KEYS).distinct()
    return out.join(bad, KEYS, "left_semi" if upstream else "left_anti")


def relevance(query: str) -> Column:
    """0 for an instruction equal to the query, 1 for a task, 2 for a collection or dataset, 3 for the rest."""
    q = F.lit(query.strip().lower())
    return F.when(F.lower("instruction") == q, 0).when(F.lower("task_name") == q, 1).when((F.lower("collection") == q) | (F.lower("dataset_uid") == q), 2).otherwise(3)


#: Sorts: (column, falling).
SORTS = {
    "relevance": (("rank", False), ("collection", False), ("task_name", False), ("dataset_uid", False), ("episode_index", False)),
    "episode": (("collection", False), ("dataset_uid", False), ("episode_index", False)),
    "duration_asc": (("duration", False), ("dataset_uid", False), ("episode_index", False)),
    "duration_desc": (("duration", True), ("dataset_uid", False), ("episode_index", False)),
}


def order_by(sort: str) -> list[Column]:
    return [F.desc_nulls_last(c) if down else F.asc_nulls_first(c) for c, down in SORTS[sort]]


def after(sort: str, values: Sequence[object]) -> Column:
    """Rows behind a place in a sort with rising and falling columns: no row is skipped or shown twice where values tie."""
    out, same = F.lit(False), F.lit(True)
    for (c, down), v in zip(SORTS[sort], values):
        x = F.col(c)
        if v is None:
            further = F.lit(False) if down else x.isNotNull()
        else:
            further = F.coalesce(x < v, F.lit(True)) if down else F.coalesce(x > F.lit(v), F.lit(False))
        out = out | (same & further)
        same = same & x.eqNullSafe(F.lit(v))
    return out


def make_cursor(sort: str, row: Sequence[object]) -> str:
    return base64.urlsafe_b64encode(json.dumps([sort, *row]).encode()).decode()


def read_cursor(text: str | None, sort: str) -> list | None:
    """The place in a cursor; None if there is none, it is unreadable, or it belongs to another sort."""
    try:
        got = json.loads(base64.urlsafe_b64decode(text or ""))
    except ValueError:
        return None
    return got[1:] if isinstance(got, list) and got and got[0] == sort and len(got) == len(SORTS[sort]) + 1 else None


def matching(episodes: DataFrame, rows: DataFrame, s: Search) -> DataFrame:
    """All episodes that a search finds, with `rank`."""
    out = episodes
    if s.datasets or s.collections:
        out = out.filter(F.col("dataset_uid").isin(*s.datasets, "") | F.col("collection").isin(*s.collections, ""))
    if s.text.strip():
        out = out.filter(text_filter(F.col("normalized_text"), s.text))
    return with_stages(out, rows, s.stages).withColumn("rank", relevance(s.text) if s.text.strip() else F.lit(0))


def search_page(episodes: DataFrame, rows: DataFrame, s: Search) -> tuple[DataFrame, str | None]:
    """(a page of 1 to 30 episodes, cursor of the next one or None)."""
    size, place = max(1, min(s.size, 30)), read_cursor(s.cursor, s.sort)
    found = matching(episodes, rows, s)
    if place is not None:
        found = found.filter(after(s.sort, place))
    elif s.page > 1:
        found = found.orderBy(*order_by(s.sort)).offset((s.page - 1) * size)
    page = found.orderBy(*order_by(s.sort)).limit(size + 1)
    cols = [c for c, _ in SORTS[s.sort]]
    heads = page.select(*cols).collect()
    cursor = make_cursor(s.sort, list(heads[size - 1])) if len(heads) > size else None
    return page.limit(size), cursor


def totals(found: DataFrame) -> DataFrame:
    """One row about all that a search finds: episodes, collections, and tasks by name, else by number, within their collection."""
    task = F.concat(F.col("collection"), F.lit(":"), F.coalesce("task_name", F.col("task_index").cast("string"), F.lit("-1")))
    return found.agg(F.count(F.lit(1)).alias("total"), F.count_distinct("collection").alias("datasets"), F.count_distinct(task).alias("tasks"))


def match_reasons(query: str) -> Column:
    """Which fields of an episode hold the whole query as it is, without letter case."""
    q = F.lit(query.strip().lower())
    fields = {"collection": F.col("collection"), "dataset": F.col("dataset_uid"), "task": F.col("task_name"), "instruction": F.col("instruction"), "episode": F.concat(F.lit("episode "), F.col("episode_index").cast("string"))}
    hits = [F.when(F.coalesce(F.contains(F.lower(c), q), F.lit(False)), n) for n, c in fields.items()] if query.strip() else []
    return F.array_compact(F.array(*hits).cast("array<string>"))


def title(collection: Column, instruction: Column, task: Column, episode: Column) -> Column:
    name = F.coalesce(F.nullif(instruction, F.lit("")), F.nullif(task, F.lit("")), F.format_string("Episode %04d", episode))
    return F.concat(F.lit("\u3010"), collection, F.lit("\u3011"), name)


def decorated(page: DataFrame, rows: DataFrame, query: str = "", ranges: DataFrame | None = None) -> DataFrame:
    """A page's episodes with title, match_reasons and the badges of stages 1 to 8 (status, verdict, score, range_count).

    ranges: rows (keys, stage_id) of anomaly ranges, of which the page's are counted.
    """
    source = F.col("source_path") if "source_path" in rows.columns else F.lit("")
    real = rows.filter(is_real(F.col("artifact_status"), source)).join(page.select(*KEYS), KEYS, "left_semi")
    marks = badges(page, real).join(real.select(*KEYS, "stage_id", "artifact_status", "score"), [*KEYS, "stage_id"], "left")
    count = F.lit(0).cast("bigint")
    if ranges is not None:
        n = ranges.join(page.select(*KEYS), KEYS, "left_semi").groupBy(*KEYS, "stage_id").agg(F.count(F.lit(1)).alias("range_count"))
        marks, count = marks.join(n, [*KEYS, "stage_id"], "left"), F.coalesce("range_count", F.lit(0))
    badge = F.struct("stage_id", F.coalesce("artifact_status", "badge").alias("status"), F.col("badge").alias("verdict"), "score", count.alias("range_count"))
    nested = marks.groupBy(*KEYS).agg(F.array_sort(F.collect_list(badge)).alias("stage_badges"))
    named = page.withColumn("title", title(F.col("collection"), F.col("instruction"), F.col("task_name"), F.col("episode_index"))).withColumn("match_reasons", match_reasons(query))
    return named.join(nested, KEYS, "left")


def search(episodes: DataFrame, rows: DataFrame, s: Search, ranges: DataFrame | None = None) -> dict:
    """A search as one call: items (a page, decorated, in no order of its own: sort by `order_by`), total, datasets, tasks, next_cursor."""
    page, cursor = search_page(episodes, rows, s)
    return totals(matching(episodes, rows, s)).first().asDict() | {"items": decorated(page, rows, s.text, ranges), "next_cursor": cursor}


def episodes_page(episodes: DataFrame, datasets: DataFrame, uid: str, after_index: int = -1, size: int = 100) -> tuple[DataFrame, int | None]:
    """(a page of 1 to 500 episodes of a dataset by rising number, the number to go on after or None).

    A dataset without listed episodes shows as many placeholders as its catalog row promises.
    """
    size = max(1, min(size, 500))
    own = episodes.filter(F.col("dataset_uid") == uid).select("dataset_uid", "episode_index", "instruction", F.lit(False).alias("placeholder"))
    if own.limit(1).count() == 0:
        promised = datasets.filter(F.col("dataset_uid") == uid).agg(F.max("episodes")).first()[0] or 0
        own = episodes.sparkSession.range(promised).select(F.lit(uid).alias("dataset_uid"), F.col("id").alias("episode_index"), F.lit(None).cast("string").alias("instruction"), F.lit(True).alias("placeholder"))
    page = own.filter(F.col("episode_index") > after_index).orderBy("episode_index").limit(size + 1)
    numbers = [r[0] for r in page.select("episode_index").collect()]
    return page.limit(size), (numbers[size - 1] if len(numbers) > size else None)


def list_datasets(datasets: DataFrame, text: str = "", version: str | None = None) -> DataFrame:
    """Datasets whose identifier holds a text, in whatever letter case, of one version."""
    out = datasets.filter(F.contains(F.lower("uid"), F.lit(text.lower())))
    return out if version is None else out.filter(F.col("codebase_version") == version)


def list_videos(timeline: DataFrame, integrity: str | None = None) -> DataFrame:
    """Videos of one state, or all, by path."""
    return (timeline if integrity is None else timeline.filter(F.col("integrity") == integrity)).orderBy("path", *KEYS)


def unmatched_selectors(selectors: DataFrame, datasets: DataFrame) -> DataFrame:
    """Selectors that name no dataset and no collection."""
    names = datasets.select(F.col("dataset_uid").alias("selector")).unionByName(datasets.select(F.col("collection").alias("selector"))).distinct()
    return selectors.join(names, "selector", "left_anti")


# --- upkeep

def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Old rows without those that new ones replace, and the new ones."""
    return old.join(new.select(*keys).distinct(), [*keys], "left_anti").unionByName(new)


def tombstones(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that are gone."""
    return old.select(*keys).distinct().join(new.select(*keys).distinct(), [*keys], "left_anti")


def shard_fingerprints(payloads: DataFrame, size: int, keys: Sequence[str] = ()) -> DataFrame:
    """(shard, rows, least and largest episode, SHA-256 of its payloads in the order of episodes) for shards of `size` episodes."""
    shard = F.floor(F.col("episode_index") / size).cast("bigint")
    lines = F.array_sort(F.collect_list(F.struct("episode_index", "payload_json")))
    return payloads.groupBy(*keys, shard.alias("shard")).agg(F.count(F.lit(1)).alias("rows"), F.min("episode_index").alias("min_episode"), F.max("episode_index").alias("max_episode"), lines.alias("__l")).withColumn("fingerprint", F.sha2(F.array_join(F.transform("__l", lambda x: x["payload_json"]), "\n"), 256)).drop("__l")


def changed_shards(old: DataFrame, new: DataFrame) -> DataFrame:
    """Shards to write (`upsert`) and to remove."""
    both = old.select("shard", F.col("fingerprint").alias("__old")).join(new.select("shard", F.col("fingerprint").alias("__new")), "shard", "full")
    return both.filter(~F.col("__old").eqNullSafe(F.col("__new"))).select("shard", F.when(F.col("__new").isNull(), "remove").otherwise("upsert").alias("change"))


def merge_duplicate_roots(datasets: DataFrame) -> DataFrame:
    """(uid, kept uid) of datasets that lie at one root: the latest scan is kept, of equal ones the first name."""
    w = Window.partitionBy("root").orderBy(F.desc("scanned_at"), "uid").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return datasets.select("uid", F.first("uid").over(w).alias("kept_uid")).distinct()


def rekey(rows: DataFrame, mapping: DataFrame, uid: str = "dataset_uid") -> DataFrame:
    """Rows under the new keys of a mapping (uid, kept_uid); others stay."""
    m = mapping.select(F.col("uid").alias(uid), "kept_uid")
    return rows.join(m, uid, "left").withColumn(uid, F.coalesce("kept_uid", uid)).drop("kept_uid")


def least_recent(files: DataFrame, bytes_kept: int) -> DataFrame:
    """Files to delete, oldest first, so that the newest ones of at most `bytes_kept` remain."""
    upto = numbered(files, [F.desc("mtime"), "path"], "__n", sums={"__before": "size"})
    return upto.filter(F.col("__before") + F.col("size") > bytes_kept).drop("__n", "__before")


def latest_manifest(manifests: DataFrame) -> DataFrame:
    """Of each dataset the manifest of the highest stage, a filter before an overlay, then the newest."""
    return manifests.groupBy("dataset_uid").agg(F.max_by("path", F.struct("stage", (F.col("format") == "filter").cast("int").alias("f"), "mtime")).alias("path"))


def key_differences(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    """Keys that only one side has (missing, extra) or whose values differ (changed)."""
    x = a.select(key, F.col(value).alias("__a"), F.lit(True).alias("__ina")).join(b.select(key, F.col(value).alias("__b"), F.lit(True).alias("__inb")), key, "full")
    state = F.when(F.col("__inb").isNull(), "missing").when(F.col("__ina").isNull(), "extra").when(~F.col("__a").eqNullSafe(F.col("__b")), "changed")
    return x.select(key, state.alias("difference")).filter("difference is not null")


def table_differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of either table that the other lacks, as often as it lacks them; schemas must be equal."""
    if [(f.name, f.dataType) for f in a.schema] != [(f.name, f.dataType) for f in b.schema]:
        raise ValueError("schemas differ")
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))


def equivalent(a: DataFrame, b: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """For each column whether all rows of equal keys agree (null equals null), and how many rows one side lacks."""
    x = a.select(*keys, F.struct(*columns).alias("__a")).join(b.select(*keys, F.struct(*columns).alias("__b")), [*keys], "full")
    lacks = F.col("__a").isNull() | F.col("__b").isNull()
    return x.agg(F.count_if(lacks).alias("unpaired"), *(F.count_if(~lacks & ~F.col(f"__a.{c}").eqNullSafe(F.col(f"__b.{c}"))).alias(c) for c in columns))


def outcome_counts(log: DataFrame, unverified: Sequence[str] = ()) -> DataFrame:
    """Rejected episodes by stage, and episodes by stage and reason, those of checks that never ran marked."""
    rejected = log.filter("rejected").groupBy("stage").agg(F.count(F.lit(1)).alias("episodes")).select("stage", F.lit(None).cast("string").alias("reason"), "episodes", F.lit(False).alias("unverified"))
    reasons = log.filter("reason is not null").groupBy("stage", "reason").agg(F.count(F.lit(1)).alias("episodes")).select("stage", "reason", "episodes", F.col("reason").isin(*unverified, "").alias("unverified"))
    return rejected.unionByName(reasons)


def add_annotation(annotations: DataFrame, rows: DataFrame) -> DataFrame:
    """Annotations with new rows; columns that they lack are null."""
    return annotations.unionByName(rows, allowMissingColumns=True)


def list_annotations(annotations: DataFrame, uid: str, episode: int | None = None) -> DataFrame:
    """The last state of a dataset's or an episode's annotations, in the order of their making."""
    own = annotations.filter(F.col("dataset_uid") == uid)
    own = own if episode is None else own.filter(F.col("episode_index") == episode)
    return latest_reviews(own).orderBy("created_at", "annotation_id")


def review(annotations: DataFrame, annotation_id: str, status: str, reviewer: str, at: float) -> DataFrame:
    """Annotations with a row more: the named one under its review. The old row stays."""
    old = latest_reviews(annotations.filter(F.col("annotation_id") == annotation_id))
    new = old.withColumns({"review_status": F.lit(status), "reviewer": F.lit(reviewer), "created_at": F.lit(float(at))})
    return annotations.unionByName(new)


def latest_reviews(annotations: DataFrame) -> DataFrame:
    """One row for each annotation: the one with the last review (accepted or rejected before pending), else the last written."""
    done = (F.col("review_status") != "pending").cast("int")
    row = F.struct(*annotations.columns)
    return annotations.groupBy("annotation_id").agg(F.max_by(row, F.struct(done.alias("d"), "created_at", "review_status", F.coalesce("reviewer", F.lit("")), F.xxhash64(*annotations.columns).alias("h"))).alias("r")).select("r.*")


def video_timeline(episodes: DataFrame, files: DataFrame) -> DataFrame:
    """Each episode's window in its cameras' files with the file's state: pass, missing or duration_mismatch.

    episodes: keys, cameras (array of camera, path, from_timestamp, to_timestamp), frames and fps.
    """
    e = episodes.select(*KEYS, "frames", "fps", F.explode("cameras").alias("c")).select(*KEYS, "frames", "fps", "c.*")
    out = e.join(files.select("path", F.col("duration").alias("file_duration"), F.lit(True).alias("__in")), "path", "left")
    gap = F.abs((F.col("to_timestamp") - F.col("from_timestamp")) - F.col("frames") / F.col("fps"))
    state = F.when(F.col("__in").isNull(), "missing").when(gap > F.greatest(1 / F.col("fps"), F.lit(1e-6)), "duration_mismatch").otherwise("pass")
    return out.withColumn("integrity", state).drop("__in")
