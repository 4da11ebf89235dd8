"""Filling and refreshing the index: artefacts of stages to rows, what changed since, previews of episodes."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajlake.operators.runs import merge_ranges
from trajlake.plans import catalog

KEYS = ["dataset_uid", "episode_index"]
RANGES = "array<struct<frame_start:bigint,frame_end:bigint,reason_code:string>>"


def label_rows(summary: DataFrame, flags: DataFrame, stage: int, reason: str) -> DataFrame:
    """Rows of a stage from its label tables: verdict, anomaly count, severity, score and ranges of flagged frames.

    summary: keys, num_frames, flagged_frames, reject_episode; flags: keys and frame_index.
    """
    r = merge_ranges(flags, KEYS).groupBy(*KEYS).agg(F.array_sort(F.collect_list(F.struct("frame_start", "frame_end", F.lit(reason).alias("reason_code")))).alias("ranges"))
    s = summary.join(r, KEYS, "left")
    verdict = catalog.stage_verdict(F.lit(stage), F.coalesce("reject_episode", F.lit(False)), F.col("flagged_frames"), F.col("num_frames"))
    return s.select(*KEYS, F.lit(stage).alias("stage_id"), verdict.alias("verdict"), F.col("flagged_frames").alias("anomaly_count"), catalog.stage_severity(F.lit(stage), verdict).alias("severity"), F.try_divide("flagged_frames", "num_frames").alias("score"), F.coalesce("ranges", F.array().cast(RANGES)).alias("ranges"))


def payload_rows(payloads: DataFrame) -> DataFrame:
    """Rows of stages 6 to 8 from JSON (keys, stage_id, payload_json); unreadable JSON has the verdict `unreadable`.

    Stage 6: status, and how many uncertainties; stage 7: decision, median overlap, failed frames; stage 8: disposition
    and invalid ranges, whose ends are exclusive in the payload and inclusive here.
    """
    v = payloads.withColumn("v", F.try_parse_json("payload_json"))
    get = lambda path, kind: F.try_variant_get("v", path, kind)
    stage = F.col("stage_id")
    verdict = F.when(F.col("v").isNull(), "unreadable").when(stage == 6, get("$.status", "string")).when(stage == 7, get("$.decision", "string")).when(stage == 8, get("$.disposition", "string"))
    failed = F.coalesce(get("$.failed_frames", "array<bigint>"), F.array().cast("array<bigint>"))
    spans = F.coalesce(get("$.invalid_ranges", "array<struct<start:bigint,end:bigint,reason:string>>"), F.array().cast("array<struct<start:bigint,end:bigint,reason:string>>"))
    of_frames = F.transform(F.array_sort(failed), lambda f: F.struct(f.alias("frame_start"), f.alias("frame_end"), F.lit("failed_frame").alias("reason_code")))
    of_spans = F.transform(F.filter(spans, lambda s: s["end"] > s["start"]), lambda s: F.struct(s["start"].alias("frame_start"), (s["end"] - 1).alias("frame_end"), s["reason"].alias("reason_code")))
    count = F.when(stage == 6, F.coalesce(F.size(get("$.quality.uncertainties", "array<variant>")), F.lit(0))).when(stage == 7, F.size(failed)).otherwise(F.size(spans))
    severity = F.when((stage == 8) & (verdict == "exclude_episode_from_training"), "critical").when(count > 0, "warning")
    ranges = F.when(stage == 7, of_frames.cast(RANGES)).when(stage == 8, of_spans.cast(RANGES)).otherwise(F.array().cast(RANGES))
    return v.select(*KEYS, "stage_id", F.coalesce(verdict, F.lit("unknown")).alias("verdict"), F.greatest(count, F.lit(0)).cast("bigint").alias("anomaly_count"), severity.alias("severity"), F.when(stage == 7, get("$.median_iou", "double")).alias("score"), ranges.alias("ranges"))


def source_changes(found: DataFrame, known: DataFrame, keys: Sequence[str], sign: Sequence[str]) -> DataFrame:
    """Sources that are new, changed (another sign), unchanged or gone."""
    a = found.select(*keys, F.struct(*sign).alias("__a"))
    b = known.select(*keys, F.struct(*sign).alias("__b"))
    state = F.when(F.col("__b").isNull(), "new").when(F.col("__a").isNull(), "gone").when(F.col("__a").eqNullSafe(F.col("__b")), "unchanged").otherwise("changed")
    return a.join(b, [*keys], "full").select(*keys, state.alias("state"))


def refresh(old: DataFrame, new: DataFrame, changes: DataFrame, source: str) -> DataFrame:
    """The index after a scan: rows of unchanged sources, rows of new and changed ones read anew, none of gone ones."""
    keep = changes.filter("state = 'unchanged'").select(source)
    read = changes.filter("state in ('new', 'changed')").select(source)
    return old.join(keep, source, "left_semi").unionByName(new.join(read, source, "left_semi"))


def refresh_decision(manifest: dict | None, known: dict | None, root: str | None = None) -> str:
    """What a stage's index needs: nothing, its changed shards, all of it, or its single files.

    Shards are trusted if the manifest has a generation, the stage and the layout's version that are known, and if the
    manifest that it was made from, where it names one (path below `root` and fingerprint), is still the same.
    """
    if manifest is None:
        return "files"
    if manifest.get("schema_version") != 1 or "generation" not in manifest or any({"path", "fingerprint", "rows"} - s.keys() for s in manifest.get("shards", [])):
        raise ValueError("the snapshot's manifest is not valid")
    source = manifest.get("source_manifest")
    if source is not None and root is not None:
        from trajlake.sources.datasets import inside

        at = inside(root, source["path"])
        if not at.is_file() or hashlib.sha256(at.read_bytes()).hexdigest() != source["fingerprint"]:
            return "files"
    if known is None or known.get("stage_id") != manifest.get("stage_id"):
        return "all"
    return "nothing" if known.get("generation") == manifest["generation"] else "shards"


def without_placeholders(rows: DataFrame) -> DataFrame:
    """Stage rows that stand for artefacts, for a compact copy."""
    return rows.filter(catalog.is_real(F.col("artifact_status"), F.col("source_path")))


#: Characters of a root's hash that a colliding identifier may end in, and of the identifier that stay.
HASH_LENGTHS, LONGEST = (8, 12, 16, 32, 64), 180


def unique_uids(candidates: DataFrame, assigned: DataFrame | None = None) -> DataFrame:
    """(root, uid): the candidate; where several roots have it, or it is taken, the first root by name keeps a free one and
    the others end in a piece of their root's hash, as long as needed. Once given, an identifier stays.

    candidates: root, candidate; assigned: root, uid.
    """
    c = candidates.select("root", "candidate").dropDuplicates(["root"])
    if assigned is not None:
        c = c.join(assigned.select("root", F.col("uid").alias("__old")), "root", "left")
        taken = assigned.select(F.col("uid").alias("candidate"), F.lit(True).alias("__taken")).distinct()
        c = c.join(taken, "candidate", "left")
    else:
        c = c.withColumn("__old", F.lit(None).cast("string")).withColumn("__taken", F.lit(None).cast("boolean"))
    new = c.filter("__old is null")
    first = new.groupBy("candidate").agg(F.min("root").alias("__first"))
    new = new.join(first, "candidate").withColumn("__free", F.col("__taken").isNull() & (F.col("root") == F.col("__first")))
    base = F.coalesce(F.nullif(F.regexp_replace(F.substring("candidate", 1, LONGEST), r"[-._]+$", ""), F.lit("")), F.lit("dataset"))
    ends = F.array(*(F.concat(base, F.lit("--"), F.substring(F.sha2("root", 256), 1, n)) for n in HASH_LENGTHS))
    new = new.withColumn("__ends", F.when(~F.col("__free"), ends))
    # an end is good if no other root wants it and none has it
    wanted = new.select("root", F.posexplode("__ends").alias("__n", "uid"))
    once = wanted.groupBy("uid").agg(F.count(F.lit(1)).alias("__c"))
    fine = wanted.join(once.filter("__c = 1").select("uid"), "uid", "left_semi")
    if assigned is not None:
        fine = fine.join(assigned.select("uid").distinct(), "uid", "left_anti")
    short = fine.groupBy("root").agg(F.min_by("uid", "__n").alias("__short"))
    uid = F.when(F.col("__free"), F.col("candidate")).otherwise(F.col("__short"))
    return c.filter("__old is not null").select("root", F.col("__old").alias("uid")).unionByName(new.join(short, "root", "left").select("root", uid.alias("uid")))


def sample_places(total: Column, most: int = 5) -> Column:
    """Up to `most` evenly spread frame numbers, rounded half to even."""
    n = F.least(total, F.lit(most)).cast("int")
    place = lambda i: F.rint(i * (total - 1) / F.greatest(n - 1, F.lit(1))).cast("bigint")
    return F.when(n > 0, F.array_distinct(F.transform(F.sequence(F.lit(0), n - 1), place))).otherwise(F.array().cast("array<bigint>"))


def select_tasks(plan: DataFrame, tasks: Sequence[str], column: str = "task") -> DataFrame:
    """Episodes of the named tasks; a task that the plan lacks is an error."""
    have = {r[0] for r in plan.filter(F.col(column).isin(*tasks)).select(column).distinct().collect()}  # at most the named ones
    if missing := sorted(set(tasks) - have):
        raise ValueError(f"tasks that are not in the plan: {missing}")
    return plan.filter(F.col(column).isin(*tasks)) if tasks else plan


def drop_aliases(files: DataFrame) -> DataFrame:
    """Files without compressed copies of others (path, sha): x.gz next to x with equal content is an alias.

    Different content is an error. Adds `alias_of` for the dropped ones, null for the kept ones.
    """
    plain = files.select(F.concat("path", F.lit(".gz")).alias("path"), F.col("sha").alias("__sha"), F.col("path").alias("alias_of"))
    both = files.join(plain, "path", "left")
    if both.filter("alias_of is not null and not (sha <=> __sha)").limit(1).count():
        raise ValueError("a compressed file differs from the plain one of its name")
    return both.drop("__sha")


def previews(episodes: DataFrame, rows: DataFrame, timeline: DataFrame | None = None) -> DataFrame:
    """One nested row for each episode: what it is, its eight badges, its ranges' number, its cameras."""
    b = catalog.badges(episodes, rows).groupBy(*KEYS).agg(F.array_sort(F.collect_list(F.struct("stage_id", "badge"))).alias("stages"))
    n = rows.groupBy(*KEYS).agg(F.sum("anomaly_count").alias("anomalies")) if "anomaly_count" in rows.columns else rows.groupBy(*KEYS).agg(F.lit(None).cast("bigint").alias("anomalies"))
    out = episodes.join(b, KEYS).join(n, KEYS, "left")
    if timeline is not None:
        t = timeline.groupBy(*KEYS).agg(F.array_sort(F.collect_list(F.struct("camera", "path", "from_timestamp", "to_timestamp", "integrity"))).alias("videos"))
        out = out.join(t, KEYS, "left")
    return out


def stage_detail(rows: DataFrame, ranges: DataFrame, annotations: DataFrame, uid: str, episode: int, stage: int) -> DataFrame:
    """Everything about one stage of one episode: a point read of each table, as one nested row."""
    at = lambda d: d.filter((F.col("dataset_uid") == uid) & (F.col("episode_index") == episode) & (F.col("stage_id") == stage))
    every = lambda d, name: at(d).agg(F.collect_list(F.struct(*(c for c in d.columns if c not in (*KEYS, "stage_id")))).alias(name))
    return every(rows, "summary").crossJoin(every(ranges, "ranges")).crossJoin(every(annotations, "annotations"))  # three single rows
