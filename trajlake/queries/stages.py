"""Queries of the stages: smoothing, sudden changes, trends, the older alignment, joints matched by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trajlake.functions.smoothing import polynomial_weights
from trajlake.operators import signals, trend
from trajlake.plans import curation
from trajlake.queries.registry import KEYS, ORDER, PLACES, Registry, frame_rows, table
from trajlake.queries.signals import FEATURES, W, with_validity

R = Registry()
QUERIES, SQL = R.queries, R.sql


# --- joints by name

_NAMES = r"""jn as (select uid, je.key as k, je.value as spec from (select * from datasets where json_valid(schema_json) and json_type(schema_json) = 'OBJECT' qualify row_number() over (partition by uid order by scanned_at desc, snapshot_id desc) = 1) d, json_each(d.schema_json) je),
  js as (select uid, json_extract_string(spec, '$.names[*]') as names, k from jn where k in ('observation.state', 'action') and json_type(spec, '$.names') = 'ARRAY'),
  ju as (select uid, k, unnest(names) as name, cast(unnest(range(len(names))) as int) as dimension from js),
  jj as (select uid, k, dimension, name, regexp_replace(replace(replace(replace(replace(replace(replace(replace(lower(name), 'observation', ''), 'state', ''), 'action', ''), 'target', ''), 'command', ''), 'position', ''), 'pos', ''), '[^a-z0-9]', '', 'g') as joint,
    regexp_matches(regexp_replace(lower(name), '[^a-z0-9]', '', 'g'), '^(state(action)?|action)\d+$') as generic, regexp_matches(lower(name), 'gripper|finger|jaw') as grip from ju),
  jo as (select uid, k, joint, min(dimension) as dimension, bool_or(grip) as grip from jj where not generic and joint <> '' and not regexp_matches(joint, '^\d+$') group by all having count(*) = 1),
  named as (select a.uid, a.joint, a.dimension as state_dimension, b.dimension as action_dimension from jo a join jo b on a.uid = b.uid and a.joint = b.joint and a.k = 'observation.state' and b.k = 'action' where not a.grip and not b.grip)"""


@R.add(f"with {_NAMES} select * from named")
def unique_name_map(spark: SparkSession, folder: str) -> DataFrame:
    """Joints matched by name in the last readable scan of each dataset."""
    d = table(spark, folder, "datasets").withColumn("v", F.try_parse_json("schema_json")).filter(F.schema_of_variant("v").startswith("OBJECT"))
    w = Window.partitionBy("uid").orderBy(F.desc("scanned_at"), F.desc("snapshot_id"))
    last = d.withColumn("n", F.row_number().over(w)).filter("n = 1")
    side = lambda k: last.select("uid", F.posexplode(F.try_variant_get("v", f"$['{k}'].names", "array<string>")).alias("dimension", "name"))
    return trend.match_joints(side("observation.state"), side("action"), ["uid"])


# --- smoothing in SQL, over the lists x of a table

def _weights() -> str:
    rows = lambda n: [[float(v) for v in r] for r in polynomial_weights(n, 3)]
    return str([rows(n) for n in (5, 7, 9, 11)])


def _median(x: str) -> str:
    half = f"(least(5, len({x})) - 1) // 2"
    return f"list_transform(range(1, len({x}) + 1), lambda i: list_sort(list_transform(range(i - {half}, i + {half} + 1), lambda j: {x}[greatest(1, least(len({x}), j))]))[{half} + 1])"


def smoothed(source: str, name: str) -> str:
    """CTEs that add y, the smoothed list, to a CTE with the list x: two medians, then local polynomials of up to eleven frames."""
    n = f"(least(11, len(m2)) - 1 + least(11, len(m2)) % 2)"
    begin = f"greatest(1, least(len(m2) - {n} + 1, i - ({n} - 1) // 2))"
    fit = f"m2[i] + list_sum(list_transform(range(0, {n}), lambda k: weights[({n} - 5) // 2 + 1][i - {begin} + 1][k + 1] * (m2[{begin} + k] - m2[i])))"
    return f"""{name}_k as (select {_weights()} as weights), {name}_a as (select *, {_median('x')} as m1 from {source}), {name}_b as (select *, {_median('m1')} as m2 from {name}_a),
  {name} as (select * exclude (m1, m2, weights), case when len(m2) < 5 then m2 else list_transform(range(1, len(m2) + 1), lambda i: {fit}) end as y from {name}_b, {name}_k)"""


# --- stage 1

_FILLED = f"""with {PLACES}, whole as (select * from v semi join (select dataset_uid, episode_index, frame_index from f where state is not null and action is not null) using (dataset_uid, episode_index, frame_index)),
  pos as (select *, row_number() over w as t, case when isfinite(value) then value end as fine from whole window w as (partition by dataset_uid, episode_index, feature, dimension order by frame_index)),
  gap as (select *, last_value(fine ignore nulls) over b as a, last_value(case when fine is not null then t end ignore nulls) over b as ta, first_value(fine ignore nulls) over c as z, first_value(case when fine is not null then t end ignore nulls) over c as tz from pos
    window b as (partition by dataset_uid, episode_index, feature, dimension order by t rows unbounded preceding), c as (partition by dataset_uid, episode_index, feature, dimension order by t rows between current row and unbounded following)),
  filled as (select dataset_uid, episode_index, feature, dimension, list(coalesce(fine, a + (z - a) * (t - ta) / nullif(tz - ta, 0), a, z, 0) order by t) as x, list(frame_index order by t) as frames, list(fine is null order by t) as bad from gap group by all),
  {smoothed('filled', 'sm')},
  metrics as (select dataset_uid, episode_index, feature, dimension, unnest(frames) as frame_index, unnest(bad) as bad, unnest(list_transform(range(1, len(x) + 1), lambda i: abs(x[i] - y[i]))) as residual,
    unnest(list_transform(range(1, len(x) + 1), lambda i: abs(x[i] - 2 * x[greatest(1, i - 1)] + x[greatest(1, i - 2)]))) as acceleration,
    unnest(list_transform(range(1, len(x) + 1), lambda i: abs(x[i] - 3 * x[greatest(1, i - 1)] + 3 * x[greatest(1, i - 2)] - x[greatest(1, i - 3)]))) as jerk from sm)"""


@R.add(_FILLED + """ select dataset_uid, episode_index, count(distinct frame_index) as frames, (max(residual) filter (feature = 'state'))::float as most_residual, (max(jerk) filter (feature = 'action'))::float as most_jerk from metrics group by all""")
def stage1_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Distance to the smooth signal and differences, by episode."""
    m = signals.change_metrics(frame_rows(spark, folder).filter("state is not null and action is not null"), KEYS, ORDER, FEATURES)
    return m.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("frames"), F.max(F.array_max("state_residual")).cast("float").alias("most_residual"), F.max(F.array_max("action_jerk")).cast("float").alias("most_jerk"))


_LONG = "select dataset_uid, feature, dimension, metric, value from metrics unpivot (value for metric in (residual, acceleration, jerk))"
_STAGE1 = _FILLED + f""", long as ({_LONG}), mid as (select dataset_uid, feature, dimension, metric, quantile_cont(value, 0.5) as mid, quantile_cont(value, 0.999) as top, quantile_cont(value, 0.99) as size from long group by all),
  mad as (select dataset_uid, feature, dimension, metric, quantile_cont(abs(value - mid), 0.5) as mad from long join mid using (dataset_uid, feature, dimension, metric) group by all),
  lim as (select dataset_uid, feature, dimension, metric, greatest(mid + 8 * 1.4826 * mad, top, greatest(size, 1) * 1e-10) as threshold from mid join mad using (dataset_uid, feature, dimension, metric)),
  wide as (select dataset_uid, feature, dimension, max(threshold) filter (metric = 'residual') as lr, max(threshold) filter (metric = 'acceleration') as la, max(threshold) filter (metric = 'jerk') as lj from lim group by all),
  sudden as (select m.*, bad or (residual > lr and (acceleration > la or jerk > lj)) as hit from metrics m join wide using (dataset_uid, feature, dimension)),
  flagged as (select dataset_uid, episode_index, frame_index, coalesce(string_agg(case when hit and feature = 'state' then dimension end, ',' order by dimension), '') as failed_state, coalesce(string_agg(case when hit and feature = 'action' then dimension end, ',' order by dimension), '') as failed_action
    from sudden group by all having bool_or(hit) union all select dataset_uid, episode_index, frame_index, null, null from f where state is null or action is null)"""


@R.add(_STAGE1 + " select * from flagged")
def stage1_flags(spark: SparkSession, folder: str) -> DataFrame:
    """Frames of sudden changes and their places; frames without a vector have none."""
    return curation.stage1(frame_rows(spark, folder))["frame_flags"].select(*KEYS, *ORDER, *(F.array_join(f"failed_{v}_dimensions", ",").alias(f"failed_{v}") for v in curation.VECTORS))


@R.add(_STAGE1 + """ select dataset_uid, episode_index, count(*) as num_frames, count(g.frame_index) = 0 as accepted, case when count(g.frame_index) > 0 then 'stage1_sudden_change' end as reason_code
  from f left join flagged g using (dataset_uid, episode_index, frame_index) group by all""")
def stage1_episode_filter(spark: SparkSession, folder: str) -> DataFrame:
    return curation.stage1(frame_rows(spark, folder), curation.Config(exclusion="episode"))["episode_filter"]


# --- stage 2

_TREND = f"""with {_NAMES}, {PLACES}, val as (select dataset_uid, episode_index, frame_index, state is not null and action is not null and list_bool_and(list_transform(state, lambda e: isfinite(e))) and list_bool_and(list_transform(action, lambda e: isfinite(e))) as valid from f),
  num as (select *, row_number() over {W} as p from val), isl as (select *, p - row_number() over (partition by dataset_uid, episode_index order by p) as island from num where valid),
  runs as (select dataset_uid, episode_index, frame_index, island, count(*) over (partition by dataset_uid, episode_index, island) as steps from isl),
  x as (select dataset_uid, episode_index, island, steps, feature, dimension, list(value order by frame_index) as x from v join runs using (dataset_uid, episode_index, frame_index) where steps >= 3 group by all),
  {smoothed('x', 'sm')},
  wide as (select dataset_uid, episode_index, max(coalesce(len(state), 0)) as ws, max(coalesce(len(action), 0)) as wa from f group by all),
  mp as (select uid as dataset_uid, row_number() over (partition by uid order by state_dimension, action_dimension) - 1 as pair, state_dimension, action_dimension from (select distinct uid, state_dimension, action_dimension from named)),
  pr as (select dataset_uid, episode_index, pair, state_dimension, action_dimension from wide join mp using (dataset_uid) where state_dimension < ws and action_dimension < wa
    union all select dataset_uid, episode_index, d, d, d from (select *, unnest(range(least(ws, wa) - 1)) as d from wide where dataset_uid not in (select dataset_uid from mp))),
  t as (select pr.*, s.island, s.steps, s.y as s, a.y as a from pr join sm s on s.dataset_uid = pr.dataset_uid and s.episode_index = pr.episode_index and s.feature = 'state' and s.dimension = pr.state_dimension
    join sm a on a.dataset_uid = pr.dataset_uid and a.episode_index = pr.episode_index and a.feature = 'action' and a.dimension = pr.action_dimension and a.island = s.island),
  l as (select *, a[greatest(1, 1 - lag) : least(steps, steps - lag)] as x, s[greatest(1, 1 + lag) : least(steps, steps + lag)] as z from (select *, unnest(range(-15, 16)) as lag from t) where abs(lag) <= least(15, steps - 2)),
  c as (select dataset_uid, episode_index, island, pair, lag, count(*) as n, sqrt(var_pop(x)) * sqrt(var_pop(z)) as size, covar_pop(x, z) as cov from (select dataset_uid, episode_index, island, pair, lag, unnest(x) as x, unnest(z) as z from l) group by all),
  r as (select *, case when n >= 3 and n * size > 1e-15 then round(cov / size, 9) else '-inf'::double end as value from c),
  b as (select dataset_uid, episode_index, island, pair, arg_max(lag, (value, lag)) filter (lag >= 0) as lag, max(value) filter (lag >= 0) as value, arg_max(lag, (value, lag)) as free_lag from r group by all),
  m as (select dataset_uid, episode_index, island, pair, lag, value, free_lag, unnest(list_transform(range(1, len(x)), lambda i: x[i + 1] - x[i])) as da, unnest(list_transform(range(1, len(x)), lambda i: z[i + 1] - z[i])) as ds from l join b using (dataset_uid, episode_index, island, pair, lag)),
  u as (select dataset_uid, episode_index, island, pair, greatest(quantile_cont(abs(da), 0.9), 1e-10) as ua, greatest(quantile_cont(abs(ds), 0.9), 1e-10) as us from m group by all),
  k as (select dataset_uid, episode_index, island, pair, any_value(lag) as lag, any_value(value) as value, any_value(free_lag) as free_lag, count(*) filter (on_) as active, count(*) filter (on_ and da * ds > 0) as alike
    from (select *, abs(da) > ua * 1e-3 and abs(ds) > us * 1e-3 as on_ from m join u using (dataset_uid, episode_index, island, pair)) group by all),
  g as (select dataset_uid, episode_index, pair, sum(lag * active) / nullif(sum(active), 0) as lag, sum(free_lag * active) / nullif(sum(active), 0) as free_lag, sum(active) as active,
    sum(value * active) filter (value > '-inf'::double) / nullif(sum(active) filter (value > '-inf'::double), 0) as correlation, case when sum(active) >= 10 then sum(alike) / sum(active) end as agreement from k group by all),
  da as (select pr.dataset_uid, pr.episode_index, cast(pr.pair as int) as pair, cast(state_dimension as int) as state_dimension, cast(action_dimension as int) as action_dimension, cast(coalesce(round_even(lag, 0), 0) as int) as lag_frames, round(coalesce(round_even(lag, 0), 0) / 30, 6) as lag_seconds, round(correlation, 6) as correlation,
    cast(coalesce(round_even(free_lag, 0), 0) as int) as unconstrained_lag_frames, cast(coalesce(active, 0) as bigint) as active_steps, round(agreement, 6) as directional_agreement, coalesce(agreement < 0.65, false) as failed from pr left join g using (dataset_uid, episode_index, pair))"""


def name_map(spark: SparkSession, folder: str) -> DataFrame:
    return unique_name_map(spark, folder).withColumnRenamed("uid", "dataset_uid")


def stage2(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Stage 2 with the joints' names of the catalog, and equal places where it has none."""
    return curation.stage2(with_validity(spark, folder).drop("force"), curation.Config(positional=True), name_map(spark, folder))


@R.add(_TREND + " select * from da")
def directional_agreement(spark: SparkSession, folder: str) -> DataFrame:
    """Lag and agreement of every joint, over runs of valid frames."""
    return stage2(spark, folder)["dimension_metrics"].withColumns({c: F.round(c, 6) for c in ("lag_seconds", "correlation", "directional_agreement")})


@R.add(_TREND + """ select dataset_uid, episode_index, cast(count(directional_agreement) as int) as scored_dimensions, coalesce(string_agg(case when failed then pair end, ',' order by pair), '') as failed_dimensions, min(directional_agreement) as minimum_da, bool_or(failed) as reject_episode from da group by all""")
def stage2_episode_flags(spark: SparkSession, folder: str) -> DataFrame:
    return stage2(spark, folder)["episode_flags"].withColumns({"minimum_da": F.round("minimum_da", 6), "failed_dimensions": F.array_join("failed_dimensions", ",")})


@R.add(f"""with {PLACES}, val as (select dataset_uid, episode_index, frame_index, len(state) as ws, len(action) as wa from f where state is not null and action is not null and list_bool_and(list_transform(state, lambda e: isfinite(e))) and list_bool_and(list_transform(action, lambda e: isfinite(e)))),
  n as (select dataset_uid, episode_index, count(*) as frames, least(max(ws), max(wa)) as wide from val group by all),
  st as (select dataset_uid, episode_index, feature, dimension, row_number() over w - 1 as p, value - coalesce(lag(value) over w, value) as d from v semi join val using (dataset_uid, episode_index, frame_index) window w as (partition by dataset_uid, episode_index, feature, dimension order by frame_index)),
  pr as (select s.dataset_uid, s.episode_index, s.dimension, frames, list(s.d order by s.p) as s, list(a.d order by s.p) as a from st s join st a using (dataset_uid, episode_index, dimension, p) join n using (dataset_uid, episode_index) where s.feature = 'state' and a.feature = 'action' and frames >= 2 and s.dimension < wide group by all),
  ce as (select *, list_transform(s, lambda x: x - list_avg(s)) as cs, list_transform(a, lambda x: x - list_avg(a)) as ca from pr),
  lg as (select *, unnest(range(1 - frames, frames)) as lag from ce),
  su as (select dataset_uid, episode_index, dimension, lag, list_sum(list_transform(range(greatest(1, 1 + lag), least(frames, frames + lag) + 1), lambda i: cs[i] * ca[i - lag])) as total, sqrt(list_sum(list_transform(cs, lambda x: x * x)) * list_sum(list_transform(ca, lambda x: x * x))) * 1e-9 as close from lg),
  tp as (select *, max(total) over (partition by dataset_uid, episode_index, dimension) as top from su),
  pk as (select dataset_uid, episode_index, dimension, min(lag) as lag from tp where total >= top - close group by all),
  ag as (select dataset_uid, episode_index, dimension, lag, list_avg(list_transform(range(0, frames), lambda i: case when sign(s[i + 1]) = sign(a[((i - lag) % frames + frames) % frames + 1]) then 1 else 0 end)) as agreement from pr join pk using (dataset_uid, episode_index, dimension)),
  me as (select dataset_uid, episode_index, cast(trunc(quantile_cont(lag, 0.5)) as int) as lag, avg(agreement) as da from ag group by all)
  select dataset_uid, episode_index, lag, round(da, 6) as directional_agreement, coalesce(abs(lag) > 5 or da < 0.65, false) as rejected, case when frames < 2 then 'insufficient_frames_for_trend_alignment' when coalesce(wide, 0) < 1 then 'no_common_state_action_dims' when abs(lag) > 5 or da < 0.65 then 'trend_misaligned' end as skip_reason,
    case when coalesce(abs(lag) > 5 or da < 0.65, false) then 0 else frames - abs(coalesce(lag, 0)) end as kept_frames from n left join me using (dataset_uid, episode_index)""")
def legacy_trend_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return trend.legacy_alignment(with_validity(spark, folder).filter("valid"), KEYS, ORDER, "state", "action").withColumn("directional_agreement", F.round("directional_agreement", 6))


# --- all stages

@R.add()
def curated_frames(spark: SparkSession, folder: str) -> DataFrame:
    """Valid frames of each episode after all three stages."""
    f = frame_rows(spark, folder)
    one = curation.stage1(f)
    view = curation.with_step_validity(f, [one["step_validity"]])
    two = curation.stage2(view, curation.Config(positional=True), name_map(spark, folder))
    three = curation.stage3(curation.accepted_only(view, [two["episode_filter"]]))
    return three["episode_summary"]
