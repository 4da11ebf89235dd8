"""Queries of signals, runs, statistics and trends over frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trajlake.functions.vectors import any_of, finite
from trajlake.operators import quantiles, runs, signals, stats, trend
from trajlake.operators.spikes import find_spikes
from trajlake.plans import curation
from trajlake.queries.registry import FRAMES, KEYS, ORDER, PLACES, Registry, frame_copies, frame_rows, table

R = Registry()
QUERIES, SQL = R.queries, R.sql
FEATURES = {"state": "state", "action": "action"}
W = "(partition by dataset_uid, episode_index order by frame_index)"


def places(spark: SparkSession, folder: str) -> DataFrame:
    return stats.explode_places(frame_rows(spark, folder), [*KEYS, *ORDER], FEATURES)


def place(vector: str, d: int) -> F.Column:
    return F.get(vector, F.lit(d))


# --- calibration and statistics

_FINITE = "value is not null and isfinite(value)"
_BOUNDS = f"select dataset_uid, feature, dimension, quantile_cont(value, 0.01) as q_low, quantile_cont(value, 0.99) as q_high from v where {_FINITE} group by all"


def stage3(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return curation.stage3(frame_rows(spark, folder).withColumn("valid", F.lit(True)))


@R.add(f"""with {PLACES}, b as ({_BOUNDS}) select dataset_uid, feature, dimension, q_low::float as q_low, q_high::float as q_high,
  (q_low - 0.1 * (q_high - q_low))::float as lower, (q_high + 0.1 * (q_high - q_low))::float as upper from b""")
def stage3_bounds(spark: SparkSession, folder: str) -> DataFrame:
    """Quantile bounds of each dataset's places, widened by a tenth; over all frames."""
    return stage3(spark, folder)["thresholds"].select(F.col("embodiment").alias("dataset_uid"), "feature", "dimension", *(F.col(c).cast("float").alias(c) for c in ("q_low", "q_high", "lower", "upper")))


_FLAGS = f"""with {PLACES}, b as ({_BOUNDS}), l as (select dataset_uid, feature, dimension, q_low - 0.1 * (q_high - q_low) as lower, q_high + 0.1 * (q_high - q_low) as upper from b),
  n as (select dataset_uid, feature, max(dimension) as last from v group by all),
  x as (select v.*, (not coalesce(isfinite(value), false)) or (dimension <> last and (value > upper or value < lower)) as bad
    from v join n using (dataset_uid, feature) left join l using (dataset_uid, feature, dimension)),
  g as (select dataset_uid, episode_index, frame_index,
    coalesce(string_agg(case when bad and feature = 'state' then cast(dimension as varchar) end, ',' order by dimension), '') as failed_state_dimensions,
    coalesce(string_agg(case when bad and feature = 'action' then cast(dimension as varchar) end, ',' order by dimension), '') as failed_action_dimensions
    from x group by all having bool_or(bad))"""


@R.add(_FLAGS + " select * from g")
def stage3_frame_flags(spark: SparkSession, folder: str) -> DataFrame:
    """Frames with places beyond the bounds (the gripper's only if not finite), and which."""
    x = stage3(spark, folder)["frame_flags"]
    return x.select(*KEYS, *ORDER, *(F.array_join(F.coalesce(f"failed_{n}_dimensions", F.array().cast("array<int>")), ",").alias(f"failed_{n}_dimensions") for n in FEATURES))


@R.add(_FLAGS + """ select dataset_uid, episode_index, count(*) as input_frames, count(g.frame_index) as flagged_frames, count(*) - count(g.frame_index) as output_frames
  from f left join g using (dataset_uid, episode_index, frame_index) group by all""")
def stage3_episode_summary(spark: SparkSession, folder: str) -> DataFrame:
    return stage3(spark, folder)["episode_summary"].select(*KEYS, "input_frames", "flagged_frames", "output_frames")


@R.add(f"""with {FRAMES}, n as (select *, row_number() over (partition by dataset_uid order by episode_index, frame_index) - 1 as p, count(*) over (partition by dataset_uid) as total from f)
  select dataset_uid, episode_index, frame_index from n where p % greatest(1, ceil(total / 100)) = 0""")
def stride_sample(spark: SparkSession, folder: str) -> DataFrame:
    """At most 100 evenly spread frames of each dataset: a sampling operator."""
    return stats.stride_sample(frame_rows(spark, folder), "dataset_uid", "episode_index", ORDER, 100).select(*KEYS, *ORDER)


@R.add(f"""with {PLACES}, x as (select dataset_uid, feature, dimension, value from v where {_FINITE}),
  m as (select dataset_uid, feature, dimension, quantile_cont(value, 0.5) as mid, quantile_cont(value, 0.999) as top, quantile_cont(abs(value), 0.99) as size from x group by all),
  d as (select x.dataset_uid, x.feature, x.dimension, quantile_cont(abs(value - mid), 0.5) as mad from x join m using (dataset_uid, feature, dimension) group by all)
  select dataset_uid, feature, dimension, greatest(mid + 8 * 1.4826 * mad, top, greatest(size, 1) * 1e-10) as threshold from m join d using (dataset_uid, feature, dimension)""")
def robust_threshold(spark: SparkSession, folder: str) -> DataFrame:
    return quantiles.robust_limits(frame_rows(spark, folder), "dataset_uid", list(FEATURES))


_COMPONENTS = """min(case when isfinite(value) then value end) as least, max(case when isfinite(value) then value end) as most, count(*) as values,
  count(*) filter (isfinite(value)) as finite, count(*) filter (isnan(value)) as nan, count(*) filter (value = 'inf'::double) as plus_inf, count(*) filter (value = '-inf'::double) as minus_inf"""


@R.add(f"with {PLACES} select dataset_uid, feature, dimension, {_COMPONENTS} from v group by all")
def component_stats(spark: SparkSession, folder: str) -> DataFrame:
    return stats.component_statistics(places(spark, folder), ["dataset_uid", "feature", "dimension"], "value")


@R.add(f"with {PLACES} select feature, dimension, {_COMPONENTS} from v group by all")
def stats_merge(spark: SparkSession, folder: str) -> DataFrame:
    """Statistics of all datasets from those of each."""
    return stats.merge_component_statistics(component_stats(spark, folder), ["feature", "dimension"])


@R.add(f"""with {PLACES} select dataset_uid, episode_index, feature, dimension, count(value) as n, min(value) as least, max(value) as most, avg(value) as mean, stddev_pop(value) as std,
  quantile_cont(value, 0.01)::float as q01, quantile_cont(value, 0.5)::float as q50, quantile_cont(value, 0.99)::float as q99 from v where {_FINITE} group by all""")
def episode_stats(spark: SparkSession, folder: str) -> DataFrame:
    out = stats.episode_statistics(places(spark, folder).filter(finite(F.col("value"))), [*KEYS, "feature", "dimension"], "value")
    return out.withColumns({c: F.col(c).cast("float") for c in ("q01", "q50", "q99")})


@R.add(f"""with {PLACES} select dataset_uid, feature, dimension, cast(count(value) as bigint) as n, min(value) as least, max(value) as most, avg(value)::float as mean, stddev_pop(value)::float as std
  from v where {_FINITE} group by all""")
def pooled_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Mean and deviation of datasets pooled from those of their episodes, over all finite readings."""
    each = stats.episode_statistics(places(spark, folder).filter(finite(F.col("value"))), [*KEYS, "feature", "dimension"], "value")
    return stats.pool_statistics(each, ["dataset_uid", "feature", "dimension"]).withColumns({c: F.col(c).cast("float") for c in ("mean", "std")})


_PAIRS = FRAMES + f""", q as (select dataset_uid, episode_index, frame_index, row_number() over {W} as p, state, action, least(len(state), len(action)) as n from f),
  p as (select dataset_uid, episode_index, frame_index, p, cast(unnest(range(n)) as int) as dimension, unnest(state[1:n]) as s, unnest(action[1:n]) as a from q where n > 0)"""


def place_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Equal places of state and action in long form, with the frame's position in its episode."""
    n = F.least(F.size("state"), F.size("action"))
    f = frame_rows(spark, folder).withColumn("p", F.row_number().over(runs.ordered(KEYS, ORDER)))
    some = lambda c: F.coalesce(F.slice(c, 1, n), F.array().cast("array<double>"))
    return f.select(*KEYS, *ORDER, "p", F.posexplode(F.arrays_zip(some("state").alias("s"), some("action").alias("a"))).alias("dimension", "z")).select(*KEYS, *ORDER, "p", "dimension", "z.s", "z.a")


@R.add(f"""with {_PAIRS}, k as (select dataset_uid, episode_index, dimension, count(*) filter (isfinite(s) and isfinite(a)) as pairs from p group by all),
  c as (select dataset_uid, episode_index, dimension, stddev_pop(s) * stddev_pop(a) * count(*) as size, corr(s, a) as r from p where isfinite(s) and isfinite(a) group by all)
  select dataset_uid, episode_index, dimension, pairs, round(case when pairs >= 3 and size > 1e-15 then r else '-inf'::double end, 6) as correlation from k left join c using (dataset_uid, episode_index, dimension)""")
def pearson_guarded(spark: SparkSession, folder: str) -> DataFrame:
    """Correlation of every place of the state with the action's."""
    return stats.guarded_correlation(place_pairs(spark, folder), [*KEYS, "dimension"], "s", "a").withColumn("correlation", F.round("correlation", 6))


_EVENTS = "select user_id, event_id, epoch_us(ts) / 1e6 as t from events"


@R.add(f"""with d as (select user_id, t - lag(t) over (partition by user_id order by event_id) as d from ({_EVENTS})),
  s as (select user_id, count(d) as n, min(d) as least, quantile_cont(d, 0.5) as mid from d group by all),
  j as (select d.user_id, quantile_cont(abs(d - mid), 0.95) as jitter from d join s using (user_id) group by all),
  u as (select *, case when mid > 0 then case when 1 / mid between 1 and 240 then 1 when 1e3 / mid between 1 and 240 then 1e3 when 1e6 / mid between 1 and 240 then 1e6 when 1e9 / mid between 1 and 240 then 1e9 end end as unit from s join j using (user_id))
  select user_id, case when problem is null then unit / mid end as fps, problem from (select *, case when n < 1 then 'too_few' when least <= 0 then 'not_rising' when unit is null then 'implausible' when jitter > 0.1 * mid then 'jitter' end as problem from u)""")
def fps_from_timestamps(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "events").select("user_id", "event_id", (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("t"))
    return quantiles.fps_from_timestamps(e, "user_id", "t", "event_id")


@R.add("""with r as (select e_uid as dataset_uid, fps from (select dataset_uid as e_uid, frames / nullif(duration, 0) as fps from episodes where duration > 0)),
  m as (select dataset_uid, quantile_cont(fps, 0.5) as mid, min(fps) as least, max(fps) as most from r group by all)
  select dataset_uid, case when most <= mid * 1.02 and least >= mid * 0.98 and round_even(mid, 0) > 0 and abs(mid - round_even(mid, 0)) <= 0.02 * round_even(mid, 0) then cast(round_even(mid, 0) as int) end as fps from m""")
def fps_consensus(spark: SparkSession, folder: str) -> DataFrame:
    rates = table(spark, folder, "episodes").filter("duration > 0").select("dataset_uid", (F.col("frames") / F.col("duration")).alias("fps"))
    return quantiles.fps_consensus(rates, "dataset_uid", "fps")


@R.add(f"""with {FRAMES}, o as (select dataset_uid, force[1] as x, force[2] as y, force[3] as z from f where isfinite(force[1]) and isfinite(force[2]) and isfinite(force[3])),
  m as (select dataset_uid, quantile_cont(x, 0.5) as m0, quantile_cont(y, 0.5) as m1, quantile_cont(z, 0.5) as m2, var_pop(x) + var_pop(y) + var_pop(z) as variance from o group by all)
  select dataset_uid, m0, m1, m2, sqrt(m0 * m0 + m1 * m1 + m2 * m2) as length, variance::float as variance from m""")
def offset_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Median forces over all finite readings, whatever a dataset's units."""
    fine = F.forall(F.slice("force", 1, 3), finite) & (F.size("force") >= 3)
    f = frame_rows(spark, folder).filter(fine).select("dataset_uid", F.slice("force", 1, 3).alias("force"))
    return quantiles.offset_statistics(f, "dataset_uid", "force").withColumn("variance", F.col("variance").cast("float"))


_RANGES = {"l_quantity": (1.0, 49.0), "l_discount": (0.01, 0.09), "l_tax": (0.0, 0.07), "l_extendedprice": (1000.0, 100000.0)}
_LINE = "l_orderkey * 10 + l_linenumber"


@R.add(" union all ".join(f"select '{c}' as field, count(*) as violations, min({_LINE}) as first, arg_min({c}::double, {_LINE}) as value from lineitem where {c} < {low} or {c} > {high} having count(*) > 0" for c, (low, high) in _RANGES.items()))
def range_violations(spark: SparkSession, folder: str) -> DataFrame:
    """Values beyond the bounds of the numeric columns: how many, and the first by order and line."""
    return stats.range_violations(table(spark, folder, "lineitem").withColumn("line", F.expr(_LINE)), _RANGES, "line")


@R.add()
def spikes_by_hour(spark: SparkSession, folder: str) -> DataFrame:
    """Implausible values of events, by type and hour of the day (quantile summaries; tested by cases)."""
    hour = F.unix_timestamp(F.col("ts").cast("timestamp")).cast("bigint").alias("seconds")
    e = table(spark, folder, "events").select("event_type", "event_id", "value", hour).withColumn("hours", F.floor(F.col("seconds") / 3600))
    e = e.withColumn("place", F.row_number().over(Window.partitionBy("event_type", "hours").orderBy("seconds", "event_id"))).withColumn("values", F.array("value"))
    found = find_spikes(e, source="event_type", episode="hours", frame="place", features=("values",), gripper_last=(), context=F.pmod(F.col("hours"), F.lit(24)), fence=3.0, rate=6.0)
    return found.select("event_type", F.pmod(F.col("hours"), F.lit(24)).alias("hour"), "kinds").groupBy("event_type", "hour", "kinds").agg(F.count(F.lit(1)).alias("events"))


# --- differences, angles, gaps

def small_state(spark: SparkSession, folder: str) -> DataFrame:
    return frame_rows(spark, folder).filter("state is not null")


@R.add(f"""with {PLACES}, s as (select *, first_value(value) over w as x0, lag(value, 1) over w as l1, lag(value, 2) over w as l2, lag(value, 3) over w as l3 from v where feature = 'state'
    window w as (partition by dataset_uid, episode_index, dimension order by frame_index)),
  d as (select dataset_uid, dimension, abs(value - 2 * coalesce(l1, x0) + coalesce(l2, x0)) as acceleration, abs(value - 3 * coalesce(l1, x0) + 3 * coalesce(l2, x0) - coalesce(l3, x0)) as jerk from s)
  select dataset_uid, dimension, count(*) filter (isfinite(acceleration)) as n, max(acceleration) filter (isfinite(acceleration)) as most_acceleration, max(jerk) filter (isfinite(jerk)) as most_jerk,
    count(*) filter (isfinite(jerk) and jerk > 0.5) as jumps from d group by all""")
def second_third_diff(spark: SparkSession, folder: str) -> DataFrame:
    d = signals.differences(small_state(spark, folder), KEYS, ORDER, "state")
    x = d.select("dataset_uid", F.posexplode(F.arrays_zip("acceleration", "jerk")).alias("dimension", "z")).select("dataset_uid", "dimension", "z.*")
    ok = lambda c: F.when(finite(F.col(c)), F.col(c))
    return x.groupBy("dataset_uid", "dimension").agg(F.count(ok("acceleration")).alias("n"), F.max(ok("acceleration")).alias("most_acceleration"), F.max(ok("jerk")).alias("most_jerk"), F.count_if(finite(F.col("jerk")) & (F.col("jerk") > 0.5)).alias("jumps"))


@R.add(f"""with {PLACES}, g as (select *, case when b is not null and a is not null then (a - b) / 2 when a is not null then a - value when b is not null then value - b end as gradient from
    (select *, lag(value) over w as b, lead(value) over w as a from v where feature = 'state' window w as (partition by dataset_uid, episode_index, dimension order by frame_index))),
  h as (select *, case when b is not null and a is not null then (a - b) / 2 when a is not null then a - gradient when b is not null then gradient - b end as gradient2 from
    (select * exclude (a, b), lag(gradient) over w as b, lead(gradient) over w as a from g window w as (partition by dataset_uid, episode_index, dimension order by frame_index))),
  k as (select dataset_uid, episode_index, frame_index, bool_or(coalesce((isfinite(gradient) and abs(gradient) > 0.5) or (isfinite(gradient2) and abs(gradient2) > 5), false)) as flagged from h group by all)
  select dataset_uid, episode_index, count(*) as frames, count(*) filter (flagged) as flagged_frames from k group by all""")
def gradient_flags(spark: SparkSession, folder: str) -> DataFrame:
    """The older rule for sudden changes: large central differences in any place of the state."""
    g = signals.gradients(small_state(spark, folder), KEYS, ORDER, "state")
    big = lambda c, k: any_of(F.transform(c, lambda x: finite(x) & (F.abs(x) > k)))
    return g.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("frames"), F.count_if(big("gradient", 0.5) | big("gradient2", 5)).alias("flagged_frames"))


_WV = "(partition by dataset_uid, episode_index, feature, dimension order by frame_index)"


@R.add(f"""with {PLACES}, s as (select *, value - lag(value) over {_WV} as d from v where isfinite(value) and feature = 'state'),
  c as (select *, case when abs(d) >= pi() then (case when m = -pi() and d > 0 then pi() else m end) - d else 0 end as fix from (select *, (d + pi()) - 2 * pi() * floor((d + pi()) / (2 * pi())) - pi() as m from s)),
  u as (select *, value + sum(coalesce(fix, 0)) over (partition by dataset_uid, episode_index, feature, dimension order by frame_index rows unbounded preceding) as angle from c)
  select dataset_uid, episode_index, dimension, count(*) as frames, round(min(angle), 3) + 0 as least, round(max(angle), 3) + 0 as most, round(arg_max(angle, frame_index), 3) + 0 as last from u group by all""")
def unwrap_angle(spark: SparkSession, folder: str) -> DataFrame:
    """Every place of the state as an angle in radians: its range and end without jumps."""
    v = stats.explode_places(frame_rows(spark, folder), [*KEYS, *ORDER], {"state": "state"}).filter(finite(F.col("value")))
    u = signals.unwrapped(v, [*KEYS, "feature", "dimension"], ORDER, "value", "angle")
    return u.groupBy(*KEYS, "dimension").agg(F.count(F.lit(1)).alias("frames"), *((F.round(c, 3) + 0.0).alias(n) for c, n in ((F.min("angle"), "least"), (F.max("angle"), "most"), (F.max_by("angle", "frame_index"), "last"))))


@R.add(f"""with {FRAMES}, q as (select dataset_uid, episode_index, frame_index, list_slice(state, 1, 4) as q from f where state is not null),
  d as (select *, list_sum(list_transform(range(1, 5), lambda i: q[i] * p[i])) as d from (select *, lag(q) over w as p from q window w as {W})),
  r as (select *, sum(case when d is null or isnan(d) or d = 0 then 1 else 0 end) over (partition by dataset_uid, episode_index order by frame_index rows unbounded preceding) as island,
    case when d is not null and not isnan(d) and d < 0 then 1 else 0 end as flip from d),
  s as (select *, sum(flip) over (partition by dataset_uid, episode_index, island order by frame_index rows unbounded preceding) % 2 as odd from r)
  select dataset_uid, episode_index, count(*) as frames, cast(sum(odd) as bigint) as flipped from s group by all""")
def quaternion_signs(spark: SparkSession, folder: str) -> DataFrame:
    """How many frames' first four places change their sign when taken as quaternions."""
    s = signals.steady_quaternions(small_state(spark, folder), KEYS, ORDER, "state", [0, 1, 2, 3], "steady")
    odd = F.exists(F.zip_with("steady", F.slice("state", 1, 4), lambda a, b: ~F.isnan(a) & (a != b)), lambda x: x)
    return s.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("frames"), F.count_if(odd).alias("flipped"))


@R.add(f"""with {PLACES}, every as (select * from v union all select dataset_uid, episode_index, frame_index, 'force', cast(unnest(range(len(force))) as int), unnest(force) from f),
  x as (select *, row_number() over w as t, case when isfinite(value) then value end as v from every window w as {_WV}),
  n as (select *, last_value(v ignore nulls) over b as a, last_value(case when v is not null then t end ignore nulls) over b as ta, first_value(v ignore nulls) over c as z, first_value(case when v is not null then t end ignore nulls) over c as tz from x
    window b as (partition by dataset_uid, episode_index, feature, dimension order by frame_index rows unbounded preceding), c as (partition by dataset_uid, episode_index, feature, dimension order by frame_index rows between current row and unbounded following))
  select dataset_uid, episode_index, frame_index, feature, dimension, round(coalesce(a + (z - a) * (t - ta) / nullif(tz - ta, 0), a, z, 0), 6) as filled from n where v is null""")
def fill_nonfinite(spark: SparkSession, folder: str) -> DataFrame:
    """What stands in for readings that are not finite, in every place of every vector."""
    v = stats.explode_places(frame_rows(spark, folder), [*KEYS, *ORDER], {"state": "state", "action": "action", "force": "force"})
    out = signals.filled(v, [*KEYS, "feature", "dimension"], ORDER, "value", "filled").filter(~finite(F.col("value")))
    return out.select(*KEYS, *ORDER, "feature", "dimension", F.round("filled", 6).alias("filled"))


# --- runs

@R.add(_FLAGS + f""", r as (select *, frame_index - row_number() over {W} as island from g)
  select dataset_uid, episode_index, min(frame_index) as frame_start, max(frame_index) as frame_end, count(*) as frames from r group by dataset_uid, episode_index, island""")
def merge_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """Flagged frames as ranges."""
    return runs.merge_ranges(stage3_frame_flags(spark, folder), KEYS)


_VALID = FRAMES + """, x as (select dataset_uid, episode_index, frame_index, state is not null and action is not null and list_bool_and(list_transform(state, lambda e: isfinite(e))) and list_bool_and(list_transform(action, lambda e: isfinite(e))) as valid from f)"""


def with_validity(spark: SparkSession, folder: str) -> DataFrame:
    whole = lambda c: F.coalesce(F.forall(c, finite), F.lit(False))
    return frame_rows(spark, folder).withColumn("valid", whole("state") & whole("action"))


@R.add(f"""with {_VALID}, p as (select *, row_number() over {W} - 1 as p from x), r as (select *, p - row_number() over (partition by dataset_uid, episode_index order by p) as island from p where valid),
  g as (select dataset_uid, episode_index, min(p) as start, max(p) as stop, count(*) as length from r group by dataset_uid, episode_index, island having count(*) >= 3)
  select *, row_number() over (partition by dataset_uid, episode_index order by start) - 1 as run from g""")
def valid_runs(spark: SparkSession, folder: str) -> DataFrame:
    return runs.valid_runs(with_validity(spark, folder), KEYS, ORDER, "valid", 3)


@R.add(f"""with {_VALID} select dataset_uid, episode_index, count(*) filter (ok) as usable, count(*) as frames from (select *, bool_and(coalesce(valid, false)) over (partition by dataset_uid, episode_index order by frame_index rows unbounded preceding) as ok from x) group by all""")
def causal_chunk_mask(spark: SparkSession, folder: str) -> DataFrame:
    """Frames before the first invalid one."""
    v = with_validity(spark, folder).withColumn("ok", runs.causal_validity(KEYS, ORDER, F.col("valid")))
    return v.groupBy(*KEYS).agg(F.count_if("ok").alias("usable"), F.count(F.lit(1)).alias("frames"))


@R.add(f"""with {_VALID}, o as (select x.*, f.state, bool_and(coalesce(valid, false)) over (partition by dataset_uid, episode_index order by frame_index rows unbounded preceding) as ok from x join f using (dataset_uid, episode_index, frame_index))
  select dataset_uid, cast(sum(case when ok then len(state) - 1 else 0 end) as bigint) as slots from o group by all""")
def causal_loss_mask(spark: SparkSession, folder: str) -> DataFrame:
    """Places that may be learned from: all but the gripper's, before the first invalid frame."""
    v = with_validity(spark, folder).withColumn("ok", runs.causal_validity(KEYS, ORDER, F.col("valid")))
    slots = F.transform("state", lambda x, i: i < F.size("state") - 1)
    mask = runs.loss_mask(F.col("ok"), slots)
    return v.groupBy("dataset_uid").agg(F.sum(F.coalesce(F.size(F.filter(mask, lambda m: m)), F.lit(0)) * F.col("ok").cast("int")).cast("bigint").alias("slots"))


_STILL = FRAMES + f""", u as (select dataset_uid, episode_index, frame_index, state[len(state)] as grip, coalesce(state[1:len(state) - 1] = lag(state[1:len(state) - 1]) over {W}, false) as unchanged from f where state is not null),
  c as (select *, case when unchanged = coalesce(lag(unchanged) over {W}, not unchanged) then 0 else 1 end as c from u),
  i as (select *, sum(c) over (partition by dataset_uid, episode_index order by frame_index rows unbounded preceding) as island from c),
  n as (select *, unchanged and count(*) over (partition by dataset_uid, episode_index, island) >= 4 as run from i)"""


def with_still(spark: SparkSession, folder: str) -> DataFrame:
    f = small_state(spark, folder).select(*KEYS, *ORDER, "state", F.slice("state", 1, F.greatest(F.size("state") - 1, F.lit(0))).alias("x"))
    same = F.coalesce(F.col("x") == F.lag("x").over(runs.ordered(KEYS, ORDER)), F.lit(False))
    return f.withColumn("unchanged", same)


@R.add(f"with {_STILL} select dataset_uid, episode_index, frame_index from n where run")
def consecutive_run_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Frames of at least four unchanged steps in a row."""
    return runs.long_runs(with_still(spark, folder), KEYS, ORDER, "unchanged", 4, "run").filter("run").select(*KEYS, *ORDER)


@R.add(f"""with {_STILL}, m as (select *, coalesce(abs(grip - lag(grip) over {W}) > 1e-6, false) as moved from n),
  p as (select *, moved or coalesce(lead(moved) over {W}, false) as protected, run or coalesce(lead(run) over {W}, false) as still from m)
  select dataset_uid, episode_index, frame_index from p where still and not protected""")
def still_frames(spark: SparkSession, folder: str) -> DataFrame:
    """Frames of a standstill of five frames or more in which the gripper rests as well."""
    f = with_still(spark, folder).withColumn("grip", F.array(F.get("state", F.size("state") - 1)))
    f = runs.gripper_moves(f, KEYS, ORDER, "grip", [0], "protected")
    return runs.still_frames(f, KEYS, ORDER, "unchanged", 5, "protected", "still").filter("still").select(*KEYS, *ORDER)


@R.add(f"""with {FRAMES}, g as (select dataset_uid, episode_index, frame_index, state[len(state)] as grip, row_number() over {W} - 1 as p from f where state is not null),
  c as (select *, case when p > 0 and grip is not distinct from lag(grip) over {W} then 0 else 1 end as c from g),
  i as (select *, sum(c) over (partition by dataset_uid, episode_index order by frame_index rows unbounded preceding) - 1 as run from c)
  select dataset_uid, episode_index, cast(run as bigint) as run, any_value(grip) as grip, min(p) as start, max(p) + 1 as stop from i group by dataset_uid, episode_index, run""")
def segment_rle(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of the gripper's position."""
    f = small_state(spark, folder).select(*KEYS, *ORDER, F.get("state", F.size("state") - 1).alias("grip"))
    return runs.encode_runs(f, KEYS, ORDER, "grip")


@R.add(f"""with {_VALID}, e as (select dataset_uid, episode_index, bool_and(coalesce(valid, false)) as accepted from x group by all)
  select dataset_uid, episode_index, row_number() over (partition by dataset_uid order by episode_index) - 1 as final_index from e where accepted""")
def survivor_rank(spark: SparkSession, folder: str) -> DataFrame:
    e = with_validity(spark, folder).groupBy(*KEYS).agg(F.bool_and("valid").alias("accepted"))
    return runs.survivor_ranks(e, ["dataset_uid"], "episode_index", "accepted")


# --- trends

_LAGS = f"""with {_PAIRS}, k as (select unnest(range(-15, 16)) as lag),
  j as (select x.dataset_uid, x.episode_index, x.dimension, lag, x.a, y.s from p x, k, p y where y.dataset_uid = x.dataset_uid and y.episode_index = x.episode_index and y.dimension = x.dimension and y.p = x.p + lag),
  c as (select dataset_uid, episode_index, dimension, lag, count(*) filter (isfinite(a) and isfinite(s)) as n, corr(a, s) filter (isfinite(a) and isfinite(s)) as r,
    stddev_pop(a) filter (isfinite(a) and isfinite(s)) * stddev_pop(s) filter (isfinite(a) and isfinite(s)) * count(*) as size from j group by all)"""


@R.add(_LAGS + """, v as (select *, round(case when n >= 3 and size > 1e-15 then r else '-inf'::double end, 6) as v from c)
  select dataset_uid, episode_index, dimension, cast(arg_max(lag, (v, lag)) as int) as best_lag, case when max(v) > '-inf'::double then max(v) end as best_correlation from v group by all""")
def best_lag_correlation(spark: SparkSession, folder: str) -> DataFrame:
    """The lag of at most 15 frames at which each place of the state follows its action best."""
    return trend.best_lags(frame_copies(spark, folder), KEYS, ORDER, "state", "action", 15, 6)
