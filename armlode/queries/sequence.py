"""Queries along episodes, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from armlode.functions import pose as P
from armlode.operators import frames as FR
from armlode.operators import quality as Q
from armlode.operators import sequence as S
from armlode.sources.tables import source_key, table

SIDE = ["episode_id", "side"]
#: SQL of the canonical rows, and of the frames of an episode.
ONE = "one AS (SELECT * FROM frames WHERE t IS NOT NULL QUALIFY row_number() OVER (PARTITION BY episode_id, side, frame_idx ORDER BY (q IS NULL), received_at, t) = 1)"
WHOLE = f"{ONE}, whole AS (SELECT episode_id, frame_idx, min(t) AS t FROM one GROUP BY 1, 2)"
ACTIVE = "act AS (SELECT DISTINCT episode_id, CAST(CASE u WHEN 'right' THEN 0 WHEN 'left' THEN 1 END AS TINYINT) AS side FROM (SELECT episode_id, unnest(active_sides) AS u FROM episodes) WHERE u IN ('right', 'left'))"
JQ = ", ".join(f"q[{i}] AS q{i}" for i in range(1, 8))


def _rates_sql() -> str:
    v = ", ".join(f"CASE WHEN i = 0 THEN 0.0 WHEN dt = 0 THEN NULL ELSE (q{k} - lag(q{k}) OVER w) / dt END AS v{k}" for k in range(1, 8))
    a = ", ".join(f"CASE WHEN i < 2 THEN 0.0 WHEN dt + pdt = 0 THEN NULL ELSE (v{k} - lag(v{k}) OVER w) / ((dt + pdt) / 2) END AS a{k}" for k in range(1, 8))
    w = "WINDOW w AS (PARTITION BY episode_id, side ORDER BY frame_idx)"
    grt = lambda p: "greatest(" + ", ".join(f"abs({p}{k})" for k in range(1, 8)) + ")"
    return (
        f"{ONE}, n0 AS (SELECT *, {JQ}, row_number() OVER w - 1 AS i, t - lag(t) OVER w AS dt FROM one {w}), n1 AS (SELECT *, {v} FROM n0 {w}), "
        f"n2 AS (SELECT *, lag(dt) OVER w AS pdt FROM n1 {w}), n3 AS (SELECT *, {a} FROM n2 {w}), rt AS (SELECT *, {grt('v')} AS speed, {grt('a')} AS acceleration FROM n3)"
    )


RATES = _rates_sql()
OK = (
    f"{RATES}, oks AS (SELECT *, coalesce(position_error_m <= 0.01, false) AND coalesce(orientation_error_rad <= 0.15, false) AND coalesce(jacobian_condition <= 500, false) "
    "AND coalesce(speed <= 3.0, q IS NOT NULL) AND coalesce(acceleration <= 20.0, q IS NOT NULL) AND coalesce(greatest(abs(q1), abs(q2), abs(q3), abs(q4), abs(q5), abs(q6), abs(q7)) <= 3.2, false) AS ok FROM rt)"
)
FEASIBLE = (
    f"{OK}, {ACTIVE}, fr AS (SELECT o.episode_id, o.frame_idx, min(o.t) AS t, bool_and(o.ok) AS ok FROM oks o JOIN act a ON o.episode_id = a.episode_id AND o.side = a.side GROUP BY 1, 2), "
    "ch AS (SELECT *, CASE WHEN ok = lag(ok) OVER w THEN 0 ELSE 1 END AS c FROM fr WINDOW w AS (PARTITION BY episode_id ORDER BY frame_idx)), "
    "ru AS (SELECT *, sum(c) OVER (PARTITION BY episode_id ORDER BY frame_idx) AS r FROM ch), feas AS (SELECT *, ok AND count(*) OVER (PARTITION BY episode_id, r) >= 6 AS feasible FROM ru), "
    "fc AS (SELECT *, CASE WHEN feasible = lag(feasible) OVER w THEN 0 ELSE 1 END AS c2 FROM feas WINDOW w AS (PARTITION BY episode_id ORDER BY frame_idx)), fx AS (SELECT *, sum(c2) OVER (PARTITION BY episode_id ORDER BY frame_idx) AS run FROM fc)"
)


def _frames(spark: SparkSession, base: str) -> DataFrame:
    return FR.canonical(table(spark, base, "frames"))


def _whole(spark: SparkSession, base: str) -> DataFrame:
    return FR.both_sides(_frames(spark, base))


def _feasible(spark: SparkSession, base: str) -> DataFrame:
    return Q.feasible_frames(table(spark, base, "frames"), table(spark, base, "episodes"))


def feasible_runs(spark, base):
    return Q.feasibility_report(table(spark, base, "frames"), table(spark, base, "episodes"))


def velocity_acceleration(spark, base):
    return Q.joint_rates(table(spark, base, "frames")).select("episode_id", "side", "frame_idx", F.round("speed", 4).alias("speed"), F.round("acceleration", 3).alias("acceleration"))


def episode_duration(spark, base):
    return S.durations(_whole(spark, base), ["episode_id"], "frame_idx", "t").select("episode_id", "frames", F.round("period", 6).alias("period"), F.round("duration", 6).alias("duration"), "increasing")


def rebase_time(spark, base):
    ns = F.unix_micros(F.col("received_at").cast("timestamp")) * 1000
    d = _frames(spark, base).withColumn("ns", ns)
    return S.rebase(d, ["episode_id"], "ns", "since").select("episode_id", "side", "frame_idx", F.round(F.col("since") / 1e9, 6).alias("seconds"))


def quat_continuity(spark, base):
    flat = _frames(spark, base).select("episode_id", "side", "frame_idx", "pose.qx", "pose.qy", "pose.qz", "pose.qw")
    d = S.continuous_quaternions(flat, SIDE, "frame_idx")
    return d.select("episode_id", "side", "frame_idx", *[(F.round(c, 6) + 0.0).alias(c) for c in ("qx", "qy", "qz", "qw")])


def run_extraction(spark, base):
    return S.extract_runs(_feasible(spark, base), ["episode_id"], "frame_idx", "feasible")


def held_event_smoothstep(spark, base):
    d = _frames(spark, base).filter("gripper is not null").select("episode_id", "side", "frame_idx", "t", F.round("gripper", 1).alias("held"))
    e = S.smoothstep_events(d, SIDE, "frame_idx", "t", "held", 1.0, 0.3, "smooth")
    return e.select("episode_id", "side", "frame_idx", F.round("smooth", 5).alias("smooth"))


def budget_prefix(spark, base):
    sel = table(spark, base, "selected_episodes").filter("seconds is not null").select(source_key("source_dataset").alias("source"), "episode_index", F.round(F.col("seconds") * 1000).cast("long").alias("ms"))
    once = sel.groupBy("source", "episode_index").agg(F.max("ms").alias("ms"))
    return S.budget_prefix(once, ["source"], ["episode_index"], "ms", 60_000).select("source", "episode_index", "ms", "before")


def best_window(spark, base):
    d = _frames(spark, base).filter("side = 0").select("episode_id", "frame_idx", "feasible", "pose")
    w = S.ordered(["episode_id"], ["frame_idx"])
    p = [F.col(f"pose.{k}") for k in "xyz"]
    step = F.coalesce(P.norm([F.lead(c).over(w) - c for c in p]), F.lit(0.0))
    d = d.withColumns({"step": F.floor(F.least(step, F.lit(1.0)) * 1e6).cast("long"), "good": F.coalesce("feasible", F.lit(False))})
    return S.best_window(d, ["episode_id"], "frame_idx", "step", "good", 30).select("episode_id", "start", "end", F.round("score", 3).alias("score"))


def balanced_ranges(spark, base):
    return S.balanced_ranges(_whole(spark, base), ["episode_id"], "frame_idx", 3)


def motion_active(spark, base):
    d = _frames(spark, base).withColumn("n", P.norm(P.fields("pose")[1])).filter("abs(n - 1) < 0.001").drop("n")
    return S.moving_sides(S.motion(d, SIDE, "frame_idx")).select("episode_id", "side", F.round("motion", 5).alias("motion"), "moves")


def overlap_windows(spark, base):
    d = S.overlap_windows(_whole(spark, base), ["episode_id"], "frame_idx", 16, 12)
    return d.select("episode_id", "i", "windows", F.col("weight_sum").cast("long").alias("weight_sum"))


def track_smoothing(spark, base):
    d = _frames(spark, base).select("episode_id", "side", "frame_idx", "gripper")
    return S.smooth_track(d, SIDE, "frame_idx", "gripper", "smooth").select("episode_id", "side", "frame_idx", F.round("smooth", 6).alias("smooth"))


def masked_average(spark, base):
    d = _frames(spark, base).select("episode_id", "side", "frame_idx", F.col("position_error_m").alias("e"))
    return S.masked_average(d, SIDE, "frame_idx", "e", 0.1, F.col("e") >= 0, "average").select("episode_id", "side", "rows", F.round("average", 8).alias("average"))


def temporal_max(spark, base):
    return S.rolling_max(_frames(spark, base), SIDE, "frame_idx", "position_error_m", 2, "peak").select("episode_id", "side", "frame_idx", "peak")


def jump_p95(spark, base):
    w = FR.side_window()
    d = _frames(spark, base).withColumn("jump", F.abs(F.col("gripper") - F.lag("gripper").over(w)))
    return d.groupBy("episode_id", "side").agg(F.round(F.percentile("jump", 0.95), 6).alias("p95"), F.round(F.max("jump"), 6).alias("most"))


def chunked_frames(spark, base):
    return S.chunks(_whole(spark, base), "frame_idx", 120).groupBy("episode_id", "chunk").agg(F.count("*").alias("frames"), F.max("at").alias("last_at"))


def strided_sample(spark, base):
    return S.strided(_whole(spark, base), "frame_idx", 10).select("episode_id", "frame_idx", F.round("t", 6).alias("t"))


def invariant_violations(spark, base):
    return FR.violations(_frames(spark, base))


def slice_rebased(spark, base):
    d = FR.slice_frames(_frames(spark, base), 10, 60)
    return d.select("episode_id", "side", "frame_idx", F.round("t", 6).alias("t"))


QUERIES = {
    f.__name__: f
    for f in (
        feasible_runs, velocity_acceleration, episode_duration, rebase_time, quat_continuity, run_extraction, held_event_smoothstep, budget_prefix, best_window, balanced_ranges, motion_active,
        overlap_windows, track_smoothing, masked_average, temporal_max, jump_p95, chunked_frames, strided_sample, invariant_violations, slice_rebased,
    )
}

_KEY = "lower(regexp_replace({}, '[^\\p{{L}}\\p{{N}}]+', '', 'g'))"
_W = "WINDOW w AS (PARTITION BY episode_id, side ORDER BY frame_idx)"
_Z = lambda c: f"CASE WHEN {c} = 0 THEN 0.0 ELSE {c} END"

SQL = {
    "feasible_runs": f"WITH {FEASIBLE} SELECT episode_id, count(*) AS frames, count(*) FILTER (feasible) AS feasible_frames, count(DISTINCT run) FILTER (feasible) AS runs, round(count(*) FILTER (feasible) / count(*), 6) AS feasible_fraction FROM fx GROUP BY 1",
    "velocity_acceleration": f"WITH {RATES} SELECT episode_id, side, frame_idx, round(speed, 4) AS speed, round(acceleration, 3) AS acceleration FROM rt",
    "episode_duration": f"""WITH {WHOLE}, st AS (SELECT *, t - lag(t) OVER (PARTITION BY episode_id ORDER BY frame_idx) AS dt FROM whole),
ag AS (SELECT episode_id, count(*) AS frames, coalesce(quantile_cont(dt, 0.5), 1/30) AS period, max(t) - min(t) AS span, coalesce(bool_and(dt > 0), true) AS increasing FROM st GROUP BY 1)
SELECT episode_id, frames, round(period, 6) AS period, round(span + period, 6) AS duration, increasing FROM ag""",
    "rebase_time": f"WITH {ONE} SELECT episode_id, side, frame_idx, round((epoch_us(received_at) * 1000 - min(epoch_us(received_at) * 1000) OVER (PARTITION BY episode_id)) / 1e9, 6) AS seconds FROM one",
    "quat_continuity": f"""WITH {ONE}, r AS (SELECT episode_id, side, frame_idx, pose.qx AS x, pose.qy AS y, pose.qz AS z, pose.qw AS w_, sqrt(pose.qx*pose.qx + pose.qy*pose.qy + pose.qz*pose.qz + pose.qw*pose.qw) AS n FROM one),
u AS (SELECT episode_id, side, frame_idx, CASE WHEN n >= 1e-12 THEN x / n * s END AS x, CASE WHEN n >= 1e-12 THEN y / n * s END AS y, CASE WHEN n >= 1e-12 THEN z / n * s END AS z, CASE WHEN n >= 1e-12 THEN w_ / n * s END AS w_ FROM (SELECT *, CASE WHEN w_ < 0 THEN -1.0 ELSE 1.0 END AS s FROM r)),
d AS (SELECT *, x * lag(x) OVER w + y * lag(y) OVER w + z * lag(z) OVER w + w_ * lag(w_) OVER w AS dt FROM u {_W}),
g AS (SELECT *, sum(CASE WHEN dt = 0 THEN 1 ELSE 0 END) OVER w AS g FROM d {_W}),
f AS (SELECT *, CASE WHEN sum(CASE WHEN dt < 0 THEN 1 ELSE 0 END) OVER (PARTITION BY episode_id, side, g ORDER BY frame_idx) % 2 = 0 THEN 1.0 ELSE -1.0 END AS sg FROM g)
SELECT episode_id, side, frame_idx, round(x * sg, 6) + 0.0 AS qx, round(y * sg, 6) + 0.0 AS qy, round(z * sg, 6) + 0.0 AS qz, round(w_ * sg, 6) + 0.0 AS qw FROM f""",
    "run_extraction": f"WITH {FEASIBLE}, nn AS (SELECT *, row_number() OVER (PARTITION BY episode_id ORDER BY frame_idx) - 1 AS i FROM fx) SELECT episode_id, min(i) AS start, max(i) + 1 AS \"end\", count(*) AS frames FROM nn WHERE feasible GROUP BY episode_id, run",
    "budget_prefix": f"""WITH once AS (SELECT {_KEY.format('source_dataset')} AS source, episode_index, max(CAST(round(seconds * 1000) AS BIGINT)) AS ms FROM selected_episodes WHERE seconds IS NOT NULL GROUP BY 1, 2),
b AS (SELECT *, coalesce(sum(ms) OVER (PARTITION BY source ORDER BY episode_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM once)
SELECT source, episode_index, ms, CAST(before AS BIGINT) AS before FROM b WHERE before < 60000""",
    "best_window": f"""WITH {ONE}, s AS (SELECT episode_id, frame_idx, coalesce(feasible, false) AS good, CAST(floor(least(coalesce(sqrt((lead(pose.x) OVER w - pose.x)*(lead(pose.x) OVER w - pose.x) + (lead(pose.y) OVER w - pose.y)*(lead(pose.y) OVER w - pose.y) + (lead(pose.z) OVER w - pose.z)*(lead(pose.z) OVER w - pose.z)), 0.0), 1.0) * 1e6) AS BIGINT) AS step,
row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY episode_id) AS n FROM one WHERE side = 0 WINDOW w AS (PARTITION BY episode_id ORDER BY frame_idx)),
c AS (SELECT *, coalesce(sum(step) OVER (PARTITION BY episode_id ORDER BY frame_idx ROWS BETWEEN CURRENT ROW AND 28 FOLLOWING), 0) * power(avg(CAST(good AS DOUBLE)) OVER (PARTITION BY episode_id ORDER BY frame_idx ROWS BETWEEN CURRENT ROW AND 29 FOLLOWING), 2) AS score FROM s)
SELECT episode_id, i AS start, least(i + 30, n) AS "end", round(score, 3) AS score FROM c WHERE i + 30 <= n OR i = 0 QUALIFY row_number() OVER (PARTITION BY episode_id ORDER BY round(score, 9) DESC, i) = 1""",
    "balanced_ranges": f"WITH {WHOLE}, n AS (SELECT *, ntile(3) OVER w AS part, row_number() OVER w - 1 AS i FROM whole WINDOW w AS (PARTITION BY episode_id ORDER BY frame_idx)) SELECT episode_id, CAST(part AS INT) AS part, min(i) AS start, max(i) + 1 AS \"end\" FROM n GROUP BY 1, 2",
    "motion_active": f"""WITH {ONE}, f AS (SELECT * FROM one WHERE abs(sqrt(pose.qx*pose.qx + pose.qy*pose.qy + pose.qz*pose.qz + pose.qw*pose.qw) - 1) < 0.001),
s AS (SELECT episode_id, side, sqrt((pose.x - lag(pose.x) OVER w)*(pose.x - lag(pose.x) OVER w) + (pose.y - lag(pose.y) OVER w)*(pose.y - lag(pose.y) OVER w) + (pose.z - lag(pose.z) OVER w)*(pose.z - lag(pose.z) OVER w))
 + 0.1 * 2 * acos(least(abs(pose.qx * lag(pose.qx) OVER w + pose.qy * lag(pose.qy) OVER w + pose.qz * lag(pose.qz) OVER w + pose.qw * lag(pose.qw) OVER w), 1.0)) AS st FROM f {_W}),
m AS (SELECT episode_id, side, coalesce(sum(st), 0.0) AS motion FROM s GROUP BY 1, 2), x AS (SELECT *, max(motion) OVER (PARTITION BY episode_id) AS most FROM m)
SELECT episode_id, side, round(motion, 5) AS motion, CASE WHEN most < 1e-6 THEN true ELSE motion >= greatest(0.01, most * 0.05) OR (most < 0.01 AND motion = most) END AS moves FROM x""",
    "overlap_windows": f"""WITH {WHOLE}, r AS (SELECT episode_id, row_number() OVER (PARTITION BY episode_id ORDER BY frame_idx) - 1 AS i, count(*) OVER (PARTITION BY episode_id) AS n FROM whole),
e AS (SELECT DISTINCT episode_id, n, greatest(n - 16, 0) AS fin FROM r), st AS (SELECT DISTINCT episode_id, n, s FROM (SELECT episode_id, n, unnest(list_append(range(0, fin + 1, 12), fin)) AS s FROM e))
SELECT r.episode_id, r.i, CAST(count(*) AS INT) AS windows, CAST(sum(least(r.i - s + 1, s + least(16, r.n) - r.i)) AS BIGINT) AS weight_sum FROM r JOIN st ON r.episode_id = st.episode_id AND s <= r.i AND r.i < s + 16 GROUP BY 1, 2""",
    "masked_average": f"""WITH RECURSIVE {ONE}, k AS (SELECT episode_id, side, position_error_m AS e, row_number() OVER (PARTITION BY episode_id, side ORDER BY frame_idx) AS i, count(*) OVER (PARTITION BY episode_id, side) AS n FROM one WHERE position_error_m >= 0),
c AS (SELECT episode_id, side, i, n, e AS a FROM k WHERE i = 1 UNION ALL SELECT c.episode_id, c.side, k.i, c.n, 0.9 * c.a + 0.1 * k.e FROM c JOIN k ON c.episode_id = k.episode_id AND c.side = k.side AND k.i = c.i + 1)
SELECT episode_id, side, CAST(n AS INT) AS rows, round(a, 8) AS average FROM c WHERE i = n""",
    "temporal_max": f"WITH {ONE} SELECT episode_id, side, frame_idx, max(position_error_m) OVER (PARTITION BY episode_id, side ORDER BY frame_idx ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS peak FROM one",
    "jump_p95": f"WITH {ONE}, j AS (SELECT episode_id, side, abs(gripper - lag(gripper) OVER w) AS jump FROM one {_W}) SELECT episode_id, side, round(quantile_cont(jump, 0.95), 6) AS p95, round(max(jump), 6) AS most FROM j GROUP BY 1, 2",
    "chunked_frames": f"WITH {WHOLE} SELECT episode_id, CAST(floor(frame_idx / 120) AS BIGINT) AS chunk, count(*) AS frames, max(frame_idx % 120) AS last_at FROM whole GROUP BY 1, 2",
    "strided_sample": f"WITH {WHOLE} SELECT episode_id, frame_idx, round(t, 6) AS t FROM whole WHERE frame_idx % 10 = 0",
    "invariant_violations": f"""WITH {ONE}, l AS (SELECT *, lag(t) OVER w AS pt FROM one {_W})
SELECT episode_id, side, frame_idx, 'time not increasing' AS problem FROM l WHERE t <= pt UNION ALL SELECT episode_id, side, frame_idx, 'gripper out of range' FROM l WHERE NOT (gripper BETWEEN 0 AND 1)
UNION ALL SELECT episode_id, side, frame_idx, 'width negative or not finite' FROM l WHERE gripper_width_m < 0 OR isinf(gripper_width_m) OR isnan(gripper_width_m) UNION ALL SELECT episode_id, side, frame_idx, 'time not finite' FROM l WHERE isinf(t) OR isnan(t)
UNION ALL SELECT episode_id, side, frame_idx, 'position not finite' FROM l WHERE isinf(pose.x) OR isinf(pose.y) OR isinf(pose.z) OR isnan(pose.x) OR isnan(pose.y) OR isnan(pose.z)
UNION ALL SELECT episode_id, side, frame_idx, 'quaternion not normalised' FROM l WHERE abs(sqrt(pose.qx*pose.qx + pose.qy*pose.qy + pose.qz*pose.qz + pose.qw*pose.qw) - 1) > 0.001""",
    "slice_rebased": f"WITH {ONE} SELECT episode_id, side, frame_idx - 10 AS frame_idx, round(t - min(t) OVER (PARTITION BY episode_id), 6) AS t FROM one WHERE frame_idx >= 10 AND frame_idx < 60",
}

SQL["held_event_smoothstep"] = f"""WITH {ONE}, h AS (SELECT episode_id, side, frame_idx, t, round(gripper, 1) AS v FROM one WHERE gripper IS NOT NULL),
c AS (SELECT *, coalesce(abs(v - lag(v) OVER w) > 1e-12, false) AS ch, lag(t) OVER w AS pt, lag(v) OVER w AS pv FROM h {_W}),
l AS (SELECT *, last_value(CASE WHEN ch THEN t END IGNORE NULLS) OVER (PARTITION BY episode_id, side ORDER BY frame_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS lc FROM c),
n AS (SELECT *, ch AND (lc IS NULL OR t - lc > 1.0) AS nw FROM l), e AS (SELECT *, sum(CASE WHEN nw THEN 1 ELSE 0 END) OVER w AS ev, coalesce(lead(nw) OVER w, false) AS anchor FROM n {_W}),
a AS (SELECT episode_id, side, ev, max(CASE WHEN nw THEN pt END) AS t0, max(CASE WHEN nw THEN pv END) AS v0, max(CASE WHEN ch THEN t END) AS t1, arg_max(CASE WHEN ch THEN v END, CASE WHEN ch THEN t END) AS v1 FROM e GROUP BY 1, 2, 3),
u AS (SELECT e.*, a.t1, a.v0, a.v1, least(greatest((e.t - a.t0) / 0.3, 0.0), 1.0) AS u FROM e JOIN a ON e.episode_id = a.episode_id AND e.side = a.side AND e.ev = a.ev)
SELECT episode_id, side, frame_idx, round(CASE WHEN anchor THEN v WHEN ev > 0 AND t <= t1 THEN v0 + (v1 - v0) * u * u * (3 - 2 * u) ELSE v END, 5) AS smooth FROM u"""
