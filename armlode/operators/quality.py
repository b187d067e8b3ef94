"""Feasibility, audits, statistics and roll-ups."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from armlode.functions import pose as P
from armlode.operators import sequence as S
from armlode.operators.frames import active_sides, canonical, side_window
from armlode.operators.scale import stored

JOINTS = tuple(f"q{i}" for i in range(1, 8))


@dataclass(frozen=True)
class Limits:
    """What a feasible frame keeps to."""

    position_error_m: float = 0.01
    orientation_error_rad: float = 0.15
    velocity_rad_s: float = 3.0
    acceleration_rad_s2: float = 20.0
    condition: float = 500.0
    run_frames: int = 6
    joint_rad: float = 3.2
    margin_rad: float = 0.0


def joint_rates(frames: DataFrame) -> DataFrame:
    """Canonical frames with q1..q7, their rates, and ``speed`` and ``acceleration``, the greatest of a row."""
    flat = canonical(frames).withColumns({n: F.get("q", F.lit(i)) for i, n in enumerate(JOINTS)})
    d = S.rates(flat, ["episode_id", "side"], "frame_idx", "t", JOINTS)
    return d.withColumns({"speed": F.greatest(*[F.abs(F.col(f"v_{n}")) for n in JOINTS]), "acceleration": F.greatest(*[F.abs(F.col(f"a_{n}")) for n in JOINTS])})


def feasible_rows(frames: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Per row of a side ``ok``: within all limits. Rates that are not defined are not tested; a null or NaN reading fails."""
    d = joint_rates(frames)
    within = lambda c, top: F.coalesce((F.col(c) <= top) & ~F.isnan(F.col(c)), F.lit(False))
    moving = F.coalesce(F.col("speed") <= limits.velocity_rad_s, F.col("q").isNotNull()) & F.coalesce(F.col("acceleration") <= limits.acceleration_rad_s2, F.col("q").isNotNull())
    top = limits.joint_rad - limits.margin_rad
    inside = F.coalesce(F.greatest(*[F.abs(F.col(n)) for n in JOINTS]) <= top, F.lit(False))
    return d.withColumn("ok", within("position_error_m", limits.position_error_m) & within("orientation_error_rad", limits.orientation_error_rad) & within("jacobian_condition", limits.condition) & moving & inside)


def feasible_frames(frames: DataFrame, episodes: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """(episode_id, frame_idx, t, feasible): a frame is feasible when every active side's row is; short runs are not."""
    rows = feasible_rows(frames, limits).join(active_sides(episodes), ["episode_id", "side"])
    one = rows.groupBy("episode_id", "frame_idx").agg(F.min("t").alias("t"), F.bool_and("ok").alias("feasible"))
    return S.drop_short_runs(one, ["episode_id"], ["frame_idx"], "feasible", limits.run_frames)


def feasibility_report(frames: DataFrame, episodes: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Per episode: frames, feasible frames, runs of them, their share."""
    d = S.run_ids(feasible_frames(frames, episodes, limits), ["episode_id"], ["frame_idx"], "feasible")
    n = F.count_if("feasible")
    return d.groupBy("episode_id").agg(F.count("*").alias("frames"), n.alias("feasible_frames"), F.count_distinct(F.when(F.col("feasible"), F.col("run"))).alias("runs"), F.round(n / F.greatest(F.count("*"), F.lit(1)), 6).alias("feasible_fraction"))


#: Steps an octave of the scale on which values are first counted for exact quantiles.
STEPS = 16


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, shares: dict[str, float]) -> DataFrame:
    """(keys, one column a share): exact quantiles per key, between two values in proportion; nulls and NaN are left out.

    No task holds a key's values. They are counted on a logarithmic scale first, so that each wanted rank falls into one step of it;
    then only the values of those steps are counted one by one and ranked within their step. ``df`` is read twice.
    """
    v = F.col(value).cast("double")
    step = F.least(F.floor((F.log2(F.abs(v)) + 1100) * STEPS), F.lit(2200 * STEPS)).cast("int")
    rows = df.filter(v.isNotNull() & ~F.isnan(v)).select(F.to_json(F.struct(F.lit(0).alias("_"), *keys), {"ignoreNullFields": "false"}).alias("_k"), *keys, v.alias("_v"), F.when(v == 0, 0).when(v > 0, step + 1).otherwise(-step - 1).alias("_s"))
    of = Window.partitionBy("_k")
    steps = rows.groupBy("_k", "_s").agg(F.count("*").alias("n"), *[F.first(k).alias(k) for k in keys])
    steps = steps.withColumns({"ahead": F.sum("n").over(of.orderBy("_s")) - F.col("n"), "all": F.sum("n").over(of)})
    places = [F.lit(p) * (F.col("all") - 1) for p in shares.values()]
    ranks = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(c), F.ceil(c)) for c in places])))
    wanted = steps.withColumn("ranks", F.filter(ranks, lambda r: (r >= F.col("ahead")) & (r < F.col("ahead") + F.col("n")))).filter(F.size("ranks") > 0).select("_k", "_s", *keys, "ahead", "all", "ranks")
    counts = rows.select("_k", "_s", "_v").join(wanted.select("_k", "_s"), ["_k", "_s"], "left_semi").groupBy("_k", "_s", "_v").agg(F.count("*").alias("n"))
    within = counts.withColumn("upto", F.sum("n").over(Window.partitionBy("_k", "_s").orderBy("_v")))
    hit = within.join(wanted, ["_k", "_s"]).withColumn("rank", F.explode(F.filter("ranks", lambda r: (r - F.col("ahead") < F.col("upto")) & (r - F.col("ahead") >= F.col("upto") - F.col("n")))))

    def between(p: float) -> Column:
        place = F.lit(p) * (F.col("all") - 1)
        low, high = (F.max(F.when(F.col("rank") == r, F.col("_v"))) for r in (F.floor(place), F.ceil(place)))
        part = F.max(place - F.floor(place))
        return F.when(part == 0, low).otherwise(low + (high - low) * part)

    return hit.groupBy("_k", *keys).agg(*[between(p).alias(n) for n, p in shares.items()]).drop("_k")


def _beside(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Two tables of one row per key side by side; null keys are keys."""
    named = b.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in b.columns if c not in keys])
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return a.join(named, on, "left").drop(*[f"_{k}" for k in keys])


def column_statistics(df: DataFrame, keys: Sequence[str], vector: str) -> DataFrame:
    """Per key and place of a vector: least, greatest, mean, population deviation, count and five quantiles."""
    flat = stored(df.select(*keys, vector)).select(*keys, F.posexplode(vector).alias("pos", "v"))
    agg = flat.groupBy(*keys, "pos").agg(F.min("v").alias("min"), F.max("v").alias("max"), F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"), F.count("v").alias("count"))
    return _beside(agg, exact_quantiles(flat, [*keys, "pos"], "v", {"q01": 0.01, "q10": 0.1, "q50": 0.5, "q90": 0.9, "q99": 0.99}), [*keys, "pos"])


def three_numbers(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Mean, 95th percentile and greatest of a value; NaN counts as missing."""
    rows = stored(df.select(*keys, F.when(~F.isnan(value), F.col(value)).alias("_value")))
    agg = rows.groupBy(*keys).agg(F.avg("_value").alias("mean"), F.max("_value").alias("max"))
    return _beside(agg, exact_quantiles(rows, keys, "_value", {"p95": 0.95}), keys).select(*keys, "mean", "p95", "max")


def audit(frames: DataFrame, episodes: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Per source the worst readings among feasible rows of active sides, and which limits they exceed.

    The norm of quaternions is judged over all rows. (source_dataset, rows, worst values, errors, ok)
    """
    rows = feasible_rows(frames, limits)
    fine = rows.join(active_sides(episodes).withColumn("_active", F.lit(True)), ["episode_id", "side"], "left").withColumn("_use", F.col("ok") & F.coalesce("_active", F.lit(False)))
    worst = {"position_error_m": limits.position_error_m + 1e-8, "orientation_error_rad": limits.orientation_error_rad + 1e-8, "jacobian_condition": limits.condition + 1e-6, "speed": limits.velocity_rad_s + 1e-6, "acceleration": limits.acceleration_rad_s2 + 1e-6}
    _, q = P.fields("pose")
    agg = fine.groupBy("source_dataset").agg(
        F.count("*").alias("rows"), F.count_if("_use").alias("used_rows"),
        F.coalesce(F.max(F.abs(P.norm(q) - 1)), F.lit(0.0)).alias("quaternion_norm_error"),
        *[F.coalesce(F.max(F.when(F.col("_use"), F.abs(F.col(c)))), F.lit(0.0)).alias(c) for c in worst],
    )
    limits_ = {"quaternion_norm_error": 1e-5} | worst
    errors = F.array_compact(F.array(*[F.when(F.col(c) > top, F.lit(c)) for c, top in limits_.items()]))
    return agg.withColumn("errors", F.array_join(errors, ",")).withColumn("ok", F.col("errors") == "")


def rollup_means(df: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """Means per key and over all rows ('all'), unweighted."""
    agg = df.rollup(key).agg(F.grouping(key).alias("_all"), F.count("*").alias("n"), *[F.avg(v).alias(v) for v in values])
    return agg.withColumn(key, F.when(F.col("_all") == 1, "all").otherwise(F.col(key))).drop("_all")


def ratio_aggregates(df: DataFrame, keys: Sequence[str], top: Column, bottom: Column) -> DataFrame:
    """(keys, weighted, mean_of_ratios): the sum over the sum, and the mean of each row's ratio. They differ."""
    d = df.select(*keys, top.alias("_a"), bottom.alias("_b"))
    return d.groupBy(*keys).agg((F.sum("_a") / F.sum("_b")).alias("weighted"), F.avg(F.try_divide("_a", "_b")).alias("mean_of_ratios"))


def best_per_group(df: DataFrame, keys: Sequence[str], score: str, ties: Sequence[str]) -> DataFrame:
    """The row of each key with the greatest score; of equal ones the first by ``ties``."""
    w = Window.partitionBy(*keys).orderBy(F.desc_nulls_last(score), *ties)
    return df.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def worst(df: DataFrame, score: str, tie: str, k: int = 10) -> DataFrame:
    """The ``k`` rows of greatest score, of equal ones the later: a top-k, no full sort."""
    return df.orderBy(F.desc(score), F.desc(tie)).limit(k)


def path_length(frames: DataFrame) -> DataFrame:
    """(episode_id, side, metres): the way that each side's position takes."""
    w = side_window()
    p, _ = P.fields("pose")
    step = P.norm([c - F.lag(c).over(w) for c in p])
    return canonical(frames).withColumn("_s", step).groupBy("episode_id", "side").agg(F.coalesce(F.sum("_s"), F.lit(0.0)).alias("metres"))
