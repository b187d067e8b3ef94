"""Operators along an episode: rates, runs, events, budgets, windows, smoothing.

Every window is partitioned by the episode's key first, so a chain of them runs on one shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from armlode.functions import pose as P


def ordered(keys: Sequence[str], order: Sequence[str]) -> Window:
    return Window.partitionBy(*keys).orderBy(*order)


def durations(df: DataFrame, keys: Sequence[str], order: str, t: str) -> DataFrame:
    """Per key: frames, median step, span plus one step, and whether time strictly increases.

    A single frame lasts 1/30 s.
    """
    w = ordered(keys, [order])
    steps = df.withColumn("_dt", F.col(t) - F.lag(t).over(w))
    agg = steps.groupBy(*keys).agg(F.count("*").alias("frames"), F.percentile("_dt", 0.5).alias("period"), F.min(t).alias("_first"), F.max(t).alias("_last"), F.coalesce(F.bool_and(F.col("_dt") > 0), F.lit(True)).alias("increasing"))
    period = F.coalesce("period", F.lit(1 / 30))
    return agg.select(*keys, "frames", period.alias("period"), (F.col("_last") - F.col("_first") + period).alias("duration"), "increasing")


def rebase(df: DataFrame, keys: Sequence[str], t: str, out: str) -> DataFrame:
    """Time from the first of its key. Integer nanoseconds are subtracted as integers, then divided."""
    return df.withColumn(out, F.col(t) - F.min(t).over(Window.partitionBy(*keys)))


def rates(df: DataFrame, keys: Sequence[str], order: str, t: str, values: Sequence[str]) -> DataFrame:
    """Adds ``v_*`` and ``a_*``: first and second differences over uneven time.

    v of the first row and a of the first two are 0; steps without time give null.
    """
    w = ordered(keys, [order])
    dt = F.col(t) - F.lag(t).over(w)
    d = df.withColumns({"_i": F.row_number().over(w) - 1, "_dt": dt}).withColumns({f"v_{c}": F.when(F.col("_i") == 0, 0.0).otherwise(F.try_divide(F.col(c) - F.lag(c).over(w), F.col("_dt"))) for c in values})
    mid = (F.col("_dt") + F.lag("_dt").over(w)) / 2
    return d.withColumns({f"a_{c}": F.when(F.col("_i") < 2, 0.0).otherwise(F.try_divide(F.col(f"v_{c}") - F.lag(f"v_{c}").over(w), mid)) for c in values})


def run_ids(df: DataFrame, keys: Sequence[str], order: Sequence[str], flag: str, out: str = "run") -> DataFrame:
    """Numbers the maximal stretches of equal ``flag``."""
    w = ordered(keys, order)
    change = F.when(F.col(flag).eqNullSafe(F.lag(flag).over(w)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    return df.withColumn("_change", change).withColumn(out, F.sum("_change").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_change")


def drop_short_runs(df: DataFrame, keys: Sequence[str], order: Sequence[str], flag: str, least: int) -> DataFrame:
    """Turns runs of True shorter than ``least`` to False; runs of False stay."""
    d = run_ids(df, keys, order, flag, "_run")
    n = F.count("*").over(Window.partitionBy(*keys, "_run"))
    return d.withColumn(flag, F.col(flag) & (n >= least)).drop("_run")


def extract_runs(df: DataFrame, keys: Sequence[str], order: str, flag: str) -> DataFrame:
    """(keys, start, end, frames) of every maximal run of True, end exclusive, in row numbers from 0."""
    w = ordered(keys, [order])
    d = run_ids(df.withColumn("_i", F.row_number().over(w) - 1), keys, [order], flag, "_run").filter(F.col(flag))
    return d.groupBy(*keys, "_run").agg(F.min("_i").cast("long").alias("start"), (F.max("_i") + 1).cast("long").alias("end"), F.count("*").alias("frames")).drop("_run")


def continuous_quaternions(df: DataFrame, keys: Sequence[str], order: str, names: Sequence[str] = ("qx", "qy", "qz", "qw")) -> DataFrame:
    """Unit quaternions whose signs make every consecutive dot product non-negative.

    Each is first put in the half with w >= 0. The sign is the parity of the negative dot products
    since the last dot of exactly 0, where the chain starts anew.
    """
    w = ordered(keys, [order])
    unit = P.normalize([F.col(n) for n in names])
    d = df.withColumns({f"_{n}": c for n, c in zip(names, unit)})
    dot = P.dot([F.col(f"_{n}") for n in names], [F.lag(f"_{n}").over(w) for n in names])
    d = d.withColumn("_dot", dot).withColumn("_anew", F.sum(F.when(F.col("_dot") == 0, 1).otherwise(0)).over(w))
    part = Window.partitionBy(*keys, "_anew").orderBy(order)
    flips = F.sum(F.when(F.col("_dot") < 0, 1).otherwise(0)).over(part)
    sign = F.when(flips % 2 == 0, 1.0).otherwise(-1.0)
    return d.withColumn("_sign", sign).withColumns({n: F.col(f"_{n}") * F.col("_sign") for n in names}).drop("_dot", "_anew", "_sign", *[f"_{n}" for n in names])


def smoothstep_events(df: DataFrame, keys: Sequence[str], order: str, t: str, value: str, max_gap: float, duration: float, out: str) -> DataFrame:
    """Replaces held, stepwise changes by smooth transitions.

    Changes no further apart than ``max_gap`` form one event, anchored at the frame before its first
    change. Within [anchor, last change] the value runs from the anchor's to the last's as u^2 (3 - 2u), u the time since
    the anchor over ``duration``, at most 1. Where two events share a frame the later one holds.
    """
    w = ordered(keys, [order])
    ahead = w.rowsBetween(1, Window.unboundedFollowing)
    changed = F.abs(F.col(value) - F.lag(value).over(w)) > 1e-12
    d = df.withColumns({"_c": F.coalesce(changed, F.lit(False)), "_pt": F.lag(t).over(w), "_pv": F.lag(value).over(w)})
    last_change = F.last(F.when(F.col("_c"), F.col(t)), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = F.col("_c") & (last_change.isNull() | (F.col(t) - last_change > max_gap))
    d = d.withColumn("_new", new).withColumn("_event", F.sum(F.when(F.col("_new"), 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    one = Window.partitionBy(*keys, "_event")
    d = d.withColumns({
        "_t0": F.max(F.when(F.col("_new"), F.col("_pt"))).over(one), "_v0": F.max(F.when(F.col("_new"), F.col("_pv"))).over(one),
        "_t1": F.max(F.when(F.col("_c"), F.col(t))).over(one), "_v1": F.max_by(F.when(F.col("_c"), F.col(value)), F.when(F.col("_c"), F.col(t))).over(one),
    })
    # the anchor frame belongs to the event that starts on the next row: its value there is the anchor's own
    anchored = F.coalesce(F.lead("_new").over(w), F.lit(False))
    u = F.least(F.greatest((F.col(t) - F.col("_t0")) / duration, F.lit(0.0)), F.lit(1.0))
    moved = F.col("_v0") + (F.col("_v1") - F.col("_v0")) * u * u * (3 - 2 * u)
    inside = (F.col("_event") > 0) & (F.col(t) <= F.col("_t1"))
    return d.withColumn(out, F.when(anchored, F.col(value)).when(inside, moved).otherwise(F.col(value))).drop("_c", "_pt", "_pv", "_new", "_event", "_t0", "_v0", "_t1", "_v1")


def budget_prefix(df: DataFrame, keys: Sequence[str], order: Sequence[str], size: str, budget: float) -> DataFrame:
    """The first rows of each key whose sizes reach ``budget``, with the one that crosses it; ``before`` is the sum ahead of a row."""
    w = ordered(keys, order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("before", F.coalesce(F.sum(size).over(w), F.lit(0))).filter(F.col("before") < budget)


def best_window(df: DataFrame, keys: Sequence[str], order: str, step: str, good: str, frames: int) -> DataFrame:
    """Per key the window of ``frames`` rows with most motion, weighted by the square of its good share.

    ``step`` is the motion from a row to the next. The first of equal windows is taken; a shorter key is one window.
    """
    w = ordered(keys, [order])
    d = df.withColumns({"_i": F.row_number().over(w) - 1, "_n": F.count("*").over(Window.partitionBy(*keys))})
    move = F.sum(step).over(w.rowsBetween(0, frames - 2)) if frames > 1 else F.lit(0.0)
    share = F.avg(F.col(good).cast("double")).over(w.rowsBetween(0, frames - 1))
    d = d.withColumn("score", F.coalesce(move, F.lit(0.0)) * share * share).filter((F.col("_i") + frames <= F.col("_n")) | (F.col("_i") == 0))
    best = d.groupBy(*keys).agg(F.max_by(F.struct("_i", "_n", "score"), F.struct(F.round("score", 9), -F.col("_i"))).alias("b"))
    return best.select(*keys, F.col("b._i").cast("long").alias("start"), F.least(F.col("b._i") + frames, F.col("b._n")).cast("long").alias("end"), F.col("b.score").alias("score"))


def balanced_ranges(df: DataFrame, keys: Sequence[str], order: str, parts: int) -> DataFrame:
    """Contiguous ranges of nearly equal length, the longer ones first: (keys, part, start, end)."""
    w = ordered(keys, [order])
    d = df.withColumns({"part": F.ntile(parts).over(w), "_i": F.row_number().over(w) - 1})
    return d.groupBy(*keys, "part").agg(F.min("_i").cast("long").alias("start"), (F.max("_i") + 1).cast("long").alias("end"))


def motion(df: DataFrame, keys: Sequence[str], order: str, lever: float = 0.1) -> DataFrame:
    """(keys, motion): path of the position plus ``lever`` times the angle turned."""
    w = ordered(keys, [order])
    p, q = P.fields("pose")
    before = F.lag("pose").over(w)
    d = df.withColumn("_before", before)
    p0, q0 = P.fields("_before")
    step = P.norm([a - b for a, b in zip(p, p0)]) + lever * P.angle(q, q0)
    return d.groupBy(*keys).agg(F.coalesce(F.sum(step), F.lit(0.0)).alias("motion"))


def moving_sides(motions: DataFrame, episode: str = "episode_id", least: float = 0.01, share: float = 0.05) -> DataFrame:
    """Adds ``moves``: at least ``least`` and ``share`` of the most moving side; where nothing moves, every side."""
    most = F.max("motion").over(Window.partitionBy(episode))
    return motions.withColumn("moves", F.when(most < 1e-6, True).otherwise((F.col("motion") >= F.greatest(F.lit(least), most * share)) | ((most < least) & (F.col("motion") == most))))


def masked_average(df: DataFrame, keys: Sequence[str], order: str, value: str, weight: float, usable: Column, out: str) -> DataFrame:
    """Per key the exponential average after its last usable row: c <- (1 - weight) c + weight x, from the first usable x.

    The recurrence is a weighted sum: a row j places before the last weighs weight (1 - weight)^j, the first one (1 - weight)^j. No
    key's rows are collected.
    """
    kept = df.filter(usable).select(*keys, F.col(order).alias("_o"), F.col(value).cast("double").alias("_x"))
    back = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("_o"), F.desc("_x"))) - 1
    placed = kept.withColumns({"_j": back, "_n": F.count("*").over(Window.partitionBy(*keys))})
    share = F.pow(F.lit(1.0 - weight), F.col("_j")) * F.when(F.col("_j") == F.col("_n") - 1, 1.0).otherwise(weight)
    return placed.groupBy(*keys).agg(F.count("*").cast("int").alias("rows"), F.sum(F.col("_x") * share).alias(out))


def smooth_track(df: DataFrame, keys: Sequence[str], order: str, value: str, out: str) -> DataFrame:
    """Fills gaps linearly by row number (ends hold), then a median of 7 and a Gaussian of 1.25 rows, ends repeated."""
    from math import exp

    w = ordered(keys, [order])
    back, ahead = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    d = df.withColumn("_i", F.row_number().over(w).cast("double"))
    at = F.when(F.col(value).isNotNull(), F.col("_i"))
    d = d.withColumns({"_a": F.last(value, True).over(back), "_ai": F.last(at, True).over(back), "_b": F.first(value, True).over(ahead), "_bi": F.first(at, True).over(ahead)})
    line = F.col("_a") + (F.col("_b") - F.col("_a")) * F.try_divide(F.col("_i") - F.col("_ai"), F.col("_bi") - F.col("_ai"))
    d = d.withColumn("_f", F.when(F.col("_a").isNull(), F.col("_b")).when(F.col("_b").isNull() | (F.col("_ai") == F.col("_bi")), F.col("_a")).otherwise(line))
    first, last = F.first("_f").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)), F.last("_f").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    near = lambda c, k: F.coalesce(F.lag(c, -k).over(w) if k else F.col(c), F.col("_first") if k < 0 else F.col("_last"))
    d = d.withColumns({"_first": first, "_last": last})
    d = d.withColumn("_m", F.get(F.array_sort(F.array(*[near("_f", k) for k in range(-3, 4)])), F.lit(3)))
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    d = d.withColumns({"_first": F.first("_m").over(whole), "_last": F.last("_m").over(whole)})
    taps = [exp(-0.5 * (k / 1.25) ** 2) for k in range(-5, 6)]
    total = sum(taps)
    smooth = sum((near("_m", k) * (g / total) for k, g in zip(range(-4, 6), taps[1:])), near("_m", -5) * (taps[0] / total))
    return d.withColumn(out, smooth).drop("_i", "_a", "_ai", "_b", "_bi", "_f", "_first", "_last", "_m")


def rolling_max(df: DataFrame, keys: Sequence[str], order: str, value: str, radius: int, out: str) -> DataFrame:
    """The greatest of the rows up to ``radius`` away, ends cut."""
    return df.withColumn(out, F.max(value).over(ordered(keys, [order]).rowsBetween(-radius, radius)))


def overlap_windows(df: DataFrame, keys: Sequence[str], order: str, size: int, stride: int) -> DataFrame:
    """(keys, i, windows, weight_sum): the overlapping windows over each row and their triangular weights.

    Windows start on the stride's grid, the last one ends with the key. A row at place j of a window weighs
    the distance to the nearer end, from 1.
    """
    w = ordered(keys, [order])
    rows = df.withColumns({"i": F.row_number().over(w) - 1, "_n": F.count("*").over(Window.partitionBy(*keys))})
    final = F.greatest(F.col("_n") - size, F.lit(0))
    # of the starts only those whose window is over the row: at most size / stride of the grid, and the last one
    low = F.greatest(F.floor((F.col("i") - size) / stride) + 1, F.lit(0)).cast("long")
    high = F.least(F.floor(F.col("i") / stride), F.floor(final / stride)).cast("long")
    none = F.array().cast("array<bigint>")
    grid = F.when(low <= high, F.transform(F.sequence(low, high, F.lit(1).cast("long")), lambda k: k * stride)).otherwise(none)
    tail = F.when((final % stride != 0) & (F.col("i") >= final) & (F.col("i") < final + size), F.array(final.cast("long"))).otherwise(none)
    over = F.concat(grid, tail)
    length = F.least(F.lit(size), F.col("_n"))
    weight = F.aggregate(over, F.lit(0.0), lambda acc, s: acc + F.least(F.col("i") - s + 1, s + length - F.col("i")).cast("double"))
    return rows.select(*keys, F.col("i").cast("long").alias("i"), F.size(over).alias("windows"), weight.alias("weight_sum"))


def chunks(df: DataFrame, frame: str, size: int) -> DataFrame:
    """Adds ``chunk`` and ``at``: fixed-size chunks of frame numbers and the place within."""
    return df.withColumns({"chunk": F.floor(F.col(frame) / size).cast("long"), "at": F.pmod(F.col(frame), F.lit(size)).cast("long")})


def strided(df: DataFrame, frame: str, stride: int) -> DataFrame:
    return df.filter(F.col(frame) % stride == 0)


def number_globally(df: DataFrame, bucket: Column, order: Sequence[str], out: str) -> DataFrame:
    """Adds a number from 0 over all rows in the order of (bucket, order), without one task that holds them all.

    ``bucket`` must rise with ``order``. Buckets are counted, the counts (one row per bucket) are summed up, and
    rows are numbered within their bucket.
    """
    d = df.withColumn("_bucket", bucket)
    sums = d.groupBy("_bucket").agg(F.count("*").alias("_n"))
    base = sums.select("_bucket", F.coalesce(F.sum("_n").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    w = Window.partitionBy("_bucket").orderBy(*order)
    return d.join(base, "_bucket").withColumn(out, (F.col("_base") + F.row_number().over(w) - 1).cast("bigint")).drop("_bucket", "_base")
