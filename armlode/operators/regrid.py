"""Irregular readings onto each episode's regular grid, by a Kalman smoother with a local linear trend."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from armlode.operators.frames import finite_or_null
from armlode.operators.scale import bounded_broadcast, map_sorted_groups, stored, with_blocks, union_rows
from armlode.sources.tables import source_key

POSE = ("x", "y", "z", "qx", "qy", "qz", "qw")
DIMS = (*POSE, "gripper")
#: Slots per block of one side's series, and the slots on either side whose readings a block also sees.
BLOCK, HALO = 4096, 128
#: Readings before and after a block that it takes whatever their distance, of pose and of gripper.
FAR = 64
#: Noise of a source without enough readings: of a reading, and its trend's wandering per second cubed.
LEAST_NOISE, LEAST_WANDER = 1e-4, 1e-3

SCHEMA = "episode_id long, side byte, slot long, t double, missing boolean, x double, y double, z double, qx double, qy double, qz double, qw double, gripper double, pose_sd_m double, rotation_sd double, gripper_sd double"


def episode_grids(frames: DataFrame, episodes: DataFrame, source_config: DataFrame) -> DataFrame:
    """(episode_id, t0, fps, last_slot, source, sides) of every episode that has a row with a time.

    ``fps`` is the episode's, or where null or not positive its source's. An episode without
    either has no grid. Of repeated episode rows the smallest ``fps`` counts.
    """
    spans = (
        frames.filter("episode_id is not null and side is not null")
        .groupBy("episode_id")
        .agg(F.min("t").alias("t0"), F.max("t").alias("t1"), F.collect_set("side").alias("sides"), F.min(source_key("source_dataset")).alias("frame_source"))
        .filter("t0 is not null")
    )
    own = episodes.groupBy("episode_id").agg(F.min(F.when(F.col("fps") > 0, F.col("fps"))).alias("own_fps"), F.min(source_key("source_dataset")).alias("own_source"))
    rates = source_config.groupBy(source_key("name").alias("source")).agg(F.min(F.when(F.col("fps") > 0, F.col("fps"))).alias("source_fps"))
    joined = spans.join(own, "episode_id", "left").withColumn("source", F.coalesce("own_source", "frame_source"))
    return (
        joined.join(bounded_broadcast(rates), "source", "left")
        .withColumn("fps", F.coalesce("own_fps", "source_fps"))
        .filter("fps is not null")
        .select("episode_id", "source", "t0", "fps", slot_of("t1").alias("last_slot"), "sides")
    )


def slot_of(t: str) -> Column:
    """The slot nearest to a time; half way goes up."""
    return F.floor((F.col(t) - F.col("t0")) * F.col("fps") + 0.5).cast("long")


def readings(frames: DataFrame, grids: DataFrame) -> DataFrame:
    """Rows with a time, with their slot; of rows of one side and time one is kept."""
    flat = frames.filter("t is not null").select("episode_id", "side", "t", *[F.col(f"pose.{k}").alias(k) for k in POSE], "gripper")
    return flat.join(grids.select("episode_id", "source", "t0", "fps", "last_slot"), "episode_id").withColumn("slot", slot_of("t"))


def far_readings(rows: DataFrame, heads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What each block of ``heads`` takes from beyond its halo: the nearest readings, and the sign of its quaternions.

    The first result, (episode_id, side, _block, t, slot, values), has the ``FAR`` poses and grippers nearest before and after
    a block, over however many blocks. Each block keeps its first and last ones; windows over one row a block
    hand them on. The second, (episode_id, side, _block, anchor_t, anchor_sign), says by what sign the last pose before a block
    is multiplied when the signs of a whole series are made continuous.
    """
    series, keys = ["episode_id", "side"], ["episode_id", "side", "_block"]
    core = rows.filter(F.col("last_slot") >= BLOCK).withColumn("_block", F.floor(F.col("slot") / BLOCK).cast("long"))
    blocks = heads.select(*keys, "first", "last")
    of, within = Window.partitionBy(*series).orderBy("_block"), Window.partitionBy(*keys)
    earlier, later = of.rowsBetween(Window.unboundedPreceding, -1), of.rowsBetween(1, Window.unboundedFollowing)
    ending = lambda c: F.reverse(F.slice(F.reverse(c), 1, FAR))
    quat = POSE[3:]
    turned = lambda a, b: F.when(sum((a[k] * b[k] for k in quat[1:]), a[quat[0]] * b[quat[0]]) < 0, 1).otherwise(0)
    far = anchors = None
    for names in (POSE, ("gripper",)):
        have = core.filter(F.coalesce(*names).isNotNull()).select(*keys, F.struct("t", "slot", *names).alias("r"))
        ends = have.withColumns({"up": F.row_number().over(within.orderBy("r")), "down": F.row_number().over(within.orderBy(F.desc("r")))})
        aggs = [F.array_sort(F.collect_list(F.when(F.col("down") <= FAR, F.col("r")))).alias("before"), F.array_sort(F.collect_list(F.when(F.col("up") <= FAR, F.col("r")))).alias("after")]
        if names == POSE:
            ends = ends.withColumn("flip", turned(F.col("r"), F.lag("r").over(within.orderBy("r"))))
            aggs += [F.sum("flip").alias("flips")]
        kept = ends.groupBy(*keys).agg(*aggs)
        handed = {"before": ending(F.flatten(F.collect_list("before").over(of.rowsBetween(1 - FAR, 0)))), "after": F.slice(F.flatten(F.collect_list("after").over(of.rowsBetween(0, FAR - 1))), 1, FAR)}
        if names == POSE:
            across = turned(F.get("after", F.lit(0)), F.lag(F.element_at("before", -1)).over(of))
            kept = kept.withColumn("turns", F.col("flips") + across).withColumn("turns", F.sum("turns").over(of.rowsBetween(Window.unboundedPreceding, 0)))
            handed["anchor"] = F.struct(F.element_at("before", -1)["t"].alias("t"), F.when(F.col("turns") % 2 == 0, 1.0).otherwise(-1.0).alias("sign"))
        near = blocks.join(kept.withColumns(handed), keys, "left")
        if names == POSE:
            last = F.last("anchor", ignorenulls=True).over(earlier)
            anchors = near.select(*keys, last["t"].alias("anchor_t"), last["sign"].alias("anchor_sign"))
        near = near.select(*keys, "first", "last", F.last("before", ignorenulls=True).over(earlier).alias("before"), F.first("after", ignorenulls=True).over(later).alias("after"))
        none = F.array().cast(near.schema["before"].dataType)
        taken = near.select(*keys, "first", "last", F.explode(F.concat(F.coalesce("before", none), F.coalesce("after", none))).alias("r")).select(*keys, "first", "last", "r.*")
        taken = taken.filter((F.col("slot") < F.col("first") - HALO) | (F.col("slot") > F.col("last") + HALO)).drop("first", "last")
        far = taken if far is None else union_rows(far, taken)
    return far, anchors


def noise(rows: DataFrame) -> DataFrame:
    """Per source the noise of a reading and the wandering of its trend, for position, rotation and gripper.

    Both come from the medians of how far a reading lies off the middle of its neighbours, one
    and two rows away: the first is mostly reading noise, the second has eight times the trend's part.
    """
    order = Window.partitionBy("episode_id", "side", "_block").orderBy("t")
    groups = {"pose": ("x", "y", "z"), "rot": ("qx", "qy", "qz", "qw"), "grip": ("gripper",)}

    def off(k: int, names: tuple[str, ...]) -> Column:
        parts = [F.col(n) - (F.lag(n, k).over(order) + F.lead(n, k).over(order)) / 2 for n in names]
        return F.sqrt(sum((p * p for p in parts[1:]), parts[0] * parts[0]) / len(names))

    steps = rows.select("source", "_core", F.least((F.lead("t").over(order) - F.lag("t").over(order)) / 2, F.lit(10.0)).alias("dt"), *[off(k, n).alias(f"{g}{k}") for g, n in groups.items() for k in (1, 2)]).filter("_core")
    median = lambda c: F.percentile_approx(F.when(~F.isnan(c), F.col(c)), 0.5, 1000)
    meds = steps.groupBy("source").agg(median("dt").alias("dt"), *[median(f"{g}{k}").alias(f"{g}{k}") for g in groups for k in (1, 2)])
    out = []
    for g in groups:
        v1, v2 = (1.4826 * F.col(f"{g}1")) ** 2, (1.4826 * F.col(f"{g}2")) ** 2
        trend = F.greatest((v2 - v1) / 7, F.lit(0.0))
        out.append(F.greatest(F.sqrt(F.greatest(v1 - trend, F.lit(0.0)) / 1.5), F.lit(LEAST_NOISE)).alias(f"{g}_r"))
        out.append(F.greatest(6 * trend / F.greatest(F.col("dt"), F.lit(1e-3)) ** 3, F.lit(LEAST_WANDER)).alias(f"{g}_q"))
    return meds.select("source", *out)


def _smooth(t: np.ndarray, z: np.ndarray, r: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Level and its variance at every time of many series at once.

    t [T, G] times in order (the last repeats as padding), z [T, G, D] readings or NaN, r and q
    [G, D] variances. A forward Kalman pass and a backward smoothing pass over level and slope.
    """
    T, G, D = z.shape
    level = np.nan_to_num(np.take_along_axis(z, np.argmax(~np.isnan(z), axis=0)[None], axis=0)[0])
    slope = np.zeros((G, D))
    p00, p01, p11 = np.full((G, D), 1e2), np.zeros((G, D)), np.full((G, D), 1e2)
    keep = np.empty((5, T, G, D))
    ahead = np.empty((5, T, G, D))
    for i in range(T):
        if i:
            dt = (t[i] - t[i - 1])[:, None]
            level = level + dt * slope
            p00 = p00 + dt * (2 * p01 + dt * p11) + q * dt**3 / 3
            p01 = p01 + dt * p11 + q * dt**2 / 2
            p11 = p11 + q * dt
        ahead[:, i] = level, slope, p00, p01, p11
        seen = ~np.isnan(z[i])
        k = np.where(seen, 1 / (p00 + r), 0.0)
        e = np.where(seen, z[i] - level, 0.0)
        k0, k1 = p00 * k, p01 * k
        level, slope = level + k0 * e, slope + k1 * e
        p00, p01, p11 = (1 - k0) * p00, (1 - k0) * p01, p11 - k1 * p01
        keep[:, i] = level, slope, p00, p01, p11
    s_level, s_slope, s00, s01, s11 = keep[:, -1].copy()
    out, var = np.empty((T, G, D)), np.empty((T, G, D))
    out[-1], var[-1] = s_level, s00
    for i in range(T - 2, -1, -1):
        dt = (t[i + 1] - t[i])[:, None]
        level, slope, p00, p01, p11 = keep[:, i]
        a_level, a_slope, a00, a01, a11 = ahead[:, i + 1]
        det = np.maximum(a00 * a11 - a01**2, 1e-300)
        c00, c01 = p00 + dt * p01, p01
        c10, c11 = p01 + dt * p11, p11
        g00, g01 = (c00 * a11 - c01 * a01) / det, (c01 * a00 - c00 * a01) / det
        g10, g11 = (c10 * a11 - c11 * a01) / det, (c11 * a00 - c10 * a01) / det
        d0, d1 = s_level - a_level, s_slope - a_slope
        e00, e01, e11 = s00 - a00, s01 - a01, s11 - a11
        s_level, s_slope = level + g00 * d0 + g01 * d1, slope + g10 * d0 + g11 * d1
        s00 = p00 + g00 * (g00 * e00 + g01 * e01) + g01 * (g00 * e01 + g01 * e11)
        s01 = p01 + g10 * (g00 * e00 + g01 * e01) + g11 * (g00 * e01 + g01 * e11)
        s11 = p11 + g10 * (g10 * e00 + g11 * e01) + g11 * (g10 * e01 + g11 * e11)
        out[i], var[i] = s_level, s00
    return out, np.maximum(var, 0.0)


def _batches(sizes: np.ndarray, cells: int) -> list[np.ndarray]:
    """Series numbers by size, in batches of at most ``cells`` padded places."""
    order, out, start = np.argsort(-sizes, kind="stable"), [], 0
    while start < len(order):
        n = max(1, cells // max(1, int(sizes[order[start]])))
        out.append(order[start : start + n])
        start += n
    return out


def _fill(rows: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
    """Grid rows of whole series. ``kind`` 0: the block's header, 1: a reading."""
    lo, hi = starts[:-1], starts[1:]
    kind = rows["kind"].to_numpy()
    headed = kind[lo] == 0
    lo, hi = lo[headed], hi[headed]
    if not len(lo):
        return pd.DataFrame(columns=[c.split()[0] for c in SCHEMA.split(", ")])
    col = {c: rows[c].to_numpy() for c in rows.columns}
    t0, fps, first, last = (col[c][lo] for c in ("t0", "fps", "first", "last"))
    grid = (last - first + 1).astype(int)
    sizes = hi - lo - 1 + grid
    params = np.stack([col[c][lo] for c in ("pose_r", "pose_q", "rot_r", "rot_q", "grip_r", "grip_q")], axis=1).astype(float)
    values = np.stack([col[c].astype(float) for c in DIMS], axis=1)
    parts = []
    for chosen in _batches(sizes, 40_000):
        T, G, D = int(sizes[chosen].max()), len(chosen), len(DIMS)
        t, z = np.zeros((T, G)), np.full((T, G, D), np.nan)
        at = []
        for j, g in enumerate(chosen):
            own = slice(lo[g] + 1, hi[g])
            slots = np.arange(first[g], last[g] + 1)
            times = np.concatenate([col["t"][own].astype(float) - t0[g], slots / fps[g]])
            order = np.argsort(times, kind="stable")
            n, m = len(times), hi[g] - lo[g] - 1
            t[:n, j], t[n:, j] = times[order], times[order[-1]]
            v = values[own].copy()
            turned = np.flatnonzero(~np.isnan(v[:, 3:7]).all(axis=1))
            if len(turned):
                flip = np.nansum(v[turned[1:], 3:7] * v[turned[:-1], 3:7], axis=1)
                sign = np.append(1.0, np.cumprod(np.where(flip < 0, -1.0, 1.0)))
                known = np.flatnonzero(col["t"][own][turned] == col["anchor_t"][lo[g]])
                if len(known):
                    sign *= sign[known[-1]] * col["anchor_sign"][lo[g]]
                v[turned, 3:7] *= sign[:, None]
            place = np.empty(n, dtype=int)
            place[order] = np.arange(n)
            z[place[:m], j] = v
            at.append((g, slots, place[m:], np.isin(slots, col["slot"][own])))
        p = params[chosen]
        r = np.concatenate([np.repeat(p[:, [0]], 3, 1), np.repeat(p[:, [2]], 4, 1), p[:, [4]]], axis=1) ** 2
        q = np.concatenate([np.repeat(p[:, [1]], 3, 1), np.repeat(p[:, [3]], 4, 1), p[:, [5]]], axis=1)
        level, var = _smooth(t, z, r, q)
        level = np.where(np.isnan(z).all(axis=0)[None], np.nan, level)
        for j, (g, slots, place, seen) in enumerate(at):
            x, sd = level[place, j], np.sqrt(var[place, j])
            norm = np.linalg.norm(x[:, 3:7], axis=1)
            x[:, 3:7] /= np.where(norm > 1e-9, norm, 1.0)[:, None]
            x[:, 7] = np.clip(x[:, 7], 0.0, 1.0)
            k = len(slots)
            parts.append((np.full(k, col["episode_id"][lo[g]]), np.full(k, col["side"][lo[g]]), slots, t0[g] + slots / fps[g], ~seen, *x.T, np.linalg.norm(sd[:, :3], axis=1), np.linalg.norm(sd[:, 3:7], axis=1), sd[:, 7]))
    return pd.DataFrame({c.split()[0]: np.concatenate(v) for c, v in zip(SCHEMA.split(", "), zip(*parts))})


def regular_grid(frames: DataFrame, episodes: DataFrame, source_config: DataFrame) -> DataFrame:
    """Pose and gripper of each side on its episode's grid, filled by a smoother and marked where missing.

    One row per side that has rows in the episode and slot 0 to the last slot read by any side:
    (episode_id, side, slot, t, missing, pose and gripper, their standard deviations). Slot k lies
    at t0 + k / fps. ``missing`` means that no reading of this side is nearest to the slot. The
    values come from a Kalman smoother over level and slope in continuous time, with the noise of
    the source; they are null (NaN) only where the side has no reading at all.

    Rows without a finite time are no readings but show that the side is there. A null pose or gripper
    is no value at that time. Rows sent again repeat a reading. Episodes without any time or rate
    have no grid. Empty tables give no rows, extra columns are ignored. Series longer than
    4096 slots are cut into blocks which also see the readings of 128 slots on either side, and beyond
    them the ``FAR`` nearest readings before and after, wherever they lie: as a smoother forgets what lies 64 readings away, the
    result is that of the whole series. Signs of quaternions run on over blocks.
    """
    frames = frames.withColumn("t", finite_or_null(F.col("t")))
    grids = stored(episode_grids(frames, episodes, source_config))
    placed = stored(readings(frames, grids))
    rows = with_blocks(placed, "slot", BLOCK, HALO)
    params = bounded_broadcast(noise(rows))
    names = ["pose_r", "pose_q", "rot_r", "rot_q", "grip_r", "grip_q"]
    top = F.floor(F.col("last_slot") / BLOCK)
    heads = (
        grids.withColumn("side", F.explode("sides"))
        .withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), top.cast("long"))))
        .join(params, "source", "left")
        .select(
            "episode_id", "side", "_block", F.lit(0).alias("kind"), "t0", "fps", (F.col("_block") * BLOCK).alias("first"), F.least("last_slot", (F.col("_block") + 1) * BLOCK - 1).alias("last"),
            top.alias("top"), *[F.coalesce(c, F.lit(LEAST_WANDER if c.endswith("q") else LEAST_NOISE)).alias(c) for c in names],
        )
    )
    given = rows.select("episode_id", "side", "_block", F.lit(1).alias("kind"), "t", "slot", *DIMS)
    far, anchors = far_readings(placed, heads.filter(F.col("top") > 0))
    given = union_rows(given, far.withColumn("kind", F.lit(1)))
    led = heads.drop("top").join(anchors, ["episode_id", "side", "_block"], "left")
    return map_sorted_groups(union_rows(led, given), ["episode_id", "side", "_block"], ["kind", "t", *DIMS], _fill, SCHEMA)


def missing_slots(frames: DataFrame, episodes: DataFrame, source_config: DataFrame) -> DataFrame:
    """The grid times without a reading: (episode_id, side, slot) of :func:`regular_grid` that are missing."""
    return regular_grid(frames, episodes, source_config).filter("missing").select("episode_id", "side", "slot")
