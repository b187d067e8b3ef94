"""Fitting and applying workspace registrations: sums on Spark, small matrices on one row per group."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from armlode.functions import pose as P

POSE7 = "struct<x:double,y:double,z:double,qx:double,qy:double,qz:double,qw:double>"


def _quaternion(m: np.ndarray) -> np.ndarray:
    """xyzw with w >= 0 of rotation matrices [n, 3, 3]: the eigenvector of a symmetric form, stable at every angle."""
    k = np.empty((len(m), 4, 4))
    xx, yy, zz = m[:, 0, 0], m[:, 1, 1], m[:, 2, 2]
    k[:, 0] = np.stack([xx - yy - zz, m[:, 0, 1] + m[:, 1, 0], m[:, 0, 2] + m[:, 2, 0], m[:, 2, 1] - m[:, 1, 2]], 1)
    k[:, 1] = np.stack([k[:, 0, 1], yy - xx - zz, m[:, 1, 2] + m[:, 2, 1], m[:, 0, 2] - m[:, 2, 0]], 1)
    k[:, 2] = np.stack([k[:, 0, 2], k[:, 1, 2], zz - xx - yy, m[:, 1, 0] - m[:, 0, 1]], 1)
    k[:, 3] = np.stack([k[:, 0, 3], k[:, 1, 3], k[:, 2, 3], xx + yy + zz], 1)
    q = np.linalg.eigh(k)[1][:, :, -1]
    return q * np.where(q[:, 3:] < 0, -1.0, 1.0)


def rotation_means(df: DataFrame, keys: Sequence[str], q: Sequence[Column]) -> DataFrame:
    """(keys, qx, qy, qz, qw): the chordal mean of unit quaternions, whatever their signs.

    The ten sums of q q^T are partial aggregates; only a 4x4 eigenvector per key is left to Python.
    """
    pairs = [(i, j) for i in range(4) for j in range(i, 4)]
    sums = df.groupBy(*keys).agg(*[F.sum(q[i] * q[j]).alias(f"s{i}{j}") for i, j in pairs])

    def solve(frames):
        for f in frames:
            m = np.zeros((len(f), 4, 4))
            for i, j in pairs:
                m[:, i, j] = m[:, j, i] = f[f"s{i}{j}"].to_numpy(dtype=float)
            ok = np.isfinite(m).all(axis=(1, 2))
            v = np.full((len(f), 4), np.nan)
            if ok.any():
                v[ok] = np.linalg.eigh(m[ok])[1][:, :, -1]
            v = v * np.where(v[:, 3:] < 0, -1.0, 1.0)
            yield pd.concat([f[list(keys)].reset_index(drop=True), pd.DataFrame(v, columns=["qx", "qy", "qz", "qw"])], axis=1)

    kinds = {n: t for n, t in sums.dtypes}
    return sums.mapInPandas(solve, ", ".join([*(f"{k} {kinds[k]}" for k in keys), "qx double, qy double, qz double, qw double"]))


def rigid_fits(df: DataFrame, keys: Sequence[str], source: Sequence[Column], target: Sequence[Column]) -> DataFrame:
    """(keys, points, pose, rms): the rotation and translation that best take source points to target points.

    Fifteen centred sums per key are partial aggregates, then a 3x3 singular value decomposition. Fewer than three
    points, or points on a line, give a null pose.
    """
    names = [*[f"a{i}" for i in range(3)], *[f"b{i}" for i in range(3)]]
    pts = df.select(*keys, *[c.alias(n) for n, c in zip(names, [*source, *target])]).dropna(subset=names)
    aggs = [F.count("*").alias("n"), *[F.avg(n).alias(f"m_{n}") for n in names]]
    for i in range(3):
        aggs += [F.covar_pop(f"a{i}", f"b{j}").alias(f"c{i}{j}") for j in range(3)]
        aggs += [F.covar_pop(f"a{i}", f"a{j}").alias(f"v{i}{j}") for j in range(3)]
    aggs += [F.var_pop(f"b{i}").alias(f"w{i}") for i in range(3)]
    sums = pts.groupBy(*keys).agg(*aggs)

    def solve(frames):
        for f in frames:
            g = lambda p: np.stack([[f[f"{p}{i}{j}"].to_numpy(dtype=float) for j in range(3)] for i in range(3)]).transpose(2, 0, 1)
            c, v, n = g("c"), g("v"), f["n"].to_numpy()
            spread = np.linalg.eigvalsh(v)
            ok = (n >= 3) & (spread[:, 1] > 1e-12 * np.maximum(spread[:, 2], 1e-300))
            u, s, vt = np.linalg.svd(c)
            sign = np.sign(np.linalg.det(vt.transpose(0, 2, 1) @ u.transpose(0, 2, 1)))
            d = np.stack([np.ones_like(sign), np.ones_like(sign), np.where(sign == 0, 1, sign)], 1)
            r = vt.transpose(0, 2, 1) @ (d[:, :, None] * u.transpose(0, 2, 1))
            ma, mb = (np.stack([f[f"m_{k}{i}"].to_numpy(dtype=float) for i in range(3)], 1) for k in "ab")
            t = mb - np.einsum("nij,nj->ni", r, ma)
            left = np.trace(v, axis1=1, axis2=2) + sum(f[f"w{i}"].to_numpy(dtype=float) for i in range(3)) - 2 * (s * d).sum(axis=1)
            q = _quaternion(r)
            rows = [dict(zip(("x", "y", "z", "qx", "qy", "qz", "qw"), map(float, [*a, *b]))) if good else None for a, b, good in zip(t, q, ok)]
            yield pd.concat([f[list(keys)].reset_index(drop=True), pd.DataFrame({"points": n, "pose": rows, "rms": np.where(ok, np.sqrt(np.maximum(left, 0)), np.nan)})], axis=1)

    kinds = {n: t for n, t in sums.dtypes}
    return sums.mapInPandas(solve, ", ".join([*(f"{k} {kinds[k]}" for k in keys), f"points long, pose {POSE7}, rms double"]))


def align_with_up(source: np.ndarray, target: np.ndarray, weight: float = 0.25) -> np.ndarray:
    """Rotation matrices that take unit ``source`` to ``target`` vectors [n, 3], with z-up as a second, lighter pair."""
    unit = lambda v: v / np.linalg.norm(v, axis=1, keepdims=True)
    a, b = unit(source), unit(target)
    up = np.array([0.0, 0.0, 1.0])
    c = np.einsum("ni,nj->nij", a, b) + weight * np.outer(up, up)
    u, _, vt = np.linalg.svd(c)
    d = np.sign(np.linalg.det(vt.transpose(0, 2, 1) @ u.transpose(0, 2, 1)))
    return vt.transpose(0, 2, 1) @ (np.stack([np.ones_like(d), np.ones_like(d), d], 1)[:, :, None] * u.transpose(0, 2, 1))


def auto_register(frames: DataFrame, homes: dict[str, tuple[float, ...]], least_scale: float = 0.4, most_scale: float = 1.0) -> DataFrame:
    """(episode_id, scale, base, tool_right, tool_left): a registration of each episode's workspace.

    ``frames`` holds the active sides only, ``homes`` the target's neutral pose (7 numbers) of 'right' and 'left'. The
    positions' medians and the rotations' means come from aggregates; the scale fits the 95th percentile of the radius into
    0.2 m; the base aligns the axis between two active sides and centres them; tools take up the rest of the rotation, without
    translation. Episodes without unit quaternions have no rotation and are left out.
    """
    p, q = P.fields("pose")
    unit = P.normalize(q)
    side = ["episode_id", "side"]
    flat = frames.select(*side, *[c.alias(n) for n, c in zip("xyz", p)], *[c.alias(n) for n, c in zip(("qx", "qy", "qz", "qw"), unit)]).dropna()
    middle = flat.groupBy(*side).agg(*[F.percentile(n, 0.5).alias(f"m{n}") for n in "xyz"])
    radius = flat.join(middle, side).groupBy(*side).agg(F.percentile(P.norm([F.col(n) - F.col(f"m{n}") for n in "xyz"]), 0.95).alias("radius"))
    means = rotation_means(flat, side, [F.col(n) for n in ("qx", "qy", "qz", "qw")])
    one = middle.join(radius, side).join(means, side)
    wide = one.groupBy("episode_id").agg(*[F.max(F.when(F.col("side") == s, F.col(c))).alias(f"{c}_{s}") for s in (0, 1) for c in ("mx", "my", "mz", "qx", "qy", "qz", "qw", "radius")])

    def matrix(v: np.ndarray) -> np.ndarray:
        x, y, z, w = v.T
        return np.stack([[1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w)], [2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w)], [2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)]]).transpose(2, 0, 1)

    home = [np.array(homes["right"], dtype=float), np.array(homes["left"], dtype=float)]

    def solve(frames_):
        for f in frames_:
            n = len(f)
            pos = [f[[f"m{c}_{s}" for c in "xyz"]].to_numpy(dtype=float) for s in (0, 1)]
            quat = [f[[f"{c}_{s}" for c in ("qx", "qy", "qz", "qw")]].to_numpy(dtype=float) for s in (0, 1)]
            here = [np.isfinite(quat[s]).all(axis=1) for s in (0, 1)]
            r = np.nanmax(f[["radius_0", "radius_1"]].to_numpy(dtype=float), axis=1)
            scale = np.clip(0.20 / np.maximum(r, 1e-6), least_scale, most_scale)
            pos = [v * scale[:, None] for v in pos]
            axis = pos[1] - pos[0]
            both = here[0] & here[1] & (np.linalg.norm(np.nan_to_num(axis), axis=1) >= 1e-5)
            rot = np.tile(np.eye(3), (n, 1, 1))
            if both.any():
                rot[both] = align_with_up(axis[both], np.tile(home[1][:3] - home[0][:3], (both.sum(), 1)))
            w = np.stack(here, 1).astype(float)
            centre = sum(np.nan_to_num(pos[s]) * w[:, [s]] for s in (0, 1)) / np.maximum(w.sum(axis=1, keepdims=True), 1)
            goal = sum(home[s][:3] * w[:, [s]] for s in (0, 1)) / np.maximum(w.sum(axis=1, keepdims=True), 1)
            shift = goal - np.einsum("nij,nj->ni", rot, centre)
            base = np.concatenate([shift, _quaternion(rot)], axis=1)
            tools = []
            for s in (0, 1):
                t = np.tile([0, 0, 0, 0, 0, 0, 1.0], (n, 1))
                k = here[s]
                if k.any():
                    mapped = rot[k] @ matrix(quat[s][k])
                    t[k, 3:] = _quaternion(mapped.transpose(0, 2, 1) @ matrix(np.tile(home[s][3:], (k.sum(), 1))))
                tools.append(t)
            dicts = lambda a: [dict(zip(("x", "y", "z", "qx", "qy", "qz", "qw"), map(float, row))) for row in a]
            yield pd.DataFrame({"episode_id": f["episode_id"], "scale": scale, "base": dicts(base), "tool_right": dicts(tools[0]), "tool_left": dicts(tools[1])})

    return wide.mapInPandas(solve, f"episode_id long, scale double, base {POSE7}, tool_right {POSE7}, tool_left {POSE7}")


def apply_registration(frames: DataFrame, registrations: DataFrame, active: DataFrame) -> DataFrame:
    """Frames with the poses of active sides scaled and moved by their episode's registration; other sides stay."""
    on = active.withColumn("_active", F.lit(True))
    d = frames.join(registrations.select("episode_id", "scale", "base", "tool_right", "tool_left"), "episode_id", "left").join(on, ["episode_id", "side"], "left")
    p, q = P.transform(P.fields("pose"), P.fields("base"), P.fields(F.when(F.col("side") == 0, F.col("tool_right")).otherwise(F.col("tool_left"))), F.col("scale"))
    moved = F.coalesce("_active", F.lit(False)) & F.col("base").isNotNull()
    return d.withColumn("pose", F.when(moved, P.make_pose(p, q)).otherwise(F.col("pose"))).drop("scale", "base", "tool_right", "tool_left", "_active")


def workspace_translations(frames: DataFrame, homes: dict[str, tuple[float, ...]]) -> DataFrame:
    """(episode_id, x, y, z): the mean over sides of how far the median position lies from the target's neutral one."""
    p, _ = P.fields("pose")
    middle = frames.groupBy("episode_id", "side").agg(*[F.percentile(c, 0.5).alias(n) for n, c in zip("xyz", p)])
    off = {n: F.when(F.col("side") == 0, homes["right"][i]).otherwise(homes["left"][i]) - F.col(n) for i, n in enumerate("xyz")}
    return middle.groupBy("episode_id").agg(*[F.avg(c).alias(n) for n, c in off.items()])


def plane_similarities(df: DataFrame, keys: Sequence[str], a: tuple[Column, Column], b: tuple[Column, Column], low: float = 0.35, high: float = 2.2) -> DataFrame:
    """(keys, scale, angle, dx, dy): the least-squares turn, scale and shift of plane points a to b; the scale is clipped."""
    d = df.select(*keys, a[0].alias("ax"), a[1].alias("ay"), b[0].alias("bx"), b[1].alias("by")).dropna()
    s = d.groupBy(*keys).agg(*[F.avg(c).alias(f"m{c}") for c in ("ax", "ay", "bx", "by")], (F.covar_pop("ax", "bx") + F.covar_pop("ay", "by")).alias("re"), (F.covar_pop("ax", "by") - F.covar_pop("ay", "bx")).alias("im"), (F.var_pop("ax") + F.var_pop("ay")).alias("n"))
    scale = F.least(F.greatest(F.try_divide(F.sqrt(F.col("re") ** 2 + F.col("im") ** 2), F.col("n")), F.lit(low)), F.lit(high))
    d = s.withColumns({"scale": scale, "angle": F.atan2("im", "re")})
    c, sn = F.cos("angle") * F.col("scale"), F.sin("angle") * F.col("scale")
    return d.select(*keys, "scale", "angle", (F.col("mbx") - (c * F.col("max") - sn * F.col("may"))).alias("dx"), (F.col("mby") - (sn * F.col("max") + c * F.col("may"))).alias("dy"))


def calibration_report(fits: DataFrame, tool_offset_validated: bool, limit: float = 0.005) -> DataFrame:
    """Adds ``validated``: the residual is within the limit and the tool offset was measured."""
    return fits.withColumn("validated", F.coalesce((F.col("rms") <= limit) & F.lit(tool_offset_validated), F.lit(False)))


def base_errors(episodes: DataFrame, metadata: str = "metadata") -> DataFrame:
    """(episode_id): the episodes whose registration does not give both sides one shared base of seven numbers.

    The registration is read from the JSON of ``metadata``; episodes without one, or with broken JSON, have no error.
    """
    at = lambda path: F.get_json_object(metadata, f"$.registration.{path}")
    right, left = (F.from_json(at(f"openarm_from_source_base.{s}"), "array<double>") for s in ("right", "left"))
    near = F.forall(F.zip_with(right, left, lambda a, b: F.abs(a - b) <= 1e-10 + 1e-5 * F.abs(b)), lambda x: x)
    fine = (at("shared_base_frame") == "true") & (F.size(right) == 7) & (F.size(left) == 7) & near
    whole = F.get_json_object(metadata, "$.registration")
    return episodes.filter(whole.startswith("{") & (whole != "{}") & ~F.coalesce(fine, F.lit(False))).select("episode_id").distinct()
