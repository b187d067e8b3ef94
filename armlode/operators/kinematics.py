"""Kinematic chains given as data: forward kinematics, damped least squares along an episode, smoothing, distances.

The chain is a table of links, so no model file is needed: joint number, axis, offset from the joint before, limits.
Episodes are solved in parallel; within one side frames follow each other, each starting from the solution before.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from armlode.operators.scale import map_sorted_groups


@dataclass(frozen=True)
class Chain:
    """Seven (or any) revolute joints: axes [n, 3], offsets [n, 3] before each joint, the tool's offset, limits."""

    axes: np.ndarray
    offsets: np.ndarray
    tool: np.ndarray
    lower: np.ndarray
    upper: np.ndarray

    @property
    def neutral(self) -> np.ndarray:
        return (self.lower + self.upper) / 2


@dataclass(frozen=True)
class SolverSettings:
    """Fixed values of the solver."""

    iterations: int = 120
    damping: float = 0.05
    step: float = 0.2
    position_tolerance: float = 1e-3
    rotation_tolerance: float = 1e-2
    posture_gain: float = 0.02
    carry: float = 0.4
    elbow: int = 3
    elbow_turns: tuple[float, ...] = (-0.45, 0.45)
    smoothing: float = 3.0
    doubt: float = 0.03


def default_chain() -> Chain:
    """A seven-joint arm of about 0.9 m, for data without a model of its own."""
    z, y, x = np.array([0.0, 0, 1]), np.array([0.0, 1, 0]), np.array([1.0, 0, 0])
    axes = np.array([z, y, z, y, z, y, x])
    offsets = np.array([[0, 0, 0.1], [0, 0, 0.05], [0, 0, 0.2], [0, 0, 0.15], [0, 0, 0.15], [0, 0, 0.1], [0, 0, 0.05]])
    return Chain(axes, offsets, np.array([0.0, 0, 0.1]), np.full(7, -2.9), np.full(7, 2.9))


def _turns(axes: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Rotation matrices [..., n, 3, 3] about unit axes by angles [..., n]."""
    c, s = np.cos(q)[..., None, None], np.sin(q)[..., None, None]
    k = np.zeros((len(axes), 3, 3))
    k[:, 0, 1], k[:, 0, 2], k[:, 1, 0], k[:, 1, 2], k[:, 2, 0], k[:, 2, 1] = -axes[:, 2], axes[:, 1], axes[:, 2], -axes[:, 0], -axes[:, 1], axes[:, 0]
    return np.eye(3) + s * k + (1 - c) * (k @ k)


def forward(chain: Chain, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(tip [g, 3], rotation [g, 3, 3], joint places [g, n, 3], joint axes [g, n, 3]) for angles [g, n]."""
    g, n = q.shape
    turns = _turns(chain.axes, q)
    r, p = np.tile(np.eye(3), (g, 1, 1)), np.zeros((g, 3))
    places, axes = np.empty((g, n, 3)), np.empty((g, n, 3))
    for j in range(n):
        p = p + r @ chain.offsets[j]
        places[:, j], axes[:, j] = p, r @ chain.axes[j]
        r = r @ turns[:, j]
    return p + r @ chain.tool, r, places, axes


def jacobian(tip: np.ndarray, places: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """[g, 6, n]: how the tip moves and turns with each joint."""
    return np.concatenate([np.cross(axes, tip[:, None] - places), axes], axis=2).transpose(0, 2, 1)


def _matrix(q: np.ndarray) -> np.ndarray:
    x, y, z, w = np.moveaxis(q / np.maximum(np.linalg.norm(q, axis=-1, keepdims=True), 1e-12), -1, 0)
    return np.stack([1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w), 2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w), 2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)], -1).reshape(*x.shape, 3, 3)


def _rotvec(r: np.ndarray) -> np.ndarray:
    """Rotation vectors of matrices, at most pi long."""
    v = np.stack([r[..., 2, 1] - r[..., 1, 2], r[..., 0, 2] - r[..., 2, 0], r[..., 1, 0] - r[..., 0, 1]], -1) / 2
    s, c = np.linalg.norm(v, axis=-1), (np.trace(r, axis1=-2, axis2=-1) - 1) / 2
    return v * np.where(s > 1e-9, np.arctan2(s, c) / np.maximum(s, 1e-9), 1.0)[..., None]


def evaluate(chain: Chain, q: np.ndarray, p: np.ndarray, r: np.ndarray, settings: SolverSettings) -> dict[str, np.ndarray]:
    """Errors, condition and success of given joint angles."""
    tip, rot, places, axes = forward(chain, q)
    ep, er = np.linalg.norm(p - tip, axis=1), np.linalg.norm(_rotvec(r @ rot.transpose(0, 2, 1)), axis=1)
    s = np.linalg.svd(jacobian(tip, places, axes), compute_uv=False)
    with np.errstate(divide="ignore"):
        cond = np.where(s[:, -1] > 1e-12, s[:, 0] / np.maximum(s[:, -1], 1e-12), np.inf)
    return {"q": q, "ep": ep, "er": er, "cond": cond, "ok": (ep <= settings.position_tolerance * 5) & (er <= settings.rotation_tolerance * 5)}


def solve(chain: Chain, start: np.ndarray, p: np.ndarray, r: np.ndarray, settings: SolverSettings, posture: np.ndarray | None = None) -> dict[str, np.ndarray]:
    """Damped least squares for many targets at once, with a pull to ``posture`` (the start) in the null space and steps clipped."""
    q = start.copy()
    posture = start if posture is None else posture
    live = np.arange(len(q))
    for _ in range(settings.iterations):
        tip, rot, places, axes = forward(chain, q[live])
        dp, dr = p[live] - tip, _rotvec(r[live] @ rot.transpose(0, 2, 1))
        off = (np.linalg.norm(dp, axis=1) > settings.position_tolerance) | (np.linalg.norm(dr, axis=1) > settings.rotation_tolerance)
        live = live[off]
        if not len(live):
            break
        j = jacobian(tip[off], places[off], axes[off])
        jt = j.transpose(0, 2, 1)
        inv = np.linalg.inv(j @ jt + settings.damping**2 * np.eye(6))
        step = (jt @ inv @ np.concatenate([dp[off], dr[off]], axis=1)[..., None])[..., 0]
        rest = settings.posture_gain * (posture[live] - q[live])
        step += rest - (jt @ inv @ (j @ rest[..., None]))[..., 0]
        q[live] = np.clip(q[live] + np.clip(step, -settings.step, settings.step), chain.lower, chain.upper)
    return evaluate(chain, q, p, r, settings)


def restart_postures(chain: Chain, settings: SolverSettings) -> np.ndarray:
    """[3, n]: where a failed frame is tried again: neutral, and neutral with the elbow turned either way."""
    out = np.tile(chain.neutral, (1 + len(settings.elbow_turns), 1))
    out[1:, settings.elbow] += settings.elbow_turns
    return np.clip(out, chain.lower, chain.upper)


def best_answers(answers: list[dict[str, np.ndarray]], last: np.ndarray, settings: SolverSettings) -> dict[str, np.ndarray]:
    """Of several answers to the same targets the least by (failed, errors over their tolerances, distance to the last joints)."""
    stacked = {k: np.stack([a[k] for a in answers]) for k in answers[0]}
    errors = stacked["ep"] / settings.position_tolerance + stacked["er"] / settings.rotation_tolerance
    first = np.lexsort((np.linalg.norm(stacked["q"] - last, axis=2), errors, ~stacked["ok"]), axis=0)[0]
    return {k: v[first, np.arange(len(first))] for k, v in stacked.items()}


def solve_episodes(frames: DataFrame, chain: Chain | None = None, settings: SolverSettings = SolverSettings(), smooth: bool = False) -> DataFrame:
    """(episode_id, side, frame_idx, q, ik_success, position_error_m, orientation_error_rad, jacobian_condition).

    Many episodes step together: frame i of all of them is one vectorised solve that starts from their frames before,
    carried on by part of the last step. Where it fails it is tried again from the neutral posture and from two with the elbow
    turned, and the best answer by (success, errors, distance to the frame before) is kept. With ``smooth`` each
    side's joints are then smoothed, failed frames weighing less, and errors, condition and success are those of the smoothed
    joints, so frames next to a failed one may lose their success. Poses with nulls or no rotation are not solved: q null, condition infinite.
    """
    chain = chain or default_chain()
    restarts = restart_postures(chain, settings)
    flat = frames.select("episode_id", "side", "frame_idx", *[F.col(f"pose.{k}").alias(k) for k in ("x", "y", "z", "qx", "qy", "qz", "qw")])

    def run(rows: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        n = np.diff(starts)
        order = np.argsort(-n, kind="stable")
        lo, n = starts[:-1][order], n[order]
        pos, quat = rows[["x", "y", "z"]].to_numpy(dtype=float), rows[["qx", "qy", "qz", "qw"]].to_numpy(dtype=float)
        fine = np.isfinite(pos).all(axis=1) & np.isfinite(quat).all(axis=1) & (np.linalg.norm(np.nan_to_num(quat), axis=1) > 1e-9)
        rot = np.tile(np.eye(3), (len(rows), 1, 1))
        rot[fine] = _matrix(quat[fine])
        q = np.full((len(rows), len(chain.lower)), np.nan)
        ep, er, cond, ok = np.full(len(rows), np.nan), np.full(len(rows), np.nan), np.full(len(rows), np.inf), np.zeros(len(rows), dtype=bool)
        last, before = np.tile(chain.neutral, (len(lo), 1)), np.tile(chain.neutral, (len(lo), 1))
        for i in range(int(n.max())):
            live = int(np.searchsorted(-n, -i, side="left"))
            at = lo[:live] + i
            use = fine[at]
            if not use.any():
                continue
            which, at = np.flatnonzero(use), at[use]
            guess = np.clip(last[which] + settings.carry * (last[which] - before[which]), chain.lower, chain.upper)
            a = solve(chain, guess, pos[at], rot[at], settings)
            bad = ~a["ok"]
            if bad.any():
                n_bad, n_from = int(bad.sum()), len(restarts)
                posture = np.concatenate([np.tile(restarts[0], (n_bad, 1)), *[guess[bad]] * (n_from - 1)])
                b = solve(chain, np.repeat(restarts, n_bad, axis=0), np.tile(pos[at[bad]], (n_from, 1)), np.tile(rot[at[bad]], (n_from, 1, 1)), settings, posture)
                tries = [{k: v[m * n_bad : (m + 1) * n_bad] for k, v in b.items()} for m in range(n_from)]
                best = best_answers([{k: v[bad] for k, v in a.items()}, *tries], last[which[bad]], settings)
                for k in a:
                    a[k][bad] = best[k]
            q[at], ep[at], er[at], cond[at], ok[at] = a["q"], a["ep"], a["er"], a["cond"], a["ok"]
            before[which], last[which] = last[which], a["q"]
        if smooth:
            for first, end in zip(starts[:-1], starts[1:]):
                have = fine[first:end]
                if end - first > 2 and have.any():
                    q[first:end] = np.clip(_smoothed(np.where(have[:, None], q[first:end], 0.0), have, ok[first:end], settings.smoothing, settings.doubt), chain.lower, chain.upper)
        if smooth and fine.any():
            a = evaluate(chain, q[fine], pos[fine], rot[fine], settings)
            ep[fine], er[fine], cond[fine], ok[fine] = a["ep"], a["er"], a["cond"], a["ok"]
        return pd.DataFrame({"episode_id": rows["episode_id"], "side": rows["side"], "frame_idx": rows["frame_idx"], "q": [v if f else None for v, f in zip(q, fine)], "ik_success": ok, "position_error_m": ep, "orientation_error_rad": er, "jacobian_condition": cond})

    return map_sorted_groups(flat, ["episode_id", "side"], ["frame_idx"], run, "episode_id long, side byte, frame_idx long, q array<double>, ik_success boolean, position_error_m double, orientation_error_rad double, jacobian_condition double")


def smooth_trajectories(frames: DataFrame, weight: float = 3.0, doubt: float = 0.03) -> DataFrame:
    """(episode_id, side, frame_idx, smooth): joints that minimise W (x - q)^2 + weight |second differences|^2.

    W is 1 where the row is feasible, else ``doubt``; missing joints weigh nothing. The banded system of each side is solved
    by two sweeps over its rows, all seven joints at once.
    """
    flat = frames.select("episode_id", "side", "frame_idx", "q", F.coalesce("feasible", F.lit(False)).alias("good"))

    def run(rows: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        out: list = [None] * len(rows)
        qs, good = rows["q"].tolist(), rows["good"].to_numpy(dtype=bool)
        for lo, hi in zip(starts[:-1], starts[1:]):
            have = np.array([v is not None and len(v) == 7 for v in qs[lo:hi]])
            if not have.any():
                continue
            b = np.array([v if h else np.zeros(7) for v, h in zip(qs[lo:hi], have)], dtype=float)
            x = _smoothed(b, have, good[lo:hi], weight, doubt)
            for i in range(hi - lo):
                out[lo + i] = x[i].tolist()
        return pd.DataFrame({"episode_id": rows["episode_id"], "side": rows["side"], "frame_idx": rows["frame_idx"], "smooth": out})

    return map_sorted_groups(flat, ["episode_id", "side"], ["frame_idx"], run, "episode_id long, side byte, frame_idx long, smooth array<double>")


def _smoothed(q: np.ndarray, have: np.ndarray, good: np.ndarray, weight: float, doubt: float) -> np.ndarray:
    """One side's joints [n, k], smoothed; rows that are not there weigh nothing."""
    n = len(q)
    w = np.where(have, np.where(good, 1.0, doubt), 1e-9)
    d0, d1, d2 = w.copy(), np.zeros(n), np.zeros(n)
    for c, k in ((1.0, 0), (4.0, 1), (1.0, 2)):
        d0[k : n - 2 + k] += weight * c if n > 2 else 0.0
    if n > 2:
        d1[: n - 2] += -2.0 * weight
        d1[1 : n - 1] += -2.0 * weight
        d2[: n - 2] += weight
    return _pentadiagonal(d0, d1, d2, w[:, None] * q)


def _pentadiagonal(d0: np.ndarray, d1: np.ndarray, d2: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Solves a symmetric positive five-diagonal system by its L D L^T form: one sweep down, one up."""
    n = len(d0)
    a, l1, l2, y = d0.copy(), np.zeros(n), np.zeros(n), b.copy()
    for i in range(n):
        if i >= 1:
            a[i] -= l1[i - 1] ** 2 * a[i - 1]
            y[i] -= l1[i - 1] * y[i - 1]
        if i >= 2:
            a[i] -= l2[i - 2] ** 2 * a[i - 2]
            y[i] -= l2[i - 2] * y[i - 2]
        l1[i] = (d1[i] - (l1[i - 1] * l2[i - 1] * a[i - 1] if i >= 1 else 0.0)) / a[i]
        l2[i] = d2[i] / a[i]
    y /= a[:, None]
    for i in range(n - 2, -1, -1):
        y[i] -= l1[i] * y[i + 1] + (l2[i] * y[i + 2] if i + 2 < n else 0.0)
    return y


def side_clearance(frames: DataFrame, radius: float = 0.05) -> DataFrame:
    """(episode_id, frame_idx, distance, collides): how far the two sides' grippers are apart, as spheres."""
    side = lambda s, p: frames.filter(F.col("side") == s).select("episode_id", "frame_idx", *[F.col(f"pose.{c}").alias(p + c) for c in "xyz"])
    j = side(0, "a").join(side(1, "b"), ["episode_id", "frame_idx"])
    d = F.sqrt(sum(((F.col(f"a{c}") - F.col(f"b{c}")) ** 2 for c in "yz"), (F.col("ax") - F.col("bx")) ** 2))
    return j.select("episode_id", "frame_idx", d.alias("distance"), (d < 2 * radius).alias("collides"))


def choose_registration(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Which of two solutions each key keeps: the alternative only where strictly more frames are feasible."""
    count = lambda d, n: d.groupBy(*keys).agg(F.count_if(F.coalesce(F.col("feasible"), F.lit(False))).alias(n))
    j = count(a, "shared").join(count(b, "alternative"), keys, "left").fillna({"alternative": 0})
    return j.withColumn("chosen", F.when(F.col("alternative") > F.col("shared"), "alternative").otherwise("shared"))


def accepted_rows(solved: DataFrame, keys: list[str]) -> DataFrame:
    """Rows to judge contacts by: the feasible ones of a key, else those that the solver reached, else all."""
    w = Window.partitionBy(*keys)
    f, s = F.coalesce(F.col("feasible"), F.lit(False)), F.coalesce(F.col("ik_success"), F.lit(False))
    return solved.withColumns({"_f": F.max(f).over(w), "_s": F.max(s).over(w)}).filter(F.when(F.col("_f"), f).when(F.col("_s"), s).otherwise(F.lit(True))).drop("_f", "_s")
