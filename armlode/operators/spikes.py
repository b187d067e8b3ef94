"""Implausible readings: a Hampel filter per source, stuck values, physical bounds."""

from __future__ import annotations

from collections.abc import Iterator
from math import log, pi

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from armlode.operators.scale import bounded_broadcast, map_sorted_groups, stored, with_neighbours
from armlode.sources.tables import source_key

#: What a quantity can take.
REACH_M = 1.5
NORM_TOLERANCE = 1e-3
TURN = 2 * pi
#: Rows on either side of the rolling median; a burst of up to HALF rows leaves it at the true level.
HALF = 3
#: A level has come back when it is within this part of the spike's own size (or within its limit).
BACK = 0.3
#: A reading is an outlier of the Hampel filter when it is this many robust deviations off the rolling median.
MAD_TIMES = 3.0
#: An outlier is a spike only when it is also this many usual changes off: position, rotation, joints, diagnostics.
POSE_TIMES, ROTATION_TIMES, JOINT_TIMES, LOG_TIMES = 11.0, 14.0, 14.0, 7.0
#: A diagnostic's spike must also be at least this ratio off, a rotation's at least this much in the columns of its matrix.
LEAST_RATIO, LEAST_TURN = 5.0, 0.3
#: Steps an octave of the scale on which values are counted for their medians: within 1.1 %.
STEPS = 32
#: Rows in succession with one reading that make it stuck.
STUCK = 7
#: Frame numbers per block of one series, how many more each side of a block sees, and the rows it sees there at least.
BLOCK, HALO, NEAR = 4096, 64, 8

DIAGNOSTICS = ("position_error_m", "orientation_error_rad", "jacobian_condition")
FIELDS = ("pose", "q", *DIAGNOSTICS)
_LOGS = ("lp", "lo", "lc")
_POSE = ("x", "y", "z", "qx", "qy", "qz", "qw")
_Q = tuple(f"q{i}" for i in range(1, 8))
#: The quantities that are judged.
GROUPS = ("pose", "rot", *_Q, *_LOGS)
TIMES = {"pose": POSE_TIMES, "rot": ROTATION_TIMES} | dict.fromkeys(_Q, JOINT_TIMES) | dict.fromkeys(_LOGS, LOG_TIMES)
LEAST = {"rot": LEAST_TURN} | dict.fromkeys(_LOGS, log(LEAST_RATIO))


SCHEMA = "episode_id long, frame_idx long, side byte, source string, stuck int, bounds int, " + ", ".join(f"{p}_{g} float" for p in ("off", "step", "back") for g in GROUPS)


def _norm(cols: list[Column]) -> Column:
    return F.sqrt(sum((c * c for c in cols[1:]), cols[0] * cols[0]))


def _bits(flags: list[Column]) -> Column:
    return sum((F.when(b, F.lit(1 << i)).otherwise(0) for i, b in enumerate(flags[1:], 1)), F.when(flags[0], F.lit(1)).otherwise(0))


def series(frames: DataFrame) -> DataFrame:
    """The readings as scalar columns, with ``bounds``, a bit for each field out of what its quantity can take; each row in every block that sees it."""
    keyed = frames.filter(F.col("episode_id").isNotNull() & F.col("frame_idx").isNotNull() & F.col("side").isNotNull())
    flat = keyed.select(
        "episode_id", "frame_idx", "side", F.coalesce(source_key("source_dataset"), F.lit("")).alias("source"), *[F.col(f"pose.{k}").alias(k) for k in _POSE],
        *[F.get("q", F.lit(i)).alias(n) for i, n in enumerate(_Q)], F.col("q").isNotNull().alias("has_q"), *[F.col(c) for c in DIAGNOSTICS], "received_at",
    )
    condition = F.col("jacobian_condition")
    bounds = [
        (_norm([F.col(n) for n in "xyz"]) >= REACH_M) | (F.abs(_norm([F.col(n) for n in _POSE[3:]]) - 1) > NORM_TOLERANCE),
        F.greatest(*[F.abs(F.col(n)) for n in _Q]) > TURN,
        F.col("position_error_m") < 0,
        (F.col("orientation_error_rad") < 0) | (F.col("orientation_error_rad") > pi),
        (condition < 1) | F.isnan(condition) | (~(condition < float("inf")) & F.col("has_q")),
    ]
    return with_neighbours(flat.withColumn("bounds", _bits(bounds)), ["episode_id", "side"], "frame_idx", BLOCK, HALO, NEAR, [F.col("has_q")])


def _shifted(v: np.ndarray, group: np.ndarray, k: int) -> np.ndarray:
    """Row i + k at row i, NaN where that is another group."""
    out = np.full_like(v, np.nan)
    n = len(v)
    if abs(k) < n:
        to, of = (slice(0, n - k), slice(k, n)) if k >= 0 else (slice(-k, n), slice(0, n + k))
        out[to] = np.where((group[to] == group[of])[:, None], v[of], np.nan)
    return out


def _hampel(v: np.ndarray, group: np.ndarray, parts: list[slice]) -> tuple[np.ndarray, np.ndarray]:
    """Residuals of rows [N, D] against the rolling median of each column, and how near the level comes to it before and after.

    ``parts`` are the columns of each quantity; its residual is their norm. The second result is NaN where a side of the window has no row.
    """
    near = {k: _shifted(v, group, k) for k in range(-HALF, HALF + 1)}
    ordered = np.sort(np.stack([near[k] for k in near]), axis=0)
    middle = (~np.isnan(ordered)).sum(axis=0) // 2
    median = np.take_along_axis(ordered, np.minimum(middle, 2 * HALF)[None], axis=0)[0]
    norm = lambda d: np.stack([np.sqrt((d[:, p] ** 2).sum(axis=1)) for p in parts], axis=1)
    before, after = (np.fmin.reduce([norm(near[s * k] - median) for k in range(1, HALF + 1)]) for s in (-1, 1))
    return norm(v - median), np.maximum(before, after)


def _measure(rows: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
    """Rows of whole blocks, in order: their residuals, changes and stuck readings."""
    group = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    frame = rows["frame_idx"].to_numpy()
    once = np.ones(len(rows), dtype=bool)
    once[1:] = (group[1:] != group[:-1]) | (frame[1:] != frame[:-1])  # the first copy of a row
    rows, group = rows[once], group[once]
    col = {c: rows[c].to_numpy(dtype=float) for c in (*_POSE, *_Q, *DIAGNOSTICS)}
    x, y, z, w = (col[c] for c in _POSE[3:])
    # two columns of the rotation matrix: equal for a quaternion and its negative
    turn = [w * w + x * x - y * y - z * z, 2 * (x * y + w * z), 2 * (x * z - w * y), 2 * (x * y - w * z), w * w - x * x + y * y - z * z, 2 * (y * z + w * x)]
    with np.errstate(all="ignore"):
        logs = [np.where((v > 0) & np.isfinite(v), np.log(v), np.nan) for v in (col[c] for c in DIAGNOSTICS)]
        body, joints = np.stack([*(col[c] for c in "xyz"), *turn, *logs], axis=1), np.stack([col[c] for c in _Q], axis=1)
        has_q = rows["has_q"].to_numpy(dtype=bool)
        parts = [slice(0, 3), slice(3, 9), *(slice(i, i + 1) for i in range(9, 12))]
        off, back = np.full((2, len(rows), len(GROUPS)), np.nan)
        here = [0, 1, 9, 10, 11]
        off[:, here], back[:, here] = _hampel(body, group, parts)
        # joints are compared along the rows that have them
        off[has_q, 2:9], back[has_q, 2:9] = _hampel(joints[has_q], group[has_q], [slice(i, i + 1) for i in range(7)])
        moved = body - _shifted(body, group, -1)
        step = np.stack([*(np.sqrt((moved[:, p] ** 2).sum(axis=1)) for p in parts[:2]), *np.abs(joints - _shifted(joints, group, -1)).T, *np.abs(moved[:, 9:]).T], axis=1)
    read = np.stack([*(col[c] for c in "xyz"), *(col[c] for c in _Q), *(np.where(np.isfinite(v), v, np.nan) for v in (col[c] for c in DIAGNOSTICS))], axis=1)
    same = read == _shifted(read, group, -1)
    same = np.concatenate([same[:, :3].all(axis=1, keepdims=True), same[:, 3:]], axis=1)
    stuck = np.zeros(len(rows), dtype=np.int32)
    for i in range(same.shape[1]):
        run = np.cumsum(~same[:, i])
        long = np.bincount(run, weights=same[:, i])[run] >= STUCK - 1
        stuck |= (same[:, i] & long).astype(np.int32) << i
    core = rows["_core"].to_numpy(dtype=bool)
    # a level no nearer to the median than the reading itself has not come back
    back[~(back < off)] = np.nan
    fields = {f"{p}_{g}": m[core, i].astype(np.float32) for p, m in (("off", off), ("step", step), ("back", back)) for i, g in enumerate(GROUPS)}
    kept = rows.loc[core, ["episode_id", "frame_idx", "side", "source", "bounds"]].reset_index(drop=True)
    return kept.assign(stuck=stuck[core], **fields)


def measures(frames: DataFrame) -> DataFrame:
    """Per row (episode_id, frame_idx, side) what the flags need, measured after one shuffle and written once.

    For each quantity ``off_*``, its residual against the rolling median of 7 rows (for joints, of those with ``q``), ``step_*``, its
    change from the row before, and ``back_*``, how near the level comes to that median on both sides; ``stuck`` and
    ``bounds`` have a bit for each reading. Of rows sent again the one with ``q`` counts. Diagnostics are taken as logarithms.
    """
    rows = series(frames)
    done = map_sorted_groups(rows, ["episode_id", "side", "_block"], ["frame_idx", F.desc("has_q"), "received_at"], _measure, SCHEMA, drop=["received_at"])
    missing = lambda c: F.when(~F.isnan(c), F.col(c)).alias(c)
    return stored(done.select("episode_id", "frame_idx", "side", "source", "stuck", "bounds", *[missing(f"{p}_{g}") for p in ("off", "step", "back") for g in GROUPS]))


def scales(measured: DataFrame) -> DataFrame:
    """Per source and quantity the median absolute deviation from the rolling median (``mad_*``), and the median
    change from row to row among rows that changed (``usual_*``).

    Medians are read from counts of values on a logarithmic scale of ``STEPS`` steps an octave. The counts merge from partial ones,
    so a source with a third of all rows is no larger than any: its size is that of the scale.
    """
    names = [f"{p}_{g}" for p in ("off", "step") for g in GROUPS]
    span, shift = 1 << 14, 160 * STEPS

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sources: dict[str, int] = {}
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            keys, at = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            return keys, np.bincount(at, weights=np.concatenate([n for _, n in held])).astype(np.int64)

        for f in frames:
            at, found = pd.factorize(f["source"])
            own = np.array([sources.setdefault(x, len(sources)) for x in found], dtype=np.int64)[at]
            v = f[names].to_numpy(dtype=float)
            with np.errstate(all="ignore"):
                code = np.where(v > 0, np.floor(np.log2(v) * STEPS) + shift, 0)
            # a zero counts as no deviation, but not as a change
            taken = (v >= 0) & (v < 1e38) & ((v > 0) | np.array([n.startswith("off") for n in names]))
            key = (own[:, None] * len(names) + np.arange(len(names))) * span + np.where(taken, code, 0).astype(np.int64)
            held.append(np.unique(key[taken], return_counts=True))
            if len(held) > 20:
                held = [merged()]
        if held:
            keys, n = merged()
            named = np.array(list(sources), dtype=object)
            yield pd.DataFrame({"source": named[keys // (span * len(names))], "quantity": keys // span % len(names), "code": keys % span, "n": n})

    parts = measured.select("source", *names).mapInPandas(count, "source string, quantity int, code int, n long")
    counts = parts.groupBy("source", "quantity", "code").agg(F.sum("n").alias("n"))
    of = Window.partitionBy("source", "quantity")
    ranked = counts.withColumns({"upto": F.sum("n").over(of.orderBy("code")), "all": F.sum("n").over(of)}).filter(F.col("upto") * 2 >= F.col("all"))
    middle = ranked.groupBy("source", "quantity").agg(F.min("code").alias("at"))
    value = F.when(F.col("at") > 0, F.pow(F.lit(2.0), (F.col("at") - shift + 0.5) / STEPS)).otherwise(0.0)
    called = [n.replace("off_", "mad_").replace("step_", "usual_") for n in names]
    return middle.groupBy("source").agg(*[F.max(F.when(F.col("quantity") == i, value)).alias(n) for i, n in enumerate(called)])


def flag_readings(frames: DataFrame, episodes: DataFrame) -> DataFrame:
    """Implausible readings of active sides: (episode_id, frame_idx, side, field, reason).

    ``reason`` is 'bounds', 'spike' or 'stuck'; a reading may have several.

    * bounds: reach, quaternion norm, a turn per joint, signs and ranges of the diagnostics; an infinite
      condition counts only where the row has ``q``.
    * spike: a Hampel filter: the residual against the rolling median of 7 rows (for joints, of those with ``q``) exceeds ``MAD_TIMES``
      robust deviations, 1.4826 times the source's median absolute deviation from that median. A check follows: it is also many times the source's
      median change from row to row, and rows before and after lie at the median, so that a level that shifts and stays is none. Diagnostics
      are compared as ratios.
    * stuck: seven or more rows in succession hold exactly one reading; all but the first.

    Nulls in a field give no reading there; a null key drops the row; an episode without ``active_sides``
    has no active side. Rows of no source are judged together. Rows sent again are one row. Empty tables give no rows. Extra columns are ignored.
    Series longer than 4096 frames are cut into blocks; each sees at least the eight rows before and after it (and with ``q``), wherever they lie.
    """
    d = measures(frames)
    d = d.join(bounded_broadcast(scales(d)), "source", "left")

    def spike(g: str) -> Column:
        off, limit = F.col(f"off_{g}"), F.greatest(F.col(f"usual_{g}") * TIMES[g], F.lit(LEAST.get(g, 0.0)))
        outlier = off > 1.4826 * MAD_TIMES * F.coalesce(f"mad_{g}", F.lit(0.0))
        return F.coalesce(outlier & (off > limit) & (F.col(f"back_{g}") <= F.greatest(limit, off * BACK)), F.lit(False))

    def stuck(first: int, last: int) -> Column:
        return F.col("stuck").bitwiseAND(F.lit(sum(1 << i for i in range(first, last + 1)))) != 0

    joints = spike(_Q[0])
    for n in _Q[1:]:
        joints = joints | spike(n)
    marks = {
        "bounds": [F.col("bounds").bitwiseAND(F.lit(1 << i)) != 0 for i in range(len(FIELDS))],
        "spike": [spike("pose") | spike("rot"), joints, *[spike(n) for n in _LOGS]],
        "stuck": [stuck(0, 0), stuck(1, 7), stuck(8, 8), stuck(9, 9), stuck(10, 10)],
    }
    cases = [F.when(c, F.struct(F.lit(f).alias("field"), F.lit(r).alias("reason"))) for r, flags in marks.items() for f, c in zip(FIELDS, flags)]
    found = d.select("episode_id", "frame_idx", "side", F.explode(F.array_compact(F.array(*cases))).alias("case")).select("episode_id", "frame_idx", "side", "case.field", "case.reason")
    sides = episodes.select("episode_id", F.explode("active_sides").alias("s")).select("episode_id", F.when(F.col("s") == "left", 1).when(F.col("s") == "right", 0).cast("tinyint").alias("side")).distinct()
    # an inner join on distinct sides: a semi join would be pushed below the explode, over all rows
    return found.join(sides, ["episode_id", "side"]).select("episode_id", "frame_idx", "side", "field", "reason")


def implausible_readings(frames: DataFrame, episodes: DataFrame) -> DataFrame:
    """The distinct (episode_id, frame_idx, side, field) of :func:`flag_readings`."""
    return flag_readings(frames, episodes).drop("reason").distinct()
