"""Source tables of any field names to canonical frames, as declared by a source's settings."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from armlode.functions import gripper as G
from armlode.functions import pose as P


@dataclass(frozen=True)
class SourceSettings:
    """What a source declares. ``fields`` maps 'timestamp', and per side 'pose' and 'gripper' (or 'right_pose', ...), to columns."""

    name: str
    fields: dict[str, str]
    rotation: str = "quaternion"
    quaternion_order: str = "xyzw"
    position_scale: float = 1.0
    sides: tuple[str, ...] = ("right", "left")
    gripper_mode: str = "normalized"
    gripper_open: float | None = None
    gripper_closed: float | None = None
    calibrated: bool = False
    base: tuple[float, ...] = (0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0)
    tool: tuple[float, ...] | dict[str, tuple[float, ...]] = field(default=(0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0))

    def tool_of(self, side: str) -> tuple[float, ...]:
        """One tool for both sides, or one per side, which must then be named."""
        return self.tool[side] if isinstance(self.tool, dict) else self.tool


def with_pose(df: DataFrame, column: str, s: SourceSettings, side: str, out: str) -> DataFrame:
    """Adds a vector of position and rotation (more values are ignored) as a pose in the target's frame; null where it is too short.

    Each step is a column of its own: nested into one expression, products of quaternions would repeat their parts at every level.
    """
    values = F.col(column)
    v = [F.get(values, F.lit(i)) for i in range(7)]
    if s.rotation == "quaternion":
        q = v[3:7] if s.quaternion_order == "xyzw" else [v[4], v[5], v[6], v[3]]
    elif s.rotation == "euler":
        q = P.euler_to_quaternion(*v[3:6])
    elif s.rotation == "rotvec":
        q = P.rotvec_to_quaternion(*v[3:6])
    else:
        raise ValueError(f"unknown rotation representation: {s.rotation}")
    lit = lambda a: ([F.lit(float(x)) for x in a[:3]], [F.lit(float(x)) for x in a[3:]])
    names = [f"_q{i}" for i in range(4)]
    kept = lambda d, cols: d.withColumns(dict(zip(names, cols)))
    here = lambda: [F.col(n) for n in names]
    d = kept(kept(df, q), P.normalize(here()))
    p, q = P.transform((v[:3], here()), lit(s.base), lit(s.tool_of(side)), s.position_scale)
    d = kept(d.withColumns({f"_p{i}": c for i, c in enumerate(p)}), q)
    d = kept(d, P.normalize(here()))
    width = 7 if s.rotation == "quaternion" else 6
    return d.withColumn(out, F.when(F.size(values) >= width, P.make_pose([F.col(f"_p{i}") for i in range(3)], here()))).drop(*names, "_p0", "_p1", "_p2")


def closure(df: DataFrame, value: str, keys: list[str], s: SourceSettings, out: str) -> DataFrame:
    """Adds the closure of a gripper column by the source's mode."""
    if s.gripper_mode in ("calibrated", "width_mm", "closure_position"):
        if s.gripper_open is None or s.gripper_closed is None or abs(s.gripper_closed - s.gripper_open) < 1e-9:
            raise ValueError("the gripper's open and closed values must be given and differ")
        return df.withColumn(out, G.linear_closure(F.col(value), F.lit(s.gripper_open), F.lit(s.gripper_closed)))
    if s.gripper_mode == "width_physical":
        return df.withColumn(out, G.closure_of_aperture(F.col(value) * 1e-3))
    if s.gripper_mode == "signed":
        ends = df.groupBy(*keys).agg(F.percentile(value, F.array(F.lit(0.01), F.lit(0.99))).alias("_e"))
        return df.join(ends, keys).withColumn(out, G.percentile_closure(F.col(value), F.get("_e", F.lit(0)), F.get("_e", F.lit(1)))).drop("_e")
    if s.gripper_mode == "mean_fingers":
        return df.withColumn(out, G.mean_of_fingers(F.col(value)))
    if s.gripper_mode == "hand":
        return df.withColumn(out, G.mean_of_fingers(F.col(value), [0, 2, 3, 4, 5]))
    if s.gripper_mode == "normalized":
        return df.withColumn(out, G.clip(F.col(value), 0.0, 1.0))
    raise ValueError(f"unknown gripper mode: {s.gripper_mode}")


def to_frames(df: DataFrame, s: SourceSettings, episode: str = "episode_index", frame: str | None = None, allow_uncalibrated: bool = False) -> DataFrame:
    """(episode_id, frame_idx, side, t, pose, gripper): a source's rows as canonical frames, time from zero.

    A source that is not calibrated is refused unless that is allowed. The frame number is a column or the order in time.
    """
    if not (s.calibrated or allow_uncalibrated):
        raise ValueError(f"{s.name} is not calibrated")
    from pyspark.sql import Window

    w = Window.partitionBy(episode).orderBy(s.fields["timestamp"])
    d = df.withColumns({"_t": F.col(s.fields["timestamp"]) - F.min(s.fields["timestamp"]).over(Window.partitionBy(episode)), "_i": F.col(frame).cast("long") if frame else (F.row_number().over(w) - 1).cast("long")})
    out = None
    for k, side in ((0, "right"), (1, "left")):
        if side not in s.sides:
            continue
        pose = s.fields.get(f"{side}_pose", s.fields.get("pose"))
        grip = s.fields.get(f"{side}_gripper", s.fields.get("gripper"))
        one = with_pose(closure(d, grip, [episode], s, "_g"), pose, s, side, "_pose").select(F.col(episode).cast("long").alias("episode_id"), F.col("_i").alias("frame_idx"), F.lit(k).cast("byte").alias("side"), F.col("_t").alias("t"), F.col("_pose").alias("pose"), F.col("_g").alias("gripper"))
        out = one if out is None else out.unionByName(one)
    return out
