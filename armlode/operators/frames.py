"""The canonical frame table: one row per (episode_id, side, frame_idx), and checks of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from armlode.functions import pose as P

#: The canonical schema.
SCHEMA = (
    "episode_id long, frame_idx long, side byte, source_dataset string, t double, pose struct<x:double,y:double,z:double,qx:double,qy:double,qz:double,qw:double>, "
    "gripper double, gripper_width_m double, q array<double>, feasible boolean, position_error_m double, orientation_error_rad double, jacobian_condition double, received_at timestamp"
)
SIDES = ("right", "left")


def side_window() -> Window:
    """Rows of one side of an episode, in order."""
    return Window.partitionBy("episode_id", "side").orderBy("frame_idx")


def canonical(frames: DataFrame) -> DataFrame:
    """One row per key with a time; of rows sent again the one that has ``q``, else the first received.

    The shuffle is by (episode_id, side), so the windows of an episode's side that follow need no other.
    Rows without key or time are dropped.
    """
    copies = Window.partitionBy("episode_id", "side", "frame_idx").orderBy(F.col("q").isNull(), "received_at", "t")
    kept = frames.filter("episode_id is not null and side is not null and frame_idx is not null and t is not null").repartition("episode_id", "side")
    return kept.withColumn("_copy", F.row_number().over(copies)).filter("_copy = 1").drop("_copy")


def active_sides(episodes: DataFrame) -> DataFrame:
    """(episode_id, side) of the sides that an episode names."""
    named = episodes.select("episode_id", F.explode("active_sides").alias("name"))
    return named.select("episode_id", F.when(F.col("name") == "right", 0).when(F.col("name") == "left", 1).cast("byte").alias("side")).filter("side is not null").distinct()


def violations(frames: DataFrame) -> DataFrame:
    """(episode_id, side, frame_idx, problem): what breaks the canonical invariants.

    Times must be finite and strictly increasing per side, closures finite in 0..1, widths finite and not
    negative, positions finite, quaternions of norm 1. Nulls in a field break nothing.
    """
    w = side_window()
    p, q = P.fields("pose")
    inf = float("inf")
    finite = lambda c: ~F.isnan(c) & (F.abs(c) < inf)
    checks = {
        "time not increasing": F.col("t") <= F.lag("t").over(w),
        "time not finite": ~finite(F.col("t")),
        "gripper out of range": ~F.col("gripper").between(0.0, 1.0),
        "width negative or not finite": (F.col("gripper_width_m") < 0) | ~finite(F.col("gripper_width_m")),
        "position not finite": ~(finite(p[0]) & finite(p[1]) & finite(p[2])),
        "quaternion not normalised": F.abs(P.norm(q) - 1) > 1e-3,
    }
    found = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in checks.items()]))
    return frames.withColumn("problems", found).select("episode_id", "side", "frame_idx", F.explode("problems").alias("problem"))


def both_sides(frames: DataFrame) -> DataFrame:
    """(episode_id, frame_idx, t): the frames of an episode, whichever sides they hold."""
    return frames.groupBy("episode_id", "frame_idx").agg(F.min("t").alias("t"))


def slice_frames(frames: DataFrame, first: int, last: int) -> DataFrame:
    """Frames first <= frame_idx < last with time from zero; the slice is recorded."""
    w = Window.partitionBy("episode_id")
    cut = frames.filter((F.col("frame_idx") >= first) & (F.col("frame_idx") < last))
    return cut.withColumns({"t": F.col("t") - F.min("t").over(w), "frame_idx": F.col("frame_idx") - first, "slice": F.array(F.lit(first), F.lit(last))})


def finite_or_null(c: Column) -> Column:
    return F.when(~F.isnan(c) & (F.abs(c) < float("inf")), c)
