"""Feasible runs as a training dataset: rows, episodes, tasks, statistics, and their validation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from armlode.functions.gripper import finger_angle
from armlode.operators import sequence as S
from armlode.operators.frames import canonical
from armlode.operators.quality import Limits, column_statistics, feasible_frames
from armlode.operators.scale import durable


def kept_frames(frames: DataFrame, episodes: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """(episode_id, run, frame_idx): the feasible frames and the stretch that each is in."""
    return S.run_ids(feasible_frames(frames, episodes, limits), ["episode_id"], ["frame_idx"], "feasible").filter("feasible").select("episode_id", "run", "frame_idx")


def runs_of(kept: DataFrame) -> DataFrame:
    """(episode_id, run, start, last, length): feasible stretches, each an episode of the dataset."""
    return kept.groupBy("episode_id", "run").agg(F.min("frame_idx").alias("start"), F.max("frame_idx").alias("last"), F.count("*").alias("length"))


def export_runs(frames: DataFrame, episodes: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The feasible stretches of all episodes."""
    return runs_of(kept_frames(frames, episodes, limits))


def numbered_runs(runs: DataFrame, episodes: DataFrame) -> DataFrame:
    """Adds ``episode_index``, ``from_index``, ``to_index`` and ``task_index`` in the order of episodes and runs.

    Numbering needs one global order. Runs are few against frames: they are summed per range of episodes first, so that
    only the ranges' totals meet in one task. Tasks are numbered by first appearance; null tasks are one task.
    """
    info = episodes.groupBy("episode_id").agg(F.min(F.coalesce("task", F.lit(""))).alias("task"))
    r = runs.join(info, "episode_id", "left").withColumn("_range", F.floor(F.col("episode_id") / 1024))
    sums = r.groupBy("_range").agg(F.count("*").alias("_n"), F.sum("length").alias("_l"))
    ahead = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("_range", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_n0"), F.coalesce(F.sum("_l").over(ahead), F.lit(0)).alias("_l0"))
    w = Window.partitionBy("_range").orderBy("episode_id", "run")
    d = r.join(base, "_range").withColumns({"episode_index": F.col("_n0") + F.row_number().over(w) - 1, "to_index": F.col("_l0") + F.sum("length").over(w.rowsBetween(Window.unboundedPreceding, 0))})
    d = d.withColumn("from_index", F.col("to_index") - F.col("length"))
    tasks = S.number_globally(d.groupBy("task").agg(F.min("episode_index").alias("_first")), F.floor(F.col("_first") / 65536), ["_first"], "task_index")
    return d.join(tasks.select("task", "task_index"), "task").select("episode_id", "run", "start", "last", "length", "episode_index", "from_index", "to_index", "task", "task_index")


def joint_vector(frames: DataFrame) -> DataFrame:
    """(episode_id, frame_idx, action): seven joints and the finger of the right side, then of the left; nulls where a side has none."""
    rows = canonical(frames).select("episode_id", "frame_idx", "side", F.concat(F.coalesce("q", F.array_repeat(F.lit(None).cast("double"), 7)), F.array(finger_angle(F.col("side"), F.col("gripper")))).alias("v"))
    side = lambda s: F.coalesce(F.max(F.when(F.col("side") == s, F.col("v"))), F.array_repeat(F.lit(None).cast("double"), 8))
    return rows.groupBy("episode_id", "frame_idx").agg(F.concat(side(0), side(1)).cast("array<float>").alias("action"))


def export_rows(frames: DataFrame, episodes: DataFrame, fps: int = 30, limits: Limits = Limits()) -> DataFrame:
    """The dataset's rows: (episode_index, frame_index, timestamp, index, task_index, action).

    Frames of a run are numbered from 0 and timed i / fps: the source's times are left behind. ``index`` counts over all.
    """
    kept = durable(kept_frames(frames, episodes, limits))  # used twice
    runs = numbered_runs(runs_of(kept), episodes)
    w = Window.partitionBy("episode_id", "run").orderBy("frame_idx")
    placed = kept.withColumn("frame_index", (F.row_number().over(w) - 1).cast("bigint")).join(runs.select("episode_id", "run", "episode_index", "from_index", "task_index"), ["episode_id", "run"])
    rows = placed.join(joint_vector(frames), ["episode_id", "frame_idx"])
    return rows.select("episode_index", "frame_index", (F.col("frame_index") / F.lit(fps)).alias("timestamp"), (F.col("from_index") + F.col("frame_index")).alias("index"), "task_index", "action")


#: Type and shape of the columns of a dataset.
FEATURES = {"action": ("float32", 16), "timestamp": ("float64", 1), "frame_index": ("int64", 1), "episode_index": ("int64", 1), "index": ("int64", 1), "task_index": ("int64", 1)}


def dataset_info(runs: DataFrame, fps: int = 30, calibrated: bool = True) -> DataFrame:
    """One row: totals, rate, splits and features of a dataset, from its numbered runs; an empty dataset has zeros."""
    features = F.struct(*[F.struct(F.lit(kind).alias("dtype"), F.array(F.lit(n)).alias("shape")).alias(c) for c, (kind, n) in FEATURES.items()])
    one = runs.agg(F.count("*").alias("total_episodes"), F.coalesce(F.sum("length"), F.lit(0)).alias("total_frames"), F.count_distinct("task_index").alias("total_tasks"))
    splits = F.struct(F.concat(F.lit("0:"), F.col("total_episodes").cast("string")).alias("train"))
    return one.withColumns({"fps": F.lit(fps), "splits": splits, "features": features, "position_unit": F.lit("metre"), "quaternion_order": F.lit("xyzw"), "calibration_validated": F.lit(calibrated)})


def write_dataset(frames: DataFrame, episodes: DataFrame, path: str, fps: int = 30, limits: Limits = Limits()) -> None:
    """Data, episodes, tasks and statistics as Parquet (zstd) folders, totals and features as JSON; data in order of ``index``, one range per file."""
    rows = export_rows(frames, episodes, fps, limits)
    rows.repartitionByRange("index").sortWithinPartitions("index").write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/data")
    numbered_runs(export_runs(frames, episodes, limits), episodes).write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/meta/episodes")
    runs = rows.sparkSession.read.parquet(f"{path}/meta/episodes")
    dataset_info(runs, fps).coalesce(1).write.mode("overwrite").json(f"{path}/meta/info")
    runs.select("task_index", "task").distinct().write.mode("overwrite").parquet(f"{path}/meta/tasks")
    data = rows.sparkSession.read.parquet(f"{path}/data")
    column_statistics(data, [], "action").write.mode("overwrite").parquet(f"{path}/meta/stats")


def validate_export(rows: DataFrame, runs: DataFrame, fps: int = 30) -> DataFrame:
    """One row: (ok, errors, frames, episodes): counts agree, numbers are contiguous, steps are 1 / fps.

    Contiguity is checked by count, least and greatest, per episode and over all: no global sort.
    """
    per = rows.groupBy("episode_index").agg(F.count("*").alias("n"), F.min("frame_index").alias("lo"), F.max("frame_index").alias("hi"), F.count_distinct("frame_index").alias("d"), F.max(F.abs(F.col("timestamp") - F.col("frame_index") / F.lit(fps))).alias("off"))
    inside = per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("frames"), F.count("*").alias("episodes"), F.count_if((F.col("lo") != 0) | (F.col("hi") != F.col("n") - 1) | (F.col("d") != F.col("n"))).alias("gaps"), F.count_if(F.col("off") > 1e-6).alias("steps"))
    # (each side is one row)
    span = rows.agg(F.count("*").alias("c"), F.min("index").alias("first"), F.max("index").alias("last"), F.count_distinct("index").alias("u"))
    meta = runs.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("m_frames"), F.count("*").alias("m_episodes"))
    one = inside.withColumn("_k", F.lit(1)).join(span.withColumn("_k", F.lit(1)), "_k").join(meta.withColumn("_k", F.lit(1)), "_k")
    errors = F.array_compact(F.array(
        F.when(F.col("frames") != F.col("m_frames"), "row count differs"), F.when(F.col("episodes") != F.col("m_episodes"), "episode count differs"), F.when(F.col("gaps") > 0, "frame_index is not contiguous"),
        F.when((F.col("c") > 0) & ((F.col("first") != 0) | (F.col("last") != F.col("c") - 1) | (F.col("u") != F.col("c"))), "index is not contiguous"), F.when(F.col("steps") > 0, "timestamps differ from 1/fps"),
    ))
    return one.select((F.size(errors) == 0).alias("ok"), F.array_join(errors, "; ").alias("errors"), "frames", "episodes")
