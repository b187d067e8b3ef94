"""Structured Streaming forms: frames as they arrive, with late rows, repeated rows and state per side."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def arriving(frames: DataFrame, late: str = "10 minutes") -> DataFrame:
    """Frames of a stream once each: repeats within the watermark are dropped, later ones ignored."""
    return frames.withWatermark("received_at", late).dropDuplicatesWithinWatermark(["episode_id", "side", "frame_idx"])


def arrivals_per_window(frames: DataFrame, late: str = "10 minutes", length: str = "5 minutes") -> DataFrame:
    """Frames and feasible frames per source and window of arrival; a window is given out once it is past the watermark."""
    w = frames.withWatermark("received_at", late).groupBy(F.window("received_at", length), "source_dataset")
    return w.agg(F.count("*").alias("frames"), F.count_if("feasible").alias("feasible_frames")).select(F.col("window.start").alias("start"), "source_dataset", "frames", "feasible_frames")


def joint_speeds(frames: DataFrame) -> DataFrame:
    """(episode_id, side, frame_idx, speed): the first joint's rate against the last frame seen of its side.

    The last frame is the state of each side and outlives batches; frames that come out of order give no rate
    and leave the state as it is.
    """

    def follow(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get if state.exists else None
        rows = []
        for f in batches:
            for r in f.sort_values("frame_idx").itertuples():
                if last is not None and r.frame_idx <= last[0]:
                    continue
                speed = None if last is None or r.t <= last[1] else abs(r.q1 - last[2]) / (r.t - last[1])
                rows.append((key[0], key[1], r.frame_idx, speed))
                last = (int(r.frame_idx), float(r.t), float(r.q1))
        if last is not None:
            state.update(last)
        yield pd.DataFrame(rows, columns=["episode_id", "side", "frame_idx", "speed"])

    d = frames.filter("q is not null and t is not null").select("episode_id", F.col("side").cast("int").alias("side"), "frame_idx", "t", F.get("q", F.lit(0)).alias("q1"))
    return d.groupBy("episode_id", "side").applyInPandasWithState(follow, "episode_id long, side int, frame_idx long, speed double", "frame_idx long, t double, q1 double", "append", GroupStateTimeout.NoTimeout)
