"""Small images of what the frames show: discs where the grippers are, seen from above."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from armlode.operators.pixels import LAYER

HEIGHT, WIDTH = 24, 32


def rasters(frames: DataFrame, what: str) -> DataFrame:
    """A layer per episode and frame: 'mask' (discs of both sides), 'video' (a grey slope with the discs), 'rgba' (one
    side's disc with alpha). x runs down from 0 to 0.8 m, y across from -0.6 to 0.6 m; an open gripper is larger."""
    one = frames.groupBy("episode_id", "frame_idx").agg(F.array_sort(F.collect_list(F.struct("side", F.col("pose.x").alias("x"), F.col("pose.y").alias("y"), F.coalesce("gripper", F.lit(0.0)).alias("g")))).alias("sides"))
    yy, xx = np.mgrid[:HEIGHT, :WIDTH]

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in batches:
            rows = []
            for e, i, sides in zip(f["episode_id"], f["frame_idx"], f["sides"]):
                m = np.zeros((HEIGHT, WIDTH), dtype=bool)
                for s in sides:
                    if np.isfinite(s["x"]) and np.isfinite(s["y"]):
                        cy, cx, r = s["x"] / 0.8 * HEIGHT, (s["y"] + 0.6) / 1.2 * WIDTH, 2.0 + 2.0 * (1 - s["g"])
                        m |= (yy - cy) ** 2 + (xx - cx) ** 2 <= r * r
                if what == "mask":
                    a = m.astype(np.uint8) * 255
                elif what == "video":
                    a = np.where(m, 200, 40 + 3 * xx + (i % 3)).astype(np.uint8)
                else:
                    a = np.dstack([np.full(m.shape, v, dtype=np.uint8) for v in (30, 160, 60)] + [m.astype(np.uint8) * 255])
                rows.append((str(e), i, HEIGHT, WIDTH, 1 if a.ndim == 2 else a.shape[2], a.tobytes()))
            yield pd.DataFrame(rows, columns=["clip", "frame_idx", "h", "w", "c", "data"])

    return one.mapInPandas(draw, LAYER)
