"""Renders against harmonised renders, and levels over all frames under the mask."""

import numpy as np
from data import FRAMES, frame

from armlode.operators import pixels as PX
from armlode.operators.rasters import rasters
from armlode.queries import solved


def test_harmonised_renders_change_colour_and_keep_alpha(spark):
    d = spark.createDataFrame([frame(i=i, gripper=0.0) for i in (1, 3)], FRAMES)
    r, v = rasters(d, "rgba"), rasters(d, "video")
    out = PX.harmonised(r, v)
    before = {x["frame_idx"]: bytes(x["data"]) for x in r.collect()}
    for x in out.collect():
        a, b = (np.frombuffer(y, dtype=np.uint8).reshape(-1, 4) for y in (bytes(x["data"]), before[x["frame_idx"]]))
        assert (a[:, 3] == b[:, 3]).all() and (a[b[:, 3] > 0, :3] != b[b[:, 3] > 0, :3]).any()
    assert PX.same_alpha(r, out).first()["different"] == 0


def test_levels_take_every_frame_and_only_masked_background(spark, tmp_path):
    spark.createDataFrame([frame(i=i) for i in (1, 3)], FRAMES).write.parquet(f"{tmp_path}/frames.parquet")
    got = {r["layer"]: r["levels"] for r in solved.light_levels(spark, str(tmp_path)).collect()}
    assert got["back"] == [200.0] * 3 and np.allclose(got["front"], [250 / 3] * 3, atol=1e-3)
