import os

import pytest
from pyspark.sql import functions as F

from armlode.operators import joins, renders
from armlode.operators.frames import canonical

SMALL = "/root/testdata/sf0.001"


def test_scenes_without_parked_sides(spark):
    rows = [(1, "base_link_right_00"), (1, "base_link_left_00"), (1, "table"), (1, None), (2, "arm_right_00"), (2, "arm_left_01"), (3, "arm_left_00")]
    active = spark.createDataFrame([(1, ["left", "right"]), (2, ["right"])], "clip long, sides array<string>")
    d = spark.createDataFrame(rows, "clip long, name string").withColumn("sides", F.lit(0))
    got = sorted((r.clip, r.scene, r.name or "") for r in renders.scene_objects(d, active, ["clip"]).collect())
    both = [(1, "both", ""), (1, "both", "base_link_left_00"), (1, "both", "base_link_right_00"), (1, "both", "table"), (2, "both", "arm_right_00"), (3, "both", "arm_left_00")]
    assert got == sorted([*both, (1, "left", "base_link_left_00"), (1, "right", "base_link_right_00"), (3, "left", "arm_left_00")])
    assert renders.scene_objects(d.limit(0), active, ["clip"]).count() == 0


def test_runtimes_need_whole_present_renders_of_all_sides(spark):
    scenes = spark.createDataFrame([(1, "right", "a"), (1, "left", "b"), (2, "right", "a"), (3, "both", "c"), (4, "both", "c"), (5, "both", "c"), (6, "both", None)], "clip long, side string, signature string")
    made = [(1, "right", "a", 3.0, 0), (1, "left", "b", 5.0, 0), (2, "right", "a", 1.0, 0), (3, "both", "old", 2.0, 0), (4, "both", "c", 2.0, 3), (6, "both", None, 7.0, None)]
    got = {r.clip: (r.seconds, r.error) for r in renders.render_runtimes(scenes, spark.createDataFrame(made, "clip long, side string, signature string, seconds double, missing long"), ["clip"]).collect()}
    assert got == {1: (5.0, None), 2: (None, "incomplete sides"), 3: (None, "stale render"), 4: (None, "incomplete render"), 5: (None, "no render"), 6: (7.0, None)}
    m = spark.createDataFrame([(1, "model", 2.0), (1, "static", 9.0), (1, "static", 8.0), (2, "model", 4.0), (3, "other", 1.0)], "clip long, kind string, seconds double")
    assert sorted(map(tuple, renders.preferred_runtimes(m, ["clip"], ["static", "model"]).collect())) == [(1, "static", 9.0), (2, "model", 4.0)]


def test_own_values_before_parts(spark):
    schema = "clip long, side string, v double"
    expected, own = spark.createDataFrame([(1, "right"), (1, "left"), (2, "left"), (1, "left")], "clip long, side string"), spark.createDataFrame([(1, "right", 1.0), (1, "left", None)], schema)
    got = renders.own_or_split(expected, own, spark.createDataFrame([(1, "right", 5.0), (1, "left", 6.0)], schema), ["clip"], "side", "v")
    assert sorted(map(tuple, got.collect())) == [(1, "left", 6.0, "split"), (1, "right", 1.0, "own"), (2, "left", None, "none")]


def test_placements(spark):
    d = spark.createDataFrame([(0.0, 0.0, 1.0, 0.0, 10.0, 10.0, 10.0, 12.0), (1.0, 1.0, 1.0, 1.0, 0.0, 0.0, 1.0, 0.0)], "a double, b double, c double, d double, e double, f double, g double, h double")
    pts = [(F.col(x), F.col(y)) for x, y in ("ab", "cd", "ef", "gh")]
    one, none = d.select(*[c.alias(k) for k, c in renders.frame_similarity(*pts).items()]).collect()
    assert (one.scale, round(one.angle, 6), one.dx, one.dy) == (2.0, 1.570796, 10.0, 10.0) and none.scale is None and none.angle is None
    fixed = d.select(*[c.alias(k) for k, c in renders.fixed_scale_similarity(*pts, F.lit(0.5)).items()]).first()
    assert fixed.scale == 0.5 and abs(fixed.dx - 10) < 1e-9 and abs(fixed.dy - 11.5) < 1e-9


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables here")
def test_sides_partitioned_alike_are_joined_whole(spark):
    d = canonical(spark.read.parquet(f"{SMALL}/frames.parquet"))
    keys = ["episode_id", "side"]
    left = d.select(*keys, F.col("frame_idx").alias("at"))
    first = d.groupBy(*keys).agg(F.min("frame_idx").alias("at"), F.lit(1).alias("v"))
    assert joins.as_of(left, first, keys, "at", ["v"]).filter("v is null").count() == 0
    base = first.select(*keys, F.lit(None).cast("long").alias("frame_idx"), F.lit("base").alias("name"))
    every = renders.framed(base.unionByName(d.select(*keys, "frame_idx", F.lit("tool").alias("name"))), d, keys).groupBy(*keys, "frame_idx").agg(F.count("*").alias("n"))
    assert every.filter("n <> 2").count() == 0
