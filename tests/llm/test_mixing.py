import datetime as dt

import pytest
from pyspark.sql import functions as F

from armlode.llm import mixing

SEL = "source_dataset string, episode_index long, tasks array<string>, frames long, seconds double"
CFG = "name string, fps double"
MIX = "mixture_id int, source_dataset string, weight double, max_repeats int"


def make(spark, sel, mix, cfg=(("A", 10.0), ("b-1", 5.0))):
    r = mixing.recordings(spark.createDataFrame(list(sel), SEL), spark.createDataFrame(list(cfg), CFG))
    return r, spark.createDataFrame(list(mix), MIX)


def test_recordings_count_once_and_use_frames_where_seconds_lack(spark):
    sel = [("A", 1, None, 50, 5.0), ("a ", 1, None, 50, 5.0), ("A", 2, [], 30, None), ("B1", 1, ["t"], 20, None), ("B1", 2, None, None, None), (None, 3, None, 1, 1.0), ("A", None, None, 1, 1.0)]
    r, _ = make(spark, sel, [])
    assert {tuple(x) for x in r.collect()} == {("a", 1, 5.0), ("a", 2, 3.0), ("b1", 1, 4.0)}


def test_unreachable_targets(spark):
    sel = [("A", i, None, 10, 1.0) for i in range(10)] + [("b1", i, None, 10, 1.0) for i in range(30)]
    mix = [(1, "A", 3.0, 2), (1, "B-1", 1.0, None), (2, "A", 1.0, 1), (2, "b 1", 3.0, 1), (3, "A", 1.0, None), (3, "none", 1.0, None), (3, "b1", 0.0, 1), (4, "gone", 2.0, 3)]
    got = {tuple(x) for x in mixing.unreachable_targets(*make(spark, sel, mix)).collect()}
    # mixture 1: total 40, A's target 30 > 2 * 10; mixture 2: 10 and 30 are just reached; mixture 3: no records; 4: a total of 0 has no target
    assert got == {(1, "A"), (3, "none")}


def test_curriculum_shares_repeats_and_order(spark):
    sel = [("A", i, None, None, 1.0 + i % 3) for i in range(200)] + [("b1", i, None, None, 2.0) for i in range(1500)]
    r, m = make(spark, sel, [(1, "A", 1.0, 4), (1, "b1", 1.0, None)])
    rep = {x["source_dataset"]: x for x in mixing.mixture_report(r, m).collect()}
    assert rep["A"]["short"] and rep["A"]["most_repeats"] == 4 and rep["A"]["records"] == 800
    assert abs(rep["b1"]["mixed"] - rep["b1"]["target"]) <= 2.0 and not rep["b1"]["short"]
    assert abs(sum(x["actual_share"] for x in rep.values()) - 1) < 1e-9
    rows = mixing.curriculum(r, m).collect()
    assert all(0 <= x["position"] <= 1 for x in rows)
    assert len({(x["source"], x["episode_index"], x["repeat"]) for x in rows}) == len(rows)
    # positions invert the integral of the weight: a source that falls off has given more than half by half time
    a = [x for x in rows if x["source"] == "a"]
    assert sum(x["seconds"] for x in a if x["position"] < 0.5) > 0.55 * sum(x["seconds"] for x in a)


def test_positions_invert_a_given_schedule_and_fill_evenly(spark):
    sel = [("A", i, None, None, 1.0) for i in range(400)] + [("b1", i, None, None, 1.0) for i in range(600)]
    r, m = make(spark, sel, [(1, "A", 0.4, None), (1, "b1", 0.6, None), (2, "A", 1.0, None)])
    # A falls in steps, b1 has one stage only; the last stage of A is empty
    plan = spark.createDataFrame([(1, "A", 0.0, 3.0), (1, "A", 0.25, 1.0), (1, "A", 0.75, 0.0), (1, "b1", 0.5, None)], "mixture_id int, source_dataset string, start double, weight double")
    rows = [x for x in mixing.curriculum(r, m, plan).collect() if x["mixture_id"] == 1]
    assert len(rows) == 1000
    tenths = [sum(x["seconds"] for x in rows if k / 10 <= x["position"] < (k + 1) / 10) for k in range(10)]
    assert max(abs(t - 100) for t in tenths) <= 2
    # stage ends in summed demand: A gives 240 of its 400 by 0.25 and all by 0.75; b1 150, 450 and 600
    of = lambda s, p: sum(x["seconds"] for x in rows if x["source"] == s and x["position"] < p - 1e-9)
    assert abs(of("a", 0.39) - 240) <= 1 and abs(of("b1", 0.39) - 150) <= 1 and abs(of("a", 0.85) - 400) <= 1 and abs(of("b1", 0.85) - 450) <= 1
    order = sorted(rows, key=lambda x: x["position"])
    assert [x["source"] for x in order[-140:]] == ["b1"] * 140


def test_default_schedule_fills_every_tenth(spark):
    sel = [("A", i, None, None, 1.0) for i in range(50)] + [("b1", i, None, None, 0.5) for i in range(1900)]
    rows = mixing.curriculum(*make(spark, sel, [(1, "A", 1.0, 6), (1, "b1", 2.0, None)])).collect()
    tenths = [sum(x["seconds"] for x in rows if k / 10 <= x["position"] < (k + 1) / 10) for k in range(10)]
    assert max(tenths) - min(tenths) <= 4


def test_running_total_is_exact(spark):
    rows = [("k", i, 0.1 * (i % 7)) for i in range(500)] + [("j", 1, 2.0)]
    out = mixing.running_total(spark.createDataFrame(rows, "k string, i long, s double"), ["k"], ["i"], "s", "before").collect()
    k = sorted((x["before"], x["s"]) for x in out if x["k"] == "k")
    ends = 0.0
    for b, s in sorted(k):
        assert abs(b - ends) < 1e-6
        ends = b + s


def test_empty_and_extra_columns(spark):
    r, m = make(spark, [], [])
    assert mixing.curriculum(r, m).count() == 0 and mixing.unreachable_targets(r, m).count() == 0
    sel = spark.createDataFrame([("A", 1, None, 1, 1.0)], SEL).withColumn("source", F.lit("x")).withColumn("fps", F.lit(3))
    cfg = spark.createDataFrame([("A", 10.0), (None, 1.0)], CFG).withColumn("source", F.lit("y"))
    mix = spark.createDataFrame([(1, "A", 1.0, None), (1, None, 1.0, None), (None, "A", 1.0, 1), (2, "A", None, None)], MIX).withColumn("held", F.lit(1)).withColumn("total", F.lit(1))
    got = {tuple(x) for x in mixing.unreachable_targets(mixing.recordings(sel, cfg), mix).collect()}
    assert got == {(1, None)}
