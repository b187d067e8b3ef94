import collections
import random

import pytest
from pyspark.sql import functions as F

from armlode.llm import splits
from armlode.operators import scale

EP = "episode_id long, source_dataset string, source_episode string, task string"
CFG = "name string, repo_id string"
PLAN = "split_name string, share double"
CONFIGS = [("Alpha One", "r/a"), ("Beta", "r/a"), ("Gamma", "r/g")]


def groups(spark, rows):
    out = splits.related(spark.createDataFrame(rows, EP), spark.createDataFrame(CONFIGS, CFG))
    return {tuple(x) for x in out.collect()}


@pytest.mark.parametrize("a,b", [("000003#0-49", "3"), ("EP 00016", "ep-16[0:329]"), ("Episode 7", "episode_000007"), ("REC_007dc21ek5#0-459", "007DC21EK5"), ("rec-01494e8ek5[5:9]", "01494E8EK5")])
def test_identifiers_of_one_recording(spark, a, b):
    d = spark.createDataFrame([(a, b)], "a string, b string").select(splits.recording_key(F.col("a")).alias("a"), splits.recording_key(F.col("b")).alias("b")).first()
    assert d["a"] == d["b"] and d["a"]


def test_relations_chain_and_placeholders_relate_nothing(spark):
    rows = [
        (5, "alpha-one", "EP 3", "Lift the cup."), (9, "BETA", "0003#10-20", "TBD"), (7, "Gamma", "3", " lift  THE cup"), (8, "Gamma", "4", "n/a"), (6, "Gamma", "5", "N/A"),
        (2, "Gamma", None, "-"), (3, "Beta", None, ""), (4, None, "3", None), (1, "Gamma", "3", None), (9, "BETA", "0003#10-20", "TBD"),
    ]
    assert groups(spark, rows) == {(i, 1) for i in (1, 5, 7, 9)}


def test_components_against_union_find(spark):
    rng = random.Random(3)
    for n, m in ((40, 30), (200, 190), (300, 150)):
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] + [(i, i + 1) for i in range(n, n + 60)]  # and a long path
        parent = {}

        def find(x):
            parent.setdefault(x, x)
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for a, b in edges:
            parent[find(a)] = find(b)
        want = collections.defaultdict(set)
        for x in list(parent):
            want[find(x)].add(x)
        got = collections.defaultdict(set)
        for r in splits.components(spark.createDataFrame([(str(a), str(b)) for a, b in edges], "a string, b string")).collect():
            got[r["label"]].add(int(r["node"]))
        assert sorted(map(sorted, want.values())) == sorted(map(sorted, got.values()))


def test_splits_keep_groups_and_shares(spark):
    rng = random.Random(1)
    g = [(i, i - i % rng.choice((1, 2, 3))) for i in range(4000)] + [(10_000 + i, 10_000) for i in range(1800)]  # one group of near a third
    out = splits.assign_splits(spark.createDataFrame(g, "episode_id long, group_id long"), spark.createDataFrame([("train", 8.0), ("validation", 1.2), ("test", 0.8), (None, 1.0), ("none", 0.0)], PLAN)).collect()
    by = collections.Counter(x["split_name"] for x in out)
    assert len(out) == len(g) and abs(by["train"] / len(g) - 0.8) < 0.02 and abs(by["test"] / len(g) - 0.08) < 0.02
    assert len({(x["group_id"], x["split_name"]) for x in out}) == len({b for _, b in g})


def test_empty_and_extra_columns(spark):
    assert groups(spark, []) == set()
    e = spark.createDataFrame([(1, "Beta", "1", "x y"), (2, "Beta", "1", None), (None, None, None, None)], EP)
    for c in ("node", "source", "repo", "place", "group_id"):
        e = e.withColumn(c, F.lit("z"))
    c = spark.createDataFrame([*CONFIGS, (None, None)], CFG)
    assert {tuple(x) for x in splits.related(e, c).collect()} == {(1, 1), (2, 1)}
    none = splits.assign_splits(spark.createDataFrame([], "episode_id long, group_id long"), spark.createDataFrame([("train", 1.0)], PLAN))
    assert none.count() == 0
    assert splits.assign_splits(spark.createDataFrame([(1, 1)], "episode_id long, group_id long"), spark.createDataFrame([], PLAN)).count() == 0


def test_a_hub_is_spread_and_no_row_of_a_long_plan_is_lost(spark, monkeypatch):
    """One task holds a third of all episodes: its node is expanded in parts."""
    monkeypatch.setattr(scale, "HOT_ROWS", 50)
    e = [(i, "Gamma", f"x{i}", "sort the bolts") for i in range(400)] + [(1000 + i, "Beta", f"y{i // 2}", f"t{i}") for i in range(800)] + [(5000, "Gamma", "x7", "other work"), (5001, "Gamma", "z", "other work")]
    got = groups(spark, e)
    assert {g for i, g in got if i < 400 or i >= 5000} == {0} and len([1 for i, _ in got if i < 400 or i >= 5000]) == 402
    assert {(i, g) for i, g in got if 1000 <= i < 5000} == {(1000 + i, 1000 + i - i % 2) for i in range(800)}
    g = spark.range(20_000).select(F.col("id").alias("episode_id"), F.col("id").alias("group_id"))
    plan = spark.range(5000).select(F.concat(F.lit("s"), F.col("id")).alias("split_name"), F.lit(1.0).alias("share"))
    out = splits.assign_splits(g, plan)
    assert out.count() == 20_000 and out.select("split_name").distinct().count() == 5000
