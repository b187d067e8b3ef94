import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from armlode.operators import scale
from armlode.operators import sequence as S


def test_broadcast_only_below_the_bound(spark):
    small, large = spark.range(5), spark.range(30)
    left = spark.range(100).repartition(3)
    plan = lambda d: left.join(d, "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan(scale.bounded_broadcast(small, 10)) and scale.bounded_broadcast(small, 10).count() == 5
    assert "broadcast" not in plan(scale.bounded_broadcast(large, 10)) and scale.bounded_broadcast(large, 10).count() == 30


def test_blocks_hold_each_row_once_as_core(spark):
    d = spark.range(200).withColumn("p", F.when(F.col("id") > 150, None).otherwise(F.col("id")))
    out = scale.with_blocks(d, "p", 50, 5).collect()
    core = [r for r in out if r["_core"]]
    assert len(core) == 200 and {r["id"] for r in core} == set(range(200))
    assert {r["_block"] for r in out} == {0, 1, 2, 3} and min(r["_block"] for r in out) == 0
    assert {r["id"] for r in out if r["_block"] == 1} >= set(range(45, 105))


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(1, 9), max_size=12), st.integers(1, 7), st.integers(1, 20))
def test_groups_are_given_whole(sizes, batch, rows):
    frame = pd.DataFrame({"a": np.repeat(np.arange(len(sizes)) // 2, sizes), "b": np.repeat(np.arange(len(sizes)), sizes), "v": np.arange(sum(sizes))})
    batches = [frame.iloc[i : i + batch] for i in range(0, len(frame), batch)]
    seen = []
    for whole, starts in scale.sorted_groups(iter(batches), ["a", "b"], rows):
        assert starts[0] == 0 and starts[-1] == len(whole)
        for lo, hi in zip(starts[:-1], starts[1:]):
            assert whole["b"].iloc[lo:hi].nunique() == 1
            seen.append(whole["b"].iloc[lo])
    assert seen == list(range(len(sizes)))


def test_numbers_over_all_rows(spark):
    d = spark.range(100).withColumn("k", F.col("id") * 7)
    out = S.number_globally(d, F.floor(F.col("k") / 50), ["k"], "n").collect()
    assert all(r["n"] == r["id"] for r in out)


def test_checkpoints_survive_and_cut_lineage(spark):
    d = scale.durable(spark.range(10).withColumn("x", F.rand()))
    assert d.agg(F.sum("x")).first()[0] == d.agg(F.sum("x")).first()[0]
    assert "Rand" not in d._jdf.queryExecution().executedPlan().toString()


def test_hot_keys_are_spread_and_joined_whole(spark):
    big = spark.range(1000).withColumn("k", F.when(F.col("id") < 400, 0).otherwise(F.col("id") % 7))
    small = spark.createDataFrame([(i, f"v{i}") for i in range(6)], "k long, v string")
    hot = scale.hot_keys(big, "k", 100)
    assert {tuple(r) for r in hot.collect()} == {(0, 5)}
    for how, n in (("inner", 1000 - 85), ("left", 1000)):
        got = scale.spread_join(big, small, "k", "id", hot, how)
        assert got.columns == ["k", "id", "v"] and got.count() == n == got.select("id").distinct().count()
        assert all(r["v"] == (f"v{r['k']}" if r["k"] < 6 else None) for r in got.collect())


def test_a_cluster_needs_a_shared_checkpoint_folder():
    import pytest

    class Bare:
        master = "spark://somewhere:7077"

        class conf:  # noqa: N801
            get = staticmethod(lambda name, default: default)

        getCheckpointDir = staticmethod(lambda: None)  # noqa: N815

    Bare.sparkContext = Bare
    with pytest.raises(RuntimeError):
        scale.checkpoint_folder(Bare)


def test_far_neighbours_are_fetched(spark):
    d = spark.createDataFrame([("a", p, p % 2 == 0) for p in (0, 1, 2, 3, 900, 901, 1800, 1801, 1802)], "k string, p long, even boolean")
    out = scale.with_neighbours(d, ["k"], "p", 100, 4, 2, [F.col("even")]).collect()
    core = sorted(r["p"] for r in out if r["_core"])
    assert core == [0, 1, 2, 3, 900, 901, 1800, 1801, 1802]
    seen = {b: {r["p"] for r in out if r["_block"] == b} for b in (0, 9, 18)}
    assert seen[9] >= {2, 3, 900, 901, 1800, 1801} and seen[0] >= {900, 1800} and seen[18] >= {901, 900, 2}
