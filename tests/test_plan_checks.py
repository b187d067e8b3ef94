"""Manifests, annotations and registrations that are wrong in one way each."""

import json

from pyspark.sql import functions as F

from armlode.functions import text
from armlode.operators import registration
from armlode.plans import acquire


def test_each_error_of_a_manifest(spark):
    kinds = "k string, requested_seconds double, selected_seconds double, selected_frames long, sample_rows long, max_slice_bytes long"
    rows = [("fine", 5.0, 6.0, 30, 30, None), ("short", 9.0, 6.0, 30, 30, None), ("sum", 5.0, 6.0, 31, 30, None), ("rows", 5.0, 6.0, None, None, None), ("bare", 5.0, 6.0, 30, 30, None), ("large", 5.0, 6.0, 30, 30, 99)]
    episodes = spark.createDataFrame([(r[0], n) for r in rows for n in (10, 20)], "k string, frames long")
    files = spark.createDataFrame([(r[0], 50) for r in rows if r[0] != "bare" for _ in range(2)], "k string, bytes long")
    got = {r["k"]: r["errors"] for r in acquire.manifest_errors(spark.createDataFrame(rows, kinds), episodes, files, "k").collect()}
    assert got["fine"] == "" and "shorter" in got["short"] and "selected_frames" in got["sum"] and got["rows"].startswith("sample_rows") and "no files" in got["bare"] and "limit" in got["large"]
    assert acquire.manifest_errors(spark.createDataFrame([], kinds), episodes, files, "k").count() == 0


def test_labels_under_a_misspelt_key(spark):
    actions = {"action_config": [{"end_frame": 4}, {"end_frame": 9}]}
    d = spark.createDataFrame([(json.dumps({"label_info": actions}),), (json.dumps({"lable_info": actions}),), (json.dumps({"label_info": {}}),), ("{broken",), (None,)], "j string")
    assert [r[0] for r in d.select(text.annotation_frames(F.col("j"))).collect()] == [9, 9, 0, 0, 0]


def test_bases_that_sides_do_not_share(spark):
    def row(i, right, left, shared=True):
        return (i, json.dumps({"registration": {"shared_base_frame": shared, "openarm_from_source_base": {"right": right, "left": left}}}))

    one, other = [0.1] * 7, [0.1] * 6 + [0.2]
    rows = [row(1, one, one), row(2, one, other), row(3, one, one, False), row(4, one[:6], one[:6]), (5, json.dumps({"registration": "fitted"})), (6, "{broken"), (7, None), (8, json.dumps({"registration": {}}))]
    assert {r[0] for r in registration.base_errors(spark.createDataFrame(rows, "episode_id long, metadata string")).collect()} == {2, 3, 4}
