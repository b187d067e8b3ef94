import glob
import json
import os

import pytest

from armlode.operators import export

SMALL = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables here")
def test_written_dataset_is_whole(spark, tmp_path):
    frames, episodes = (spark.read.parquet(f"{SMALL}/{n}.parquet") for n in ("frames", "episodes"))
    path = str(tmp_path / "set")
    export.write_dataset(frames, episodes, path)
    data, runs = spark.read.parquet(f"{path}/data"), spark.read.parquet(f"{path}/meta/episodes")
    report = export.validate_export(data, runs).first()
    assert report.ok and report.frames == data.count() > 0
    info = json.loads("".join(open(p).read() for p in glob.glob(f"{path}/meta/info/*.json")))
    assert (info["total_frames"], info["total_episodes"], info["splits"]) == (report.frames, report.episodes, {"train": f"0:{report.episodes}"})
    assert info["total_tasks"] == spark.read.parquet(f"{path}/meta/tasks").count() and info["features"]["action"] == {"dtype": "float32", "shape": [16]}
    assert set(info["features"]) == set(data.columns) and spark.read.parquet(f"{path}/meta/stats").count() == 16


def test_an_empty_dataset_has_zeros(spark):
    runs = spark.createDataFrame([], "length long, task_index long")
    assert export.dataset_info(runs).first()[:3] == (0, 0, 0)
