import datetime as dt

from data import FRAMES, NOW, frame

from armlode.streaming import live


def run(spark, tmp_path, make, name):
    """Two files of frames as two batches of a stream; gives the sink's rows."""
    src = tmp_path / "in"
    rows = [frame(i=i, at=NOW + dt.timedelta(seconds=i)) for i in range(6)]
    for k, part in enumerate((rows[:3], [rows[2], *rows[3:]])):
        spark.createDataFrame(part, FRAMES).coalesce(1).write.mode("append").parquet(str(src))
    stream = spark.readStream.schema(FRAMES).option("maxFilesPerTrigger", 1).parquet(str(src))
    q = make(stream).writeStream.outputMode("append").format("memory").queryName(name).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.table(name).collect()


def test_repeats_are_dropped_across_batches(spark, tmp_path):
    assert len(run(spark, tmp_path, live.arriving, "arrived")) == 6


def test_state_outlives_batches(spark, tmp_path):
    out = {r["frame_idx"]: r["speed"] for r in run(spark, tmp_path, live.joint_speeds, "speeds")}
    assert len(out) == 6 and [i for i in out if out[i] is None] == [0] and abs(out[3] - abs((0.03 + 0.003 * __import__("math").sin(3.9)) - (0.02 + 0.003 * __import__("math").sin(2.6))) / 0.1) < 1e-9


def test_windows_are_given_out_past_the_watermark(spark, tmp_path):
    out = run(spark, tmp_path, lambda s: live.arrivals_per_window(s, "1 second", "2 seconds"), "windows")
    assert out and all(r["frames"] >= 1 for r in out)
