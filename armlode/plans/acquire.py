"""Planning which files and episodes to fetch, over metadata tables, and checking what came."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from armlode.functions.text import archive_range
from armlode.operators.joins import in_ranges
from armlode.operators.sequence import budget_prefix

#: Fixed value: no slice may be larger, in bytes.
CEILING = 20_000_000_000


def check_ceiling(max_bytes: int) -> int:
    """The ceiling of a slice; it can be lowered, not raised."""
    if not 0 < max_bytes <= CEILING:
        raise ValueError(f"max_bytes must lie within 1 and {CEILING}")
    return max_bytes


def keyword_select(rows: DataFrame, keys: Sequence[str], tasks: str, keywords: Sequence[str]) -> DataFrame:
    """Rows whose tasks contain any keyword, whatever the case; all rows of a key where none of its rows does.

    The fallback is a window over the key, not a second pass. Null and empty task lists match nothing.
    """
    if not keywords:
        return rows
    hit = F.exists(F.coalesce(F.col(tasks), F.array().cast("array<string>")), lambda t: F.coalesce(_any_of(F.lower(t), keywords), F.lit(False)))
    d = rows.withColumn("_hit", hit).withColumn("_some", F.max("_hit").over(Window.partitionBy(*keys)))
    return d.filter(F.col("_hit") | ~F.col("_some")).drop("_hit", "_some")


def _any_of(text: Column, words: Sequence[str]) -> Column:
    found = text.contains(words[0].lower())
    for w in words[1:]:
        found = found | text.contains(w.lower())
    return found


def plan_episodes(rows: DataFrame, keys: Sequence[str], order: Sequence[str], seconds: str, budget: float) -> DataFrame:
    """Whole episodes in order until the budget is reached, with the one that crosses it; ``reached`` says whether a key does."""
    total = F.sum(seconds).over(Window.partitionBy(*keys))
    return budget_prefix(rows.filter(F.col(seconds).isNotNull()).withColumn("reached", total >= budget), keys, order, seconds, budget)


def planned_files(plan: DataFrame, keys: Sequence[str], data_file: str, video_files: str, cameras: Sequence[str] | None = None) -> DataFrame:
    """(keys, file, kind, episodes): the distinct files of a plan. ``cameras`` None takes all, an empty list none."""
    videos = plan.select(*keys, F.explode(video_files).alias("file"), F.lit("video").alias("kind"))
    if cameras is not None:
        videos = videos.filter(_any_of(F.col("file"), [f"/{c}/" for c in cameras])) if cameras else videos.limit(0)
    files = plan.filter(F.col(data_file).isNotNull()).select(*keys, F.col(data_file).alias("file"), F.lit("data").alias("kind")).unionByName(videos)
    return files.groupBy(*keys, "file", "kind").agg(F.count("*").alias("episodes"))


def camera_segments(plan: DataFrame, keys: Sequence[str], segments: str, rate: Column) -> DataFrame:
    """One row per episode and camera: its file, where it starts in it in frames (half to even), how long it is."""
    d = plan.select(*keys, rate.alias("_fps"), F.explode(segments).alias("s"))
    return d.select(*keys, F.col("s.key").alias("camera"), F.col("s.file").alias("file"), F.bround(F.col("s.from_timestamp") * F.col("_fps")).cast("bigint").alias("first_frame"), (F.col("s.to_timestamp") - F.col("s.from_timestamp")).alias("seconds"))


def required_archives(names: DataFrame, wanted: DataFrame, name: str, episode: str) -> DataFrame:
    """Archives to fetch: those whose range holds a wanted episode, and statistics archives in any case."""
    low, high = archive_range(F.col(name))
    ranged = names.withColumns({"_low": low, "_high": high})
    hit = in_ranges(ranged.filter("_low is not null"), wanted, "_low", "_high", episode).select(name)
    always = names.filter(F.col(name).startswith("proprio_stats/") & F.col(name).endswith(".tar")).select(name)
    return hit.union(always).distinct()


def verify_files(manifest: DataFrame, present: DataFrame, key: str = "file") -> DataFrame:
    """(file, problem): planned files that are missing, or differ in size or hash from what is there.

    ``manifest`` and ``present`` hold (file, bytes, sha256).
    """
    there = present.select(key, F.col("bytes").alias("_bytes"), F.col("sha256").alias("_sha"))
    problem = F.when(F.col("_bytes").isNull(), "missing").when(F.col("_bytes") != F.col("bytes"), "size mismatch").when(F.col("_sha") != F.col("sha256"), "hash mismatch")
    return manifest.join(there, key, "left").withColumn("problem", problem).filter("problem is not null").select(key, "problem")


def manifest_report(plan: DataFrame, keys: Sequence[str], frames: str, seconds: str, requested: float) -> DataFrame:
    """Per key: episodes, frames, seconds, and what is wrong with the plan."""
    agg = plan.groupBy(*keys).agg(F.count("*").alias("episodes"), F.sum(frames).alias("frames"), F.sum(seconds).alias("seconds"))
    return agg.withColumn("errors", F.when(F.col("seconds") < requested, "selected duration is shorter than requested duration").otherwise(""))


def manifest_errors(manifests: DataFrame, episodes: DataFrame, files: DataFrame, key: str) -> DataFrame:
    """(key, episodes, frames, files, bytes, errors): what is wrong with each manifest, joined by '; '.

    ``manifests`` holds (key, requested_seconds, selected_seconds, selected_frames, sample_rows, max_slice_bytes), one row per key, ``episodes`` (key,
    frames) and ``files`` (key, bytes). Null counts of frames or a null ceiling are not stated: the episodes' sum and the ceiling
    hold; a null number of sample rows is an error.
    """
    e = episodes.groupBy(key).agg(F.count("*").alias("episodes"), F.coalesce(F.sum("frames"), F.lit(0)).alias("frames"))
    f = files.groupBy(key).agg(F.count("*").alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))
    d = manifests.join(e, key, "left").join(f, key, "left").fillna(0, ["episodes", "frames", "files", "bytes"])
    errors = F.array_compact(F.array(
        F.when(F.col("selected_seconds") < F.col("requested_seconds"), "selected duration is shorter than requested duration"),
        F.when(F.coalesce("selected_frames", "frames") != F.col("frames"), "selected_frames does not equal the episode frame sum"),
        F.when(~F.col("sample_rows").eqNullSafe(F.col("frames")), "sample_rows does not equal the episode frame sum"),
        F.when(F.col("files") == 0, "manifest contains no files"),
        F.when(F.col("bytes") > F.coalesce("max_slice_bytes", F.lit(CEILING)), "files exceed the slice limit"),
    ))
    return d.select(key, "episodes", "frames", "files", "bytes", F.array_join(errors, "; ").alias("errors"))


def remaining(work: DataFrame, done: DataFrame, keys: Sequence[str], signature: str = "signature") -> DataFrame:
    """Work not yet done: no committed row has its key, its signature and a feasible frame."""
    fine = done.filter("feasible_frames > 0").select(*keys, signature)
    return work.join(fine, [*keys, signature], "left_anti")


def signature(columns: Sequence[str]) -> Column:
    """A hash of settings, whatever the order in which they are named."""
    return F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256)
