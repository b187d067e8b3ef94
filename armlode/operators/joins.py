"""The join shapes of frame data, each with the plan that holds at scale."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from armlode.operators.scale import union_rows


def selected(rows: DataFrame, chosen: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Semi join: rows whose key is among the chosen, once each."""
    return rows.join(chosen.select(*keys), list(keys), "left_semi")


def missing(expected: DataFrame, present: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Anti join: what is expected and not present."""
    return expected.select(*keys).distinct().join(present.select(*keys), list(keys), "left_anti")


def in_ranges(ranges: DataFrame, points: DataFrame, low: str, high: str, point: str, width: int = 64) -> DataFrame:
    """Range semi join: ranges that hold any point.

    Ranges are laid over buckets of ``width`` and joined on the bucket, so the join is an equi join that shuffles,
    not a nested loop. Each range is kept once.
    """
    keyed = ranges.withColumn("_id", F.monotonically_increasing_id())
    laid = keyed.filter(F.col(low) <= F.col(high)).withColumn("_b", F.explode(F.sequence(F.floor(F.col(low) / width).cast("long"), F.floor(F.col(high) / width).cast("long"))))
    at = points.select(F.col(point).alias("_p")).distinct().withColumn("_b", F.floor(F.col("_p") / width).cast("long"))
    hit = laid.join(at, "_b").filter(F.col("_p").between(F.col(low), F.col(high)))
    return hit.dropDuplicates(["_id"]).select(*ranges.columns)


def lookup_last(left: DataFrame, right: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Unique-key lookup where the last of repeated keys wins; keys without one keep nulls."""
    last = right.groupBy(*keys).agg(F.max_by(F.struct(*values), F.struct(*order)).alias("_v")).select(*keys, "_v.*")
    return left.join(last, list(keys), "left")


def positional(a: DataFrame, b: DataFrame, keys: Sequence[str], order_a: Sequence[str], order_b: Sequence[str], how: str = "inner") -> DataFrame:
    """Joins by place within each key; ``how`` 'full' also shows the places that only one side has."""
    number = lambda d, order: d.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return number(a, order_a).join(number(b, order_b), [*keys, "place"], how)


def constant_or_framed(frames: DataFrame, values: DataFrame, keys: Sequence[str], frame: str, columns: Sequence[str]) -> DataFrame:
    """Values given once for a key or once for each frame: a single row of a key holds for all its frames."""
    n = F.count("*").over(Window.partitionBy(*keys))
    v = values.select(*keys, frame, *columns).withColumn("_n", n)
    fixed = v.filter("_n = 1").select(*keys, *[F.col(c).alias(f"_c_{c}") for c in columns])
    framed = v.filter("_n > 1").select(*keys, frame, *columns)
    j = frames.join(fixed, list(keys), "left").join(framed, [*keys, frame], "left")
    return j.select(*frames.columns, *[F.coalesce(f"_c_{c}", c).alias(c) for c in columns])


def within_segments(rows: DataFrame, segments: DataFrame, keys: Sequence[str], at: str, low: str, high: str) -> DataFrame:
    """Interval join local to a key; of overlapping segments the later one holds."""
    s = segments.select(*keys, F.col(low).alias("_low"), F.col(high).alias("_high"), *[c for c in segments.columns if c not in (*keys, low, high)])
    hit = rows.join(s, list(keys), "left").withColumn("_in", F.col(at).between(F.col("_low"), F.col("_high")))
    w = Window.partitionBy(*keys, at).orderBy(F.desc(F.coalesce(F.col("_in"), F.lit(False))), F.desc("_low"))
    return hit.withColumn("_r", F.row_number().over(w)).filter("_r = 1").withColumn("inside", F.coalesce("_in", F.lit(False))).drop("_r", "_in")


def nearest(points: DataFrame, centres: Sequence[tuple[str, tuple[float, float, float]]], xyz: Sequence[Column]) -> DataFrame:
    """The centre nearest to each point and the squared distance; of equal ones the first listed. Centres are a short literal list."""
    options = [F.struct(sum(((c - v) * (c - v) for c, v in zip(xyz[1:], at[1:])), (xyz[0] - at[0]) * (xyz[0] - at[0])).alias("d"), F.lit(i).alias("i"), F.lit(n).alias("n")) for i, (n, at) in enumerate(centres)]
    best = F.least(*options)
    return points.withColumns({"nearest": best["n"], "squared": best["d"]})


def as_of(left: DataFrame, right: DataFrame, keys: Sequence[str], at: str, values: Sequence[str]) -> DataFrame:
    """For each left row the last right values at or before its time: one union, one window, no range join."""
    a = left.withColumn("_left", F.lit(True))
    b = right.select(*keys, at, *[F.col(v).alias(f"_r_{v}") for v in values]).withColumn("_left", F.lit(False))
    both = union_rows(a, b)
    w = Window.partitionBy(*keys).orderBy(at, "_left").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumns({v: F.last(F.when(~F.col("_left"), F.struct(f"_r_{v}")), ignorenulls=True).over(w)[f"_r_{v}"] for v in values}).filter("_left").select(*left.columns, *values)
