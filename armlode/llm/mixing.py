"""Mixing sources to target weights: a curriculum of training positions with capped repeats."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from armlode.operators.scale import bounded_broadcast
from armlode.sources.tables import source_key

#: Buckets of one source's running total: prefix sums are taken over buckets, then within each.
BUCKETS = 256
#: Stages of the default schedule.
STAGES = 10


def recordings(selected: DataFrame, source_config: DataFrame) -> DataFrame:
    """(source, episode_index, seconds): each recording once.

    ``seconds`` or, where null, frames / fps of the source; of repeated rows the greatest. A recording
    without either has no size and is left out, as is one without source or number.
    """
    rates = source_config.groupBy(source_key("name").alias("source")).agg(F.min(F.when(F.col("fps") > 0, F.col("fps"))).alias("fps"))
    rows = selected.select(source_key("source_dataset").alias("source"), "episode_index", "frames", F.col("seconds").alias("own")).filter("source is not null and episode_index is not null")
    once = rows.groupBy("source", "episode_index").agg(F.max("own").alias("own"), F.max("frames").alias("frames"))
    sized = once.join(bounded_broadcast(rates), "source", "left").withColumn("seconds", F.coalesce("own", F.try_divide("frames", "fps")))
    return sized.filter("seconds is not null and seconds >= 0").select("source", "episode_index", "seconds")


def demands(records: DataFrame, targets: DataFrame) -> DataFrame:
    """Per (mixture_id, source_dataset): source, what it holds, the mixture's total, its target, what it can give and gives.

    The total of a mixture is the size of all sources listed in it. A source gives its target, at
    most ``max_repeats`` times its size; without a cap a source that holds anything gives its target.
    """
    sizes = records.groupBy("source").agg(F.sum(F.col("seconds").cast("decimal(38,9)")).cast("double").alias("held"))
    rows = targets.filter("mixture_id is not null").groupBy("mixture_id", "source_dataset").agg(F.max(F.coalesce("weight", F.lit(0.0))).alias("weight"), F.max("max_repeats").alias("max_repeats"))
    joined = rows.withColumn("source", source_key("source_dataset")).join(bounded_broadcast(sizes), "source", "left").fillna(0.0, ["held"])
    mixture = Window.partitionBy("mixture_id")
    share = F.try_divide("weight", F.sum("weight").over(mixture))
    full = joined.withColumns({"total": F.sum("held").over(mixture), "share": F.coalesce(share, F.lit(0.0))}).withColumn("target", F.col("total") * F.col("share"))
    room = F.when(F.col("max_repeats").isNotNull(), F.col("max_repeats") * F.col("held")).when(F.col("held") > 0, F.lit(float("inf"))).otherwise(0.0)
    return full.withColumn("capacity", room).withColumn("given", F.least("target", "capacity"))


def running_total(df: DataFrame, keys: Sequence[str], order: Sequence[str], size: str, out: str) -> DataFrame:
    """Adds the sum of ``size`` over the rows before each one, per ``keys`` in ``order``.

    Two levels: rows are hashed into buckets, totals of buckets are summed in bucket order, and
    within a bucket rows are summed in ``order``. The order of rows is by (bucket, order): fixed, shuffled, and no
    task needs a whole key, so one source may hold any part of the rows.
    """
    exact = F.col(size).cast("decimal(38,9)")
    rows = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(BUCKETS)))
    sums = rows.groupBy(*keys, "_bucket").agg(F.sum(exact).alias("_sum"))
    before = sums.withColumn("_start", F.coalesce(F.sum("_sum").over(Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("decimal(38,9)"))).drop("_sum")
    within = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    placed = rows.withColumn("_within", F.coalesce(F.sum(exact).over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("decimal(38,9)")))
    return placed.join(before, [*keys, "_bucket"]).withColumn(out, (F.col("_start") + F.col("_within")).cast("double")).drop("_bucket", "_start", "_within")


def default_schedule(wanted: DataFrame) -> DataFrame:
    """(mixture_id, source_dataset, start, weight): sources whose target exceeds what they hold start heavy and fall off, others rise.

    ``STAGES`` stages of equal length, with weights in proportion to 1 -/+ (2 s - 1) / 2 at their middle s.
    """
    shape = F.when(F.col("target") > F.col("held"), -0.5).otherwise(0.5)
    staged = wanted.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(STAGES - 1))))
    return staged.select("mixture_id", "source_dataset", (F.col("k") / STAGES).alias("start"), (1 + shape * (2 * (F.col("k") + 0.5) / STAGES - 1)).alias("weight"))


def demand_pieces(wanted: DataFrame, schedule: DataFrame) -> DataFrame:
    """(mixture_id, source_dataset, pieces): each source's cumulative demand against the mixture's, piece by piece.

    ``schedule`` holds (mixture_id, source_dataset, start, weight): from ``start`` (0..1 of the schedule) until its next row a source is drawn by
    that weight; before its first row, and where it has none at all, by 1. Each source's weight is integrated over the
    stages of its mixture and scaled to what it gives in all. A piece (from, size, low, high) says that the
    source's demand from ``from`` on, ``size`` in all, falls due while the summed demand of all sources runs from the share ``low`` to ``high``. Weights that
    are null, negative or add up to nothing count as 1.
    """
    keys = ["mixture_id", "source_dataset"]
    plan = schedule.filter("start >= 0 and start < 1 and mixture_id is not null").groupBy(*keys, "start").agg(F.max(F.when(F.col("weight") >= 0, F.col("weight")).otherwise(1.0)).alias("weight"))
    edges = plan.select("mixture_id", "start").union(wanted.select("mixture_id", F.lit(0.0).alias("start"))).distinct()
    staged = edges.withColumn("length", F.lead("start", 1, 1.0).over(Window.partitionBy("mixture_id").orderBy("start")) - F.col("start"))
    every = wanted.select(*keys, "given").join(staged, "mixture_id").join(plan, [*keys, "start"], "left")
    ahead = Window.partitionBy(*keys).orderBy("start")
    held = every.withColumn("weight", F.coalesce(F.last("weight", ignorenulls=True).over(ahead), F.lit(1.0)))
    mass, all_mass = F.col("weight") * F.col("length"), F.sum(F.col("weight") * F.col("length")).over(Window.partitionBy(*keys))
    size = F.col("given") * F.when(all_mass > 0, mass / all_mass).otherwise(F.col("length"))
    due = held.withColumn("size", size)
    upto = F.sum("size").over(ahead.rowsBetween(Window.unboundedPreceding, 0))
    stages = due.groupBy("mixture_id", "start").agg(F.sum("size").alias("all"))
    run = Window.partitionBy("mixture_id").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    whole = F.sum("all").over(Window.partitionBy("mixture_id"))
    ranges = stages.withColumns({"high": F.sum("all").over(run) / whole, "low": (F.sum("all").over(run) - F.col("all")) / whole})
    pieces = due.withColumn("from", upto - F.col("size")).join(ranges.drop("all"), ["mixture_id", "start"]).filter("size > 0")
    return pieces.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("from", "size", "low", "high"))).alias("pieces"))


def curriculum(records: DataFrame, targets: DataFrame, schedule: DataFrame | None = None) -> DataFrame:
    """The training order of every mixture: (mixture_id, source_dataset, source, episode_index, repeat, seconds, position).

    Each source's demand is laid end to end over its records, repeated as often as the demand needs. A
    record is in once for each time its middle lies within the demand, so no source is off its demand by more than half a record. Its
    position (0..1) inverts the source's cumulative demand under ``schedule`` (see :func:`demand_pieces`; by default small sources start heavy and
    large ones rise) and is counted in summed demand: every tenth of positions holds a tenth of the seconds, and each source keeps its total
    share. Rows are range-partitioned and sorted by (mixture_id, position).

    No record is in more than ``max_repeats`` times. Sources without size give nothing; weights of 0 or null
    too. Empty tables give no rows. A null ``source_dataset`` matches no source.
    """
    want = demands(records, targets).filter("given > 0").select("mixture_id", "source_dataset", "source", "held", "target", "given", "max_repeats")
    want = bounded_broadcast(want)
    pieces = demand_pieces(want, default_schedule(want) if schedule is None else schedule)
    spaced = running_total(records, ["source"], ["episode_index"], "seconds", "start")
    # as many laps of a source's records as its demand takes
    laps = F.ceil(F.col("given") / F.col("held") - 1e-12).cast("int")
    capped = F.least(laps, F.coalesce("max_repeats", laps))
    lapped = want.join(pieces, ["mixture_id", "source_dataset"]).withColumn("repeat", F.explode(F.sequence(F.lit(0), F.greatest(capped - 1, F.lit(0)))))
    rows = spaced.join(bounded_broadcast(lapped), "source").withColumn("at", F.col("start") + F.col("repeat") * F.col("held")).filter(F.col("at") + F.col("seconds") / 2 <= F.col("given"))
    piece = F.element_at(F.filter("pieces", lambda p: (p["from"] <= F.col("at")) | (p["from"] <= 0)), -1)
    part = F.least((F.col("at") - piece["from"]) / piece["size"], F.lit(1.0))
    placed = rows.withColumn("position", piece["low"] + (piece["high"] - piece["low"]) * part)
    out = placed.select("mixture_id", "source_dataset", "source", "episode_index", F.col("repeat").cast("int").alias("repeat"), "seconds", "position")
    return out.repartitionByRange("mixture_id", "position").sortWithinPartitions("mixture_id", "position", "source", "episode_index", "repeat")


def mixture_report(records: DataFrame, targets: DataFrame, schedule: DataFrame | None = None) -> DataFrame:
    """What each source of each mixture was to give and gives in :func:`curriculum`.

    (mixture_id, source_dataset, held, total, target, capacity, mixed, records, most_repeats, actual_share, short):
    ``mixed`` and the shares come from the placed rows; ``short`` says that the target can't be reached.
    """
    placed = curriculum(records, targets, schedule)
    given = placed.groupBy("mixture_id", "source_dataset").agg(
        F.sum(F.col("seconds").cast("decimal(38,9)")).cast("double").alias("mixed"), F.count("*").alias("records"), (F.max("repeat") + 1).alias("most_repeats")
    )
    joined = demands(records, targets).join(given, ["mixture_id", "source_dataset"], "left").fillna({"mixed": 0.0, "records": 0, "most_repeats": 0})
    share = F.try_divide("mixed", F.sum("mixed").over(Window.partitionBy("mixture_id")))
    # placed rows are off the demand by half a record, so an unreached target shows in them too
    short = (F.col("target") > 0) & (F.col("target") > F.col("capacity") * (1 + 1e-12)) & (F.col("mixed") <= F.col("capacity") * (1 + 1e-9) + 1e-6)
    return joined.select("mixture_id", "source_dataset", "held", "total", "share", "target", "capacity", "mixed", "records", "most_repeats", F.coalesce(share, F.lit(0.0)).alias("actual_share"), short.alias("short"))


def unreachable_targets(records: DataFrame, targets: DataFrame) -> DataFrame:
    """The sources that can't reach their target: (mixture_id, source_dataset)."""
    return mixture_report(records, targets).filter("short").select("mixture_id", "source_dataset")
