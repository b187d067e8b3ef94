"""Helpers that keep plans sound at scale: size-checked broadcasts, block splits with halos, checkpoints."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows that a side may hold at most to be sent to every executor.
BROADCAST_ROWS = 4096


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` as a broadcast literal if it has at most ``max_rows`` rows, else ``df`` unchanged.

    At most ``max_rows + 1`` rows reach the driver, so the check itself is bounded. A larger side
    takes the shuffled join that Spark picks. ``df`` is evaluated once here, which also fixes
    its values for every later use.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder for intermediate data: the session's ``spark.checkpoint.dir``.

    Where it is unset, a local session (tests) gets a temporary folder; a cluster gets an error, as its executors
    would each write to a disk of their own.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="armlode-"))
    return sc.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """``df`` written to the checkpoint folder and read from there: lineage is cut and losses are survived."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as a Parquet table in the checkpoint folder: like :func:`durable`, but read again column by column."""
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows that a key may have before a join counts it as hot.
HOT_ROWS = 100_000


def hot_keys(df: DataFrame, key: str, rows: int | None = None) -> DataFrame:
    """(key, _salts): the keys with more than ``rows`` (``HOT_ROWS``) rows, and over how many parts to spread them.

    The 1024 largest at most, which are broadcast: any other key has less than a 1024th of all rows, whatever the data. Counts are partial before they are shuffled.
    """
    rows = rows or HOT_ROWS
    counts = df.groupBy(key).agg(F.count("*").alias("_n")).filter(F.col("_n") > rows)
    return bounded_broadcast(counts.orderBy(F.desc("_n"), key).limit(1024).select(key, F.ceil(F.col("_n") / rows).cast("int").alias("_salts")))


def spread_join(big: DataFrame, small: DataFrame, key: str, by: str, hot: DataFrame, how: str = "inner") -> DataFrame:
    """``big`` joined with ``small``, of which each key has few rows; the rows of ``hot`` keys of ``big`` are spread by the hash of ``by``.

    A key with a third of all rows is so joined by many tasks. Rows of ``small`` are repeated for its hot keys only. ``how`` is 'inner' or 'left'.
    """
    left = big.join(hot, key, "left").withColumn("_salt", F.when(F.col("_salts").isNotNull(), F.pmod(F.xxhash64(by), F.col("_salts"))).otherwise(0)).drop("_salts")
    right = small.join(hot, key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).withColumn("_salt", F.col("_salt").cast("long")).drop("_salts")
    return left.withColumn("_salt", F.col("_salt").cast("long")).join(right, [key, "_salt"], how).drop("_salt")


def with_blocks(df: DataFrame, position: str | Column, block: int, halo: int) -> DataFrame:
    """Adds ``_block`` and ``_core``: each row once as core of its block, and as halo of a neighbour it is near to.

    ``position`` is an integer place within a series. A window partitioned by the series and
    ``_block`` then sees ``halo`` places on either side of each core row, so one long series
    becomes many tasks. Positions start at 0; rows with a null position are core of block 0.
    """
    pos = F.coalesce(F.col(position) if isinstance(position, str) else position, F.lit(0)).cast("long")
    own = F.floor(pos / F.lit(block)).cast("long")
    within = pos - own * F.lit(block)
    blocks = F.array_compact(F.array(own, F.when((within < halo) & (own > 0), own - 1), F.when(within >= block - halo, own + 1)))
    return df.withColumn("_own", own).withColumn("_block", F.explode(blocks)).withColumn("_core", F.col("_block") == F.col("_own")).drop("_own")


def with_neighbours(df: DataFrame, keys: Sequence[str], position: str, block: int, halo: int, near: int, having: Sequence[Column] = ()) -> DataFrame:
    """:func:`with_blocks`, and for each block also the rows nearest to it beyond its halo, however far they lie.

    A block gets at least the ``near`` rows before and after it, and as many of those for which each of ``having`` holds.
    Which places hold rows is gathered as one short list per block; only where rows are sparse at an edge are rows
    fetched from afar, by an equi join on small buckets of places.
    """
    width = max(1, halo // near)
    pos = F.coalesce(F.col(position), F.lit(0)).cast("long")
    bucket, own = F.floor(pos / width).cast("long"), F.floor(pos / block).cast("long")
    conditions = [F.lit(True), *having]
    sets = df.groupBy(*keys, own.alias("_block")).agg(*[F.array_sort(F.collect_set(F.when(c, bucket))).alias(f"_s{i}") for i, c in enumerate(conditions)])
    order = Window.partitionBy(*keys).orderBy("_block")
    low, high = F.col("_block") * block - halo, (F.col("_block") + 1) * block + halo
    last = lambda c: F.reverse(F.slice(F.reverse(c), 1, near))
    far = []
    for i in range(len(conditions)):
        held = F.col(f"_s{i}")
        some = F.size(held) > 0
        of_held = Window.partitionBy(*keys, some).orderBy("_block")
        sets = sets.withColumns({
            f"_u{i}": F.when(some, last(F.flatten(F.collect_list(last(held)).over(of_held.rowsBetween(1 - near, 0))))),
            f"_d{i}": F.when(some, F.slice(F.flatten(F.collect_list(F.slice(held, 1, near)).over(of_held.rowsBetween(0, near - 1))), 1, near)),
        })
    for i in range(len(conditions)):
        sets = sets.withColumns({
            f"_u{i}": F.last(f"_u{i}", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1)),
            f"_d{i}": F.first(f"_d{i}", ignorenulls=True).over(order.rowsBetween(1, Window.unboundedFollowing)),
        })
        none = F.array().cast("array<bigint>")
        far += [F.filter(F.coalesce(f"_u{i}", none), lambda b: b * width < low), F.filter(F.coalesce(f"_d{i}", none), lambda b: (b + 1) * width > high)]
    wanted = sets.select(*keys, F.col("_block").alias("_to"), F.explode(F.array_distinct(F.concat(*far))).alias("_bucket"))
    hit = df.withColumn("_bucket", bucket).join(bounded_broadcast(wanted), [*keys, "_bucket"])
    beyond = (pos < F.col("_to") * block - halo) | (pos >= (F.col("_to") + 1) * block + halo)
    extra = hit.filter(beyond).select(*df.columns, F.col("_to").alias("_block"), F.lit(False).alias("_core"))
    return union_rows(with_blocks(df, position, block, halo), extra)


def union_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of both; missing columns are null.

    Where both sides are already partitioned alike, Spark 4.1 takes their union to be so too, and adaptive execution may
    then pair partitions that were coalesced differently: groups come out in parts (a ``repartition`` after the union is
    planned away for the same reason). That shortcut is switched off in the session, so what groups the union shuffles it.
    """
    a.sparkSession.conf.set("spark.sql.unionOutputPartitioning", "false")
    return a.unionByName(b, allowMissingColumns=True)


def sorted_groups(frames: Iterator[pd.DataFrame], keys: list[str], rows: int = 60_000) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Whole groups from a partition whose rows are sorted by ``keys``.

    Yields frames of one or more complete groups, each with the array of group starts (and the
    end). A frame holds about ``rows`` rows, so memory is bounded by that and the largest group.
    """

    def cut(parts: list[pd.DataFrame]) -> tuple[pd.DataFrame, np.ndarray]:
        whole = pd.concat(parts, ignore_index=True) if len(parts) > 1 else parts[0].reset_index(drop=True)
        return whole, boundaries(whole)

    def boundaries(frame: pd.DataFrame) -> np.ndarray:
        change = np.zeros(len(frame), dtype=bool)
        change[:1] = True
        for key in keys:
            v = frame[key].to_numpy()
            change[1:] |= v[1:] != v[:-1]
        return np.append(np.flatnonzero(change), len(frame))

    held: list[pd.DataFrame] = []
    count = 0
    for frame in frames:
        if not len(frame):
            continue
        held.append(frame)
        count += len(frame)
        if count < rows:
            continue
        whole, starts = cut(held)
        last = starts[-2]
        if last:
            yield whole.iloc[:last], starts[:-1]
        held = [whole.iloc[last:]]
        count = len(whole) - last
    if count:
        yield cut(held)


def map_sorted_groups(df: DataFrame, keys: list[str], order: Sequence[str | Column], fn: Callable[[pd.DataFrame, np.ndarray], pd.DataFrame], schema: str, drop: Sequence[str] = ()) -> DataFrame:
    """Applies ``fn`` to whole groups of ``keys``, many at a time, after one shuffle and one sort; columns of ``drop`` only order rows.

    ``fn`` gets complete groups and their starts. Unlike a call per group, thousands of short
    groups share one vectorised call.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole, starts in sorted_groups(frames, keys):
            out = fn(whole, starts)
            if len(out):
                yield out

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).drop(*drop).mapInPandas(run, schema)
