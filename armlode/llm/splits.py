"""Splits that keep related records together: frontier components, then components in hash order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from armlode.operators.scale import bounded_broadcast, hot_keys, spread_join, stored
from armlode.sources.tables import source_key

#: What stands for no task, as letters and digits only.
NO_TASK = ("", "tbd", "na", "nan", "none", "null", "nil", "unknown", "unlabeled", "unlabelled", "unnamed", "untitled", "nodescription", "notask", "notavailable", "todo", "undefined", "missing", "empty", "unspecified", "placeholder", "default", "xxx")
#: Buckets of the running size of components in hash order, and of the places of splits.
BUCKETS = 1024


def recording_key(source_episode: Column) -> Column:
    """An identifier without case, appended range of frames, prefix word and zero padding."""
    text = F.regexp_replace(F.lower(F.trim(source_episode)), r"\s*(?:#\s*\d+\s*[-:]\s*\d+|\[\s*\d+\s*[:-]\s*\d+\s*\])$", "")
    bare = F.regexp_replace(text, r"^(?:(?:episode|ep|recording|rec|[g-z][a-z]*)(?=[\s_\-:.]*\d)[\s_\-:.]*|[a-z]+[\s_\-:.]+)", "")
    return F.when(bare.rlike(r"^\d+$"), F.regexp_replace(bare, r"^0+(?=\d)", "")).otherwise(F.when(bare != "", bare))


def task_key(task: Column) -> Column:
    """A task's letters and digits in lower case; null where it says nothing."""
    key = F.lower(F.regexp_replace(task, r"[^\p{L}\p{N}]+", ""))
    return F.when(~key.isin(*NO_TASK), key)


def relations(episodes: DataFrame, source_config: DataFrame) -> DataFrame:
    """(episode_id, node): the recording and the task that each episode belongs to, as hashed nodes."""
    repos = source_config.groupBy(source_key("name").alias("source")).agg(F.min(F.lower(F.trim("repo_id"))).alias("repo"))
    rows = episodes.filter("episode_id is not null").select("episode_id", source_key("source_dataset").alias("source"), recording_key(F.col("source_episode")).alias("recording"), task_key(F.col("task")).alias("task"))
    keyed = rows.join(bounded_broadcast(repos), "source", "left").withColumn("place", F.coalesce(F.concat(F.lit("repo:"), "repo"), F.concat(F.lit("source:"), "source"), F.lit("")))
    nodes = F.array_compact(F.array(F.when(F.col("recording").isNotNull(), F.unhex(F.md5(F.concat_ws("\u0001", F.lit("r"), "place", "recording")))), F.when(F.col("task").isNotNull(), F.unhex(F.md5(F.concat_ws("\u0001", F.lit("t"), "task"))))))
    return keyed.select("episode_id", F.explode(nodes).alias("node")).distinct()


def components(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(node, label): connected components of the undirected edges (a, b), by frontiers from many seeds.

    Adjacency is hash-partitioned by node, the lists of hub nodes (see ``hot_keys``) by neighbour too, so that a node with a third
    of all edges is expanded by many tasks. Seeds are the nodes that come before all their neighbours
    in hash order, so every component has one. All frontiers advance a step at a time, each unlabelled node
    taking the least label that reaches it, until none is left; labels that meet make the edges of a much smaller graph, which is
    treated alike until no labels meet. Each step is written to the checkpoint folder. Nothing reaches the driver but counts and hubs, less than 1024 a round.
    """
    both = stored(edges.filter("a <> b").select("a", "b").union(edges.filter("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    mapping = edges.select(F.col("a").alias("node")).union(edges.select(F.col("b").alias("node"))).distinct().withColumn("label", F.col("node"))
    for _ in range(max_rounds):
        if both.isEmpty():
            return mapping
        hubs = hot_keys(both, "a")
        labels = _frontiers(both, hubs)
        # a label of the round before is a node of this one; many nodes may share it
        named = labels.select(F.col("node").alias("label"), F.col("label").alias("to"))
        mapping = stored(mapping)
        mapping = stored(spread_join(mapping, named, "label", "node", hot_keys(mapping, "label"), "left").select("node", F.coalesce("to", "label").alias("label")))
        at_a = spread_join(both, labels.select(F.col("node").alias("a"), F.col("label").alias("la")), "a", "b", hubs)
        at_b = spread_join(at_a, labels.select(F.col("node").alias("b"), F.col("label").alias("lb")), "b", "a", hubs.withColumnRenamed("a", "b"))
        both = stored(at_b.filter("la <> lb").select(F.col("la").alias("a"), F.col("lb").alias("b")).distinct())
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _frontiers(both: DataFrame, hubs: DataFrame) -> DataFrame:
    """Labels of all nodes of a symmetric graph by concurrent breadth-first expansion from its local minima.

    A step reaches nodes of its own level, the one before and the next, so only these two are compared and no level is written twice.
    """
    rank = lambda c: F.struct(F.xxhash64(c), F.col(c))
    nearest = both.groupBy("a").agg(F.min(rank("b")).alias("least"))
    levels = [stored(nearest.filter(rank("a") < F.col("least")).select(F.col("a").alias("node"), F.col("a").alias("label")))]
    while True:
        known = levels[-1] if len(levels) == 1 else levels[-1].unionByName(levels[-2])
        reached = spread_join(both, levels[-1].withColumnRenamed("node", "a"), "a", "b", hubs).groupBy(F.col("b").alias("node")).agg(F.min("label").alias("label"))
        fresh = stored(reached.join(known.select("node"), "node", "left_anti"))
        if fresh.isEmpty():
            break
        levels.append(fresh)
    done = levels[0]
    for level in levels[1:]:
        done = done.unionByName(level)
    return done


def related_groups(episodes: DataFrame, source_config: DataFrame) -> DataFrame:
    """(episode_id, group_id) of every episode; ``group_id`` is the smallest episode_id of its group.

    Episodes are related that come from one recording (sources of one repository, one identifier up to
    case, prefix, zero padding and an appended range) or carry out one task (up to case, spacing and
    punctuation); relations chain. Each episode ties the nodes it belongs to, so a task with a third of all
    episodes is one node and no pairs are made. Null, blank and placeholder values relate nothing; such an episode is a group of its own. Repeated rows are one
    episode; null ids are dropped; empty tables give no rows.
    """
    return _sized_groups(episodes, source_config).select("episode_id", "group_id")


def _sized_groups(episodes: DataFrame, source_config: DataFrame) -> DataFrame:
    """:func:`related_groups` with ``n``, the size of the group."""
    rel = stored(relations(episodes, source_config))
    per = rel.groupBy("episode_id").agg(F.min("node").alias("a"))
    # copies of an episode may differ, so it can have more than two nodes
    labels = components(rel.join(per, "episode_id").select("a", F.col("node").alias("b")).distinct())
    one = stored(per)
    member = stored(spread_join(one, labels.withColumnRenamed("node", "a"), "a", "episode_id", hot_keys(one, "a")).select("episode_id", "label"))
    least = member.groupBy("label").agg(F.min("episode_id").alias("group_id"), F.count("*").alias("n"))
    named = spread_join(member, least, "label", "episode_id", hot_keys(member, "label")).select("episode_id", "group_id", "n")
    alone = episodes.select("episode_id").filter("episode_id is not null").distinct()
    return alone.join(named, "episode_id", "left").select("episode_id", F.coalesce("group_id", "episode_id").alias("group_id"), F.coalesce("n", F.lit(1)).alias("n"))


def related(episodes: DataFrame, source_config: DataFrame) -> DataFrame:
    """The episodes that are related to another, with the smallest episode_id of their group."""
    return _sized_groups(episodes, source_config).filter("n > 1").select("episode_id", "group_id")


def assign_splits(groups: DataFrame, plan: DataFrame) -> DataFrame:
    """(episode_id, group_id, split_name): whole groups in hash order, cut at the shares of the plan.

    Groups are laid end to end by the hash of their id, and each goes to the split that its middle lies in; the splits
    follow by share, the largest first. A group larger than half the smallest share comes before all others, largest
    first, so that no small split is swallowed. Shares need not sum to 1. An empty plan gives no rows. The plan is joined by place, whatever its length.
    """
    shares = plan.filter("split_name is not null and share > 0").groupBy("split_name").agg(F.max("share").alias("share"))
    sums = shares.agg(F.sum("share").alias("whole"), F.min("share").alias("least")).first()
    if sums["whole"] is None:
        return groups.select("episode_id", "group_id", F.lit(None).cast("string").alias("split_name")).limit(0)
    whole, least = sums["whole"], sums["least"]
    sizes = stored(groups.groupBy("group_id").agg(F.count("*").alias("n")))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    # large groups come first by size, in bucket 0; there are fewer of them than 2 * whole / least
    ranked = sizes.withColumn("large", F.col("n") > total * least / whole / 2)
    placed = ranked.withColumns({"_bucket": F.when(F.col("large"), 0).otherwise(1 + F.pmod(F.xxhash64("group_id"), F.lit(BUCKETS))), "_key": F.when(F.col("large"), -F.col("n")).otherwise(F.xxhash64(F.lit(7), F.col("group_id")))})
    counts = placed.groupBy("_bucket").agg(F.sum("n").alias("_sum"))
    before = counts.withColumn("_start", F.coalesce(F.sum("_sum").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_sum")
    within = Window.partitionBy("_bucket").orderBy("_key", "group_id").rowsBetween(Window.unboundedPreceding, -1)
    middle = (F.col("_start") + F.coalesce(F.sum("n").over(within), F.lit(0)) + F.col("n") / 2) / F.lit(float(max(total, 1)))
    at = placed.join(bounded_broadcast(before), "_bucket").withColumn("middle", middle)
    # the splits' places in 0..1, laid over buckets, so that each group meets the few splits of its bucket
    ends = shares.withColumn("end", F.sum("share").over(Window.orderBy(F.desc("share"), "split_name").rowsBetween(Window.unboundedPreceding, 0)) / whole)
    spans = ends.withColumns({"start": F.coalesce(F.lag("end").over(Window.orderBy("end")), F.lit(0.0)), "last": F.lead("end").over(Window.orderBy("end")).isNull()})
    bucket = lambda c: F.least(F.floor(c * BUCKETS), F.lit(BUCKETS - 1)).cast("long")
    laid = spans.withColumn("_place", F.explode(F.sequence(bucket(F.col("start")), bucket(F.col("end"))))).select("_place", "start", "end", "last", "split_name")
    hit = at.withColumn("_place", bucket(F.col("middle"))).join(bounded_broadcast(laid), "_place").filter((F.col("middle") >= F.col("start")) & ((F.col("middle") < F.col("end")) | F.col("last")))
    return spread_join(groups, hit.select("group_id", "split_name"), "group_id", "episode_id", hot_keys(groups, "group_id")).select("episode_id", "group_id", "split_name")
